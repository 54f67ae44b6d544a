"""The upload pipeline: two transform phases around an ordered, gated load.

Phase 1 cleans the roster, settles who the people of both sheets are (filled numbers, one identity per upload against
the state) and builds employees, education and jobs from the roster.  These are loaded (master first; dependents only when the master loaded).
Phase 2 then resolves the assessment sheet against the *refreshed* state and builds the people new to the state, job
rows for people without any, assessments and the career roadmap, and loads them.

All transforms are lazy DataFrame plans.  Lineage is cut where one result feeds several (the resolved sheets) and at
every commit: with a ``SnapshotStore`` a commit is a versioned Parquet write the next phase reads back, with a
``LazyState`` (query registry, tests) it is a staged copy in the shared folder.  A loaded dataset is computed once: rows
to load and rows with a reason against them are written together, and all counts are taken from what is written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.operators.cleaning import classify, normalize_gender_column
from rosterline.operators.datasets import (
    assessment_history,
    career_roadmap,
    education_history,
    employees_from_roster,
    job_history,
    job_history_supplement,
    new_employees,
)
from rosterline.operators.headers import conform_headers
from rosterline.operators.keys import ASSESSMENT, ROSTER, next_counter_value
from rosterline.operators.resolve import attach, cell_pairs, fill_pairs, identify, refresh
from rosterline.operators.upsert import accepted, merge, project_incoming
from rosterline.plans.outcomes import Outcome, UploadReport, report
from rosterline.session import cut
from rosterline.sources.snapshots import LazyState, SnapshotStore, StateStore
from rosterline.specs import (
    ASSESSMENT_COLUMNS,
    ASSESSMENTS,
    EDUCATION,
    EMPLOYEES,
    JOBS,
    LOAD_ORDER,
    MASTER,
    ROADMAP,
    ROSTER_COLUMNS,
    UNK_DEFAULT_START,
    DatasetSpec,
)

DEFAULT_SALT = "rosterline"


#: A dataset, or what builds it: an error in building one table is that table's own.
Dataset = DataFrame | Callable[[], DataFrame]


@dataclass(frozen=True)
class Clock:
    """The time of a load: one value for all its rows, also when tasks run again."""

    at: datetime

    @classmethod
    def now(cls) -> Clock:
        return cls(datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0))

    @property
    def time(self) -> Column:
        return F.lit(self.at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")

    @property
    def date(self) -> Column:
        return F.lit(self.at.strftime("%Y-%m-%d")).cast("date")


@dataclass
class Phase1:
    """identities: the upload's distinct (number, name) cells with filled number and name, employee_id and match_kind."""

    datasets: dict[str, Dataset]
    assessment: DataFrame
    roster_resolved: DataFrame
    identities: DataFrame
    salt: str

    @property
    def assessment_filled(self) -> DataFrame:
        return attach(self.assessment, self.identities, ASSESSMENT, self.salt).drop("employee_id", "match_kind")


def conform_sheets(raw: DataFrame, assessment: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Workbook headers → internal names (P1/P3); the roster must have an employee number and a name column (P2)."""
    return (conform_headers(raw, ROSTER_COLUMNS, "roster", required=("nik", "nama")),
            conform_headers(assessment, ASSESSMENT_COLUMNS, "assessment"))


def phase1(raw: DataFrame, assessment: DataFrame, state: StateStore, start_counter: int, salt: str = DEFAULT_SALT,
           status_from_end_date: bool = False, fallback_key: tuple[str, ...] = ("name",)) -> Phase1:
    emp, jobs = state.read(EMPLOYEES.name), state.read(JOBS.name)
    raw = normalize_gender_column(raw)
    pairs = cut(cell_pairs([(ROSTER, raw), (ASSESSMENT, assessment)]))
    filled = fill_pairs(pairs, emp, jobs, start_counter)
    ids = cut(identify(filled, emp, jobs, salt, tie_names="nik" not in fallback_key))
    # The resolved roster feeds three datasets, the identities both sheets: compute each once.
    raw_r = cut(attach(raw, ids, ROSTER, salt))
    datasets = {
        EMPLOYEES.name: lambda: employees_from_roster(raw_r),
        EDUCATION.name: lambda: education_history(raw_r),
        JOBS.name: lambda: job_history(raw_r, status_from_end_date=status_from_end_date),
    }
    return Phase1(datasets, assessment, raw_r, ids, salt)


def resolve_assessment(p1: Phase1, state: StateStore) -> DataFrame:
    """The assessment's people in the refreshed state; who isn't there keeps the identity that phase 1 gave."""
    ids = refresh(p1.identities.where(F.col("_last") == ASSESSMENT), state.read(EMPLOYEES.name), state.read(JOBS.name))
    return cut(attach(p1.assessment, ids, ASSESSMENT, p1.salt))


def phase2(p1: Phase1, state: StateStore) -> dict[str, Dataset]:
    """The assessment's datasets.  People and jobs new to the state are those new after phase 1, whenever they are built."""
    ass_r = resolve_assessment(p1, state)
    emp, jobs = state.read(EMPLOYEES.name), state.read(JOBS.name)
    return {
        EMPLOYEES.name: lambda: new_employees(ass_r, emp),
        JOBS.name: lambda: job_history_supplement(ass_r, jobs),
        ASSESSMENTS.name: lambda: assessment_history(ass_r),
        ROADMAP.name: lambda: career_roadmap(ass_r),
    }


def built(dataset: Dataset) -> DataFrame:
    return dataset if isinstance(dataset, DataFrame) else dataset()


def _load_one(state: StateStore, dataset: Dataset, spec: DatasetSpec, clock: Clock, owner: str, evaluate: bool) -> Outcome:
    """Classifies, merges and commits one dataset; with ``evaluate`` it is written once, for rows, rejects and counts."""
    proj = project_incoming(built(dataset), spec)
    if proj is None:
        return Outcome(spec.name, "absent")
    parents = state.read(spec.parents[0]) if spec.parents else None
    flagged = classify(proj, spec, clock.date, parents)
    if not evaluate:
        state.commit(spec.name, merge(state.read(spec.name), accepted(flagged), spec, now=clock.time))
        return Outcome(spec.name, "loaded")
    flagged = state.write_given(spec.name, flagged, owner)
    copies = F.col("_copies") if "_copies" in flagged.columns else F.lit(1)
    seen = {r["_reason"]: r for r in flagged.groupBy("_reason").agg(F.count(F.lit(1)).alias("n"), F.sum(copies).alias("m")).collect()}
    out = Outcome(spec.name, "empty", given=sum(r["n"] for r in seen.values()), before_dedup=sum(r["m"] for r in seen.values()),
                  **{reason: r["n"] for reason, r in seen.items() if reason})
    if None not in seen:
        return out
    rows = accepted(flagged)
    touched = state.touched(rows)
    merged = merge(state.read_buckets(spec.name, touched), rows, spec, now=clock.time)
    committed = state.commit(spec.name, merged, touched, owner)
    done = {r["_action"]: r["n"] for r in committed.groupBy("_action").agg(F.count(F.lit(1)).alias("n")).collect()}
    keys = {a: done.get(a, 0) for a in ("insert", "update", "ignore")}
    return replace(out, status="loaded", rows_upserted=keys["insert"] + keys["update"], ignored=keys["ignore"], collapsed=seen[None]["n"] - sum(keys.values()))


def load(state: StateStore, datasets: dict[str, Dataset], present: tuple[str, ...] = (), evaluate: bool = True,
         clock: Clock | None = None, owner: str = DEFAULT_SALT) -> dict[str, Outcome]:
    """Loads datasets along the parent graph of their specs; every table's commit stands on its own.

    A table whose parent neither loaded here nor is ``present`` already is skipped, and says because of which.  An
    error ends its own table only: the others are loaded, then ``LoadFailed`` is raised.  ``evaluate=False`` (lazy state)
    counts nothing and takes every commit for loaded.
    """
    return report(_settled(state, datasets, present, evaluate, clock, owner)).checked().results


def _settled(state: StateStore, datasets: dict[str, Dataset], present: tuple[str, ...], evaluate: bool,
             clock: Clock | None, owner: str) -> dict[str, Outcome]:
    """``load``, with the errors of failed tables in their outcomes."""
    outcomes: dict[str, Outcome] = {}
    clock = clock or Clock.now()

    def settle(spec: DatasetSpec) -> Outcome:
        for parent in spec.parents:
            before = outcomes.get(parent)
            if parent not in present and not (before and before.success):
                cause = f": {before.error}" if before and before.error else ""
                return Outcome(spec.name, "skipped", error=f"{parent} holds no loaded rows{cause}")
        try:
            return _load_one(state, datasets[spec.name], spec, clock, owner, evaluate)
        except Exception as e:  # noqa: BLE001 - kept in the outcome, and raised when the other tables are done
            return Outcome(spec.name, "failed", error=str(e), cause=e)

    for spec in LOAD_ORDER:
        if spec.name in datasets:
            outcomes[spec.name] = settle(spec)
    return outcomes


def upload(spark: SparkSession, store: SnapshotStore | LazyState, raw: DataFrame, assessment: DataFrame,
           upload_id: str = DEFAULT_SALT, evaluate: bool = True, clock: Clock | None = None) -> UploadReport:
    """One upload (L5): counter snapshot → phase 1 → load → phase 2 on the refreshed state → load → report.

    ``upload_id`` salts generated ids: the same upload gives the same ids again, another upload doesn't take its
    one-word names for the same people.  Without a loaded master there is no second phase.  ``clock``: the time that
    inserted rows get and that decides the century of birth dates (default: now).  ``LoadFailed`` is raised at the end if a
    table of either phase failed.
    """
    clock = clock or Clock.now()
    counter = next_counter_value(store.read(JOBS.name))
    p1 = phase1(raw, assessment, store, counter, upload_id)
    first = _settled(store, p1.datasets, (), evaluate, clock, upload_id)
    if not first[MASTER].success:
        return report(first).checked()
    return report(first, _settled(store, phase2(p1, store), (MASTER,), evaluate, clock, upload_id)).checked()


def upload_sheets(spark: SparkSession, store: SnapshotStore | LazyState, raw: DataFrame, assessment: DataFrame,
                  upload_id: str, evaluate: bool = True, clock: Clock | None = None) -> UploadReport:
    """``upload`` of sheets as ``sources.sheets.read_workbook`` gives them: workbook headers, numbered rows."""
    raw, assessment = conform_sheets(raw, assessment)
    return upload(spark, store, cut(raw), cut(assessment), upload_id, evaluate, clock)


def transform_only(spark: SparkSession, raw: DataFrame, assessment: DataFrame, share_state: bool = True,
                   start_counter: int = UNK_DEFAULT_START, salt: str = DEFAULT_SALT) -> dict[str, DataFrame]:
    """One-shot run without a database (L4): both phases, same-named datasets unioned by name.

    With ``share_state`` the phase-1 output serves as the state phase 2 resolves against (so a roster person in the
    assessment keeps one id); ``share_state=False`` resolves phase 2 against an empty state, as the original does.
    """
    state = LazyState(spark)
    p1 = phase1(raw, assessment, state, start_counter, salt)
    p1.datasets = {name: cut(built(d)) for name, d in p1.datasets.items()}  # loaded here, and returned
    if share_state:
        load(state, p1.datasets, evaluate=False)
        p2 = phase2(p1, state)
    else:
        p2 = phase2(p1, LazyState(spark))
    merged = {name: built(d) for name, d in p1.datasets.items()}
    for name, d in p2.items():
        df = built(d)
        merged[name] = merged[name].unionByName(df, allowMissingColumns=True) if name in merged else df
    return merged
