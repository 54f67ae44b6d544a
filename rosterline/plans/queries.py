"""Registered queries: one per operator key of the blueprint, each ``(spark, sf_dir) -> DataFrame``.

Inputs are the derived sheets and state tables of ``sources.fixtures`` over the generated tables of ``sf_dir``; every
query runs over whole tables.  Helper columns (``_ord``, ``_action``) never leave a query.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.functions.dates import parse_date
from rosterline.functions.text import blank_to_default, is_missing, normalize_gender, strip_ws, token_count
from rosterline.operators import audit, checks, recycle
from rosterline.operators.cleaning import classify, defaulted_genders, drop_all_null, drop_incomplete_keys, fill_blank
from rosterline.operators.datasets import JOB_DEDUP_SUBSET, golden_record as golden
from rosterline.operators.dedup import duplicate_rows as dup_rows
from rosterline.operators.headers import conform_headers, project_to_target
from rosterline.operators.keys import ASSESSMENT, ROSTER, existing_key_lookup, missing_names as names_needing_keys
from rosterline.operators.keys import next_counter as counter_df
from rosterline.operators.keys import next_counter_value
from rosterline.operators.resolve import cell_pairs, match_stats as stats_by_kind
from rosterline.operators.resolve import state_lookup as lookup_rows
from rosterline.operators.upsert import append_rows as append, conform, merge, prepare_incoming, project_incoming, upsert_stats as stats
from rosterline.plans.pipeline import (
    DEFAULT_SALT,
    Clock,
    built,
    load,
    phase1,
    phase2,
    resolve_assessment,
    transform_only,
    upload,
    upload_sheets,
)
from rosterline.session import cut, merged, scratch_path
from rosterline.sources.fixtures import Fixtures
from rosterline.sources.sheets import clean_cells, read_workbook, spread, write_workbook
from rosterline.sources.snapshots import LazyState, SnapshotStore
from rosterline.specs import (
    ASSESSMENT_COLUMNS,
    ASSESSMENTS,
    EDUCATION,
    EMPLOYEES,
    GENDER_DOMAIN,
    JOB_STATUS_DOMAIN,
    JOBS,
    ROADMAP,
    ROSTER_COLUMNS,
    SPECS,
)

Query = Callable[[SparkSession, str], DataFrame]

# Pattern used by the delete / count queries to pick people by name (the guide's "test people" filter).
DELETE_PATTERN = "%customer#%7"
COUNT_PATTERN = "vendor %"

# The time of every load here (it decides the century of birth dates, so the oracle states it too).
CLOCK = Clock(datetime(2026, 1, 1))

# Workbook spellings used to check header matching (upper/lower case, padding, a format hint after a newline or in
# parentheses, one column the roster does not define).
WORKBOOK_HEADERS = {
    "tahun": " Tahun ",
    "nik": "NIK/NIP",
    "nama": "Nama\n(sesuai KTP)",
    "jenis_kelamin": "JENIS KELAMIN",
    "tanggal_lahir": "TANGGAL LAHIR\n(DD/MM/YY)",
    "subholding": "SUBHOLDING (kode)",
    "subco": "subco",
    "job_title": "JOB TITLE",
    "tanggal_masuk_kerja": "TANGGAL MASUK KERJA (DD/MM/YYYY)",
    "tanggal_resign": "Tanggal Resign/Mutasi",
    "tingkat_pendidikan": "Tingkat Pendidikan",
    "universitas": "UNIVERSITAS ",
    "jurusan": "Jurusan",
}


# ---------------------------------------------------------------------------------------------------------------------
# Shared building blocks
# ---------------------------------------------------------------------------------------------------------------------


class Upload:
    """The derived upload of one scale factor, built lazily and step by step."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.fx = Fixtures(spark, sf_dir)
        # Ingest stages the cleaned sheets once (as a real upload does); every later step reads the staged copy.
        self.raw = cut(clean_cells(spread(self.fx.raw_data)))
        self.ass = cut(clean_cells(spread(self.fx.assesment)))
        self._p1 = None
        self._built: dict[tuple[int, str], DataFrame] = {}
        self._state = None
        self._p2 = None

    def dataset(self, phase: int, name: str) -> DataFrame:
        """One dataset of a phase, as the phase builds it."""
        if (phase, name) not in self._built:
            self._built[phase, name] = built((self.p1.datasets if phase == 1 else self.p2)[name])
        return self._built[phase, name]

    def stage(self, name: str) -> DataFrame:
        """A dataset of phase 1 that the load and the query both read, built once."""
        if not isinstance(self.p1.datasets[name], DataFrame):
            self.p1.datasets[name] = cut(built(self.p1.datasets[name]))
        return self.p1.datasets[name]

    def db_state(self) -> LazyState:
        return LazyState(self.spark, {
            EMPLOYEES.name: self.fx.db_employees,
            JOBS.name: self.fx.db_jobs,
            EDUCATION.name: self.fx.db_education,
        })

    @property
    def p1(self):
        if self._p1 is None:
            state = self.db_state()
            counter = next_counter_value(self.fx.db_jobs)
            self._p1 = phase1(self.raw, self.ass, state, counter, DEFAULT_SALT)
            self._state = state
        return self._p1

    @property
    def state_after_p1(self) -> LazyState:
        p1 = self.p1
        if not getattr(self, "_loaded1", False):
            load(self._state, p1.datasets, evaluate=False, clock=CLOCK)
            self._loaded1 = True
        return self._state

    @property
    def p2(self) -> dict[str, DataFrame]:
        if self._p2 is None:
            self._p2 = phase2(self.p1, self.state_after_p1)
        return self._p2

    @property
    def state_after_p2(self) -> LazyState:
        p2 = self.p2
        if not getattr(self, "_loaded2", False):
            load(self._state, p2, present=(EMPLOYEES.name,), evaluate=False, clock=CLOCK)
            self._loaded2 = True
        return self._state


STAMPS = ("created_at", "updated_at")


def _rows(state, spec) -> DataFrame:
    """A state table without the times of its rows."""
    return state.read(spec.name).drop(*STAMPS)


def _no_ord(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def _union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------------------------------------------------------
# Ingest, cleaning, projection
# ---------------------------------------------------------------------------------------------------------------------


def q_ingest_clean(spark, sf_dir):
    return clean_cells(Fixtures(spark, sf_dir).raw_data)


def q_header_match(spark, sf_dir):
    raw = Fixtures(spark, sf_dir).raw_data
    sheet = raw.select(
        "row_id",
        F.lit("national id").alias("NIK (KTP)"),  # not the employee number, though it comes first
        *[F.col(c).alias(WORKBOOK_HEADERS.get(c, c)) for c in raw.columns if c != "row_id"],
        F.lit("x").alias("Catatan"),
    )
    return conform_headers(clean_cells(sheet), ROSTER_COLUMNS, "roster")


def q_blank_default(spark, sf_dir):
    raw = Fixtures(spark, sf_dir).raw_data
    return raw.select("row_id", blank_to_default("job_title", "Unknown").alias("job_title"))


def q_gender_normalize(spark, sf_dir):
    raw = Fixtures(spark, sf_dir).raw_data
    return raw.select("row_id", normalize_gender("jenis_kelamin").alias("jenis_kelamin"))


def q_target_projection(spark, sf_dir):
    raw = clean_cells(Fixtures(spark, sf_dir).raw_data)
    return drop_all_null(project_to_target(raw, EMPLOYEES))


def q_key_complete(spark, sf_dir):
    jobs = project_to_target(Upload(spark, sf_dir).dataset(1, JOBS.name), JOBS)
    return drop_incomplete_keys(drop_all_null(jobs), JOBS.key)


def q_date_coerce(spark, sf_dir):
    raw = clean_cells(Fixtures(spark, sf_dir).raw_data)
    return raw.select(
        "row_id",
        parse_date("tanggal_lahir", latest=CLOCK.date).alias("birth_date"),
        parse_date("tanggal_masuk_kerja").alias("tanggal_mulai"),
        parse_date("tanggal_resign").alias("tanggal_selesai"),
    )


def q_pattern_filter(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    j = fx.db_employees.join(merged(fx.db_jobs), "employee_id", "inner")
    k = F.col("employee_no_subholding")
    return j.where(F.col("fullname").ilike("%customer#%") & k.like("unk-%") & k.rlike("^unk-[0-9]+$")).select(
        "fullname", "employee_no_subholding"
    )


# ---------------------------------------------------------------------------------------------------------------------
# Golden record and phase-1 datasets
# ---------------------------------------------------------------------------------------------------------------------


def q_golden_record(spark, sf_dir):
    raw = fill_blank(clean_cells(spread(Fixtures(spark, sf_dir).raw_data)), "job_title")
    cols = ["nik", "nama", "tanggal_lahir", "jenis_kelamin", "subholding", "subco", "job_title"]
    return golden(raw.select("tahun", *cols, "row_id"), "nik", cols)


def q_employees_from_roster(spark, sf_dir):
    return _no_ord(Upload(spark, sf_dir).dataset(1, EMPLOYEES.name))


def q_education_history(spark, sf_dir):
    return _no_ord(Upload(spark, sf_dir).dataset(1, EDUCATION.name))


def q_job_history(spark, sf_dir):
    return _no_ord(Upload(spark, sf_dir).dataset(1, JOBS.name))


def q_duplicate_rows(spark, sf_dir):
    r = Upload(spark, sf_dir).p1.roster_resolved
    src = fill_blank(r.select("row_id", "employee_id", "nama", "nik", "subholding", "subco", "job_title",
                              "tanggal_masuk_kerja"), "job_title")
    return dup_rows(src, JOB_DEDUP_SUBSET).select("row_id", "employee_id", "nama", "nik", "job_title")


def q_duplicate_names(spark, sf_dir):
    emp = Upload(spark, sf_dir).state_after_p2.read(EMPLOYEES.name)
    return (
        emp.where(F.col("fullname").isNotNull()).groupBy("fullname")
        .agg(F.count(F.lit(1)).cast("bigint").alias("n")).where(F.col("n") > 1)
    )


# ---------------------------------------------------------------------------------------------------------------------
# Keys
# ---------------------------------------------------------------------------------------------------------------------


def q_next_counter(spark, sf_dir):
    return counter_df(Fixtures(spark, sf_dir).db_jobs)


def _names(u: Upload) -> DataFrame:
    return names_needing_keys(cell_pairs([(ROSTER, u.raw), (ASSESSMENT, u.ass)]))


def q_existing_key_lookup(spark, sf_dir):
    u = Upload(spark, sf_dir)
    names = _names(u).withColumn("name_key", F.lower(strip_ws("nama")))
    return existing_key_lookup(names, u.fx.db_employees, u.fx.db_jobs)


def q_state_lookup(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return lookup_rows(fx.db_employees, fx.db_jobs)


def q_missing_names(spark, sf_dir):
    return _names(Upload(spark, sf_dir))


def q_fill_missing_key(spark, sf_dir):
    u = Upload(spark, sf_dir)
    p1 = u.p1
    roster = p1.roster_resolved.select("row_id", "nama", "nik")
    return (
        roster.select(F.lit(ROSTER).alias("sheet"), "row_id", "nama", "nik")
        .unionByName(p1.assessment_filled.select(F.lit(ASSESSMENT).alias("sheet"), "row_id", "nama", "nik"))
    )


# ---------------------------------------------------------------------------------------------------------------------
# Resolution
# ---------------------------------------------------------------------------------------------------------------------


def q_entity_resolve(spark, sf_dir):
    return Upload(spark, sf_dir).p1.roster_resolved.select("row_id", "nik", "nama", "employee_id", "match_kind")


def q_match_stats(spark, sf_dir):
    u = Upload(spark, sf_dir)
    roster = stats_by_kind(u.p1.roster_resolved).select(F.lit(ROSTER).alias("sheet"), "match_kind", "n")
    ass = stats_by_kind(resolve_assessment(u.p1, u.state_after_p1))
    return roster.unionByName(ass.select(F.lit(ASSESSMENT).alias("sheet"), "match_kind", "n"))


# ---------------------------------------------------------------------------------------------------------------------
# Phase-2 datasets
# ---------------------------------------------------------------------------------------------------------------------


def q_new_employees(spark, sf_dir):
    return _no_ord(Upload(spark, sf_dir).dataset(2, EMPLOYEES.name))


def q_job_history_supplement(spark, sf_dir):
    return _no_ord(Upload(spark, sf_dir).dataset(2, JOBS.name))


def q_assessment_history(spark, sf_dir):
    return _no_ord(Upload(spark, sf_dir).dataset(2, ASSESSMENTS.name))


def q_career_roadmap(spark, sf_dir):
    return _no_ord(Upload(spark, sf_dir).dataset(2, ROADMAP.name))


def q_merge_phases(spark, sf_dir):
    u = Upload(spark, sf_dir)
    return _no_ord(transform_only(spark, u.raw, u.ass, share_state=True)[EMPLOYEES.name])


# ---------------------------------------------------------------------------------------------------------------------
# State changes
# ---------------------------------------------------------------------------------------------------------------------


def q_upsert_state(spark, sf_dir):
    return _rows(Upload(spark, sf_dir).state_after_p1, EMPLOYEES)


def q_insert_ignore(spark, sf_dir):
    return Upload(spark, sf_dir).state_after_p1.read(EDUCATION.name)


def _typed_p1(u: Upload, spec) -> DataFrame:
    staged = u.stage(spec.name)
    parents = u.state_after_p1.read(EMPLOYEES.name) if spec.parents else None
    return prepare_incoming(staged, spec, CLOCK.date, parents)


def q_append_rows(spark, sf_dir):
    u = Upload(spark, sf_dir)
    return append(u.fx.db_jobs, _no_ord(_typed_p1(u, JOBS)), JOBS).drop(*STAMPS)


def q_default_fill(spark, sf_dir):
    """People's values and times: rows that the load inserts take the defaults and the clock, others keep what they have."""
    emp = Upload(spark, sf_dir).state_after_p2.read(EMPLOYEES.name)
    return emp.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in STAMPS})


def q_upsert_stats(spark, sf_dir):
    u = Upload(spark, sf_dir)
    state = u.db_state()
    parts = []
    # Load order of phase 1, each dataset against the state the previous commit left.
    for spec in (EMPLOYEES, JOBS, EDUCATION):
        typed = cut(prepare_incoming(u.dataset(1, spec.name), spec, CLOCK.date, state.read(EMPLOYEES.name) if spec.parents else None))
        after = state.commit(spec.name, merge(state.read(spec.name), typed, spec, now=CLOCK.time))
        parts.append(stats(after, typed, spec.name))
    return _union_all(parts)


def _seeded_store(spark, u: Upload, name: str) -> SnapshotStore:
    store = SnapshotStore(spark, scratch_path(spark, name))
    store.seed({EMPLOYEES.name: u.fx.db_employees, JOBS.name: u.fx.db_jobs, EDUCATION.name: u.fx.db_education})
    return store


def q_reload_noop(spark, sf_dir):
    u = Upload(spark, sf_dir)
    store = _seeded_store(spark, u, "reload")
    upload(spark, store, u.raw, u.ass, clock=CLOCK)
    first = {name: store.latest_version(name) for name in SPECS}
    upload(spark, store, u.raw, u.ass, clock=CLOCK)
    parts = []
    for name, spec in SPECS.items():
        a = store.read_version(name, first[name]) if first[name] else spark.createDataFrame([], spec.schema)
        b = store.read(name)
        changed = audit.change_log(a, b, list(spec.key), name).agg(F.count(F.lit(1)).alias("changed"))
        na = a.agg(F.count(F.lit(1)).alias("rows_first"))
        nb = b.agg(F.count(F.lit(1)).alias("rows_second"))
        parts.append(
            _union_all([
                na.select(F.lit("a").alias("_k"), F.col("rows_first").alias("_v")),
                nb.select(F.lit("b").alias("_k"), F.col("rows_second").alias("_v")),
                changed.select(F.lit("c").alias("_k"), F.col("changed").alias("_v")),
            ]).agg(
                F.max(F.when(F.col("_k") == "a", F.col("_v"))).cast("bigint").alias("rows_first"),
                F.max(F.when(F.col("_k") == "b", F.col("_v"))).cast("bigint").alias("rows_second"),
                F.max(F.when(F.col("_k") == "c", F.col("_v"))).cast("bigint").alias("changed"),
            ).select(F.lit(name).alias("table_name"), "rows_first", "rows_second", "changed")
        )
    return _union_all(parts)


def q_two_uploads(spark, sf_dir):
    """The same names under other numbers in a second upload: one-word names of two uploads are two people."""
    u = Upload(spark, sf_dir)
    store = _seeded_store(spark, u, "two")
    upload(spark, store, u.raw, u.ass, clock=CLOCK)
    upload(spark, store, cut(u.raw.withColumn("nik", F.when(~is_missing("nik"), F.concat(F.lit("B"), "nik")))), u.ass, "second", clock=CLOCK)
    emp = store.read(EMPLOYEES.name).where(token_count("fullname") == 1)
    return emp.groupBy("fullname").agg(F.count(F.lit(1)).cast("bigint").alias("people"))


def _store_after_upload(spark, u: Upload, name: str) -> SnapshotStore:
    """All five tables as an upload leaves them, committed."""
    store = SnapshotStore(spark, scratch_path(spark, name))
    store.seed({spec.name: u.state_after_p2.read(spec.name) for spec in SPECS.values()})
    return store


def q_cascade_delete(spark, sf_dir):
    store = _store_after_upload(spark, Upload(spark, sf_dir), "delete")
    before = store.counts().select("table_name", F.col("n").alias("_before"))
    recycle.delete_people(store, F.col("fullname").ilike(DELETE_PATTERN), "d1", CLOCK.time)
    binned = recycle.recycle_bin(store).groupBy(F.col("entity_type").alias("table_name")).agg(F.count(F.lit(1)).alias("binned"))
    out = before.join(store.counts(), "table_name").join(binned, "table_name", "left")
    return out.select("table_name", (F.col("_before") - F.col("n")).alias("deleted"), F.col("n").alias("remaining"), F.coalesce("binned", F.lit(0)).cast("bigint").alias("binned"))


def q_fk_filter(spark, sf_dir):
    u = Upload(spark, sf_dir)
    parts = []
    for spec in (JOBS, EDUCATION):
        flagged = classify(project_incoming(u.dataset(1, spec.name), spec), spec, CLOCK.date, u.fx.db_employees)
        parts.append(flagged.agg(
            F.count_if(F.col("_reason").isNull()).cast("bigint").alias("kept"),
            F.count_if(F.col("_reason") == "orphaned").cast("bigint").alias("orphaned"),
        ).select(F.lit(spec.name).alias("dataset"), "kept", "orphaned"))
    return _union_all(parts)


def q_incomplete_entities(spark, sf_dir):
    state = Upload(spark, sf_dir).state_after_p2
    emp = state.read(EMPLOYEES.name).select("employee_id", "fullname")
    parts = []
    for label, spec in (("no_education", EDUCATION), ("no_assessment", ASSESSMENTS), ("no_roadmap", ROADMAP)):
        missing = checks.not_in(emp, "employee_id", state.read(spec.name), "employee_id")
        parts.append(missing.select(F.lit(label).alias("check_name"), "employee_id", "fullname"))
    return _union_all(parts)


def q_table_counts(spark, sf_dir):
    state = Upload(spark, sf_dir).state_after_p2
    emp = state.read(EMPLOYEES.name)
    chosen = emp.where(F.col("fullname").ilike(COUNT_PATTERN)).select("employee_id")
    parts = [emp.where(F.col("fullname").ilike(COUNT_PATTERN)).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
             .select(F.lit(EMPLOYEES.name).alias("tabel"), "n")]
    for spec in (JOBS, EDUCATION, ASSESSMENTS, ROADMAP):
        parts.append(
            state.read(spec.name).join(merged(chosen), "employee_id", "left_semi")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(F.lit(spec.name).alias("tabel"), "n")
        )
    return _union_all(parts)


# ---------------------------------------------------------------------------------------------------------------------
# Checks and audit
# ---------------------------------------------------------------------------------------------------------------------


def q_check_unique(spark, sf_dir):
    u = Upload(spark, sf_dir)
    jobs = u.stage(JOBS.name)
    return _union_all([
        checks.check_unique(u.dataset(2, ASSESSMENTS.name), ["employee_id", "asessment_year"], ASSESSMENTS.name),
        checks.check_unique(u.dataset(2, ROADMAP.name), ["employee_id", "year"], ROADMAP.name),
        checks.check_unique(jobs, JOB_DEDUP_SUBSET, JOBS.name),
    ])


def q_check_fk(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return _union_all([
        checks.check_fk(fx.table("lineitem"), fx.table("orders"), ["l_orderkey"], ["o_orderkey"], "lineitem.l_orderkey->orders"),
        checks.check_fk(fx.table("orders"), fx.table("customer"), ["o_custkey"], ["c_custkey"], "orders.o_custkey->customer"),
        checks.check_fk(fx.db_jobs, fx.db_employees, ["employee_id"], ["employee_id"], "riwayat_pekerjaan.employee_id->employees"),
    ])


def q_check_domain(spark, sf_dir):
    u = Upload(spark, sf_dir)
    return _union_all([
        checks.check_domain(u.raw, "jenis_kelamin", GENDER_DOMAIN, "raw_data"),
        checks.check_domain(u.state_after_p1.read(EMPLOYEES.name), "gender", GENDER_DOMAIN, EMPLOYEES.name),
        checks.check_domain(u.state_after_p1.read(JOBS.name), "status", JOB_STATUS_DOMAIN, JOBS.name),
        checks.check_domain(u.state_after_p1.read(EDUCATION.name), "tingkat_pendidikan", ("S1", "S2"), EDUCATION.name),
    ])


def q_check_not_null(spark, sf_dir):
    raw = clean_cells(Fixtures(spark, sf_dir).raw_data)
    return checks.check_not_null(raw, ["nik", "nama", "tanggal_masuk_kerja"], "raw_data")


def q_change_log(spark, sf_dir):
    u = Upload(spark, sf_dir)
    before = conform(u.fx.db_employees, EMPLOYEES).drop(*STAMPS)
    after = _rows(u.state_after_p1, EMPLOYEES)
    return audit.change_log(before, after, ["employee_id"], EMPLOYEES.name).select("entity_type", "employee_id", "action_type")


def q_recycle_restore(spark, sf_dir):
    """All five tables after two deletes of overlapping people and the restore of both."""
    store = _store_after_upload(spark, Upload(spark, sf_dir), "restore")
    recycle.delete_people(store, F.col("fullname").ilike(DELETE_PATTERN), "d1", CLOCK.time)
    recycle.delete_people(store, F.col("fullname").ilike(COUNT_PATTERN), "d2", CLOCK.time)
    recycle.restore_people(store, ["d1", "d2"], "2026-01-02 00:00:00")
    return _all_tables(store)


# ---------------------------------------------------------------------------------------------------------------------
# Whole uploads
# ---------------------------------------------------------------------------------------------------------------------


def _report_df(spark, report) -> DataFrame:
    rows = [(r.dataset, int(r.rows_upserted), bool(r.success)) for r in report.results.values()]
    return spark.createDataFrame(rows, "dataset string, rows_upserted bigint, success boolean")


def q_load_report(spark, sf_dir):
    u = Upload(spark, sf_dir)
    store = _seeded_store(spark, u, "load")
    return _report_df(spark, upload(spark, store, u.raw, u.ass, clock=CLOCK))


def q_pipeline_counts(spark, sf_dir):
    u = Upload(spark, sf_dir)
    store = _seeded_store(spark, u, "counts")
    upload(spark, store, u.raw, u.ass, clock=CLOCK)
    return store.counts()


def q_load_rejects(spark, sf_dir):
    u = Upload(spark, sf_dir)
    done = upload(spark, _seeded_store(spark, u, "rejects"), u.raw, u.ass, clock=CLOCK)
    rows = [(r.dataset, r.rejected, r.orphaned) for r in done.results.values()]
    return spark.createDataFrame(rows, "dataset string, rejected bigint, orphaned bigint")


def q_load_accounting(spark, sf_dir):
    """Where every row of every dataset went; ``reject_rows``: rows in the tables of rejects."""
    u = Upload(spark, sf_dir)
    store = _seeded_store(spark, u, "accounting")
    done = upload(spark, store, u.raw, u.ass, clock=CLOCK)
    rows = [(r.dataset, r.given, r.rows_upserted + r.ignored, r.collapsed, r.empty, r.incomplete, r.rejected, r.orphaned) for r in done.results.values()]
    counts = spark.createDataFrame(rows, "dataset string, given bigint, loaded bigint, collapsed bigint, empty bigint, incomplete bigint, rejected bigint, orphaned bigint")
    kept = _union_all([store.rejects(name).groupBy(F.lit(name).alias("dataset")).agg(F.count(F.lit(1)).alias("reject_rows")) for name in SPECS])
    balance = F.col("given") - F.col("loaded") - F.col("collapsed") - F.col("empty") - F.col("incomplete") - F.col("rejected") - F.col("orphaned")
    return counts.join(kept, "dataset", "left").withColumn("reject_rows", F.coalesce("reject_rows", F.lit(0)).cast("bigint")).withColumn("unaccounted", balance)


def q_reject_rows(spark, sf_dir):
    """The rows that weren't loaded, with the reason and their cells."""
    u = Upload(spark, sf_dir)
    store = _seeded_store(spark, u, "rejected")
    upload(spark, store, u.raw, u.ass, clock=CLOCK)
    cell = lambda c: F.get_json_object("given", f"$.{c}")
    return _union_all([
        store.rejects(spec.name).select(F.lit(spec.name).alias("dataset"), "reason", cell("employee_id").alias("employee_id"),
                                        F.concat_ws("|", *(F.coalesce(cell(c), F.lit("-")) for c in spec.key[1:])).alias("item"))
        for spec in SPECS.values()
    ])


def q_dedup_stats(spark, sf_dir):
    """Sheet rows in, rows with content, dropped as duplicates, out: sums over the datasets as they are written."""
    u = Upload(spark, sf_dir)
    parts = []
    for name, phase, sheet in ((JOBS.name, 1, u.p1.roster_resolved), (EDUCATION.name, 1, u.p1.roster_resolved), (ASSESSMENTS.name, 2, u.ass)):
        data = u.dataset(phase, name).agg(F.lit(0).alias("i"), F.sum("_copies").alias("c"), F.count(F.lit(1)).alias("o"))
        parts.append(data.unionByName(sheet.agg(F.count(F.lit(1)).alias("i"), F.lit(0).alias("c"), F.lit(0).alias("o"))).agg(
            F.sum("i").cast("bigint").alias("rows_in"), F.sum("c").cast("bigint").alias("non_empty"),
            (F.sum("c") - F.sum("o")).cast("bigint").alias("dropped"), F.sum("o").cast("bigint").alias("rows_out"),
        ).select(F.lit(name).alias("dataset"), "rows_in", "non_empty", "dropped", "rows_out"))
    return _union_all(parts)


def q_gender_defaults(spark, sf_dir):
    return defaulted_genders(clean_cells(Fixtures(spark, sf_dir).raw_data))


def q_gate_closed(spark, sf_dir):
    u = Upload(spark, sf_dir)
    store = _seeded_store(spark, u, "gate")
    done = upload(spark, store, u.raw.withColumn("nama", F.lit(None).cast("string")), u.ass.withColumn("nama", F.lit(None).cast("string")), clock=CLOCK)
    rows = spark.createDataFrame([(r.dataset, r.status) for r in done.results.values()], "dataset string, status string")
    counts = store.counts().select(F.col("table_name").alias("dataset"), F.col("n").alias("rows_in_table"))
    return rows.join(counts, "dataset")


def _all_tables(state) -> DataFrame:
    """The five tables' rows in one shape."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    return _union_all([
        state.read(spec.name).select(F.lit(spec.name).alias("table_name"), "employee_id",
                                     F.concat_ws("|", *(text(c) for c in _COMPARED[spec.name])).alias("cells"))
        for spec in SPECS.values()
    ])


_COMPARED = {
    EMPLOYEES.name: ("fullname", "birth_date", "gender"),
    JOBS.name: ("subholding_code", "company_code", "jabatan", "tanggal_mulai", "employee_no_subholding", "tanggal_selesai", "status"),
    EDUCATION.name: ("tingkat_pendidikan", "universitas", "jurusan"),
    ASSESSMENTS.name: ("assesment_year", "overal_score"),
    ROADMAP.name: ("year", "planned_position"),
}


def q_final_tables(spark, sf_dir):
    state = Upload(spark, sf_dir).state_after_p2
    text = lambda c: F.col(c).cast("string")
    row = lambda spec, item, value: state.read(spec.name).select(
        F.lit(spec.name).alias("table_name"), "employee_id", item.alias("item"), value.alias("value"))
    return _union_all([
        row(JOBS, F.concat_ws("|", "subholding_code", "company_code", "jabatan", text("tanggal_mulai")),
            F.concat_ws("|", "employee_no_subholding", text("tanggal_selesai"), "status")),
        row(ASSESSMENTS, text("assesment_year"), F.col("overal_score")),
        row(ROADMAP, text("year"), F.col("planned_position")),
    ])


def q_export_datasets(spark, sf_dir):
    from rosterline.sources.export import export_csv, read_back_counts

    u = Upload(spark, sf_dir)
    datasets = {k: _no_ord(v) for k, v in transform_only(spark, u.raw, u.ass).items()}
    paths = export_csv(datasets, scratch_path(spark, "export"))
    return read_back_counts(spark, paths)


def _headed(df: DataFrame, columns) -> DataFrame:
    return df.withColumnsRenamed({i: WORKBOOK_HEADERS.get(i, h) for i, h in columns if i in df.columns})


def q_ingest_files(spark, sf_dir):
    """The sheets as several CSV files with workbook headers, line breaks and quotes in cells, read back as a workbook and
    taken to the tables: the roster as it is conformed, numbered over the files."""
    fx, folder = Fixtures(spark, sf_dir), scratch_path(spark, "workbook")
    broken = fx.raw_data.withColumn("universitas", F.replace("universitas", F.lit("Univ "), F.lit('Univ "of"\n')))
    write_workbook({"RAW  data": _headed(broken, ROSTER_COLUMNS), "assessment": _headed(fx.assesment, ASSESSMENT_COLUMNS)}, folder)
    sheets = read_workbook(spark, folder)
    return conform_headers(sheets["raw_data"], ROSTER_COLUMNS, "roster")


def q_upload_files(spark, sf_dir):
    """From files to tables: counts after an upload of a workbook."""
    u = Upload(spark, sf_dir)
    folder = scratch_path(spark, "workbook")
    write_workbook({"Raw Data": _headed(u.raw, ROSTER_COLUMNS), "Assesment": _headed(u.ass, ASSESSMENT_COLUMNS)}, folder)
    store, sheets = _seeded_store(spark, u, "files"), read_workbook(spark, folder)
    upload_sheets(spark, store, sheets["raw_data"], sheets["assesment"], DEFAULT_SALT, clock=CLOCK)
    return store.counts()


def q_stream_upsert(spark, sf_dir):
    from rosterline.streaming.drop_folder import run_drop_folder

    u = Upload(spark, sf_dir)
    store, _ = run_drop_folder(spark, u, scratch_path(spark, "stream"), CLOCK)
    return _rows(store, EMPLOYEES)


def q_stream_change_feed(spark, sf_dir):
    from rosterline.streaming.drop_folder import run_drop_folder, read_change_feed

    u = Upload(spark, sf_dir)
    _, root = run_drop_folder(spark, u, scratch_path(spark, "stream"), CLOCK)
    return read_change_feed(spark, root).select("entity_type", "entity_id", "action_type")


EDUCATION_CELLS = ("tingkat_pendidikan", "universitas", "jurusan")


def _second_roster(u: Upload) -> DataFrame:
    """Other people: the roster's rows under other numbers and names."""
    return u.raw.withColumns({"nik": F.concat(F.lit("B"), "nik"), "nama": F.concat("nama", F.lit(" Second"))})


def q_feed_after_failure(spark, sf_dir):
    """Upload a fails after its employees are committed (no education columns), b succeeds, a gets its whole roster: the
    feed, followed after every step, by upload."""
    from rosterline.streaming.drop_folder import drop_upload, read_change_feed, start_stream

    u = Upload(spark, sf_dir)
    root = scratch_path(spark, "feed")
    store = SnapshotStore(spark, f"{root}/state")
    store.seed({EMPLOYEES.name: u.fx.db_employees, JOBS.name: u.fx.db_jobs, EDUCATION.name: u.fx.db_education})
    none = u.ass.limit(0)
    for upload_id, roster, piece in (("a", u.raw.drop(*EDUCATION_CELLS), "1"), ("b", _second_roster(u), "1"), ("a", u.raw, "2")):
        drop_upload(roster, none, root, upload_id, piece)
        start_stream(spark, store, root, clock=CLOCK)
        feed = read_change_feed(spark, root)
    return feed.groupBy("upload_id", "entity_type", "action_type").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.countDistinct("entity_id").cast("bigint").alias("entities"))


def q_stream_with_bad_upload(spark, sf_dir):
    """A good upload between one without a name column and one whose files are no text at all: the good one's tables."""
    from rosterline.streaming.drop_folder import drop_upload, quarantine, start_stream

    u = Upload(spark, sf_dir)
    root = scratch_path(spark, "bad")
    store = SnapshotStore(spark, f"{root}/state")
    store.seed({EMPLOYEES.name: u.fx.db_employees, JOBS.name: u.fx.db_jobs, EDUCATION.name: u.fx.db_education})
    drop_upload(u.raw.drop("nama"), u.ass, root, "bad1")
    drop_upload(u.raw, u.ass, root, DEFAULT_SALT)
    u.ass.write.parquet(f"{root}/drop/zz-bad2/Raw Data/1")
    start_stream(spark, store, root, clock=CLOCK)
    bad = quarantine(store).agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(F.lit("quarantine").alias("table_name"), "n")
    return store.counts().unionByName(bad)


QUERIES: dict[str, Query] = {
    "ingest_clean": q_ingest_clean,
    "header_match": q_header_match,
    "blank_default": q_blank_default,
    "gender_normalize": q_gender_normalize,
    "target_projection": q_target_projection,
    "key_complete": q_key_complete,
    "date_coerce": q_date_coerce,
    "pattern_filter": q_pattern_filter,
    "golden_record": q_golden_record,
    "employees_from_roster": q_employees_from_roster,
    "education_history": q_education_history,
    "job_history": q_job_history,
    "duplicate_rows": q_duplicate_rows,
    "duplicate_names": q_duplicate_names,
    "next_counter": q_next_counter,
    "existing_key_lookup": q_existing_key_lookup,
    "state_lookup": q_state_lookup,
    "missing_names": q_missing_names,
    "fill_missing_key": q_fill_missing_key,
    "entity_resolve": q_entity_resolve,
    "match_stats": q_match_stats,
    "new_employees": q_new_employees,
    "job_history_supplement": q_job_history_supplement,
    "assessment_history": q_assessment_history,
    "career_roadmap": q_career_roadmap,
    "merge_phases": q_merge_phases,
    "upsert_state": q_upsert_state,
    "insert_ignore": q_insert_ignore,
    "append_rows": q_append_rows,
    "default_fill": q_default_fill,
    "upsert_stats": q_upsert_stats,
    "reload_noop": q_reload_noop,
    "two_uploads": q_two_uploads,
    "cascade_delete": q_cascade_delete,
    "fk_filter": q_fk_filter,
    "incomplete_entities": q_incomplete_entities,
    "table_counts": q_table_counts,
    "check_unique": q_check_unique,
    "check_fk": q_check_fk,
    "check_domain": q_check_domain,
    "check_not_null": q_check_not_null,
    "change_log": q_change_log,
    "recycle_restore": q_recycle_restore,
    "load_report": q_load_report,
    "pipeline_counts": q_pipeline_counts,
    "load_rejects": q_load_rejects,
    "load_accounting": q_load_accounting,
    "reject_rows": q_reject_rows,
    "dedup_stats": q_dedup_stats,
    "gender_defaults": q_gender_defaults,
    "ingest_files": q_ingest_files,
    "upload_files": q_upload_files,
    "feed_after_failure": q_feed_after_failure,
    "stream_with_bad_upload": q_stream_with_bad_upload,
    "gate_closed": q_gate_closed,
    "final_tables": q_final_tables,
    "export_datasets": q_export_datasets,
    "stream_upsert": q_stream_upsert,
    "stream_change_feed": q_stream_change_feed,
}
