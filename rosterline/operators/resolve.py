"""Entity resolution: the people of an upload, and which known employees they are.

Sheets are wide, their distinct pairs of number and name are not, so all lookups work on the pairs, and a sheet is joined
with the outcome once.

1. ``cell_pairs``     distinct (number, name) cells of all sheets, each with the place where it is first seen.
2. ``fill_pairs``     a name without a number gets one (``operators.keys``); a number without a name in the roster takes
                      the name that the assessment has for it.
3. ``identify``       a number of the state → its employee; else a name of at least two words that the state knows → that
                      employee; else a new id.  What one upload ties by number or by name is one person: rows that share
                      an unknown number, or an unknown name, get one id before any id is made.
4. ``attach``         ids, filled numbers and names → the sheet's rows; a row with neither number nor name is a person of its own.

Rows and pairs that cannot match join on a value of their own instead of null, so that they spread over all partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.functions.ids import row_suffix, uuid_from_text
from rosterline.functions.text import is_missing, strip_cell, strip_ws, token_count
from rosterline.operators.components import components
from rosterline.operators.keys import ROSTER, assign_keys, key_candidates, missing_names, preferred_key
from rosterline.session import cut, hashed, merged
from rosterline.specs import UNK_PREFIX

_NO_MATCH = "\u0000"  # prefix of surrogate join keys; cleaned names and keys never start with it


def state_lookup(employees: DataFrame, jobs: DataFrame) -> DataFrame:
    """``SELECT DISTINCT e.employee_id, e.fullname, j.employee_no_subholding FROM employees e LEFT JOIN jobs j``."""
    return (
        employees.select("employee_id", "fullname")
        .join(merged(jobs.select("employee_id", "employee_no_subholding")), "employee_id", "left")
        .distinct()
    )


def key_map(employees: DataFrame, jobs: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """``(_k, _eid)``: stripped employee number → employee (smallest id when a number is shared).

    With ``wanted`` (a ``_k`` column) only those numbers are looked up: an upload is usually far smaller than the
    state, so the semi join runs first and only matching state rows reach the aggregation.
    """
    k = F.col("employee_no_subholding")
    j = jobs.where(k.isNotNull() & (k != "") & F.col("employee_id").isNotNull()).select("employee_id", strip_ws(k).alias("_k"))
    if wanted is not None:
        j = j.join(merged(wanted), "_k", "left_semi")
    j = j.join(merged(employees.select("employee_id")), "employee_id", "left_semi")
    return j.groupBy("_k").agg(F.min("employee_id").alias("_eid"))


def name_map(employees: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """``(_n, _eid)``: lower-cased stripped full name → employee (smallest id when a name is shared).

    With ``wanted`` (a ``_n`` column) only those names are looked up.
    """
    n = F.col("fullname")
    e = employees.where(n.isNotNull() & (n != "") & F.col("employee_id").isNotNull())
    e = e.select("employee_id", F.lower(strip_ws(n)).alias("_n"))
    if wanted is not None:
        e = e.join(merged(wanted), "_n", "left_semi")
    return e.groupBy("_n").agg(F.min("employee_id").alias("_eid"))


def _cells(df: DataFrame, key_col: str, name_col: str) -> tuple[Column, Column]:
    """The row's number and name, stripped; null where blank or where the sheet has no such column."""
    null = F.lit(None).cast("string")
    cell = lambda c: F.when(~is_missing(c), strip_cell(c)) if c in df.columns else null
    return cell(key_col), cell(name_col)


def cell_pairs(sheets: list[tuple[int, DataFrame]], key_col: str = "nik", name_col: str = "nama") -> DataFrame:
    """``_k, _n``: distinct pairs of number and name over all sheets (at least one of them not null), with the first
    (sheet, row_id), the last sheet, and whether a sheet with both columns holds the pair (``_fill``)."""
    parts = []
    for sheet, df in sheets:
        k, n = _cells(df, key_col, name_col)
        both = key_col in df.columns and name_col in df.columns
        parts.append(df.select(k.alias("_k"), n.alias("_n"), F.lit(sheet).alias("sheet"), "row_id", F.lit(both).alias("_fill")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = rows.where(F.col("_k").isNotNull() | F.col("_n").isNotNull())
    # the first (sheet, row_id), a null row_id before others, from numbers alone: a minimum of structs would sort all rows
    aggs, first = [F.max("sheet").alias("_last"), F.max("_fill").alias("_fill")], None
    for s in sorted({sheet for sheet, _ in sheets}):
        here = F.col("sheet") == s
        aggs += [F.min(F.when(here, F.col("row_id"))).alias(f"_m{s}"), F.count_if(here).alias(f"_c{s}"), F.count_if(here & F.col("row_id").isNull()).alias(f"_z{s}")]
        place = F.struct(F.lit(s).alias("sheet"), F.when(F.col(f"_z{s}") == 0, F.col(f"_m{s}")).alias("row_id"))
        first = F.when(F.col(f"_c{s}") > 0, place) if first is None else first.when(F.col(f"_c{s}") > 0, place)
    return rows.groupBy("_k", "_n").agg(*aggs).select("_k", "_n", first.alias("_first"), "_last", "_fill")


def fill_pairs(pairs: DataFrame, employees: DataFrame, jobs: DataFrame, start_counter: int, prefix: str = UNK_PREFIX) -> DataFrame:
    """``pairs`` with ``nik`` and ``nama``: a name without a number takes the state's number for it or one that the upload
    has for it (real ones first), else a generated one; a nameless number that only the assessment names takes that name."""
    names = cut(missing_names(pairs).withColumn("name_key", F.lower("nama")))
    given = pairs.where(F.col("_k").isNotNull()).select(F.lower("_n").alias("name_key"), "_k").join(merged(names.select("name_key").distinct()), "name_key", "left_semi")
    known = preferred_key(key_candidates(names, employees, jobs).unionByName(given), prefix)
    keys = assign_keys(names, known, start_counter, prefix).select(F.col("nama").alias("_nm"), "key")
    out = pairs.withColumn("_j", F.when(F.col("_k").isNull() & F.col("_fill"), F.col("_n")).otherwise(F.concat(F.lit(_NO_MATCH), F.coalesce("_k", "_n"))))
    out = out.join(merged(keys), F.col("_j") == F.col("_nm"), "left").withColumn("nik", F.coalesce("_k", "key")).drop("_j", "_nm", "key")

    nameless = pairs.where(F.col("_n").isNull()).select("_k").distinct()
    named = pairs.where(F.col("_n").isNotNull() & F.col("_k").isNotNull()).join(merged(nameless), "_k", "left_semi")
    other = named.groupBy(F.col("_k").alias("_nk")).agg(F.min_by("_n", "_first").alias("_name"), F.min("_first.sheet").alias("_s"))
    other = other.where(F.col("_s") > ROSTER).select("_nk", "_name")
    out = out.withColumn("_j", F.when(F.col("_n").isNull(), F.col("_k")).otherwise(F.concat(F.lit(_NO_MATCH), "_n")))
    return out.join(merged(other), F.col("_j") == F.col("_nk"), "left").withColumn("nama", F.coalesce("_n", "_name")).drop("_j", "_nk", "_name")


def _looked_up(pairs: DataFrame, employees: DataFrame, jobs: DataFrame, restrict: bool = False) -> DataFrame:
    """``pairs`` with ``_ek`` (the state's employee by number) and ``_en`` (by a name of two words or more)."""
    wanted_k = wanted_n = None
    name = F.when(token_count("nama") >= 2, F.lower("nama"))
    if restrict:
        wanted_k = pairs.where(F.col("nik").isNotNull()).select(F.col("nik").alias("_k")).distinct()
        wanted_n = pairs.select(name.alias("_n")).where(F.col("_n").isNotNull()).distinct()
    km = key_map(employees, jobs, wanted_k).select(F.col("_k").alias("_mk"), F.col("_eid").alias("_ek"))
    nm = name_map(employees, wanted_n).select(F.col("_n").alias("_mn"), F.col("_eid").alias("_en"))
    out = pairs.withColumn("_j", F.coalesce("nik", F.concat(F.lit(_NO_MATCH), "nama")))
    out = out.join(merged(km), F.col("_j") == F.col("_mk"), "left")
    out = out.withColumn("_j", F.coalesce(name, F.concat(F.lit(_NO_MATCH), F.coalesce("nik", "nama"))))
    return out.join(merged(nm), F.col("_j") == F.col("_mn"), "left").drop("_j", "_mk", "_mn")


def identify(pairs: DataFrame, employees: DataFrame, jobs: DataFrame, salt: str, tie_names: bool = True, restrict: bool = False) -> DataFrame:
    """``pairs`` (with ``nik`` and ``nama``) with ``employee_id`` and ``match_kind`` (``key`` / ``name`` / ``new``).

    Unknown numbers that share an unknown name, and unknown names that share an unknown number, form one person.  If the
    state knows one of its names, or another row of the upload gives one of its names (of two words or more) to a known
    number, the person is that employee (the smallest id of several); else a new one, whose id derives from the smallest
    of its names, or from its number if it has none.  ``tie_names=False`` keeps numbers apart that share a new name.
    """
    pairs = cut(_looked_up(pairs, employees, jobs, restrict))
    several = token_count("nama") >= 2
    node = F.when(F.col("_en").isNull(), F.when(several, F.lower("nama")).otherwise(F.col("nama")))
    pairs = pairs.withColumn("_node", node).withColumn("_number", F.coalesce("nik", F.concat(F.lit(_NO_MATCH), "nama")))
    unknown = pairs.where(F.col("_ek").isNull())
    numbers = unknown.groupBy("_number").agg(F.min("_node").alias("_person"), F.max("_node").alias("_top"), F.min("_en").alias("_label"))
    if tie_names:
        numbers = cut(numbers)
        many = numbers.where(F.col("_person") != F.col("_top")).select("_number", "_person")
        links = unknown.select("_number", "_node").distinct().join(merged(many), "_number").select(F.col("_person").alias("u"), F.col("_node").alias("v"))
        numbers = numbers.drop("_top")
        beside = pairs.where(F.col("_ek").isNotNull() & several & F.col("_node").isNotNull()).select(F.col("_node").alias("_person"), F.col("_ek").alias("_label"))
        if not many.isEmpty():
            joined = components(links)
            one = lambda df: df.join(merged(joined), F.col("_person") == F.col("node"), "left").withColumn("_person", F.coalesce("component", "_person")).drop("node", "component")
            numbers, beside = one(numbers), one(beside)
        labels = numbers.select("_person", "_label").unionByName(beside).where("_person is not null and _label is not null")
        labels = labels.groupBy(F.col("_person").alias("_p")).agg(F.min("_label").alias("_shared"))
        place = F.coalesce("_person", F.concat(F.lit(_NO_MATCH), "_number"))
        numbers = numbers.join(merged(labels), place == F.col("_p"), "left").withColumn("_label", F.coalesce("_shared", "_label")).drop("_p", "_shared")
        basis = F.concat_ws("|", F.lit(salt), F.lit("name"), "_person")
    else:
        numbers = numbers.drop("_top")
        basis = F.concat_ws("|", F.lit(salt), F.lit("name"), "_person", F.lit("nik"), "_number")
    new = F.when(F.col("_person").isNotNull(), uuid_from_text(basis)).otherwise(uuid_from_text(F.concat_ws("|", F.lit(salt), F.lit("key"), "_number")))
    ids = numbers.select(F.col("_number").alias("_num"), "_label", new.alias("_new"))
    out = pairs.withColumn("_j", F.when(F.col("_ek").isNull(), F.col("_number")).otherwise(F.concat(F.lit(_NO_MATCH), F.lit("="), "_number")))
    out = out.join(merged(ids), F.col("_j") == F.col("_num"), "left")
    return out.select(
        *(c for c in pairs.columns if c not in ("_ek", "_en", "_node", "_number")), F.coalesce("_ek", "_label", "_new").alias("employee_id"),
        F.when(F.col("_ek").isNotNull(), F.lit("key")).when(F.col("_label").isNotNull(), F.lit("name")).otherwise(F.lit("new")).alias("match_kind"),
    )


def refresh(identities: DataFrame, employees: DataFrame, jobs: DataFrame) -> DataFrame:
    """``identities`` against a later state: its employee by number, by name, else the id given before."""
    out = _looked_up(identities, employees, jobs)
    kind = F.when(F.col("_ek").isNotNull(), F.lit("key")).when(F.col("_en").isNotNull(), F.lit("name")).otherwise(F.lit("new"))
    out = out.withColumn("match_kind", kind).withColumn("employee_id", F.coalesce("_ek", "_en", "employee_id"))
    return out.drop("_ek", "_en")


def attach(df: DataFrame, identities: DataFrame, sheet: int, salt: str, key_col: str = "nik", name_col: str = "nama", prefix: str = UNK_PREFIX) -> DataFrame:
    """The sheet with filled number and name, ``employee_id`` and ``match_kind``: one join on the pair of cells.

    A row with neither gets the number ``unk-x`` + 32 hex digits of its place, and an id of its own.
    """
    k, n = _cells(df, key_col, name_col)
    place = lambda *first: F.concat_ws("|", F.lit(salt), *map(F.lit, first), F.lit(str(sheet)), F.col("row_id").cast("string"))
    none = F.lit(_NO_MATCH)
    right = identities.select(F.coalesce("_k", none).alias("_rk"), F.coalesce("_n", none).alias("_rn"), F.col("nik").alias("_nik"),
                              F.col("nama").alias("_nama"), F.col("employee_id").alias("_eid"), F.col("match_kind").alias("_kind"))
    out = df.withColumn("_lk", k).withColumn("_ln", n)
    alone = F.col("_lk").isNull() & F.col("_ln").isNull()
    out = out.withColumn("_lk", F.when(alone, F.concat(none, F.col("row_id").cast("string"))).otherwise(F.coalesce("_lk", none))).withColumn("_ln", F.coalesce("_ln", none))
    out = out.join(hashed(right), (F.col("_lk") == F.col("_rk")) & (F.col("_ln") == F.col("_rn")), "left")
    if key_col in df.columns:
        suffix = F.concat(F.lit(prefix), row_suffix(place())) if name_col in df.columns else F.lit(None).cast("string")
        out = out.withColumn(key_col, F.coalesce("_nik", F.when(F.col("_eid").isNull(), suffix)))
    if name_col in df.columns:
        out = out.withColumn(name_col, F.col("_nama"))
    own = uuid_from_text(place("row"))
    return out.select(*df.columns, F.coalesce("_eid", own).alias("employee_id"), F.coalesce("_kind", F.lit("new")).alias("match_kind"))


def resolve(df: DataFrame, employees: DataFrame, jobs: DataFrame, salt: str, sheet: int,
            key_col: str = "nik", name_col: str = "nama", fallback_key: tuple[str, ...] = ("name",),
            restrict_to_sheet: bool = False) -> DataFrame:
    """One sheet by itself with ``employee_id`` and ``match_kind``; numbers are taken as they are.

    ``fallback_key=("name", "nik")`` keeps unmatched people apart who share a name and have numbers of their own.
    ``restrict_to_sheet`` first semi-joins the state with the numbers and names the sheet holds; it pays off when the
    state is far larger than one upload.
    """
    pairs = cell_pairs([(sheet, df)], key_col, name_col).withColumn("nik", F.col("_k")).withColumn("nama", F.col("_n"))
    ids = identify(pairs, employees, jobs, salt, tie_names="nik" not in fallback_key, restrict=restrict_to_sheet)
    return attach(df, ids, sheet, salt, key_col, name_col)


def match_stats(resolved: DataFrame) -> DataFrame:
    """Rows per resolution branch."""
    return resolved.groupBy("match_kind").agg(F.count(F.lit(1)).alias("n"))
