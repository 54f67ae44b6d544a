"""The five output datasets built from resolved sheets.

Every dataset keeps ``_ord``: the sheet position its row stands for, so a later last-wins reduction (several rows with
one target key) can pick the row the reference would have written last.  Deduplicated ones keep ``_copies``: the rows a
row stands for, so that dedup statistics are sums over what is written anyway.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.functions.dates import to_number, year_start
from rosterline.functions.text import strip_ws
from rosterline.operators.cleaning import drop_all_null, fill_blank
from rosterline.operators.dedup import distinct_with_order, first_non_null, keep_first
from rosterline.session import merged
from rosterline.specs import JOB_STATUS, JOB_STATUS_ENDED, JOB_TITLE_DEFAULT, ROADMAP_COLUMN_RE

EMPLOYEE_COLUMNS = ["tahun", "employee_id", "nik", "nama", "tanggal_lahir", "agama", "jenis_kelamin", "subholding",
                    "subco", "job_title", "function"]
EDUCATION_COLUMNS = ["employee_id", "tingkat_pendidikan", "universitas", "jurusan", "tanggal_masuk_pendidikan",
                     "tanggal_keluar_pendidikan", "tanggal_selesai_pendidikan"]
EDUCATION_REQUIRED = ["tingkat_pendidikan", "universitas", "jurusan"]
JOB_COLUMNS = ["employee_id", "nama", "nik", "subholding", "subco", "divisi", "department", "level", "job_title",
               "function", "gol", "kj", "tanggal_masuk_kerja", "tanggal_resign"]
JOB_DEDUP_SUBSET = ["employee_id", "subholding", "subco", "job_title", "tanggal_masuk_kerja"]
NEW_EMPLOYEE_COLUMNS = ["employee_id", "nik", "nama", "sub_holding", "sub_company"]
JOB_SUPPLEMENT_COLUMNS = ["employee_id", "nama", "nik", "sub_holding", "sub_company", "job_title", "asessment_year"]
ASSESSMENT_COLUMNS = ["employee_id", "nama", "nik", "asessment_year", "remarks", "age", "int_int", "exc_int",
                      "comp_int", "hum_int", "adm_int", "plc_int", "mch_int", "ftw_int", "emp_int", "people",
                      "organization", "business", "persistent", "perseverance", "passion", "grit", "value_driven",
                      "leadership_comp", "business_comp", "technical_comp", "overall_skor", "talent_class", "strength",
                      "area_of_development", "idp", "iq", "disc", "hav", "hav_tia"]
ASSESSMENT_HELPERS = ["nama", "nik"]
CROSS_SHEET_RENAMES = {"sub_holding": "subholding", "sub_company": "subco"}


def _present(df: DataFrame, wanted: list[str]) -> list[str]:
    return [c for c in wanted if c in df.columns]


def golden_record(df: DataFrame, key: str, columns: list[str], year_col: str | None = "tahun") -> DataFrame:
    """One row per ``key``: each column's first non-null value, latest year first (unparseable years last), then
    sheet order."""
    if year_col and year_col in df.columns:
        y = to_number(year_col)
        base = df.withColumn("_y", y)
        order = [F.col("_y").isNull(), -F.col("_y"), F.col("row_id")]
    else:
        base = df
        order = [F.col("row_id")]
    cols = [c for c in columns if c not in (key, year_col)]
    return first_non_null(base, [key], order, cols)


def employees_from_roster(resolved: DataFrame) -> DataFrame:
    """Phase 1 employees: the roster's golden record per employee."""
    cols = _present(resolved, EMPLOYEE_COLUMNS)
    df = fill_blank(resolved.select(*cols, "row_id"), "job_title", JOB_TITLE_DEFAULT)
    return golden_record(df, "employee_id", cols).withColumn("_ord", F.lit(0).cast("bigint"))


def education_history(resolved: DataFrame) -> DataFrame:
    """Education rows: drop rows empty in all of level/university/major, then distinct rows."""
    cols = _present(resolved, EDUCATION_COLUMNS)
    missing = [c for c in EDUCATION_REQUIRED if c not in cols]
    if missing:
        raise ValueError(f"education columns missing from the roster: {missing}")
    df = resolved.select(*cols, "row_id")
    if "tanggal_selesai_pendidikan" in cols and "tanggal_keluar_pendidikan" not in cols:
        df = df.withColumnRenamed("tanggal_selesai_pendidikan", "tanggal_keluar_pendidikan")
        cols = [("tanggal_keluar_pendidikan" if c == "tanggal_selesai_pendidikan" else c) for c in cols]
    df = drop_all_null(df, EDUCATION_REQUIRED)
    return distinct_with_order(df, cols, "row_id", "_ord")


def _finalize_jobs(df: DataFrame, status_from_end_date: bool = False) -> DataFrame:
    df = fill_blank(df, "job_title", JOB_TITLE_DEFAULT)
    kept = keep_first(df, _present(df, JOB_DEDUP_SUBSET), "row_id", copies_as="_copies")
    if "nama" in kept.columns:
        kept = kept.drop("nama")
    status = F.lit(JOB_STATUS)
    if status_from_end_date and "tanggal_resign" in kept.columns:
        # The guide's intent: a row with a resign/transfer date is no longer active.
        status = F.when(F.col("tanggal_resign").isNotNull(), F.lit(JOB_STATUS_ENDED)).otherwise(status)
    return kept.withColumn("status", status).withColumnRenamed("row_id", "_ord")


def job_history(resolved: DataFrame, status_from_end_date: bool = False) -> DataFrame:
    """Phase 1 jobs: one row per (employee, placement, title, start), the first in sheet order.

    Status is ``active`` on every row (as the reference code does); ``status_from_end_date`` marks rows with an end
    date ``inactive`` instead (as its test guide expects).
    """
    return _finalize_jobs(resolved.select(*_present(resolved, JOB_COLUMNS), "row_id"), status_from_end_date)


def _renamed(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    for a, b in renames.items():
        if a in df.columns:
            df = df.withColumnRenamed(a, b)
    return df


def new_employees(resolved_ass: DataFrame, state_employees: DataFrame) -> DataFrame:
    """Phase 2 employees: assessment people not in the state, first non-null value per column in sheet order."""
    cols = _present(resolved_ass, NEW_EMPLOYEE_COLUMNS)
    df = _renamed(resolved_ass.select(*cols, "row_id"), CROSS_SHEET_RENAMES)
    df = df.join(merged(state_employees.select("employee_id")), "employee_id", "left_anti")
    out_cols = [c for c in df.columns if c not in ("employee_id", "row_id")]
    return first_non_null(df, ["employee_id"], [F.col("row_id")], out_cols).withColumn("_ord", F.lit(0).cast("bigint"))


def job_history_supplement(resolved_ass: DataFrame, state_jobs: DataFrame) -> DataFrame:
    """Phase 2 jobs for people without any job row in the state; the assessment year becomes the start date."""
    df = resolved_ass.join(merged(state_jobs.select("employee_id")), "employee_id", "left_anti")
    df = _renamed(df.select(*_present(df, JOB_SUPPLEMENT_COLUMNS), "row_id"),
                  {**CROSS_SHEET_RENAMES, "asessment_year": "tanggal_masuk_kerja"})
    if "tanggal_masuk_kerja" in df.columns:
        df = df.withColumn("tanggal_masuk_kerja", year_start("tanggal_masuk_kerja"))
    return _finalize_jobs(df)


def assessment_history(resolved_ass: DataFrame) -> DataFrame:
    """Assessment rows: distinct over the score columns together with name and number, which are then dropped."""
    cols = _present(resolved_ass, ASSESSMENT_COLUMNS)
    out = distinct_with_order(resolved_ass.select(*cols, "row_id"), cols, "row_id", "_ord")
    return out.drop(*[c for c in ASSESSMENT_HELPERS if c in cols])


def roadmap_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if ROADMAP_COLUMN_RE.match(c)]


def career_roadmap(resolved_ass: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Wide → long: one row per (employee, planned position, year) from the ``road_map_<year>`` columns."""
    cols = columns or roadmap_columns(resolved_ass)
    if not cols:
        spark = resolved_ass.sparkSession
        return spark.createDataFrame([], "employee_id string, planned_position string, year int, _ord struct<c:int,row_id:bigint>")
    long = resolved_ass.select("employee_id", "row_id", *cols).unpivot(
        ["employee_id", "row_id"], cols, "_col", "planned_position"
    )
    pos = F.col("planned_position")
    long = long.where(pos.isNotNull() & (strip_ws(pos) != ""))
    long = long.withColumn("year", F.regexp_extract("_col", r"(\d{4})", 1).cast("int"))
    col_index = F.array_position(F.array(*[F.lit(c) for c in cols]), F.col("_col")).cast("int")
    return long.groupBy("employee_id", "planned_position", "year").agg(
        F.min(F.struct(col_index.alias("c"), F.col("row_id"))).alias("_ord")
    )
