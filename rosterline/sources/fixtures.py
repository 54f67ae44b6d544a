"""Derived input sheets and state tables over the generated TPC-H-style tables.

Each fixture is one SQL text in the subset both Spark and DuckDB accept.  Table references are written as
``{orders}``-style placeholders: Spark binds them to DataFrames (``spark.sql(text, orders=df)``), the DuckDB oracle
renders them as plain view names.  So both engines run literally the same fixture text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rosterline.session import merged
from rosterline.specs import ROADMAP_YEARS

SOURCE_TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")

def _emp(key: str) -> str:
    """Employee number of a customer: at least six digits, longer keys as they are."""
    k = f"CAST({key} AS STRING)"
    return f"'EMP' || CASE WHEN length({k}) < 6 THEN lpad({k}, 6, '0') ELSE {k} END"


# Names: null, one word, or two; some known employees share a name, and some orders have another name, which customers share.
_NAME = "c_mktsegment || ' ' || c_name"
_NAMESAKES = "WHEN c_custkey % 40 = 16 THEN 'Namesake Person ' || CAST(c_custkey % 3 AS STRING)"

RAW_DATA = f"""
SELECT o.o_orderkey AS row_id,
  CASE WHEN o.o_orderkey % 41 = 0 THEN 'n/a' ELSE CAST(year(o.o_orderdate) AS STRING) END AS tahun,
  CASE WHEN c.c_custkey % 11 = 0 THEN NULL WHEN c.c_custkey % 11 = 1 THEN '  '
       ELSE {_emp('c.c_custkey')} END AS nik,
  CASE WHEN c.c_custkey % 97 = 5 THEN NULL
       WHEN c.c_custkey % 13 = 0 THEN c.c_name
       {_NAMESAKES}
       WHEN c.c_custkey % 43 = 2 AND c.c_custkey % 11 > 1 AND o.o_orderkey % 7 = 0 THEN 'Alias Group ' || CAST(c.c_custkey % 4 AS STRING)
       ELSE {_NAME} END AS nama,
  CASE c.c_custkey % 10 WHEN 0 THEN 'LAKI-LAKI' WHEN 1 THEN 'perempuan' WHEN 2 THEN ' L ' WHEN 3 THEN 'P'
       WHEN 4 THEN 'm' WHEN 5 THEN 'F' WHEN 6 THEN 'WANITA' WHEN 7 THEN '' WHEN 8 THEN NULL ELSE 'Female' END AS jenis_kelamin,
  CASE WHEN o.o_orderkey % 3 = 0 THEN NULL
       WHEN o.o_orderkey % 3 = 1 THEN '17/05/' || CAST(70 + c.c_custkey % 30 AS STRING)
       ELSE '19' || CAST(70 + c.c_custkey % 30 AS STRING) || '-05-17' END AS tanggal_lahir,
  r.r_name AS subholding, n.n_name AS subco,
  CASE WHEN o.o_orderkey % 29 = 0 THEN '   ' WHEN o.o_orderkey % 29 = 1 THEN NULL
       ELSE substr(o.o_orderpriority, 3) END AS job_title,
  CASE WHEN o.o_orderkey % 37 = 0 THEN NULL ELSE substr(CAST(o.o_orderdate AS STRING), 1, 4) || '-01-01' END AS tanggal_masuk_kerja,
  CASE WHEN o.o_orderstatus = 'F' THEN substr(CAST(o.o_orderdate AS STRING), 1, 4) || '-12-31'
       WHEN o.o_orderkey % 23 = 0 THEN '31/12/30' WHEN o.o_orderkey % 23 = 1 THEN '30/06/2031' END AS tanggal_resign,
  CASE WHEN c.c_custkey % 9 = 0 THEN NULL ELSE 'S' || CAST(1 + c.c_custkey % 3 AS STRING) END AS tingkat_pendidikan,
  CASE WHEN c.c_custkey % 9 = 0 THEN NULL ELSE 'Univ ' || n.n_name END AS universitas,
  CASE WHEN c.c_custkey % 9 = 0 THEN NULL WHEN c.c_custkey % 9 = 4 THEN NULL ELSE c.c_mktsegment END AS jurusan
FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey
JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey JOIN {{region}} r ON n.n_regionkey = r.r_regionkey
"""


def _roadmap_cells(key: str) -> str:
    # One CASE per roadmap year: a position, a blank cell or null, rotating with the key.
    return ",\n  ".join(
        f"CASE WHEN ({key} + {y}) % 5 = 0 THEN 'Role ' || CAST(({key} + {y}) % 7 AS STRING) "
        f"WHEN ({key} + {y}) % 5 = 1 THEN ' ' END AS road_map_{y}"
        for y in ROADMAP_YEARS
    )


_LATER_YEARS = ", ".join(f"road_map_{y}" for y in ROADMAP_YEARS[1:])

ASSESMENT = f"""
WITH base AS (SELECT c_custkey,
  CASE WHEN c_custkey % 11 <= 1 THEN NULL ELSE {_emp('c_custkey')} END AS nik,
  CASE WHEN c_custkey % 13 = 0 THEN c_name {_NAMESAKES} ELSE {_NAME} END AS nama,
  'SH' || CAST(c_custkey % 5 AS STRING) AS sub_holding, 'CO' || CAST(c_custkey % 7 AS STRING) AS sub_company,
  CASE WHEN c_custkey % 19 = 0 THEN ' ' ELSE 'Analyst' END AS job_title,
  CASE WHEN c_custkey % 51 = 0 THEN 'FY ' ELSE '' END || CAST(2021 + c_custkey % 4 AS STRING) AS asessment_year,
  CAST(c_custkey % 100 AS STRING) AS overall_skor,
  {_roadmap_cells('c_custkey')}
FROM {{customer}} WHERE c_custkey % 3 = 0) SELECT 3 * c_custkey AS row_id, nik, nama, sub_holding, sub_company, job_title, asessment_year, overall_skor, road_map_2023, {_LATER_YEARS}
FROM base
UNION ALL
SELECT 3 * c_custkey + 1, nik, nama, sub_holding, sub_company, job_title, asessment_year,
  CASE WHEN c_custkey % 30 = 15 THEN 'retest' ELSE overall_skor END,
  CASE WHEN c_custkey % 30 = 15 THEN 'Role X' ELSE road_map_2023 END, {_LATER_YEARS}
FROM base WHERE c_custkey % 15 = 0
UNION ALL
SELECT 3 * s_suppkey + 2,
  CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'SUP' || CAST(s_suppkey AS STRING) END, 'Vendor ' || s_name,
  'SH' || CAST(s_suppkey % 5 AS STRING), 'CO' || CAST(s_suppkey % 7 AS STRING), CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'Supplier' END,
  CAST(2021 + s_suppkey % 4 AS STRING), CAST(s_suppkey % 100 AS STRING),
  {_roadmap_cells('s_suppkey')}
FROM {{supplier}}
"""


def _seed_uuid(key: str) -> str:
    h = f"md5('seed:' || CAST({key} AS STRING))"
    return (
        f"substr({h},1,8) || '-' || substr({h},9,4) || '-3' || substr({h},14,3) || '-8' || substr({h},18,3) "
        f"|| '-' || substr({h},21,12)"
    )


DB_EMPLOYEES = f"""
SELECT {_seed_uuid('c_custkey')} AS employee_id, CASE {_NAMESAKES} ELSE {_NAME} END AS fullname
FROM {{customer}} WHERE c_custkey % 4 = 0
"""

DB_JOBS = f"""
SELECT {_seed_uuid('c_custkey')} AS employee_id,
  CASE WHEN c_custkey % 24 = 0 THEN 'unk-' || CAST(5001 + c_custkey AS STRING) ELSE {_emp('c_custkey')} END AS employee_no_subholding
FROM {{customer}} WHERE c_custkey % 8 = 0
"""

# Prior education rows of the existing employees, built the same way as the roster's education cells, so a re-sent row
# collides with the key already in the state.
DB_EDUCATION = f"""
SELECT {_seed_uuid('c.c_custkey')} AS employee_id,
  'S' || CAST(1 + c.c_custkey % 3 AS STRING) AS tingkat_pendidikan,
  'Univ ' || n.n_name AS universitas,
  c.c_mktsegment AS jurusan
FROM {{customer}} c JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey WHERE c.c_custkey % 4 = 0
"""

FIXTURES: dict[str, str] = {
    "raw_data": RAW_DATA,
    "assesment": ASSESMENT,
    "db_employees": DB_EMPLOYEES,
    "db_jobs": DB_JOBS,
    "db_education": DB_EDUCATION,
}


def duckdb_fixture(name: str) -> str:
    """The fixture text with placeholders rendered as the oracle's view names."""
    return FIXTURES[name].format(**{t: t for t in SOURCE_TABLES})


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Fixtures:
    """Lazily built fixture DataFrames for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        key = f"table:{name}"
        if key not in self._cache:
            self._cache[key] = read_table(self.spark, self.sf_dir, name)
        return self._cache[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in FIXTURES:
            raise AttributeError(name)
        if name not in self._cache:
            text = FIXTURES[name]
            # orders meet customers by sorting, whatever the size of their files; nations and regions are few
            refs = {t: merged(self.table(t)) if t == "orders" else self.table(t) for t in SOURCE_TABLES if "{" + t + "}" in text}
            self._cache[name] = self.spark.sql(text, **refs)
        return self._cache[name]
