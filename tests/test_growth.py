"""What must not grow with the input: tables broadcast by the driver, folders of a table, work done twice."""

from __future__ import annotations

import pytest
from test_golden_sheets import _conformed

from pyspark.sql import functions as F

from rosterline.functions.text import strip_cell, strip_ws
from rosterline.operators.checks import not_in
from rosterline.operators.cleaning import classify
from rosterline.operators.datasets import new_employees
from rosterline.operators.dedup import duplicate_rows
from rosterline.operators.dense_index import dense_index
from rosterline.operators.keys import ASSESSMENT, ROSTER, key_candidates
from rosterline.operators.resolve import attach, cell_pairs, identify, key_map, name_map
from rosterline.plans import pipeline
from rosterline.session import cut, empty
from rosterline.sources import sheets
from rosterline.sources.fixtures import Fixtures
from rosterline.sources.snapshots import SnapshotStore
from rosterline.specs import EMPLOYEES, JOBS


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_of_growing_tables_are_not_broadcast(spark):
    emp = cut(spark.createDataFrame([("e1", "Ann Lee"), ("e2", "Bo")], "employee_id string, fullname string"))
    jobs = cut(spark.createDataFrame([("e1", "N1")], "employee_id string, employee_no_subholding string"))
    rows = cut(spark.createDataFrame([(1, "N1", "Ann Lee", "e1"), (2, None, "Cy Roe", "e9")], "row_id bigint, nik string, nama string, employee_id string"))
    pairs = cell_pairs([(ROSTER, rows)]).withColumn("nik", F.col("_k")).withColumn("nama", F.col("_n"))
    names = rows.select(F.lower("nama").alias("name_key"))
    given = classify(rows.select("employee_id", F.col("nik").alias("employee_no_subholding")), JOBS, F.current_date(), emp)
    plans = [identify(pairs, emp, jobs, "s"), attach(rows.drop("employee_id"), cut(identify(pairs, emp, jobs, "s")), ROSTER, "s"), given,
             key_map(emp, jobs, rows.select(F.col("nik").alias("_k"))), name_map(emp, names.select(F.col("name_key").alias("_n"))), key_candidates(names, emp, jobs),
             new_employees(rows, emp), not_in(emp, "employee_id", jobs, "employee_id"), duplicate_rows(rows, ["nama"])]
    assert not [k for k, df in enumerate(plans) if "Broadcast" in _plan(df)]


def test_orders_meet_customers_without_broadcast(spark):
    from conftest import SF001

    plan = _plan(Fixtures(spark, SF001).raw_data)
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 2  # nations and regions


def test_first_places_are_found_without_sorting(spark):
    rows = [(5, "N1", "Ann"), (3, "N1", "Ann"), (None, "N2", "Bo"), (1, "N2", "Bo"), (7, None, "Cy")]
    roster = spark.createDataFrame(rows, "row_id bigint, nik string, nama string")
    ass = spark.createDataFrame([(0, "N1", "Ann"), (4, "N3", None), (2, "N3", None)], "row_id bigint, nik string, nama string")
    pairs = cell_pairs([(ROSTER, roster), (ASSESSMENT, ass)])
    assert "SortAggregate" not in _plan(pairs)
    got = {(r["_k"], r["_n"]): (r["_first"]["sheet"], r["_first"]["row_id"], r["_last"], r["_fill"]) for r in pairs.collect()}
    assert got == {("N1", "Ann"): (0, 3, 1, True), ("N2", "Bo"): (0, None, 0, True), (None, "Cy"): (0, 7, 0, True), ("N3", None): (1, 2, 1, True)}


def test_a_table_has_at_most_32_buckets_and_empty_ones_need_no_python(spark, tmp_folder):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        store = SnapshotStore(spark, f"{tmp_folder}/state")
        store.seed({EMPLOYEES.name: spark.range(500).selectExpr("concat('e', id) AS employee_id")})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert store.buckets == 32 and store.read(EMPLOYEES.name).count() == 500
    none = empty(spark, JOBS.schema)
    assert none.schema.names == JOBS.schema.names and none.isEmpty() and "ExistingRDD" not in _plan(store.read(JOBS.name))


def test_transform_only_builds_each_dataset_once(spark, monkeypatch):
    raw, ass = _conformed(spark)
    built = []
    for name in ("employees_from_roster", "job_history", "education_history"):
        f = getattr(pipeline, name)
        monkeypatch.setattr(pipeline, name, lambda *a, f=f, name=name, **k: built.append(name) or f(*a, **k))
    assert pipeline.transform_only(spark, raw, ass)[EMPLOYEES.name].count() > 0
    assert sorted(built) == ["education_history", "employees_from_roster", "job_history"]


@pytest.mark.parametrize("text", ["a", "", " ", "\ta b\n", " x", "x ", "é", "　 y   ", "\x1cz", "~", "\x7f", None])
def test_strip_cell_equals_strip_ws(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(strip_cell("t").alias("a"), strip_ws("t").alias("b")).first()
    assert got["a"] == got["b"] == (text.strip() if text is not None else None)


def test_numbering_of_few_rows_takes_few_files(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        rows = spark.range(1000).selectExpr("(id * 7919) % 1000 AS k")
        got = dense_index(rows, ["k"], "n", start=5)
        assert len(got.inputFiles()) < 50
        assert got.where("n <> k + 5").isEmpty() and got.count() == 1000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_cut_runs_without_methods_too_large_to_be_compiled(spark):
    """The limit holds while a table is written, and not after it, also when writing fails."""
    limit, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(limit)

    class Writer:
        def parquet(self, path):
            seen.append(spark.conf.get(limit))
            raise OSError("full")

    class Table:
        sparkSession, write = spark, Writer()

    with pytest.raises(OSError):
        cut(Table())
    assert seen == ["8000"] and spark.conf.get(limit) == before


@pytest.mark.parametrize("split", [48, 1 << 20])
def test_lines_without_open_quotes_are_numbered_where_they_are(spark, tmp_folder, monkeypatch, split):
    """Files of two layouts and one without rows, cut by splits: rows by (file, position), nothing sorted for it."""
    want = []
    for k, header in enumerate(("a;b", "b;a", "a;b", "row_id;a")):
        with open(f"{tmp_folder}/part-{k}.csv", "w", encoding="utf-8") as f:
            f.write(header + "\n")
            for i in range(0 if k == 2 else 40):
                f.write(f'{k}-{i};"x {i}"\n')
                want.append((f"{k}-{i}", f"x {i}") if k == 0 else (f"x {i}", f"{k}-{i}") if k == 1 else (f"x {i}", None))
    monkeypatch.setattr(sheets, "dense_index", None)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        df = sheets.read_csv_sheet(spark, [tmp_folder])
        got = df.orderBy("row_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r["a"], r["b"]) for r in got] == want and [r["row_id"] for r in got] == list(range(120))
    assert "rangepartitioning" not in _plan(df)
