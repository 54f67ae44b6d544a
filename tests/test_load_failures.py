"""A table that can't be loaded ends in an error for whoever asked, not in tables that look like a result."""

from __future__ import annotations

import pytest
from test_golden_sheets import _conformed

from pyspark.sql import functions as F

from rosterline.plans import pipeline
from rosterline.plans.outcomes import LoadFailed
from rosterline.plans.queries import QUERIES
from rosterline.sources.snapshots import SnapshotStore
from rosterline.specs import ASSESSMENTS, EDUCATION, EMPLOYEES, JOBS, ROADMAP
from rosterline.streaming.drop_folder import drop_upload, quarantine, start_stream


def _break(monkeypatch, table):
    whole = pipeline.merge

    def merge(state, incoming, spec, **kw):
        if spec.name == table:
            raise OSError("disk full")
        return whole(state, incoming, spec, **kw)

    monkeypatch.setattr(pipeline, "merge", merge)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    ids = spark.range(120)
    tables = {
        "region": spark.range(2).selectExpr("id AS r_regionkey", "concat('R', id) AS r_name"),
        "nation": spark.range(4).selectExpr("id AS n_nationkey", "concat('N', id) AS n_name", "id % 2 AS n_regionkey"),
        "customer": ids.selectExpr("id AS c_custkey", "concat('Customer#', id) AS c_name", "id % 4 AS c_nationkey", "'FURNITURE' AS c_mktsegment"),
        "supplier": spark.range(8).selectExpr("id AS s_suppkey", "concat('Supplier#', id) AS s_name"),
        "orders": ids.selectExpr("id AS o_orderkey", "id % 60 AS o_custkey", "timestamp'1995-03-04' AS o_orderdate", "'1-URGENT' AS o_orderpriority", "'F' AS o_orderstatus"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("query,table", [
    ("assessment_history", EMPLOYEES.name), ("change_log", EMPLOYEES.name), ("incomplete_entities", ROADMAP.name),
])
def test_no_rows_after_a_failed_load(spark, sf_dir, monkeypatch, query, table):
    _break(monkeypatch, table)
    with pytest.raises(LoadFailed, match=f"{table}: disk full"):
        QUERIES[query](spark, sf_dir).collect()


def test_the_other_tables_are_loaded_before_the_error(spark, tmp_folder, monkeypatch):
    raw, ass = _conformed(spark)
    store = SnapshotStore(spark, f"{tmp_folder}/state")
    _break(monkeypatch, JOBS.name)
    with pytest.raises(LoadFailed) as e:
        pipeline.upload(spark, store, raw, ass, "u")
    done = e.value.report
    assert {n: r.status for n, r in done.results.items()} == {
        EMPLOYEES.name: "loaded", JOBS.name: "failed", EDUCATION.name: "loaded", ASSESSMENTS.name: "loaded", ROADMAP.name: "loaded"}
    assert isinstance(e.value.__cause__, OSError) and not done.success
    assert store.read(EMPLOYEES.name).count() == 12 and store.read(JOBS.name).isEmpty() and store.read(ASSESSMENTS.name).count() == 6


def test_a_streamed_upload_notes_the_failed_table(spark, tmp_folder, monkeypatch):
    raw, ass = _conformed(spark)
    store = SnapshotStore(spark, f"{tmp_folder}/state")
    _break(monkeypatch, EDUCATION.name)
    drop_upload(raw, ass, tmp_folder, "u")
    start_stream(spark, store, tmp_folder)
    bad = quarantine(store).where(F.col("upload_id") == "u").collect()
    assert [(r["attempts"], r["errors"]) for r in bad] == [(1, str({EDUCATION.name: "disk full"}))] and not store.notes("applied")
