"""Registered queries against their DuckDB oracle at sf0.001 (the driver does the same at sf0.01)."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb
import pytest

from conftest import SF001

KEYS = ["ingest_clean", "header_match", "gender_normalize", "date_coerce", "golden_record", "next_counter",
        "missing_names", "existing_key_lookup", "fill_missing_key", "entity_resolve", "job_history",
        "career_roadmap", "upsert_state", "change_log", "check_unique", "load_report", "recycle_restore", "export_datasets", "stream_change_feed",
        "load_rejects", "gate_closed", "final_tables", "job_history_supplement", "check_fk", "reload_noop", "two_uploads", "load_accounting", "reject_rows", "dedup_stats",
        "ingest_files", "cascade_delete", "default_fill", "feed_after_failure", "stream_with_bad_upload"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "orders", "lineitem"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    import __spark_entry__ as e

    df = e.queries()[key](spark, SF001)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(_norm(r[c]) for c in cols)) for r in df.select(*cols).collect())
    res = con.execute(e.oracle_sql()[key])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    want = sorted(repr(tuple(_norm(row[i]) for i in idx)) for row in res.fetchall())
    assert got == want


def test_every_key_has_oracle_or_is_rows_only():
    import __spark_entry__ as e
    from rosterline.plans.oracle import ROWS_ONLY

    q, o = set(e.queries()) - set(e.CORPUS_QUERIES), set(e.oracle_sql()) - set(e.CORPUS_SQL)
    assert q == o | set(ROWS_ONLY)


def test_entry_runs(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "nik"
