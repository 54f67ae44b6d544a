"""Operators on small frames, each checked against a direct Python computation."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from rosterline.operators.dense_index import dense_index
from rosterline.operators.dedup import duplicate_rows, first_non_null, keep_first, last_wins
from rosterline.operators.upsert import merge
from rosterline.specs import EMPLOYEES


def test_dense_index_equals_global_order(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 3), rnd.randint(0, 10_000), f"n{i}") for i in range(500)]
    rows = list({(a, b): (a, b, c) for a, b, c in rows}.values())
    df = spark.createDataFrame(rows, "a int, b int, name string")
    for parts in (1, 3, 8):
        got = {r["name"]: r["idx"] for r in dense_index(df, ["a", "b"], "idx", start=5001, partitions=parts).collect()}
        want = {c: 5001 + i for i, (_, _, c) in enumerate(sorted(rows))}
        assert got == want


def test_keep_first_and_duplicates(spark):
    rows = [(1, "a", "x"), (2, "a", "y"), (3, None, "z"), (4, None, "w"), (5, "b", "v")]
    df = spark.createDataFrame(rows, "row_id long, k string, v string")
    kept = sorted((r["row_id"], r["v"]) for r in keep_first(df, ["k"], "row_id").collect())
    assert kept == [(1, "x"), (3, "z"), (5, "v")]  # null equals null
    dups = sorted(r["row_id"] for r in duplicate_rows(df, ["k"]).collect())
    assert dups == [2, 4]


def test_first_non_null_mixes_rows(spark):
    rows = [(1, "e", None, "b1"), (2, "e", "a2", None), (3, "e", "a3", "b3"), (4, None, "q", "q")]
    df = spark.createDataFrame(rows, "row_id long, k string, a string, b string")
    out = first_non_null(df, ["k"], [F.col("row_id")], ["a", "b"]).collect()
    assert [(r["k"], r["a"], r["b"]) for r in out] == [("e", "a2", "b1")]


def test_last_wins(spark):
    df = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new"), ("j", 1, "only")], "key string, _ord int, v string")
    got = sorted((r["key"], r["v"]) for r in last_wins(df, ["key"], "_ord").collect())
    assert got == [("j", "only"), ("k", "new")]


def test_merge_semantics(spark):
    state = spark.createDataFrame([("e1", "Old Name", "Female"), ("e2", "Keep", None)], "employee_id string, fullname string, gender string")
    incoming = spark.createDataFrame([("e1", "New Name", 1), ("e3", "Fresh", 2)], "employee_id string, fullname string, _ord int")
    out = {r["employee_id"]: r for r in merge(state, incoming, EMPLOYEES).collect()}
    assert out["e1"]["fullname"] == "New Name" and out["e1"]["gender"] == "Female" and out["e1"]["_action"] == "update"
    assert out["e2"]["fullname"] == "Keep" and out["e2"]["_action"] == "keep"
    assert out["e3"]["gender"] == "Male" and out["e3"]["_action"] == "insert"  # default on insert only


def test_not_in_null_rules(spark):
    from rosterline.operators.checks import not_in

    df = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    assert sorted(r[0] for r in not_in(df, "id", spark.createDataFrame([("a",)], "id string"), "id").collect()) == ["b"]
    assert not_in(df, "id", spark.createDataFrame([("a",), (None,)], "id string"), "id").count() == 0
    assert not_in(df, "id", spark.createDataFrame([], "id string"), "id").count() == 3


def test_resolve_restricted_equals_full(spark):
    from rosterline.operators.resolve import resolve

    emp = spark.createDataFrame([("e1", "Ana Maria"), ("e2", "Budi Santoso"), ("e3", "Joko")], "employee_id string, fullname string")
    jobs = spark.createDataFrame([("e1", "K1"), ("e3", " K3 ")], "employee_id string, employee_no_subholding string")
    rows = [(1, "K1", "x y"), (2, None, "budi santoso"), (3, "K3", "Joko"), (4, None, "Joko"), (5, None, None)]
    df = spark.createDataFrame(rows, "row_id long, nik string, nama string")
    full = sorted(tuple(r) for r in resolve(df, emp, jobs, "s", 0).select("row_id", "employee_id", "match_kind").collect())
    rest = sorted(tuple(r) for r in resolve(df, emp, jobs, "s", 0, restrict_to_sheet=True)
                  .select("row_id", "employee_id", "match_kind").collect())
    assert full == rest
    kinds = {r[0]: r[2] for r in full}
    assert kinds == {1: "key", 2: "name", 3: "key", 4: "new", 5: "new"}  # one-word name never matches by name
