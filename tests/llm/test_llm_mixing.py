"""Poisson mixing: DuckDB SQL over the whole table, shares, edge cases."""

import duckdb

from rosterline.llm import mixing, queries

SF = "/root/testdata/sf0.01"


def test_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    got = queries.op5_poisson_mixing(spark, SF)
    want = con.execute(f"select {', '.join(got.columns)} from ({queries.ORACLE_SQL['op5_poisson_mixing']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_shares_nulls_and_large_rates(spark):
    rows = [(k, f"t{k}", "a" if k < 900 else None, "c") for k in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copy string")
    out = mixing.mix(docs, weights={"a": 1, None: 3}, total=4000)
    assert out.columns == ["doc_id", "text", "source", "copy", "copies", "shuffle_key"]
    n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(n["a"] - 1000) < 150 and abs(n[None] - 3000) < 250  # 30 copies of each on average: two draws
    assert out.distinct().count() == out.count()
    assert mixing.mix(docs, weights={"b": 1}).count() == 0
    assert mixing.mix(docs.limit(0)).count() == 0
    again = mixing.mix(docs, weights={"a": 1, None: 3}, total=4000)
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_null_and_repeated_ids_draw_alone(spark):
    """A third of null ids, a repeated id and equal rows: shares within bounds, no hot partition, the same again."""
    docs = spark.range(60_000).selectExpr("case when id % 3 = 0 then null when id % 3 = 1 then 5 else id end as doc_id", "concat('t', case when id % 3 = 1 then id % 2 else id end) as text", "concat('s', id % 2) as source")
    out = mixing.mix(docs, weights={"s0": 1, "s1": 3}, total=120_000).cache()
    n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(n["s0"] / 30_000 - 1) < 0.02 and abs(n["s1"] / 90_000 - 1) < 0.02
    of_null = out.where("doc_id is null and source = 's1'").select("text", "copies").distinct().groupBy("copies").count().collect()
    assert len(of_null) > 6  # rows of their own, not all alike
    equal = {r["copies"]: r["count"] / r["copies"] for r in out.where("doc_id = 5 and text = 't1'").groupBy("copies").count().collect()}
    assert len(equal) > 6 and all(k == int(k) for k in equal.values()) and sum(equal.values()) < 10_000
    parts = [r["count"] for r in out.groupBy("shuffle_key").count().collect()]
    assert max(parts) == 1
    again = mixing.mix(docs.repartition(5), weights={"s0": 1, "s1": 3}, total=120_000)
    assert again.exceptAll(out).isEmpty() and out.exceptAll(again).isEmpty()
    out.unpersist()


def test_one_document_of_a_high_rate(spark):
    docs = spark.createDataFrame([(k, "x", "rare" if k == 0 else "usual") for k in range(1000)], "doc_id long, text string, source string")
    out = mixing.mix(docs, weights={"rare": 1, "usual": 0.01}, total=202_000).where("source = 'rare'").cache()
    n = out.count()
    assert abs(n / 200_000 - 1) < 0.02
    assert out.select("copy").distinct().count() == n and out.agg({"copy": "max"}).first()[0] == n and out.where(f"copies != {n}").isEmpty()
    out.unpersist()
