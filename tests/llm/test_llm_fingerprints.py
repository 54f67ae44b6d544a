"""Fingerprints: edited texts against Python, order independence, adding and taking away, likeness."""

import hashlib

from pyspark.sql import functions as F

from rosterline.llm import fingerprint as fp

LOW = -(1 << 63)


def brute(rows):
    first = {}
    for i, t in rows:
        k = LOW if i is None else i
        first[k] = min(first.get(k, t or ""), t or "", key=lambda x: x.encode())
    ids = sorted(first)
    out = []
    for i, t in rows:
        t, k = t or "", LOW if i is None else i
        q = len(t) // 4
        out.append((i, len(t), hashlib.sha256((t[: len(t) - q] + first[ids[(ids.index(k) + 1) % len(ids)]][:q]).encode()).hexdigest()))
    return sorted(out, key=str)


def test_edits(spark):
    rows = [(3, "abcdefgh"), (1, "🙂🙂🙂🙂é. b\n\nc"), (None, None), (2, ""), (2, "zzzz. a. b. c"), (9, "x." * 20_000), (9, "x." * 20_000)]
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, k string")
    got = fp.edits(df).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "near_edited", "near_next").collect()
    assert sorted([tuple(r)[:3] for r in got], key=str) == brute(rows)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert fp.edits(df.limit(0)).count() == 0
    alone = fp.edits(df.where("doc_id = 3")).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = fp.edits(docs).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "near_edited", "near_next").collect()
    assert sorted([tuple(r)[:3] for r in got], key=str) == brute(rows)
    texts, by_text = dict(rows), {}
    for r in got:
        by_text.setdefault(texts[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values()) and len({next(iter(v)) for v in by_text.values()}) == len(by_text)
    mean = lambda c: sum(r[c] for r in got) / len(got)
    assert mean("near_edited") > 0.6 and mean("near_next") < 0.1


def test_multisets(spark):
    df = spark.createDataFrame([("a. b. c.", "c.\nb.  a.", "b. c.", "a.")], "x string, y string, z string, w string")
    for c in "xyzw":
        df = fp.with_fingerprint(df, F.col(c), f"f{c}")
    r = df.select("fx", "fy", "fz", fp.combined(F.col("fx"), F.col("fw"), -1).alias("less"), fp.combined(F.col("fz"), F.col("fw")).alias("more")).first()
    assert r["fx"] == r["fy"] == r["more"] and r["fz"] == r["less"] and r["fx"] != r["fz"]
