"""The line CRF: gradients and marginals against enumeration, held-out accuracy, edge cases."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from rosterline.llm import line_crf

SF = "/root/testdata/sf0.01"


def test_marginals_match_enumeration():
    rnd = np.random.default_rng(1)
    scores, move = rnd.normal(size=7), rnd.normal(size=(2, 2))
    starts, sizes = np.array([0, 4]), np.array([4, 3])
    got, pairs = line_crf.forward_backward(scores, starts, sizes, move)
    want, want_pairs = np.zeros(7), np.zeros((2, 2))
    for s, n in zip(starts, sizes):
        paths = list(itertools.product((0, 1), repeat=int(n)))
        weight = np.array([np.exp(sum(scores[s + i] * y for i, y in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        weight /= weight.sum()
        for p, w in zip(paths, weight):
            want[s : s + n] += w * np.array(p)
            for a, b in zip(p, p[1:]):
                want_pairs[a, b] += w
    assert np.allclose(got, want) and np.allclose(pairs, want_pairs)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    field = line_crf.train(docs, labels)
    rows = line_crf.score(docs, field).join(labels, "doc_id").where(line_crf.held_out()).select("quality", "quality_good").collect()
    assert len(rows) > 40
    assert sum(r[0] == r[1] for r in rows) >= 0.97 * len(rows)


def test_edge_cases(spark):
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0)], "doc_id long, quality int")
    rows = [(1, None, "a"), (1, "", "b"), (None, "\n\n", "c"), (2, "x " * 100_000, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality_score string")
    field = line_crf.train(docs, labels)
    got = line_crf.score(docs, field)
    assert got.columns == ["doc_id", "text", "quality_score", "quality_good"]
    assert all(0 <= r["quality_score"] <= 1 for r in got.collect()) and got.count() == 4
    assert line_crf.score(docs.limit(0), line_crf.train(docs.limit(0), labels)).count() == 0
    assert [r["quality_score"] for r in line_crf.score(docs, line_crf.fit([])).collect()] == [0.5] * 4
    assert spark.range(5).select(line_crf.held_out("id")).count() == 5
    assert got.where(F.col("quality_good").isNull()).count() == 0
