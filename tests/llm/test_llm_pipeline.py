"""The pipeline: each stage's decisions on its own input, and the whole run."""

from pyspark.sql import functions as F

import corpus_pipeline
from test_llm_near import brute
from test_llm_secrets import base

from rosterline.llm.common import stage, table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality", "near", "secrets", "mixing", "bpe"]

    good = stage(steps["quality"](spark, docs, SF), "t")
    assert good.columns == columns
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    kept = {r["doc_id"] for r in good.collect()}
    known = [i for r in docs.collect() if (i := r["doc_id"]) in labels]
    assert sum((i in kept) == bool(labels[i]) for i in known) >= 0.97 * len(known)

    alone = stage(steps["near"](spark, good, SF), "t")
    groups = brute([(r["doc_id"], r["text"]) for r in good.collect()], 80)
    assert alone.columns == columns
    assert sorted(r["doc_id"] for r in alone.collect()) == sorted({c for _, _, c in groups})

    clean = stage(steps["secrets"](spark, alone, SF), "t")
    before = {r["doc_id"]: r for r in alone.collect()}
    assert clean.columns == columns and clean.count() == len(before)
    for r in clean.collect():
        assert not base(r["text"]) and r["n_chars"] == len(r["text"])
        if not base(before[r["doc_id"]]["text"]):
            assert r["text"] == before[r["doc_id"]]["text"]

    mixed = stage(steps["mixing"](spark, clean, SF), "t")
    assert mixed.columns == columns
    assert {(r["doc_id"], r["text"]) for r in mixed.collect()} <= {(r["doc_id"], r["text"]) for r in clean.collect()}

    ids = steps["bpe"](spark, mixed, SF)
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    got = ids.collect()
    assert len(got) == mixed.count() and all(r["decoded"] == texts[r["doc_id"]] and len(r["ids"]) == r["n_tokens"] for r in got)


def test_repeated_and_odd_rows(spark):
    rows = [(1, "a b c d e f g", "en", "s", 13), (1, "a b c d e f g", "en", "s", 13), (None, None, None, None, None), (2, "", "en", "s", 0), (3, "a b c d e f g", "en", "t", 13)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    alone = corpus_pipeline.near(spark, docs, SF)
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in alone.collect()) == [("1", "a b c d e f g"), ("2", ""), ("None", "None")]
    assert corpus_pipeline.secrets(spark, docs, SF).count() == 5
    assert corpus_pipeline.mixed(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.encoded(spark, docs, SF).count() == 5


def test_different_texts_of_one_id_stay(spark):
    a, b, c = "a b c d e f g h i j", "k l m n o p q r s t", "u v w x y z 1 2 3 4"
    rows = [(1, a, "p"), (1, b, "p"), (1, b, "q"), (2, a, "p"), (3, c, "p"), (4, b + " five", "p"), (None, c, "p"), (5, None, "p"), (5, "", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("extra", F.create_map(F.lit("x"), F.lit(1)))
    alone = corpus_pipeline.near(spark, docs, SF)
    assert alone.columns == docs.columns
    got = sorted((str(r["doc_id"]), str(r["text"])) for r in alone.collect())
    assert got == sorted([("1", a), ("1", b), ("3", c), ("None", c), ("5", "None"), ("5", "")])
