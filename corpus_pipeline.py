"""Corpus pipeline: documents go through the stages in order, each written as Parquet and reread as the next one's input.

1. quality   documents that the line CRF rejects go
2. near      one document of each group of near-duplicates stays (five-word shingles, similarity 0.8 or more)
3. secrets   secrets are replaced by a mark in the text, n_chars follows
4. mixing    documents are repeated or left out so that all sources have the same expected share
5. bpe       ids and decoded text of every document

The last stage's rows may repeat an id, once for each copy that mixing made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterline.llm import bpe_codec, line_crf, minhash, mixing, secret_scan
from rosterline.llm.common import broadcast_checked, stage, table
from rosterline.llm.queries import vocabulary
from rosterline.operators.dense_index import dense_index

#: Dropped ids are broadcast up to this many (16 bytes each in a hash table), else joined by sorting.
DROPPED = 1_000_000
#: Column that numbers the documents where ids repeat.
NUMBER = "_near_number"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the quality classifier calls good."""
    field = line_crf.train(docs, table(spark, sf_dir, "labels"))
    return line_crf.score(docs, field).where("quality_good = 1").select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates.

    Rows of a repeated id are documents of their own where their texts differ, and one document where id and text are
    equal (of their other columns one row's stay).  Rows with a null id stay.
    """
    columns, key = docs.columns, "doc_id"
    if not docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        docs, key = stage(_numbered(docs), "numbered"), NUMBER
    found = stage(minhash.near_duplicates(docs, id_col=key, size=5, percent=80), "near")
    dropped = found.where("not kept").select(key)
    return docs.join(broadcast_checked(dropped, DROPPED), key, "left_anti").select(*columns)


def _numbered(docs: DataFrame) -> DataFrame:
    """Each id and text once, with a number in the order of ids and of the texts' hashes; the number of null ids is null."""
    columns = docs.columns
    rows = docs.withColumn(f"{NUMBER}_text", F.coalesce(F.sha2("text", 256), F.lit("")))
    known = rows.where("doc_id is not null")
    numbers = dense_index(known.select("doc_id", f"{NUMBER}_text").distinct(), ["doc_id", f"{NUMBER}_text"], NUMBER)
    whole = F.struct(*columns)
    once = known.join(numbers, ["doc_id", f"{NUMBER}_text"]).groupBy(NUMBER).agg(F.min_by(whole, F.sha2(F.to_json(whole), 256)).alias("_row"))
    once = once.select(*(F.col(f"_row.`{c}`").alias(c) for c in columns), NUMBER)
    return once.unionByName(docs.where("doc_id is null").withColumn(NUMBER, F.lit(None).cast("long")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts by a mark."""
    found = secret_scan.scan(docs)
    clean = F.when(F.size("secrets") > 0, secret_scan.redacted(F.col("text"), F.col("secrets"))).otherwise(F.col("text"))
    found = found.withColumn("text", clean)
    return found.withColumn("n_chars", F.when(F.size("secrets") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that every source has the same expected number, as many in all as before."""
    return mixing.mix(docs).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded text."""
    return bpe_codec.encode(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("near", near), ("secrets", secrets), ("mixing", mixed), ("bpe", encoded)]

#: The stages use a trained model and iterated link searches, which one SQL statement can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
