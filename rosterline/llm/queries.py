"""Registered queries of this subpackage: one per operator over its whole table, and their DuckDB SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    block_search,
    bpe_codec,
    embedding_dedup,
    fingerprint,
    line_crf,
    minhash,
    mixing,
    orchard_codes,
    secret_scan,
    suffix_dedup,
    token_count,
    url_filter,
    whitening,
)
from .common import table

#: Folder of the public vocabulary files where the package that knows it isn't installed.
VOCABULARIES = "/opt/tokenizers"


def vocabulary(name: str) -> str:
    try:
        import public_tokenizers
    except ModuleNotFoundError:
        return os.path.join(VOCABULARIES, name)
    return str(public_tokenizers.path(name))


#: verdict, host, path
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict", F.round("log_odds", 6).alias("log_odds"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kind = lambda k: F.filter("secrets", lambda x: x["kind"] == k)
    return found.select(
        "doc_id",
        *(F.size(kind(k)).cast("long").alias(f"n_{secret_scan.KINDS[k]}") for k in range(3)),
        F.sha2(secret_scan.joined(F.filter("secrets", lambda x: x["kind"] < 3)), 256).alias("base_sha256"),
        secret_scan.joined(F.col("secrets")).alias("spans"),
        F.size(kind(3)).cast("long").alias("n_random"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op4_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = line_crf.train(docs, table(spark, sf_dir, "labels"))
    scored = line_crf.score(docs, field)
    return scored.select("doc_id", line_crf.held_out().alias("held_out"), F.col("quality_score").alias("score"), F.col("quality_good").alias("predicted"))


def op5_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), seed=7)


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.encode_digest(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=100)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op9_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprint.edits(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=5, percent=85)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(table(spark, sf_dir, "embeddings"), components=8, scale=1024, offset=100_000)
    return out.withColumn("deviation", F.col("deviation").cast("long"))


def op12_block_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_search.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, neighbours=10)


def op13_orchard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, books = orchard_codes.encode(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256)
    code = F.lower(F.array_join(F.transform("codes", lambda c: F.lpad(F.hex(c), 2, "0")), ""))
    return out.select("vec_id", code.alias("code"), "error", "label_error", F.lit(orchard_codes.digest(books)).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_secret_scan": op2_secret_scan,
    "op3_token_counts": op3_token_counts,
    "op4_line_crf": op4_line_crf,
    "op5_poisson_mixing": op5_poisson_mixing,
    "op6_bpe_codec": op6_bpe_codec,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_multiset_fingerprint": op9_multiset_fingerprint,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_block_nearest": op12_block_nearest,
    "op13_orchard_codes": op13_orchard_codes,
}

def _orchard_sql() -> str:
    """Whole numbers by part; each round: nearest entries by arg_min, then the floors of the means; codes at last."""
    near = """
        near{r} AS (
            SELECT vec_id, label, part, arg_min(entry, d * 64 + entry) AS entry, min(d) AS d, any_value(x) AS x FROM (
                SELECT p.*, b.entry, list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - b.x[i]) * (p.x[i] - b.x[i])))::BIGINT AS d
                FROM parts p JOIN book{r} b ON b.part = p.part
            ) GROUP BY vec_id, label, part
        )"""
    book = """
        sums{n} AS (SELECT part, entry, i, floor(sum(x[i])::DECIMAL(38,0) / count(*))::BIGINT AS m FROM near{r}, range(1, (SELECT size + 1 FROM shape)) t(i) GROUP BY part, entry, i),
        book{n} AS (SELECT b.part, b.entry, coalesce(s.x, b.x) AS x FROM book{r} b LEFT JOIN (SELECT part, entry, list(m ORDER BY i) AS x FROM sums{n} GROUP BY part, entry) s USING (part, entry))"""
    steps = [near.format(r=0), book.format(n=1, r=0), near.format(r=1), book.format(n=2, r=1), near.format(r=2)]
    return f"""
        WITH v AS (
            SELECT vec_id, label, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::BIGINT) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        shape AS (SELECT max(len(e)) // 16 AS size FROM v),
        parts AS (SELECT vec_id, label, part, e[part * size + 1 : part * size + size] AS x FROM v, shape, range(16) r(part)),
        firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v QUALIFY entry < 64),
        book0 AS (SELECT part, entry, x FROM parts JOIN firsts USING (vec_id)),
        {",".join(steps)},
        errors AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near2 GROUP BY vec_id),
        flat AS (SELECT part, entry, i, x[i] AS c FROM book2, range(1, (SELECT size + 1 FROM shape)) t(i))
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
               (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, i)) FROM flat) AS codebooks_sha256
        FROM errors
    """


ORACLE_SQL: dict[str, str] = {
    "op5_poisson_mixing": """
        WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
        rates AS (SELECT source, (SELECT sum(n) FROM sizes)::DOUBLE / ((SELECT count(*) FROM sizes) * n) AS rate FROM sizes),
        drawn AS (SELECT source, rate, greatest(1, ceil(rate / 16))::INT AS draws FROM rates),
        cdf AS (
            SELECT source, k, sum(exp(-rate / draws + k * ln(rate / draws) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS upto
            FROM drawn, range(0, 101) AS r(k)
        ),
        uniform AS (
            SELECT d.doc_id, d.source, j, ('0x' || left(md5('7:' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || j), 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
            FROM documents d JOIN drawn s ON s.source IS NOT DISTINCT FROM d.source, LATERAL (SELECT unnest(range(1, s.draws + 1)) AS j)
        ),
        copies AS (
            SELECT u.doc_id, count(*) FILTER (WHERE u.u >= c.upto) AS copies
            FROM uniform u JOIN cdf c ON c.source IS NOT DISTINCT FROM u.source GROUP BY u.doc_id
        )
        SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, n.copy::INT AS copy, c.copies::INT AS copies,
               md5('7-order:' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || n.copy) AS shuffle_key
        FROM documents d JOIN copies c ON c.doc_id IS NOT DISTINCT FROM d.doc_id, LATERAL (SELECT unnest(range(1, c.copies + 1)) AS copy) n
    """,
    "op12_block_nearest": """
        WITH v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   sqrt(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: (q.e[i] - c.e[i]) * (q.e[i] - c.e[i])))) AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
        ),
        ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INT AS rank, vec_id, score FROM pairs)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op13_orchard_codes": _orchard_sql(),
}
