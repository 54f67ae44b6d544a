"""Mixing sources to target weights by Poisson replication, with DataFrame functions only.

A source's rate is its target number of documents over the number it has.  Each document draws its number of copies
from a Poisson distribution of that mean, by inverting the distribution at a uniform number hashed from seed and id;
copies are exploded and shuffled globally by a hash of seed, id and copy.

Rates above 16 are split into several draws, so that the inversion stays exact.  Null sources form a source of their
own.  A row whose id is null or repeats draws by id, content and number: equal rows are counted, then numbered where
the count is exploded, so each row draws on its own and no window sorts them.  Documents of a high rate are exploded
in blocks of copies that are dealt to all tasks first.  Sources without a given weight have weight 0.  An empty table
gives an empty result.  All columns pass through; a column named like one that is added (copy, copies, shuffle_key)
is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import broadcast_checked, others, stage

#: Largest mean of one inversion, and its largest outcome (beyond double precision's last step below 1).
MEAN, MOST = 16, 100
#: The table of rates is broadcast up to this many sources, else joined by sorting.
SOURCES = 100_000
#: Copies or equal rows of one block; documents of sources with a higher rate than half of it are dealt in blocks.
BLOCK = 1_000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) with 52 bits, hashed from text parts joined by colons."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / float(1 << 52)


def poisson(rate: Column, u: Column) -> Column:
    """The smallest k whose cumulative Poisson probability exceeds ``u`` (rate at most MEAN)."""
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("upto"), F.lit(0).alias("k"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * rate / k
        return F.struct(p.alias("p"), (acc["upto"] + p).alias("upto"), F.when(u >= acc["upto"], k).otherwise(acc["k"]).alias("k"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(MOST)), start, step, lambda acc: acc["k"])


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, total: float | None = None, seed: int = 7, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Every copy of every document, with ``copy`` (from 1), ``copies`` (of the document) and ``shuffle_key``.

    ``weights``: target share of each source, in any unit (without: the same for all); ``total``: expected number of
    rows in all (without: as many as ``docs`` has).  Partitions hold random parts of the result in random order.
    """
    spark = docs.sparkSession
    key = lambda c: F.when(c.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), c.cast("string")))
    sizes = docs.groupBy(key(F.col(source_col)).alias("_source")).agg(F.count("*").alias("_n"))
    if weights is None:
        sizes = sizes.withColumn("_w", F.lit(1.0))
    else:
        rows = [("null" if k is None else f"={k}", float(w)) for k, w in weights.items()]
        sizes = sizes.join(broadcast_checked(spark.createDataFrame(rows, "_source string, _w double"), SOURCES), "_source", "left").fillna(0.0, ["_w"])
    sizes = stage(sizes, "sources")
    all_ = sizes.agg(F.sum("_n"), F.sum("_w")).first()
    wanted = float(total if total is not None else all_[0] or 0)
    rates = sizes.select("_source", (F.col("_w") * wanted / (F.lit(all_[1] or 1.0) * F.col("_n"))).alias("_rate"))

    names = docs.columns
    df = docs.toDF(*(f"c{k}" for k in range(len(names))))
    df = _keyed(df, F.col(f"c{names.index(id_col)}"))
    df = df.withColumn("_source", key(F.col(f"c{names.index(source_col)}"))).join(broadcast_checked(rates, SOURCES), "_source")
    rare = rates.where(F.col("_rate") > BLOCK / 2)
    out = _copied(df.where(F.col("_rate") <= BLOCK / 2), seed)
    if not rare.isEmpty():
        out = out.unionByName(_copied(df.where(F.col("_rate") > BLOCK / 2), seed, scatter=True))
    out = out.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(f"{seed}-order"), "_id", F.col("copy").cast("string"))))
    out = out.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
    added = ["copy", "copies", "shuffle_key"]
    return out.select(*(F.col(f"c{k}").alias(n) for k, n in others(names, added)), *added)


def _keyed(df: DataFrame, id_: Column) -> DataFrame:
    """``df`` with ``_id``, the text that a row draws by: its id, or id, content and number where the id is null or repeats."""
    cols = df.columns
    repeated = stage(df.where(id_.isNotNull()).groupBy(id_.cast("string").alias("_id")).agg(F.count("*").alias("_n")).where("_n > 1").select("_id"), "repeated-ids")
    known = df.withColumn("_id", id_.cast("string"))
    if repeated.isEmpty() and df.where(id_.isNull()).isEmpty():
        return known
    few = broadcast_checked(repeated, SOURCES)
    content = F.sha2(F.to_json(F.struct(*cols)), 256)
    odd = known.where("_id is null").unionByName(known.join(few, "_id", "left_semi")).withColumn("_content", F.concat_ws(":", F.coalesce("_id", F.lit("null")), content))
    same = odd.groupBy("_content").agg(F.count("*").alias("_n"), F.first(F.struct(*cols)).alias("_row"))
    same = same.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / BLOCK)))).repartition("_content", "_block")
    last = F.least(F.col("_n"), (F.col("_block") + 1) * BLOCK) - 1
    each = same.withColumn("_number", F.explode(F.sequence(F.col("_block") * BLOCK, last)))
    each = each.select(*(F.col(f"_row.{c}").alias(c) for c in cols), F.concat_ws(":", "_content", F.col("_number").cast("string")).alias("_id"))
    return known.where("_id is not null").join(few, "_id", "left_anti").select(*cols, "_id").unionByName(each)


def _copied(df: DataFrame, seed: int, scatter: bool = False) -> DataFrame:
    """Each row of ``df`` (``_id``, ``_rate``) for each of its copies; ``scatter``: blocks of copies are dealt to all tasks."""
    draws = F.greatest(F.lit(1), F.ceil(F.col("_rate") / MEAN)).cast("int")
    # the numbers are bound before the inversion, which would hash again at each of its steps
    numbers = F.transform(F.sequence(F.lit(1), draws), lambda k: uniform(F.lit(str(seed)), F.col("_id"), k.cast("string")))
    drawn = F.transform(numbers, lambda u: poisson(F.col("_rate") / draws, u))
    total = F.array(F.aggregate(drawn, F.lit(0), lambda acc, k: acc + k))
    none = F.array().cast("array<struct<block:int,copies:int>>")
    blocks = lambda n: F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")), lambda b: F.struct(b.alias("block"), n.alias("copies")))
    df = df.withColumn("_b", F.explode(F.flatten(F.transform(total, lambda n: F.when(n > 0, blocks(n)).otherwise(none)))))
    if scatter:
        df = df.repartition("_id", "_b")
    last = F.least(F.col("_b.copies"), (F.col("_b.block") + 1) * BLOCK)
    return df.withColumn("copy", F.explode(F.sequence(F.col("_b.block") * BLOCK + 1, last))).withColumn("copies", F.col("_b.copies"))
