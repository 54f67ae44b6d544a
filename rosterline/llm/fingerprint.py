"""Document fingerprints as homomorphic multiset hashes, with DataFrame functions only.

A text's paragraphs, taken in sentences of at most 160 characters, form a multiset.  Every element is hashed to a wide
vector: 8 words of 32 bits, 64 signs and a constant 1.  A fingerprint is the sum of its elements' vectors, each
component modulo 2**32.  So it doesn't depend on the elements' order, equal multisets have equal fingerprints, and
elements are put in or taken out by adding or subtracting their fingerprint (``combined``).  The sign sums estimate
inner products of the multisets, which gives the likeness of two fingerprints.

Null texts count as empty, whose fingerprint is zero.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stage

#: Elements: a sentence of a paragraph with its end marks, cut after 160 characters.
ELEMENT = r"[^\s.!?][^\n.!?]{0,159}[.!?]*|[.!?]+"
#: Hashes per element, of which each gives two words; the first also gives the 64 signs.
HASHES = 4
WORD = 0xFFFFFFFF
#: The least 64-bit number stands for a null id in the order of documents.
NULL_ID = -(1 << 63)


def _hash(seed: int):
    return lambda x: F.xxhash64(x, F.lit(seed))


def with_fingerprint(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Adds ``name``: struct of n (elements), words (8) and signs (32 packed pairs of counts of set sign bits)."""
    elements, hashes = f"{name}_e", [f"{name}_h{k}" for k in range(HASHES)]
    df = df.withColumn(elements, F.regexp_extract_all(text, F.lit(ELEMENT), F.lit(0)))
    for k, h in enumerate(hashes):
        df = df.withColumn(h, F.transform(elements, _hash(k)))
    total = lambda h, part: F.aggregate(h, F.lit(0).cast("long"), lambda acc, x: acc + part(x))
    low, high = lambda x: x.bitwiseAND(F.lit(WORD)), lambda x: F.shiftrightunsigned(x, 32)
    words = [total(h, part).bitwiseAND(F.lit(WORD)) for h in hashes for part in (low, high)]
    pair = F.lit(1 << 32 | 1)  # one bit for each of two 32-bit counters
    signs = [total(hashes[0], lambda x, j=j: F.shiftright(x, j).bitwiseAND(pair)) for j in range(32)]
    fp = F.struct(F.size(elements).cast("long").alias("n"), F.array(*words).alias("words"), F.array(*signs).alias("signs"))
    return df.withColumn(name, fp).drop(elements, *hashes)


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of both multisets together (``sign`` 1), or of the first without the second (-1)."""
    plain = lambda x, y: (x + sign * y).bitwiseAND(F.lit(WORD))
    upper = lambda x: F.shiftrightunsigned(x, 32)
    packed = lambda x, y: F.shiftleft(plain(upper(x), upper(y)), 32).bitwiseOR(plain(x.bitwiseAND(F.lit(WORD)), y.bitwiseAND(F.lit(WORD))))
    return F.struct(plain(a["n"], b["n"]).alias("n"), F.zip_with(a["words"], b["words"], plain).alias("words"), F.zip_with(a["signs"], b["signs"], packed).alias("signs"))


def as_text(fp: Column) -> Column:
    """Hexadecimal components: elements, words, sign counts."""
    fixed = lambda width: lambda x: F.lpad(F.hex(x), width, "0")
    return F.concat_ws("-", F.lpad(F.hex(fp["n"]), 8, "0"), F.array_join(F.transform(fp["words"], fixed(8)), ""), F.array_join(F.transform(fp["signs"], fixed(16)), ""))


def likeness(a: Column, b: Column) -> Column:
    """2 <a, b> / (<a, a> + <b, b>) of the multisets as estimated from the sign sums, within 0 and 1; 1 if equal."""
    def sums(x: Column, y: Column) -> Column:
        sign = lambda fp, count: (fp["n"] - 2 * count).cast("double")
        parts = []
        for part in (lambda v: v.bitwiseAND(F.lit(WORD)), lambda v: F.shiftrightunsigned(v, 32)):
            parts.append((sign(a, part(x)), sign(b, part(y))))
        return F.struct(sum(p * q for p, q in parts).alias("dot"), sum(p * p + q * q for p, q in parts).alias("norm"))

    pairs = F.zip_with(a["signs"], b["signs"], sums)
    start = F.struct(F.lit(0.0).alias("dot"), F.lit(0.0).alias("norm"))
    add = lambda acc, x: F.struct((acc["dot"] + x["dot"]).alias("dot"), (acc["norm"] + x["norm"]).alias("norm"))
    value = F.aggregate(pairs, start, add, lambda acc: F.when(acc["norm"] > 0, 2 * acc["dot"] / acc["norm"]).otherwise(0.0))
    same = (a["n"] == b["n"]) & (a["words"] == b["words"])
    return F.when(same, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), value)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars, fingerprint (struct) and its text form of every row."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    rows = with_fingerprint(rows, F.col("_text"), "fp")
    return rows.select(F.col("_id").alias(id_col), F.length("_text").cast("long").alias("n_chars"), "fp", as_text(F.col("fp")).alias("fingerprint"))


def _followers(rows: DataFrame) -> DataFrame:
    """k, follows (the next smaller id, for the smallest the largest), need (a quarter of the longest text there).

    The distinct ids are sorted by ranges; a window in each range gives all neighbours but those across ranges, which
    follow from one row for each range.
    """
    ids = rows.groupBy("k").agg(F.floor(F.max(F.length("text")) / 4).cast("int").alias("need"))
    ranged = stage(ids.repartitionByRange("k").withColumn("range", F.spark_partition_id()), "ranges")
    ends = ranged.groupBy("range").agg(F.min("k").alias("first"), F.max(F.struct("k", "need")).alias("last")).orderBy("first").collect()
    if not ends:
        return ranged.select("k", F.col("k").alias("follows"), "need")
    within = Window.partitionBy("range").orderBy("k")
    before = [(e["range"], ends[i - 1]["last"]["k"], ends[i - 1]["last"]["need"]) for i, e in enumerate(ends)]
    across = F.broadcast(rows.sparkSession.createDataFrame(before, "range int, k0 long, need0 int"))  # a row for each range
    both = ranged.withColumns({"k1": F.lag("k").over(within), "need1": F.lag("need").over(within)}).join(across, "range")
    return both.select("k", F.coalesce("k1", "k0").alias("follows"), F.coalesce("need1", "need0").alias("need"))


def edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's fingerprint, edited text and likeness to the edited and the next document.

    The edited text has the last quarter of its code points replaced by the first as many of the next document's, in
    the order of ids (after the last comes the first; a lone document is its own next).  A null id comes before all
    others.  Where rows share an id, each gets a row, and the least text of the next id counts as the next document.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("k"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    follow = stage(_followers(rows), "follow")
    heads = rows.join(follow, "k")
    heads = with_fingerprint(heads, F.col("text"), "fp").select("follows", F.substring("text", 1, F.col("need")).alias("head"), "fp", "text")
    if rows.count() != follow.count():  # shared ids: the least text
        heads = heads.groupBy("follows").agg(F.min(F.struct("text", "head", "fp")).alias("m")).select("follows", "m.head", "m.fp")
    heads = heads.select(F.col("follows").alias("k"), "head", F.col("fp").alias("next_fp"))
    both = rows.join(heads, "k")
    n, quarter = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    both = both.withColumn("edited", F.concat(F.substring("text", 1, n - quarter), F.substring("head", 1, quarter)))
    both = with_fingerprint(with_fingerprint(both, F.col("text"), "fp"), F.col("edited"), "edited_fp")
    id_ = F.when(F.col("k") == NULL_ID, F.lit(None)).otherwise(F.col("k"))
    return both.select(
        id_.cast(docs.schema[id_col].dataType).alias(id_col), n.cast("long").alias("n_chars"), "edited", "fp", "edited_fp", "next_fp",
        F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
