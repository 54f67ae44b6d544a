"""Near-duplicate embeddings: random-hyperplane sign hashing in several tables, exact cosines, connected components.

Equal vectors fall into one class.  In each table a class's code is the signs of its projections on that table's
hyperplanes; classes with the same code share a bucket.  Buckets are cut into blocks, and each pair of blocks computes
all its cosines in double precision, so that a crowded bucket becomes many tasks and never a list of its pairs.  A
link counts in the first table that finds it.  Blocks return sums and a forest of their links.

The number of hyperplanes grows with the number of classes, so that buckets keep their size, and the number of tables
follows from it, so that a pair at the threshold is missed with a chance of at most 1 in 100,000.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do vectors of
different lengths.  Rows that share an id are vectors of their own and one node of the components; rows with a null id
link with nothing, have no component and are kept.  An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ship_code, stage
from .components import components

#: Classes per bucket that the number of hyperplanes aims at, classes per block, chance to miss a pair.
CROWD, BLOCK, MISSED = 512, 1024, 1e-5


def table_sizes(classes: int, threshold: float) -> tuple[int, int]:
    """Hyperplanes per table and tables."""
    bits = min(30, max(4, math.ceil(math.log2(max(1, classes) / CROWD))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISSED) / math.log(1 - same))


@functools.cache
def _planes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([31, dim]).standard_normal((dim, bits * tables))


def _classes(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, str]:
    """_id, cls (null: links with nothing) and vec (its components as binary) of every row; the components' type."""
    single = "float" in vectors.schema[vector_col].dataType.simpleString()
    kind, item = ("<f4", "float") if single else ("<f8", "double")
    ship_code(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for k, v in enumerate(batch.column("_vec")):
                x = np.array([], kind)
                if v.is_valid and v.values.null_count == 0 and batch.column("_id")[k].is_valid:
                    x = v.values.to_numpy(zero_copy_only=False).astype(kind) + 0.0  # no negative zeros
                held.append(x.tobytes() if len(x) and np.isfinite(x).all() and x.any() else None)
            keys = [None if x is None else hashlib.blake2b(x, digest_size=16).digest() for x in held]
            yield pa.record_batch([batch.column("_id"), pa.array(keys, pa.binary()), pa.array(held, pa.binary())], names=["_id", "cls", "vec"])

    cols = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).cast(f"array<{item}>").alias("_vec"))
    return cols.mapInArrow(run, f"_id {cols.schema['_id'].dataType.simpleString()}, cls binary, vec binary"), kind


def _coded(heads: DataFrame, kind: str, bits: int, tables: int) -> DataFrame:
    """heads with codes: one number per table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits)
        for batch in batches:
            codes = []
            for v in batch.column("vec"):
                x = np.frombuffer(v.as_buffer(), kind).astype(float)
                codes.append((((x / np.abs(x).max()) @ _planes(len(x), bits, tables)).reshape(tables, bits) > 0) @ weights)
            yield pa.record_batch([*batch.columns, pa.array(codes, pa.list_(pa.int64()))], names=[*batch.schema.names, "codes"])

    node = heads.schema["node"].dataType.simpleString()
    return heads.mapInArrow(run, f"cls binary, node {node}, n bigint, vec binary, codes array<bigint>")


def _unit(blobs: pd.Series, kind: str) -> np.ndarray:
    x = np.stack([np.frombuffer(b, kind) for b in blobs]).astype(float)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _compare(kind: str, threshold: float):
    """For a pair of blocks: of each class with a link, the vectors it links with for the first time, and a root."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        first, second, table = part["i"].iloc[0], part["j"].iloc[0], int(part["t"].iloc[0])
        a, b = part[part["block"] == first], part[part["block"] == second]
        links = _unit(a["vec"], kind) @ _unit(b["vec"], kind).T >= threshold
        if first == second:
            np.fill_diagonal(links, False)
        x, y = np.nonzero(links)
        codes_a, codes_b = (np.stack(p["codes"].to_list())[:, :table] for p in (a, b))
        fresh = np.zeros(links.shape, bool)
        for s in range(0, len(x), 65536):
            u, v = x[s : s + 65536], y[s : s + 65536]
            fresh[u, v] = ~(codes_a[u] == codes_b[v]).any(axis=1)
        ids_a, ids_b = a["node"].to_numpy(), b["node"].to_numpy()
        root_a, root_b = ids_a.copy(), ids_b.copy()
        top = max(ids_a.max(), ids_b.max()) if len(a) and len(b) else 0
        while len(x):
            low_a = np.minimum(root_a, np.where(links, root_b[None, :], top).min(axis=1))
            low_b = np.minimum(root_b, np.where(links, low_a[:, None], top).min(axis=0))
            if first == second:
                low_a = low_b = np.minimum(low_a, low_b)
            if (low_a == root_a).all() and (low_b == root_b).all():
                break
            root_a, root_b = low_a, low_b
        out = [pd.DataFrame({"cls": a["cls"], "node": ids_a, "linked": fresh @ b["n"].to_numpy(), "root": root_a})[links.any(axis=1)]]
        if first != second:
            out.append(pd.DataFrame({"cls": b["cls"], "node": ids_b, "linked": a["n"].to_numpy() @ fresh, "root": root_b})[links.any(axis=0)])
        return pd.concat(out)

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """id, n_links (other vectors with a cosine of ``threshold`` or more), component_id, kept of every row."""
    rows, kind = _classes(vectors, id_col, vector_col)
    rows = stage(rows, "vectors")
    good = rows.where("cls is not null")
    heads = good.groupBy("cls").agg(F.min("_id").alias("node"), F.count("*").alias("n"), F.min("vec").alias("vec"))
    heads = stage(heads, "classes")
    bits, tables = table_sizes(heads.count(), threshold)
    coded = stage(_coded(heads, kind, bits, tables), "codes")
    dealt = coded.select("cls", F.octet_length("vec").alias("width"), F.posexplode("codes").alias("t", "code"))
    bucket = ["width", "t", "code"]
    crowds = stage(dealt.groupBy(*bucket).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("k")).where("k > 1").drop("k"), "buckets")
    dealt = dealt.join(crowds, bucket).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("cls", *bucket, "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    node = heads.schema["node"].dataType.simpleString()
    found = dealt.join(coded, "cls").groupBy(*bucket, "i", "j").applyInPandas(_compare(kind, threshold), f"cls binary, node {node}, linked bigint, root {node}")
    found = stage(found, "links")

    shared = rows.where("_id is not null").groupBy("_id").agg(F.count("*").alias("n")).where("n > 1").select("_id")
    by_id = good.join(shared, "_id").join(heads.select("cls", "node"), "cls").select(F.col("_id").alias("u"), F.col("node").alias("v"))
    comp = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")).union(by_id))
    linked = found.groupBy("cls").agg(F.sum("linked").alias("linked"))
    final = heads.select("cls", "node", "n").join(linked, "cls", "left").join(comp, "node", "left")
    final = final.select("cls", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    out = rows.select("_id", "cls").join(final, "cls", "left")
    if not shared.isEmpty():  # a vector that links with nothing belongs to the other rows of its id
        own = out.join(shared, "_id").groupBy("_id").agg(F.min("component_id").alias("own"))
        out = out.join(own, "_id", "left").withColumn("component_id", F.coalesce("own", "component_id"))
    out = out.withColumn("component_id", F.coalesce("component_id", "_id"))
    return out.select(F.col("_id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.coalesce(F.col("_id") == F.col("component_id"), F.lit(True)).alias("kept"))
