"""Nearest neighbours by a block matrix join: int8 product tiles, error bounds, exact distances of what is left.

Equal vectors form one class, which stands for its smallest ids (one more than neighbours are asked for).  Classes and
query classes are dealt into blocks by hash; a task takes one block of each.  Every vector is also held as int8 numbers
times a scale, with the exact length of what rounding lost.  The product of two int8 tiles gives all distances of a pair
of blocks up to the two losses, hence a lower and an upper bound; a pair is left if its lower bound does not exceed the
query's (neighbours + 1)-th smallest upper one.  These pairs are computed again in double precision, and heaps keep the
nearest of each query, first in a block, then over blocks.  Nothing is approximate: the result is that of brute force.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows with a null id.  A
shorter vector counts as ending in zeros.  Rows that share an id are rows of their own (a query leaves out one row that
equals it).  Distances are sums over the components in their order.  Nearness ties go to the smaller id.  An empty
table or one without queries gives an empty result; a query without other rows has no result rows.  Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ship_code, stage
from .vectors import binaries, from_binaries, matrix, width

#: Fewest and most rows of a block, bytes of a block's vectors, query rows of a tile, pairs computed again at a time, and blocks whose results one task merges.
LEAST, MOST, BYTES, TILE, PAIRS, MERGE = 512, 8192, 1 << 24, 256, 1 << 16, 64


def _rows(vectors: DataFrame, id_col: str, vector_col: str, is_query: Column, dim: int) -> DataFrame:
    """_id, query, cls and vec of every row that takes part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, rows = matrix(batch.column(2), dim)
            held = rows.any(axis=1) if dim else np.zeros(0, bool)
            good[good] = held
            blobs = binaries(rows[held] + 0.0 if dim else rows[:0])  # no negative zeros
            keys = pa.array([hashlib.blake2b(x.as_py(), digest_size=16).digest() for x in blobs], pa.binary())
            keep = pa.array(good)
            yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep), keys, blobs], names=["_id", "query", "cls", "vec"])

    cols = vectors.select(F.col(id_col).alias("_id"), F.coalesce(is_query, F.lit(False)).alias("query"), F.col(vector_col).cast("array<double>").alias("_vec"))
    return cols.where("_id is not null").mapInArrow(run, f"_id {cols.schema['_id'].dataType.simpleString()}, query boolean, cls binary, vec binary")


def quantised(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, scales, and upper bounds of the distance between a row and its int8 row times its scale."""
    scale = np.abs(rows).max(axis=1) / 127
    scale[scale == 0] = np.finfo(float).tiny  # components too small to divide
    codes = np.rint(rows / scale[:, None]).clip(-127, 127)
    lost = np.sqrt(((rows - codes * scale[:, None]) ** 2).sum(axis=1))
    return codes.astype(np.int8), scale, lost * (1 + 1e-9) + 1e-7 * np.sqrt((rows * rows).sum(axis=1))


def _tiles(classes: DataFrame, dim: int) -> DataFrame:
    """classes with q8, scale and lost."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, scale, lost = quantised(from_binaries(batch.column("vec").to_pylist(), "<f8", dim))
            yield pa.record_batch([*batch.columns, binaries(codes), pa.array(scale), pa.array(lost)], names=[*batch.schema.names, "q8", "scale", "lost"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema.fields)
    return classes.mapInArrow(run, f"{schema}, q8 binary, scale double, lost double")


def bounds(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances between two blocks of (codes, scale, lost).

    The products of int8 numbers are taken in single precision, 1,024 components at a time: they stay below 2**24 and so are exact.
    """
    (x, sx, lx), (y, sy, ly) = a, b
    dots = np.zeros((len(x), len(y)))
    for k in range(0, x.shape[1], 1024):
        dots += x[:, k : k + 1024].astype(np.float32) @ y[:, k : k + 1024].astype(np.float32).T
    size = lambda c, s: (c.astype(np.float64) ** 2).sum(axis=1) * s * s
    middle = size(x, sx)[:, None] + size(y, sy)[None, :] - 2 * dots * sx[:, None] * sy[None, :]
    middle = np.sqrt(np.maximum(middle, 0))
    lost = lx[:, None] + ly[None, :]
    return np.maximum(middle - lost, 0), middle + lost


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows, components added in their order."""
    total = np.zeros(len(x))
    for k in range(x.shape[1]):
        total += (x[:, k] - y[:, k]) ** 2
    return np.sqrt(total)


def _search(dim: int, most: int):
    """For a pair of blocks: of each query class, its ``most`` nearest rows as lists of distances and ids."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        ask, have = part[part["asks"]], part[~part["asks"]]
        codes = lambda p: (from_binaries(p["q8"], "<i1", dim), p["scale"].to_numpy(), p["lost"].to_numpy())
        asked, held, other = from_binaries(ask["vec"], "<f8", dim), from_binaries(have["vec"], "<f8", dim), codes(have)
        ids, out = have["ids"].to_list(), []
        for k in range(0, len(ask) if len(have) else 0, TILE):
            low, high = bounds(tuple(c[k : k + TILE] for c in codes(ask)), other)
            limit = np.partition(high, most - 1, axis=1)[:, most - 1] if high.shape[1] > most else np.full(len(high), np.inf)
            u, v = np.nonzero(low <= limit[:, None])
            exact = np.concatenate([distances(asked[k + u[s : s + PAIRS]], held[v[s : s + PAIRS]]) for s in range(0, len(u), PAIRS)])
            ends = np.searchsorted(u, np.arange(len(high) + 1))
            for q in range(len(high)):
                near = slice(ends[q], ends[q + 1])
                best = heapq.nsmallest(most, ((d, i) for d, c in zip(exact[near].tolist(), v[near]) for i in ids[c]))
                out.append((ask["cls"].iloc[k + q], int(have["j"].iloc[0]), [d for d, _ in best], [i for _, i in best]))
        return pd.DataFrame(out, columns=["cls", "j", "scores", "ids"])

    return run


def _merge(most: int):
    """The ``most`` nearest rows of one query class out of several blocks' sorted lists."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        best = []
        for _, near in zip(range(most), heapq.merge(*(zip(s, i) for s, i in zip(part["scores"], part["ids"])))):
            best.append(near)
        return pd.DataFrame([(part["cls"].iloc[0], int(part["j"].iloc[0]), [d for d, _ in best], [i for _, i in best])], columns=["cls", "j", "scores", "ids"])

    return run


def nearest(vectors: DataFrame, is_query: Column, neighbours: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), the neighbour's id and score (distance): the nearest other rows of every row with ``is_query``."""
    spark = vectors.sparkSession
    ship_code(spark)
    dim, most = width(vectors, vector_col), neighbours + 1
    rows = stage(_rows(vectors, id_col, vector_col, is_query, dim), "vectors")
    kind = rows.schema["_id"].dataType.simpleString()
    # Row numbers up to a limit are cut within each task before the shuffle, so that a crowded class moves few rows.
    first = rows.withColumn("_r", F.row_number().over(Window.partitionBy("cls").orderBy("_id"))).where(F.col("_r") <= most)
    classes = first.groupBy("cls").agg(F.array_sort(F.collect_list("_id")).alias("ids"), F.min("vec").alias("vec"))
    classes = stage(_tiles(classes, dim), "classes")
    asking = stage(rows.where("query").select("cls").distinct(), "asking")
    n, m = classes.count(), asking.count()
    lanes = 4 * spark.sparkContext.defaultParallelism
    block = max(LEAST, min(MOST, BYTES // max(1, 9 * dim), math.ceil(n / lanes)))
    down, across = max(1, math.ceil(m / block)), max(1, math.ceil(n / block))

    deal = lambda blocks: F.pmod(F.xxhash64("cls"), F.lit(blocks)).cast("int")
    spread = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    asks = classes.join(asking, "cls", "left_semi").withColumn("ids", F.array().cast(f"array<{kind}>"))
    asks = asks.select("*", F.lit(True).alias("asks"), deal(down).alias("i")).withColumn("j", spread(across))
    have = classes.select("*", F.lit(False).alias("asks"), deal(across).alias("j")).withColumn("i", spread(down))
    schema = f"cls binary, j int, scores array<double>, ids array<{kind}>"
    found = asks.unionByName(have).groupBy("i", "j").applyInPandas(_search(dim, most), schema)
    if across > MERGE:
        found = found.withColumn("g", F.floor(F.col("j") / MERGE)).groupBy("cls", "g").applyInPandas(_merge(most), schema)
    found = found.groupBy("cls").applyInPandas(_merge(most), schema).select("cls", F.arrays_zip("scores", "ids").alias("near"))

    out = rows.where("query").select("_id", "cls").join(stage(found, "nearest"), "cls")
    own = F.array_position("near", F.struct(F.lit(0.0).alias("scores"), F.col("_id").alias("ids")))
    out = out.withColumn("_own", own)
    out = out.withColumn("near", F.slice(F.filter("near", lambda x, k: k + 1 != F.col("_own")), 1, neighbours))
    out = out.select(F.col("_id").alias("query_id"), F.posexplode("near").alias("_k", "_near"))
    return out.select("query_id", (F.col("_k") + 1).cast("int").alias("rank"), F.col("_near.ids").alias(id_col), F.col("_near.scores").alias("score"))
