"""Near-duplicate documents by HyperMinHash: compressed registers, banding, collision-corrected estimate, exact check.

A document's shingles are hashed once to 64 bits.  The first bits choose one of 128 buckets; a bucket's register holds
the leading zeros and ten mantissa bits of its smallest hash (16 bits in all).  Documents with equal sets fall into
one class, of which the smallest id goes on.  Bands of five registers (empty ones filled from the next) propose pairs,
the registers estimate their Jaccard similarity, corrected for chance collisions, and pairs near or above the
threshold are checked on the full sets.

Linking is done in two passes, so that a large group of copies never becomes all its pairs:
1. every class is compared with the smallest class of each of its band groups, which settles most groups;
2. in band groups that still hold several components, blocks of registers give a forest of the pairs of different
   components that may be linked; within its trees such pairs are compared on full sets, block by block, until joined.

Null or empty texts have no shingles and link with nothing.  Rows that share an id are one node, linked by any of its
texts; rows with a null id link with nothing and are kept.  Further columns pass through untouched.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import broadcast_checked, dealt, ship_code, stage, text_of
from .components import components

BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
BAND = 5
BANDS = BUCKETS // BAND
EMPTY = 0xFFFF
#: Pairs whose estimate lies this far below the threshold (five standard errors of 128 registers) aren't checked.
MARGIN = 0.16
#: Ids whose sets are needed are broadcast up to this many (about 60 bytes each), else joined by sorting.
HEADS = 500_000
#: Classes per block in the second pass; a task holds two blocks.
BLOCK = 256

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes."""
    h = (h ^ (h >> _S)) * _M1
    h = (h ^ (h >> _S)) * _M2
    return h ^ (h >> _S)


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random values of the bytes (A-Z as a-z), which bytes are white space, and odd factors."""
    rnd = np.random.default_rng(20)
    byte = rnd.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    upper = np.arange(256)
    upper[65:91] += 32
    space = np.zeros(256, bool)
    space[[32, 9, 10, 11, 12, 13]] = True
    return byte[upper], space, rnd.integers(1, 1 << 63, 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@functools.cache
def _powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """base**k and base**-k modulo 2**64 for k below 2**bits."""
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        p = np.ones(1, np.uint64)
        for k in range(bits):
            p = np.concatenate((p, p * np.uint64(pow(b, 1 << k, 1 << 64))))
        out.append(p)
    return out[0], out[1]


def word_hashes(data: np.ndarray, part: int = 1 << 18) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words of UTF-8 bytes; A-Z count as a-z.

    Long inputs are read in parts that end at white space, which bounds the memory.
    """
    if len(data) <= part:
        return _word_hashes(data)
    space, out, start = _tables()[1], [], 0
    while start < len(data):
        stop = min(len(data), start + part)
        while stop < len(data) and not space[data[stop]]:
            ahead = np.flatnonzero(space[data[stop : stop + part]])
            stop = stop + int(ahead[0]) if len(ahead) else min(len(data), stop + part)
        s, e, h = _word_hashes(data[start:stop])
        out.append((s + start, e + start, h))
        start = stop
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values, space, _ = _tables()
    gap = space[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64)
    power, back = _powers(0x9E3779B97F4A7C15, max(1, int(len(data)).bit_length()))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values[data] * power[: len(data)], dtype=np.uint64)))
    return starts, ends, mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; the whole sequence where there are fewer words than ``size``."""
    words = word_hashes(np.frombuffer(text, np.uint8))[2]
    if not len(words):
        return words
    n = max(1, len(words) - size + 1)
    factors = _tables()[2]
    total = np.full(n, np.uint64(min(len(words), size)))
    for k in range(min(size, len(words))):
        total = total * factors[0] + words[k : k + n]
    return np.unique(mix(total))


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 128 registers per set."""
    lows = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS)
    least = np.full((len(sets), BUCKETS), np.uint64(0))
    has = np.zeros((len(sets), BUCKETS), bool)
    for k, s in enumerate(sets):
        if len(s):
            at = np.searchsorted(s, lows)
            upto = np.append(at[1:], len(s))
            has[k] = at < upto
            least[k] = s[np.minimum(at, len(s) - 1)]
    rest = least << np.uint64(BUCKET_BITS) | np.uint64(1)  # the bits after the bucket's, never zero
    part, exponent = np.frexp(rest.astype(np.float64))
    zeros = np.clip(64 - exponent, 0, 62)
    mantissa = ((part * 2 - 1) * (1 << MANTISSA_BITS)).astype(np.int64) & ((1 << MANTISSA_BITS) - 1)
    return np.where(has, zeros << MANTISSA_BITS | mantissa, EMPTY).astype("<u2")


def band_keys(regs: np.ndarray) -> np.ndarray:
    """64-bit keys of the bands; empty registers take the next filled one and its distance."""
    n = len(regs)
    twice = np.concatenate((regs, regs), axis=1).astype(np.uint64)
    where = np.where(twice != EMPTY, np.arange(2 * BUCKETS), 4 * BUCKETS)
    nearest = np.minimum.accumulate(where[:, ::-1], axis=1)[:, ::-1][:, :BUCKETS]
    filled = np.take_along_axis(twice, np.minimum(nearest, 2 * BUCKETS - 1), axis=1)
    filled = filled + ((nearest - np.arange(BUCKETS)).astype(np.uint64) << np.uint64(16))
    grouped = filled[:, : BANDS * BAND].reshape(n, BANDS, BAND)
    total = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (n, BANDS)).copy()
    for k in range(BAND):
        total = mix(total * _tables()[2][1] + grouped[:, :, k])
    return total.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from registers, corrected for chance collisions of compressed registers."""
    either = ((a != EMPTY) | (b != EMPTY)).sum(axis=-1)
    same = ((a == b) & (a != EMPTY)).sum(axis=-1)
    both = ((a != EMPTY) & (b != EMPTY)).sum(axis=-1)
    x, y = size_a.astype(float), size_b.astype(float)
    chance = both * 0.17 * 2.0**-MANTISSA_BITS * 4 * x * y / np.maximum(1.0, (x + y) ** 2)
    return (same - chance) / np.maximum(1, either - chance)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union of two sorted sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """_id, n_shingles, set_hash, regs (128 registers) and bands of every row; set_hash is null without shingles."""
    ship_code(docs.sparkSession)
    # a set of n shingles and a different one have at most n / (n + 1) in common; sets that can't reach the threshold
    # so need no bands
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 1024):
                part = batch.slice(s, 1024)
                sets = [shingle_set(t.as_buffer(), size) for t in part.column("_text")]
                regs = registers(sets)
                keys = band_keys(regs)
                yield pa.record_batch(
                    [
                        part.column("_id"),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets], pa.binary()),
                        pa.array([r.tobytes() if len(x) else None for r, x in zip(regs, sets, strict=True)], pa.binary()),
                        pa.array([k if len(x) and 100 * len(x) >= percent * (len(x) + 1) else [] for k, x in zip(keys, sets, strict=True)], pa.list_(pa.int64())),
                    ],
                    names=["_id", "n_shingles", "set_hash", "regs", "bands"],
                )

    cols = docs.select(F.col(id_col).alias("_id"), text_of(text_col).cast("binary").alias("_text"))
    kind = cols.schema["_id"].dataType.simpleString()
    return cols.mapInArrow(run, f"_id {kind}, n_shingles long, set_hash binary, regs binary, bands array<bigint>")


def _sets_of(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """_id, set_hash, set (hashes as binary) of the class heads ``ids`` (_id, set_hash)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                sets = [shingle_set(t.as_buffer(), size).tobytes() for t in part.column("_text")]
                right = [hashlib.blake2b(x, digest_size=16).digest() == h.as_py() for x, h in zip(sets, part.column("set_hash"), strict=True)]
                yield pa.record_batch([part.column("_id"), part.column("set_hash"), pa.array(sets, pa.binary())], names=["_id", "set_hash", "set"]).filter(pa.array(right, pa.bool_()))

    texts = docs.select(F.col(id_col).alias("_id"), text_of(text_col).cast("binary").alias("_text"))
    cols = texts.join(broadcast_checked(ids.select("_id", "set_hash"), HEADS), "_id")
    kind = cols.schema["_id"].dataType.simpleString()
    return cols.mapInArrow(run, f"_id {kind}, set_hash binary, set binary")


def _near(parts: pd.DataFrame, percent: int) -> np.ndarray:
    """Whether the registers of ru, rv allow the threshold."""
    stack = lambda c: np.stack([np.frombuffer(x, "<u2") for x in parts[c]]) if len(parts) else np.zeros((0, BUCKETS))
    return estimate(stack("ru"), stack("rv"), parts["nu"].to_numpy(), parts["nv"].to_numpy()) >= percent / 100 - MARGIN


def _side(t: DataFrame, x: str, *cols: tuple[str, str]) -> DataFrame:
    return t.select(F.col("_id").alias(x), *(F.col(a).alias(b) for a, b in cols))


def _close(pairs: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """The pairs u, v whose registers allow the threshold."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            yield part.loc[_near(part, percent), ["u", "v"]]

    kind = pairs.schema["u"].dataType.simpleString()
    regs = pairs.join(_side(heads, "u", ("regs", "ru"), ("n_shingles", "nu")), "u").join(_side(heads, "v", ("regs", "rv"), ("n_shingles", "nv")), "v")
    return regs.mapInPandas(run, f"u {kind}, v {kind}")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs u, v whose full sets reach the threshold."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            yes = [similar(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent) for a, b in zip(part["su"], part["sv"], strict=True)]
            yield part.loc[yes, ["u", "v"]]

    kind = pairs.schema["u"].dataType.simpleString()
    held = pairs.join(_side(sets, "u", ("set", "su")), "u").join(_side(sets, "v", ("set", "sv")), "v")
    return held.mapInPandas(run, f"u {kind}, v {kind}")


def _forest(percent: int):
    """For a block pair of a band group: a forest of the pairs of different components that the registers allow."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        found, root = [], _Joined()
        for a, b, _ in _cross_pairs(part, percent):
            x, y = root.of(part["_id"].iloc[a]), root.of(part["_id"].iloc[b])
            if x != y:
                root.join(x, y)
                found.append((part["_id"].iloc[a], part["_id"].iloc[b]))
        return pd.DataFrame(found, columns=["u", "v"])

    return run


class _Joined:
    """Disjoint sets."""

    def __init__(self):
        self.parent = {}

    def of(self, x):
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = x = self.parent.get(up, up)
        return x

    def join(self, x, y):
        self.parent[max(x, y)] = min(x, y)


def _cross_pairs(part: pd.DataFrame, percent: int) -> Iterator[tuple[int, int, float]]:
    """Row numbers and estimates of the pairs of a block pair that lie in different components and may be linked."""
    block, comp, sizes = part["block"].to_numpy(), part["comp"].to_numpy(), part["n_shingles"].to_numpy()
    first, second = part["i"].iloc[0], part["j"].iloc[0]
    regs = np.stack([np.frombuffer(x, "<u2") for x in part["regs"]])
    rows, cols = np.flatnonzero(block == first), np.flatnonzero(block == second)
    for r in rows.tolist():
        other = cols[cols > r] if first == second else cols
        other = other[comp[other] != comp[r]]
        other = other[100 * np.minimum(sizes[other], sizes[r]) >= percent * np.maximum(sizes[other], sizes[r])]
        if len(other):
            guess = estimate(regs[r][None, :], regs[other], sizes[r : r + 1], sizes[other])
            for o, g in zip(other.tolist(), guess.tolist(), strict=True):
                if g >= percent / 100 - MARGIN:
                    yield r, o, g


def _link_block(percent: int):
    """For a block pair: joins classes of different components, best estimates first, until no unjoined pair is left."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_id", ignore_index=True)
        comp, root, found = part["comp"].tolist(), _Joined(), []
        held: dict[int, np.ndarray] = {}
        for a, b, _ in sorted(_cross_pairs(part, percent), key=lambda p: (-p[2], p[0], p[1])):
            x, y = root.of(comp[a]), root.of(comp[b])
            if x != y:
                for k in (a, b):
                    if k not in held:
                        held[k] = np.frombuffer(part["set"].iloc[k], np.uint64)
                if similar(held[a], held[b], percent):
                    root.join(x, y)
                    found.append((part["_id"].iloc[a], part["_id"].iloc[b]))
        return pd.DataFrame(found, columns=["u", "v"])

    return run


def _blocked(nodes: DataFrame, group: str, *extra: str) -> DataFrame:
    """Rows of every block pair (i, j) of each group; a row goes to as many pairs as its group has blocks."""
    blocks = stage(nodes.groupBy(group).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "blocks")
    nodes = nodes.join(blocks, group).withColumn("block", F.pmod(F.xxhash64("_id"), F.col("blocks")).cast("int"))
    spread = nodes.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return spread.select(group, "_id", *extra, "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))


def _block_links(open_: DataFrame, heads: DataFrame, sets_of, percent: int) -> DataFrame:
    """Links u, v between different components within band groups; ``open_``: key, _id, comp of groups with several."""
    kind = heads.schema["_id"].dataType.simpleString()
    schema = f"u {kind}, v {kind}"
    regs = heads.select("_id", "set_hash", "n_shingles", "regs")
    near = dealt(_blocked(open_, "key", "comp").join(regs, "_id"), "key", "i", "j").groupBy("key", "i", "j").applyInPandas(_forest(percent), schema)
    near = stage(near, "forest")
    if near.isEmpty():
        return near
    area = components(near).select(F.col("node").alias("_id"), F.col("component").alias("area"))
    nodes = near.select(F.col("u").alias("_id")).union(near.select("v")).distinct().join(area, "_id", "left")
    nodes = nodes.select("_id", F.coalesce("area", "_id").alias("area"))
    nodes = stage(nodes.join(open_.select("_id", "comp").distinct(), "_id"), "areas")
    held = _blocked(nodes, "area", "comp").join(regs, "_id").join(sets_of(nodes), ["_id", "set_hash"])
    return stage(dealt(held, "area", "i", "j").groupBy("area", "i", "j").applyInPandas(_link_block(percent), schema), "more")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """id, n_shingles, component_id (smallest id reachable by links), kept (id = component_id) of every row.

    Two documents are linked if 100 * |intersection| >= ``percent`` * |union| of their shingle sets.
    """
    rows = stage(sketches(docs, id_col, text_col, size, percent), "sketch")
    member = rows.where("_id is not null and set_hash is not null")
    heads = member.groupBy("set_hash").agg(F.min(F.struct("_id", "n_shingles", "regs", "bands")).alias("h"))
    heads = stage(heads.select("set_hash", "h.*"), "heads")

    # rows that share an id are one node: the id joins the classes of its texts, through their heads
    shared = member.groupBy("_id").agg(F.count_distinct("set_hash").alias("n")).where("n > 1").select("_id")
    by_id = member.join(shared, "_id").select(F.col("_id").alias("u"), "set_hash").join(heads.select("set_hash", F.col("_id").alias("v")), "set_hash").select("u", "v").where("u <> v")

    # one id can head several classes where rows share ids; the pairs work on ids, which is the node
    banded = heads.select("_id", F.explode("bands").alias("key"))
    # written, so that the join's sides are plain shuffles, which adaptive execution can split where a key is hot
    pivots = banded.groupBy("key").agg(F.min("_id").alias("pivot"), F.max("_id").alias("last")).where("pivot <> last").select("key", "pivot")
    pivots = stage(pivots, "pivots")
    grouped = stage(banded.join(pivots, "key"), "bands")
    pairs = stage(grouped.where("_id <> pivot").select(F.col("_id").alias("u"), F.col("pivot").alias("v")).distinct(), "pairs")
    close = stage(_close(pairs, heads, percent), "close")

    def sets_of(nodes: DataFrame) -> DataFrame:
        ids = stage(heads.join(nodes.select("_id").distinct(), "_id", "left_semi").select("_id", "set_hash"), "involved")
        return _sets_of(docs, ids, id_col, text_col, size).distinct()

    sets = stage(sets_of(close.select(F.col("u").alias("_id")).union(close.select("v"))), "sets")
    links = stage(_verified(close, sets, percent).union(by_id), "near")
    found = components(links)

    # second pass: band groups that still hold several components
    labelled = grouped.join(found.withColumnRenamed("node", "_id"), "_id", "left").withColumn("comp", F.coalesce("component", "_id"))
    # (the first pass has compared both members of a group of two)
    mixed = labelled.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), F.count("*").alias("n")).where("a <> b and n > 2")
    mixed = stage(mixed.select("key"), "mixed")
    open_ = stage(labelled.join(mixed, "key", "left_semi").select("key", "_id", "comp").distinct(), "open")
    more = _block_links(open_, heads, sets_of, percent)
    if not more.isEmpty():
        found = components(links.select("u", "v").union(more))

    final = heads.select("set_hash", F.col("_id").alias("node")).join(found, "node", "left")
    final = final.select("set_hash", F.coalesce("component", "node").alias("component_id"))
    out = rows.select("_id", "n_shingles", "set_hash").join(final, "set_hash", "left")
    # a repeated id keeps the component of its linked texts also on a row without words
    again = rows.where("_id is not null").groupBy("_id").agg(F.count("*").alias("n")).where("n > 1").select("_id")
    if not again.isEmpty():
        own = out.join(again, "_id").groupBy("_id").agg(F.min("component_id").alias("own"))
        out = out.join(own, "_id", "left").withColumn("component_id", F.coalesce("own", "component_id"))
    out = out.withColumn("component_id", F.when(F.col("_id").isNotNull(), F.coalesce("component_id", "_id")))
    return out.select(F.col("_id").alias(id_col), "n_shingles", "component_id", F.coalesce(F.col("_id") == F.col("component_id"), F.lit(True)).alias("kept"))
