"""Exact removal of repeated byte strings with suffix arrays, built block by block with a difference cover.

Every byte goes that lies in a string of ``length`` bytes which also starts earlier (smaller id, or earlier in the
same document).  A string may repeat only around a repeated anchor: of the 50-byte strings in each window of
``length`` bytes, the one with the smallest hash.  Equal windows have equal anchors at equal places, so windows
without a repeated anchor need no sorting.  Then:

1. anchors are counted by hash over all documents; those that occur once are dropped;
2. the windows of the others are sorted, first those of a task's own documents (which settles most copies where they
   are, so that a passage in very many documents reaches the next step once for each task), then those left, dealt
   out by anchor hash; a slice whose anchor no other slice of the block has isn't sorted there;
3. the starts that were found give the removed bytes of each document.

Sorting (``repeated``) takes one bucket of suffixes at a time.  Suffixes are sorted by their first 32 bytes; ties are
resolved by the ranks of a difference cover's sample, which are computed once for the block: for any two suffixes
there is a distance below 32 at which both are in the sample.

Texts count as UTF-8 bytes, null as empty, and are read whole.  Texts shorter than ``length`` bytes stay as they are.
Null ids come before all others; rows that share an id follow one another in the order of their text's digest.  An
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import broadcast_checked, ship_code, stage, text_of
from .minhash import mix

ANCHOR = 50
#: The cover's period and its residues: every number modulo 32 is a difference of two of them.
PERIOD, COVER = 32, (0, 1, 2, 3, 7, 11, 19)
#: Suffixes in a bucket, bytes of slices in a block of the local and of the global step (a block takes about 60 times that).
BUCKET, LOCAL, GLOBAL = 200_000, 2_000_000, 2_000_000
#: Tables of one row per document are broadcast up to this many rows and list items, else joined by sorting.
SMALL = 1_000_000
NULL_ID = -(1 << 63)


def _distances() -> np.ndarray:
    """For residues r and s, the least distance at which both r and s are in the cover."""
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True
    out = np.full((PERIOD, PERIOD), -1)
    for r in range(PERIOD):
        for s in range(PERIOD):
            out[r, s] = next(d for d in range(PERIOD) if cover[(r + d) % PERIOD] and cover[(s + d) % PERIOD])
    return out


DISTANCE = _distances()


def _words(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes at each place as a number that sorts like them; ``text``: bytes, or these numbers at all places."""
    if text.dtype == np.uint64:
        return text[at]
    return np.lib.stride_tricks.sliding_window_view(text, 8)[at].view(">u8").ravel().astype(np.uint64)


def _all_words(text: np.ndarray) -> np.ndarray:
    two = text.astype(np.uint16)
    two = two[:-1] << np.uint16(8) | two[1:]
    four = two.astype(np.uint32)
    four = four[:-2] << np.uint32(16) | four[2:]
    eight = four.astype(np.uint64)
    return eight[:-4] << np.uint64(32) | eight[4:]


def _open(new: np.ndarray) -> np.ndarray:
    """Whether each row is one of several equal ones; ``new``: whether it differs from the row before."""
    out = ~new
    out[:-1] |= out[1:]
    return out


def _refine(order: np.ndarray, new: np.ndarray, keys: list[Callable[[np.ndarray], np.ndarray]]) -> None:
    """Sorts runs of equal rows by further keys, each of which gives the values of the rows that are still tied.

    Changes ``order`` and ``new`` (whether a row in this order differs from the one before).
    """
    for key in keys:
        places = np.flatnonzero(_open(new))
        if not len(places):
            return
        rows = order[places]
        value, run = key(rows), np.cumsum(new[places])
        differs = np.append(False, value[1:] != value[:-1]) & ~new[places]
        if not differs.any():
            continue
        mixed = np.zeros(run[-1] + 1, bool)
        mixed[run[differs]] = True
        at = np.flatnonzero(mixed[run])
        by = at[np.lexsort((value[at], run[at]))]
        order[places[at]], value[at] = rows[by], value[by]
        new[places[1:]] |= value[1:] != value[:-1]


def cover_ranks(text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the cover's sample in the first ``size`` bytes, and their ranks by their next 128 bytes.

    Ranks by 32 bytes are doubled twice: a sample's successor at distance 32 is in the sample as well.
    """
    residue = np.zeros(PERIOD, bool)
    residue[list(COVER)] = True
    places = np.flatnonzero(np.tile(residue, size // PERIOD + 1)[:size])
    first = _words(text, places)
    order = np.argsort(first)
    new = np.append(True, first[order][1:] != first[order][:-1])[: len(order)]
    _refine(order, new, [lambda rows, j=j: _words(text, places[rows] + j) for j in range(8, PERIOD, 8)])
    rank = np.empty(len(order), np.int64)
    per = len(COVER)  # the sample's next row at distance 32 is this many rows on
    for step in (per, 2 * per):
        rank[order] = np.cumsum(new) - 1
        ahead = np.concatenate((rank[step:] + 1, np.zeros(min(step, len(rank)), np.int64)))[: len(rank)]
        _refine(order, new, [lambda rows, ahead=ahead: ahead[rows]])
    rank[order] = np.cumsum(new) - 1
    return places, rank


def sort_bucket(text: np.ndarray, at: np.ndarray, rank_at: np.ndarray, fresh: np.ndarray | None = None) -> np.ndarray:
    """The order of the suffixes that start at ``at``; ``rank_at``: the sample's ranks by place, -1 elsewhere.

    ``fresh``: where smaller buckets begin, which stay apart and in this order.
    """
    order, new = np.arange(len(at)), np.arange(len(at)) == 0 if fresh is None else fresh.copy()
    new[:1] = True
    _refine(order, new, [lambda rows, j=j: _words(text, at[rows] + j) for j in range(0, PERIOD, 8)])
    many = _open(new)
    open_, group = order[many], np.cumsum(new)[many]  # suffixes that share their first 32 bytes with others, by group
    if not len(open_):
        return order
    residue = at[open_] % PERIOD
    # within a residue, the sample's ranks at one distance decide
    rank = rank_at[at[open_] + DISTANCE[residue, residue]].astype(np.int64)
    by = np.lexsort((rank, residue, group))
    open_, group, residue, rank = open_[by], group[by], residue[by], rank[by]
    head = np.append(True, (group[1:] != group[:-1]) | (residue[1:] != residue[:-1]))
    differs = head | np.append(True, rank[1:] != rank[:-1])
    n = np.arange(len(open_))
    place = np.maximum.accumulate(np.where(differs, n, 0)) - np.maximum.accumulate(np.where(head, n, 0))
    # across residues, count the suffixes of other residues of the group that come before
    new_group = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    mixed = np.repeat(np.add.reduceat(head.astype(int), new_group) > 1, np.diff(np.append(new_group, len(group))))
    if mixed.any():
        top, across = int(rank_at.max()) + 2, np.flatnonzero(mixed)
        by_residue = {r: across[residue[across] == r] for r in np.unique(residue[across]).tolist()}
        for r, one in by_residue.items():
            for t, other in by_residue.items():
                if r == t:
                    continue
                a, b = one[np.isin(group[one], group[other])], other[np.isin(group[other], group[one])]
                if len(a):
                    key_a, key_b = (group[x] * top + rank_at[at[open_[x]] + DISTANCE[r, t]] for x in (a, b))
                    key_a.sort()
                    place[b] += np.searchsorted(key_a, key_b, side="left") - np.searchsorted(key_a, group[b] * top, side="left")
    order[many] = open_[np.lexsort((place, group))]
    return order


def repeated(text: np.ndarray, at: np.ndarray, bucket: np.ndarray, age: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` bytes at each place also stand at a place of smaller ``age``.

    Equal strings have equal ``bucket`` values; a block takes whole buckets until it holds BUCKET suffixes.
    """
    out = np.zeros(len(at), bool)
    if not len(at):
        return out
    size = len(text) + 32
    text = _all_words(np.concatenate((text, np.zeros(256, np.uint8))))
    places, ranks = cover_ranks(text, size)
    rank_at = np.full(size + PERIOD, -1, np.int32)
    rank_at[places] = ranks
    by = np.argsort(bucket, kind="stable")
    fresh = np.append(True, bucket[by][1:] != bucket[by][:-1])
    edges = np.flatnonzero(fresh)
    ends, start = np.append(edges[1:], len(by)), 0
    while start < len(by):
        stop = ends[np.searchsorted(ends, min(start + BUCKET, len(by)), side="right") - 1] if ends[np.searchsorted(ends, start, side="right")] <= start + BUCKET else ends[np.searchsorted(ends, start, side="right")]
        part = by[start:stop]
        part = part[sort_bucket(text, at[part], rank_at, fresh[start:stop])]
        same = ~fresh[start + 1 : stop]  # smaller buckets stayed in their order
        x, y = at[part[:-1]], at[part[1:]]
        left = np.flatnonzero(same)
        for j in [*range(0, length - 7, 8), length - 8]:
            left = left[_words(text, x[left] + j) == _words(text, y[left] + j)]
        same = np.zeros(len(same), bool)
        same[left] = True
        group = np.cumsum(np.append(True, ~same)) - 1
        least = np.minimum.reduceat(age[part], np.flatnonzero(np.append(True, ~same)))
        out[part] = age[part] > least[group]
        start = stop
    return out


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each anchor, first window that it stands for, how many windows it stands for, and its own place."""
    windows = len(data) - length + 1
    if windows < 1:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    x = _BYTES[data]
    for step in (1, 2, 4, 8, 16):
        x = x[:-step] * np.uint64(pow(0x9E3779B97F4A7C15, step, 1 << 64)) + x[step:]
    rest = ANCHOR - 32
    h = mix(x[: len(x) - rest] * np.uint64(0xD6E8FEB86659FD93) + x[rest:])
    least = (h >> np.uint64(28)) << np.uint64(28) | np.arange(len(h), dtype=np.uint64)  # the leftmost of equals
    wide, done = length - ANCHOR + 1, 1
    while done * 2 <= wide:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if wide > done:
        least = np.minimum(least[: windows], least[wide - done : wide - done + windows])
    where = (least[:windows] & np.uint64((1 << 28) - 1)).astype(np.int64)
    first = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
    return h[where[first]], first, np.diff(np.append(first, windows)), where[first]


_PADS = [bytes(n) for n in range(PERIOD)]
_BYTES = np.random.default_rng(57).integers(1, 1 << 63, 256, dtype=np.uint64)
#: Longer texts are read for anchors in parts of this many windows (places have 28 bits).
PART = 1 << 22


def _all_anchors(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, out = np.frombuffer(text, np.uint8), []
    for s in range(0, max(1, len(data) - length + 1), PART):
        h, first, n, place = anchors(data[s : s + PART + length - 1], length)
        out.append((h, first + s, n, place + s))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _shared(hashes: np.ndarray) -> np.ndarray:
    """Whether another slice has the same anchor; windows of the others repeat nothing here and need no sorting."""
    _, which, many = np.unique(hashes, return_inverse=True, return_counts=True)
    return many[which] > 1


def _windows(k: np.ndarray, seq: np.ndarray, start: np.ndarray, count: np.ndarray, place: np.ndarray, hashes: np.ndarray, texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Sorts the windows of slices: document, start, number of windows, place and hash of the anchor, and text of each.

    Per window: row, start, whether repeated.  Slices are laid out so that anchors stand at multiples of PERIOD; so
    equal windows mostly have the same residue.
    """
    parts, offsets, size = [], np.empty(len(texts), np.int64), 0
    for i, (t, ahead) in enumerate(zip(texts, (place - start).tolist(), strict=True)):
        pad = -(size + ahead) % PERIOD
        parts += (_PADS[pad], t)
        offsets[i] = size + pad
        size += pad + len(t)
    text = np.frombuffer(b"".join(parts), np.uint8)
    row = np.repeat(np.arange(len(texts)), count)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(offsets, count) + inside
    begins = start[row] + inside
    # windows at the same distance from equal anchors may be equal: these are the buckets
    bucket = (mix(hashes.view(np.uint64)[row] + (place[row] - begins).astype(np.uint64))).view(np.int64)
    # a document's slices hold different windows, so these are as old as their slices
    order = np.lexsort((start, seq, k))
    before = np.empty(len(order), np.int64)
    before[order] = np.cumsum(count[order]) - count[order]
    age = before[row] + inside
    return row, begins, repeated(text, at, bucket, age, length)


def _runs(row: np.ndarray, begins: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and count of the runs of marked windows."""
    row, begins = row[mask], begins[mask]
    if not len(row):
        return row, begins, row
    new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (begins[1:] != begins[:-1] + 1)))
    return row[new], begins[new], np.diff(np.append(new, len(row)))


_MARK = "k bigint, seq int, start bigint, n bigint"


def _settle_locally(length: int):
    """Of documents with their repeated anchors: runs of repeated windows, and slices of the windows left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, most = 0, LOCAL // (2 * length)
        for batch in batches:
            for k, seq, text, found in zip(*(batch.column(c) for c in ("k", "seq", "text", "found")), strict=True):
                whole = text.as_py()
                for s in range(0, len(found.values), most):  # a document's anchors may go to several blocks
                    held.append((k.as_py(), seq.as_py(), whole, found.values.slice(s, most)))
                    size += len(held[-1][3])
                    if size >= most:
                        yield settle(held)
                        held, size = [], 0
        if held:
            yield settle(held)

    def settle(held: list[tuple]) -> pa.RecordBatch:
        many = [len(found) for *_, found in held]
        k, seq = (np.repeat(np.array(c, np.int64), many) for c in list(zip(*held, strict=True))[:2])
        h, start, count, place = (np.concatenate([found.field(c).to_numpy(zero_copy_only=False) for *_, found in held]) for c in ("h", "start", "n", "place"))
        ends, doc = (start + count + length - 1).tolist(), np.repeat(np.arange(len(held)), many).tolist()
        texts = [held[d][2][a:b] for d, a, b in zip(doc, start.tolist(), ends, strict=True)]
        shared = _shared(h)
        at, alone = np.flatnonzero(shared), np.flatnonzero(~shared)
        row, begins, twice = _windows(k[at], seq[at], start[at], count[at], place[at], h[at], [texts[i] for i in at.tolist()], length)
        r, s, n = _runs(row, begins, twice)
        r2, s2, n2 = _runs(row, begins, ~twice)
        ahead = s2 - start[at][r2]
        cut = [texts[i][a : a + c + length - 1] for i, a, c in zip(at[r2].tolist(), ahead.tolist(), n2.tolist(), strict=True)]
        slices = [None] * len(r) + cut + [texts[i] for i in alone.tolist()]
        both = np.concatenate((at[r], at[r2], alone))
        starts, counts = np.concatenate((s, s2, start[alone])), np.concatenate((n, n2, count[alone]))
        return pa.record_batch(
            [pa.array(k[both]), pa.array(seq[both].astype(np.int32)), pa.array(starts), pa.array(counts), pa.array(place[both]), pa.array(h[both]), pa.array(slices, pa.binary())],
            names=["k", "seq", "start", "n", "place", "h", "slice"],
        )

    return run


def _settle_bucket(length: int):
    """Of the slices of a bucket of anchors: runs of repeated windows."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part[_shared(part["h"].to_numpy())]
        k, seq, start, count, place, h = (part[c].to_numpy().astype(np.int64) for c in ("k", "seq", "start", "n", "place", "h"))
        row, begins, twice = _windows(k, seq, start, count, place, h, part["slice"].tolist(), length)
        r, s, n = _runs(row, begins, twice)
        return pd.DataFrame({"k": k[r], "seq": seq[r].astype(np.int32), "start": s, "n": n})

    return run


def _cut(length: int):
    """id, whole and kept bytes and removed runs of each document, from the starts of its repeated windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, found in zip(batch.column("text"), batch.column("found"), strict=True):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                edge = np.zeros(len(data) + 1, np.int64)
                if found.is_valid:
                    start, n = (found.values.field(c).to_numpy(zero_copy_only=False) for c in ("start", "n"))
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + n + length - 1, -1)
                gone = np.cumsum(edge)[:-1] > 0
                spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                out.append((len(data), int(gone.sum()), spans, data[~gone].tobytes()))
            cols = [pa.array(c) for c in list(zip(*out, strict=True))] if out else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())]
            yield pa.record_batch([batch.column("k"), *cols], names=["k", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """id, n_bytes, n_removed, n_spans (maximal removed runs) and kept (the other bytes) of every row.

    ``length``: ANCHOR to ANCHOR + 62 bytes (an anchor's windows and distance are numbers below 64), else a ValueError.
    """
    if not ANCHOR <= length <= ANCHOR + 62:
        raise ValueError(f"length {length} isn't in {ANCHOR} to {ANCHOR + 62}")
    ship_code(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("k"), text_of(text_col).cast("binary").alias("text"))
    if rows.groupBy("k").count().where("count > 1").isEmpty():
        rows = rows.withColumn("seq", F.lit(0))
    else:
        rows = stage(rows.withColumn("seq", F.row_number().over(Window.partitionBy("k").orderBy(F.sha2("text", 256)))), "rows")
    # whole copies: all bytes of all but the first go
    digests = stage(rows.select("k", "seq", F.sha2("text", 256).alias("digest"), F.octet_length("text").cast("long").alias("size")).where(F.col("size") >= length), "digests")
    firsts = digests.groupBy("digest").agg(F.min(F.struct("k", "seq")).alias("f"), F.count("*").alias("c")).where("c > 1").select("digest", "f")
    copies = digests.join(stage(firsts, "firsts"), "digest").where(F.struct("k", "seq") != F.col("f"))
    copies = stage(copies.select("k", "seq", F.lit(0).cast("long").alias("start"), (F.col("size") - length + 1).alias("n")), "copies")
    single = rows.where(F.octet_length("text") >= length).join(broadcast_checked(copies.select("k", "seq"), SMALL), ["k", "seq"], "left_anti")

    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                got = [_all_anchors(t.as_buffer(), length) for t in part.column("text")]
                many = np.array([len(x[0]) for x in got])
                h, start, n, place = (np.concatenate(c) for c in zip(*got, strict=True))
                which = pa.array(np.repeat(np.arange(part.num_rows), many))
                yield pa.record_batch([part.column("k").take(which), part.column("seq").take(which), pa.array(h.view(np.int64)), pa.array(start), pa.array(n), pa.array(place)], names=["k", "seq", "h", "start", "n", "place"])

    every = single.select("k", "seq", "text").mapInArrow(anchored, "k bigint, seq int, h bigint, start bigint, n bigint, place bigint")
    often = stage(every.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h"), "repeated-anchors")
    # n and the anchor's distance from start are below 64: one number for the shuffle
    packed = every.select("k", "seq", "h", (F.shiftleft("start", 12) + F.shiftleft("n", 6) + F.col("place") - F.col("start")).alias("w"))
    found = packed.join(often, "h").select("k", "seq", "h", F.shiftright("w", 12).alias("start"), F.shiftright("w", 6).bitwiseAND(F.lit(63)).alias("n"), F.col("w").bitwiseAND(F.lit(63)).alias("d"))
    found = found.groupBy("k", "seq").agg(F.collect_list(F.struct("h", "start", F.col("n").cast("long").alias("n"), (F.col("start") + F.col("d")).alias("place"))).alias("found"))
    found = stage(found, "found")

    local = single.join(_checked(found), ["k", "seq"]).select("k", "seq", "text", "found")
    local = stage(local.mapInArrow(_settle_locally(length), f"{_MARK}, place bigint, h bigint, slice binary"), "local")
    left = local.where("slice is not null")
    # blocks of at most about GLOBAL bytes, and enough of them for all tasks
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(4 * tasks, (left.agg(F.sum(F.octet_length("slice"))).first()[0] or 0) // GLOBAL)
    dealt = left.withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(blocks)))
    marks = dealt.groupBy("bucket").applyInPandas(_settle_bucket(length), _MARK)
    marks = stage(local.where("slice is null").select("k", "seq", "start", "n").union(marks).union(copies), "marks")

    starts = stage(marks.groupBy("k", "seq").agg(F.collect_list(F.struct("start", "n")).alias("found")), "starts")
    out = rows.join(_checked(starts), ["k", "seq"], "left").select("k", "text", "found")
    out = out.mapInArrow(_cut(length), "k bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    id_ = F.when(F.col("k") != NULL_ID, F.col("k")).cast(docs.schema[id_col].dataType)
    return out.select(id_.alias(id_col), "n_bytes", "n_removed", "n_spans", "kept")


def _checked(lists: DataFrame) -> DataFrame:
    """``lists`` marked for broadcast if rows and list items are few (counted first)."""
    items = lists.agg(F.sum(F.size("found"))).first()[0] or 0
    return F.broadcast(lists) if items <= SMALL else lists
