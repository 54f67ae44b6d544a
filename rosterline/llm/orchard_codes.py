"""Vector codes: each part of a vector becomes the index of its nearest codebook entry, found by Orchard's search.

Components become whole numbers floor(scale * x); vectors are cut into equal consecutive parts.  Each part's codebook
starts as that part of the first vectors by id.  A round assigns every part and replaces entries by the floor of their
parts' mean; unused entries stay.  All arithmetic is in whole numbers, so the result doesn't depend on partitions.

Orchard's search: every entry has a list of the others by distance.  From the best entry so far one walks its list; an
entry nearer to the part becomes the best one, whose list is then walked from its start; visited entries are skipped.
An entry farther than twice the part's distance from the best one can't be nearer, nor as near, so the walk ends there.
Ties go to the lower index.  A task walks all its parts in step.

Rows with a null vector, or with null or non-finite components, are left out of codebooks and result.  A shorter vector
counts as ending in zeros, up to the longest one's length and then to a multiple of the number of parts.  Null ids come
after all others; rows that share an id are ordered by their components.  With fewer rows than entries the codebooks are
smaller; without rows the result is empty.  Components of a size above 2**16 are an error.  Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import broadcast_checked, ship_code, stage
from .vectors import matrix, width

#: Labels whose sums are broadcast (16 bytes each), beyond which they are joined by sorting; rows that one task walks at a time.
LABELS, ROWS = 100_000, 8192


@dataclass
class Book:
    """One part's codebook: entries, squared distances between them, and for each the others by distance."""

    entries: np.ndarray
    apart: np.ndarray
    lists: np.ndarray

    @classmethod
    def of(cls, entries: np.ndarray) -> Book:
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        return cls(entries, apart, np.argsort(apart, axis=1, kind="stable"))


def assign(parts: np.ndarray, book: Book, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry of every row of ``parts``."""
    n, entries = len(parts), len(book.entries)
    distance = lambda who, entry: ((parts[who] - book.entries[entry]) ** 2).sum(axis=1)
    best = np.zeros(n, np.int64) if start is None else start.copy()
    least = distance(np.arange(n), best)
    seen = np.zeros((n, entries), bool)
    seen[np.arange(n), best] = True
    place = np.zeros(n, np.int64)
    walking = np.arange(n)
    while len(walking):
        at = best[walking]
        entry = book.lists[at, place[walking]]
        on = book.apart[at, entry] <= 4 * least[walking]
        walking, entry = walking[on], entry[on]
        place[walking] += 1
        new = ~seen[walking, entry]
        who, entry = walking[new], entry[new]
        seen[who, entry] = True
        d = distance(who, entry)
        nearer = (d < least[who]) | ((d == least[who]) & (entry < best[who]))
        who, entry = who[nearer], entry[nearer]
        best[who], least[who], place[who] = entry, d[nearer], 0
        walking = walking[place[walking] < entries]
    return best, least


def _whole(rows: np.ndarray, scale: float) -> np.ndarray:
    if rows.size and np.abs(rows).max() > 2.0**16:
        raise ValueError("a component is above 2**16 in size")
    return np.floor(rows * scale).astype(np.int64)


def _codes(rows: np.ndarray, books: list[Book]) -> tuple[np.ndarray, np.ndarray]:
    """Codes (a column for each part) and errors of whole rows."""
    size = rows.shape[1] // len(books)
    found = [assign(rows[:, k * size : (k + 1) * size], book) for k, book in enumerate(books)]
    return np.stack([f[0] for f in found], axis=1), sum(f[1] for f in found)


def _batches(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            piece = batch.slice(k, ROWS)
            yield piece, piece.column("vec").flatten().to_numpy().reshape(piece.num_rows, dim)


def _replaced(rows: DataFrame, books: list[Book], dim: int) -> list[np.ndarray]:
    """The codebooks after a round: sums and numbers of every entry's parts are added up in each task, then over tasks."""
    parts, size, entries = len(books), dim // len(books), len(books[0].entries)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, size), np.int64), np.zeros((parts, entries), np.int64)
        for _, whole in _batches(batches, dim):
            codes, _ = _codes(whole, books)
            for k in range(parts):
                np.add.at(sums[k], codes[:, k], whole[:, k * size : (k + 1) * size])
                counts[k] += np.bincount(codes[:, k], minlength=entries)
        part, entry = np.nonzero(counts)
        lists = pa.array(list(np.column_stack([counts[part, entry], sums[part, entry]])), pa.list_(pa.int64()))
        yield pa.record_batch([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), lists], names=["part", "entry", "totals"])

    totals = rows.mapInArrow(add, "part int, entry int, totals array<bigint>")
    totals = totals.select("part", "entry", F.posexplode("totals").alias("k", "v")).groupBy("part", "entry", "k").agg(F.sum("v").alias("v"))
    out = [book.entries.copy() for book in books]
    lists = totals.groupBy("part", "entry").agg(F.array_sort(F.collect_list(F.struct("k", "v"))).alias("t"))
    for r in lists.collect():  # one row per entry of the codebooks
        count, *sums = (t["v"] for t in r["t"])
        out[r["part"]][r["entry"]] = np.array(sums, np.int64) // count
    return out


def encode(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2, scale: float = 256.0) -> tuple[DataFrame, list[np.ndarray]]:
    """id, codes (array of indexes), error and label_error (errors summed over equal labels) of every row, and the final
    codebook of each part."""
    ship_code(vectors.sparkSession)
    dim = -(-width(vectors, vector_col) // parts) * parts

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, rows = matrix(batch.column(2), dim)
            keep = pa.array(good)
            lists = pa.array(list(_whole(rows, scale)), pa.list_(pa.int64()))
            yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep), lists], names=["_id", "_label", "vec"])

    cols = vectors.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), F.col(vector_col).cast("array<double>").alias("_vec"))
    id_type, label_type = (cols.schema[c].dataType.simpleString() for c in ("_id", "_label"))
    rows = stage(cols.mapInArrow(whole, f"_id {id_type}, _label {label_type}, vec array<bigint>"), "vectors")

    first = rows.orderBy(F.col("_id").asc_nulls_last(), "vec").limit(entries).select("vec").collect()
    start, size = np.array([r[0] for r in first], np.int64).reshape(len(first), dim), dim // parts
    books = [Book.of(start[:, k * size : (k + 1) * size]) for k in range(parts)]
    for _ in range(rounds if first else 0):
        books = [Book.of(e) for e in _replaced(rows, books, dim)]

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, whole_rows in _batches(batches, dim):
            codes, error = _codes(whole_rows, books)
            yield pa.record_batch([piece.column(0), piece.column(1), pa.array(list(codes.astype(np.int32)), pa.list_(pa.int32())), pa.array(error, pa.int64())], names=["_id", "_label", "codes", "error"])

    coded = stage(rows.mapInArrow(final, f"_id {id_type}, _label {label_type}, codes array<int>, error bigint"), "codes")
    sums = coded.groupBy(F.col("_label").alias("_l")).agg(F.sum("error").alias("label_error"))
    out = coded.join(broadcast_checked(sums, LABELS), F.col("_label").eqNullSafe(F.col("_l")))
    return out.select(F.col("_id").alias(id_col), "codes", "error", "label_error"), [b.entries for b in books]


def digest(books: list[np.ndarray]) -> str:
    """sha256 of all entries' decimal components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.reshape(-1).tolist()).encode()).hexdigest()
