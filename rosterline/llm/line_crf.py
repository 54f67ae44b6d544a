"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own features and those of its two neighbours.  Forward-backward gives each
line's marginal probability of being good; a document's score is their mean, weighted by line length.

The field is fitted on a bounded sample of labelled documents (``sample`` of them, the smallest by a hash of the id),
whose lines take the document's label.  Scores read the text alone.  Null texts count as empty: one empty line, which
is scored like any other.  Rows with equal or null ids each get their own row, documents with several labels count by
their mean, an empty table gives an empty result, without labels every score is 0.5, and other columns pass
through (those named like added ones are replaced).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import others, ship_code, text_of
from .minhash import word_hashes

#: Labelled documents that the field is fitted on, at most.
SAMPLE = 4000
#: Lines per chain in fitting; longer documents give several chains.
CHAIN = 64
#: Documents are scored together until they hold this many bytes.
TOGETHER = 1 << 20
STEPS = 150
RIDGE = 1e-3
#: A document is good from this score on.
GOOD = 0.3

OWN = 16
WIDTH = 3 * OWN + 2
LETTER, UPPER, DIGIT, SPACE, SENTENCE, BAR, SYMBOL, HIGH = range(8)


def _classes() -> np.ndarray:
    kind = np.full(256, SYMBOL, np.int64)
    kind[ord("a") : ord("z") + 1] = LETTER
    kind[ord("A") : ord("Z") + 1] = UPPER
    kind[ord("0") : ord("9") + 1] = DIGIT
    kind[[9, 10, 11, 12, 13, 32]] = SPACE
    kind[list(b".,;:'\"-?()")] = SENTENCE
    kind[ord("|")] = BAR
    kind[128:] = HIGH
    return kind


KINDS = _classes()


def line_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the lines of UTF-8 bytes; an empty text is one empty line."""
    cuts = np.flatnonzero(data == 10)
    return np.concatenate(([0], cuts + 1)), np.concatenate((cuts, [len(data)]))


def line_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One row of own features per line, roughly between 0 and 1."""
    n, size = len(starts), ends - starts
    line_of = np.repeat(np.arange(n), np.diff(np.append(starts, len(data))))
    count = np.bincount(line_of * 8 + KINDS[data], minlength=8 * n).reshape(n, 8).astype(float)
    count[:-1, SPACE] -= 1  # the line break itself
    full = np.maximum(size, 1)
    letters = count[:, LETTER] + count[:, UPPER] + count[:, HIGH]
    w_start, w_end, word = word_hashes(data)
    w_line = line_of[w_start]
    words = np.bincount(w_line, minlength=n).astype(float)
    some = np.maximum(words, 1)
    per_word = lambda mask: np.bincount(w_line[mask], minlength=n) / some
    repeated = np.zeros(len(word), bool)
    repeated[1:] = (word[1:] == word[:-1]) & (w_line[1:] == w_line[:-1])
    order = np.lexsort((word, w_line))
    first = np.ones(len(word), bool)
    first[1:] = (word[order][1:] != word[order][:-1]) | (w_line[order][1:] != w_line[order][:-1])
    last_kind = KINDS[data[w_end - 1]] if len(word) else np.zeros(0, np.int64)
    out = np.empty((n, OWN))
    out[:, 0] = np.log1p(size) / 8
    out[:, 1] = count[:, UPPER] / np.maximum(letters, 1)
    out[:, 2] = np.minimum(1, count[:, SYMBOL] / full * 4)
    out[:, 3] = np.minimum(1, count[:, BAR] / full * 10)
    out[:, 4] = count[:, DIGIT] / full
    out[:, 5] = np.minimum(1, count[:, SENTENCE] / full * 10)
    out[:, 6] = letters / full
    out[:, 7] = np.minimum(2, size / some / 10)
    out[:, 8] = per_word(repeated)
    out[:, 9] = np.bincount(w_line[order][first], minlength=n) / some
    out[:, 10] = per_word(last_kind == SYMBOL)
    out[:, 11] = per_word(w_end - w_start <= 3)
    out[:, 12] = per_word(w_end - w_start >= 15)
    out[:, 13] = per_word(last_kind == SENTENCE)
    out[:, 14] = size == 0
    out[:, 15] = out[:, 9] * np.log1p(words) / 8
    return out


def chain_features(own: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Own features with those of the line before and after; zeros and a mark at a document's ends."""
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first], after[last] = 0, 0
    return np.concatenate((own, before, after, first[:, None], last[:, None]), axis=1)


def forward_backward(scores: np.ndarray, starts: np.ndarray, sizes: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginal of label 1 per line, and the expected transitions (2 x 2) over all chains.

    ``scores``: log-odds of label 1 by a line's features; ``move``: log weights of label pairs.  All chains advance
    together, the longest first, so that step t works on those that are longer than t.
    """
    node = np.stack((1 / (1 + np.exp(np.clip(scores, -30, 30))), 1 / (1 + np.exp(-np.clip(scores, -30, 30)))), axis=1)
    weight = np.exp(move - move.max())
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    many = np.searchsorted(-sizes, -np.arange(longest), side="left")  # chains longer than t
    alpha, beta = np.empty_like(node), np.ones_like(node)
    now = None
    for t in range(longest):
        at = starts[: many[t]] + t
        now = node[at] if now is None else now[: many[t]] @ weight * node[at]
        now /= now.sum(axis=1, keepdims=True)
        alpha[at] = now
    expected = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        at = starts[: many[t + 1]] + t
        ahead = node[at + 1] * beta[at + 1]
        back = ahead @ weight.T
        both = alpha[at][:, :, None] * weight[None] * ahead[:, None, :]
        expected += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        beta[at] = back / back.sum(axis=1, keepdims=True)
    joint = alpha * beta
    return joint[:, 1] / joint.sum(axis=1), expected


@dataclass
class Field:
    """weights: of the features and a constant; move: log weights of the labels of adjacent lines."""

    weights: np.ndarray
    move: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]


def fit(chains: list[tuple[np.ndarray, int]]) -> Field:
    """Maximum likelihood with a ridge, by Adam steps over all chains (features of a chain's lines, its label)."""
    if not chains:
        return Field(np.zeros(WIDTH + 1), np.zeros((2, 2)), np.zeros(WIDTH), np.ones(WIDTH))
    x = np.concatenate([c for c, _ in chains])
    sizes = np.array([len(c) for c, _ in chains])
    y = np.repeat(np.array([label for _, label in chains], float), sizes)
    starts = np.cumsum(sizes) - sizes
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-6] = 1
    field = Field(np.zeros(WIDTH + 1), np.zeros((2, 2)), mean, scale)
    z = np.concatenate(((x - mean) / scale, np.ones((len(x), 1))), axis=1)
    inside = np.ones(len(x) - 1, bool)
    inside[starts[1:] - 1] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:-1][inside].astype(int), y[1:][inside].astype(int)), 1)
    theta, m, v = np.zeros(WIDTH + 5), np.zeros(WIDTH + 5), np.zeros(WIDTH + 5)
    for step in range(1, STEPS + 1):
        p, expected = forward_backward(z @ theta[: WIDTH + 1], starts, sizes, theta[WIDTH + 1 :].reshape(2, 2))
        slope = np.concatenate((z.T @ (y - p), (seen - expected).ravel())) / len(x) - RIDGE * theta
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    field.weights, field.move = theta[: WIDTH + 1], theta[WIDTH + 1 :].reshape(2, 2)
    return field


def _lines(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features and lengths of all lines of some texts, each text's first line and number of lines."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    starts, ends = line_bounds(data)
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    first_line = np.searchsorted(starts, offsets[:-1])
    counts = np.diff(np.append(first_line, len(starts)))
    first, last = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    first[first_line], last[first_line + counts - 1] = True, True
    return chain_features(line_features(data, starts, ends), first, last), ends - starts, first_line, counts


def _together(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start = 0
    while start < len(texts):
        stop, held = start, 0
        while stop < len(texts) and (stop == start or held + len(texts[stop]) <= TOGETHER):
            held += len(texts[stop])
            stop += 1
        yield start, stop
        start = stop


def score_texts(texts: list[bytes], field: Field) -> np.ndarray:
    """Length-weighted mean marginal of each text."""
    out = np.empty(len(texts))
    for s, e in _together(texts):
        features, size, first, count = _lines(texts[s:e])
        good, _ = forward_backward(field.scores(features), first, count, field.move)
        total = np.add.reduceat(size, first).astype(float)
        weight = np.where(np.repeat(total, count) > 0, size, 1.0)
        out[s:e] = np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first)
    return np.clip(out, 0, 1)


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learned from: CRC-32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Field:
    """Fits the field on at most ``sample`` labelled documents outside the held-out fifth.

    The driver gets the features of their lines, never texts.
    """
    ship_code(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y")).where("_id is not null and _y is not null")
    known = known.where(~held_out("_id")).groupBy("_id").agg((F.avg("_y") >= 0.5).cast("int").alias("_y"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).cast("binary").alias("_text"))
    rows = rows.join(F.broadcast(known), "_id")  # at most ``sample`` rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                features, _, _, _ = _lines([batch.column("_text")[k].as_py()])
                parts = [features[i : i + CHAIN].astype("<f4").tobytes() for i in range(0, len(features), CHAIN)]
                yield pa.record_batch([pa.array([batch.column("_id")[k].as_py()] * len(parts), batch.schema.field("_id").type), pa.array(range(len(parts)), pa.int32()), pa.array([batch.column("_y")[k].as_py()] * len(parts), pa.int32()), pa.array(parts, pa.binary())], names=["_id", "part", "y", "features"])

    kind = rows.schema["_id"].dataType.simpleString()
    # of documents with very many lines, the chains with the smallest hashes: the sample stays bounded
    got = rows.select("_id", "_text", "_y").mapInArrow(run, f"_id {kind}, part int, y int, features binary")
    got = got.orderBy(F.xxhash64("_id", "part"), "_id", "part").limit(2 * sample).collect()
    return fit([(np.frombuffer(r["features"], "<f4").reshape(-1, WIDTH).astype(float), r["y"]) for r in got])


def score(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``quality_score`` and ``quality_good`` (1 from GOOD on) added."""
    ship_code(docs.sparkSession)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 1024):
                part = batch.slice(s, 1024)
                got = score_texts(part.column("_crf_text").to_pylist(), field)
                keep = [n for n in part.schema.names if n != "_crf_text"]
                yield pa.record_batch([*(part.column(n) for n in keep), pa.array(got), pa.array((got >= GOOD).astype("int32"))], names=[*keep, "_crf_score", "_crf_good"])

    numbered = docs.toDF(*(f"c{k}" for k in range(len(schema)))).withColumn("_crf_text", text_of(f"c{schema.names.index(text_col)}").cast("binary"))
    kinds = ", ".join(f"c{k} {f.dataType.simpleString()}" for k, f in enumerate(schema))
    out = numbered.mapInArrow(run, f"{kinds}, _crf_score double, _crf_good int")
    added = ["quality_score", "quality_good"]
    return out.select(*(F.col(f"c{k}").alias(n) for k, n in others(schema.names, added)), F.col("_crf_score").alias(added[0]), F.col("_crf_good").alias(added[1]))
