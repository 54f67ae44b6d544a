"""Byte-level BPE encoding and decoding with a pair occurrence index.

All new words of a batch stand in one array of symbols.  An index maps each adjacent pair that has a rank to all its
positions in the array.  Active ranks are applied in ascending order: one step merges every live occurrence of its
pair at once and enters the pairs that this makes under their own (always higher) ranks.

Null texts count as empty (no ids), rows with equal or null ids each get their own row, an empty table gives an empty
result, and further input columns are ignored.  Texts are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .common import ship_code, text_of
from .token_count import byte_symbols

#: A worker remembers the ids of this many distinct chunks and then starts afresh (bounds its memory).
REMEMBERED = 450_000
#: Texts are indexed together until they hold this many characters.
TOGETHER = 12_000_000

#: Fixed value: the byte-level vocabulary's pattern of words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Codec:
    def __init__(self, spec: str):
        j = json.loads(spec)
        vocab = j["model"]["vocab"]
        symbols = byte_symbols()
        self.of_byte = np.array([vocab[s] for s in symbols], np.int64)
        merges = [p if isinstance(p, list) else p.split(" ") for p in j["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in merges], np.int64)
        self.right = np.array([vocab[b] for _, b in merges], np.int64)
        self.made = [vocab[a + b] for a, b in merges]
        self.left_of, self.right_of = self.left.tolist(), self.right.tolist()
        keys = self.left << 20 | self.right
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        back = {s: b for b, s in enumerate(symbols)}
        self.bytes_of = {i: bytes(back[c] for c in s) for s, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in j["added_tokens"]}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words, self.inner_space = regex.compile(WORDS), regex.compile(r"(?<=\s) (?=\s|\Z)")
        self.known: dict[str, bytes] = {}

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 without one."""
        key = a << 20 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, little-endian unsigned 32-bit."""
        data = np.frombuffer(b"".join(words), np.uint8)
        n = len(data)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        sym = np.append(self.of_byte[data], -1)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1] = n  # n: past the end of the word; sym[n] fits no pair
        before[ends - lengths] = n
        index: dict[int, list[np.ndarray]] = {}

        def enter(at: np.ndarray) -> list[int]:
            """Puts the pairs that begin at these positions into the index; the ranks that are new in it."""
            rank = self.rank_of(sym[at], sym[after[at]])
            has = rank >= 0
            if not has.any():
                return []
            at, rank = at[has], rank[has]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            starts = [0, *cuts.tolist()]
            fresh = []
            for r, s, e in zip(rank[starts].tolist(), starts, [*starts[1:], len(at)], strict=True):
                if (places := index.get(r)) is None:
                    index[r] = [at[s:e]]
                    fresh.append(r)
                else:
                    places.append(at[s:e])
            return fresh

        inside = np.flatnonzero(after[:n] < n)
        active = enter(inside) if len(inside) else []
        heapify(active)
        while active:
            r = heappop(active)
            places = index.pop(r)
            at = places[0] if len(places) == 1 else np.concatenate(places)
            a, b = self.left_of[r], self.right_of[r]
            at = at[(sym[at] == a) & (sym[after[at]] == b)]
            if not len(at):
                continue
            if a == b and len(at) > 1:  # of overlapping occurrences, every second from the left
                at = np.sort(at)
                first = np.append(True, after[at[:-1]] != at[1:])
                k = np.arange(len(at))
                at = at[(k - np.maximum.accumulate(np.where(first, k, 0))) % 2 == 0]
            gone = after[at]
            follow = after[gone]
            sym[at], sym[gone] = self.made[r], -1
            after[at] = follow
            before[follow] = at
            before[n] = n
            touched = np.concatenate((before[at], at))
            touched = touched[(touched < n)]
            touched = np.unique(touched[after[touched] < n])
            if len(touched):
                for x in enter(touched):
                    heappush(active, x)
        live = sym[:n] >= 0
        upto = np.concatenate(([0], np.cumsum(live)))
        buffer = sym[:n][live].astype("<u4").tobytes()
        stops = (upto[ends] * 4).tolist()
        return [buffer[s:e] for s, e in zip([0, *stops], stops)]

    def chunks(self, text: str) -> list[str]:
        """Pieces of a text whose words don't depend on what stands around them."""
        if "\0" in text or self.inner_space.search(text):
            return self.words.findall(text)
        return text.replace(" ", "\0 ").split("\0")

    def learn(self, chunks: set[str]) -> None:
        """Encodes chunks that aren't known yet."""
        parts = {c: self.words.findall(c) for c in chunks}
        words = list({w for p in parts.values() for w in p})
        ids = dict(zip(words, self.merge([w.encode("utf-8", "surrogatepass") for w in words]))) if words else {}
        if len(self.known) + len(parts) > REMEMBERED:
            self.known.clear()
        self.known |= {c: b"".join([ids[w] for w in p]) for c, p in parts.items()}

    def split(self, text: str) -> list[str]:
        return self.at_special.split(text) if any(s in text for s in self.special) else [text]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, little-endian unsigned 32-bit."""
        start = 0
        while start < len(texts):
            stop, held = start, 0
            while stop < len(texts) and (stop == start or held + len(texts[stop]) <= TOGETHER):
                held += len(texts[stop])
                stop += 1
            block = texts[start:stop]
            for again in (False, True):
                new: set[str] = set()
                for t in block:
                    for part in self.split(t):
                        if part not in self.special:
                            new.update(set(self.chunks(part)).difference(self.known))
                if not new:
                    break
                if again or len(self.known) + len(new) > REMEMBERED:
                    self.known.clear()
                    if not again:
                        continue  # everything was forgotten: gather the whole block's chunks
                self.learn(new)
                break
            for t in block:
                yield b"".join([self.special[p].to_bytes(4, "little") if p in self.special else b"".join(map(self.known.__getitem__, self.chunks(p))) for p in self.split(t)])
            start = stop

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_CODECS: dict[int, Codec] = {}


def _codec(spec: str) -> Codec:
    key = hash(spec)
    if key not in _CODECS:
        _CODECS[key] = Codec(spec)
    return _CODECS[key]


def _broadcast(docs: DataFrame, vocabulary: str):
    ship_code(docs.sparkSession)
    with open(vocabulary, encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def _mapped(docs: DataFrame, spec, id_col: str, text_col: str, row, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(spec.value)
        for batch in batches:
            ids, texts = batch.column("_id"), batch.column("_text")
            for s in range(0, batch.num_rows, 512):
                part = texts.slice(s, 512).to_pylist()
                cols = list(zip(*[row(codec, t, e) for t, e in zip(part, codec.encode(part), strict=True)], strict=True))
                yield pa.record_batch([ids.slice(s, 512), *map(pa.array, cols)], names=["_id", *(f"c{k}" for k in range(len(cols)))])

    cols = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    kind = cols.schema["_id"].dataType.simpleString()
    return cols.mapInArrow(run, f"_id {kind}, {schema}")


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids (array of int) and decoded text of every row.  ``vocabulary``: path of a byte-level .json."""
    spec = _broadcast(docs, vocabulary)
    row = lambda codec, t, e: (len(e) // 4, np.frombuffer(e, "<i4"), codec.decode(e))
    out = _mapped(docs, spec, id_col, text_col, row, "c0 bigint, c1 array<int>, c2 string")
    return out.select(F.col("_id").alias(id_col), F.col("c0").alias("n_tokens"), F.col("c1").alias("ids"), F.col("c2").alias("decoded"))


def encode_digest(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens and SHA-256 of the ids (little-endian unsigned 32-bit) and of the decoded text (UTF-8)."""
    spec = _broadcast(docs, vocabulary)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    row = lambda codec, t, e: (len(e) // 4, sha(e), sha(codec.decode(e).encode()))
    out = _mapped(docs, spec, id_col, text_col, row, "c0 bigint, c1 string, c2 string")
    return out.select(F.col("_id").alias(id_col), F.col("c0").alias("n_tokens"), F.col("c1").alias("ids_sha256"), F.col("c2").alias("decoded_sha256"))
