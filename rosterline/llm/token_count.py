"""Token counts by heap-and-linked-list byte-pair merging.

A word's symbols form a doubly linked list.  A heap holds the rank of every adjacent pair; the lowest rank is popped
and merged until no pair has a rank.  The count is the initial symbols minus the merges; no identifiers are made.

Null texts count as empty (0 tokens), rows with equal or null ids each get their own row, an empty table gives an empty
result, and further input columns are ignored.  Texts are read whole; a word of any length is merged in O(n log n).
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .common import ship_code, text_of

#: A worker remembers the counts of this many distinct chunks and then starts afresh (bounds its memory).
REMEMBERED = 700_000

#: Fixed value: the byte-level alphabet's printable stand-ins for the 256 bytes.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    others = iter(range(256, 512))
    shown = set(PRINTABLE)
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class Counter(dict):
    """chunk without white space -> its number of tokens, computed when first asked for."""

    def __init__(self, spec: str):
        super().__init__()
        j = json.loads(spec)
        vocab, end = j["model"]["vocab"], j["model"].get("end_of_word_suffix") or ""
        self.inner = [vocab[s] for s in byte_symbols()]
        self.last = [vocab[s + end] for s in byte_symbols()]
        self.table = {}
        for rank, pair in enumerate(j["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.table[vocab[a] << 20 | vocab[b]] = rank << 20 | vocab[a + b]
        split = next(p for p in j["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.special = [t["content"] for t in j["added_tokens"]]
        self.at_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))))

    def merged(self, word: bytes) -> int:
        """Tokens of one word."""
        ids = [self.inner[b] for b in word]
        ids[-1] = self.last[word[-1]]
        n, get = len(ids), self.table.get
        heap = [v << 40 | i for i in range(n - 1) if (v := get(ids[i] << 20 | ids[i + 1])) is not None]
        heapify(heap)
        after, before, merges = list(range(1, n + 1)), list(range(-1, n - 1)), 0
        ids.append(-1)
        while heap:
            item = heappop(heap)
            i, pair = item & 0xFFFFFFFFFF, item >> 40
            j = after[i]
            if ids[i] < 0 or ids[j] < 0 or get(ids[i] << 20 | ids[j]) != pair:
                continue  # one of the two has been merged with another symbol meanwhile
            merges += 1
            ids[i], ids[j] = pair & 0xFFFFF, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (v := get(ids[i] << 20 | ids[k])) is not None:
                    heappush(heap, v << 40 | i)
            if (h := before[i]) >= 0 and (v := get(ids[h] << 20 | ids[i])) is not None:
                heappush(heap, v << 40 | h)
        return n - merges

    def __missing__(self, chunk: str) -> int:
        # the library lower-cases character by character, so a final sigma gets no form of its own
        plain = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        count = sum(self.merged(w.encode("utf-8", "surrogatepass")) for w in self.words.findall(plain))
        if len(self) >= REMEMBERED:
            self.clear()
        self[chunk] = count
        return count

    def plain(self, text: str) -> int:
        chunks = regex.split(r"\s+", text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()
        return sum(map(self.__getitem__, chunks))

    def tokens(self, text: str) -> int:
        if not any(s in text for s in self.special):
            return self.plain(text)
        parts = self.at_special.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))


_COUNTERS: dict[int, Counter] = {}


def _counter(spec: str) -> Counter:
    key = hash(spec)
    if key not in _COUNTERS:
        _COUNTERS[key] = Counter(spec)
    return _COUNTERS[key]


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit of every row.  ``vocabulary``: path of a tokenizers .json with word ends.

    The vocabulary is read on the driver and broadcast; its size is fixed and doesn't depend on the data.
    """
    spark = docs.sparkSession
    ship_code(spark)
    with open(vocabulary, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(spec.value)
        for batch in batches:
            counts = [counter.tokens(t.as_py()) for t in batch.column("_text")]
            yield pa.record_batch([batch.column("_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], names=["_id", "n_bytes", "n_tokens"])

    cols = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    cols = cols.withColumn("n_bytes", F.octet_length("_text").cast("long"))
    kind = cols.schema["_id"].dataType.simpleString()
    out = cols.mapInArrow(run, f"_id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
