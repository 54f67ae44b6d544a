"""Token counts and the BPE codec against the tokenizers library."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterline.llm import bpe_codec, token_count
from rosterline.llm.queries import vocabulary

tokenizers = pytest.importorskip("tokenizers")

ODD = ["", " ", "  ", "a   b", "foo\n \nbar", "a<|endoftext|>b <|startoftext|> c", "ΑΣ ΑΣΑ", "a" * 3000, "x\0y", "The 'S thing's we'LL", "é é 🙂👍🏽 \x1c\x85", None]
ODD += ["".join(random.Random(k).choice(" \n\tabc'sSé1٣!?文🙂") for _ in range(30)) for k in range(200)]


def _library(name):
    t = tokenizers.Tokenizer.from_file(vocabulary(name))
    t.no_truncation()
    t.no_padding()
    return t


def _frame(spark):
    rows = [(k if k % 7 else None, t, "x") for k, t in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")


def test_counts(spark):
    lib = _library("word_bpe_49k.json")
    got = token_count.count_tokens(_frame(spark), vocabulary("word_bpe_49k.json"), limit=5).collect()
    want = [(k if k % 7 else None, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for k, t in enumerate(ODD)]
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == sorted((str(a), b, c) for a, b, c in want)
    assert all(r["over_limit"] == (r["n_tokens"] > 5) for r in got)


def test_round_trip(spark):
    lib = _library("byte_bpe_50k.json")
    docs = _frame(spark).withColumn("doc_id", F.monotonically_increasing_id())
    got = bpe_codec.encode(docs, vocabulary("byte_bpe_50k.json")).join(docs.select("doc_id", "text"), "doc_id").collect()
    for r in got:
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["decoded"] == lib.decode(ids, skip_special_tokens=False) == (r["text"] or "")
    assert bpe_codec.encode(docs.limit(0), vocabulary("byte_bpe_50k.json")).count() == 0


def test_codec_forgets_and_goes_on(monkeypatch):
    monkeypatch.setattr(bpe_codec, "REMEMBERED", 20)
    lib = _library("byte_bpe_50k.json")
    with open(vocabulary("byte_bpe_50k.json"), encoding="utf-8") as f:
        codec = bpe_codec.Codec(f.read())
    texts = [t or "" for t in ODD]
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == [lib.encode(t, add_special_tokens=False).ids for t in texts]
