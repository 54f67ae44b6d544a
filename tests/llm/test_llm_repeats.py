"""Repeated strings: the block sort against plain sorting, whole documents against a set of all strings."""

import hashlib
import random

import numpy as np
import pytest

from rosterline.llm import suffix_dedup as sd


def test_block_sort_and_repeats(monkeypatch):
    rnd = random.Random(3)
    for trial in range(12):
        base = bytes(rnd.choice(b"ab ") for _ in range(600))
        text = b"".join(base[(a := rnd.randrange(0, 400)) : a + rnd.randrange(100, 200)] + bytes([rnd.randrange(256)]) for _ in range(40))
        at = np.arange(len(text) - 99)
        at = at[np.random.default_rng(trial).random(len(at)) < 0.8]
        age = np.random.default_rng(trial + 99).permutation(len(at))
        monkeypatch.setattr(sd, "BUCKET", rnd.choice([50, 500, 10**6]))
        bucket = np.array([sum(text[p : p + 3]) % 7 for p in at])
        low = {}
        for p, a in zip(at, age):
            low[text[p : p + 100]] = min(low.get(text[p : p + 100], 1 << 60), a)
        assert (sd.repeated(np.frombuffer(text, np.uint8), at, bucket, age, 100) == [low[text[p : p + 100]] < a for p, a in zip(at, age)]).all()
        padded = np.concatenate((np.frombuffer(text, np.uint8), np.zeros(256, np.uint8)))
        places, ranks = sd.cover_ranks(padded, len(padded) - 224)
        rank_at = np.full(len(padded) + 32, -1)
        rank_at[places] = ranks
        order, b = sd.sort_bucket(padded, at, rank_at), padded.tobytes()
        keys = [b[p : p + 128] for p in at[order]]
        assert keys == sorted(keys)


def test_cover_has_every_difference():
    assert {(a - b) % sd.PERIOD for a in sd.COVER for b in sd.COVER} == set(range(sd.PERIOD))


def brute(rows, length=100):
    rows = sorted(((-(1 << 63) if i is None else i, (t or "").encode()) for i, t in rows), key=lambda r: (r[0], hashlib.sha256(r[1]).hexdigest()))
    seen, out = set(), []
    for i, b in rows:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            g = b[p : p + length]
            if g in seen:
                gone[p : p + length] = True
            seen.add(g)
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((None if i == -(1 << 63) else i, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out, key=str)


def test_documents(spark, monkeypatch):
    monkeypatch.setattr(sd, "LOCAL", 3000)
    rnd = random.Random(8)
    x = "".join(rnd.choice("abcdé🙂 ") for _ in range(300))
    rows = [(5, x), (3, x[100:]), (None, "a" * 250), (1, None), (2, ""), (2, "q" + x[:150]), (7, "ab" * 300), (7, "ab" * 300), (8, x + x), (9, "z" * 99), (10, "z" * 100), (11, "z" * 101)]
    passages = ["".join(rnd.choice("abcdefgh ") for _ in range(rnd.randrange(90, 400))) for _ in range(10)]
    rows += [(100 + k, "".join(rnd.choice("abcdefgh ") for _ in range(rnd.randrange(0, 300))) + rnd.choice(passages) + rnd.choice(passages)[rnd.randrange(50) :]) for k in range(60)]
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, k string")
    run = lambda d: sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in sd.remove_repeats(d).collect()), key=str)
    assert run(df) == brute(rows)
    assert run(df.limit(0)) == []
    for length in (sd.ANCHOR, sd.ANCHOR + 62):
        got = sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in sd.remove_repeats(df, length=length).collect()), key=str)
        assert got == brute(rows, length)
    for length in (0, sd.ANCHOR - 1, sd.ANCHOR + 63, 200):
        with pytest.raises(ValueError):
            sd.remove_repeats(df, length=length)
