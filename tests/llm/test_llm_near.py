"""Near-duplicates of texts and vectors against brute force."""

import collections
import random
import re

import numpy as np
import pytest

from rosterline.llm import components, embedding_dedup, minhash


def joined(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def brute(rows, percent):
    per = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (t or "")))
        per.append((i, frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    inv = collections.defaultdict(list)
    for k, (_, s) in enumerate(per):
        for x in s:
            inv[x].append(k)
    pairs = {(l[b], l[a]) for l in inv.values() for a in range(len(l)) for b in range(a)}
    links = [(per[a][0], per[b][0]) for a, b in pairs if None not in (per[a][0], per[b][0]) and 100 * len(per[a][1] & per[b][1]) >= percent * len(per[a][1] | per[b][1])]
    comp = joined({i for i, _ in per if i is not None}, links)
    return sorted(((i, len(s), comp.get(i)) for i, s in per), key=str)


def found(df, percent):
    return sorted(((r[0], r[1], r[2]) for r in minhash.near_duplicates(df, percent=percent).collect()), key=str)


def test_documents(spark):
    rnd = random.Random(4)
    words = [f"w{k}" for k in range(300)]
    rows = [(1, "a b c d e f"), (2, "A B c d  e f"), (3, ""), (4, None), (5, "x y"), (6, "X\ty"), (7, "x y z"), (None, "a b c d e f"),
            (8, "q w e r t y u"), (8, "a b c d e f"), (9, "q w e r t y u"), (3, "x y z"), (2**40, "x" * 2_000_000 + " b c d e f g")]
    for g in range(20):  # chains of edits: copies of copies, some beyond the threshold
        text = [rnd.choice(words) for _ in range(rnd.choice((12, 60, 250)))]
        for k in range(12):
            rows.append((100 + g * 20 + k, " ".join(text)))
            text = [rnd.choice(words) if rnd.random() < 0.02 else w for w in text]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_shingles string")
    for percent in (85, 60):
        assert found(df, percent) == brute(rows, percent)
    assert found(df.limit(0), 85) == []


def test_few_shingles(spark):
    letters = "a b c d e f g h i j".split()
    rows = [(k, " ".join(letters[:k])) for k in range(1, 11)]  # 7 to 10 words: 3/4, 4/5 and 5/6 in common
    rows += [(100 * k + n, " ".join(f"{x}{k}" for x in letters[:n])) for k in range(1, 60) for n in (8, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (80, 85, 100):
        assert found(df, percent) == brute(rows, percent)


def test_large_group_in_blocks(spark, monkeypatch):
    rnd = random.Random(9)
    base = [f"w{rnd.randrange(1000)}" for _ in range(120)]
    rows = []
    for k in range(120):
        t = list(base)
        for _ in range(rnd.randrange(1, 5)):
            t[rnd.randrange(120)] = f"v{rnd.randrange(1000)}"
        rows.append((k, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(minhash, "BLOCK", 16)
    assert found(df, 85) == brute(rows, 85)


def test_components(spark):
    rnd = random.Random(2)
    links = [(k, k + 1) for k in range(60)] + [(200, k) for k in range(100, 160)] + [(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(60)] + [(5, 5), (None, 3)]
    got = components.components(spark.createDataFrame(links, "u long, v long"))
    want = joined(range(400), [x for x in links if None not in x])
    assert {r["node"]: r["component"] for r in got.collect()} == {k: v for k, v in want.items() if k != v}


def vectors_brute(rows, threshold=0.95):
    good = [k for k, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    n, links = [0] * len(rows), []
    for a in good:
        for b in good:
            x, y = rows[a][1], rows[b][1]
            if a != b and len(x) == len(y) and np.dot(x, y) / np.sqrt(np.dot(x, x) * np.dot(y, y)) >= threshold:
                n[a] += 1
                links.append((rows[a][0], rows[b][0]))
    comp = joined({i for i, _ in rows if i is not None}, links)
    return sorted(((i, n[k], comp.get(i)) for k, (i, _) in enumerate(rows)), key=str)


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rnd = np.random.default_rng(3)
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [1.0, None]), (None, [1.0, 0.0]),
            (8, [1.0, 0.1, 0.0]), (9, []), (10, [0.0, 1.0]), (10, [1.0, 0.0]), (11, [0.0, 1.0]), (12, [-0.0, 1.0]), (5, [0.01, 1.0])]
    for g in range(12):
        base = rnd.normal(size=16)
        rows += [(100 + g * 20 + k, (base + rnd.normal(size=16) * 0.25).tolist()) for k in range(15)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, n int")
    run = lambda d: sorted(((r[0], r[1], r[2]) for r in embedding_dedup.near_duplicates(d).collect()), key=str)
    assert run(df) == vectors_brute(rows)
    assert run(df.limit(0)) == []


@pytest.mark.parametrize("local", [0, 1_000_000])
def test_components_in_one_task_and_in_rounds(spark, monkeypatch, local):
    """Long paths, stars and random links: both ways give the smallest node of every component."""
    monkeypatch.setattr("rosterline.llm.components.LOCAL", local)
    rng = np.random.default_rng(6)
    links = [(k, k + 1) for k in range(100, 140)] + [(500, k) for k in range(400, 430)] + [tuple(map(int, rng.integers(1000, 1080, 2))) for _ in range(60)] + [(7, 7), (None, 3)]
    near = {}
    for u, v in links:
        if u is not None and u != v:
            near.setdefault(u, set()).add(v)
            near.setdefault(v, set()).add(u)
    want, seen = {}, set()
    for start in sorted(near):
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                want[x] = start
                todo += near[x]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "u long, v long").repartition(7)).collect()}
    assert got == {k: v for k, v in want.items() if k != v}
