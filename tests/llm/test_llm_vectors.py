"""Whitening, block search and Orchard codes against brute force on tables with nulls, ties, copies and odd lengths."""

import hashlib
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterline.llm import block_search, orchard_codes, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, cls string, i int, vec string, n int, whitened string, near int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, lab, "c", 1, "v", 2, "w", 3) for i, v, lab in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def rows():
    """Vectors with copies (a third of all), ties, repeated and null ids, and rows that take no part."""
    rng = np.random.default_rng(5)
    out = [(k, [float(x) for x in rng.standard_normal(20).astype(np.float32)], k % 3 if k % 5 else None) for k in range(240)]
    out += [(300 + k, [0.5] * 20, 1) for k in range(120)]
    out += [(500 + k, [float(np.float32(x)) for x in np.eye(20)[k % 20] * (1 if k < 20 else -1)], 2) for k in range(40)]
    out += [(20, [0.25] * 20, 0), (20, [0.25] * 20, 0), (None, [0.75] * 20, None), (700, [1.0, 2.0], 0), (701, [-0.0] * 20, 1)]
    out += [(800, None, 0), (801, [float("nan")] + [0.0] * 19, 0), (802, [float("inf")] * 20, None), (803, [None] + [1.0] * 19, 0), (804, [], 1)]
    return out


def kept(rows, dim):
    return [(i, np.array(list(v) + [0.0] * (dim - len(v)), np.float32).astype(float), lab) for i, v, lab in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]


# -- whitening --------------------------------------------------------------------------------------------------------


def spectrum(m):
    r = np.linalg.qr(m, mode="r")
    a, b, v = whitening.bidiagonal(np.vstack([r, np.zeros((m.shape[1] - len(r), m.shape[1]))]))
    return whitening.squared_singular_values(a, b), a, b, v


def matrices():
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    wilkinson = np.diag(np.abs(np.arange(-10, 11)) + 12.0) + np.eye(21, k=1) + np.eye(21, k=-1)
    return {
        "random": rng.standard_normal((200, 30)), "low rank": rng.standard_normal((7, 30)), "identity": np.eye(30), "one column": rng.standard_normal((9, 1)),
        "graded": rng.standard_normal((200, 30)) @ np.diag(10.0 ** -np.arange(30)), "repeated": np.diag([3.0] * 10 + [2.0] * 20) @ q,
        "close": np.diag(np.concatenate([3 - 10.0 ** -np.arange(13, 5, -1), np.linspace(2, 1, 22)])) @ q, "wilkinson": np.linalg.cholesky(wilkinson).T,
    }


@pytest.mark.parametrize("name", matrices())
def test_singular_values_and_directions(name):
    m = matrices()[name]
    squares, a, b, v = spectrum(m)
    want = np.zeros(m.shape[1])
    want[: min(m.shape)] = np.linalg.svd(m, compute_uv=False)
    assert np.abs(np.sqrt(squares) - want).max() < 1e-14 * want[0] * m.shape[1]
    k = min(8, int((want > 1e-12 * want[0]).sum()))
    z = v @ whitening.directions(a, b, squares[:k])
    assert np.abs(z.T @ z - np.eye(k)).max() < 1e-13
    assert np.abs(m.T @ (m @ z) - z * squares[:k]).max() < 1e-13 * squares[0] * m.shape[1]


def test_small_singular_values_keep_their_digits():
    """A graded bidiagonal matrix: every singular value to a relative accuracy that a full solver doesn't reach."""
    a, b = 10.0 ** -np.arange(0, 24, 2.0), 10.0 ** -np.arange(1, 23, 2.0) * 1e-3
    got = np.sqrt(whitening.squared_singular_values(a, b))
    assert np.isclose(np.prod(got), np.prod(a), rtol=1e-12)


def test_whitening_equals_eigenvectors(spark, rows):
    got = whitening.whiten(table(spark, rows)).toPandas()
    left = kept(rows, 20)
    x = np.floor(1024 * np.stack([v for _, v, _ in left])).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    assert len(got) == 8 * n and set(got["n"]) == {n} and sorted(got.columns) == sorted(["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-10
    assert np.allclose(got.groupby("component")["explained"].first(), values / np.trace(centred.T @ centred / n), rtol=1e-10)
    assert sorted(int(d) for d in got.loc[got["component"] == 1, "deviation"]) == sorted(int(d) for d in ((n * x - sums) ** 2).sum(axis=1))
    want = np.abs(centred @ vectors / np.sqrt(values))
    for k in range(8):
        gaps = np.abs(np.diff(values)) / values[0]
        if min(gaps[max(0, k - 1) : k + 1]) > 1e-6:
            assert np.allclose(np.sort(np.abs(got.loc[got["component"] == k + 1, "whitened"])), np.sort(want[:, k]), atol=1e-8)


def test_triangles_of_many_partitions(spark, rows, monkeypatch):
    monkeypatch.setattr(whitening, "FOLD", 2)
    a = whitening.fit(table(spark, rows).repartition(40))
    b = whitening.fit(table(spark, rows).coalesce(1))
    assert np.allclose(a.values, b.values, rtol=1e-12) and a.sums == b.sums and a.rows == b.rows


@pytest.mark.parametrize("data", [[], [(1, [1.0, 2.0], 0)], [(1, None, 0)], [(k, [1.0, 2.0], 0) for k in range(9)], [(1, [], 0), (2, [], 0)]])
def test_no_variance_no_component(spark, data):
    assert whitening.whiten(table(spark, data)).count() == 0


def test_fewer_directions_than_components(spark):
    got = whitening.whiten(table(spark, [(k, [float(k), float(-k), 1.0], 0) for k in range(5)])).toPandas()
    assert set(got["component"]) == {1} and len(got) == 5 and abs(got["explained"].iloc[0] - 1) < 1e-12


# -- block search -----------------------------------------------------------------------------------------------------


def brute_nearest(rows, dim, every, k):
    left = [(i, v) for i, v, _ in kept(rows, dim) if i is not None and v.any()]
    out = []
    for at, (i, v) in enumerate(left):
        if i % every == 0:
            near = sorted((float(block_search.distances(v[None], w[None])[0]), j) for b, (j, w) in enumerate(left) if b != at)[:k]
            out += [(i, r + 1, j, d) for r, (d, j) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("every,k", [(10, 10), (1, 3), (50, 1000)])
def test_nearest_equals_brute_force(spark, rows, every, k):
    got = block_search.nearest(table(spark, rows), F.col("vec_id") % every == 0, neighbours=k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute_nearest(rows, 20, every, k)


def test_nearest_over_many_blocks(spark, rows, monkeypatch):
    for name, value in (("LEAST", 16), ("MOST", 16), ("TILE", 3), ("PAIRS", 7), ("MERGE", 2)):
        monkeypatch.setattr(block_search, name, value)
    got = block_search.nearest(table(spark, rows), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == brute_nearest(rows, 20, 10, 10)


@pytest.mark.parametrize("data,expected", [([], 0), ([(10, [1.0], 0)], 0), ([(1, [1.0], 0), (2, [2.0], 0)], 0), ([(10, None, 0), (20, [0.0], 0), (30, [1.0], 0)], 0), ([(10, [1.0], 0), (10, [1.0], 0)], 2)])
def test_nearest_small_tables(spark, data, expected):
    assert block_search.nearest(table(spark, data), F.col("vec_id") % 10 == 0).count() == expected


@pytest.mark.parametrize("scale", [1e-200, 1e-3, 1.0, 1e6])
def test_bounds_hold(scale):
    rng = np.random.default_rng(3)
    x, y = rng.standard_normal((40, 1500)) * scale, rng.standard_normal((30, 1500)) * scale
    y[:10] = x[:10]
    low, high = block_search.bounds(block_search.quantised(x), block_search.quantised(y))
    exact = np.array([[block_search.distances(a[None], b[None])[0] for b in y] for a in x])
    assert (low <= exact).all() and (exact <= high).all()


# -- Orchard codes ----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("spread", [2, 6, 400])
def test_orchard_search_equals_full_search(spread):
    """Small spreads make many ties and equal entries."""
    rng = np.random.default_rng(spread)
    book = orchard_codes.Book.of(rng.integers(-spread, spread, (64, 4)))
    parts = rng.integers(-spread, spread, (3000, 4))
    apart = ((parts[:, None, :] - book.entries[None]) ** 2).sum(axis=2)
    for start in (None, rng.integers(0, 64, 3000)):
        code, least = orchard_codes.assign(parts, book, start)
        assert (code == apart.argmin(axis=1)).all() and (least == apart.min(axis=1)).all()


def brute_codes(rows, dim, parts, entries, rounds):
    left = sorted(((i is None, i or 0, np.floor(256 * np.concatenate([v, np.zeros(dim - len(v))])).astype(int).tolist()), lab) for i, v, lab in kept(rows, 20))
    x = np.array([r[0][2] for r in left])
    size, error, codes, books = dim // parts, np.zeros(len(x), int), [], []
    for p in range(parts):
        y = x[:, p * size : (p + 1) * size]
        book = y[:entries].copy()
        for step in range(rounds + 1):
            apart = ((y[:, None, :] - book[None]) ** 2).sum(axis=2)
            code = apart.argmin(axis=1)
            if step < rounds:
                for e in set(code):
                    book[e] = y[code == e].sum(axis=0) // (code == e).sum()
        codes.append(code)
        error += apart.min(axis=1)
        books.append(book)
    totals = {lab: sum(int(e) for e, (_, m) in zip(error, left) if m == lab) for lab in {m for _, m in left}}
    out = [(None if r[0] else r[1], tuple(int(c[k]) for c in codes), int(error[k]), totals[lab]) for k, (r, lab) in enumerate(left)]
    return out, hashlib.sha256(",".join(str(v) for v in itertools.chain(*(b.reshape(-1) for b in books))).encode()).hexdigest()


@pytest.mark.parametrize("parts,entries,dim", [(16, 64, 32), (5, 9, 20), (2, 1000, 20)])
def test_codes_equal_brute_force(spark, rows, parts, entries, dim):
    rows = [(i, v, None if lab == 1 else lab) for i, v, lab in rows]
    if dim == 32:  # null labels count together
        rows = rows[:200] + rows[400:]
    got, books = orchard_codes.encode(table(spark, rows), parts=parts, entries=entries)
    assert got.columns == ["vec_id", "codes", "error", "label_error"]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    want, sha = brute_codes(rows, dim, parts, entries, 2)
    assert sorted(((r[0], tuple(r[1]), r[2], r[3]) for r in got.collect()), key=key) == sorted(want, key=key)
    assert orchard_codes.digest(books) == sha


@pytest.mark.parametrize("data,expected", [([], 0), ([(1, None, 0)], 0), ([(1, [], None)], 1), ([(5, [1.0] * 3, 0)], 1), ([(None, [2.0], 0)] * 3, 3)])
def test_codes_small_tables(spark, data, expected):
    got, _ = orchard_codes.encode(table(spark, data))
    assert [r["error"] for r in got.collect()] == [0] * expected
