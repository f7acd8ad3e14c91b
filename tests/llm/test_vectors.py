"""Operators 4 and 7 against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from parcelflow.llm import topk_search as K
from parcelflow.llm import vector_dedup as V

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()), *[T.StructField(n, T.StringType()) for n in
                                                ("node", "y", "d", "block", "cell", "score", "h1")]])


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 7) for r in rows], SCHEMA)


def vectors(n=400, dim=16, seed=3):
    rnd = np.random.default_rng(seed)
    base = rnd.normal(size=(n // 4, dim))
    rows = []
    for i in range(n):
        v = base[i % len(base)] + rnd.normal(size=dim) * rnd.choice([0.02, 0.05, 0.09])
        rows.append((i * 5, [float(np.float32(x)) for x in v], int(rnd.integers(3))))
    odd = [(7001, None, 1), (7002, [0.0] * dim, 1), (7003, [float("nan")] + [1.0] * (dim - 1), 1),
           (7004, [float("inf")] * dim, 1), (7005, [None] + [1.0] * (dim - 1), 1),
           (7006, rows[0][1], None), (None, rows[0][1], rows[0][2]), (7010, [1.0, 2.0], 1),
           (7020, [1.0, 2.0], 1), (7030, [], 1), (7100, [3.0, -1.0], 2),
           (8000, rows[4][1], rows[4][2]), (8000, rows[4][1], rows[4][2])]
    copies = [(9000 + k, rows[8][1], rows[8][2]) for k in range(30)]
    return rows + odd + copies


def good(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute_top(rows, k=10):
    ints = {(i, tuple(math.floor(1024 * x) for x in v)) for i, v, _ in rows
            if i is not None and good(v)}
    out = []
    for q in {i for i, _ in ints if i % 100 == 0}:
        best = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), c)
                      for i, x in ints if i == q for c, y in ints if c != q and len(x) == len(y))[:k]
        out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block,query_block", [(32768, 16384), (50, 3)])
def test_top_k_is_exact(spark, block, query_block):
    rows = vectors()
    got = K.top_k(frame(spark, rows), block=block, query_block=query_block)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows)


def test_top_k_few_rows_ties_and_large_values(spark):
    rows = [(100, [1.0, 0.0], 0), (1, [1.0, 5.0], 0), (2, [1.0, -5.0], 0), (3, [-1.0, 0.0], 0),
            (200, [0.0, 0.0], 0), (4, [3e6, 2e6], 0), (5, [3e6, 1e6], 0)]
    got = sorted(tuple(r) for r in K.top_k(frame(spark, rows), k=3).collect())
    assert got == brute_top(rows, 3)
    assert K.top_k(frame(spark, [])).count() == 0
    assert K.top_k(frame(spark, [(100, [1.0], 0)])).count() == 0


def test_search_stops_early():
    rnd = np.random.default_rng(1)
    y = np.concatenate([rnd.normal(size=(40, 8)), rnd.normal(size=(4000, 8)) * 0.01]) * 1000
    y = np.floor(y)
    pivots = K.farthest_first(y, 16)
    d = np.stack([np.linalg.norm(y - p, axis=1) for p in pivots], axis=1)
    seen = []
    original = K.inner
    K.inner = lambda some, *a: seen.append(len(some)) or original(some, *a)
    try:
        q = np.array([0])
        got = list(K.search_block(np.arange(len(y)), y, d, q, y[:1], d[:1], 5))
    finally:
        K.inner = original
    want = sorted(((-int(y[0] @ y[i]), i) for i in range(1, len(y))))[:5]
    assert [(c, s) for _, c, s in got] == [(i, -s) for s, i in want]
    assert sum(seen) < len(y) / 4


def brute_near(rows, t=0.98):
    able = [i for i, (n, v, label) in enumerate(rows)
            if n is not None and label is not None and good(v) and any(v)]
    unit = {i: np.array(rows[i][1], float) / np.linalg.norm(np.array(rows[i][1], float))
            for i in able}
    links, group = [0] * len(rows), list(range(len(rows)))
    for x in range(len(able)):
        for y in range(x):
            a, b = able[x], able[y]
            if (rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b])
                    and float(unit[a] @ unit[b]) >= t):
                links[a] += 1
                links[b] += 1
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    out = []
    for i, (n, _, _) in enumerate(rows):
        c = min((rows[j][0] for j in range(len(rows)) if group[j] == group[i]
                 and rows[j][0] is not None), default=None) if n is not None else None
        out.append((n, links[i], c, n is not None and n == c))
    return sorted(map(repr, out))


@pytest.mark.parametrize("cell,block", [(8192, 1024), (40, 16)])
def test_near_duplicates_are_exact(spark, cell, block):
    rows = vectors()
    got = V.near_duplicates(frame(spark, rows), cell_size=cell, block=block)
    want = brute_near(rows)
    assert sum("True" not in r for r in want) > 20
    assert sorted(repr(tuple(r)) for r in got.collect()) == want


def test_cells_that_outgrow_the_bound_are_cut_again(spark, monkeypatch):
    monkeypatch.setattr(V, "MOST_CELLS", 3)
    monkeypatch.setattr(V, "DEALT", 25)
    rows = vectors()
    sizes = []
    real = V.inner_cells
    monkeypatch.setattr(V, "inner_cells", lambda placed, size, reach: sizes.append(
        real(placed, size, reach)) or sizes[-1])
    got = V.near_duplicates(frame(spark, rows), cell_size=10, block=16)
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute_near(rows)
    assert sizes[0].agg({"inner": "max"}).first()[0] > 0  # some are cut


def test_near_duplicates_of_nothing(spark):
    assert V.near_duplicates(frame(spark, [])).count() == 0
    got = [tuple(r) for r in V.near_duplicates(frame(spark, [(3, None, 1), (4, [2.0], 1)])).collect()]
    assert sorted(got) == [(3, 0, 3, True), (4, 0, 4, True)]
