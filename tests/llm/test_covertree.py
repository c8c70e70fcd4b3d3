"""Dual-tree search against scoring all pairs."""

import math
import random

import duckdb
import numpy as np
import pytest

from wattline.llm import covertree as ct


def brute(rows, k, modulo):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, asked = [], {}
    for i, v in ok:
        if i % modulo == 0:
            asked[i] = min(asked.get(i, v), v)
    for q, v in asked.items():
        scores = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in ok if j != q and len(w) == len(v)))
        out += [(q, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 0) for i, v in rows],
                                 "vec_id long, embedding array<float>, label int, v string, pivot long")


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("dim,kind", [(2, "ties"), (8, "clusters"), (64, "unit")])
def test_search(spark, dim, kind, monkeypatch):
    monkeypatch.setattr(ct.tree, "__defaults__", (None, 16))
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(600, dim))
    if kind == "clusters":
        x = x * 0.05 + rng.normal(size=(12, dim))[rng.integers(0, 12, 600)] * 3
    if kind == "unit":
        x /= np.linalg.norm(x, axis=1)[:, None]
    if kind == "ties":
        x = np.round(x)
    rows = [(int(i), [float(np.float32(c)) for c in v]) for i, v in zip(rng.permutation(600), x, strict=True)]
    df = frame(spark, rows)
    assert got(ct.top_k(df, df.where("vec_id % 10 = 0"), 5, group=64)) == brute(rows, 5, 10)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (10, [0.5, -1.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (None, [9.0, 9.0]), (4, [None, 1.0]),
            (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [3.0]), (20, [2.0]), (8, []), (30, []), (9, [1.0, 2.0]), (9, [1.0, 2.0]), (-50, [0.0, 0.0]),
            (40, [2.0 ** 22, 1.0]), (11, [2.0 ** 20, 3.0])]
    df = frame(spark, rows)
    assert got(ct.top_k(df, df.where("vec_id % 10 = 0"), 5, group=4)) == brute(rows, 5, 10)
    none = frame(spark, [])
    assert got(ct.top_k(none, none)) == []
    one = frame(spark, rows[:1])
    assert got(ct.top_k(one, one)) == []


def test_waves(spark, monkeypatch):
    monkeypatch.setattr(ct, "WAVE", 7)
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, 0.25, 2.0]) for _ in range(4)]) for i in range(200)]
    df = frame(spark, rows)
    assert got(ct.top_k(df, df.where("vec_id % 5 = 0"), 3, group=50)) == brute(rows, 3, 5)


def test_tree_invariants(leaf=16):
    x = np.random.default_rng(0).normal(size=(900, 3))

    def check(n):
        assert np.linalg.norm(x[n.rows] - n.center, axis=1).max() <= n.radius + 1e-9
        if n.children:
            assert sorted(np.concatenate([c.rows for c in n.children])) == sorted(n.rows)
            for i, c in enumerate(n.children):
                check(c)
                for o in n.children[:i]:
                    assert np.linalg.norm(c.center - o.center) > n.radius / 2 - 1e-9
    check(ct.tree(x, leaf=leaf))


def test_same_rows_as_sql(spark):
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{d}/embeddings.parquet'")
    assert got(ct.query(spark, d)) == sorted(con.sql(ct.SQL).fetchall())
