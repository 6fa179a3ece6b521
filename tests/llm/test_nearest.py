"""Nearest neighbours against brute force, over many cells and curves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from metaloom.llm import nearest as module
from metaloom.llm.nearest import Curves, _cells, _packed, nearest

SCHEMA = "vec_id long, embedding array<double>, cell int"


def brute(rows, every=20, k=20):
    """The best of each query among its own length, with all their ties at the end."""
    kept = sorted({(i, tuple(v)) for i, v, _ in rows
                   if i is not None and v and None not in v and np.isfinite(v).all() and any(v)})
    out = {}
    for i, v in kept:
        if i % every == 0:
            near = sorted((-float(np.dot(v, w)), j) for j, w in kept if j != i and len(w) == len(v))
            out[i] = near[:k]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    shares = [len({j for _, j in got.get(q, [])} & {j for _, j in near}) / len(near) for q, near in want.items() if near]
    return np.mean(shares), np.quantile(shares, 0.1)


def made(kind, n=3000, dims=16):
    rng = np.random.default_rng(1)
    if kind == "isotropic":
        v = rng.normal(size=(n, dims))
    elif kind == "clusters":
        v = rng.normal(size=(40, dims))[rng.integers(0, 40, n)] + 0.1 * rng.normal(size=(n, dims))
    else:  # a third of all rows lies so close together that keys are equal
        v = rng.normal(size=(n, dims))
        v[: n // 3] = v[0] + 1e-9 * rng.normal(size=(n // 3, dims))
    return [(int(i), [float(x) for x in row], 0) for i, row in zip(rng.permutation(n), v)]


@pytest.mark.parametrize("kind", ["isotropic", "clusters", "tight"])
def test_recall(spark, kind):
    rows = made(kind)
    got, want = found(nearest(spark.createDataFrame(rows, SCHEMA), cell_rows=64, query_rows=16)), brute(rows)
    whole, worst = recall(got, want)
    assert whole >= 0.9 and worst >= 0.6 and set(got) == set(want) and all(len(n) == 20 for n in got.values())
    scores = {(i, j): -s for i, near in want.items() for s, j in near}
    assert all(abs(-s - scores[i, j]) < 1e-9 for i, near in got.items() for s, j in near if (i, j) in scores)


def test_a_window_over_all_cells_is_exact(spark, monkeypatch):
    rows = made("isotropic", 700)
    monkeypatch.setattr(module, "_window", lambda *_: 10**6)
    got = found(nearest(spark.createDataFrame(rows, SCHEMA), cell_rows=50))
    assert {q: [j for _, j in near] for q, near in got.items()} == {q: [j for _, j in near] for q, near in brute(rows).items()}


@pytest.mark.parametrize("kind", ["isotropic", "tight"])
def test_cells_are_bounded_and_in_order(spark, conf, kind):
    conf(**{"spark__sql__adaptive__coalescePartitions__enabled": "false", "spark__sql__shuffle__partitions": "7"})
    rows = made(kind, 1500)
    kinds = _packed(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding")
    kinds = kinds.select("vector", F.array("vec_id").alias("ids"), (F.col("vec_id") % 20 == 0).alias("asks"))
    curves = Curves.fit(np.array([v for _, v, _ in rows]), 0)
    cells, count = _cells(kinds, curves, 0, 40)
    last = {}
    sizes = []
    for r in cells.orderBy("curve", "cell").collect():
        keys = curves.keys(np.stack([np.frombuffer(v, "<f8") for v in r.vectors]))[r.curve]
        assert (np.diff(keys) >= 0).all() and last.get(r.curve, (-1, -1))[1] <= keys[0]
        assert r.cell == last.get(r.curve, (-1,))[0] + 1
        last[r.curve] = (r.cell, keys[-1])
        sizes.append(len(keys))
    assert max(sizes) <= 40 and sum(sizes) == 4 * 1500 and count == max(c for c, _ in last.values()) + 1 >= 38


def test_odd_rows(spark):
    nan = float("nan")
    rows = made("clusters", 200, 4)
    rows += [(1000 + i, rows[5][1], 0) for i in range(60)] + rows[:9]  # ties, and copies
    rows += [(2000, [1.0, 2.0, 3.0], 0), (2001, [1.0, 1.0, 1.0], 0), (2020, [5.0], 0)]  # other lengths
    rows += [(None, [1.0] * 4, 0), (2040, None, 0), (2060, [0.0] * 4, 0), (2080, [nan] * 4, 0), (2100, [1.0, None] * 2, 0), (2120, [], 0)]
    got = found(nearest(spark.createDataFrame(rows, SCHEMA), cell_rows=30))
    want = brute(rows)
    assert set(got) == {q for q, near in want.items() if near} and recall(got, want)[0] >= 0.9
    assert got[2000] == [(-6.0, 2001)]


def test_one_odd_length_silences_nobody(spark):
    rows = [(i, [float(i + 1), 1.0], 0) for i in range(100)] + [(500, [1.0, 1.0, 1.0], 0)]
    got = found(nearest(spark.createDataFrame(rows, SCHEMA)))
    assert set(got) == {0, 20, 40, 60, 80} and got[0][0] == (-101.0, 99)
    assert nearest(spark.createDataFrame([], SCHEMA)).count() == 0
    assert nearest(spark.createDataFrame([(1, [1.0], 0)], SCHEMA)).count() == 0
    assert nearest(spark.createDataFrame([(20, [1.0], 0)], SCHEMA)).count() == 0
