"""Whitening against numpy in double precision, and the eigenvectors against their definition."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from playerlens.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def kept(table):
    out = []
    for i, v in table:
        if v and all(x is not None and math.isfinite(x) for x in v):
            x = [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]
            out.append((i, x))
    return out


def check(spark, table, components=8, extra=lambda df: df):
    df = extra(spark.createDataFrame(table, SCHEMA))
    out = whitening.whitened(df).collect()
    rows = kept(table)
    n, d = len(rows), len(rows[0][1])
    k = min(components, d)
    assert len(out) == n * k
    sums = [sum(x[i] for _, x in rows) for i in range(d)]
    deviations = {}
    for i, x in rows:
        deviations.setdefault(i, []).append(sum((n * a - s) ** 2 for a, s in zip(x, sums)))
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for _, x in rows])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    for c in range(k):
        got = sorted((r for r in out if r["component"] == c + 1), key=lambda r: (str(r["vec_id"]), r["whitened"] or 0))
        assert len(got) == n and {r["n"] for r in got} == {n}
        assert {r["identity_error"] for r in got} == {out[0]["identity_error"]}
        for i in deviations:
            assert sorted(r["deviation"] for r in got if r["vec_id"] == i) == sorted(deviations[i])
        e = values[c]
        if e <= values[0] * 1e-12:
            assert {r["whitened"] for r in got} == {None}
            continue
        assert got[0]["explained"] == pytest.approx(e / values.sum(), rel=1e-9)
        gap = min([abs(e - x) for j, x in enumerate(values) if j != c], default=e)
        if gap > 1e-4 * e:
            want = centred @ vectors[:, c] / math.sqrt(e)
            place = {}
            for (i, _), w in zip(rows, want):
                place.setdefault(str(i), []).append(w)
            flip = 1 if sum(r["whitened"] * w for r, w in zip(got, [x for i in sorted(place) for x in sorted(place[i])])) > 0 else -1
            want = [x for i in sorted(place) for x in sorted(flip * y for y in place[i])]
            assert [r["whitened"] for r in got] == pytest.approx(want, abs=1e-7)
    assert out[0]["identity_error"] <= 1e-9
    return out


def test_equals_numpy(spark):
    rng = np.random.default_rng(1)
    mix = rng.normal(size=(12, 12)) * np.geomspace(1, 0.02, 12)
    table = [(i, (rng.normal(size=12) @ mix).tolist()) for i in range(500)]
    table += [(900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11), (904, [0.0] * 12), (None, [1.0] * 12), (7, table[7][1])]
    check(spark, table)


def test_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(2)
    table = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    df = spark.createDataFrame(table, SCHEMA)
    a = whitening.fit(whitening.usable(df.repartition(1)))
    b = whitening.fit(whitening.usable(df.repartition(13)))
    assert (a.n, a.sums, a.trace) == (b.n, b.sums, b.trace)
    assert np.array_equal(a.components, b.components) and np.array_equal(a.eigenvalues, b.eigenvalues)


def test_exact_products():
    rng = np.random.default_rng(3)
    for size in (10, 1 << 22, 1 << 41):
        y = rng.integers(-size, size, (5000, 5))
        got = whitening.exact_products(y)
        want = y.astype(object).T @ y.astype(object)
        assert (got == want).all()


def test_eigenvectors_of_clusters():
    """Three equal eigenvalues, two pairs closer than float32 can tell, one far smaller."""
    rng = np.random.default_rng(4)
    q = np.linalg.qr(rng.normal(size=(12, 12)))[0].astype(np.longdouble)
    for _ in range(3):  # orthonormal beyond a double
        q = q @ (1.5 * np.eye(12, dtype=np.longdouble) - 0.5 * (q.T @ q))
    values = np.array([5, 5, 5, 3, 3 + 1e-9, 2, 2 + 1e-12, 1, 0.5, 0.1, 1e-3, 1e-9], np.longdouble)
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    got, x = whitening.refined_eigenvectors(a)
    assert np.abs(x.T @ x - np.eye(12)).max() < 1e-17
    assert np.abs(a @ x - x * got).max() < 1e-17
    assert np.abs(np.sort(got) - np.sort(values)).max() < 1e-17
    order = np.argsort(-got)
    for i, place in ((5, 3), (10, 10), (11, 11)):
        want = q[:, np.argsort(-values)[place]]
        assert min(np.abs(x[:, order[place]] - want).max(), np.abs(x[:, order[place]] + want).max()) < 1e-7


def test_close_eigenvectors_reach_double_precision():
    a = np.diag(np.array([2, 2 + 2.0**-20, 1], np.longdouble))
    turn = np.longdouble(0.3)
    g = np.eye(3, dtype=np.longdouble)
    g[:2, :2] = [[np.cos(turn), -np.sin(turn)], [np.sin(turn), np.cos(turn)]]
    values, x = whitening.refined_eigenvectors(g @ a @ g.T)
    for i in range(3):
        best = np.abs(x.T @ g[:, i]).max()
        assert abs(1 - best) < 1e-16
    assert np.abs(np.abs(x.T @ g).round(8).sum(axis=0) - 1).max() == 0
    off = np.abs(x.T @ g)
    assert np.sort(off.ravel())[:6].max() < 1e-12


def test_few_dimensions_and_no_variance(spark):
    check(spark, [(i, [random.Random(i).gauss(0, 1), 0.25, i / 7]) for i in range(40)])
    out = whitening.whitened(spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], SCHEMA)).collect()
    assert len(out) == 4
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in out} == {(2, 0, None, None, 0.0)}


def test_odd_tables(spark):
    empty = whitening.whitened(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == []
    assert empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whitened(spark.createDataFrame([(1, None), (2, []), (3, [None])], SCHEMA)).count() == 0
    clash = lambda df: df.withColumns({c: F.lit("mine") for c in ("v", "n", "w", "component", "deviation")})
    table = [(i, [math.sin(i), math.cos(2 * i), i % 5 / 3]) for i in range(60)]
    plain = whitening.whitened(clash(spark.createDataFrame(table, SCHEMA)))
    assert plain.count() == 180
    ragged = spark.createDataFrame([*table, (100, [1.0]), (101, [1.0, 2.0])], SCHEMA)
    assert whitening.whitened(ragged).filter("component = 1").count() == 60


def test_large_entries(spark):
    df = spark.createDataFrame([(1, [1e9, 1.0]), (2, [-1e9, 3.0]), (3, [5.0, 7.0]), (4, [1e12, 0.0])], "vec_id long, embedding array<double>")
    out = {(r["vec_id"], r["component"]): r for r in whitening.whitened(df).collect()}
    assert {i for i, _ in out} == {1, 2, 3}
    assert out[1, 1]["deviation"] is None and out[3, 1]["n"] == 3
    assert out[1, 1]["identity_error"] < 1e-6
