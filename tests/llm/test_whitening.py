from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuskiln.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def brute_force(rows, components):
    """Per vector: n, deviation, whitened by component, explained; the mean by exact fractions."""
    x = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in rows]
    n, d = len(x), len(x[0][1])
    sums = [sum(v[k] for _, v in x) for k in range(d)]
    centred = np.array([[float(Fraction(n * v[k] - sums[k], n)) for k in range(d)] for _, v in x])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    w = centred @ u / np.sqrt(e)
    return {i: (n, sum((n * v[k] - sums[k]) ** 2 for k in range(d)), np.abs(w[r, :components]), e[:components] / e.sum()) for r, (i, v) in enumerate(x)}


def run(spark, rows, components=32, parts=3):
    out = {}
    for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(parts), components=components).orderBy("vec_id", "component").collect():
        out.setdefault(r["vec_id"], []).append(r)
    return out


@pytest.mark.parametrize(("d", "components", "parts"), [(3, 32, 1), (40, 32, 5), (8, 5, 3)])
def test_equals_brute_force(spark, d, components, parts):
    rng = np.random.default_rng(d)
    mixed = rng.normal(size=(d, d)) * np.linspace(0.2, 3, d)
    rows = [(i, (rng.normal(size=d) @ mixed + 5).astype(np.float32).tolist()) for i in range(300)]
    got, want = run(spark, rows, components, parts), brute_force(rows, components)
    assert set(got) == set(want)
    for i, found in got.items():
        n, deviation, w, shares = want[i]
        assert [r["component"] for r in found] == list(range(1, min(d, components) + 1))
        assert {(r["n"], r["deviation"]) for r in found} == {(n, deviation)}
        assert np.allclose([abs(r["whitened"]) for r in found], w, rtol=1e-6, atol=1e-6)
        assert np.allclose([r["explained"] for r in found], shares, rtol=1e-9)
    all_w = np.array([[r["whitened"] for r in found] for found in got.values()])
    error = np.abs(all_w.T @ all_w / len(all_w) - np.eye(all_w.shape[1])).max()
    assert {r["identity_error"] < 1e-4 for found in got.values() for r in found} == {True} and error < 1e-9


def test_no_order_of_tasks_changes_integers(spark):
    rows = [(i, [float(np.float32(i % 17 - 0.33)), 1e6 * (i % 5)]) for i in range(200)]
    one, many = run(spark, rows, parts=1), run(spark, rows, parts=7)
    assert {i: r[0]["deviation"] for i, r in one.items()} == {i: r[0]["deviation"] for i, r in many.items()}


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [-1.0, 0.0]), (2, [-1.0, 0.0]), (None, [3.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (8, [1.0]), (9, [1e13, 0.0]), (10, [0.0] * 3)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit(0)).withColumn("vector", F.lit("x")).withColumn("n", F.lit(1))
    found = whitening.whiten(df).collect()
    by_size = {n: [r for r in found if r["n"] == n] for n in (1, 4)}
    assert len(by_size[4]) == 8 and len(by_size[1]) == 1 + 3  # four vectors of two components; two lists of a single vector
    assert {r["whitened"] for r in by_size[4] if r["component"] == 2} == {None} and all(r["explained"] == 1.0 for r in by_size[4] if r["component"] == 1)
    assert all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 for r in by_size[1])
    assert whitening.whiten(df.limit(0)).count() == 0 and whitening.whiten(df.where("vec_id = 3")).count() == 0


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(1, [1e9]), (2, [-1e9]), (3, [0.0])]
    got = run(spark, rows)
    x = [64 * 10**9, -64 * 10**9, 0]
    want = [(3 * v) ** 2 for v in x]
    assert [got[i][0]["deviation"] for i in (1, 2, 3)] == [v if v < 1 << 63 else None for v in want]
