import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuskiln.llm import vectors


def brute_force(rows, least=0.9):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    links = [[] for _ in good]
    for x, (_, a) in enumerate(good):
        for y, (_, b) in enumerate(good):
            if x != y and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= least:
                links[x].append(y)
    out, seen = [], set()
    for x in range(len(good)):
        if x in seen:
            continue
        group, work = {x}, [x]
        while work:
            for y in links[work.pop()]:
                if y not in group:
                    group.add(y)
                    work.append(y)
        seen |= group
        out += [(good[y][0], len(links[y]), min(good[z][0] for z in group)) for y in group]
    bad = len(rows) - len(good)
    return sorted(out), bad


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return [(r["vec_id"], r["n_links"], r["component_id"]) for r in vectors.near_vectors(df, **options).collect()]


def clusters(seed, n, d, spread=0.25):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    rows = [(int(i), (centres[rng.integers(12)] + spread * rng.normal(size=d)).astype(np.float32).tolist()) for i in rng.permutation(n)]
    return rows + [(n + k, rows[k % 3][1]) for k in range(10)] + [(n + 20, [2 * v for v in rows[0][1]])]


@pytest.mark.parametrize(("d", "block"), [(8, 4096), (16, 37)])
def test_equals_brute_force(spark, monkeypatch, d, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "CELLS", 7)
    rows = clusters(d, 250, d)
    assert sorted(run(spark, rows)) == brute_force(rows)[0]


def test_bound_is_rigorous():
    rng = np.random.default_rng(2)
    a = vectors.unit(rng.normal(size=(300, 33)))
    b = vectors.unit(np.concatenate([a + 0.3 * rng.normal(size=a.shape), rng.normal(size=(50, 33)) * 1e-200]))
    for least in (0.85, 0.9, 0.99):
        got = {(int(x), int(y)) for i, j in vectors.linked(a, b, least) for x, y in zip(i, j)}
        assert got == {(int(x), int(y)) for x, y in zip(*np.nonzero(a @ b.T >= least))}


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (10, [1e-30, 1e-32]), (11, [-1.0, 0.0])]
    got = sorted(run(spark, rows), key=lambda r: (r[0] is None, r))
    assert got == [(1, 3, 1), (2, 3, 1), (2, 3, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 0, 8), (9, 0, 9), (10, 3, 1), (11, 0, 11), (None, 0, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("n", F.lit(1)).withColumn("cell", F.lit(1)).withColumn("vector", F.lit("x"))
    assert vectors.near_vectors(df).count() == len(rows) and vectors.near_vectors(df.limit(0)).count() == 0
    assert sorted(run(spark, [(1, [0.0]), (2, None)])) == [(1, 0, 1), (2, 0, 2)]
