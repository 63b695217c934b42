import re

import numpy as np
from pyspark.sql import functions as F

from corpuskiln.llm.mixing import fit, mix_sources, mixed_documents


def plain_mix(rows, weights=(1, 2, 3), most=3):
    """Per source of (source, text) rows: its size, its target, whole repeats, and how near its taken words can come to the rounded target."""
    sizes = {}
    for source, text in rows:
        sizes.setdefault(source, []).append(len(re.findall(r"[^\x20\x09-\x0D]+", text or "")))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    cap = {s: most * sum(sizes[s]) for s in order}
    target, free, rest = {}, set(order), sum(map(sum, sizes.values()))
    while free:
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > cap[s]}
        if not over:
            target |= share
            break
        target |= {s: float(cap[s]) for s in over}
        rest, free = rest - sum(cap[s] for s in over), free - over
    out = {}
    for s in order:
        whole = sum(sizes[s])
        epochs = min(most, int(target[s] // whole)) if whole else 0
        sums = 1  # bit k: some documents sum up to k
        for n in sizes[s] if epochs < most else []:
            sums |= sums << n
        left = round(target[s]) - epochs * whole
        out[s] = (whole, target[s], epochs, min(abs(k - left) for k in range(sums.bit_length()) if sums >> k & 1))
    return out


def test_fit_reaches_the_budget():
    rng = np.random.default_rng(3)
    for _ in range(60):
        sizes = np.unique(rng.integers(1, 60, rng.integers(1, 8)))
        counts = rng.integers(1, 5, len(sizes))
        budget = int(rng.integers(0, (sizes * counts).sum() + 5))
        sums = {0}
        for s, n in zip(sizes, counts):
            sums = {x + s * k for x in sums for k in range(n + 1)}
        take = fit(sizes, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        assert (take * sizes).sum() == max(x for x in sums if x <= budget)


def test_large_budget_is_near():
    rng = np.random.default_rng(4)
    sizes, counts = np.arange(1, 3000), rng.integers(1, 40, 2999)
    budget = int((sizes * counts).sum() * 0.37)
    take = fit(sizes, counts, budget)
    assert (take * sizes).sum() == budget


def docs(spark, n=300):
    words = lambda k: " ".join(["w"] * k)
    rows = [(i, words(1 + (i * 7) % 50), ["a", "b", "c", None][i % 4] if i % 10 else "a") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mix_meets_targets(spark):
    df = docs(spark)
    rows = mix_sources(df).join(df.select("doc_id", "source"), "doc_id").collect()
    total = sum(r["size"] for r in rows)
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is None, s or ""))
    size = {s: sum(r["size"] for r in rows if r["source"] == s) for s in sources}
    target = {r["source"]: r["target"] for r in rows}
    assert abs(sum(target.values()) - total) < 1e-6 * total or all(target[s] == 3 * size[s] for s in sources)
    weight = {s: 1 + i % 3 for i, s in enumerate(sources)}
    free = [s for s in sources if target[s] < 3 * size[s] - 1e-9]
    levels = [target[s] / weight[s] for s in free]
    assert max(levels) - min(levels) < 1e-6 * max(levels)
    for s in sources:
        taken = sum(r["taken"] for r in rows if r["source"] == s)
        assert abs(taken - target[s]) <= 50
        assert {r["source_size"] for r in rows if r["source"] == s} == {size[s]}
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    again = {r["doc_id"]: r["taken"] for r in mix_sources(df.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_capped_sources(spark):
    rows = [(0, "w", "a"), (1, " ".join(["w"] * 100), "b"), (2, "w w", "c")]
    got = {r["doc_id"]: (r["target"], r["taken"]) for r in mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0] == (3.0, 3) and got[2] == (6.0, 6) and got[1][0] == 94.0


def test_edge_cases(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "w " * 100000, "b"), (3, "x y", "b"), (None, "x", "b"), (4, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit(1)).withColumn("n", F.lit(1)).withColumn("key", F.lit("k"))
    out = mix_sources(df).collect()
    assert len(out) == 6 and all(r["taken"] <= 3 * r["size"] for r in out)
    mixed = mixed_documents(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r["copies"] for r in out)
    assert mix_sources(df.limit(0)).count() == 0
    assert all(r["taken"] == 0 for r in mix_sources(df.where("coalesce(text, '') = ''")).collect())


def test_long_documents_use_the_budget():
    def taken(sizes, counts, budget, **options):
        return int((fit(np.array(sizes), np.array(counts), budget, **options) * sizes).sum())

    assert taken([300000], [3], 620000) == 600000
    assert taken([300000], [3], 880000) == 600000 and taken([300000], [3], 880000, above=True) == 900000
    assert taken([300000, 330000], [1, 1], 329000) == 300000 and taken([300000, 330000], [1, 1], 329000, above=True) == 330000
    assert taken([75000], [2], 140000) == 75000 and taken([75000], [2], 140000, above=True) == 150000
    assert taken([100], [1], 94) == 0 and taken([100], [1], 94, above=True) == 100
    assert taken([100], [1], 50, above=True) == 0


def test_fit_above_is_nearest():
    rng = np.random.default_rng(6)
    for dp_words in [1 << 16] * 60 + [3, 20] * 200:
        small = dp_words < 1000
        sizes = np.unique(rng.integers(30 if small else 1, 60, rng.integers(1, 8)))
        counts = rng.integers(1, 2 if small else 5, len(sizes))
        budget = int(rng.integers(0, (60 if small else (sizes * counts).sum() + 5)))
        sums = {0}
        for s, n in zip(sizes, counts):
            sums = {x + s * k for x in sums for k in range(n + 1)}
        take = fit(sizes, counts, budget, dp_words, above=True)
        assert (take >= 0).all() and (take <= counts).all()
        if not small:
            assert abs(int((take * sizes).sum()) - budget) == min(abs(x - budget) for x in sums)
        else:  # the spread may have taken a document before
            assert abs(int((take * sizes).sum()) - budget) <= max(sizes)
            lower = fit(sizes, counts, budget, dp_words)
            assert abs(int((take * sizes).sum()) - budget) <= budget - int((lower * sizes).sum()) and (lower * sizes).sum() <= budget


def test_mix_takes_the_nearest_sum(spark):
    rows = [(0, "w", "a"), (1, " ".join(["w"] * 100), "b"), (2, "w w", "c")]
    got = {r["doc_id"]: r["taken"] for r in mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got == {0: 3, 1: 100, 2: 6}
    rows = [(i, " ".join(["w"] * 10), "a") for i in range(3)] + [(9, " ".join(["w"] * 40), "b")]
    out = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(27, 43)).collect()
    assert sum(r["taken"] for r in out if r["doc_id"] < 9) == 30 and [r["taken"] for r in out if r["doc_id"] == 9] == [40]


def test_columns_of_any_name_and_repeated_rows(spark):
    rows = [(1, "a b c", "s", 1), (1, "a b c", "s", 2), (1, "a b d", "s", 3), (2, "e f g h", "t", 4), (None, "x y", None, 5), (3, None, "s", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, __id int").withColumns({c: F.lit(0) for c in ("__size", "__no", "__copy", "row", "no", "copy", "copies", "shares", "id", "digest")})
    out = mixed_documents(df)
    assert out.columns == df.columns
    want = sorted((r["doc_id"] or -1, r["size"]) for r in mix_sources(df).collect() for _ in range(r["copies"]))
    got = out.collect()
    assert sorted((r["doc_id"] or -1, len((r["text"] or "").split())) for r in got) == want
    assert {r["__id"] for r in got} <= {1, 2, 3, 4, 5, 6}
