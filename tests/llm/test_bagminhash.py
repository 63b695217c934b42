import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuskiln.llm.bagminhash import TILE_BYTES, _rest, bag, near_dedup, near_duplicates, signatures, weighted_jaccard
from corpuskiln.llm.words import WordHashes


def brute_force(rows):
    memory = WordHashes()
    bags = {i: bag(memory.of((t or "").encode().split())) for i, t in rows}
    parent = {i: i for i in bags}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_text = {}
    for i, t in rows:
        by_text.setdefault(t or "", []).append(i)
    same = [(v[0], w) for v in by_text.values() for w in v]
    near = [(a, b) for a, b in itertools.combinations(sorted(bags), 2) if weighted_jaccard(bags[a], bags[b]) >= 0.8]
    for a, b in same + near:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in bags}


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows, texts = [], []
    for i in range(n):
        if texts and rng.random() < 0.6:
            t = list(rng.choice(texts))
            for _ in range(rng.randint(0, max(1, len(t) // 25))):
                t[rng.randrange(len(t))] = rng.choice(words)
        else:
            t = [rng.choice(words) for _ in range(rng.randint(1, 150))]
        texts.append(t)
        rows.append((i, " ".join(t)))
    return rows


def test_signature_agreement_estimates_weighted_jaccard():
    rng = np.random.default_rng(5)
    pairs = []
    for _ in range(40):
        u = np.unique(rng.integers(0, 2**62, 150).astype(np.uint64))
        a, b = rng.integers(1, 40, len(u)), rng.integers(1, 40, len(u))
        rows = signatures([(u, a), (u, b)], m=120)
        pairs.append(((rows[0] == rows[1]).mean(), weighted_jaccard((u, a), (u, b))))
    got, true = np.mean(pairs, axis=0)
    assert abs(got - true) < 0.02


def test_signature_does_not_depend_on_the_batch():
    memory = WordHashes()
    bags = [bag(memory.of(t.encode().split())) for t in ("a b c d e f g", "x", "", "a a a a a a a a")]
    whole = signatures(bags)
    for i, b in enumerate(bags):
        assert (signatures([b])[0] == whole[i]).all()


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_brute_force(spark, seed):
    rows = corpus(seed)
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_force(rows)


def test_chain_that_no_star_links(spark):
    """The hub of a bucket is near the middle text only; the middle text links the third."""
    base = [f"w{k}" for k in range(200)]
    second, third = list(base), list(base)
    for k in range(0, 15, 5):
        second[k] = third[k] = f"y{k}"
    for k in range(100, 115, 5):
        third[k] = f"z{k}"
    rows = [(i, " ".join(t)) for i, t in enumerate((base, second, third))]
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_force(rows)


def test_edge_cases(spark):
    rows = [(1, None, "x"), (2, "", None), (3, "a b", "x"), (4, "a  b", "x"), (None, "a b", "x"), (None, "only here", "x"), (5, "w " * 30000, "x"), (3, "a b", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, rep string").withColumn("bucket", F.lit(1))
    got = sorted(((r["doc_id"] or -1), r["class_id"], r["copies"]) for r in near_duplicates(df).collect() if r["class_id"] is not None)
    assert got == [(-1, 3, 3), (1, 1, 2), (2, 1, 2), (3, 3, 3), (3, 3, 3), (4, 3, 1), (5, 5, 1)]
    kept = near_dedup(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, -1, 1, 3, 5]
    assert near_duplicates(df.limit(0)).count() == 0


def long_texts():
    """Four texts of 4 MB: 0, 1 and 2 are a chain whose ends are at a similarity of about 0.72; 3 is at about 0.7 to 0 and less to the others."""
    base = [f"{k:050d}" for k in range(82_000)]
    texts = [list(base) for _ in range(4)]
    for k in range(0, 6500, 5):
        texts[1][k] = texts[2][k] = f"y{k:049d}"
    for k in range(20_000, 26_500, 5):
        texts[2][k] = f"z{k:049d}"
    for k in range(40_000, 54_000, 5):
        texts[3][k] = f"x{k:049d}"
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_tiles_of_more_blocks_than_texts(spark):
    rows = long_texts()
    assert sum(len(t) for _, t in rows) // TILE_BYTES + 1 > len(rows) - 1
    texts = spark.createDataFrame(rows, "cid long, text string")
    placed = spark.createDataFrame([(0, i, 81_996, c, 0, 0.0, 0.0 if i == 1 else 1.0) for i, c in ((1, 0), (2, 2), (3, 3))], "hub long, cid long, weight long, component long, core long, low double, high double")
    assert {(r["a"], r["b"]) for r in _rest(placed, texts, 0.8).collect()} == {(2, 1)}
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(texts.withColumnRenamed("cid", "doc_id")).collect()}
    assert got == brute_force(rows) == {0: 0, 1: 0, 2: 0, 3: 3}


@pytest.mark.parametrize("seed", [3, 4])
def test_loose_texts_equal_brute_force(spark, seed):
    """Texts at every distance from their hub, so that many are linked by others only."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(70):
        t = list(base)
        for k in range(rng.randint(0, 9)):
            t[rng.randrange(len(t))] = f"x{rng.randint(0, 3)}"
        rows.append((i, " ".join(t[: rng.randint(80, 120)])))
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_force(rows)


def test_a_doc_id_with_several_texts_and_clashing_names(spark):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(7, "one two three four five six", "keep"), (7, long, "keep"), (9, long + " more", "go"), (8, "one two three four five six", "go"), (None, "one two three four five six", "keep"), (7, long, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __id string").withColumns({"__no": F.lit(1), "row": F.lit(2), "hit": F.lit(3), "digest": F.lit(4), "keep": F.lit(5), "word": F.lit(6)})
    kept = near_dedup(df)
    assert kept.columns == df.columns
    got = kept.collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in got) == sorted([(7, rows[0][1]), (7, long), (-1, rows[4][1])])
    assert {r["__id"] for r in got} <= {"keep", "again"}
