import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuskiln.llm import substring
from corpuskiln.llm.substring import SuffixAutomaton, pieces, remove_repeats
from corpuskiln.llm.words import WordHashes

W = substring.WINDOW


def brute_force(rows):
    first, out = {}, []
    for doc, text in rows:
        words = (text or "").split()
        for i in range(len(words) - W + 1):
            key = tuple(words[i : i + W])
            if doc is not None:
                first[key] = min(doc, first.get(key, doc))
    for doc, text in rows:
        words, gone = (text or "").split(), set()
        for i in range(len(words) - W + 1):
            if doc is not None and first[tuple(words[i : i + W])] < doc:
                gone |= set(range(i, i + W))
        out.append((-1 if doc is None else doc, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out)


def corpus(seed, n, vocabulary):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)]
    passages = [[rng.choice(words) for _ in range(rng.randint(8, 40))] for _ in range(6)]
    rows = []
    for i in range(n):
        t = []
        for _ in range(rng.randint(0, 6)):
            t += [rng.choice(words) for _ in range(rng.randint(0, 15))] if rng.random() < 0.5 else rng.choice(passages)[rng.randint(0, 4) :]
        rows.append((i, " ".join(t)))
    rng.shuffle(rows)
    return rows


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in remove_repeats(df).collect())


@pytest.mark.parametrize(("seed", "n", "vocabulary"), [(1, 80, 300), (2, 60, 2), (3, 5, 20)])
def test_equals_brute_force(spark, seed, n, vocabulary):
    rows = corpus(seed, n, vocabulary)
    assert run(spark, rows) == brute_force(rows)


@pytest.mark.parametrize("shard", [1, 3, 40])
def test_crowded_anchors_go_by_windows(spark, shard):
    rows = corpus(5, 40, 4)
    out = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), shard=shard)
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in out.collect()) == brute_force(rows)


@pytest.mark.parametrize("judged", [1, 50, 700])
def test_keys_are_judged_whole(judged):
    rng = np.random.default_rng(judged)
    key = np.sort(rng.integers(0, 60, 2000))
    columns = [key, rng.integers(0, 4, 2000), rng.integers(0, 30, 2000), (np.arange(2000) << 5) | (rng.integers(1, 9, 2000) << 1)]
    cuts = np.unique(np.r_[0, rng.integers(0, 2000, 40), 2000])
    batches = [pa.RecordBatch.from_arrays([pa.array(c[a:b]) for c in columns], ["key", "content", "doc", "place"]) for a, b in zip(cuts, cuts[1:])]
    flat = lambda found: sorted(tuple(r.values()) for batch in found for r in batch.to_pylist())
    whole = flat(substring._judge(substring.SHARD)(iter(batches)))
    steps = list(substring._judge(substring.SHARD, judged)(iter([batches[0].slice(0, 0), *batches])))
    assert flat(steps) == whole and len(steps) > 1
    crowded = flat(substring._judge(5, judged)(iter(batches)))
    assert len(crowded) == len(whole) and any(r[-1] for r in crowded) and not any(r[-1] for r in whole)


def test_edge_cases(spark):
    long = " ".join(f"a{k}" for k in range(20))
    rows = [(1, None), (2, ""), (3, long), (4, long), (4, long + " x"), (5, "z " * 20000), (6, "z " * 13), (None, long), (7, "one two")]
    assert run(spark, rows) == brute_force(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("doc", F.lit("x"))
    assert remove_repeats(df).count() == len(rows)
    assert remove_repeats(df.limit(0)).count() == 0


def test_matching_statistics():
    rng = random.Random(4)
    for _ in range(50):
        refs = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 20))] for _ in range(4)]
        automaton = SuffixAutomaton()
        for r in refs:
            automaton.add(r)
        q = [rng.choice([b"a", b"b", b"c"]) for _ in range(25)]
        inside = lambda s: any(r[k : k + len(s)] == s for r in refs for k in range(len(r) - len(s) + 1))
        want = [max(n for n in range(e + 2) if inside(q[e + 1 - n : e + 1])) for e in range(len(q))]
        assert automaton.longest(q) == want


def test_equal_windows_have_equal_anchors():
    rng, memory = random.Random(6), WordHashes()
    words = [b"%d" % rng.randint(0, 3) for _ in range(400)]
    seen = {}
    for at in (0, 7, 100):
        anchor, _, starts, counts = pieces(memory.of(words[at:]))
        assert counts.sum() == len(words) - at - W + 1 and counts.max() <= W
        for a, s, n in zip(anchor, starts, counts):
            for k in range(s, s + n):
                window = tuple(words[at + k : at + k + W])
                assert seen.setdefault(window, a) == a
    assert np.array_equal(pieces(memory.of(words[:W]))[2], [0])


def test_no_table_stays_in_the_catalog(spark):
    before = {t.name for t in spark.catalog.listTables()}
    out = remove_repeats(spark.createDataFrame(corpus(4, 20, 30), "doc_id long, text string"))
    assert {t.name for t in spark.catalog.listTables()} == before
    out.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = out.select("*")._jdf.queryExecution().toString()
    finally:
        out.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert out.count() == 20 and "Bucketed: true" in plan  # a join by doc does not move texts


def test_ids_of_any_type(spark):
    rows = [(doc, text) for doc, text in corpus(11, 60, 30) if doc is not None]
    named = [(f"é{doc % 7}-{doc}", text) for doc, text in rows]
    out = remove_repeats(spark.createDataFrame(named, "doc_id string, text string").withColumn("number", F.lit("x")))
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept"]
    got = sorted(tuple(r) for r in out.collect())
    assert got == brute_force(named)
    assert sum(r[2] for r in got) > 0
    decimals = spark.createDataFrame(rows, "doc_id long, text string").withColumn("doc_id", (F.col("doc_id") / 4).cast("decimal(20,2)"))
    assert sorted((int(r["doc_id"] * 4), *tuple(r)[1:]) for r in remove_repeats(decimals).collect()) == brute_force(rows)
    empty = spark.createDataFrame([(None, "x"), (None, None)], "doc_id string, text string")
    assert sorted(tuple(r) for r in remove_repeats(empty).collect()) == [(None, 0, 0, ""), (None, 1, 0, "x")] and remove_repeats(empty.limit(0)).count() == 0
