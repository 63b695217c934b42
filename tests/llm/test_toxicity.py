import itertools
import random

import pytest
from pyspark.sql import functions as F

from corpuskiln.llm import toxicity
from corpuskiln.llm.toxicity import LexiconAutomaton, Scorer, Term, ToxicityModel


def distance(a, b):
    """Edits between two words, swaps of neighbours among them (optimal string alignment)."""
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(1)
    terms = [Term("abcab", False, 1.0), Term("cabba", True, 1.0), Term("abcabcabc", False, 1.0), Term("abc", False, 1.0), Term("bbbbb", False, 1.0, fuzzy=False)]
    automaton = LexiconAutomaton(terms)
    for _ in range(3000):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(0, 11)))
        want = None
        for k, t in enumerate(terms):
            ends = range(len(word) + 1) if t.stem else [len(word)]
            e = min(distance(t.text, word[:n]) for n in ends)
            if e <= t.edits and (want is None or (e, k) < (want[1], want[0])):
                want = (k, e)
        assert automaton.match(word) == want, word


def test_context():
    plain = "they are all idiot here"
    scorer = Scorer(ToxicityModel([Term("idiot", False, 1.0)]))
    score = lambda t: scorer.hits(t)[0][2]
    assert score(plain) == 1.0
    assert score('he "is an idiot they" think') == 0.2
    assert score("he „so idiot ja“ x") == 0.2
    assert score("she said idiot") == 0.5
    assert score("you idiot") == 1.5
    assert score('"closed" then idiot') == 1.0
    far = "so " * 60
    assert score(f'he “{far}idiot {far}” x') == score(f'“a «b» {far}idiot {far}”') == 0.2
    assert score(f'"one" {far}"two" idiot "three"') == 1.0
    assert score('"open\nidiot" x') == 1.0


def test_states_are_bounded(monkeypatch):
    import corpuskiln.llm.toxicity as toxicity

    monkeypatch.setattr(toxicity, "STATES", 50)
    rng = random.Random(3)
    automaton = LexiconAutomaton([Term("dunghead", False, 1.0), Term("vermin", True, 1.0)])
    fresh = LexiconAutomaton(automaton.terms)
    for _ in range(400):
        word = "".join(rng.choice("vermindughea") for _ in range(rng.randint(1, 12)))
        fresh._forget()
        assert automaton.match(word) == fresh.match(word)
        assert len(automaton.items) <= 50 + len(word) + 1


def corpus(spark, n=900):
    rng = random.Random(7)
    clean = [f"word{k}" for k in range(200)]
    rows, labels = [], []
    for i in range(n):
        t = [rng.choice(clean) for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(rng.randint(1, 3)):
                t.insert(rng.randint(0, len(t)), rng.choice(["vermin", "dunghead", "zlor" + rng.choice("abcdefgh") + rng.choice("xyzuvw")]))
        rows.append((i, " ".join(t)))
        labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus(spark)
    return docs, labels, toxicity.fit(docs, labels)


def test_lexicon_has_words_and_stems(fitted):
    terms = {(t.text, t.stem) for t in fitted[2].terms}
    assert {("vermin", False), ("dunghead", False), ("zlor", True)} <= terms


def test_held_out_accuracy(fitted):
    docs, labels, model = fitted
    out = toxicity.score(docs, model).join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id"))).select("toxicity.score", "toxic").collect()
    assert len(out) > 200 and sum((r["score"] >= toxicity.THRESHOLD) == bool(r["toxic"]) for r in out) >= 0.98 * len(out)


def test_labels_of_held_out_rows_are_never_read(spark, fitted):
    docs, labels, model = fitted
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, turned) == model


def test_misspelled_and_quoted(spark, fitted):
    rows = [(1, "such vermni here, dungheda"), (2, 'they wrote "vermin" and "dunghead" there'), (3, "nothing")]
    got = {r["doc_id"]: r["toxicity"] for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), fitted[2]).collect()}
    assert got[1]["n_misspelled"] == 2 and got[1]["score"] > got[2]["score"] > 0 and got[2]["n_quoted"] == 2
    assert got[3]["n_hits"] == 0


def test_edge_cases(spark, fitted):
    rows = [(1, None, "x"), (2, "", "x"), (None, "vermin", "x"), (3, "word1 " * 50000 + "vermin", "x"), (3, "vermin", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    out = toxicity.score(df, fitted[2])
    assert out.columns == [*df.columns, "toxicity"] and out.count() == 5
    assert all(0 < r["toxicity"]["score"] < 1 for r in out.collect())
    empty = df.limit(0)
    assert toxicity.score(empty, fitted[2]).count() == 0
    nothing = toxicity.fit(empty.drop("score"), fitted[1].limit(0))
    assert nothing.terms == [] and toxicity.score(df, nothing).where("toxicity.score >= 0.7").count() == 0
    assert df.select(toxicity.held_out(F.col("doc_id")).alias("h")).where("h is null").count() == 0
