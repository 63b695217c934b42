import random
import re

import pytest
from pyspark.sql import functions as F

from corpuskiln.functions import text as X
from corpuskiln.functions.text import find_all
from corpuskiln.operators import glossary, matching


def make_terms(spark, rows):
    full = [(i, *r, *([None] * (7 - len(r)))) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, f"term_no long, {glossary.TERM_SCHEMA}")


def found(spark, text, rows, domain=None, general=False):
    known = glossary.active_terms(make_terms(spark, rows), domain)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    out = matching.by_tokens(docs, glossary.phrases(known), "text") if general else matching.find_terms(docs, known)
    return [(r["start"], r["end"], r["source"], r["matched_text"]) for r in out.orderBy("start").collect()]


FIELD = [("field", "F", ["*"]), ("fraction field", "FF", ["*"])]


@pytest.mark.parametrize("general", [False, True])
def test_longest_match_wins(spark, general):
    got = found(spark, "The fraction field is a field.", FIELD, general=general)
    assert [g[:3] for g in got] == [(4, 18, "fraction field"), (24, 29, "field")]


def test_domain_gating(spark):
    rows = [("ring", "R", ["algebra"]), ("map", "M", ["general"])]
    assert [g[2] for g in found(spark, "a ring map", rows)] == ["map"]
    assert [g[2] for g in found(spark, "a ring map", rows, "Algebra")] == ["ring", "map"]


@pytest.mark.parametrize("general", [False, True])
def test_alias_reports_the_canonical_source(spark, general):
    rows = [("local ring", "L", None, ["quasi local  ring"])]
    assert found(spark, "A Quasi\nLocal ring here", rows, general=general) == [(2, 18, "local ring", "Quasi\nLocal ring")]


def test_status_and_missing_sides(spark):
    rows = [("a", "A", None, None, "draft"), ("b", "", None), ("c", "C", None)]
    got = {r["source"]: r["error"] for r in glossary.active_terms(make_terms(spark, rows)).collect()}
    assert got == {"b": "source or target is missing", "c": None}


def test_conflicting_targets(spark):
    rows = [("normal form", "N1", ["*"]), ("standard form", "N2", ["*"], ["Normal  Form"])]
    got = glossary.conflicts(glossary.active_terms(make_terms(spark, rows))).collect()
    assert [(r["key"], r["first_target"], r["last_target"]) for r in got] == [("normal form", "N1", "N2")]


def test_term_table_is_conservative(spark):
    lines = ["English\tOther", "", "no tab", "vector  space A\t v s ", "Ring\tr", "L-function\tl", "Topology\tt", "环\tx", "x{y} z\tq", "a\tb\tc", "vector space\tlater"]
    rows = spark.createDataFrame([(0, i, v) for i, v in enumerate(lines)], "table_no int, line_no int, value string")
    table = glossary.parse_term_table(rows)
    base = glossary.active_terms(make_terms(spark, FIELD))
    take = lambda single: sorted((r["source"], r["target"]) for r in glossary.add_table_terms(base, table, single).where(F.col("term_no") >= (1 << 40)).collect())
    assert take(False) == [("L-function", "l"), ("vector space", "vs")]
    assert take(True) == [("L-function", "l"), ("Topology", "t"), ("vector space", "vs")]


def test_approve_adds_and_updates(spark):
    base = make_terms(spark, FIELD)
    added = glossary.approve_term(base, "Stack", "S", "geometry", "ref")
    assert [(r["term_no"], r["source"], r["status"]) for r in added.where("source = 'Stack'").collect()] == [(2, "Stack", "approved")]
    again = glossary.approve_term(added, "stack", "S2", "Geometry", "ref2")
    assert [(r["source"], r["target"], r["source_reference"]) for r in again.where("lower(source) = 'stack'").collect()] == [("Stack", "S2", "ref2")]
    docs = spark.createDataFrame([(1, "A stack.")], "doc_id long, text string")
    assert matching.find_terms(docs, glossary.active_terms(again, "geometry")).count() == 1


def plain_matches(text, phrases):
    """The greedy rule, said literally."""
    hits = []
    for p in phrases:
        body = r"\s+".join(map(re.escape, p.split()))
        hits += [(m.start(), m.end(), p) for m in re.finditer(rf"(?<![A-Za-z0-9_]){body}(?![A-Za-z0-9_])", text, re.IGNORECASE)]
    taken = []
    for h in sorted(hits, key=lambda h: (h[0], h[0] - h[1], h[2])):
        if not any(h[0] < e and h[1] > s for s, e, _ in taken):
            taken.append(h)
    return sorted(taken)


def test_both_ways_equal_the_plain_rule(spark):
    rng = random.Random(3)
    phrases = ["a b", "b", "b c", "c a b", "a b a", "c"]
    texts = [(i, "".join(rng.choice(["a ", "b ", "c ", "\n", "x", ", "]) for _ in range(40))) for i in range(60)]
    known = glossary.active_terms(make_terms(spark, [(p, p.upper(), ["*"]) for p in phrases]))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    for use, out in ((phrases, matching.find_terms(docs, known)), ([p for p in phrases if p != "a b a"], matching.find_terms(docs, known.where("source <> 'a b a'")))):
        got = {}
        for r in out.collect():
            got.setdefault(r["doc_id"], []).append((r["start"], r["end"], r["source"]))
        assert {i: sorted(v) for i, v in got.items()} == {i: m for i, t in texts if (m := plain_matches(t, use))}


def test_offsets_count_code_points(spark):
    got = spark.range(1).select(find_all(F.lit("😀ab😀😀ab"), "ab").alias("m")).first()["m"]
    assert [(x["start"], x["end"]) for x in got] == [(1, 3), (5, 7)]


def test_forms_and_rules(spark):
    docs = spark.createDataFrame([(2, "Field field FIELD Field"), (1, "field Field")], "doc_id long, text string")
    m = matching.find_terms(docs, glossary.active_terms(make_terms(spark, FIELD)))
    assert [(r["matched_text"], r["n"]) for r in matching.form_counts(m).orderBy("form_no").collect()] == [("Field", 3), ("field", 2), ("FIELD", 1)]
    assert {(r["doc_id"], r["matched_text"]) for r in matching.unique_rules(m).collect()} == {(1, "field"), (2, "Field")}


def test_more_matches_than_a_block_of_the_fold(spark):
    texts = [(n, "é" + "ab, " * n) for n in (0, 1, 255, 256, 257, 1000)] + [(9, None)]
    out = spark.createDataFrame(texts, "n int, text string").select("n", find_all(F.col("text"), "ab").alias("m")).collect()
    got = {r["n"]: None if r["m"] is None else [(x["start"], x["end"], x["text"]) for x in r["m"]] for r in out}
    assert got == {n: None if t is None else [(1 + 4 * i, 3 + 4 * i, "ab") for i in range(n)] for n, t in texts}
    rows = [("a b", "1", ["*"]), ("b", "2", ["*"])]
    assert [g[:3] for g in found(spark, "a b b " * 700, rows, general=True)] == [m for i in range(0, 4200, 6) for m in ((i, i + 3, "a b"), (i + 4, i + 5, "b"))]


@pytest.mark.parametrize("general", [False, True])
def test_phrases_without_an_ascii_word(spark, general):
    rows = [("环", "1", ["*"]), ("环 面", "2", ["*"]), ("😀", "3", ["*"]), ("É", "4", ["*"]), ("§", "5", ["*"])]
    assert [g[:3] for g in found(spark, "x 环\n面 é😀 a§", rows, general=general)] == [(2, 5, "环 面"), (6, 7, "É"), (7, 8, "😀")]
    assert found(spark, "", rows, general=general) == [] and found(spark, "plain words", rows, general=general) == []


CASES = [("\u212a", "k"), ("ſ", "s"), ("İ", "i"), ("ı", "i"), ("ς", "σ"), ("Σ", "σ"), ("É", "é"), ("ẞ", "ß"), ("ß", "ss"), ("ﬁ", "fi"), ("Ǆ", "ǆ"), ("ᾼ", "ᾳ"), ("𐐀", "𐐨")]


def test_folding_equals_python(spark):
    texts = [a for pair in CASES for a in pair] + ["MASSE Maße", "ΟΔΟΣ οδος", "İstanbul ıI", "plain TEXT", "", "".join(map(chr, range(0x80, 0x2200))), None]
    out = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", X.fold_case(F.col("t")).alias("f"), (F.length(X.fold_signs(F.col("t"))) == F.length("t")).alias("same")).collect()
    assert {r["i"]: r["f"] for r in out} == {i: t if t is None else t.casefold() for i, t in enumerate(texts)}
    assert all(r["same"] in (True, None) for r in out)


def test_ignored_case_is_that_of_patterns(spark):
    """A phrase matches a text sign by sign as the pattern of the JVM that ignores case does, in both ways."""
    words = ["king", "ſun", "οδος", "straße", "ıris", "é", "x-ray", "naïve map"]
    texts = ["the \u212aing and king", "SUN ſun", "ΟΔΟΣ οδοσ", "STRASSE Straße STRAẞE", "IRIS İris ıris iris", "É é xé é\u212a", "X-RAY x-rays x- ray", "Naïve  MAP\nnaïve map"]
    known = glossary.phrases(glossary.active_terms(make_terms(spark, [(w, w, ["*"]) for w in words])))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    pattern = docs.crossJoin(known.select("source", X.phrase_pattern(F.col("phrase")).alias("p")))
    want = sorted((r["doc_id"], r["m"]["start"], r["m"]["end"], r["source"]) for r in pattern.select("doc_id", "source", F.explode(find_all(F.col("text"), F.col("p"))).alias("m")).collect())
    terms = glossary.active_terms(make_terms(spark, [(w, w, ["*"]) for w in words]))
    shape = lambda out: sorted((r["doc_id"], r["start"], r["end"], r["source"]) for r in out.collect())
    assert shape(matching.find_terms(docs, terms)) == want
    keyed = known.withColumn("key", X.fold_signs(F.col("phrase")))
    assert shape(matching.by_tokens(docs, keyed, "text")) == want
    assert (0, 4, 8, "king") in want and (0, 13, 17, "king") in want


@pytest.mark.parametrize("seed", [1, 2])
def test_size_of_the_dictionary_changes_nothing(spark, monkeypatch, seed):
    rng = random.Random(seed)
    signs = ["a ", "B ", "b", "\u212a", "k ", "ß", "é ", "-", "\n ", "x_1 ", "İ", "环"]
    texts = [(i, "".join(rng.choice(signs) for _ in range(rng.choice([0, 5, 80, 700])))) for i in range(40)] + [(99, None)]
    phrases = {"".join(rng.choice(signs) for _ in range(rng.choice([1, 2, 3]))).strip() for _ in range(60)} - {""}
    rows = [(p, f"T{i}", ["*"]) for i, p in enumerate(sorted(phrases)) if not matching.overlaps_itself(" ".join(p.casefold().split()))]
    docs, terms = spark.createDataFrame(texts, "doc_id long, text string"), glossary.active_terms(make_terms(spark, rows))
    take = lambda **o: sorted(tuple(str(x) for x in r) for r in matching.find_terms(docs, terms, **o).collect())
    small = take(), take(offsets=False)
    monkeypatch.setattr(matching, "ONE_PATTERN", 0)
    monkeypatch.setattr(matching, "RUNS", 7)
    assert len(small[0]) > 100 and (take(), take(offsets=False)) == small
