"""A conversion stores its fragments and no other text; a chunk is judged within its row as the join of tokens judges it."""

import random

from pyspark.sql import functions as F

from corpuskiln.operators import audit, backend, chunking
from corpuskiln.plans import flows, queries
from corpuskiln.sources import sinks

SF = "/root/testdata/sf0.001"


def stored_texts(monkeypatch, make):
    """Names of what is stored with a text, or tokens, or a request in it."""
    names, real = [], sinks.stored

    def noting(rows, name):
        if {"text", "tex", "t", "chunk", "prompt", "sources"} & set(rows.columns):
            names.append(name)
        return real(rows, name)

    monkeypatch.setattr(sinks, "stored", noting)
    return make().count(), names


def test_only_fragments_are_stored(spark, monkeypatch):
    n, names = stored_texts(monkeypatch, lambda: queries.convert_chunks(spark, SF))
    assert n >= 20 and names == ["fragments"]  # before: pages, requests, fragments, page-tokens


def test_only_fragments_are_stored_where_attempts_are_recovered(spark, monkeypatch):
    n, names = stored_texts(monkeypatch, lambda: queries.recovered_chunks(spark, SF))
    assert n >= 20 and names == ["fragments"]


def test_a_report_stores_fragments_once(spark, monkeypatch):
    n, names = stored_texts(monkeypatch, lambda: queries.document_report(spark, SF))
    assert n == 20 and names == ["fragments"]


def test_coverage_within_a_row_is_that_of_the_join(spark):
    pick = random.Random(5)
    words = [f"word{i}" for i in range(60)] + ["Table", "end", "的的", "x"]
    text = lambda n: None if pick.random() < 0.05 else " ".join(pick.choice(words) for _ in range(n))
    parts = [(k, [(i, text(pick.choice([0, 3, 40, 80]))) for i in range(pick.choice([1, 2, 12, 25]))], text(pick.choice([0, 20, 60, 400]))) for k in range(120)]
    rows = spark.createDataFrame(parts, "part int, sources array<struct<page_no: int, text: string>>, tex string")
    pages = rows.select("part", F.inline("sources"))
    joined = audit.completeness(audit.coverage(pages, rows.select("part", F.col("tex").alias("text")), ["part"]), ["part"])
    want = {r["part"]: (r["overall_coverage"], r["passed"]) for r in joined.collect()}
    got = {r["part"]: (r["c"]["overall_coverage"], r["c"]["passed"]) for r in rows.select("part", audit.chunk_coverage(F.col("sources"), F.col("tex")).alias("c")).collect()}
    assert got == want and len({p for _, p in got.values()}) == 2


def test_texts_may_join_by_document(spark):
    texts = spark.createDataFrame([(10 + i, t) for i, t in enumerate(["one " * 50, None, "three " * 50])], "doc_id long, text string")
    numbers = spark.createDataFrame([("b", i, 10 + i) for i in range(3)], "book string, page_no int, doc_id long")
    pages = numbers.join(texts, "doc_id").drop("doc_id")
    plan = chunking.plan_parts(pages.selectExpr("book", "page_no", "length(coalesce(text, '')) chars"), ["book"], 200)
    show = lambda out: sorted((r["part"], tuple(r["pages"]), r["tex"], r["accepted"]) for r in out.collect())
    assert show(flows.convert(numbers, plan, ["book"], texts=texts)) == show(flows.convert(pages, plan, ["book"]))


def test_a_null_prompt_is_not_asked(spark):
    asked = spark.createDataFrame([(1, "<SOURCE>\na\n</SOURCE>"), (2, None)], "i int, prompt string").coalesce(1)
    got = sorted(map(tuple, backend.generate(asked, drop=("prompt",)).select("i", F.col("answer").isNull(), "error", "tries").collect()))
    assert got == [(1, False, None, 1), (2, True, None, 0)]
