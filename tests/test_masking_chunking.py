import random

import pytest
from pyspark.sql import functions as F

from corpuskiln.functions import text as X
from corpuskiln.operators import chunking, masking

MARKDOWN = """---
title: x
---
# Head $x^2$ and [link](http://a.b/c) `code`

```py
let $y$
```
~~~
tilde
~~~
<!-- note -->
$$ a + b $$ \\[ c \\] \\( d \\) \\ref{eq:1} <https://x.y> http://z.w <b>
\\begin{align} e \\end{align} \\S 3 \\verb|f|
% line
"""


def masked(spark, *texts, kind="Markdown"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return masking.mask(df, kind=kind)


def test_markdown_round_trip(spark):
    m = masked(spark, MARKDOWN)
    back = masking.restore(F.col("mask.masked"), F.col("mask.tokens"), F.col("mask.originals"))
    r = m.select("mask", back.alias("back")).first()
    assert r["mask"]["error"] is None and r["back"]["text"] == MARKDOWN and r["back"]["error"] is None
    for gone in ("title", "x^2", "a.b/c", "`code`", "let", "tilde", "note", "a + b", "eq:1", "x.y", "z.w", "<b>", "align", "verb", "% line"):
        assert gone not in r["mask"]["masked"]
    assert len(r["mask"]["tokens"]) == len(r["mask"]["originals"]) == 18


def test_latex_round_trip(spark):
    text = "\\begin{verbatim} $x$ \\end{verbatim} \\cite{a} \\label{b} plain `tick` <b>"
    r = masked(spark, text, kind="LaTeX").first()["mask"]
    assert "verbatim" not in r["masked"] and "cite" not in r["masked"] and "`tick` <b>" in r["masked"]


@pytest.mark.parametrize("text", ["@@MATH_TRANSLATOR_ x", "<a href='http://x.y/z'>", "% a $$b$$ c", "[t](a $x$ b)"])
def test_texts_that_cannot_be_masked_keep_their_row(spark, text):
    assert masked(spark, text).first()["mask"]["error"] is not None


def test_restore_rejects_lost_and_unknown_tokens(spark):
    m = masked(spark, "a $x$ b").withColumn("lost", F.lit("a b")).withColumn("more", F.concat("mask.masked", F.lit("@@MATH_TRANSLATOR_000009@@")))
    for c in ("lost", "more"):
        assert m.select(masking.restore(F.col(c), F.col("mask.tokens"), F.col("mask.originals"))["error"]).first()[0]
    bad = m.select(masking.token_errors(F.col("mask.masked"), F.lit("x\x07"), F.col("mask.tokens")).alias("e")).first()["e"]
    assert bad == "control character U+0007"


def test_null_and_unknown_format(spark):
    assert masked(spark, None).first()["mask"]["masked"] == ""
    assert masked(spark, "a", kind="Word").first()["mask"]["error"] == "unknown format Word"


def chunks_of(spark, text, size):
    col = chunking.pack_blocks(F.col("text"), size)["chunk"]
    return spark.createDataFrame([(text,)], "text string").select(col.alias("c")).first()["c"]


def plain_chunks(text, size):
    import re

    out, now = [], ""
    for b in re.split(r"(\r?\n[ \t]*\r?\n)", text):
        if now and len(now) + len(b) > size:
            out.append(now)
            now = b
        else:
            now += b
    return out + [now] if now or not out else out


def test_chunks_join_to_the_source(spark):
    rng = random.Random(1)
    for _ in range(8):
        text = "".join(rng.choice(["x" * rng.randint(1, 700), "\n\n", "\r\n \r\n", "\n"]) for _ in range(20))
        got = chunks_of(spark, text, 1000)
        assert "".join(got) == text and got == plain_chunks(text, 1000)
    assert chunks_of(spark, "", 1000) == [""]
    with pytest.raises(ValueError):
        chunking.pack_blocks(F.col("text"), 999)


@pytest.mark.parametrize(("chars", "size", "want"), [([10] * 4, 20, [0, 0, 1, 1]), ([50, 1, 1, 1], 20, [0, 1, 2, 2]), ([1, 1, 50], 20, [0, 0, 0]), ([5], 20, [0]), ([30, 30], 60, [0, 0])])
def test_balanced_parts(spark, chars, size, want):
    pages = spark.createDataFrame([("b", i, c) for i, c in enumerate(chars)], "book string, page_no int, chars int")
    got = chunking.plan_parts(pages, ["book"], size)
    assert [r["part"] for r in got.orderBy("page_no").collect()] == want
    assert sum(r["chars"] for r in chunking.part_ranges(got, ["book"]).collect()) == sum(chars)


def test_a_match_across_a_border_is_in_both_chunks(spark):
    chunks = spark.createDataFrame([(1, 0, 0, 10), (1, 1, 10, 20)], "doc_id long, chunk_no int, chunk_start int, chunk_end int")
    spans = spark.createDataFrame([(1, 5, 15), (1, 10, 12)], "doc_id long, start int, end int")
    got = sorted((r["chunk_no"], r["start"]) for r in chunking.overlapping(chunks, spans).collect())
    assert got == [(0, 5), (1, 5), (1, 10)]


def test_range_joins(spark):
    parts = spark.createDataFrame([("b", 0, 0, 2), ("b", 1, 3, 4)], "book string, part int, first_page int, last_page int")
    pages = spark.createDataFrame([("b", n, n) for n in (0, 2, 3)], "book string, page_no int, n int")
    assert chunking.pages_of_ranges(parts, pages, ["book"]).count() == 3
    sections = spark.createDataFrame([("b", 2), ("b", None), ("b", 4)], "book string, section_start int")
    assert sorted((r["part"], r["section_start"]) for r in chunking.sections_in_parts(parts, sections, ["book"]).collect()) == [(0, 2), (1, 4)]
    assert chunking.contiguity_violations(parts, ["book"], "part").count() == 0
    gap = parts.withColumn("first_page", F.when(F.col("part") == 1, 4).otherwise(F.col("first_page")))
    assert chunking.contiguity_violations(gap, ["book"], "part").count() == 1


def test_text_functions(spark):
    one = spark.createDataFrame([("a  b \r\n\n c\x0bd\n",)], "t string")
    assert one.select(X.nonempty_lines(F.col("t"))).first()[0] == ["a b", "c", "d"]
    assert one.select(X.lines(F.lit("a\nb\n"))).first()[0] == ["a", "b"]
    value = lambda c: one.select(c).first()[0]
    assert value(X.tex_escape(F.lit("a\\b_{c}&%#"))) == "a\\textbackslash{}b\\_\\{c\\}\\&\\%\\#"
    assert value(X.content_tokens(F.lit("étage 汉字 汉 begin word_1 abc"))) == ["tage", "汉字", "word_1"]
    assert value(X.arxiv_id(F.lit("see https://arxiv.org/abs/2101.01234v3 now"))) == "2101.01234v3"
    assert value(X.safe_dir_name(X.arxiv_id(F.lit("math.AG/0102030")))) == "arXiv_math.AG_0102030"
    assert value(X.image_references(F.lit("<img src=' a\\b.png'> ![x](c.png) ![y](a/b.png)"))) == ["a/b.png", "c.png"]
    assert value(X.output_path(F.lit("d/x.tex"))) == "d/x.zh.tex" and value(X.document_format(F.lit("x.LTX"))) == "LaTeX"
    assert value(X.drop_class_marker(F.lit(" vector   space A "))) == "vector space"
    assert value(X.macro_before_han(F.lit("a\n\\alpha中"))) is True
