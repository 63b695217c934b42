import json

import pytest
from pyspark.sql import functions as F

from corpuskiln.operators import assemble, audit, backend, boundaries, ledger, lifecycle


def pages(spark, *texts, book="b"):
    return spark.createDataFrame([(book, i, t) for i, t in enumerate(texts)], "book string, page_no int, text string")


def bounds(spark, *texts):
    r = boundaries.detect_boundaries(pages(spark, *texts)).first()
    return (r["contents_page"], r["body_start_page"], r["end_page_excluded"], r["error"])


def test_boundaries(spark):
    toc = "A .... 1\nB …… 2"
    assert bounds(spark, "title", "# Contents\nA 1", toc, "", "", "Chapter", "text", "References") == (1, 5, 7, None)
    assert bounds(spark, "目录", "x 1", "## INDEX") == (0, 1, 2, None)
    assert bounds(spark, "Table of Contents", "数学家生平简介\n body") == (0, 1, 1, None)
    assert bounds(spark, "Contents", "", "  ")[3] == "no body page after the contents"
    assert bounds(spark, *["x"] * 32, "Contents", "y")[3] == "no contents page among the first pages"


def test_metadata(spark):
    p = pages(spark, "x", "# The  Title\n[著] An Author\nmore", "# Other", "Contents", "body")
    assert tuple(boundaries.infer_metadata(p, boundaries.detect_boundaries(p)).first())[1:] == ("The Title", "An Author")
    q = pages(spark, "Contents", "body")
    assert tuple(boundaries.infer_metadata(q, boundaries.detect_boundaries(q)).first())[1:] == ("OCR Document", "")
    r = pages(spark, "# T\n# Not an author", "Contents", "body")
    assert tuple(boundaries.infer_metadata(r, boundaries.detect_boundaries(r)).first())[1:] == ("T", "")


def test_manifest_rules(spark):
    p = pages(spark, *"abcdef")
    rows = [("b", 1, 2, None), ("b", 9, 2, None), ("b", 2, 2, None), ("b", 1, 2, 2), ("b", 1, 2, 9)]
    m = spark.createDataFrame(rows, "book string, contents_page int, body_start_page int, end_page_excluded int")
    assert [r["error"] for r in boundaries.manifest_errors(m, p).collect()] == [None, "contents_page is not a page", "the body does not follow the contents", "the end does not follow the body's start", "end_page_excluded is not a page"]


def chapter_errors(spark, *rows):
    shape = "book string, number int, title string, ocr_start_page int, ocr_end_page int, sections array<struct<title:string,ocr_start_page:int>>"
    m = spark.createDataFrame([("b", 0, 1, 6)], "book string, contents_page int, body_start_page int, end_page_excluded int")
    out = boundaries.chapter_errors(spark.createDataFrame(rows, shape), m, pages(spark, *"abcdefg"))
    return sorted((r["number"], r["error"]) for r in out.collect())


def test_chapter_rules(spark):
    good = [("b", 1, "A", 1, 3, [("s", 2), ("t", None)]), ("b", 2, "B", 4, 5, [])]
    assert chapter_errors(spark, *good) == []
    assert chapter_errors(spark, good[0], ("b", 3, " ", 5, 9, [(None, 4)])) == [
        (3, "a section has no title"),
        (3, "a section starts outside its chapter"),
        (3, "does not follow the chapter before"),
        (3, "numbers are not consecutive"),
        (3, "the last chapter does not reach the end"),
        (3, "the range has pages that do not exist"),
        (3, "the title is empty"),
    ]
    assert (1, "starts before the body") in chapter_errors(spark, ("b", 1, "A", 0, 5, []))
    assert {e for _, e in chapter_errors(spark, ("b", 1, "A", 3, 2, None))} >= {"no valid page range", "the list of sections is missing"}


def test_page_index(spark):
    p = pages(spark, "\n".join(f"# h{i}" for i in range(10)))
    r = boundaries.page_index(p).first()
    assert r["headings"] == [f"# h{i}" for i in range(8)] and r["opening"] == ["# h0", "# h1", "# h2"]


WORDS = [f"word{i}" for i in range(10)]
LONG = " ".join(WORDS) + " " * 5 + "-" * 200


def completeness(spark, sources, output):
    out = spark.createDataFrame([("b", output)], "book string, text string")
    return audit.completeness(audit.coverage(pages(spark, *sources), out, ["book"]), ["book"]).first()


def test_coverage(spark):
    r = completeness(spark, [LONG], " ".join(WORDS[:7]))
    assert (r["overall_coverage"], r["missing_pages"], r["passed"]) == (0.7, 0, False)
    assert completeness(spark, ["short"], "")["passed"]
    r = completeness(spark, [LONG, "- " * 200], " ".join(WORDS[:1]))
    assert (r["overall_coverage"], r["missing_pages"], r["allowed_missing_pages"]) == (0.1, 1, 1)
    assert completeness(spark, [LONG], " ".join(WORDS))["passed"]


@pytest.mark.parametrize(
    ("tex", "rule"),
    [
        (" \n", "empty"),
        ("  ```tex", "code fence"),
        ("x \\documentclass{a}", "root document command"),
        ("<TABLE border>", "html table"),
        ("\\caption{ image }", "placeholder caption"),
        ("\\text{a}" * 40, "prose in text wrappers"),
        (("\\text{a}" * 3 + "x" * 700 + "\n") * 2, "prose in text wrappers"),
        ("\\chapter*{A}", "chapter heading in a chunk"),
        ("\\section{A}", None),
    ],
)
def test_artifact_rules(spark, tex, rule):
    df = spark.createDataFrame([(tex,)], "t string")
    assert df.select(audit.artifact_error(F.col("t"), F.lit(True))).first()[0] == rule


def test_report_rules(spark):
    shape = "chunk_id string, pages array<int>, report struct<chunk_id:string,source_pages:array<int>,structure_notes:array<string>,image_notes:array<string>>"
    rows = [("c", [1, 2], ("c", [1, 2], [], [])), ("c", [1, 2], ("d", [1, 2], [], [])), ("c", [1, 2], ("c", [2, 1], [], [])), ("c", [1, 2], ("c", [1, 2], None, []))]
    df = spark.createDataFrame(rows, shape)
    assert [r[0] for r in df.select(audit.report_error(F.col("chunk_id"), F.col("pages"), F.col("report"))).collect()] == [None, "chunk_id differs", "source_pages differ", "structure_notes is missing"]


def test_structural_warnings(spark):
    df = spark.createDataFrame([("# a\n---\n\\section{x}\\label{l}\\ref{r}", "## a\n\\section*{x}\\label{m}\\cite{r}")], "a string, b string")
    assert df.select(audit.structural_warnings(F.col("a"), F.col("b"))).first()[0] == ["headings", "rules", "sections", "labels"]
    assert df.select(audit.structural_warnings(F.col("a"), F.col("a"))).first()[0] == []


LEDGER = "source string, target string, domain string, reason string, status string, occurrences long, first_seen timestamp, last_seen timestamp"


def test_ledger_accumulates(spark):
    now = F.lit("2024-02-01").cast("timestamp")
    base = spark.createDataFrame([("x", "t", "d", "old", "candidate", 1, None, None), ("q", "t", "d", "", "rejected", 4, None, None)], LEDGER)
    raw = [("X", "t", "D", "", 0), (" x ", "t", "d", "new", 1), ("z", "t", "", None, 2), ("z", "", "d", "", 3), ("y" * 121, "t", "d", "", 4)]
    batch = ledger.sanitize(spark.createDataFrame(raw, "source string, target string, domain string, reason string, no int"))
    got = {r["source"]: (r["occurrences"], r["reason"], r["status"], r["domain"]) for r in ledger.upsert(base, batch, now).collect()}
    assert got == {"x": (3, "new", "candidate", "d"), "q": (4, "", "rejected", "d"), "z": (1, "", "candidate", "unspecified")}
    assert ledger.upsert(base, batch.limit(0), now).exceptAll(base).count() == 0


def test_lifecycle(spark):
    work = spark.createDataFrame([("a",), ("b",), ("c",)], "chunk string")
    tries = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("b", 1, False)], "chunk string, mtime int, ok boolean")
    assert sorted(r[0] for r in lifecycle.pending(work, tries, ["chunk"], F.col("ok")).collect()) == ["b", "c"]
    assert [(r["chunk"], r["mtime"]) for r in lifecycle.latest_valid(tries, ["chunk"], ["mtime"], F.col("ok")).collect()] == [("a", 1)]
    refs = spark.createDataFrame([(["img/a.png", "./img/b.png", "../x.png", "http://x/y.png", "img/c.png"],)], "refs array<string>")
    have = spark.createDataFrame([("img/a.png",), ("img/b.png",)], "path string")
    assert sorted(r["path"] for r in lifecycle.missing_references(refs, have).collect()) == ["../x.png", "img/c.png"]


def test_assembly(spark):
    parts = spark.createDataFrame([("b", 2, "Two", 0, 5, 6), ("b", 1, "One_&", 1, 3, 4), ("b", 1, "One_&", 0, 1, 2)], "book string, chapter_number int, chapter_title string, part int, first_page int, last_page int")
    r = assemble.chapter_inputs(parts, ["book"]).first()
    assert r["inputs"] == "\\chapter{One\\_\\&}\n\\input{chapters/chapter_01_part_00}\n\\input{chapters/chapter_01_part_01}\n\\chapter{Two}\n\\input{chapters/chapter_02_part_00}"
    assert r["complete"] and [(c["number"], c["start_page"], c["end_page"], c["parts"]) for c in r["chapters"]] == [(1, 1, 4, 2), (2, 5, 6, 1)]
    assert not assemble.chapter_inputs(parts.where("chapter_number = 2"), ["book"]).first()["complete"]
    root = spark.range(1).select(assemble.root_document(F.lit("I"), F.lit("T#"), F.lit("A"))).first()[0]
    assert "\\title{T\\#}\n\\author{A}\n\\begin{document}" in root and root.endswith("\\mainmatter\nI\n\\end{document}\n")


def test_legacy_chapters(spark):
    chapters = spark.createDataFrame([("b", 1, "A"), ("b", 2, "B"), ("c", 1, "C")], "book string, number int, title string")
    files = spark.createDataFrame([("b", 1, "\\chapter{A} x"), ("b", 2, "plain")], "book string, number int, text string")
    got = assemble.legacy_chapters(chapters, files, ["book"]).collect()
    assert [(r["book"], r["inputs"], r["error"]) for r in got] == [("b", "\\input{chapters/chapter_01}\n\\chapter{B}\n\\input{chapters/chapter_02}", None)]


def answer(text):
    return json.dumps({"translation": text, "candidate_terms": []})


def test_backend_retries_with_the_reason(spark):
    def model(prompts):  # what it uses is its own: tasks do not import tests
        import json

        answer = lambda text: json.dumps({"translation": text, "candidate_terms": []})
        return [answer("T0" if "failed" in p else "lost") if "retry" in p else "no json" if "bad" in p else answer("T0 ok") for p in prompts]

    rows = spark.createDataFrame([(1, "good", "T0 x", ["T0"]), (2, "retry", "T0 x", ["T0"]), (3, "bad", "x", [])], "id int, prompt string, chunk string, tokens array<string>")
    got = {r["id"]: (r["translation"], r["error"], r["tries"]) for r in backend.parsed(backend.generate(rows, model, backend.check_tokens)).collect()}
    assert got == {1: ("T0 ok", None, 1), 2: ("T0", None, 2), 3: (None, "not JSON", 2)}


@pytest.mark.parametrize(
    ("text", "error"),
    [(answer("x"), None), ("[]", "wrong shape"), ('{"translation": 1, "candidate_terms": []}', "wrong shape"), ('{"translation": "", "candidate_terms": [{"source": "a"}]}', "wrong candidate"), ('{"translation": "", "candidate_terms": [], "x": 1}', "wrong shape"), (None, "not JSON")],
)
def test_answers_are_checked(text, error):
    assert backend.answer_error(text) == error
