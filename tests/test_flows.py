from pyspark.sql import functions as F

from corpuskiln.operators import assemble, boundaries, chunking, glossary, lifecycle, masking, scan
from corpuskiln.plans import flows

LONG = " ".join(f"word{i}" for i in range(40))


def book(spark, *texts):
    return spark.createDataFrame([("b", i, t) for i, t in enumerate(texts)], "book string, page_no int, text string")


def plan(pages, size):
    return chunking.plan_parts(pages.select("book", "page_no", F.length("text").alias("chars")), ["book"], size)


def test_conversion_accepts_an_echo_and_skips_what_is_done(spark):
    pages = book(spark, LONG, LONG, LONG)
    planned = plan(pages, len(LONG))
    out = flows.convert(pages, planned, ["book"])
    assert sorted((r["part"], r["error"], r["overall_coverage"], r["accepted"]) for r in out.collect()) == [(k, None, 1.0, True) for k in range(3)]
    done = spark.createDataFrame([("b", 0, True), ("b", 1, False)], "book string, part long, accepted boolean")
    assert sorted(r["part"] for r in flows.convert(pages, planned, ["book"], done).collect()) == [1, 2]
    again = flows.review(out, ["book"]).collect()
    assert len(again) == 3 and all(r["tex"] == r["first_version"] and r["error"] is None for r in again)


def test_conversion_rejects(spark):
    def bad(prompts):
        import json

        kinds = {0: lambda c: "no json", 1: lambda c: json.dumps({"tex": "short", "report": {**c, "source_pages": c["pages"], "structure_notes": [], "image_notes": []}}), 2: lambda c: json.dumps({"tex": "\\documentclass{x}", "report": c})}
        out = []
        for p in prompts:
            c = json.loads(p.split("<CHUNK>\n", 1)[1].split("\n</CHUNK>", 1)[0])
            out.append(kinds[c["pages"][0]](c))
        return out

    pages = book(spark, LONG, LONG, LONG)
    got = {r["part"]: (r["error"], r["accepted"]) for r in flows.convert(pages, plan(pages, len(LONG)), ["book"], generator=bad).collect()}
    assert got == {0: ("not JSON", False), 1: (None, False), 2: ("root document command", False)}


def test_outline(spark):
    def model(prompts):
        import json

        whole = [{"number": 1, "title": "A", "ocr_start_page": 1, "ocr_end_page": 2, "sections": []}]
        return [json.dumps({"chapters": whole if "Chapter A" in p else [{**whole[0], "ocr_end_page": 9}]}) for p in prompts]

    good, wrong = book(spark, "Contents\nA 1", "# Chapter A", "text", "Index"), book(spark, "Contents", "x", "y").withColumn("book", F.lit("c"))
    pages = good.unionByName(wrong)
    found = boundaries.detect_boundaries(pages)
    got = {r["book"]: (len(r["chapters"]), r["errors"]) for r in flows.outline(pages, found, model).collect()}
    assert got == {"b": (1, []), "c": (1, ["the range has pages that do not exist"])}
    assert [r["book"] for r in flows.outline(pages, found, model, stored=good.select("book").distinct()).collect()] == ["c"]


def test_roots(spark):
    df = spark.createDataFrame([("\\documentclass[x]{a}",), ("\\documentclassy",), (None,)], "text string")
    assert [r["priority"] for r in lifecycle.main_first(df).collect()] == [0, 1, 1]
    text = "\\title{Old}\\input{chapters/chunk_1}\\input{preamble}"
    assert spark.range(1).select(lifecycle.translated_root(F.lit(text), "Old", "New")).first()[0] == "\\title{New}\\input{chapters/chunk_1-zh}\\input{preamble}"


def answer(chunk_id, pages, tex):
    import json

    return json.dumps({"tex": tex, "report": {"chunk_id": chunk_id, "source_pages": pages, "structure_notes": [], "image_notes": []}})


def test_the_newest_valid_attempt_is_recovered(spark):
    pages = book(spark, LONG, LONG, LONG)
    planned = plan(pages, len(LONG))
    rows = [("b", 0, "2024-01-01", answer("chapter_01_part_00", [0], LONG + " old")), ("b", 0, "2024-01-02", answer("chapter_01_part_00", [0], LONG + " new")), ("b", 0, "2024-01-03", "broken off"), ("b", 1, "2024-01-01", answer("chapter_01_part_01", [7], LONG)), ("b", 2, "2024-01-01", answer("chapter_01_part_02", [2], "too little"))]
    attempts = spark.createDataFrame(rows, "book string, part long, made_at string, answer string").withColumn("made_at", F.to_timestamp("made_at"))
    got = {r["part"]: (r["recovered"], r["accepted"], r["tex"]) for r in flows.convert(pages, planned, ["book"], attempts=attempts).collect()}
    assert got == {0: (True, True, LONG + " new"), 1: (False, True, LONG), 2: (False, True, LONG)}


def test_review_checks_pages_and_keeps_the_first_version(spark):
    pages = book(spark, LONG, LONG)
    made = flows.convert(pages, plan(pages, len(LONG)), ["book"])
    wrong = lambda prompts: [answer("chapter_01_part_00", [5], "x") for _ in prompts]
    assert {r["part"]: r["error"] for r in flows.review(made, ["book"], wrong).collect()} == {0: "source_pages differ", 1: "chunk_id differs"}
    earlier = spark.createDataFrame([("b", 0, "first", None), ("b", 1, "other", "failed")], "book string, part long, first_version string, error string")
    assert [(r["part"], r["first_version"]) for r in flows.review(made, ["book"], reviewed=earlier).collect()] == [(1, "other")]
    assert sorted((r["part"], r["first_version"]) for r in flows.review(made, ["book"], reviewed=earlier, overwrite=True).collect()) == [(0, "first"), (1, "other")]


def test_warnings_name_structures_and_absent_terms(spark):
    docs = spark.createDataFrame([(1, "# a\n\\label{x}"), (2, "plain"), (3, "lost")], "doc_id long, text string")
    out = spark.createDataFrame([(1, "## a T"), (2, "plain"), (3, None)], "doc_id long, text string")
    rules = spark.createDataFrame([(1, 4, "s", "T"), (1, 2, "u", "V"), (1, 9, "w", "X")], "doc_id long, start int, source string, target string")
    assert {r["doc_id"]: r["warnings"] for r in flows.translation_warnings(docs, out, rules).collect()} == {1: ["headings", "labels", "u -> V", "w -> X"], 2: []}


def test_numbers_within_groups(spark):
    from corpuskiln.sources import files

    rows = [(None if i % 5 == 0 else "ab"[i % 2], i) for i in range(200)]
    out = scan.number_rows(spark.createDataFrame(rows, "k string, v int").repartition(7), "v", name="no", by=("k",)).collect()
    want = {k: [v for x, v in rows if x == k] for k in (None, "a", "b")}
    assert sorted((str(r["k"]), r["no"], r["v"]) for r in out) == sorted((str(k), n, v) for k, vs in want.items() for n, v in enumerate(vs))


def test_assembly_validates_again(spark):
    chunks = spark.createDataFrame([("a", 1, 0, [0, 1]), ("a", 2, 0, [2]), ("b", 1, 0, [0]), ("c", 2, 0, [0]), ("d", 1, 0, [0]), ("d", 1, 1, [1])], "book string, chapter_number int, part int, pages array<int>")
    report = "struct<chunk_id:string,source_pages:array<int>,structure_notes:array<string>,image_notes:array<string>>"
    rows = [("a", 1, 0, "x", ("chapter_01_part_00", [0, 1], [], [])), ("a", 2, 0, "y", ("chapter_02_part_00", [2], [], [])), ("b", 1, 0, "x", ("chapter_01_part_00", [1], [], [])), ("c", 2, 0, "x", ("chapter_02_part_00", [0], [], [])), ("d", 1, 0, "\\chapter{x}", None)]
    artifacts = spark.createDataFrame(rows, f"book string, chapter_number int, part int, tex string, report {report}")
    faults = assemble.assembly_faults(chunks, artifacts, ["book"])
    assert sorted(tuple(r) for r in faults.collect()) == [("b", 1, 0, "source_pages differ"), ("d", 1, 0, "chapter heading in a chunk"), ("d", 1, 1, "the fragment is missing")]
    parts = chunks.select("book", "chapter_number", F.lit("T").alias("chapter_title"), "part", F.element_at("pages", 1).alias("first_page"), F.element_at("pages", -1).alias("last_page"))
    got = {r["book"]: (r["inputs"], r["n_faults"], r["error"]) for r in assemble.assembled(parts, faults, ["book"]).collect()}
    assert got["a"] == ("\\chapter{T}\n\\input{chapters/chapter_01_part_00}\n\\chapter{T}\n\\input{chapters/chapter_02_part_00}", 0, None)
    assert got["b"] == (None, 1, "chapter_01_part_00: source_pages differ") and got["d"] == (None, 2, "chapter_01_part_00: chapter heading in a chunk")
    assert got["c"] == (None, 0, "the chapters' numbers do not run from 1")
    assert assemble.assembly_faults(chunks.limit(0), artifacts, ["book"]).count() == 0


def test_only_whole_translations_teach_terms(spark):
    def model(prompts):
        import json

        chunk = lambda p: p.split("<SOURCE>\n", 1)[1].rsplit("\n</SOURCE>", 1)[0]
        term = lambda s, d: {"source": s, "target": "T", "domain": d, "reason": ""}
        return [json.dumps({"translation": chunk(p).replace("@@", "") if "lost" in p else chunk(p), "candidate_terms": [term(" group ", ""), term("", "x"), term("x" * 121, "x"), term("ring", "General")]}) for p in prompts]

    docs = spark.createDataFrame([(1, "a $x$ text", "en"), (2, "lost $x$ here", "en"), (3, None, None)], "doc_id long, text string, lang string")
    masked = masking.mask(docs).select("doc_id", "lang", "mask.masked", "mask.tokens", "mask.originals", "mask.error")
    terms = spark.createDataFrame([], f"term_no long, {glossary.TERM_SCHEMA}")
    answers = flows.translation_answers(masked, glossary.active_terms(terms, ["en"]), model)
    made = flows.translated(masked, answers)
    assert {r["doc_id"]: (r["text"], r["error"] is None) for r in made.collect()} == {1: ("a $x$ text", True), 2: (None, False), 3: ("", True)}
    got = sorted((r["no"]["doc_id"], r["source"], r["domain"]) for r in flows.candidates(answers, made).collect())
    assert [x for x in got if x[0] == 1] == [(1, "group", "en"), (1, "ring", "General")] and not any(x[0] == 2 for x in got)
