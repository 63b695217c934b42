import json

from pyspark.sql import functions as F

from corpuskiln.operators import glossary, masking, matching, report, scan
from corpuskiln.sources import files, sinks
from corpuskiln.streaming import incremental


def test_page_and_text_scans(spark, tmp_path):
    for name, text in (("doc_0.md", "a\r\nb"), ("DOC_2.MD", "é"), ("doc_x.md", "no"), ("note.txt", "no")):
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub/x.tex").write_bytes(b"bad \xff byte")
    texts = {r["path"].rpartition("/")[2]: (r["format"], r["text"]) for r in files.read_texts(spark, str(tmp_path)).collect()}
    assert texts["x.tex"] == ("LaTeX", "bad \ufffd byte") and texts["doc_0.md"] == ("Markdown", "a\nb") and "note.txt" not in texts
    pages = files.read_pages(spark, str(tmp_path))
    assert sorted((r["page_no"], r["chars"]) for r in pages.collect()) == [(0, 3), (2, 1)]
    assert [r["page_no"] for r in files.missing_pages(spark, pages, 3).collect()] == [1]


def test_glossary_and_table_files(spark, tmp_path):
    terms = {"version": 1, "terms": [{"source": "ring", "target": "R"}, {"source": "map", "target": "M", "domains": ["x"], "status": "draft"}]}
    (tmp_path / "g.json").write_text(json.dumps(terms, indent=1))
    (tmp_path / "t.tsv").write_bytes("\ufeffEnglish\tX\r\nvector space\tvs\r\n".encode())
    active = glossary.active_terms(files.read_glossary(spark, str(tmp_path / "g.json")))
    assert [r["source"] for r in active.collect()] == ["ring"]
    table = glossary.parse_term_table(files.read_term_lines(spark, str(tmp_path / "t.tsv")))
    assert [(r["source"], r["target"]) for r in table.collect()] == [("vector space", "vs")]


def test_nested_lines_are_numbered_through(spark):
    line = lambda *texts: json.dumps({"result": {"layoutParsingResults": [{"markdown": {"text": t, "images": {"a": "u"}}, "outputImages": {}} for t in texts]}})
    rows = spark.createDataFrame([(2, line("c")), (0, line("a", "b")), (1, "  ")], "line_no int, value string")
    got = files.ocr_pages(rows).orderBy("page_no").collect()
    assert [(r["page_no"], r["text"]) for r in got] == [(0, "a"), (1, "b"), (2, "c")] and got[0]["images"] == {"a": "u"}


def test_number_rows_over_many_parts(spark):
    got = scan.number_rows(spark.range(1000).withColumn("k", 999 - F.col("id")), "k").collect()
    assert all(r["no"] == r["k"] for r in got)


def test_chunk_index_file(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"version": 1, "chunks": [{"chunk_id": "a", "pages": [1, 2], "characters": 5}]}))
    r = files.read_chunk_index(spark, str(tmp_path / "c.json")).first()
    assert (r["chunk_id"], r["pages"], r["chapter_number"]) == ("a", [1, 2], None)


def report_of(spark, **options):
    rows = [(0, "field", "F", ["*"], ["fields"], None, None, "n1"), (1, "fraction field", "FF", ["general", "a"], [], None, None, None)]
    terms = glossary.active_terms(spark.createDataFrame(rows, f"term_no long, {glossary.TERM_SCHEMA}"))
    docs = spark.createDataFrame([(1, "Fields, field `field` and fraction field"), (2, "field <a href='http://x'>"), (3, None)], "doc_id long, text string")
    return docs, terms, report.term_report(docs, terms, **options)


def test_report(spark):
    docs, terms, out = report_of(spark)
    got = [(r["rank"], r["source"], r["occurrences"], [(f["form"], f["count"]) for f in r["forms"]], r["domains"], r["notes"], r["n_files"]) for r in out.orderBy("rank").collect()]
    assert got == [(1, "field", 2, [("Fields", 1), ("field", 1)], ["*"], ["n1"], 1), (2, "fraction field", 1, [("fraction field", 1)], ["a", "general"], [], 1)]
    assert [r["value"] for r in report.report_lines(out).collect()][0] == "| field | F | 2 | Fields (1), field (1) | n1 |"
    totals = report.report_totals(masking.mask(docs).select("mask.*"), terms, matching.find_terms(docs, terms), max_terms=1).first()
    assert (totals["files"], totals["protected_segments"], totals["reported_terms"], totals["omitted_terms"], totals["active_terms"]) == (3, 1, 1, 1, 2)


def test_report_limits(spark):
    assert [r["source"] for r in report_of(spark, min_occurrences=2)[2].collect()] == ["field"]
    assert report_of(spark, max_terms=1)[2].count() == 1


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a.md", "é")], "path string, text string")
    sinks.write_json(rows, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first()["text"] == "é"
    try:
        sinks.write_texts(rows, str(tmp_path / "j"))
    except Exception as e:
        assert "already exists" in str(e)
    else:
        raise AssertionError("an existing folder was overwritten")
    sinks.write_texts(rows, str(tmp_path / "j"), overwrite=True)
    sinks.write_lines(rows.select(F.col("text").alias("value")), str(tmp_path / "l"))
    assert [p.read_text() for p in (tmp_path / "l").glob("part-*")] == ["é\n"]
    assert sinks.run_dir("r", "c").startswith("r/runs/c-")


def test_incremental_counts(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    spark.createDataFrame([(1, "With the field"), (2, "the")], "doc_id long, text string").write.parquet(source)
    run = lambda: incremental.run_counts(incremental.term_counts(incremental.stream_documents(spark, source), ["the", "with the"]), out, state).awaitTermination()
    run()
    assert {r["key"]: r["occurrences"] for r in incremental.read_counts(spark, out).collect()} == {"the": 1, "with the": 1}
    spark.createDataFrame([(3, "THE the")], "doc_id long, text string").write.mode("append").parquet(source)
    run()
    assert {r["key"]: r["occurrences"] for r in incremental.read_counts(spark, out).collect()} == {"the": 3, "with the": 1}
