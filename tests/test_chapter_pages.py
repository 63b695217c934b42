"""Pages of chapters are counted along ranges, not gathered by book."""

from corpuskiln.operators import boundaries


def test_ranges_with_and_without_all_pages(spark):
    pages = spark.createDataFrame([("a", n) for n in (1, 2, 2, 3, 5, 6, None)] + [("b", 4)], "book string, page_no int")
    manifest = spark.createDataFrame([("a", 1, None, None), ("b", 1, None, None)], "book string, body_start_page int, end_page_excluded int, error string")
    shape = "book string, number int, title string, ocr_start_page int, ocr_end_page int, sections array<struct<title:string,ocr_start_page:int>>"
    rows = [("a", 1, "A", 1, 3, []), ("a", 2, "A", 4, 5, []), ("a", 3, "A", 6, 6, []), ("a", 4, "A", 7, 2_000_000_000, []), ("a", 5, "A", 9, 8, []), ("b", 1, "A", 4, 4, []), ("c", 1, "A", 4, 4, [])]
    out = boundaries.chapter_errors(spark.createDataFrame(rows, shape), manifest, pages)
    missing = {(r["book"], r["number"]) for r in out.where("error = 'the range has pages that do not exist'").collect()}
    assert missing == {("a", 2), ("a", 4), ("c", 1)}  # a range of 2,000,000,000 pages is no array
    assert "collect_set" not in out._jdf.queryExecution().toString()
