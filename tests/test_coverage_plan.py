"""Coverage works out the tokens of a page once."""

from corpuskiln.operators import audit


def test_tokens_of_pages_are_stored(spark):
    text = "alphabet betagamma " * 20
    pages = spark.createDataFrame([("a", 0, text), ("a", 1, text + "deltas"), (None, 0, text)], "book string, page_no int, text string")
    outputs = spark.createDataFrame([("a", "alphabet betagamma"), (None, "alphabet")], "book string, text string")
    out = audit.coverage(pages, outputs, ["book"])
    assert sorted(((r["book"] or "", r["page_no"], r["tokens"], r["hits"]) for r in out.collect())) == [("", 0, 2, 0), ("a", 0, 2, 2), ("a", 1, 3, 2)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1  # that of the outputs; before, pages had theirs twice beside it
