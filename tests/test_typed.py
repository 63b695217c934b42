import json

from pyspark.sql import functions as F

from corpuskiln.functions import typed
from corpuskiln.functions.numbers import round_binary

GOOD = {"number": 1, "title": "t", "ocr_start_page": 1, "ocr_end_page": 2, "sections": [{"title": "s", "ocr_start_page": None}]}


def faults(spark, texts, rule):
    return [r["f"] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", rule(F.col("t")).alias("f")).orderBy("i").collect()]


def test_kinds(spark):
    texts = ["{}", "[]", '"a"', "1", "-7", "1.5", "1e3", "123456789012345678901", "true", "null", "﻿{}"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(typed.kind(typed.parse(F.col("t")))).collect()]
    assert got == ["object", "array", "string", "integer", "integer", "number", "number", "integer", "boolean", "null", "object"]


def test_manifests(spark):
    texts = ['{"contents_page": 1, "body_start_page": 2}', '{"contents_page": "1", "body_start_page": null, "end_page_excluded": [3]}', "[1]", "{", None, '{"contents_page": 1.5, "body_start_page": true, "end_page_excluded": null}']
    assert faults(spark, texts, typed.manifest_faults) == [
        [], ["$.contents_page: string", "$.body_start_page: null", "$.end_page_excluded: array"], ["$: array"], ["no JSON"], ["no JSON"], ["$.contents_page: number", "$.body_start_page: boolean"],
    ]


def test_outlines(spark):
    outline = lambda chapters, **more: json.dumps({"chapters": chapters, "body_end": {}} | more)
    texts = [
        outline([GOOD]), outline([GOOD | {"number": "1", "printed_start_page": "iv"}]), outline([GOOD, 3, None]), outline([]), outline({"a": 1}), outline([GOOD | {"sections": None}]),
        outline([GOOD | {"sections": [4, {"title": None}, {"title": "x", "ocr_start_page": "2"}]}]), outline([GOOD], body_end={"heading": None, "ocr_start_page": "9"}), json.dumps({"chapters": [GOOD]}), "[]",
    ]
    assert faults(spark, texts, typed.outline_faults) == [
        [], ["chapters[0].number: string", "chapters[0].printed_start_page: string"], ["chapters[1]: integer", "chapters[2]: null"], ["chapters: empty"], ["chapters: object"], ["chapters[0].sections: null"],
        ["chapters[0].sections[0]: integer", "chapters[0].sections[1].title: null", "chapters[0].sections[2].ocr_start_page: string"], ["body_end.heading: null", "body_end.ocr_start_page: string"], ["body_end: missing"], ["$: array"],
    ]


def test_fragments(spark):
    report = {"chunk_id": "c", "source_pages": [1], "structure_notes": [], "image_notes": []}
    texts = [json.dumps({"tex": "x", "report": report}), json.dumps({"tex": None, "report": report | {"source_pages": "1"}}), json.dumps({"tex": "x", "report": []}), "no"]
    assert faults(spark, texts, typed.fragment_faults) == [[], ["$.tex: null", "report.source_pages: string"], ["$.report: array"], ["no JSON"]]


def test_rounding_is_that_of_the_binary_value(spark):
    values = [2.675, 0.0625, 0.1875, 0.0, 1.0, -2.675, -0.0625, 0.0005, 1e-9, 123456.7895, 1e15, None, float("nan"), float("inf")]
    values += [h / n for n in range(1, 1001, 7) for h in range(0, n + 1, 3)]
    out = spark.createDataFrame([(v,) for v in values], "v double").select("v", round_binary(F.col("v"), 3).alias("r")).collect()
    show = lambda v: None if v is None else repr(v)
    assert [show(r["r"]) for r in out] == [show(None if v is None else v if v != v or v in (float("inf"),) else round(v, 3)) for v in values]
