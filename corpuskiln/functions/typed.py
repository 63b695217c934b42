"""Types of JSON values, told apart from values that are missing, by Spark's VARIANT."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Field(NamedTuple):
    """A field of an object: its kind, whether it may be missing, and whether null stands for missing."""

    name: str
    kind: str
    optional: bool = False
    nullable: bool = True


# The fields of manifests, outlines and reports of fragments.
MANIFEST = (Field("contents_page", "integer"), Field("body_start_page", "integer"), Field("end_page_excluded", "integer", True))
CHAPTER = (Field("number", "integer"), Field("title", "string"), Field("printed_start_page", "integer", True), Field("ocr_start_page", "integer"), Field("ocr_end_page", "integer"), Field("sections", "array"))
SECTION = (Field("title", "string"), Field("printed_start_page", "integer", True), Field("ocr_start_page", "integer", True))
BODY_END = (Field("heading", "string", True, False), Field("printed_start_page", "integer", True), Field("ocr_start_page", "integer", True))
REPORT = (Field("chunk_id", "string"), Field("source_pages", "array"), Field("structure_notes", "array"), Field("image_notes", "array"))

_NONE = "cast(array() as array<string>)"


def parse(text: Column) -> Column:
    """A JSON text as VARIANT; a byte order mark before it is passed over, null if it is no JSON."""
    return F.try_parse_json(F.regexp_replace(text, "^﻿", ""))


def kind(value: Column, path: str = "$") -> Column:
    """object, array, string, integer, number, boolean or null; a missing value gives a null. VARIANT keeps 1.0 as 1, so that is an integer; 1.5 is a number."""
    found = F.schema_of_variant(value if path == "$" else F.try_variant_get(value, path, "variant"))
    whole = F.regexp_like(found, F.lit(r"^(BIGINT|DECIMAL\(\d+,0\))$"))
    return (
        F.when(found.startswith("OBJECT"), "object").when(found.startswith("ARRAY"), "array").when(found == "STRING", "string").when(whole, "integer")
        .when(found == "BOOLEAN", "boolean").when(found == "VOID", "null").when(found.isNotNull(), "number")
    )


def field_faults(value: Column, fields: tuple[Field, ...], where: Column) -> Column:
    """What is wrong with the types of an object's fields, in their order: ``where.name: kind`` or ``where.name: missing``."""

    def fault(f: Field) -> Column:
        found = F.coalesce(kind(value, f"$.{f.name}"), F.lit("missing"))
        fine = [f.kind, *(["missing"] if f.optional else []), *(["null"] if f.optional and f.nullable else [])]
        return F.when(~found.isin(fine), F.concat(where, F.lit(f".{f.name}: "), found))

    return F.array_compact(F.array(*map(fault, fields)))


def object_faults(value: Column, fields: tuple[Field, ...], where: Column) -> Column:
    """``field_faults``, or that the value is no object."""
    found = F.coalesce(kind(value), F.lit("missing"))
    return F.when(found == "object", field_faults(value, fields, where)).otherwise(F.array(F.concat(where, F.lit(": "), found)))


def _elements(value: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(value, path, "array<variant>"), F.expr("cast(array() as array<variant>)"))


def outline_faults(text: Column) -> Column:
    """All faults of type in an outline: of its chapters, their sections and the end of the body; of one that is no JSON object, that alone."""
    value = parse(text)
    at = lambda name, i: F.concat(F.lit(f"{name}["), i.cast("string"), F.lit("]"))

    def chapter(c: Column, i: Column) -> Column:
        sections = F.transform(_elements(c, "$.sections"), lambda s, j: object_faults(s, SECTION, F.concat(at("chapters", i), F.lit("."), at("sections", j))))
        return F.when(F.coalesce(kind(c), F.lit("")) == "object", F.concat(field_faults(c, CHAPTER, at("chapters", i)), F.flatten(sections))).otherwise(object_faults(c, CHAPTER, at("chapters", i)))

    listed = F.flatten(F.transform(_elements(value, "$.chapters"), chapter))
    empty = F.when(F.size(_elements(value, "$.chapters")) == 0, F.array(F.concat(F.lit("chapters: "), F.when(kind(value, "$.chapters") == "array", "empty").otherwise(F.coalesce(kind(value, "$.chapters"), F.lit("missing")))))).otherwise(F.expr(_NONE))
    end = object_faults(F.try_variant_get(value, "$.body_end", "variant"), BODY_END, F.lit("body_end"))
    return F.when(value.isNull(), F.array(F.lit("no JSON"))).when(kind(value) != "object", F.array(F.concat(F.lit("$: "), kind(value)))).otherwise(F.concat(empty, listed, end))


def manifest_faults(text: Column) -> Column:
    """All faults of type in a page manifest."""
    value = parse(text)
    return F.when(value.isNull(), F.array(F.lit("no JSON"))).otherwise(object_faults(value, MANIFEST, F.lit("$")))


def fragment_faults(answer: Column) -> Column:
    """All faults of type in an answer that should hold a fragment and its report."""
    value = parse(answer)
    report = F.try_variant_get(value, "$.report", "variant")
    inner = F.when(kind(value, "$.report") == "object", field_faults(report, REPORT, F.lit("report"))).otherwise(F.expr(_NONE))
    return F.when(value.isNull(), F.array(F.lit("no JSON"))).otherwise(F.concat(object_faults(value, (Field("tex", "string"), Field("report", "object")), F.lit("$")), inner))


def fragment_error(answer: Column) -> Column:
    """Why an answer is no fragment with its report, null if it is."""
    value = parse(answer)
    fine = (kind(value, "$.tex") == "string") & (kind(value, "$.report") == "object")
    return F.when(value.isNull(), "not JSON").when(~F.coalesce(fine, F.lit(False)), "wrong shape")
