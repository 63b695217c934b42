"""Splits of texts and page ranges, and joins of what lies in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions.text import bound, fold_items
from corpuskiln.operators import scan

# Fixed values.
BLANK_LINE = r"\r?\n[ \t]*\r?\n"
LEAST_CHUNK, CHUNK_CHARS, PAGE_CHUNK_CHARS = 1000, 12000, 45000


def blocks(text: Column) -> Column:
    """Text cut at blank lines; the separators are blocks of their own."""
    gaps, ends = F.split(text, BLANK_LINE, -1), F.regexp_extract_all(text, F.lit(BLANK_LINE), F.lit(0))
    return F.flatten(F.zip_with(gaps, ends, lambda g, e: F.when(e.isNull(), F.array(g)).otherwise(F.array(g, e))))


def pack_blocks(text: Column, max_chars: int = CHUNK_CHARS) -> Column:
    """Chunks of whole blocks, each with its start, filled in order up to ``max_chars``; a longer block is a chunk, an empty text one empty chunk."""
    if max_chars < LEAST_CHUNK:
        raise ValueError(f"chunks of fewer than {LEAST_CHUNK} characters")
    end = F.lit(None).cast("int")
    none = F.expr("cast(array() as array<struct<start:int,first:int,n:int>>)")

    def step(at: Column, length: Column) -> tuple[Column, Column, Column]:
        """``at`` is the open chunk: its start, its length, its first block and their number; a null length closes the last one."""
        full = length.isNull() & ((at["now"] > 0) | (at["first"] == 1)) | (at["now"] > 0) & (at["now"] + length > max_chars)
        grown = F.struct(at["start"].alias("start"), (at["now"] + length).alias("now"), at["first"].alias("first"), (at["n"] + 1).alias("n"))
        opened = F.struct((at["start"] + at["now"]).alias("start"), length.alias("now"), (at["first"] + at["n"]).alias("first"), F.lit(1).alias("n"))
        return F.when(full, opened).otherwise(grown), full, F.struct(at["start"].alias("start"), at["first"].alias("first"), at["n"].alias("n"))

    def cut(parts: Column) -> Column:
        """Lengths are summed first, and each chunk is put together once from its blocks."""
        first = F.struct(F.lit(0).alias("start"), F.lit(0).alias("now"), F.lit(1).alias("first"), F.lit(0).alias("n"))
        spans = fold_items(F.concat(F.transform(parts, lambda b: F.length(b)), F.array(end)), first, none, step)
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_join(F.slice(parts, s["first"], s["n"]), "").alias("chunk")))

    return bound(blocks(text), cut)


def chunk_rows(docs: DataFrame, text: str = "text", max_chars: int = CHUNK_CHARS, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per chunk: doc_id, the columns ``keep`` of its document, chunk_no, chunk, chunk_start and chunk_end (E7); no text is moved."""
    rows = docs.select("doc_id", *keep, F.posexplode(pack_blocks(F.coalesce(F.col(text), F.lit("")), max_chars)).alias("chunk_no", "c"))
    return rows.select("doc_id", *keep, "chunk_no", "c.chunk", F.col("c.start").alias("chunk_start"), (F.col("c.start") + F.length("c.chunk")).alias("chunk_end"))


def overlapping(chunks: DataFrame, matches: DataFrame, key: str = "doc_id") -> DataFrame:
    """Matches that a chunk holds or touches; a match across a border goes to both chunks."""
    return chunks.join(matches, key).where((F.col("start") < F.col("chunk_end")) & (F.col("end") > F.col("chunk_start")))


def pages_of_ranges(ranges: DataFrame, pages: DataFrame, keys: list[str]) -> DataFrame:
    """Pages of each range first_page to last_page; numbers without a page are passed over."""
    numbers = ranges.where("first_page <= last_page").withColumn("page_no", F.explode(F.sequence("first_page", "last_page")))
    return numbers.join(pages, [*keys, "page_no"])


def plan_parts(pages: DataFrame, keys: list[str], max_chars: int = PAGE_CHUNK_CHARS) -> DataFrame:
    """``pages`` (keys, page_no, chars) with the part of its chapter that each page is in (W3). Only lengths are moved.

    A chapter of n characters is planned as ceil(n / max) parts; the cut to part k falls behind the first page where
    at least k of these shares are reached, one cut behind a page at most and none behind the last. No book is in one task. With q(j) the shares reached behind
    page j, the part of page i is the least of i and all q(j) + i - 1 - j for j < i: a running sum and a running least.
    """
    one = F.lit(1).cast("long")
    rows = scan.running(
        pages.select(*keys, "page_no", F.col("chars").cast("long").alias("chars")), keys, ["page_no"],
        {"i": scan.Fold("sum", one), "reached": scan.Fold("sum", F.col("chars"))}, {"total": scan.Fold("sum", F.col("chars"))},
    ).withColumn("i", F.col("i") - 1)
    planned = F.greatest(one, F.ceil(F.col("total") / F.lit(max_chars)).cast("long"))
    rows = rows.withColumn("planned", planned)
    shares = F.when(F.col("total") > 0, F.expr("(cast(reached as decimal(38,0)) * cast(planned as decimal(19,0))) div cast(total as decimal(38,0))")).otherwise(0).cast("long")
    rows = rows.withColumn("slack", F.least(shares, F.col("planned") - 1) - F.col("i"))
    rows = scan.running(rows, keys, ["page_no"], {"least": scan.Fold("min", F.col("slack"), -1)})
    part = F.col("i") - 1 + F.least(one, F.coalesce("least", one))
    return rows.select(*keys, "page_no", "chars", part.cast("long").alias("part"))


def part_ranges(planned: DataFrame, keys: list[str]) -> DataFrame:
    """First and last page, number of pages and characters of each part, with its id."""
    out = planned.groupBy(*keys, "part").agg(F.min("page_no").alias("first_page"), F.max("page_no").alias("last_page"), F.count(F.lit(1)).alias("n_pages"), F.sum("chars").alias("chars"))
    return out


def chunk_id(chapter: Column, part: Column) -> Column:
    return F.format_string("chapter_%02d_part_%02d", chapter.cast("int"), part.cast("int"))


def chapter_ranges(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Page range and number of parts of each chapter."""
    return parts.groupBy(*keys).agg(F.min("first_page").alias("start_page"), F.max("last_page").alias("end_page"), F.count(F.lit(1)).alias("parts"))


def sections_in_parts(parts: DataFrame, sections: DataFrame, keys: list[str]) -> DataFrame:
    """Sections that begin within a part; those without a start page nowhere."""
    return parts.join(sections.where("section_start is not null"), keys).where(F.col("section_start").between(F.col("first_page"), F.col("last_page")))


def neighbours(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Previous and next page of every page, over all pages of a book."""
    number = F.col("page_no")
    back = scan.running(pages.select(*keys, "page_no"), keys, ["page_no"], {"previous_page": scan.Fold("last", number, -1)})
    ahead = back.withColumn("__back", -number)
    return scan.running(ahead.drop(scan.PART), keys, ["__back"], {"next_page": scan.Fold("last", number, -1)}).select(*keys, "page_no", "previous_page", "next_page")


def contiguity_violations(ranges: DataFrame, keys: list[str], order: str, start: str = "first_page", end: str = "last_page") -> DataFrame:
    """Ranges that do not begin right after the one before."""
    rows = scan.running(ranges, keys, [order], {"previous_end": scan.Fold("last", F.col(end), -1)}).drop(scan.PART)
    return rows.where(F.col("previous_end").isNotNull() & (F.col(start) != F.col("previous_end") + 1))


def chunk_index(parts: DataFrame, planned: DataFrame, keys: list[str]) -> DataFrame:
    """One nested row per part with its page numbers and characters (K4)."""
    return planned.groupBy(*keys, "part").agg(F.sort_array(F.collect_list("page_no")).alias("pages"), F.sum("chars").alias("characters")).join(parts.select(*keys, "part", "first_page"), [*keys, "part"])
