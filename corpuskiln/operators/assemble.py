"""Assembly of chapters into one document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions.numbers import round_binary
from corpuskiln.functions.text import tex_escape
from corpuskiln.operators import audit
from corpuskiln.operators.chunking import chunk_id

# Fixed values.
DOCUMENT_CLASS, PREAMBLE = "\\documentclass{article}", "preamble"
#: The first line of a root file.
ROOT_COMMENT = "% Includes the chapters in their order."


def chapter_inputs(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The lines that include a book's chapters in order, with the chapter ranges and whether the numbers run from 1.

    ``parts`` has the keys, chapter_number, chapter_title, part, first_page and last_page.
    """
    per_chapter = parts.groupBy(*keys, "chapter_number").agg(
        F.max("chapter_title").alias("title"),
        F.sort_array(F.collect_list(F.struct("part", chunk_id(F.col("chapter_number"), F.col("part")).alias("id")))).alias("ids"),
        F.min("first_page").alias("start_page"),
        F.max("last_page").alias("end_page"),
        F.count(F.lit(1)).alias("parts"),
    )
    head = F.concat(F.lit("\\chapter{"), tex_escape(F.coalesce("title", F.lit(""))), F.lit("}"))
    body = F.transform("ids", lambda x: F.concat(F.lit("\\input{chapters/"), x["id"], F.lit("}")))
    text = F.array_join(F.concat(F.array(head), body), "\n")
    chapter = F.struct(F.col("chapter_number").alias("number"), "title", "start_page", "end_page", "parts", text.alias("text"))
    packed = per_chapter.groupBy(*keys).agg(F.sort_array(F.collect_list(chapter)).alias("chapters"))
    numbers = F.transform("chapters", lambda x: x["number"].cast("int"))
    return packed.select(
        *keys, F.array_join(F.transform("chapters", lambda x: x["text"]), "\n").alias("inputs"), F.transform("chapters", lambda x: x.dropFields("text")).alias("chapters"), (numbers == F.sequence(F.lit(1), F.size("chapters"))).alias("complete")
    )


def assembly_faults(chunks: DataFrame, artifacts: DataFrame, keys: list[str]) -> DataFrame:
    """What keeps books from being assembled: keys, chapter_number, part, error, one row per part whose fragment is missing or breaks a rule.

    ``chunks`` has the keys, chapter_number, part and pages (page numbers in order), ``artifacts`` the keys, chapter_number, part, tex and report, as
    they are stored now: a fragment may have changed since it was accepted, so all rules are checked again. Only broken rules leave the
    join. A part with several artifacts is broken if any of them is.
    """
    on = [*keys, "chapter_number", "part"]
    both = chunks.select(*on, "pages").join(artifacts.select(*on, "tex", "report", F.lit(True).alias("made")), on, "left")
    rule = F.coalesce(audit.artifact_error(F.col("tex"), F.lit(True)), audit.report_error(chunk_id(F.col("chapter_number"), F.col("part")), F.col("pages"), F.col("report")))
    error = F.when(F.col("made").isNull(), "the fragment is missing").when(F.col("report").isNull(), F.coalesce(audit.artifact_error(F.col("tex"), F.lit(True)), F.lit("the report is missing"))).otherwise(rule)
    return both.select(*on, error.alias("error")).where("error is not null").distinct()


def assembled(parts: DataFrame, faults: DataFrame, keys: list[str]) -> DataFrame:
    """Books with their include lines, or the reason for having none: keys, inputs, chapters, n_faults, error.

    ``parts`` is what ``chapter_inputs`` takes, ``faults`` what ``assembly_faults`` gives. The error is that of the first broken part; else
    that the chapters' numbers do not run from 1.
    """
    place = F.struct("chapter_number", "part", "error")
    broken = faults.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_faults"), F.min_by(F.concat(chunk_id(F.col("chapter_number"), F.col("part")), F.lit(": "), "error"), place).alias("fault"))
    rows = chapter_inputs(parts, keys).join(broken, keys, "left")
    error = F.coalesce("fault", F.when(~F.col("complete"), "the chapters' numbers do not run from 1"))
    return rows.select(*keys, F.when(error.isNull(), F.col("inputs")).alias("inputs"), "chapters", F.coalesce("n_faults", F.lit(0)).alias("n_faults"), error.alias("error"))


def document_report(inputs: DataFrame, converted: DataFrame, reviewed: DataFrame, keys: list[str]) -> DataFrame:
    """The report of each assembled document: chunks, chapters, chapter_ranges, reviewed_chunks and completeness.

    ``inputs`` is what ``chapter_inputs`` gives, ``converted`` has the keys, part, chunk_id, accepted and overall_coverage, ``reviewed``
    the keys, part and error. Only facts of chunks are gathered, no texts.
    """
    facts = F.struct("part", "chunk_id", F.col("accepted").alias("passed"), round_binary(F.col("overall_coverage")).alias("overall_coverage"))
    made = converted.groupBy(*keys).agg(F.count(F.lit(1)).alias("chunks"), F.sort_array(F.collect_list(facts)).alias("completeness"))
    seen = reviewed.where("error is null").groupBy(*keys).agg(F.count(F.lit(1)).alias("reviewed_chunks"))
    rows = inputs.select(*keys, F.size("chapters").cast("long").alias("chapters"), F.col("chapters").alias("chapter_ranges")).join(made, keys, "left").join(seen, keys, "left")
    return rows.select(*keys, F.coalesce("chunks", F.lit(0)).alias("chunks"), "chapters", "chapter_ranges", F.coalesce("reviewed_chunks", F.lit(0)).alias("reviewed_chunks"), "completeness")


def root_document(inputs: Column, title: Column, author: Column, document_class: str = DOCUMENT_CLASS, preamble: str = PREAMBLE) -> Column:
    """The text of a book's root file (K6)."""
    by = F.when(F.coalesce(author, F.lit("")) != "", F.concat(F.lit("\\author{"), tex_escape(author), F.lit("}\n"))).otherwise("")
    return F.concat(
        F.lit(f"{ROOT_COMMENT}\n{document_class}\n\\input{{{preamble}}}\n\\title{{"),
        tex_escape(title),
        F.lit("}\n"),
        by,
        F.lit("\\begin{document}\n\\maketitle\n\\frontmatter\n\\tableofcontents\n\\mainmatter\n"),
        inputs,
        F.lit("\n\\end{document}\n"),
    )


def legacy_chapters(chapters: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """Include lines of whole-chapter files, only for books that have one for every chapter.

    ``chapters`` has the keys, number and title, ``files`` the keys, number and text. A heading is added where a file has
    none; an empty file makes ``error``; books with a missing file are left out.
    """
    joined = chapters.select(*keys, "number", "title").join(files.select(*keys, "number", "text"), [*keys, "number"], "left")
    name = F.concat(F.lit("\\input{chapters/chapter_"), F.format_string("%02d", F.col("number").cast("int")), F.lit("}"))
    has_head = F.regexp_like(F.coalesce("text", F.lit("")), F.lit(r"\\chapter\*?(?U:\s*)\{"))
    line = F.when(has_head, name).otherwise(F.concat(F.lit("\\chapter{"), tex_escape(F.col("title")), F.lit("}\n"), name))
    blank = F.coalesce(F.trim(F.regexp_replace("text", r"(?U)\s+", "")) == "", F.lit(False))
    packed = joined.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("number", line.alias("line")))).alias("l"), F.min(F.col("text").isNotNull()).alias("whole"), F.max(blank).alias("blank"))
    return packed.where("whole").select(*keys, F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("inputs"), F.when(F.col("blank"), "a chapter file is empty").alias("error"))
