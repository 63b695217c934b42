"""Checks of outputs against their sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions.numbers import round_binary
from corpuskiln.functions.text import bound, content_tokens, lines, strip
from corpuskiln.sources import sinks

# Fixed values.
EXEMPT_CHARS, LEAST_PAGE, LEAST_OVERALL = 160, 0.20, 0.72
ROOT_COMMANDS = ("\\documentclass", "\\begin{document}", "\\end{document}", "\\bibliography")
MOST_WRAPPERS, LONG_LINE, WRAPPERS_IN_LINE, MOST_PROSE_LINES = 40, 700, 3, 2
HEADING = r"(?md)^(#{1,6})[ \t]+"
RULE_LINE = r"(?md)^(?U:\s*)(?:---+|\*\*\*+|___+)(?U:\s*)$"
SECTION = r"\\(?:part|chapter|section|subsection|subsubsection|paragraph)\*?(?U:\s*)\{"
LABEL = r"\\label\{([^{}]+)\}"
REFERENCE = r"\\(?:ref|eqref|autoref|cref|Cref|cite|citep|citet)\*?(?:\[[^\]]*\])?\{([^{}]+)\}"
WRAPPER = r"\\text(?U:\s*)\{"


def coverage(pages: DataFrame, outputs: DataFrame, keys: list[str]) -> DataFrame:
    """Coverage of each source page by the output of its chunk: keys, page_no, tokens, hits, coverage, missing.

    ``pages`` has the keys, page_no and text, ``outputs`` the keys and text. Short pages and those without tokens are
    exempt: hits is null, coverage 1. Tokens meet in a join, so no output is gathered with all its pages. A page's tokens are stored, as two steps read
    them; the distinct ones of outputs, which no key repeats, are hashed instead of sorted.
    """
    tokens = content_tokens(F.coalesce("text", F.lit("")))
    short = F.length(strip(F.coalesce("text", F.lit("")))) < EXEMPT_CHARS
    source = sinks.stored(pages.select(*keys, "page_no", short.alias("short"), tokens.alias("t")), "page-tokens")
    audited = source.where(~F.col("short")).select(*keys, "page_no", F.explode("t").alias("token"))
    have = outputs.select(*keys, F.explode(tokens).alias("token")).distinct()
    hits = audited.join(have.hint("shuffle_hash"), [*keys, "token"], "left_semi").groupBy(*keys, "page_no").agg(F.count(F.lit(1)).alias("hits"))
    out = source.select(*keys, "page_no", F.size("t").cast("long").alias("tokens"), (F.col("short") | (F.size("t") == 0)).alias("exempt")).join(hits, [*keys, "page_no"], "left")
    counted = F.when(~F.col("exempt"), F.coalesce("hits", F.lit(0)).cast("long"))
    share = F.when(F.col("exempt"), 1.0).otherwise(counted / F.col("tokens"))
    return out.select(*keys, "page_no", "tokens", counted.alias("hits"), share.alias("coverage"), (share < LEAST_PAGE).alias("missing"))


def completeness(covered: DataFrame, keys: list[str]) -> DataFrame:
    """Overall coverage, missing and allowed pages and the verdict of each chunk."""
    audited = F.when(F.col("hits").isNotNull(), F.col("tokens"))
    sums = covered.groupBy(*keys).agg(F.count(F.lit(1)).alias("pages"), F.sum("hits").alias("h"), F.sum(audited).alias("n"), F.sum(F.col("missing").cast("int")).alias("missing_pages"))
    overall, allowed = F.coalesce(F.col("h") / F.col("n"), F.lit(1.0)), F.greatest(F.lit(1), F.floor(F.col("pages") / 10)).cast("long")
    return sums.select(*keys, overall.alias("overall_coverage"), "missing_pages", allowed.alias("allowed_missing_pages"), ((overall >= LEAST_OVERALL) & (F.col("missing_pages") <= allowed)).alias("passed"))


def chunk_coverage(sources: Column, tex: Column) -> Column:
    """overall_coverage and passed of a chunk's output, as ``completeness`` of ``coverage`` has them, worked out within its row; null for null ``sources``.

    ``sources`` is an array of structs with the text of each page. It is for chunks whose pages are few by their plan.
    """

    def page(text: Column, have: Column) -> Column:
        hits = lambda t: F.when((F.length(strip(text)) >= EXEMPT_CHARS) & (F.size(t) > 0), F.size(F.array_intersect(t, have)))
        return bound(content_tokens(text), lambda t: F.struct(F.size(t).cast("long").alias("tokens"), hits(t).cast("long").alias("hits")))

    def verdict(pages: Column) -> Column:
        audited = F.filter(pages, lambda p: p["hits"].isNotNull())
        total = lambda name: F.aggregate(audited, F.lit(0).cast("long"), lambda acc, p: acc + p[name])
        missing = F.size(F.filter(audited, lambda p: p["hits"] / p["tokens"] < LEAST_PAGE))
        overall = F.when(F.size(audited) > 0, total("hits") / total("tokens")).otherwise(1.0)
        allowed = F.greatest(F.lit(1), F.floor(F.size(pages) / 10))
        return bound(overall, lambda o: F.struct(o.alias("overall_coverage"), ((o >= LEAST_OVERALL) & (missing <= allowed)).alias("passed")))

    every = bound(content_tokens(F.coalesce(tex, F.lit(""))), lambda have: F.transform(sources, lambda p: page(F.coalesce(p["text"], F.lit("")), have)))
    return F.when(sources.isNotNull(), bound(every, verdict))


def completeness_report(covered: DataFrame, keys: list[str]) -> DataFrame:
    """What is written of each chunk's audit: the verdict, made on exact shares, and shares rounded to three places.

    ``pages`` (page_no, tokens, hits, coverage) and ``missing_pages`` are in page order; a chunk's pages are few by its plan.
    """
    page = F.struct("page_no", "tokens", "hits", round_binary(F.col("coverage")).alias("coverage"), "missing")
    packed = covered.groupBy(*keys).agg(F.sort_array(F.collect_list(page)).alias("p"))
    listed = packed.select(*keys, F.transform(F.filter("p", lambda x: x["missing"]), lambda x: x["page_no"]).alias("missing_pages"), F.transform("p", lambda x: x.dropFields("missing")).alias("pages"))
    sums = completeness(covered, keys).select(*keys, "passed", round_binary(F.col("overall_coverage")).alias("overall_coverage"), "allowed_missing_pages")
    return sums.join(listed, keys)


def has_root_command(tex: Column) -> Column:
    """Whether a text has a command that only a root document may have."""
    found = F.lit(False)
    for command in ROOT_COMMANDS:
        found = found | F.contains(tex, F.lit(command))
    return found


def artifact_error(tex: Column, in_chapter: Column) -> Column:
    """First rule that a converted fragment breaks, null if none."""
    per_line = F.transform(lines(tex), lambda x: F.struct(F.length(x).alias("n"), F.regexp_count(x, F.lit(WRAPPER)).alias("k")))
    wrappers = F.regexp_count(tex, F.lit(WRAPPER))
    prose = F.size(F.filter(per_line, lambda x: (x["n"] > LONG_LINE) & (x["k"] >= WRAPPERS_IN_LINE)))
    return (
        F.when(strip(F.coalesce(tex, F.lit(""))) == "", "empty")
        .when(F.regexp_like(tex, F.lit(r"^(?U:\s*)```")), "code fence")
        .when(has_root_command(tex), "root document command")
        .when(F.regexp_like(tex, F.lit(r"(?i)<(?U:\s*)/?(?:table|tr|td|th)\b")), "html table")
        .when(F.regexp_like(tex, F.lit(r"(?i)\\caption(?U:\s*)\{(?U:\s*)Image(?U:\s*)\}")), "placeholder caption")
        .when((wrappers >= MOST_WRAPPERS) | (prose >= MOST_PROSE_LINES), "prose in text wrappers")
        .when(in_chapter & F.regexp_like(tex, F.lit(r"\\chapter\*?(?U:\s*)\{")), "chapter heading in a chunk")
    )


def report_error(chunk_id: Column, pages: Column, report: Column) -> Column:
    """First rule that a chunk report breaks, null if none."""
    return (
        F.when(~report["chunk_id"].eqNullSafe(chunk_id), "chunk_id differs")
        .when(~report["source_pages"].eqNullSafe(pages), "source_pages differ")
        .when(report["structure_notes"].isNull(), "structure_notes is missing")
        .when(report["image_notes"].isNull(), "image_notes is missing")
    )


def structural_warnings(source: Column, output: Column) -> Column:
    """Which structures differ between a source and its output."""
    found = lambda c, p, g: F.regexp_extract_all(c, F.lit(p), F.lit(g))
    sets = lambda c, p: F.array_sort(F.array_distinct(found(c, p, 1)))
    checks = [
        (found(source, HEADING, 1) != found(output, HEADING, 1), "headings"),
        (F.regexp_count(source, F.lit(RULE_LINE)) != F.regexp_count(output, F.lit(RULE_LINE)), "rules"),
        (found(source, SECTION, 0) != found(output, SECTION, 0), "sections"),
        (sets(source, LABEL) != sets(output, LABEL), "labels"),
        (sets(source, REFERENCE) != sets(output, REFERENCE), "references"),
    ]
    return F.array_compact(F.array(*(F.when(cond, F.lit(name)) for cond, name in checks)))


def terminology_warnings(rules: DataFrame, outputs: DataFrame, by: str = "doc_id") -> DataFrame:
    """Terms of a text whose target its output lacks."""
    return rules.join(outputs.select(by, F.col("text").alias("output")), by).where(~F.contains(F.coalesce("output", F.lit("")), F.col("target"))).drop("output")


def set_difference(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Distinct values that only one side has, with the side."""
    a, b = left.select(column).distinct(), right.select(column).distinct()
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))
