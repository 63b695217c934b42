"""The terminology report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.operators.masking import mask
from corpuskiln.operators.matching import find_terms

# Fixed values.
MAX_TERMS, TOP_FORMS = 300, 8


def term_report(docs: DataFrame, terms: DataFrame, min_occurrences: int = 1, max_terms: int = MAX_TERMS) -> DataFrame:
    """The most frequent terms of masked texts: rank, source, target, occurrences, forms, domains, notes, n_files.

    Texts that cannot be masked are left out. Terms rank by occurrences, then length, then spelling.
    """
    masked = mask(docs.select("doc_id", "text")).where("mask.error is null").select("doc_id", F.col("mask.masked").alias("text"))
    return rank_terms(find_terms(masked, terms, offsets=False), min_occurrences, max_terms)


def rank_terms(matches: DataFrame, min_occurrences: int = 1, max_terms: int = MAX_TERMS) -> DataFrame:
    """One chain of aggregates, so that texts are matched once: by form and document, by term and document, by form, by term."""
    return rank_forms(count_forms(matches), min_occurrences, max_terms)


def count_forms(matches: DataFrame) -> DataFrame:
    """One row per term and form: source, target, form, n, first, files (documents in which it is the term's first form), domains, notes. Each task counts before rows are moved."""
    counted = matches.groupBy("source", "target", "doc_id", "domains", "note", "matched_text").agg(F.count(F.lit(1)).alias("n"), F.min("start").alias("start"))
    per_doc = counted.groupBy("source", "target", "doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "matched_text", "n", "domains", "note"))).alias("hits"))
    hits = per_doc.select("source", "target", "doc_id", F.posexplode("hits").alias("pos", "hit"))
    return hits.groupBy("source", "target", F.col("hit.matched_text").alias("form")).agg(
        F.sum("hit.n").alias("n"), F.min(F.struct("doc_id", "hit.start")).alias("first"), F.sum((F.col("pos") == 0).cast("long")).alias("files"), F.collect_set("hit.domains").alias("domains"), F.collect_set("hit.note").alias("notes")
    )


def rank_forms(per_form: DataFrame, min_occurrences: int = 1, max_terms: int = MAX_TERMS) -> DataFrame:
    """The most frequent terms of counted forms, ranked."""
    ranked = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), "first", "form"))), 1, TOP_FORMS)
    per_term = per_form.groupBy("source", "target").agg(
        F.sum("n").alias("occurrences"),
        F.array_sort(F.array_distinct(F.flatten(F.flatten(F.collect_list("domains"))))).alias("domains"),
        F.array_sort(F.array_distinct(F.filter(F.flatten(F.collect_list("notes")), lambda x: x != ""))).alias("notes"),
        F.sum("files").alias("n_files"),
        F.transform(ranked, lambda x: F.struct(x["form"].alias("form"), (-x["less"]).alias("count"))).alias("forms"),
    )
    order = (F.desc("occurrences"), F.desc(F.length("source")), F.lower("source"), F.col("target"))
    top = per_term.where(F.col("occurrences") >= min_occurrences).orderBy(*order).limit(max_terms)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # max_terms rows


def report_totals(masked: DataFrame, terms: DataFrame, matches: DataFrame, max_terms: int = MAX_TERMS, min_occurrences: int = 1) -> DataFrame:
    """One row of counters: files, protected segments, active terms, unique, reported and omitted terms (A4); ``masked`` has tokens and error."""
    return report_counts(masked, terms, matches.groupBy("source", "target").count(), max_terms, min_occurrences)


def report_counts(masked: DataFrame, terms: DataFrame, counts: DataFrame, max_terms: int = MAX_TERMS, min_occurrences: int = 1) -> DataFrame:
    """The counters of ``report_totals`` from the number of matches of each term: source, target and count."""
    files = masked.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum(F.when(F.col("error").isNull(), F.size("tokens"))), F.lit(0)).alias("protected_segments"))
    kept = F.count(F.when(F.col("count") >= min_occurrences, 1))
    unique = counts.agg(F.count(F.lit(1)).alias("matched_unique_terms"), F.least(kept, F.lit(max_terms)).alias("reported_terms"), F.greatest(kept - max_terms, F.lit(0)).alias("omitted_terms"))
    active = terms.agg(F.count(F.lit(1)).alias("active_terms"))
    return files.crossJoin(unique).crossJoin(active)  # one row each


def _line() -> Column:
    forms = F.array_join(F.transform("forms", lambda x: F.format_string("%s (%d)", x["form"], x["count"])), ", ")
    return F.format_string("| %s | %s | %d | %s | %s |", "source", "target", "occurrences", forms, F.array_join("notes", "; "))


def report_document(report: DataFrame, totals: DataFrame, domain: str) -> DataFrame:
    """The whole report as Markdown, line_no and value: a heading, a list of counters, and the table with its head (K5)."""
    counters = ["files", "protected_segments", "active_terms", "matched_unique_terms", "reported_terms", "omitted_terms"]
    bullets = [F.concat(F.lit(f"- {name.replace('_', ' ')}: "), F.col(name).cast("string")) for name in counters]
    head = [F.lit("# Terms in use"), F.lit(""), F.lit(f"- domain: {domain}"), *bullets, F.lit(""), F.lit("| source | target | occurrences | forms | notes |"), F.lit("| --- | --- | ---: | --- | --- |")]
    top = totals.select(F.posexplode(F.array(*head)).alias("line_no", "value"))
    rows = report.select((F.col("rank") + (len(head) - 1)).cast("int").alias("line_no"), _line().alias("value"))
    return top.unionByName(rows)


def report_lines(report: DataFrame) -> DataFrame:
    """The report's table as Markdown lines in order (K5)."""
    return report.orderBy("rank").select(_line().alias("value"))
