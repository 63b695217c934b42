"""Registered queries of the document operators over the test tables, each over whole tables."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuskiln.functions import text as X
from corpuskiln.functions import typed
from corpuskiln.operators import assemble, audit, backend, boundaries, chunking, glossary, ledger, lifecycle, masking, matching, report, scan
from corpuskiln.plans import flows
from corpuskiln.sources import archives, files, sinks, text_sink

#: A dictionary of phrases that the test texts hold: source, target, domains, aliases, status, note.
TERMS = [
    ("the", "T1", ["en"], [], "approved", ""),
    ("with", "T2", ["en"], [], "approved", ""),
    ("that", "T3", ["*"], [], None, ""),
    ("with the", "T4", ["en", "*"], [], "approved", "longer than its words"),
    ("that the", "T5", ["general"], [], "approved", ""),
    ("from the", "T6", ["en"], ["by the"], "approved", ""),
    ("la", "T7", ["fr"], [], "approved", ""),
    ("de la", "T8", ["fr", "es"], [], "approved", "two domains"),
    ("der", "T9", ["de"], [], "approved", ""),
    ("und", "T10", ["de"], [], "draft", ""),
]
DOMAINS = ("en", "fr", "de", "es")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang", "source")


def terms(spark: SparkSession) -> DataFrame:
    rows = [(i, s, t, d, a, st, None, n) for i, (s, t, d, a, st, n) in enumerate(TERMS)]
    return spark.createDataFrame(rows, f"term_no long, {glossary.TERM_SCHEMA}").coalesce(1)


def every_term(spark: SparkSession) -> DataFrame:
    """Approved terms of all domains."""
    return glossary.active_terms(terms(spark), DOMAINS)


def matches(spark: SparkSession, sf_dir: str, offsets: bool = True) -> DataFrame:
    return matching.find_terms(docs(spark, sf_dir), every_term(spark), offsets=offsets)


def books(spark: SparkSession, sf_dir: str, texts: bool = True) -> DataFrame:
    """Documents as pages of one book per source; texts join the numbers by document, once, as several steps read them."""
    rows = docs(spark, sf_dir).select(F.col("source").alias("book"), "doc_id", F.length("text").alias("chars"))
    numbered = scan.number_rows(rows, "doc_id", name="page_no", by=("book",)).withColumn("page_no", F.col("page_no").cast("int"))
    return sinks.stored(numbered.join(docs(spark, sf_dir).select("doc_id", "text"), "doc_id"), "pages") if texts else numbered


def scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as scanned books: a title page, contents of two pages and, in long ones, back matter."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("book"), F.col("turn").cast("int").alias("turn"), F.coalesce("text", F.lit("")).alias("text"))
    last = F.max("turn").over(Window.partitionBy("book"))
    title = F.concat(F.lit("# Book "), F.col("book").cast("string"), F.lit("\n[by] Author "), F.col("book").cast("string"))
    entry = F.concat(F.lit("A .... 1\nB .... 2\n"), "text")
    page = F.when(F.col("turn") == 0, title).when(F.col("turn") == 1, F.concat(F.lit("Contents\n"), "text")).when(F.col("turn") == 2, entry).when((F.col("turn") == F.col("last")) & (F.col("last") > 4), F.concat(F.lit("## Index\n"), "text")).otherwise(F.col("text"))
    return rows.withColumn("last", last).select("book", F.col("turn").alias("page_no"), page.alias("text"))


def planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.plan_parts(books(spark, sf_dir, texts=False).select("book", "page_no", "chars"), ["book"])


def term_frequency(spark, sf_dir):
    """Occurrences of each term, longest match first."""
    return matching.term_counts(matches(spark, sf_dir, offsets=False))


def term_report(spark, sf_dir):
    """The report over masked texts; the flagship."""
    out = report.term_report(docs(spark, sf_dir), every_term(spark))
    forms = F.array_join(F.transform("forms", lambda x: F.format_string("%s (%d)", x["form"], x["count"])), ", ")
    return out.select("rank", "source", "target", "occurrences", forms.alias("forms"), F.array_join("domains", ",").alias("domains"), F.array_join("notes", "; ").alias("notes"), "n_files")


def term_forms_top8(spark, sf_dir):
    """A2: most frequent forms of each term."""
    return matching.form_counts(matches(spark, sf_dir, offsets=False)).select("source", F.col("matched_text").alias("form"), "n", F.col("form_no").cast("long").alias("form_no"))


def longest_match(spark, sf_dir):
    """Accepted matches of each document."""
    return matches(spark, sf_dir).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_matches"), F.sum((F.col("end") - F.col("start")).cast("long")).alias("matched_chars"), F.count(F.when(F.col("source").contains(" "), 1)).alias("n_phrases"))


def _large_dictionary(spark, sf_dir) -> DataFrame:
    """Pairs of words of conversations, triples and words of the benchmark, some 20,000 phrases at the least size tested, as terms."""
    word = "[a-z0-9_]+"
    found = lambda name, pattern: table(spark, sf_dir, name).select(F.explode(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(pattern), F.lit(0))).alias("source"))
    every = found("conversations", f"{word} {word}").union(found("benchmark", f"{word} {word} {word}")).union(found("benchmark", word)).distinct()
    return every.select(F.lit(0).cast("long").alias("term_no"), "source", F.lit("T").alias("target"), F.array(F.lit("*")).alias("domains"), F.expr("cast(array() as array<string>)").alias("aliases"), F.lit("").alias("note"))


def dictionary_matches(spark, sf_dir):
    """A dictionary of tens of thousands of phrases in all documents, longest match first."""
    found = matching.find_terms(docs(spark, sf_dir), _large_dictionary(spark, sf_dir))
    return found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_matches"), F.sum((F.col("end") - F.col("start")).cast("long")).alias("matched_chars"), F.count(F.when(F.col("source").contains(" "), 1)).alias("n_phrases"))


#: Spellings that case folding makes equal, three and three, and those that it keeps apart.
SPELLINGS = (("Stra\u00dfe", "STRASSE", "stra\u1e9ee"), ("\u039f\u0394\u039f\u03a3", "\u03bf\u03b4\u03bf\u03c2", "\u03bf\u03b4\u03bf\u03c3"), ("\u212aelvin", "Kelvin", "kelvin"), ("\u0130x", "i\u0307x", "ix"))


def folded_spellings(spark, sf_dir):
    """How many documents have each key of spellings that differ in case, dealt out to them before their first word."""
    spelled = F.element_at(F.array(*(F.lit(x) for group in SPELLINGS for x in group)), (F.pmod("doc_id", F.lit(3 * len(SPELLINGS))) + 1).cast("int"))
    phrase = F.concat(spelled, F.lit("  "), F.regexp_extract("text", "([A-Za-z]+)", 1))
    return docs(spark, sf_dir).groupBy(X.term_key(phrase).alias("key")).agg(F.count(F.lit(1)).alias("n"))


def term_conflicts(spark, sf_dir):
    """Host names that part of the pages reach by both schemes, as phrases with two targets."""
    url = F.regexp_extract_all("url", F.lit("^([a-z]+)://([^/]*)"), F.lit(1))
    rows = table(spark, sf_dir, "pages").where("url is not null").select(F.regexp_extract("url", "://([^/]*)", 1).alias("source"), url[0].alias("target")).where("source <> ''").distinct()
    shaped = rows.withColumn("aliases", F.expr("cast(array() as array<string>)"))
    return glossary.conflicts(shaped)


def domain_filter(spark, sf_dir):
    """active terms of each language of the documents."""
    out = None
    for d in DOMAINS:
        part = glossary.active_terms(terms(spark), d).select(F.lit(d).alias("domain"), "source", "target")
        out = part if out is None else out.unionByName(part)
    return table(spark, sf_dir, "documents").select(F.col("lang").alias("domain")).distinct().join(F.broadcast(out), "domain")


def table_term_filter(spark, sf_dir):
    """Part names as a term table; usable terms that the dictionary lacks, first row of each."""
    value = F.concat("p_name", F.lit("\t"), "p_brand", F.lit(" "), "p_type")
    lines = table(spark, sf_dir, "part").select(F.lit(0).alias("table_no"), F.col("p_partkey").alias("line_no"), value.alias("value"))
    added = glossary.add_table_terms(every_term(spark), glossary.parse_term_table(lines))
    return added.where(F.col("term_no") >= (1 << 40)).select("source", "target")


def content_tokens(spark, sf_dir):
    """Distinct content tokens of each document."""
    t = X.content_tokens(F.col("text"))
    return docs(spark, sf_dir).select("doc_id", F.size(t).cast("long").alias("n_tokens"), F.array_min(t).alias("first_token"))


def _coverage(spark, sf_dir):
    pages = books(spark, sf_dir).select("book", "page_no", "text")
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    outputs = docs(spark, sf_dir).join(good, "doc_id", "left_semi").select(F.col("source").alias("book"), "text")
    return audit.coverage(pages, outputs, ["book"])


def coverage_audit(spark, sf_dir):
    """How far a source's documents of good quality cover each of its pages."""
    return _coverage(spark, sf_dir)


def missing_pages(spark, sf_dir):
    """Overall coverage and verdict by source."""
    return audit.completeness(_coverage(spark, sf_dir), ["book"])


def chapter_parts(spark, sf_dir):
    """Parts of balanced size."""
    return chunking.part_ranges(planned(spark, sf_dir), ["book"])


def chapter_ranges(spark, sf_dir):
    """Page range and parts of each book."""
    return chunking.chapter_ranges(chapter_parts(spark, sf_dir), ["book"])


def _turns(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("text")))).alias("t"))
    return rows.select(F.col("conv_id").alias("doc_id"), F.array_join(F.col("t.text"), "\n\n").alias("text"))


def block_packing(spark, sf_dir):
    """Conversations packed to chunks of 1,000 characters at blank lines."""
    return chunking.chunk_rows(_turns(spark, sf_dir), max_chars=1000).select("doc_id", "chunk_no", "chunk_start", "chunk_end", F.sha2("chunk", 256).alias("chunk_sha256"))


def chunk_match_overlap(spark, sf_dir):
    """Lines that lie in each chunk of a conversation."""
    turns = _turns(spark, sf_dir)
    lengths = F.transform(F.split("text", "\n"), lambda x: F.length(x))
    line = turns.select("doc_id", F.posexplode(lengths).alias("line_no", "n"))
    start = F.coalesce(F.sum(F.col("n") + 1).over(Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = line.withColumn("start", start).withColumn("end", F.col("start") + F.col("n"))
    return chunking.overlapping(chunking.chunk_rows(turns, max_chars=1000), spans).groupBy("doc_id", "chunk_no").agg(F.count(F.lit(1)).alias("n_lines"), F.min("line_no").alias("first_line"))


def section_in_chunk(spark, sf_dir):
    """Long pages as sections, counted by part."""
    sections = books(spark, sf_dir, texts=False).select("book", F.when(F.col("chars") > 3000, F.col("page_no")).alias("section_start"))
    return chunking.sections_in_parts(chapter_parts(spark, sf_dir), sections, ["book"]).groupBy("book", "part").agg(F.count(F.lit(1)).alias("n_sections"))


def range_pages(spark, sf_dir):
    """Pages of each part, found by their numbers."""
    return chunking.pages_of_ranges(chapter_parts(spark, sf_dir).select("book", "part", "first_page", "last_page"), books(spark, sf_dir, texts=False).select("book", "page_no", F.col("chars").alias("n")), ["book"]).groupBy("book", "part").agg(F.count(F.lit(1)).alias("pages"), F.sum("n").alias("characters"))


def neighbour_pages(spark, sf_dir):
    """Pages before and after every page."""
    return chunking.neighbours(books(spark, sf_dir, texts=False), ["book"])


def contiguity_violations(spark, sf_dir):
    """Documents of a source that do not follow the one before."""
    rows = docs(spark, sf_dir).select("source", "doc_id", F.col("doc_id").alias("first_page"), F.col("doc_id").alias("last_page"))
    return chunking.contiguity_violations(rows, ["source"], "doc_id").groupBy("source").agg(F.count(F.lit(1)).alias("n_violations"))


def body_bounds(spark, sf_dir):
    """Contents, start and end of the body."""
    return boundaries.detect_boundaries(scans(spark, sf_dir))


def metadata_heading(spark, sf_dir):
    """Titles and authors."""
    pages = scans(spark, sf_dir)
    return boundaries.infer_metadata(pages, boundaries.detect_boundaries(pages))


def body_page_count(spark, sf_dir):
    """Valid manifests and the number of body pages."""
    pages = scans(spark, sf_dir)
    found = boundaries.detect_boundaries(pages)
    n = boundaries.body_pages(pages, found).groupBy("book").agg(F.count(F.lit(1)).alias("n_pages"))
    return boundaries.manifest_errors(found, pages).join(n, "book", "left").select("book", F.col("error").isNull().alias("valid"), F.coalesce("n_pages", F.lit(0)).cast("long").alias("n_pages"))


def page_lines(spark, sf_dir):
    """lines that are not blank."""
    lines = X.nonempty_lines(F.col("text"))
    return docs(spark, sf_dir).select("doc_id", F.size(lines).cast("long").alias("n_lines"), F.sha2(F.array_join(lines, "\n"), 256).alias("lines_sha256"))


def page_index(spark, sf_dir):
    """headings and opening lines."""
    out = boundaries.page_index(docs(spark, sf_dir))
    return out.select("doc_id", F.size("headings").cast("long").alias("n_headings"), F.array_join("opening", " | ").alias("opening"))


def _references(spark, sf_dir):
    host = F.regexp_extract("url", "://([^/?#]*)", 1)
    body = F.concat(F.lit("<IMG alt=x src='img/"), host, F.lit(".png'> ![x](pic\\"), host, F.lit(".jpg ) ![y]("), "url", F.lit(")"))
    return table(spark, sf_dir, "pages").where("url is not null").select("page_id", host.alias("host"), F.array_sort(X.image_references(body)).alias("refs"))


def image_refs(spark, sf_dir):
    """Image references of each page."""
    return _references(spark, sf_dir).select("page_id", F.size("refs").cast("long").alias("n_refs"), F.array_join("refs", "|").alias("refs"))


def missing_refs(spark, sf_dir):
    """Local references without a file."""
    found = _references(spark, sf_dir)
    have = found.where(F.col("host").startswith("blog.")).select(F.concat(F.lit("img/"), "host", F.lit(".png")).alias("path")).distinct()
    return lifecycle.missing_references(found, have)


#: What is put before texts so that each rule of a fragment is broken somewhere.
FAULTS = ("", "```tex\n", "\\documentclass{a}", "<Table >", "\\caption{ Image }", "\\text{x}" * 40, ("\\text{a}\\text {b}\\text{c}" + "w " * 360 + "\n") * 2, "\\chapter{A}\n")


def artifact_violations(spark, sf_dir):
    """first broken rule of documents, with a fault put before most of them, and of pages as fragments."""
    fault = F.element_at(F.array(*map(F.lit, FAULTS)), (F.pmod("doc_id", F.lit(len(FAULTS))) + 1).cast("int"))
    text = F.when(F.pmod("doc_id", F.lit(17)) == 0, F.lit(" \n")).otherwise(F.concat(fault, "text"))
    both = docs(spark, sf_dir).select(text.alias("text")).unionByName(table(spark, sf_dir, "pages").select(F.coalesce("html", F.lit("")).alias("text")))
    return both.groupBy(F.coalesce(audit.artifact_error(F.col("text"), F.lit(True)), F.lit("valid")).alias("rule")).agg(F.count(F.lit(1)).alias("n"))


def control_chars(spark, sf_dir):
    """first forbidden control character of each document, with one put into every text that has a percent sign."""
    text = F.replace("text", F.lit("%"), F.lit("\x07"))
    return docs(spark, sf_dir).groupBy(X.control_character(text).alias("code")).agg(F.count(F.lit(1)).alias("n"))


#: The head of a source, and that of its outputs: the same, then each structure changed.
HEADS = tuple("%s A\n%s\n\\%s{B}\n\\label{%s} \\cite[p]{%s}\n" % x for x in (("#", "---", "section", "c", "d"), ("##", "---", "section", "c", "d"), ("#", "--", "section", "c", "d"), ("#", "---", "chapter*", "c", "d"), ("#", "---", "section", "e", "d"), ("#", "---", "section", "c", "d,f")))


def structural_diff(spark, sf_dir):
    """Structures that differ between documents under one head and their outputs under others; of some, number signs and dashes go too."""
    head = F.element_at(F.array(*map(F.lit, HEADS)), (F.pmod("doc_id", F.lit(len(HEADS))) + 1).cast("int"))
    body = F.when(F.pmod("doc_id", F.lit(7)) == 0, F.translate("text", "#-", "")).otherwise(F.col("text"))
    w = audit.structural_warnings(F.concat(F.lit(HEADS[0]), "text"), F.concat(head, body))
    return docs(spark, sf_dir).select("doc_id", F.array_join(w, ",").alias("warnings"))


def terminology_missing(spark, sf_dir):
    """Terms whose target the text itself lacks."""
    rules = matching.unique_rules(matches(spark, sf_dir, offsets=False)).withColumn("target", F.lower("source"))
    return audit.terminology_warnings(rules, docs(spark, sf_dir)).groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))


def _candidates(spark, sf_dir, role):
    word = F.regexp_extract("text", "([A-Za-z]+)", 1)
    rows = table(spark, sf_dir, "conversations").where(F.col("role") == role)
    return rows.select(word.alias("source"), F.lit(" t ").alias("target"), F.lit("").alias("domain"), F.when(F.col("turn") > 2, F.concat(F.lit("r"), F.col("turn").cast("string"))).otherwise("").alias("reason"), F.struct("conv_id", "turn").alias("no"))


def candidate_upsert(spark, sf_dir):
    """First words of user turns as the ledger, those of assistant turns as a batch."""
    old, new = F.lit("2024-01-01").cast("timestamp"), F.lit("2024-02-01").cast("timestamp")
    empty = spark.createDataFrame([], "source string, target string, domain string, reason string, status string, occurrences long, first_seen timestamp, last_seen timestamp")
    before = ledger.upsert(empty, ledger.sanitize(_candidates(spark, sf_dir, "user")), old)
    after = ledger.upsert(before, ledger.sanitize(_candidates(spark, sf_dir, "assistant")), new)
    return after.select(F.lower("source").alias("source"), "target", "domain", "reason", "status", "occurrences", F.date_format("first_seen", "yyyy-MM-dd").alias("first_seen"), F.date_format("last_seen", "yyyy-MM-dd").alias("last_seen"))


def ledger_versions(spark, sf_dir):
    """A stored ledger after a batch of first words of user turns and one of benchmark items; ``rewritten``: the second batch wrote the entry's part anew."""
    folder = sinks.new_folder(spark, "ledger")
    old, new = F.lit("2024-01-01").cast("timestamp"), F.lit("2024-02-01").cast("timestamp")
    items = table(spark, sf_dir, "benchmark").select(F.regexp_extract("text", "([A-Za-z]+)", 1).alias("source"), F.lit("t").alias("target"), F.lit("").alias("domain"), F.lit("b").alias("reason"), F.col("item_id").alias("no"))
    ledger.upsert_stored(folder, ledger.sanitize(_candidates(spark, sf_dir, "user")), old, 1)
    first = ledger.versions.state(folder)["folders"]
    ledger.upsert_stored(folder, ledger.sanitize(items), new, 2)
    ledger.upsert_stored(folder, ledger.sanitize(items), new, 2)  # counted in already
    second = ledger.versions.state(folder)["folders"]
    moved = [int(b) for b, at in second.items() if first.get(b) != at]  # at most BUCKETS
    out = ledger.read_stored(spark, folder)
    return ledger.keyed(out).select(F.lower("source").alias("source"), "occurrences", "reason", F.date_format("last_seen", "yyyy-MM-dd").alias("last_seen"), ledger.bucket_of(out).isin(moved).alias("rewritten"))


def approve_term(spark, sf_dir):
    """One term updated and one added, beside the number of documents of its domain."""
    out = glossary.approve_term(glossary.approve_term(terms(spark), "UND", "T11", "de", "r1"), "neu", "T12", "de", "r2")
    n = table(spark, sf_dir, "documents").where("lang = 'de'").agg(F.count(F.lit(1)).alias("n_docs"))
    return out.select("term_no", "source", "target", F.coalesce("status", F.lit("")).alias("status"), F.coalesce("source_reference", F.lit("")).alias("reference")).crossJoin(F.broadcast(n))


def pending_chunks(spark, sf_dir):
    """Documents without a label of good quality."""
    return lifecycle.pending(docs(spark, sf_dir).select("doc_id", "source"), table(spark, sf_dir, "labels"), ["doc_id"], F.col("quality") == 1)


def latest_valid_attempt(spark, sf_dir):
    """Newest event of each user that is no error."""
    out = lifecycle.latest_valid(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") != "error")
    return out.select("user_id", "event_id", "event_type", "value")


def jsonl_pages(spark, sf_dir):
    """Conversations as nested result lines, their pages numbered through."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("role", F.lit("")).alias("role"))
    packed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "text", "role"))).alias("t"))
    pages = F.transform("t", lambda x: F.struct(F.struct(x["text"].alias("text"), F.create_map(F.lit("a"), x["role"]).alias("images")).alias("markdown")))
    lines = packed.select(F.col("conv_id").alias("line_no"), F.to_json(F.struct(F.struct(pages.alias("layoutParsingResults")).alias("result"))).alias("value"))
    out = files.ocr_pages(lines)
    return out.select("line_no", "page_no", F.length("text").cast("long").alias("chars"), F.col("images")["a"].alias("role"))


def arxiv_ids(spark, sf_dir):
    """Identifiers in urls, and their folder names."""
    url = F.concat(F.lit("https://arxiv.org/abs/"), F.when(F.col("url").contains("/en/"), F.lit("math.AG/")).otherwise(F.lit("2101.")), F.lpad(F.col("page_id").cast("string"), 7, "0"), F.lit("v2"))
    found = X.arxiv_id(url)
    return table(spark, sf_dir, "pages").where("url is not null").select("page_id", found.alias("arxiv_id"), X.safe_dir_name(found).alias("folder"))


def ordered_assembly(spark, sf_dir):
    """The root document of each book."""
    parts = chapter_parts(spark, sf_dir).withColumn("chapter_number", F.lit(1)).withColumn("chapter_title", F.concat(F.lit("On "), F.coalesce("book", F.lit("")), F.lit("_&")))
    inputs = assemble.chapter_inputs(parts, ["book"])
    return inputs.select("book", "complete", F.sha2(assemble.root_document(F.col("inputs"), F.coalesce("book", F.lit("")), F.lit("")), 256).alias("tex_sha256"))


def command_set_diff(spark, sf_dir):
    """Hosts that only secure or only plain pages have."""
    rows = table(spark, sf_dir, "pages").where("url is not null").select(F.regexp_extract("url", "://([^/?#]*)", 1).alias("host"), F.col("url").startswith("https:").alias("safe"))
    return audit.set_difference(rows.where("safe"), rows.where("not safe"), "host")


def tex_escape(spark, sf_dir):
    """Escaped texts."""
    return docs(spark, sf_dir).select("doc_id", F.sha2(X.tex_escape(F.col("text")), 256).alias("tex_sha256"))


def sanitized_candidates(spark, sf_dir):
    """candidates with both sides."""
    rows = table(spark, sf_dir, "conversations").select(F.col("text").alias("source"), F.concat(F.lit(" "), "role", F.lit("\n")).alias("target"), F.when(F.col("role") == "user", "algebra").otherwise(" ").alias("domain"), F.lit(None).cast("string").alias("reason"))
    return ledger.sanitize(rows, "general").groupBy("domain").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("target").cast("long")).alias("target_chars"))


def chapter_violations(spark, sf_dir):
    """Broken rules of conversations as chapter manifests whose turns are chapters of one page, each book with one of twelve faults or none."""
    pages = sinks.stored(scans(spark, sf_dir).select("book", "page_no", "text"), "scans")
    found = sinks.stored(boundaries.detect_boundaries(pages), "bounds")  # read by four steps
    pages = pages.select("book", "page_no")
    fault, page, end = F.pmod("book", F.lit(13)), F.col("page_no"), F.col("end_page_excluded")
    rows = boundaries.body_pages(pages, found).join(found.select("book", "end_page_excluded"), "book")
    rows = rows.where(~F.coalesce((fault == 10) & (page == end - 1), F.lit(False)) & ~((fault == 0) & (F.pmod("book", F.lit(26)) == 0)))
    start = F.when((fault == 5) & (page == 3), 0).when((fault == 6) & (page == 4), 3).otherwise(page)
    last = F.when(fault == 3, page - 1).when(fault == 4, page + 1000).otherwise(page)
    section = F.array(F.struct(F.when(fault != 8, "s").alias("title"), F.when(fault == 9, page + 1).otherwise(page).alias("ocr_start_page")))
    chapters = rows.select("book", (page - 2 + (fault == 1).cast("int")).alias("number"), F.when(fault == 2, " ").otherwise("T").alias("title"), start.alias("ocr_start_page"), last.alias("ocr_end_page"), F.when(fault != 7, section).alias("sections"))
    ends = found.where(fault != 11).select("book", (end + F.when(fault == 12, 5).otherwise(0)).alias("ocr_start_page"))
    return boundaries.chapter_errors(chapters, found, pages, ends=ends).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


def output_names(spark, sf_dir):
    """formats and output names of paths."""
    suffix = F.element_at(F.array(*map(F.lit, ("md", "TeX", "ltx", "txt"))), (F.length("lang") + F.length(F.coalesce("source", F.lit("")))) % 4 + 1)
    path = F.concat(F.coalesce("source", F.lit("")), F.lit("/a."), suffix)
    return table(spark, sf_dir, "documents").groupBy(X.document_format(path).alias("format"), X.output_path(path).alias("output")).agg(F.count(F.lit(1)).alias("n"))


def mask_counts(spark, sf_dir):
    """O3: masked regions of documents and pages, and those that cannot be masked."""
    both = docs(spark, sf_dir).select("doc_id", "text", F.lit("document").alias("kind")).unionByName(table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), F.coalesce("html", F.lit("")).alias("text"), F.lit("page").alias("kind")))
    return masking.mask(both).groupBy("kind", F.col("mask.error").alias("error")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("mask.tokens").cast("long")).alias("n_tokens"))


def mask_roundtrip(spark, sf_dir):
    """Whether texts come back from their masked form as they were; of those that cannot be masked, why."""
    masked = masking.mask(docs(spark, sf_dir))
    back = masking.restore(F.col("mask.masked"), F.col("mask.tokens"), F.col("mask.originals"))
    return masked.select("doc_id", F.when(F.col("mask.error").isNull(), back["text"] == F.col("text")).alias("same"), F.coalesce("mask.error", back["error"]).alias("error"))


def _masked(spark, sf_dir) -> DataFrame:
    """Documents with their masked text, written once, as several steps read them."""
    return sinks.stored(masking.mask(docs(spark, sf_dir)).select("doc_id", "lang", "mask.masked", "mask.tokens", "mask.originals", "mask.error"), "masked")


def _masked_matches(spark, masked: DataFrame) -> DataFrame:
    return matching.find_terms(masked.where("error is null").select("doc_id", F.col("masked").alias("text")), every_term(spark), offsets=False)


def _translated(spark, sf_dir) -> DataFrame:
    """doc_id, text, tries and error of every document, translated by the stand-in."""
    masked = _masked(spark, sf_dir)
    return flows.translated(masked, flows.translation_answers(masked, every_term(spark)))


def translate_documents(spark, sf_dir):
    """Masked, matched, cut, sent to the stand-in, checked and put back."""
    return _translated(spark, sf_dir).select("doc_id", F.sha2("text", 256).alias("text_sha256"), "tries", "error")


def proposing(prompts: list[str]) -> list[str]:
    """A stand-in that gives its chunk back and proposes each word of 7 to 12 small letters as a term, those that begin with a as often without a target and those with e without a domain."""
    out = []
    for p in prompts:
        chunk = p.split("<SOURCE>\n", 1)[1].rsplit("\n</SOURCE>", 1)[0]
        found = [{"source": f" {w}\n", "target": " " if w[0] == "a" else w.upper(), "domain": "" if w[0] == "e" else "General", "reason": f"ends in {w[-1]}"} for w in re.findall(r"\b[a-z]{7,12}\b", chunk, re.ASCII)]
        out.append(json.dumps({"translation": chunk, "candidate_terms": found}, ensure_ascii=False))
    return out


def learned_terms(spark, sf_dir):
    """Terms that translations of all documents propose, counted into a stored ledger; the batch is offered twice and counts once."""
    masked = _masked(spark, sf_dir)
    answers = sinks.stored(flows.translation_answers(masked, every_term(spark), proposing), "answers")
    batch, folder = flows.candidates(answers, flows.translated(masked, answers)), sinks.new_folder(spark, "ledger")
    for _ in range(2):
        ledger.upsert_stored(folder, batch, F.lit("2024-01-01").cast("timestamp"), 1)
    return ledger.read_stored(spark, folder).select("source", "target", "domain", "reason", "status", "occurrences")


def translation_warnings(spark, sf_dir):
    """Structures and terms that each translation by the stand-in lacks."""
    rules = matching.unique_rules(matches(spark, sf_dir, offsets=False))
    return flows.translation_warnings(docs(spark, sf_dir), _translated(spark, sf_dir), rules).select("doc_id", F.array_join("warnings", "; ").alias("warnings"))


def faulty_answers(prompts: list[str]) -> list[str]:
    """A stand-in that does what the digit at the head of a prompt says: loses, repeats or invents a token, gives no JSON or another shape; 1, 2 and 5 do well when they are told."""
    out = []
    for p in prompts:
        chunk, again = p.split("<SOURCE>\n", 1)[1].rsplit("\n</SOURCE>", 1)[0], "The last answer failed" in p
        first = chunk[: chunk.index(" ")]
        lost, twice, invented = chunk[len(first) :], f"{first}{chunk}", f"{chunk}{masking.PREFIX}000009@@"
        text = {"1": chunk if again else lost, "2": chunk if again else twice, "3": invented, "4": lost}.get(p[0], chunk)
        good = json.dumps({"translation": text, "candidate_terms": []}, ensure_ascii=False)
        out.append({"5": good if again else "no JSON", "6": "[1]"}.get(p[0], good))
    return out


def answer_faults(spark, sf_dir):
    """Documents between two tokens, with answers that lose, repeat and invent tokens or have another shape; what the second try mends."""
    token = lambda i: f"{masking.PREFIX}{i:06d}@@"
    rows = docs(spark, sf_dir).withColumn("chunk", F.concat(F.lit(token(0) + " "), "text", F.lit(" " + token(1)))).withColumn("tokens", F.array(F.lit(token(0)), F.lit(token(1))))
    prompt = F.concat(F.pmod("doc_id", F.lit(7)).cast("string"), F.lit("\n<SOURCE>\n"), "chunk", F.lit("\n</SOURCE>"))
    answers = backend.checked(backend.parsed(backend.generate(rows.select("doc_id", "chunk", "tokens", prompt.alias("prompt")), faulty_answers, backend.check_tokens)))
    back = masking.restore(F.col("translation"), F.col("tokens"), F.array(F.lit("$a$"), F.lit("$b$")))
    return answers.select("doc_id", "tries", F.coalesce("error", "token_error", back["error"]).alias("error"), F.sha2(back["text"], 256).alias("text_sha256"))


def _file_name(prefix: str) -> Column:
    suffix = F.element_at(F.array(*map(F.lit, ("md", "TEX", "markdown", "txt"))), (F.pmod("doc_id", F.lit(4)) + 1).cast("int"))
    return F.concat(F.lit(f"{prefix}/"), F.lpad(F.pmod("doc_id", F.lit(16)).cast("string"), 2, "0"), F.lit("/d"), F.lpad(F.col("doc_id").cast("string"), 12, "0"), F.lit("."), suffix)


def scanned_files(spark, sf_dir):
    """Every document written to a file of its own, some with a byte that is no UTF-8, and read back in the order of paths; the folder is named twice."""
    broken = F.when(F.pmod("doc_id", F.lit(10)) == 1, F.lit(b"\xff")).otherwise(F.lit(b""))
    content = F.concat(F.encode(F.concat(F.replace("text", F.lit("\n"), F.lit("\r\n")), F.lit("\n")), "UTF-8"), broken)
    folder = sinks.new_folder(spark, "files")
    text_sink.write_files(docs(spark, sf_dir).select(_file_name("texts").alias("name"), content.alias("content")), folder)
    out = files.scan_texts(spark, folder, f"{folder}/texts")
    return out.select("file_no", F.regexp_extract("path", "(texts/.*)$", 1).alias("name"), "format", F.sha2("text", 256).alias("text_sha256"), "error")


def written_translations(spark, sf_dir):
    """Translations written as one text each, in 1,024 folders, and read back as they are; what could not be translated has no file."""
    folder = sinks.new_folder(spark, "translations")
    made = _translated(spark, sf_dir).where("error is null")
    name = F.concat(F.lpad(F.pmod("doc_id", F.lit(1024)).cast("string"), 4, "0"), F.lit("/d"), F.col("doc_id").cast("string"), F.lit(".zh.md"))
    text_sink.write_files(made.select(name.alias("name"), "text"), folder)
    back = files.scan_texts(spark, folder, empty=True, as_is=True)
    return back.select(F.regexp_extract("path", r"d(-?\d+)\.zh\.md$", 1).cast("long").alias("doc_id"), F.sha2("text", 256).alias("text_sha256"), "error")


def archive_members(spark, sf_dir):
    """Pages packed to archives and read back; names that are absolute, leave the folder or only look like a neighbour of it."""
    kind = F.pmod("page_id", F.lit(9))
    number = F.col("page_id").cast("string")
    name = F.when(kind == 1, F.concat(F.lit("../"), number)).when(kind == 2, F.concat(F.lit("/p/"), number)).when(kind == 3, F.concat(F.lit("p/../../p-more/"), number)).when(kind == 4, F.concat(F.lit("p/x/.././"), number)).otherwise(F.concat(F.lit("p/"), number))
    pages = table(spark, sf_dir, "pages").select(F.floor(F.col("page_id") / 100).cast("long").alias("archive"), name.alias("name"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("content"))
    folder = sinks.new_folder(spark, "archives")
    text_sink.write_files(archives.pack(pages, "archive").select(F.concat(F.lit("a"), F.col("archive").cast("string"), F.lit(".tar.gz")).alias("name"), "content"), folder)
    return archives.read_archives(spark, folder).select(F.regexp_extract("archive", r"a(\d+)\.tar", 1).cast("long").alias("archive"), "name", "size", F.sha2("content", 256).alias("content_sha256"), "error")


def report_document(spark, sf_dir):
    """The report as Markdown with its heading, counters and table."""
    masked = _masked(spark, sf_dir)
    forms = sinks.stored(report.count_forms(_masked_matches(spark, masked)), "forms")  # texts are masked and matched once for both parts
    totals = report.report_counts(masked, every_term(spark), forms.groupBy("source", "target").agg(F.sum("n").alias("count")))
    return report.report_document(report.rank_forms(forms), totals, "all").select("line_no", "value")


def prompt_rules(spark, sf_dir):
    """The rules that each document's chunks are sent with."""
    m = matching.unique_rules(matches(spark, sf_dir, offsets=False))
    return backend.rule_lines(m, ["doc_id"])


def report_counters(spark, sf_dir):
    """A4: the report's counters."""
    masked = _masked(spark, sf_dir)
    return report.report_totals(masked, every_term(spark), _masked_matches(spark, masked))


def chunk_index(spark, sf_dir):
    """K4: page numbers and characters of every part."""
    p = planned(spark, sf_dir)
    return chunking.chunk_index(chunking.part_ranges(p, ["book"]), p, ["book"]).select("book", "part", F.array_join("pages", ",").alias("pages"), "characters")


def _requests(spark, sf_dir) -> DataFrame:
    """Every part of every book; numbers are given once, and texts join them last."""
    pages = sinks.stored(books(spark, sf_dir, texts=False), "numbers")
    plan = chunking.plan_parts(pages.select("book", "page_no", "chars"), ["book"])
    return flows.chunk_requests(pages.drop("chars"), plan, ["book"], docs(spark, sf_dir))


def _converted(spark, sf_dir, generator=flows.echo_fragment) -> DataFrame:
    return flows.converted(_requests(spark, sf_dir), ["book"], generator=generator)


def convert_chunks(spark, sf_dir):
    """Every part of every book through the stand-in, with all checks."""
    return _converted(spark, sf_dir).select("book", "part", "chunk_id", F.sha2("tex", 256).alias("tex_sha256"), "error", "overall_coverage", "accepted")


def review_chunks(spark, sf_dir):
    """Accepted fragments through the stand-in again."""
    return flows.review(_converted(spark, sf_dir), ["book"]).select("book", "part", (F.col("tex") == F.col("first_version")).alias("same"), "error")


def faulty_fragments(prompts: list[str]) -> list[str]:
    """A stand-in whose fault follows from the number of the part: another chunk, pages turned round, notes missing, an empty text, a root document within a fence."""
    out = []
    for p, answer in zip(prompts, flows.echo_fragment(prompts)):
        value = json.loads(answer)
        fault = int(value["report"]["chunk_id"].rsplit("_", 1)[1]) % 7
        if fault == 1:
            value["report"]["chunk_id"] = "other"
        elif fault == 2:
            value["report"]["source_pages"] = [*reversed(value["report"]["source_pages"]), -1]
        elif fault in (3, 4):
            del value["report"]["structure_notes" if fault == 3 else "image_notes"]
        elif fault == 5:
            value["tex"] = " "
        elif fault == 6:
            value["tex"] = "```tex\n\\documentclass{a}\n" + value["tex"]
        out.append(json.dumps(value, ensure_ascii=False))
    return out


def conversion_faults(spark, sf_dir):
    """Every part of every book answered with one of six faults or none; the first broken rule of each."""
    made = _converted(spark, sf_dir, faulty_fragments)
    return made.select("book", "part", "error", "accepted")


def review_faults(spark, sf_dir):
    """Accepted fragments reviewed by a stand-in with the same faults; of an answer with a root document that breaks an earlier rule too, the root is told."""
    return flows.review(_converted(spark, sf_dir), ["book"], faulty_fragments).select("book", "part", "error")


def assembly_checks(spark, sf_dir):
    """Books in chapters of two parts, validated again before they are assembled. In books of odd number, one part in three
    is missing, changed since or reported wrongly; every fourth book begins with chapter 2."""
    number = F.coalesce(F.regexp_extract("book", r"(\d+)$", 1).try_cast("int"), F.lit(2))
    chapter = F.floor(F.col("part") / 2) + F.when(number % 4 == 0, 2).otherwise(1)
    plan = planned(spark, sf_dir).withColumn("chapter_number", chapter.cast("int"))
    chunks = sinks.stored(plan.groupBy("book", "chapter_number", "part").agg(F.sort_array(F.collect_list("page_no")).alias("pages")), "chunks")
    fault, none = F.when(number % 2 == 1, (F.col("part") + F.floor(number / 2)) % 12).otherwise(1), F.expr("cast(array() as array<string>)")
    named = F.when(fault == 3, "other").otherwise(chunking.chunk_id(F.col("chapter_number"), F.col("part")))
    notes = F.when(fault != 5, none)
    report_ = F.when(fault != 6, F.struct(named.alias("chunk_id"), F.col("pages").alias("source_pages"), notes.alias("structure_notes"), none.alias("image_notes")))
    tex = F.when(fault == 7, "```tex").when(fault == 8, "\\begin{document}").otherwise("A text.")
    artifacts = chunks.where(fault != 0).select("book", "chapter_number", "part", tex.alias("tex"), report_.alias("report"))
    parts = chunks.select("book", "chapter_number", F.lit("On").alias("chapter_title"), "part", F.element_at("pages", 1).alias("first_page"), F.element_at("pages", -1).alias("last_page"))
    out = assemble.assembled(parts, assemble.assembly_faults(chunks, artifacts, ["book"]), ["book"])
    return out.select("book", F.sha2("inputs", 256).alias("inputs_sha256"), F.size("chapters").cast("long").alias("chapters"), "n_faults", "error")


def legacy_chapters(spark, sf_dir):
    """Conversations as books of whole-chapter files, some with a heading of their own, one missing in every eleventh book and a blank one in every seventh."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", (F.col("turn") + 1).alias("number"), F.concat(F.coalesce("role", F.lit("")), F.lit("_&")).alias("title"), F.coalesce("text", F.lit("")).alias("text"))
    text = F.when((F.col("conv_id") % 7 == 0) & (F.col("number") == 2), " \n\t").when(F.col("title") == "user_&", F.concat(F.lit("\\chapter* {A}\n"), "text")).otherwise(F.concat(F.lit("."), "text"))
    found = rows.where(~((F.col("conv_id") % 11 == 0) & (F.col("number") == 1))).select("conv_id", "number", text.alias("text"))
    out = assemble.legacy_chapters(rows, found, ["conv_id"])
    return out.select("conv_id", F.sha2("inputs", 256).alias("inputs_sha256"), "error")


def outliner(prompts: list[str]) -> list[str]:
    """A stand-in that makes each body page of a book a chapter; of books with a number of pages that leaves 0, 1 or 3 when divided by 4, the last chapter is too long, there are none, or the titles are blank."""
    out = []
    for p in prompts:
        pages = [x["page_no"] for x in json.loads(p.split("<PAGES>\n", 1)[1].split("\n</PAGES>", 1)[0])]
        fault = len(pages) % 4
        chapters = [{"number": i, "title": " " if fault == 3 else f"On {n}", "ocr_start_page": n, "ocr_end_page": n, "sections": [{"title": "s", "ocr_start_page": n}]} for i, n in enumerate(pages, 1)]
        chapters[-1]["ocr_end_page"] += 1000 if fault == 0 else 0
        out.append(json.dumps({"chapters": [] if fault == 1 else chapters}))
    return out


def book_outlines(spark, sf_dir):
    """Chapters of scanned books by a stand-in, and their broken rules; every fifth book is outlined already."""
    pages = sinks.stored(scans(spark, sf_dir), "scans")
    found = boundaries.detect_boundaries(pages)
    out = flows.outline(pages, found, outliner, found.where("book % 5 = 0").select("book"))
    return out.select("book", F.coalesce(F.size("chapters"), F.lit(-1)).cast("long").alias("chapters"), F.array_join("errors", "; ").alias("errors"))


#: Outlines of K, a number of each event, with faults of type; the sign before the second is a byte order mark.
_CHAPTER = '{"number": K, "title": "A", "ocr_start_page": 1, "ocr_end_page": K, "sections": [{"title": "s", "ocr_start_page": K}]}'
OUTLINES = (
    f'{{"chapters": [{_CHAPTER}], "body_end": {{"ocr_start_page": K}}}}', f'\ufeff{{"chapters": [{_CHAPTER}], "body_end": {{}}}}', f'{{"chapters": [{_CHAPTER.replace("K", chr(34) + "K" + chr(34))}], "body_end": {{}}}}',
    f'{{"chapters": {_CHAPTER}, "body_end": [K]}}', f'{{"chapters": [K, {_CHAPTER}, null], "body_end": {{"heading": null}}}}', '{"chapters": [], "body_end": {"ocr_start_page": "K"}}', "[K]", '{"chapters": [{"number": K', '"K"',
    f'{{"chapters": [{_CHAPTER.replace("[{", "[7, {").replace(chr(34) + "s" + chr(34), "null")}], "body_end": {{"heading": 3, "printed_start_page": 1.5}}}}', '{"body_end": true}',
)


def json_type_faults(spark, sf_dir):
    """An outline made of each event's properties; how many have each fault of type."""
    number = F.expr("try_variant_get(try_parse_json(props), '$.k', 'string')")
    shape = F.element_at(F.array(*map(F.lit, OUTLINES)), (F.pmod("event_id", F.lit(len(OUTLINES))) + 1).cast("int"))
    text = F.replace(shape, F.lit("K"), F.coalesce(number, F.lit("0")))
    rows = table(spark, sf_dir, "events").select(F.explode_outer(typed.outline_faults(text)).alias("fault"))
    return rows.groupBy(F.coalesce("fault", F.lit("none")).alias("fault")).agg(F.count(F.lit(1)).alias("n"))


def recovered_chunks(spark, sf_dir):
    """Parts whose broken-off runs left an answer for every second part; of two answers the newer is no fragment."""
    requests = _requests(spark, sf_dir)
    none = F.expr("cast(array() as array<string>)")
    report_ = F.struct("chunk_id", F.col("pages").alias("source_pages"), none.alias("structure_notes"), none.alias("image_notes"))
    good = F.to_json(F.struct(flows.source_text(F.col("sources")).alias("tex"), report_.alias("report")))
    made = lambda day, answer: F.struct(F.lit(day).cast("timestamp").alias("made_at"), answer.alias("answer"))
    left = F.when(F.col("part") % 2 == 0, F.array(made("2024-01-01", good), made("2024-01-02", F.lit("no answer"))))
    attempts = requests.select("book", "part", F.inline_outer(left)).where("answer is not null")  # filtered last, so that both reads of the requests share their exchanges
    out = flows.converted(requests, ["book"], attempts=attempts)
    return out.select("book", "part", F.sha2("tex", 256).alias("tex_sha256"), "accepted", "recovered")


def document_report(spark, sf_dir):
    """The report of each book's document."""
    made = _converted(spark, sf_dir)
    parts = chapter_parts(spark, sf_dir).withColumn("chapter_number", F.lit(1)).withColumn("chapter_title", F.col("book"))
    out = assemble.document_report(assemble.chapter_inputs(parts, ["book"]), made, flows.review(made, ["book"]), ["book"])
    passed = F.array_join(F.transform("completeness", lambda x: F.concat_ws(":", x["chunk_id"], x["passed"].cast("string"))), ",")
    return out.select("book", "chunks", "chapters", F.col("chapter_ranges")[0]["end_page"].alias("end_page"), "reviewed_chunks", passed.alias("completeness"))


def completeness_report(spark, sf_dir):
    """How far the documents of good quality in each part cover its pages."""
    pages = books(spark, sf_dir).join(planned(spark, sf_dir).select("book", "page_no", "part"), ["book", "page_no"])
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id").distinct()
    covered = audit.coverage(pages.select("book", "part", "page_no", "text"), pages.join(good, "doc_id", "left_semi").select("book", "part", "text"), ["book", "part"])
    out = audit.completeness_report(covered, ["book", "part"])
    shares = F.array_join(F.transform("pages", lambda x: F.round(x["coverage"] * 1000).cast("int").cast("string")), ",")
    return out.select("book", "part", "passed", "overall_coverage", "allowed_missing_pages", F.array_join("missing_pages", ",").alias("missing_pages"), shares.alias("shares"))


def unknown_pages(spark, sf_dir):
    """Pages that the index of every second document's neighbours names and the books lack."""
    pages = books(spark, sf_dir, texts=False).select("book", "page_no")
    named = pages.where("page_no % 2 = 0").groupBy("book").agg(F.array(F.max("page_no"), F.max("page_no") + 2).alias("pages"))
    return lifecycle.unknown_pages(named, pages, ["book"])


def changed_manifests(spark, sf_dir):
    """Manifests that differ from those stored before the back matter of every third book was found."""
    new = boundaries.detect_boundaries(scans(spark, sf_dir))
    old = new.withColumn("end_page_excluded", F.when(F.col("book") % 3 != 0, F.col("end_page_excluded")))
    return boundaries.changed_manifests(new, old)


def main_files(spark, sf_dir):
    """Documents under a root's head, roots first, and the root with its chapters' translations."""
    root = F.concat(F.lit("\\documentclass{a}\n\\title{Old}\n\\input{chapters/c_"), F.col("doc_id").cast("string"), F.lit("}\n\\textbf中"))
    text = F.when(F.pmod("doc_id", F.lit(50)) == 0, root).otherwise(F.col("text"))
    rows = lifecycle.main_first(docs(spark, sf_dir).select("doc_id", text.alias("text")))
    changed = lifecycle.translated_root(F.col("text"), "Old", "New")
    return rows.select("doc_id", "priority", F.when(F.col("priority") == 0, changed).alias("root"), X.macro_before_han(F.col("text")).alias("macro_before_han"))


REGISTERED = (
    learned_terms, assembly_checks, legacy_chapters, book_outlines, dictionary_matches, folded_spellings, ledger_versions, scanned_files, written_translations, archive_members, report_document, answer_faults, conversion_faults, review_faults, json_type_faults, term_frequency, term_report, term_forms_top8, longest_match, term_conflicts, domain_filter, table_term_filter, content_tokens, coverage_audit, missing_pages, chapter_parts, chapter_ranges, block_packing,
    chunk_match_overlap, section_in_chunk, range_pages, neighbour_pages, contiguity_violations, body_bounds, metadata_heading, body_page_count, page_lines, page_index, image_refs, missing_refs, artifact_violations,
    control_chars, structural_diff, terminology_missing, candidate_upsert, approve_term, pending_chunks, latest_valid_attempt, jsonl_pages, arxiv_ids, ordered_assembly, command_set_diff, tex_escape,
    sanitized_candidates, chapter_violations, output_names, mask_counts, mask_roundtrip, translate_documents, prompt_rules, report_counters, chunk_index, convert_chunks, review_chunks,
    translation_warnings, recovered_chunks, document_report, completeness_report, unknown_pages, changed_manifests, main_files,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in REGISTERED}
