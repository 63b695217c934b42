"""Term dictionaries: active terms, conflicts, term tables, approval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.functions.text import drop_class_marker, fold_case, strip, term_key

# Fixed values.
ANY_DOMAIN = ("*", "general")
LONGEST_TABLE_TERM, SHORTEST_PHRASE, SHORTEST_WORD = 120, 4, 7

TERM_SCHEMA = "source string, target string, domains array<string>, aliases array<string>, status string, source_reference string, note string"


def domain_allows(domains: Column, domain: str | tuple[str, ...] | None) -> Column:
    """Whether a term is active: its domains have a wildcard or the active one, or one of several (F2)."""
    active = (domain,) if isinstance(domain, str) else domain or ()
    known = [*ANY_DOMAIN, *(d.casefold() for d in active)]
    return F.arrays_overlap(F.transform(domains, lambda d: fold_case(d)), F.array(*map(F.lit, known)))


def active_terms(glossary: DataFrame, domain: str | tuple[str, ...] | None = None) -> DataFrame:
    """Approved terms of the active domain with missing values filled; ``term_no`` keeps their order.

    ``glossary`` has ``term_no`` and the columns of ``TERM_SCHEMA``. A term without source or target has ``error`` set.
    """
    filled = glossary.where(F.coalesce("status", F.lit("approved")) == "approved").select(
        "term_no",
        strip(F.coalesce("source", F.lit(""))).alias("source"),
        strip(F.coalesce("target", F.lit(""))).alias("target"),
        F.transform(F.coalesce("domains", F.array(F.lit("*"))), lambda d: fold_case(d)).alias("domains"),
        F.filter(F.transform(F.coalesce("aliases", F.expr("cast(array() as array<string>)")), lambda a: strip(a)), lambda a: a != "").alias("aliases"),
        F.coalesce("note", F.lit("")).alias("note"),
    )
    error = F.when((F.col("source") == "") | (F.col("target") == ""), F.lit("source or target is missing"))
    return filled.withColumn("error", error).where(domain_allows(F.col("domains"), domain))


def phrases(terms: DataFrame) -> DataFrame:
    """One row per phrase of a term, its source first, then its aliases: term columns, phrase, phrase_no, key."""
    both = F.concat(F.array("source"), F.coalesce("aliases", F.expr("cast(array() as array<string>)")))
    out = terms.select("*", F.posexplode(both).alias("phrase_no", "phrase"))
    return out.withColumn("key", term_key(F.col("phrase"))).where("key <> ''")


def conflicts(terms: DataFrame) -> DataFrame:
    """Phrases that active terms give different targets: key, n_targets, least and largest target."""
    found = phrases(terms).groupBy("key").agg(F.count_distinct("target").alias("n_targets"), F.min("target").alias("first_target"), F.max("target").alias("last_target"))
    return found.where("n_targets > 1")


def usable_table_term(source: Column, single_words: bool = False) -> Column:
    """Whether a term of a table is safe to use: several words, or, if allowed, one long capitalised word."""
    several = F.regexp_like(source, F.lit(r"(?U)[\s/-]"))
    one = F.lit(single_words) & (F.length(source) >= SHORTEST_WORD) & (F.upper(F.substring(source, 1, 1)) == F.substring(source, 1, 1)) & (F.lower(F.substring(source, 1, 1)) != F.substring(source, 1, 1))
    plain = (F.length(source) <= LONGEST_TABLE_TERM) & ~F.regexp_like(source, F.lit(r"[{}\\$]"))
    return plain & F.when(several, F.length(source) >= SHORTEST_PHRASE).otherwise(one)


def parse_term_table(rows: DataFrame) -> DataFrame:
    """Term rows of tab-separated lines: ``rows`` has table_no, line_no and value; gives table_no, line_no, source, target."""
    header = (F.col("line_no") == 0) & fold_case(F.col("value")).startswith("english\t")
    cells = F.split("value", "\t", 2)
    target = F.regexp_replace(cells[1], r"(?U)\s+", "")
    out = rows.where(F.col("value").contains("\t") & ~header).select("table_no", "line_no", drop_class_marker(cells[0]).alias("source"), target.alias("target"))
    return out.where((F.col("source") != "") & (F.col("target") != "") & ~F.regexp_like("source", F.lit(r"[\x{4e00}-\x{9fff}]")))


def add_table_terms(terms: DataFrame, table: DataFrame, single_words: bool = False, note: str = "from a term table; use by context") -> DataFrame:
    """``terms`` and the usable rows of a term table whose phrase no term has; of equal phrases the first row counts."""
    usable = table.where(usable_table_term(F.col("source"), single_words)).withColumn("key", term_key(F.col("source")))
    new = usable.join(phrases(terms).select("key").distinct(), "key", "left_anti")
    first = F.row_number().over(Window.partitionBy("key").orderBy("table_no", "line_no"))
    new = new.withColumn("no", first).where("no = 1")
    shaped = new.select(
        (F.lit(1 << 40) + F.col("table_no").cast("long") * (1 << 32) + F.col("line_no")).alias("term_no"),
        "source",
        "target",
        F.array(F.lit("*")).alias("domains"),
        F.expr("cast(array() as array<string>)").alias("aliases"),
        F.lit(note).alias("note"),
        F.lit(None).cast("string").alias("error"),
    )
    return terms.withColumn("term_no", F.col("term_no").cast("long")).unionByName(shaped)


def approve_term(glossary: DataFrame, source: str, target: str, domain: str, reference: str) -> DataFrame:
    """``glossary`` with a term approved: the first term of that source and domain is updated, else one is added."""
    spark = glossary.sparkSession
    same = (fold_case(F.col("source")) == source.casefold()) & F.exists(F.coalesce("domains", F.expr("cast(array() as array<string>)")), lambda d: fold_case(d) == domain.casefold())
    first = glossary.where(same).agg(F.min("term_no").alias("hit"), F.count(F.lit(1)).alias("n"))
    last = glossary.agg(F.coalesce(F.max("term_no"), F.lit(-1)).alias("last"))
    marked = glossary.crossJoin(F.broadcast(first.select("hit")))  # one row
    here = F.col("term_no").eqNullSafe(F.col("hit"))
    set_ = lambda name, value: F.when(here, F.lit(value)).otherwise(F.col(name)).alias(name)
    updated = marked.select("term_no", "source", set_("target", target), "domains", "aliases", set_("status", "approved"), set_("source_reference", reference), "note")
    added = spark.createDataFrame([(source, target, [domain], [], "approved", reference, "")], TERM_SCHEMA).crossJoin(F.broadcast(first.crossJoin(last))).where("n = 0")
    return updated.unionByName(added.select((F.col("last") + 1).alias("term_no"), "source", "target", "domains", "aliases", "status", "source_reference", "note"))
