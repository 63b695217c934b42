"""The ledger of candidate terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.functions.text import fold_case, strip
from corpuskiln.sources import sinks, versions

# Fixed values.
LONGEST, NO_DOMAIN = 120, "unspecified"
KEY = ["source_key", "target", "domain_key"]
LEDGER = "source string, target string, domain string, reason string, status string, occurrences long, first_seen timestamp, last_seen timestamp"

#: Parts of a stored ledger; a batch rewrites only those that its keys fall into.
BUCKETS = 128


def sanitize(batch: DataFrame, domain: str | None = None) -> DataFrame:
    """Candidates stripped, with a domain, both sides filled and at most 120 characters long."""
    clean = {c: strip(F.coalesce(c, F.lit(""))) for c in ("source", "target", "domain", "reason")}
    out = batch.withColumns(clean).withColumn("domain", F.when(F.col("domain") == "", F.lit(domain or NO_DOMAIN)).otherwise(F.col("domain")))
    return out.where((F.col("source") != "") & (F.col("target") != "") & (F.length("source") <= LONGEST) & (F.length("target") <= LONGEST))


def counted(batch: DataFrame, *more: str) -> DataFrame:
    """Equal rows of a batch (in source, target, domain, reason and the columns ``more``) as one, with how many they are, ``n``, the first ``no`` and the last, ``last_no``. Each task counts before rows are moved."""
    return batch.groupBy("source", "target", "domain", "reason", *more).agg(F.count(F.lit(1)).alias("n"), F.min("no").alias("no"), F.max("no").alias("last_no"))


def keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("source_key", fold_case(F.col("source"))).withColumn("domain_key", fold_case(F.col("domain")))


def upsert(ledger: DataFrame, batch: DataFrame, now: Column) -> DataFrame:
    """``ledger`` with a batch of candidates counted in.

    ``batch`` has source, target, domain, reason and ``no``, its order. Equal keys (case aside in source and domain) are one
    entry: each row adds an occurrence, the last reason that is not empty stays, and the spelling of the first row
    names a new entry. Entries without new rows stay as they are. Rows of ``counted`` stand for as many as they count.
    """
    many = "n" in batch.columns
    order, last, reason = F.col("no"), F.col("last_no" if many else "no"), F.when(F.col("reason") != "", F.col("reason"))
    new = keyed(batch).groupBy(*KEY).agg(
        F.min_by(F.struct("source", "domain"), order).alias("named"), F.sum(F.col("n") if many else F.lit(1).cast("long")).alias("n"), F.max_by(reason, F.when(reason.isNotNull(), last)).alias("new_reason")
    )
    both = keyed(ledger).join(new, KEY, "full_outer")
    seen = F.col("n").isNotNull()
    return both.select(
        F.coalesce("source", "named.source").alias("source"),
        "target",
        F.coalesce("domain", "named.domain").alias("domain"),
        F.coalesce("new_reason", "reason", F.lit("")).alias("reason"),
        F.coalesce("status", F.lit("candidate")).alias("status"),
        (F.when(F.col("source").isNotNull(), F.coalesce("occurrences", F.lit(1))).otherwise(0) + F.coalesce("n", F.lit(0))).cast("long").alias("occurrences"),
        F.when(F.col("source").isNull(), now).otherwise(F.col("first_seen")).alias("first_seen"),
        F.when(seen, now).otherwise(F.col("last_seen")).alias("last_seen"),
    )


def bucket_of(rows: DataFrame, buckets: int = BUCKETS) -> Column:
    """The part of a stored ledger that a row with the columns ``KEY`` belongs to."""
    return (F.conv(F.substring(F.md5(F.concat_ws("\n", *KEY).cast("binary")), 1, 4), 16, 10).cast("int") % buckets).cast("int")


def upsert_stored(ledger: str, batch: DataFrame, now: Column, number: int, buckets: int = BUCKETS) -> list[int]:
    """The stored ledger at ``ledger`` with batch ``number`` counted in; returns the parts that were rewritten.

    Only parts with keys of the batch are read and written, to a folder of this run; the other parts stay where they are, and one pointer switches
    all at once. A batch that has been counted in is not counted again; an empty one writes nothing.
    """
    spark = batch.sparkSession
    known = versions.state(ledger)
    if known["batch"] is not None and known["batch"] >= number:
        return []
    marked = sinks.stored(keyed(batch).withColumn("bucket", bucket_of(batch, buckets)), "ledger-batch")
    touched = sorted(r["bucket"] for r in marked.select("bucket").distinct().collect())  # at most ``buckets``
    if not touched:
        return []
    old = [f"{ledger}/{known['folders'][str(b)]}" for b in touched if str(b) in known["folders"]]
    before = spark.read.schema(LEDGER).parquet(*old) if old else spark.createDataFrame([], LEDGER)
    after = upsert(before, marked.drop("source_key", "domain_key", "bucket"), now)
    run = versions.new_run(ledger, number)
    placed = keyed(after).withColumn("bucket", bucket_of(after, buckets)).drop("source_key", "domain_key")
    placed.repartition("bucket").write.partitionBy("bucket").parquet(f"{ledger}/{run}")
    versions.switch(ledger, {"version": known["version"] + 1, "batch": number, "folders": known["folders"] | {str(b): f"{run}/bucket={b}" for b in touched}})
    return touched


def read_stored(spark: SparkSession, ledger: str) -> DataFrame:
    """The stored ledger."""
    return versions.read(spark, ledger, LEDGER)
