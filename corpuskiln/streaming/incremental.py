"""Incremental runs: new documents of a folder are matched once and counted with a checkpoint (J9 as a stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpuskiln.functions.text import find_all, fold_signs, squeeze
from corpuskiln.operators.matching import alternation
from corpuskiln.sources import versions


def stream_documents(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """A stream of ``doc_id``, ``text`` rows from Parquet files that appear in ``path``."""
    return spark.readStream.schema("doc_id long, text string").option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def term_counts(docs: DataFrame, keys: list[str]) -> DataFrame:
    """Running occurrences of the phrases ``keys`` (lower case, single spaces, none overlapping itself)."""
    hits = docs.select(F.explode(find_all(F.col("text"), alternation(keys))).alias("m"))
    return hits.groupBy(fold_signs(squeeze(F.col("m.text"))).alias("key")).agg(F.count(F.lit(1)).alias("occurrences"))


def run_counts(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there, then end; each batch gives a new version of the totals in ``path``, which ``read_counts`` reads.

    A batch that is run again changes nothing, and one that breaks off leaves the version before it current.
    """

    def write(batch: DataFrame, number: int) -> None:
        versions.publish(batch, path, number)

    return counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """The totals of the last batch that was finished."""
    return versions.read(spark, path, "key string, occurrences long")
