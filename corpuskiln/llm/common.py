"""Helpers that several training-data operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the only separators of words in the whole-text operators.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_local_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a temporary one in local tests only."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _local_dir:
        _local_dir.append("file://" + tempfile.mkdtemp(prefix="corpuskiln-"))
    return _local_dir[0]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/corpuskiln/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage by a table in the shared folder; a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words, null counting as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN)).cast("long")


def lookup_by_hot_key(big: DataFrame, small: DataFrame, key: str, total: int, floor: int = 1000) -> DataFrame:
    """Left join ``big`` with ``small``, which has one row per ``key`` and how many rows of ``big`` share it in column ``n``.

    Keys with more than ``total / 1000`` rows are under a thousand by the pigeonhole principle, so their
    lookup rows are broadcast and their rows of ``big`` are not moved; all others go by an ordinary join,
    where no key holds more than a thousandth of the rows.
    """
    limit = max(floor, total // 1000)
    hot = F.broadcast(small.where(F.col("n") > limit))
    moved = big.join(F.broadcast(small.where(F.col("n") > limit).select(key)), key, "left_anti")
    cold = moved.join(small.where(F.col("n") <= limit), key, "left")
    return big.join(hot, key).select(cold.columns).unionByName(cold)


#: A bitmap of keys has two to the power of so many bits in words of 64: at most half a million rows of 16 bytes, whatever the input.
BITMAP_BITS = 25


def _place(key: list[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(1 << BITMAP_BITS))


def key_bitmap(keys: DataFrame, *key: str) -> DataFrame:
    """A bitmap of fixed size as rows (word, mask), in which the hash of each row of ``keys`` sets a bit."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int"))
    placed = keys.select(_place(list(key)).alias("place"))
    return placed.groupBy(F.floor(F.col("place") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("mask"))


def with_hit(rows: DataFrame, bits: DataFrame, *key: str) -> DataFrame:
    """``rows`` with ``hit``: false for rows that no key of the bitmap ``bits`` can equal; they need not be moved to meet the keys.

    The bitmap is broadcast, as its size is fixed; where keys outgrow it, more rows are hit, and all of them at worst.
    """
    at = _place(list(key))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))
    joined = rows.withColumn("word", F.floor(at / 64).cast("int")).join(F.broadcast(bits), "word", "left")
    return joined.withColumn("hit", F.coalesce(F.col("mask").bitwiseAND(bit) != 0, F.lit(False))).drop("word", "mask")


def keep_rows(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``marks`` (id, digest, keep) lets stay.

    ``id`` is ``row_id`` and ``digest`` the SHA-256 of the text, in bytes. Rows without a mark stay; of those with one, which are equal in
    doc_id and text, one stays if ``keep`` is true, else none. Only rows that a bitmap of the marks hits are moved.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), row_id().alias("id"), F.unhex(F.sha2(text, 256)).alias("digest"))
    marked = with_hit(packed, key_bitmap(marks, "id", "digest"), "id", "digest")
    steady = [F.col("row").getField(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString()]
    met = marked.where("hit").join(marks, ["id", "digest"], "left").where("keep is null or keep")
    alone = met.where("keep is null").select("row")  # hit by chance
    first = met.where("keep").groupBy("id", "digest").agg(F.min_by("row", F.xxhash64(*steady)).alias("row")).select("row")
    return marked.where("not hit").select("row").unionByName(alone).unionByName(first).select("row.*")


def row_id() -> Column:
    """doc_id as a string that tells null from all others."""
    return F.coalesce(F.concat(F.lit("d"), F.col("doc_id").cast("string")), F.lit("-"))
