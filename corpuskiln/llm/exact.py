"""Exact dedup with a heavy-hitter split, in DataFrame and SQL operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.llm.common import keep_rows, materialize, row_id

#: Digests that the frequent-items sketch may report, and so the most rows that are ever broadcast.
HEAVY_ITEMS = 256
#: Counters of the sketch: a digest with more than 1/750 of the rows is never missed.
SKETCH_ITEMS = 1024


def normalised(text: Column) -> Column:
    """No change; null counts as empty."""
    return F.coalesce(text, F.lit(""))


def duplicate_groups(docs: DataFrame, heavy_items: int = HEAVY_ITEMS, sketch_items: int = SKETCH_ITEMS) -> DataFrame:
    """Columns doc_id, digest (hex SHA-256), keep_id and group_size, one row per row of ``docs`` (doc_id, text).

    ``keep_id`` is the largest doc_id among equal texts (null only if all of them are null); group_size counts rows, repeated
    ones too, each of which is the row that stays if it has keep_id. A frequent-items sketch (a Misra-Gries summary, ``approx_top_k``) proposes digests; their exact counts and winners,
    at most ``heavy_items`` rows, are broadcast, so that the rows of large groups are not moved. All other digests are
    shuffled, where no group has more than a small share of the rows. Empty and very long texts are texts as any other.
    """
    rows = materialize(docs.select("doc_id", F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest")), "digests")
    sketch = rows.agg(F.expr(f"approx_top_k(hex(digest), {heavy_items}, {sketch_items})").alias("top"))
    proposed = sketch.select(F.explode("top").alias("x")).where("x.count > 1").select(F.unhex("x.item").alias("digest"))
    verified = rows.join(F.broadcast(proposed), "digest", "left_semi").groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    winners = materialize(verified.where("group_size > 1").coalesce(1), "winners")
    hot = rows.join(F.broadcast(winners), "digest").select("doc_id", "digest", "keep_id", "group_size")
    same = Window.partitionBy("digest")
    rest = rows.join(F.broadcast(winners), "digest", "left_anti")
    cold = rest.select("doc_id", "digest", F.max("doc_id").over(same).alias("keep_id"), F.count(F.lit(1)).over(same).alias("group_size"))
    return hot.unionByName(cold).withColumn("digest", F.lower(F.hex("digest")))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text no row with a larger doc_id repeats, with all columns, which may have any names.

    Of rows equal in doc_id and text one stays; rows without doc_id go if their text has one, and are equal if their texts are. Only
    rows that go, or that are repeated, are moved.
    """
    same = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    marks = duplicate_groups(docs).select(row_id().alias("id"), F.unhex("digest").alias("digest"), same.alias("keep"), "group_size").where("group_size > 1")
    marks = marks.groupBy("id", "digest").agg(F.first("keep").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1 or not keep")
    return keep_rows(docs, materialize(marks.select("id", "digest", "keep"), "marks"))
