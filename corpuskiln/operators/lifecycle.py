"""Which work is pending, and which attempt counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.functions.text import resolved


def pending(work: DataFrame, done: DataFrame, keys: list[str], valid: Column | None = None) -> DataFrame:
    """Work without a valid result."""
    return work.join((done if valid is None else done.where(valid)).select(*keys), keys, "left_anti")


def latest_valid(attempts: DataFrame, keys: list[str], newest: list[str], valid: Column) -> DataFrame:
    """The newest valid attempt of each item; items without one are left out."""
    order = Window.partitionBy(*keys).orderBy(*(F.col(c).desc() for c in newest))
    return attempts.where(valid).withColumn("attempt_no", F.row_number().over(order)).where("attempt_no = 1").drop("attempt_no")


def missing_references(pages: DataFrame, files: DataFrame, refs: str = "refs") -> DataFrame:
    """Distinct local references that no file answers or that leave the folder; ``..`` within it is followed."""
    local = pages.select(F.explode(refs).alias("path")).where(~F.col("path").startswith("http://") & ~F.col("path").startswith("https://")).distinct()
    there = files.select(F.col("path").alias("plain"), F.lit(True).alias("there")).distinct()
    found = local.withColumn("plain", resolved(F.col("path"))).join(there, "plain", "left")
    return found.where(F.col("there").isNull()).select("path")


def unknown_pages(chunks: DataFrame, pages: DataFrame, keys: list[str]) -> DataFrame:
    """Page numbers of chunks that are no pages."""
    return chunks.select(*keys, F.explode("pages").alias("page_no")).join(pages.select(*keys, "page_no"), [*keys, "page_no"], "left_anti")


def main_first(docs: DataFrame, text: str = "text") -> DataFrame:
    """TeX files with ``priority`` 0 where they declare the document's class, 1 elsewhere: roots are worked on first."""
    return docs.withColumn("priority", F.when(F.regexp_like(F.coalesce(F.col(text), F.lit("")), F.lit(r"\\documentclass\b")), 0).otherwise(1))


def translated_root(text: Column, title: str, new_title: str, suffix: str = "-zh") -> Column:
    """A root file that includes the translated chapters, under another title."""
    titled = F.replace(text, F.lit(f"\\title{{{title}}}"), F.lit(f"\\title{{{new_title}}}"))
    return F.regexp_replace(titled, r"\\input\{(chapters/[^{}]+)\}", rf"\\input{{$1{suffix}}}")
