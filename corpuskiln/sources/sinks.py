"""Writers of results."""

from __future__ import annotations

import tempfile
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_dir: list[str] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that driver and executors share; a temporary one in local tests only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not (spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not root and not _local_dir:
        _local_dir.append("file://" + tempfile.mkdtemp(prefix="corpuskiln-"))
    return f"{root or _local_dir[0]}/corpuskiln/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to the folder that driver and executors share and read again, so that they are made once; a temporary folder in local tests only."""
    spark = rows.sparkSession
    path = new_folder(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def write_json(rows: DataFrame, path: str, overwrite: bool = False) -> None:
    """JSON lines; Spark's commit makes them visible as a whole (K1, K2, K4)."""
    rows.write.mode("overwrite" if overwrite else "errorifexists").json(path)


def write_texts(rows: DataFrame, path: str, text: str = "text", overwrite: bool = False) -> None:
    """One text per row with its name, refusing a folder that exists unless told (K3)."""
    rows.select("path", F.col(text).alias("text")).write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def write_lines(rows: DataFrame, path: str, overwrite: bool = False) -> None:
    """The lines of an ordered, bounded report as one text file (K5, K9)."""
    rows.coalesce(1).write.mode("overwrite" if overwrite else "errorifexists").text(path)


def run_dir(root: str, name: str, now: datetime | None = None) -> str:
    """A folder name of its own for one run."""
    return f"{root}/runs/{name}-{(now or datetime.now(timezone.utc)).strftime('%Y%m%dT%H%M%S%fZ')}"
