"""Versions of a result: written to a folder of their own, then made current by one pointer file."""

from __future__ import annotations

import json
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from corpuskiln.sources.text_sink import opened

POINTER = "_current"


def state(root: str) -> dict:
    """What the pointer of ``root`` says: the number of the version, its batch, and its folders by part; of none, version 0 without folders."""
    system, at = opened(root)
    if system.get_file_info(f"{at}/{POINTER}").type == fs.FileType.NotFound:
        return {"version": 0, "batch": None, "folders": {}}
    with system.open_input_stream(f"{at}/{POINTER}", compression=None) as f:
        return json.loads(f.read())


def switch(root: str, now: dict) -> None:
    """Make ``now`` current: the pointer is written aside and moved over the old one, so a reader sees one or the other."""
    system, at = opened(root)
    system.create_dir(at, recursive=True)
    aside = f"{at}/_next-{uuid.uuid4().hex}"
    with system.open_output_stream(aside, compression=None) as f:
        f.write(json.dumps(now).encode())
    system.move(aside, f"{at}/{POINTER}")


def new_run(root: str, batch: int) -> str:
    """A folder of its own for one run of a batch, below ``root``."""
    return f"runs/{batch:020d}-{uuid.uuid4().hex}"


def publish(rows: DataFrame, root: str, batch: int) -> bool:
    """``rows`` as the version of ``batch``; false, and nothing is written, if that batch or a later one is current.

    A run that breaks off before the switch leaves the version before it current and a folder that nothing names.
    """
    before = state(root)
    if before["batch"] is not None and before["batch"] >= batch:
        return False
    run = new_run(root, batch)
    rows.write.parquet(f"{root}/{run}")
    switch(root, {"version": before["version"] + 1, "batch": batch, "folders": {"all": run}})
    return True


def read(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The current version; no rows if there is none. Folders without a file are passed over."""
    folders = [f"{root}/{f}" for f in state(root)["folders"].values()]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
