"""Members of tar archives as rows, read as streams; names checked by their components."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.functions.text import resolved
from corpuskiln.sources.text_sink import component_error, opened

MEMBER = "archive string, member_no long, name string, size long, content binary, error string"
#: Bytes of members that a task passes on at once.
TOGETHER = 8 << 20


def _members(path: str) -> Iterator[tuple]:
    """Members in order, plain or gzip; a member that may not be taken has an error and no content, and so has what is left of a broken archive."""
    system, at = opened(path)
    no = 0
    try:
        with system.open_input_stream(at, compression=None) as raw, tarfile.open(fileobj=raw, mode="r|*") as archive:
            for no, member in enumerate(archive):
                error = component_error(member.name) or (None if member.isfile() or member.isdir() else "no plain file")
                if member.isdir():
                    continue
                content = archive.extractfile(member).read() if error is None else None
                yield path, no, member.name, member.size, content, error
    except (tarfile.TarError, EOFError, OSError) as e:
        yield path, no, None, None, None, f"broken archive: {type(e).__name__}"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per member of the archives below ``path``: archive, member_no, name (resolved), size, content and error.

    Archives are opened in tasks and read as streams, a member at a time. A name is refused with an error row if it is absolute or leaves the folder, also for a
    while, whatever its first signs; links and devices are refused too. Names with dots that stay within are resolved.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        for batch in batches:
            for file in batch["path"]:
                for row in _members(file):
                    rows.append(row)
                    if sum(r[3] or 0 for r in rows) > TOGETHER or len(rows) >= 1000:
                        yield pd.DataFrame(rows, columns=["archive", "member_no", "name", "size", "content", "error"])
                        rows = []
        if rows:
            yield pd.DataFrame(rows, columns=["archive", "member_no", "name", "size", "content", "error"])

    files = spark.read.option("recursiveFileLookup", True).format("binaryFile").load(path).select("path")
    rows = files.repartition("path").mapInPandas(run, MEMBER)  # contents are not read by the listing
    return rows.withColumn("name", F.when(F.col("error").isNull(), resolved(F.col("name"))).otherwise(F.col("name")))


def pack(members: DataFrame, by: str, gzip: bool = True) -> DataFrame:
    """Rows of ``by``, name and content packed to one archive per ``by``: by and content; a group must fit a task."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w:gz" if gzip else "w") as archive:
            for name, content in zip(pdf["name"], pdf["content"], strict=True):
                info = tarfile.TarInfo(name)
                info.size = len(content)
                archive.addfile(info, io.BytesIO(content))
        return pd.DataFrame({by: [pdf[by].iloc[0]], "content": [out.getvalue()]})

    return members.select(by, "name", "content").groupBy(by).applyInPandas(run, f"{by} {dict(members.dtypes)[by]}, content binary")
