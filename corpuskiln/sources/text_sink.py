"""A sink of one file per row, as a Python data source: staged by tasks, moved by tasks to where they are seen (K3)."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:/") else f"file://{posixpath.abspath(path)}")


def component_error(name: str) -> str | None:
    """Why a relative name may not be used below a folder, null if it may; told by its components, not by its first signs."""
    if not name or name.startswith("/"):
        return "absolute or empty"
    depth = 0
    for part in name.split("/"):
        depth += -1 if part == ".." else part not in ("", ".")
        if depth < 0:
            return "leaves the folder"
    return None if depth else "names the folder itself"


@dataclass
class Staged(WriterCommitMessage):
    folder: str


class TextFiles(DataSource):
    """Format ``text_files``: rows of ``name`` and ``content`` (bytes) become files below the folder ``staging`` of ``path``, for ``write_files`` to move."""

    @classmethod
    def name(cls) -> str:
        return "text_files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:  # noqa: ANN001
        return TextFilesWriter(self.options["path"], overwrite, self.options["staging"])


class TextFilesWriter(DataSourceWriter):
    """Tasks write below a staging folder, an attempt of a task to a folder of its own, so a task that fails or runs twice leaves nothing that counts.

    A name that exists is refused, in the tasks, unless the mode is overwrite; so is one that leaves the folder. The commit drops the folders of attempts
    that did not succeed; an abort drops the staging folder, whose name scans pass over in any case.
    """

    def __init__(self, path: str, overwrite: bool, staging: str) -> None:
        self.path, self.overwrite, self.staging = path, overwrite, staging

    def write(self, rows: Iterator[Row]) -> Staged:
        system, root = opened(self.path)
        own = f"{root}/{self.staging}/{uuid.uuid4().hex}"
        system.create_dir(f"{root}/{self.staging}", recursive=True)
        for row in rows:
            if system.get_file_info(f"{root}/{self.staging}").type == fs.FileType.NotFound:
                raise RuntimeError("the write was aborted")  # a task that is stopped late must not begin the folder anew
            if error := component_error(row["name"] or ""):
                raise ValueError(f"{row['name']}: {error}")
            if not self.overwrite and system.get_file_info(f"{root}/{row['name']}").type != fs.FileType.NotFound:
                raise FileExistsError(f"{self.path}/{row['name']}")
            to = f"{own}/{row['name']}"
            system.create_dir(posixpath.dirname(to), recursive=True)
            with system.open_output_stream(to, compression=None) as out:  # the bytes as they are, whatever the suffix
                out.write(bytes(row["content"] or b""))
        return Staged(own)

    def commit(self, messages: list[Staged | None]) -> None:
        system, root = opened(self.path)
        good = {posixpath.basename(m.folder) for m in messages if m}
        for info in system.get_file_info(fs.FileSelector(f"{root}/{self.staging}", allow_not_found=True)):
            if info.base_name not in good:
                system.delete_dir(info.path)

    def abort(self, messages: list[Staged | None]) -> None:
        dropped(self.path, self.staging)


def dropped(path: str, staging: str) -> None:
    system, root = opened(path)
    if system.get_file_info(f"{root}/{staging}").type != fs.FileType.NotFound:
        system.delete_dir(f"{root}/{staging}")


def _moved(batches: Iterator[pa.RecordBatch], path: str, staging: str) -> Iterator[pa.RecordBatch]:
    """Moves the files of attempts (their folders' names) below ``path``; a task that runs again moves those that are left."""
    system, root = opened(path)
    made: set[str] = set()
    for batch in batches:
        moved = 0
        for attempt in batch.column(0).to_pylist():
            folder = f"{root}/{staging}/{attempt}"
            for info in system.get_file_info(fs.FileSelector(folder, allow_not_found=True, recursive=True)):
                if not info.is_file:
                    continue
                to = f"{root}/{posixpath.relpath(info.path, folder)}"
                if posixpath.dirname(to) not in made:
                    system.create_dir(posixpath.dirname(to), recursive=True)
                    made.add(posixpath.dirname(to))
                try:
                    system.move(info.path, to)
                except FileNotFoundError:
                    if system.get_file_info(to).type == fs.FileType.NotFound:
                        raise
                moved += 1
        yield pa.RecordBatch.from_pydict({"moved": [moved]}, pa.schema([("moved", pa.int64())]))


def write_files(rows: DataFrame, path: str, overwrite: bool = False) -> None:
    """``rows`` of name and text (or content, in bytes) as files below ``path``; a null text is an empty file (K3).

    The driver holds a name for each task, none for a file.
    """
    spark: SparkSession = rows.sparkSession
    spark.dataSource.register(TextFiles)
    content = F.col("content") if "content" in rows.columns else F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    staging = f"_staging-{uuid.uuid4().hex}"
    rows.select("name", content.alias("content")).write.format("text_files").mode("overwrite" if overwrite else "append").option("path", path).option("staging", staging).save()
    try:
        system, root = opened(path)
        attempts = [(info.base_name,) for info in system.get_file_info(fs.FileSelector(f"{root}/{staging}", allow_not_found=True))]
        if attempts:
            named = spark.createDataFrame(attempts, "attempt string").repartition(min(len(attempts), int(spark.conf.get("spark.sql.shuffle.partitions"))))
            named.mapInArrow(partial(_moved, path=path, staging=staging), "moved long").agg(F.sum("moved")).collect()
    finally:
        dropped(path, staging)
