"""Scans of texts, pages, dictionaries and nested JSON lines."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from functools import partial, reduce
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.functions.text import document_format
from corpuskiln.operators import scan
from corpuskiln.operators.glossary import TERM_SCHEMA
from corpuskiln.sources import sinks
from corpuskiln.sources.text_sink import opened

OCR_RESULT = "result struct<layoutParsingResults:array<struct<markdown:struct<text:string,images:map<string,string>>,outputImages:map<string,string>>>>"
CHUNK_INDEX = "version int, chunks array<struct<chunk_id:string,pages:array<int>,files:array<string>,characters:long,chapter_number:int,chapter_title:string,section_titles:array<string>>>"

LISTED = pa.schema([("path", pa.string()), ("root", pa.int32()), ("length", pa.int64()), ("folder", pa.bool_())])
#: Rows, and bytes of files, that a task passes on at once.
ROWS, TOGETHER = 10_000, 4 << 20


def read_texts(spark: SparkSession, *paths: str) -> DataFrame:
    """Whole Markdown and LaTeX files below ``paths``: path, format and text; line ends are line feeds."""
    rows = spark.read.option("recursiveFileLookup", True).format("binaryFile").load(list(paths))
    named = rows.withColumn("format", document_format(F.col("path"))).where("format is not null").dropDuplicates(["path"])
    text = F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), "\r\n?", "\n")
    return named.select("path", "format", text.alias("text"))


def _apart(paths: tuple[str, ...]) -> list[str]:
    """``paths`` without those that are equal to or below another one."""
    whole = sorted({p.rstrip("/") or "/" for p in paths}, key=len)
    return [p for i, p in enumerate(whole) if not any(p.startswith(q.rstrip("/") + "/") for q in whole[:i])]


def _prefixes(spark: SparkSession, roots: list[str]) -> list[str] | None:
    """What stands before a path of each root's file system in the paths that Spark gives; null if a root is of a file system that only Spark reads."""
    out = []
    for root in roots:
        if ":" not in root.split("/", 1)[0] and not spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:"):
            return None
        try:
            at = opened(root)[1]
        except (pa.ArrowException, OSError, ImportError):
            return None
        whole = unquote(root) if ":" in root.split("/", 1)[0] else f"file:{at}"
        if not whole.rstrip("/").endswith(at.rstrip("/")):
            return None
        before = whole.rstrip("/").removesuffix(at.rstrip("/"))
        out.append("file:" if before == "file://" else before)
    return out


def _below(batches: Iterator[pa.RecordBatch], roots: list[str], prefixes: list[str]) -> Iterator[pa.RecordBatch]:
    """Files and folders right below folders; names that Spark's scans pass over are left out."""
    for batch in batches:
        for path, root in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = opened(roots[root])[0].get_file_info(fs.FileSelector(path[len(prefixes[root]) :]))
            rows = [i for i in found if not (i.base_name[:1] == "." or i.base_name[:1] == "_" and "=" not in i.base_name or i.base_name.endswith("._COPYING_"))]
            for at in range(0, len(rows), ROWS):
                part = rows[at : at + ROWS]
                yield pa.RecordBatch.from_arrays([[prefixes[root] + i.path for i in part], [root] * len(part), [i.size for i in part], [not i.is_file for i in part]], schema=LISTED)


def _listed(spark: SparkSession, roots: list[str], prefixes: list[str]) -> DataFrame:
    """Every file below ``roots``: path, root (its number) and length. Folders are listed in tasks, one level after the other; the names of one folder are in one task."""
    kind = "path string, root int, length long, folder boolean"
    first = []
    for i, (root, prefix) in enumerate(zip(roots, prefixes)):
        system, at = opened(root)
        info = system.get_file_info(at)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(root)
        first.append((prefix + posixpath.normpath(at), i, info.size, not info.is_file))
    rows, found = spark.createDataFrame(first, kind), []
    while True:
        found.append(rows.where("not folder").drop("folder"))
        folders = rows.where("folder").select("path", "root")
        if not (n := folders.count()):
            break
        dealt = folders.repartition(min(n, int(spark.conf.get("spark.sql.shuffle.partitions"))))
        rows = sinks.stored(dealt.mapInArrow(partial(_below, roots=roots, prefixes=prefixes), kind), "listed")
    out = reduce(DataFrame.unionByName, found)
    return out.dropDuplicates(["path"]) if len(roots) > 1 else out


def _contents(batches: Iterator[pa.RecordBatch], roots: list[str], prefixes: list[str]) -> Iterator[pa.RecordBatch]:
    """Numbered files (file_no, path, root) with their bytes."""
    systems = [opened(root)[0] for root in roots]
    for batch in batches:
        done, held, size = 0, [], 0
        for at, (path, root) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()), 1):
            with systems[root].open_input_stream(path[len(prefixes[root]) :], compression=None) as file:
                held.append(file.read())
            size += len(held[-1])
            if size >= TOGETHER or at == batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(held)), batch.column(1).slice(done, len(held)), pa.array(held, pa.binary())], ["file_no", "path", "content"])
                done, held, size = at, [], 0


def scan_texts(spark: SparkSession, *paths: str, empty: bool = False, as_is: bool = False) -> DataFrame:
    """Every file below ``paths`` in the order of its path, once: file_no, path, format, text and error.

    A file of no known format, or whose bytes are no UTF-8, keeps its row with an error and no text, and no byte is replaced; line ends are line feeds and a byte order mark is passed over, unless
    ``as_is``. A file of no bytes has no row unless ``empty``. Folders are listed, and files read, in tasks, so the driver holds no name of a file and no content is moved; patterns, and file systems that only Spark opens, are
    listed by Spark on the driver, and empty files are then passed over in any case.
    """
    plain = not any(c in p for p in paths for c in "*?[{\\")
    roots = _apart(paths) if plain else list(paths)
    prefixes = _prefixes(spark, roots) if plain else None
    if prefixes is None:
        rows = spark.read.option("recursiveFileLookup", True).format("binaryFile").load(roots)
        if len(roots) > 1 or not plain:  # else no file is listed twice, and contents need not be moved to tell
            rows = rows.dropDuplicates(["path"])
        rows = rows.select("path", "content").join(scan.number_rows(rows.select("path"), "path", name="file_no"), "path")
    else:
        listed = _listed(spark, roots, prefixes)
        numbers = scan.number_rows(listed if empty else listed.where("length > 0"), "path", name="file_no").select("file_no", "path", "root")
        dealt = numbers.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")  # names only
        rows = dealt.mapInArrow(partial(_contents, roots=roots, prefixes=prefixes), "file_no long, path string, content binary")
    raw = F.col("content").cast("string")
    kind = document_format(F.col("path"))
    error = F.when(kind.isNull(), "no known format").when(~F.is_valid_utf8(raw), "no UTF-8")
    text = raw if as_is else F.regexp_replace(F.regexp_replace(raw, "^\ufeff", ""), "\r\n?", "\n")
    return rows.select("file_no", "path", kind.alias("format"), F.when(error.isNull(), text).alias("text"), error.alias("error"))


def read_pages(spark: SparkSession, path: str, book: str = "book") -> DataFrame:
    """Scanned pages ``doc_N.md`` of a folder: book, page_no, file, text and chars."""
    rows = read_texts(spark, path).withColumn("file", F.regexp_extract("path", r"([^/]+)\z", 1))
    number = F.regexp_extract("file", r"(?i)^doc_(\d+)\.md\z", 1)
    return rows.where(number != "").select(F.lit(book).alias("book"), number.cast("int").alias("page_no"), "file", "text", F.length("text").alias("chars"))


def missing_pages(spark: SparkSession, pages: DataFrame, page_count: int) -> DataFrame:
    """Numbers from 0 to ``page_count - 1`` that no page has."""
    return spark.range(page_count).select(F.col("id").cast("int").alias("page_no")).join(pages.select("page_no"), "page_no", "left_anti")


def read_glossary(spark: SparkSession, path: str) -> DataFrame:
    """Terms of a glossary file in their order, as ``TERM_SCHEMA`` with term_no."""
    fields = ", ".join(f"{n}: {k}" for n, k in (c.split(" ", 1) for c in TERM_SCHEMA.split(", ")))
    rows = spark.read.schema(f"version int, terms array<struct<{fields}>>").option("multiLine", True).option("mode", "FAILFAST").json(path)
    return rows.select(F.posexplode("terms").alias("term_no", "t")).select(F.col("term_no").cast("long"), "t.*")


def read_term_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Lines of term tables in order: table_no, line_no and value, for ``parse_term_table``."""
    tables = F.array_position(F.array(*(F.lit(p.rpartition("/")[2]) for p in paths)), F.regexp_extract("path", r"([^/]+)\z", 1)).cast("int") - 1
    rows = spark.read.format("binaryFile").load(list(paths)).select(tables.alias("table_no"), F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), "^\ufeff", "").alias("t"))
    return rows.select("table_no", F.posexplode(F.split("t", r"\R")).alias("line_no", "value"))


def read_chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """Chunks of an index file, one row each."""
    return spark.read.schema(CHUNK_INDEX).option("multiLine", True).json(path).select(F.explode("chunks").alias("c")).select("c.*")


def ocr_pages(lines: DataFrame) -> DataFrame:
    """Pages of nested result lines (line_no, value), numbered through all lines, of which ``line_no`` is unique: page_no, text, images, output_images."""
    parsed = lines.where(F.trim("value") != "").select("line_no", F.from_json("value", OCR_RESULT).alias("r"))
    held = parsed.select("line_no", F.coalesce(F.size("r.result.layoutParsingResults"), F.lit(0)).cast("long").alias("n")).where("n > 0")
    before = scan.running(held, [], ["line_no"], {"before": scan.Fold("sum", F.col("n"), -1)}).select("line_no", F.coalesce("before", F.lit(0)).alias("before"))
    rows = parsed.select("line_no", F.posexplode("r.result.layoutParsingResults").alias("pos", "p")).join(before, "line_no")
    return rows.select("line_no", "pos", F.coalesce("p.markdown.text", F.lit("")).alias("text"), F.col("p.markdown.images").alias("images"), F.col("p.outputImages").alias("output_images"), (F.col("before") + F.col("pos")).alias("page_no"))
