"""WARC archives: written by Spark's writers, read back by record length, joined into transactions."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.llm.common import materialize, new_path

CRLF = "\r\n"
#: Bytes of payload that a file of the archive is planned to hold; none holds more than ``SPREAD`` times that, or one record.
FILE_BYTES = 32 << 20
SPREAD = 16
RECORDS = "record_id string, record_type string, concurrent_to string, refers_to string, target_uri string, payload_digest string, payload_bytes long, fields string, payload binary, error string"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of SHA-1: 40 hex digits are four groups of 40 bits, eight base-32 digits each."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*groups)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def numbered(pages: DataFrame) -> DataFrame:
    """Adds ``part`` to ``pages`` (page_id, url, payload): null where page_id is one row's alone, else what tells the row from others.

    It is made of url and payload, and of a number among equal rows; null ids have one always.
    Only rows of repeated or null ids are moved.
    """
    pages = pages.select("page_id", "url", "payload")
    ids = materialize(pages.groupBy("page_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or page_id is null").select(F.col("page_id").alias("again")), "repeated-ids")
    if ids.isEmpty():
        return pages.withColumn("part", F.lit(None).cast("string"))
    same = F.col("page_id").eqNullSafe(F.col("again"))
    equal = pages.join(ids, same, "left_semi").groupBy("page_id", "url", "payload").agg(F.count(F.lit(1)).alias("n"))
    no = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))
    mark = F.sha1(F.concat(F.coalesce(F.concat(F.lit("u"), "url"), F.lit("")), F.lit("\x00"), F.sha2("payload", 256)))
    marked = equal.select("page_id", "url", "payload", mark.alias("mark"), no.alias("no")).withColumn("part", F.concat_ws("-", "mark", F.col("no").cast("string")))
    return pages.join(ids, same, "left_anti").withColumn("part", F.lit(None).cast("string")).unionByName(marked.drop("mark", "no"))


def classify(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Adds payload_bytes, payload_digest, record_type, refers_to and refers_part to ``pages`` (page_id, url, payload, and part if ids repeat).

    Of records with equal payloads of ``min_bytes`` or more, those with the smallest page_id (null is the largest) are responses and the
    others revisit the first of them; all smaller payloads are responses.
    """
    if "part" not in pages.columns:
        pages = pages.withColumn("part", F.lit(None).cast("string"))
    marked = pages.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "sha": F.unhex(F.sha2("payload", 256))})
    least = F.min(F.struct(F.col("page_id").isNull(), "page_id", "part"))
    counted = marked.where(F.col("payload_bytes") >= min_bytes).groupBy("sha").agg(least.alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sha", F.col("least.page_id").alias("first"), F.col("least.part").alias("first_part"))
    # only digests and ids meet here; payloads join the few pages that revisit another
    lost = marked.select("page_id", "sha").join(counted, "sha").where("first is not null and (page_id > first or page_id is null)")
    lost = materialize(lost.select(F.col("page_id").alias("lost_id"), F.col("sha").alias("lost_sha"), "first", "first_part").distinct(), "revisits")
    return marked.join(lost, F.col("page_id").eqNullSafe(F.col("lost_id")) & (F.col("sha") == F.col("lost_sha")), "left").select(
        "page_id", "url", "payload", "part", "payload_bytes", base32_sha1(F.col("payload")).alias("payload_digest"), F.when(F.col("first").isNull(), "response").otherwise("revisit").alias("record_type"), F.col("first").alias("refers_to"), F.col("first_part").alias("refers_part")
    )


def record_uri(kind: str, page_id: Column, part: Column) -> Column:
    """``<urn:page:kind:id>``, with the part before the id where a row has one; a null id is empty."""
    return F.concat(F.lit(f"<urn:page:{kind}:"), F.coalesce(F.concat(part, F.lit(":")), F.lit("")), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def _record(kind: Column, record_id: Column, uri: Column, date: Column, content_type: str, block: Column, extra: list[tuple[str, Column]]) -> Column:
    clean = F.regexp_replace(F.coalesce(uri, F.lit("")), r"[\x00-\x20\x7f]", "")
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", date), ("WARC-Target-URI", F.when(clean != "", clean)), *extra, ("Content-Type", F.lit(content_type)), ("Content-Length", F.octet_length(block).cast("string"))]
    lines = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v, F.lit(CRLF))).otherwise("") for k, v in head]
    return F.concat(F.lit("WARC/1.1" + CRLF), *lines, F.lit(CRLF), block)


def write_warc(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """Write a request, a response or revisit, and a metadata record for each page, as gzip files of about ``file_bytes`` of payload.

    ``pages`` has page_id, url and html; other columns are ignored. Null html is an empty payload; a null url leaves out
    the target; repeated rows are written each. Pages are written by classes of size, so that a run of long ones makes no huge file.
    Every record ends with two line ends, which are the text writer's line separator. No rows write no record.
    """
    rows = classify(numbered(pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))), min_bytes)
    ident, part, day = F.col("page_id"), F.col("part"), F.lit(date)
    capture = record_uri("capture", ident, part)
    path_of = F.coalesce(F.nullif(F.regexp_extract("url", r"(?s)://[^/?#]*(/[^#]*)", 1), F.lit("")), F.lit("/"))
    request = _record(F.lit("request"), record_uri("request", ident, part), F.col("url"), day, "application/http; msgtype=request", F.concat(F.lit("GET "), F.regexp_replace(path_of, r"[\x00-\x20\x7f]", ""), F.lit(f" HTTP/1.1{CRLF}{CRLF}")), [("WARC-Concurrent-To", capture)])
    body = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}"), F.when(F.col("record_type") == "response", F.col("payload")).otherwise(""))
    refers = F.when(F.col("refers_to").isNotNull(), record_uri("capture", F.col("refers_to"), F.col("refers_part")))
    profile = F.when(F.col("refers_to").isNotNull(), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    response = _record(F.col("record_type"), capture, F.col("url"), day, "application/http; msgtype=response", body, [("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")), ("WARC-Refers-To", refers), ("WARC-Profile", profile)])
    metadata = _record(F.lit("metadata"), record_uri("metadata", ident, part), F.col("url"), day, "application/warc-fields", F.concat(F.lit("page-id: "), F.coalesce(ident.cast("string"), F.lit("")), F.lit(f"{CRLF}payload-bytes: "), F.col("payload_bytes").cast("string"), F.lit(CRLF)), [("WARC-Concurrent-To", capture)])
    records = F.explode(F.array(request, response, metadata)).alias("value")
    level = lambda size: F.greatest(F.floor(F.log(F.greatest(size, F.lit(1)).cast("double")) / F.log(F.lit(float(SPREAD)))), F.lit(3)).cast("int")  # noqa: E731  up to 64 KB all are one class
    size = F.octet_length(F.coalesce("html", F.lit("")))
    found = pages.groupBy(level(size).alias("level")).agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("n")).collect()  # one row for each power of SPREAD
    for k in sorted(found, key=lambda k: k["level"]) or [{"level": 3, "bytes": 0, "n": 0}]:
        # files are cut by rows within the scan's own partitions, so nothing is dealt out anew
        mean = max(k["bytes"] / max(1, k["n"]), SPREAD ** k["level"])
        per_file = 3 * max(1, int(file_bytes // mean))
        rows.where(level(F.col("payload_bytes")) == k["level"]).select(records).write.mode("append").option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def parse_records(content: bytes, with_payload: bool) -> Iterator[tuple]:
    """Records of one archive, plain or in one or more gzip members, by Content-Length; what a response carries after its HTTP head is the payload.

    A record that cannot be used has its reason in ``error``; after one whose end is unknown nothing of the archive is read.
    """
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content))) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    lost = lambda reason, head={}: (head.get("warc-record-id"), head.get("warc-type"), *[None] * 7, reason)
    try:
        while True:
            line = stream.readline()
            while line in (b"\r\n", b"\n"):
                line = stream.readline()
            if not line:
                return
            if not line.startswith(b"WARC/"):
                yield lost("no record where one should begin")
                return
            head = {}
            while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
                k, _, v = line.decode("utf-8", "replace").rstrip("\r\n").partition(":")
                head[k.strip().lower()] = v.strip()
            if not head.get("content-length", "").isdigit():
                yield lost("no length", head)
                return
            block = stream.read(int(head["content-length"]))
            if len(block) < int(head["content-length"]):
                yield lost("cut short", head)
                return
            yield _fields(head, block, with_payload)
    except (OSError, EOFError, zlib.error) as e:
        yield lost(f"unreadable archive: {type(e).__name__}")


def _fields(head: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    kind, payload, fields, error = head.get("warc-type"), None, None, None
    if kind in ("response", "revisit"):
        _, gap, payload = block.partition(b"\r\n\r\n")
        error = None if gap or kind == "revisit" else "no end of the HTTP head"
    elif kind == "metadata":
        fields = block.decode("utf-8", "replace")
    digest = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "response" and digest and digest != base64.b32encode(hashlib.sha1(payload).digest()).decode():
        error = "the payload does not match its digest"
    if not kind or not head.get("warc-record-id"):
        error = "no type or record id"
    return head.get("warc-record-id"), kind, head.get("warc-concurrent-to"), head.get("warc-refers-to"), head.get("warc-target-uri"), digest, len(payload) if kind == "response" else None, fields, payload if with_payload else None, error


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives in ``path``, in the columns of ``RECORDS``; a broken record is a row with an ``error``."""
    names = [re.match(r"\s*(\w+)", c)[1] for c in RECORDS.split(",")]
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for row in parse_records(content.as_py(), with_payload):
                    rows.append(row)
                    held += len(row[8] or b"")
                    if len(rows) == 2000 or held > FILE_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, RECORDS)


def assemble_transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: record_id and the structs capture (response or revisit), request and metadata.

    Requests and metadata join their capture by its record id in WARC-Concurrent-To; where one is missing, its struct is
    null, and where a capture has several, the one with the least record id is taken. Records that belong to no capture,
    or have an ``error``, are left out.
    """
    records = records.where("error is null") if "error" in records.columns else records
    is_capture = F.col("record_type").isin("response", "revisit")
    key = F.when(is_capture, F.col("record_id")).otherwise(F.col("concurrent_to"))
    whole = F.struct(*(c for c in records.columns))
    part = lambda kind: F.min_by(whole, F.when(F.col("record_type") == kind if isinstance(kind, str) else kind, F.col("record_id")))
    return records.where(key.isNotNull()).groupBy(key.alias("capture_id")).agg(part(is_capture).alias("capture"), part("request").alias("request"), part("metadata").alias("metadata")).where("capture is not null").withColumnRenamed("capture_id", "record_id")


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back and assemble the transactions, payloads included: one for each row."""
    path = new_path(pages.sparkSession, "warc")
    write_warc(pages, path, min_bytes=min_bytes)
    return assemble_transactions(read_warc(pages.sparkSession, path))
