import base64
import gzip
import hashlib

from pyspark.sql import functions as F

from corpuskiln.llm import warc

PAGES = "page_id long, url string, html string"


def test_round_trip(spark, tmp_path):
    rows = [(3, "http://x/a b\n", "<p>é😀\r\n\r\nWARC/1.1\r\n</p>"), (1, None, "same"), (2, "http://y", "same"), (4, "z", None), (5, "z", ""), (6, "u", "x" * 200000)]
    path = str(tmp_path / "w")
    warc.write_warc(spark.createDataFrame(rows, PAGES).withColumn("payload", F.lit(1)).withColumn("sha", F.lit(1)), path)
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "w").glob("*.gz"))
    assert raw.count(b"WARC-Type: ") == 18 and raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
    records = warc.read_warc(spark, path)
    got = {r["record_id"]: r for r in warc.assemble_transactions(records).collect()}
    for i, url, html in rows:
        r, payload = got[f"<urn:page:capture:{i}>"], (html or "").encode()
        assert r["capture"]["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert r["request"]["record_id"] == f"<urn:page:request:{i}>" and f"payload-bytes: {len(payload)}" in r["metadata"]["fields"]
        revisit = {2: 1, 5: 4}.get(i)
        assert r["capture"]["record_type"] == ("revisit" if revisit else "response")
        assert r["capture"]["refers_to"] == (f"<urn:page:capture:{revisit}>" if revisit else None)
        if not revisit:
            assert bytes(r["capture"]["payload"]) == payload


def test_least_bytes_and_missing_partners(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], PAGES).withColumnRenamed("html", "payload")
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.classify(pages, 3).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}
    rows = [("c1", "response", None), ("r1", "request", "c1"), ("r0", "request", "c1"), ("m9", "metadata", "gone"), ("c2", "revisit", None), ("x", "request", None)]
    records = spark.createDataFrame(rows, "record_id string, record_type string, concurrent_to string")
    out = {r["record_id"]: (r["request"] and r["request"]["record_id"], r["metadata"]) for r in warc.assemble_transactions(records).collect()}
    assert out == {"c1": ("r0", None), "c2": (None, None)}


def test_no_pages_and_repeated_rows(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0
    twice = spark.createDataFrame([(1, "u", "x"), (1, "u", "x")], PAGES)
    assert [r["capture"]["record_type"] for r in warc.round_trip(twice).collect()] == ["response", "response"]


def test_each_row_gives_a_transaction(spark):
    rows = [(1, "u", "one"), (1, "u", "two"), (1, "v", "two"), (2, "u", "two"), (3, "u", "three"), (3, "u", "three"), (None, "u", "two"), (None, None, "lone"), (None, None, "lone"), (None, None, None)]
    out = warc.round_trip(spark.createDataFrame(rows, PAGES)).collect()
    assert len(out) == len({r["record_id"] for r in out}) == len(rows)
    assert all(r["request"]["concurrent_to"] == r["metadata"]["concurrent_to"] == r["record_id"] for r in out)
    at = {r["record_id"]: bytes(r["capture"]["payload"]).decode() for r in out if r["capture"]["record_type"] == "response"}
    revisits = [r for r in out if r["capture"]["record_type"] == "revisit"]
    assert [at[r["capture"]["refers_to"]] for r in revisits] == ["two", "two"]
    assert sorted(r["record_id"].rsplit(":", 1)[1] for r in revisits) == ["2>", ">"]
    assert sorted([*at.values(), "two", "two"]) == sorted(t or "" for _, _, t in rows)
    assert all(r["capture"]["payload_bytes"] == len(at[r["record_id"]]) for r in out if r["record_id"] in at)


def record(kind, ident, block, **extra):
    head = {"WARC-Type": kind, "WARC-Record-ID": ident, "Content-Length": str(len(block)), **{k.replace("_", "-"): v for k, v in extra.items()}}
    return b"WARC/1.0\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in head.items() if v is not None) + b"\r\n" + block + b"\r\n\r\n"


def test_a_member_for_each_record_and_broken_archives(spark, tmp_path):
    good = [record("warcinfo", "<w>", b"software: x\r\n"), record("response", "<c>", b"HTTP/1.1 200 OK\r\n\r\nbody"), record("request", "<r>", b"GET / HTTP/1.1\r\n\r\n", WARC_Concurrent_To="<c>")]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in good))
    (tmp_path / "b.warc").write_bytes(record("response", "<d>", b"HTTP/1.1 200 OK\r\n\r\nx", WARC_Payload_Digest="sha1:AAAA") + record("response", "<e>", b"HTTP/1.1 200 OK\r\n\r\ny")[:-12])
    (tmp_path / "c.warc").write_bytes(record("request", "<f>", b"", Content_Length=None) + good[0])
    (tmp_path / "d.warc.gz").write_bytes(gzip.compress(b"".join(good))[:-20])
    (tmp_path / "e.warc").write_bytes(record("response", None, b"HTTP/1.1 200 OK\r\n\r\ny") + b"junk\r\n")
    got = sorted((r["record_id"] or "", r["record_type"] or "", r["error"] or "") for r in warc.read_warc(spark, str(tmp_path / "[abce]*")).collect())
    assert got == sorted([("<w>", "warcinfo", ""), ("<c>", "response", ""), ("<r>", "request", ""), ("<d>", "response", "the payload does not match its digest"), ("<e>", "response", "cut short"), ("<f>", "request", "no length"), ("", "response", "no type or record id"), ("", "", "no record where one should begin")])
    assert any((r["error"] or "").startswith("unreadable archive") for r in warc.read_warc(spark, str(tmp_path / "d*")).collect())
    out = warc.assemble_transactions(warc.read_warc(spark, str(tmp_path / "[ab]*"))).collect()
    assert [(r["record_id"], bytes(r["capture"]["payload"]), r["request"]["record_id"]) for r in out] == [("<c>", b"body", "<r>")]


def test_long_pages_make_no_huge_files(spark, tmp_path):
    rows = [(i, "u", f"{i}" * (40_000 if 100 <= i < 130 else 5)) for i in range(400)]
    path = str(tmp_path / "w")
    warc.write_warc(spark.createDataFrame(rows, PAGES).coalesce(1), path, file_bytes=100_000)
    sizes = [len(gzip.decompress(p.read_bytes())) for p in (tmp_path / "w").glob("*.gz")]
    assert max(sizes) <= 16 * 100_000 and warc.assemble_transactions(warc.read_warc(spark, path)).count() == 400
