"""Proposals are counted in tasks before they are cleaned and moved, and texts are searched once for places."""

import re

from pyspark.sql import functions as F

from corpuskiln.functions.text import find_all
from corpuskiln.operators import backend, ledger
from corpuskiln.plans import flows


def test_a_counted_batch_equals_its_rows(spark):
    rows = [(("W", "w", "ß", "ss")[i % 4], "t", ("d", "D")[i % 3 % 2], ("", "r", f"r{i % 5}")[i % 3], (i * 37 % 101, i)) for i in range(120)]
    batch = spark.createDataFrame(rows, "source string, target string, domain string, reason string, no struct<a:int,b:int>")
    empty, now = spark.createDataFrame([], ledger.LEDGER), F.lit("2024-01-01").cast("timestamp")
    counted = ledger.counted(batch)
    assert counted.count() < 60 and counted.agg(F.sum("n")).first()[0] == 120
    key = lambda df: sorted(tuple(r) for r in df.collect())
    once = ledger.upsert(empty, batch, now)
    assert key(ledger.upsert(empty, counted, now)) == key(once) and key(ledger.upsert(once, counted, now)) == key(ledger.upsert(once, batch, now))


def test_equal_proposals_are_one_row_and_failed_documents_none(spark):
    kind = "doc_id long, lang string, chunk_no int, candidate_terms array<struct<source:string,target:string,domain:string,reason:string>>"
    term = lambda s, d="General": (s, "T", d, "r")
    answers = spark.createDataFrame([(1, "en", 0, [term("ring"), term("ring")]), (2, "fr", 0, [term("ring"), term(" field", "  ")]), (3, "en", 0, [term("lost")]), (4, None, 0, None)], kind)
    made = spark.createDataFrame([(1, None), (2, None), (3, "failed"), (4, None)], "doc_id long, error string")
    got = sorted((r["source"], r["domain"], r["n"], r["no"]["doc_id"], r["last_no"]["doc_id"]) for r in flows.candidates(answers, made).collect())
    assert got == [("field", "fr", 1, 2, 2), ("ring", "General", 3, 1, 2)]  # before, ring was three rows


def test_places_are_found_in_one_search(spark):
    texts = ["😀the x THE", "", "none", "the", "the\0the \0$0 the", "a\\the$the", "thethe the", None]
    pattern = r"(?i)(?=[t])(?<![A-Za-z0-9_])(?:the)(?![A-Za-z0-9_])"
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, text string").select("n", find_all(F.col("text"), pattern).alias("m"))
    got = {r["n"]: r["m"] if r["m"] is None else [tuple(m) for m in r["m"]] for r in rows.collect()}
    assert got == {n: None if t is None else [(m.start(), m.end(), m[0]) for m in re.finditer(r"(?i)(?<![A-Za-z0-9_])the(?![A-Za-z0-9_])", t)] for n, t in enumerate(texts)}
    assert "regexp_replace" in rows._jdf.queryExecution().optimizedPlan().toString()


def test_an_answer_is_read_once(monkeypatch):
    reads, loads = [], backend.json.loads
    monkeypatch.setattr(backend.json, "loads", lambda x: reads.append(x) or loads(x))

    class Requests:
        columns, dtypes = ["chunk", "prompt", "tokens"], [("chunk", "string"), ("prompt", "string"), ("tokens", "array<string>")]

        def mapInArrow(self, run, schema):
            return run, schema

    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"chunk": ["a", "b"], "prompt": [f"<SOURCE>\n{x}\n</SOURCE>" for x in "ab"], "tokens": [[], []]}, pa.schema([("chunk", pa.string()), ("prompt", pa.string()), ("tokens", pa.list_(pa.string()))]))
    run, schema = backend.generate(Requests(), check=backend.check_tokens, drop=("prompt",))
    (out,) = run(iter([batch]))
    assert out.schema.names == ["chunk", "tokens", "answer", "error", "tries"] and "prompt" not in schema
    assert out.column("error").to_pylist() == [None, None] and len(reads) == 2  # before, 4
