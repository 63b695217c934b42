import hashlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpuskiln.llm import queries

SF = "/root/testdata/sf0.001"


def show(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("null" if r[i] is None else str(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        db.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = db.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert show(got.columns, [tuple(r) for r in got.collect()]) == show(want.columns, want.fetchall())


def test_sentencepiece_equals_the_library(spark):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = {r["doc_id"]: r for r in queries.op5_sentencepiece(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(out) == len(rows)
    for doc, text in rows:
        ids = library.encode(text or "")
        r = out[doc]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest() and r["n_bytes"] == len((text or "").encode())


def test_toxicity_rows(spark):
    from zlib import crc32

    out = queries.op3_toxicity(spark, SF).collect()
    assert len(out) == 200
    for r in out:
        assert r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)


def test_toxicity_equals_brute_force(spark):
    """Scores of the query from plain edit distances of every word to every term, and contexts read line by line."""
    import math
    import re

    from corpuskiln.llm import toxicity

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    known = {}

    def distances(term, word):
        """Edits between a term and each beginning of a word, swaps of neighbours among them."""
        rows = [list(range(len(word) + 1))]
        for i, a in enumerate(term, 1):
            row = [i]
            for j, b in enumerate(word, 1):
                e = min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (a != b))
                if i > 1 and j > 1 and a == word[j - 2] and b == term[i - 2]:
                    e = min(e, rows[-2][j - 2] + 1)
                row.append(e)
            rows.append(row)
        return rows[-1]

    def nearest(word):
        if word not in known:
            best = None
            for k, t in enumerate(model.terms):
                if not t.edits:
                    e = 0 if (word.startswith(t.text) if t.stem else word == t.text) else 99
                elif len(word) < len(t.text) - t.edits or (not t.stem and len(word) > len(t.text) + t.edits):
                    continue
                else:
                    e = min(distances(t.text, word)) if t.stem else distances(t.text, word)[-1]
                if e <= t.edits and (best is None or (e, k) < best):
                    best = e, k
            known[word] = best
        return known[word]

    def context(line, a, b):
        before, after = toxicity.WORD.findall(line[max(0, a - toxicity.WINDOW) : a])[-8:], toxicity.WORD.findall(line[b : b + toxicity.WINDOW])[:8]
        quoted = line[:a].count('"') % 2 == 1 and '"' in line[b:]
        quoted = quoted or any(m.start() <= a and m.end() > b for o, c in toxicity.QUOTES for m in re.finditer(f"{o}[^{c}]*{c}", line))
        worth = 0.2 if quoted else 1.0
        if set(before) & toxicity.REPORTING:
            return worth * 0.5
        return worth * 1.5 if not quoted and set(before + after) & toxicity.ADDRESSING else worth

    out = {r["doc_id"]: r for r in queries.op3_toxicity(spark, sf).collect()}
    total = 0
    for doc, text in docs.collect():
        hits = [(*nearest(m[0]), context(line, m.start(), m.end())) for line in (text or "").lower().split("\n") for m in toxicity.WORD.finditer(line) if nearest(m[0])]
        worth = [(model.terms[k].weight * c / (1 + e), c >= 0.75) for e, k, c in hits]
        direct, quoted = sum(w for w, d in worth if d), sum(w for w, d in worth if not d)
        x = [1.0, math.log1p(direct), math.log1p(quoted), float(len({k for _, k, c in hits if c >= 0.75}) > 1)] if hits else [1.0, 0.0, 0.0, 0.0]
        z = sum(a * b for a, b in zip(x, model.coefficients, strict=True))
        r = out[doc]
        assert (r["n_hits"], r["n_quoted"], r["n_misspelled"]) == (len(hits), sum(c < 0.75 for _, _, c in hits), sum(e > 0 for e, _, _ in hits)), doc
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-6), doc
        total += len(hits)
    assert total > 100


def test_planted_quotations_are_told_from_abuse(spark):
    """Toxic documents as they are, and with every line within quotation marks after a word that reports: the quoted twins are no longer toxic."""
    from corpuskiln.llm import toxicity

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    direct = toxicity.score(docs, model).where(F.col("toxicity.score") >= toxicity.THRESHOLD)
    clean = F.regexp_replace("text", "[\"“”„«»‘’]", " ")
    quoted = F.array_join(F.transform(F.split(clean, "\n"), lambda x: F.concat(F.lit("they wrote „"), x, F.lit("“"))), "\n")
    twins = toxicity.score(direct.select("doc_id", quoted.alias("text")), model).select("toxicity.*").collect()
    assert len(twins) >= 10 and all(r["n_quoted"] == r["n_hits"] > 0 for r in twins)
    assert sum(r["score"] >= toxicity.THRESHOLD for r in twins) == 0


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_mixing_equals_brute_force(spark, sf):
    from tests.llm.test_mixing import plain_mix

    docs = {r["doc_id"]: (r["source"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op2_mix_sources(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for source, (whole, target, epochs, distance) in plain_mix(docs.values()).items():
        own = [r for r in rows if docs[r["doc_id"]][0] == source]
        assert {r["source_size"] for r in own} == {whole} and all(abs(r["target"] - target) < 1e-6 * max(1, target) for r in own)
        assert abs(sum(r["taken"] for r in own) - round(target)) == distance
        assert all(r["taken"] == r["size"] * r["copies"] and r["copies"] in (epochs, epochs + 1) and r["copies"] <= 3 for r in own)


def test_pipeline_equals_its_stages_by_brute_force(spark):
    """Every stage from the rows of the one before it, told anew in plain Python."""
    import public_tokenizers
    import sentencepiece

    from tests.llm.test_bagminhash import brute_force
    from tests.llm.test_mixing import plain_mix

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen, columns = [docs.collect()], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), f"test-{name}")
        seen.append(docs.collect())
        if name != "sentencepiece":
            assert docs.columns == columns
    start, clean, exact, near, mixed, pieces = seen
    scores = {r["doc_id"]: r["predicted"] for r in queries.op3_toxicity(spark, SF).collect()}
    assert {r["doc_id"] for r in clean} == {d for d, p in scores.items() if not p}
    best = {}
    for r in clean:
        best[r["text"]] = max(best.get(r["text"], -1), r["doc_id"])
    assert {r["doc_id"] for r in exact} == set(best.values())
    groups = brute_force([(r["doc_id"], r["text"]) for r in exact])
    assert {r["doc_id"] for r in near} == {i for i, g in groups.items() if i == g}
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in near} and len(mixed) > 0
    for source, (_, target, epochs, distance) in plain_mix([(r["source"], r["text"]) for r in near]).items():
        own = [r for r in mixed if r["source"] == source]
        assert abs(sum(len((r["text"] or "").split()) for r in own) - round(target)) == distance
        assert all(Counter(r["doc_id"] for r in own)[r["doc_id"]] in (epochs, epochs + 1) for r in near if r["source"] == source)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert sorted((r["doc_id"], r["ids"]) for r in pieces) == sorted((r["doc_id"], library.encode(r["text"] or "")) for r in mixed)
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "ids", "begins", "ends", "n_tokens"] and out.where(F.col("n_tokens") > 0).count() > 0
