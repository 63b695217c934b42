from collections import Counter
from math import lgamma, log, log10
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from corpuskiln.llm import lattice

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return lattice.load_vocabulary(MODEL)


@pytest.fixture(scope="module")
def pieces():
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    plain = {model.id_to_piece(i): i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    return plain, {int(model.id_to_piece(i)[3:5], 16): i for i in range(model.vocab_size()) if model.is_byte(i)}


def segmentations(text, pieces):
    """All lists of piece ids, a list of bytes for a sign."""
    plain, byte = pieces
    if not text:
        yield []
        return
    for rest in segmentations(text[1:], pieces):
        yield [byte[b] for b in text[0].encode()] + rest
    for k in range(1, len(text) + 1):
        if text[:k] in plain:
            for rest in segmentations(text[k:], pieces):
                yield [plain[text[:k]]] + rest


WORDS = [b"the", b"a", b"", "ß中".encode(), b"\xff", b"ing$", "naïve".encode(), b"nothing"]


def test_forward_and_expected_equal_all_segmentations(vocabulary, pieces):
    p = np.exp(vocabulary.prior)
    want, counts = [], np.zeros(len(p))
    for w in WORDS:
        found = [(np.prod(p[s]), s) for s in segmentations("▁" + w.decode("utf-8", "replace"), pieces)]
        total = sum(x for x, _ in found)
        want.append(log(total))
        for x, s in found:
            np.add.at(counts, s, x / total)
    got, expected = np.zeros(len(WORDS)), np.zeros(len(p))
    for at, some in lattice.lattices(WORDS, vocabulary):
        got[at] = some.forward(vocabulary.prior)
        expected += some.expected()
    assert np.allclose(got, want) and np.allclose(expected, counts)


def test_scores_are_a_distribution_and_long_words_end(vocabulary):
    assert abs(np.exp(vocabulary.prior).sum() - 1) < 1e-9
    word = b"abcdefghij" * 3000
    ((_, some),) = lattice.lattices([word], vocabulary)
    (found,) = some.forward(vocabulary.prior)
    assert np.isfinite(found) and found < -1000
    assert some.expected().sum() >= 30000 / vocabulary.longest


@pytest.mark.parametrize("n", [1, 2, 5, 64, 65, 1000, 10**6])
def test_rising(spark, n):
    for log_x in (-300.0, -20.0, -1.0, 0.0, 3.0):
        x = 10.0**log_x
        want = log_x + sum(log10(x + i) for i in range(1, n)) if n <= 1000 else log_x + (lgamma(x + n) - lgamma(x + 1)) / log(10)
        assert abs(lattice.rising(np.array([log_x]), np.array([n]))[0] - want) < 1e-9 * max(1, abs(want))
        from pyspark.sql import functions as F

        assert abs(spark.range(1).select(lattice._rising(F.lit(log_x), F.lit(n).cast("long"))).first()[0] - want) < 1e-9 * max(1, abs(want))


def brute_force(rows, vocabulary, pieces, rounds, discount=0.75, strength=1000.0):
    plain, byte = pieces

    def arcs(word):
        text = "▁" + word.decode("utf-8", "replace")
        out = [(i, i + 1, [byte[b] for b in text[i].encode()]) for i in range(len(text))]
        return len(text), out + [(i, j, [plain[text[i:j]]]) for i in range(len(text)) for j in range(i + 1, len(text) + 1) if text[i:j] in plain]

    def passes(word, p):
        n, found = arcs(word)
        ahead, behind = [1.0] + [0.0] * n, [0.0] * n + [1.0]
        for i, j, s in sorted(found, key=lambda a: a[1]):
            ahead[j] += ahead[i] * np.prod(p[s])
        for i, j, s in sorted(found, key=lambda a: -a[0]):
            behind[i] += behind[j] * np.prod(p[s])
        return ahead[n], [(ahead[i] * np.prod(p[s]) * behind[j] / ahead[n], s) for i, j, s in found]

    docs = [(i, (t or "").encode().lower().split()) for i, t in rows]
    train = [w for i, w in docs if i is None or crc32(str(i).encode()) % 7 != 2]
    c = Counter(w for ws in train for w in ws)
    n, v = sum(c.values()) + len(train), len(c) + bool(train)
    prior = np.exp(vocabulary.prior)
    p = prior
    for _ in range(rounds):
        counts = lattice.PRIOR * prior
        for w in c:
            for share, s in passes(w, p)[1]:
                np.add.at(counts, s, share)
        p = counts / counts.sum()
    out = []
    end = (len(train) + 1) / (n + 2)
    for i, ws in docs:
        base = sum(log10((c[w] + 1) / (n + v + 1)) for w in ws) + log10((len(train) + 1) / (n + v + 1))
        lat = {w: passes(w, p)[0] for w in ws}
        mean = {w: (max(c[w] - discount, 0) + (discount * len(c) + 1) * lat[w]) / (n + 2) for w in ws}
        score = log(strength * end) + sum(lgamma(strength * mean[w] + k) - lgamma(strength * mean[w]) for w, k in Counter(ws).items()) - (lgamma(strength + len(ws) + 1) - lgamma(strength))
        alone = sum(log10(lat[w]) + log10(max(n + 1 - len(train), 1) / (n + 2)) for w in ws) + log10(end)
        out.append((i, i is not None and crc32(str(i).encode()) % 7 == 2, len(ws) + 1, sum(c[w] > 0 for w in ws) + bool(train), n, base, score / log(10), alone))
    return out


def close(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:6])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [tuple(r[:5]) for r in got] == [tuple(r[:5]) for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-7)


@pytest.mark.parametrize("frequent", [1 << 16, 5])
def test_scores_equal_brute_force(spark, monkeypatch, vocabulary, pieces, frequent):
    monkeypatch.setattr(lattice, "FREQUENT", frequent)
    monkeypatch.setattr(lattice, "COUNTED", 20)
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(25).collect()]
    rows = [(i, t[:600] if t else t) for i, t in enumerate(texts)] + [(None, "The the THE"), (None, None), (16, ""), (16, ""), (900, " \t\n"), (901, "x" * 60 + " � \x00 end ▁a"), (902, "the " * 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row", "'x' as word", "2 as c", "3 as p")
    got = lattice.score_texts(df.repartition(3), MODEL, rounds=2).collect()
    close(got, brute_force(rows, vocabulary, pieces, 2))


def test_edge_cases(spark, vocabulary, pieces):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lattice.score_texts(empty, MODEL).count() == 0
    held = next(i for i in range(100) if crc32(str(i).encode()) % 7 == 2)
    rows = [(held, "nothing learned"), (held, None)]
    close(lattice.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), MODEL, rounds=1).collect(), brute_force(rows, vocabulary, pieces, 1))


def test_base_scores_need_no_vocabulary(spark, monkeypatch):
    texts = ["The cat the dog", None, "", "\x0bzebra\tZebra  the", "a b c d e f g " * 9, "É é É", "cat cat cat"]
    df = spark.createDataFrame([(i if i else None, texts[i % 7]) for i in range(40)], "doc_id long, text string").repartition(3)
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens"]
    key = lambda out: sorted((str(tuple(r[c] for c in columns)), round(r["base_score"], 9)) for r in out.collect())
    for frequent in (lattice.FREQUENT, 4):  # all words looked up in place, and most of them moved
        monkeypatch.setattr(lattice, "FREQUENT", frequent)
        whole = key(lattice.score_texts(df, MODEL, rounds=1))
        with monkeypatch.context() as m:
            m.setattr(lattice, "load_vocabulary", None)
            assert key(lattice.base_scores(df)) == whole
            assert lattice.base_scores(df.limit(0)).count() == 0
    from corpuskiln.llm import queries

    monkeypatch.setattr(lattice, "load_vocabulary", None)
    assert queries.lm_base_scores(spark, "/root/testdata/sf0.001").count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()  # before, the model was fitted for it
