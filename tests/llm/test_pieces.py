import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from corpuskiln.llm.pieces import Normaliser, PieceEncoder, encode_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BITS = ["a", "B", " ", "  ", "ﬁ", "①", "é", "é", "　", "\t", "\n", "한", "한", "▁", "😀", "​", "ß", "½", "<s>", "\x00", "汉"]


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
def test_normalisation_and_alignment_equal_the_library(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    mine = Normaliser(library.serialized_model_proto())
    for t in texts(1, 3000):
        if "\x00" in t:
            continue
        want, offsets = library.Normalize(t, with_offsets=True)
        whole, source = mine(t.encode())
        assert whole.decode() == want
        at = [0]
        for c in want:
            at.append(at[-1] + len(c.encode()))
        assert [len(t.encode()[: source[k]].decode()) for k in at] == list(offsets)


def test_ids_spans_and_text(spark):
    rows = list(enumerate(["Hello  wörld", "", None, " x", "😀▁", *texts(3, 200)]))
    out = {r["doc_id"]: r for r in encode_pieces(spark.createDataFrame(rows, "doc_id long, text string"), MODEL).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for i, t in rows:
        r, raw = out[i], (t or "").encode()
        assert r["ids"] == library.encode(t or "") and r["decoded"] == library.decode(r["ids"])
        assert len(r["begins"]) == len(r["ends"]) == len(r["ids"])
        joined = b"".join(raw[b:e] for b, e in zip(r["begins"], r["ends"]))
        assert joined == raw and r["begins"] == sorted(r["begins"])


def test_whole_words_have_their_own_bytes():
    encoder = PieceEncoder(MODEL)
    raw = "über den Fluss".encode()
    ids, begins, ends = encoder.encode([raw.decode()])[0]
    assert ids.tolist() == encoder.decoder.encode(raw.decode())
    cut = [raw[b:e].decode() for b, e in zip(begins, ends)]
    assert "".join(cut) == "über den Fluss" and " den" in cut


def test_edge_cases(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (2, "word " * 60000)], "doc_id long, text string").withColumn("ids", F.lit("x")).withColumn("decoded", F.lit(1))
    got = encode_pieces(df, MODEL).collect()
    assert len(got) == 4 and {len(r["ids"]) for r in got if r["doc_id"] is None} == {0}
    long = next(r for r in got if r["doc_id"] == 2)
    assert hashlib.sha256(long["decoded"].encode()).digest() == hashlib.sha256(("word " * 60000).encode()).digest()
    assert encode_pieces(df.limit(0), MODEL).count() == 0
