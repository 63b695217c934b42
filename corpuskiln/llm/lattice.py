"""Likelihood of texts under a lattice of subword pieces: all segmentations of every word, summed by forward recursion in log space."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.common import materialize
from corpuskiln.llm.words import sliced

WORD_START = "▁"
#: Rounds in which the scores are fitted, and the weight, in pieces, of what the vocabulary says before.
ROUNDS, PRIOR = 4, 1000.0
#: What is taken off each count for words that were never seen, and how many tokens a document's own words are outweighed by.
DISCOUNT, STRENGTH = 0.75, 1000.0
#: So many words at most, the most frequent ones, are broadcast; steps in which counts are told apart for that, to a factor of 2.
FREQUENT, COUNT_STEPS = 1 << 16, 8
#: Cells (word, start, piece length) of a table that is worked on at once, and distinct words that a task counts before it passes them on.
CELLS, COUNTED = 1 << 21, 400_000
#: Terms of a rising factorial that are summed one by one; the rest is Stirling's series, exact to 1e-12 from here on.
TERMS = 64


class Vocabulary(NamedTuple):
    """Pieces as a trie in arrays: ``keys`` (state and code point) sorted, the ``state`` each leads to, the ``piece`` of a state (-1: none), the piece of each byte, and log weights."""

    keys: np.ndarray
    state: np.ndarray
    piece: np.ndarray
    bytes: np.ndarray
    prior: np.ndarray
    longest: int


def load_vocabulary(path: str) -> Vocabulary:
    """The pieces of a model file of the sentencepiece library with byte fallback.

    Scores of a unigram model are log weights. Those of a merge model count down by rank; a piece of rank r weighs 1 / (r + 1), by
    Zipf's law, and a byte as much as the last piece. Control and unknown pieces take no part.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.vocab_size()
    score = np.array([model.get_score(i) for i in range(n)])
    plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    ranked = np.allclose(score[plain], np.rint(score[plain]))
    prior = np.full(n, -np.inf)
    prior[plain] = -np.log1p(-score[plain]) if ranked else score[plain]
    byte = np.full(256, -1)
    for i in range(n):
        if model.is_byte(i):
            byte[int(model.id_to_piece(i)[3:5], 16)] = i
    if (byte < 0).any():
        raise ValueError("the vocabulary has no byte fallback")
    prior[byte] = np.min(prior[plain][score[plain] > -1e8])
    prior -= np.log(np.exp(prior).sum())
    states, edges, ends = {"": 0}, {}, {}
    for i in plain:
        text = model.id_to_piece(i)
        for k in range(1, len(text) + 1):
            if text[:k] not in states:
                states[text[:k]] = len(states)
                edges[states[text[: k - 1]] << 21 | ord(text[k - 1])] = states[text[:k]]
        ends[states[text]] = i
    keys = np.array(sorted(edges), np.int64)
    piece = np.full(len(states), -1)
    piece[list(ends)] = list(ends.values())
    return Vocabulary(keys, np.array([edges[k] for k in keys.tolist()]), piece, byte, prior, max(len(model.id_to_piece(i)) for i in plain))


class Lattices:
    """The lattices of some words: ``points`` (word, place) are code points, ``ids`` (word, start, length) the piece of each arc or -1.

    Length 0 stands for the arc of one sign by its bytes, which every sign has, so every word has a segmentation.
    """

    def __init__(self, words: list[str], vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.size = np.array([len(w) for w in words])
        m, n = len(words), int(self.size.max())
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.points = np.zeros((m, n), np.int64)
        self.inside = np.arange(n) < self.size[:, None]
        self.points[self.inside] = flat
        row, start = np.nonzero(self.inside)
        state, arcs = np.zeros(len(row), np.int64), []
        for length in range(1, min(vocabulary.longest, n) + 1):
            here = start + length <= self.size[row]
            row, start, state = row[here], start[here], state[here]
            key = state << 21 | self.points[row, start + length - 1]
            at = np.minimum(np.searchsorted(vocabulary.keys, key), len(vocabulary.keys) - 1)
            known = vocabulary.keys[at] == key
            row, start, state = row[known], start[known], vocabulary.state[at[known]]
            if not len(row):
                break
            arcs.append((row, start, vocabulary.piece[state]))
        self.ids = np.full((m, n, len(arcs) + 1), -1)
        for length, (r, s, p) in enumerate(arcs, 1):
            self.ids[r, s, length] = p
        self.signs, inverse = np.unique(self.points[self.inside], return_inverse=True)
        self.sign = np.zeros((m, n), np.int64)
        self.sign[self.inside] = inverse
        self.sign_bytes = [vocabulary.bytes[list(chr(c).encode("utf-8", "surrogatepass"))] for c in self.signs.tolist()]

    def forward(self, scores: np.ndarray) -> np.ndarray:
        """Log probability of each word: over all segmentations the sum of the products of their pieces."""
        self.weights = np.where(self.ids >= 0, scores[self.ids], -np.inf)
        self.weights[:, :, 0] = np.where(self.inside, np.array([scores[b].sum() for b in self.sign_bytes])[self.sign], -np.inf)
        m, n, k = self.ids.shape
        self.alpha = np.full((m, n + 1), -np.inf)
        self.alpha[:, 0] = 0.0
        length = np.arange(1, k)
        for j in range(1, n + 1):
            back = length[length <= j]
            terms = np.concatenate([(self.alpha[:, j - 1] + self.weights[:, j - 1, 0])[:, None], self.alpha[:, j - back] + self.weights[:, j - back, back]], axis=1)
            self.alpha[:, j] = _log_sum(terms)
        self.whole = self.alpha[np.arange(m), self.size]
        return self.whole

    def expected(self) -> np.ndarray:
        """How often each piece occurs in the segmentations of all words, by their probability; after ``forward``."""
        m, n, k = self.ids.shape
        beta = np.full((m, n + 1), -np.inf)
        beta[np.arange(m), self.size] = 0.0
        length = np.arange(1, k)
        for i in range(n - 1, -1, -1):
            on = length[length <= n - i]
            terms = np.concatenate([(beta[:, i + 1] + self.weights[:, i, 0])[:, None], beta[:, i + on] + self.weights[:, i, on]], axis=1)
            beta[:, i] = np.where(i < self.size, _log_sum(terms), beta[:, i])
        found = np.zeros(len(self.vocabulary.prior))
        for step in range(1, k):
            shares = np.exp(self.alpha[:, : n + 1 - step] + self.weights[:, : n + 1 - step, step] + beta[:, step:] - self.whole[:, None])
            ids = self.ids[:, : n + 1 - step, step]
            found += np.bincount(ids[ids >= 0], shares[ids >= 0], len(found))
        shares = np.exp(self.alpha[:, :n] + self.weights[:, :, 0] + beta[:, 1:] - self.whole[:, None])
        for share, ids in zip(np.bincount(self.sign[self.inside], shares[self.inside], len(self.signs)), self.sign_bytes):
            np.add.at(found, ids, share)
        return found


def _log_sum(terms: np.ndarray) -> np.ndarray:
    top = terms.max(axis=1)
    top[~np.isfinite(top)] = 0.0
    with np.errstate(divide="ignore"):
        return np.log(np.exp(terms - top[:, None]).sum(axis=1)) + top


def lattices(words: list[bytes], vocabulary: Vocabulary) -> Iterator[tuple[np.ndarray, Lattices]]:
    """The lattices of ``words`` (UTF-8; bytes that are none are read as the replacement sign), some words of like length at a time, with their places."""
    texts = [WORD_START + w.decode("utf-8", "replace") for w in words]
    size = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(size, kind="stable")
    at = 0
    while at < len(order):
        most = size[order[at]] + size[order[at]] // 4 + 2
        end = min(at + max(1, CELLS // (int(most) * (vocabulary.longest + 1))), int(np.searchsorted(size[order], most, "right")))
        some = order[at:end]
        yield some, Lattices([texts[i] for i in some], vocabulary)
        at = end


def learned(doc_id: Column) -> Column:
    """Whether a document's words are learned: the CRC-32 of its doc_id by 7 leaves no 2; a null doc_id is learned."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(7)) != 2, F.lit(True))


def count_words(docs: DataFrame) -> DataFrame:
    """word (bytes), t and c: how often all documents and the learned ones have it; each task adds up before rows are moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, others = Counter(), Counter()

        def out() -> pa.RecordBatch:
            words = [*known, *others]  # a word of both has two rows, which are added up with those of other tasks
            c = pa.array([*known.values(), *[0] * len(others)], pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([*known.values(), *others.values()], pa.int64()), c], ["word", "t", "c"])

        for batch in sliced(batches):
            for text, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (known if own else others).update((text or b"").lower().split())
                if len(known) + len(others) > COUNTED:
                    yield out()
                    known.clear()
                    others.clear()
        yield out()

    rows = docs.select(F.col("text").cast("binary"), learned(F.col("doc_id")).alias("learned"))
    return rows.mapInArrow(run, "word binary, t long, c long").groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))


def fit_scores(words: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Log probabilities of the pieces: the vocabulary's scores, fitted to ``words`` (each once), in rounds of expectation and maximisation.

    A round is one pass over all words; a task gives one row of expected counts, and these are added in a tree of tasks.
    """
    scores = vocabulary.prior
    pieces = np.exp(vocabulary.prior)
    for _ in range(rounds):

        def expect(batches: Iterator[pa.RecordBatch], now: np.ndarray = scores) -> Iterator[pa.RecordBatch]:
            found = np.zeros(len(now))
            for batch in batches:
                for _, some in lattices(batch.column(0).to_pylist(), vocabulary):
                    some.forward(now)
                    found += some.expected()
            yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], ["found"])

        parts = words.select("word").mapInArrow(expect, "found binary").rdd.map(lambda r: np.frombuffer(r["found"]))
        found = parts.treeAggregate(np.zeros(len(scores)), lambda a, b: a + b, lambda a, b: a + b, 3)
        total = found + PRIOR * pieces
        with np.errstate(divide="ignore"):
            scores = np.log(total / total.sum())
    return scores


def rising(log_x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """log10 of x (x + 1) ... (x + n - 1), where ``log_x`` is log10 of x and n is 1 at least."""
    x, out = 10.0**log_x, log_x.copy()
    more = np.flatnonzero(n > 1)
    for i in range(1, TERMS):
        more = more[n[more] > i]
        if not len(more):
            return out
        out[more] += np.log10(x[more] + i)
    more = more[n[more] > TERMS]
    out[more] += (_stirling(x[more] + n[more]) - _stirling(x[more] + TERMS)) / np.log(10)
    return out


def _stirling(z: np.ndarray) -> np.ndarray:
    return (z - 0.5) * np.log(z) - z + 1 / (12 * z) - 1 / (360 * z**3)


class Counts(NamedTuple):
    """Totals of the learned documents: how many there are, and their tokens and distinct tokens, ends included."""

    documents: int
    tokens: int
    distinct: int


def totals(docs: DataFrame, counted: DataFrame) -> Counts:
    trained = docs.agg(F.count(F.when(learned(F.col("doc_id")), 1)).alias("n")).first()["n"]
    sums = counted.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("c"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    return Counts(trained, sums["c"] + trained, sums["v"] + (trained > 0))


def least_frequent(words: DataFrame) -> int:
    """The least ``t`` of the words that are looked up in place, ``FREQUENT`` at most."""
    by_count = words.groupBy(F.floor(F.log2("t") * COUNT_STEPS).alias("k")).agg(F.min("t").alias("least"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("k")).collect()  # hundreds of rows
    limit, so_far = (1 << 62), 0
    for r in by_count:
        so_far += r["n"]
        limit = r["least"] if so_far <= FREQUENT else limit
    return limit


def base_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens and base_score of ``score_texts`` alone: counts need no vocabulary, no lattices and no fit.

    Words are looked up and moved as there: the most frequent where the text is, the others once per document and word.
    """
    counted = materialize(count_words(docs), "words")
    trained, n_train, distinct = totals(docs, counted)
    limit, floor = least_frequent(counted), float(np.log10(n_train + distinct + 1))
    frequent = counted.where(F.col("t") >= limit).select("word", "c").toArrow()  # FREQUENT rows at most
    held = docs.sparkSession.sparkContext.broadcast(({w: i for i, w in enumerate(frequent.column("word").to_pylist())}, frequent.column("c").to_numpy()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, c = held.value
        logs = np.log10(c + 1.0)
        for batch in sliced(batches):
            n_tokens, known, base, rare, rare_times, ends = [], [], [], [], [], [0]
            for text in batch.column(0).to_pylist():
                words = (text or b"").lower().split()  # ASCII letters and white space only
                places = [names.get(w, -1) for w in words]
                at = np.array(places, np.int64)
                at = at[at >= 0]
                if len(at) < len(words):
                    others = Counter(w for w, i in zip(words, places) if i < 0)
                    rare.extend(others)
                    rare_times.extend(others.values())
                ends.append(len(rare))
                n_tokens.append(len(words) + 1)
                known.append(int((c[at] > 0).sum()) + (trained > 0))
                base.append(float(logs[at].sum()))
            rest = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(rare, pa.binary()), pa.array(rare_times, pa.int64())], ["word", "n"]))
            base = np.array(base, float) + np.log10(trained + 1.0) - np.array(n_tokens, float) * floor
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base), rest], ["doc_id", "n_tokens", "known", "base", "rare"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select(F.col("text").cast("binary"), "doc_id").mapInArrow(read, f"doc_id {kind}, n_tokens long, known long, base double, rare array<struct<word:binary,n:long>>")
    texts = materialize(out.withColumn("row", F.monotonically_increasing_id()), "read-texts")
    asked = texts.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n")
    met = asked.join(counted.where(F.col("t") < limit).select("word", "c"), "word")
    rest = met.groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("n"))).alias("known_"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("base_"))
    plus = lambda name: F.col(name) + F.coalesce(F.col(f"{name}_"), F.lit(0))
    return texts.drop("rare").join(rest, "row", "left").select("doc_id", (~learned(F.col("doc_id"))).alias("held_out"), "n_tokens", plus("known").cast("long").alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"), plus("base").alias("base_score"))


def score_texts(docs: DataFrame, path: str, rounds: int = ROUNDS, discount: float = DISCOUNT, strength: float = STRENGTH) -> DataFrame:
    """One row per row of ``docs`` (doc_id and text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score.

    Tokens are words, A to Z in lower case, and one end; a null text is empty. ``base_score`` is the log10 probability by counts plus one.
    The model: a word is a run of pieces of the vocabulary at ``path``, the first of which begins a word, and its probability is summed over
    all segmentations; scores are fitted to the learned words. ``lattice_score`` is the log10 probability by pieces alone, as one
    recursion over the text gives it, since no piece goes beyond a word. For ``score`` the lattice also has an arc for each learned word as a whole,
    weighted by its count less ``discount``, pieces have what is taken off, and a document draws its tokens from a distribution of its own, of which this is the
    mean (Dirichlet, ``strength``); that is summed out too, so words that a document repeats become likelier. All three are
    probabilities of the whole text but the first, which gives every unknown word the same. Equal rows are scored alike; no rows give no rows.

    The most frequent words (``FREQUENT`` at most) are looked up where the text is; the others are moved once per document and word, and meet their counts
    in a join in which no word has more than about one in ``FREQUENT`` of all tokens. Only texts' sums return to their rows.
    """
    spark = docs.sparkSession
    vocabulary = load_vocabulary(path)
    counted = materialize(count_words(docs), "words")
    trained, n_train, distinct = totals(docs, counted)
    scores = fit_scores(counted.where("c > 0"), vocabulary, rounds)
    unseen, whole = float(np.log10((discount * (distinct - (trained > 0)) + 1) / (n_train + 2))), n_train + 2
    end, floor = float(np.log10((trained + 1) / (n_train + 2))), float(np.log10(n_train + distinct + 1))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros(batch.num_rows)
            for at, some in lattices(batch.column(0).to_pylist(), vocabulary):
                found[at] = some.forward(scores) / np.log(10)
            seen = np.maximum(batch.column(2).to_numpy(zero_copy_only=False) - discount, 0.0)
            with np.errstate(divide="ignore"):
                both = np.logaddexp(np.log(seen / whole), (unseen + found) * np.log(10)) / np.log(10)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found), pa.array(both)], ["word", "t", "c", "lattice", "p"])

    words = materialize(counted.select("word", "t", "c").mapInArrow(weigh, "word binary, t long, c long, lattice double, p double"), "weighed-words")
    limit = least_frequent(words)
    frequent = words.where(F.col("t") >= limit).select("word", "c", "lattice", "p").toArrow()  # FREQUENT rows at most
    names = {w: i for i, w in enumerate(frequent.column("word").to_pylist())}
    held = spark.sparkContext.broadcast((names, *(frequent.column(c).to_numpy() for c in ("c", "lattice", "p"))))
    step = float(np.log10(strength))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, c, lattice, p = held.value
        for batch in sliced(batches):
            doc, place, times, n_tokens, rare, rare_times, ends = [], [], [], [], [], [], [0]
            for text in batch.column(0).to_pylist():
                found = Counter((text or b"").lower().split())  # ASCII letters and white space only
                for w, n in found.items():
                    at = names.get(w)
                    if at is None:
                        rare.append(w)
                        rare_times.append(n)
                    else:
                        doc.append(len(n_tokens))
                        place.append(at)
                        times.append(n)
                ends.append(len(rare))
                n_tokens.append(found.total() + 1)
            doc, place, times, n = np.array(doc, int), np.array(place, int), np.array(times, int), len(n_tokens)
            per_doc = lambda x: np.bincount(doc, x, n).astype(float)  # noqa: E731; of no rows bincount gives integers
            # the end is a word of its own that each text has once
            urn = per_doc(rising(p[place] + step, times)) + (end + step) - rising(np.full(n, step), np.array(n_tokens))
            rest = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(rare, pa.binary()), pa.array(rare_times, pa.int64())], ["word", "n"]))
            known = per_doc(times * (c[place] > 0)).astype(np.int64) + (trained > 0)
            base = per_doc(times * np.log10(c[place] + 1.0)) + np.log10(trained + 1.0) - np.array(n_tokens) * floor
            columns = [batch.column(1), pa.array(n_tokens, pa.int64()), pa.array(known), pa.array(base), pa.array(urn), pa.array(per_doc(times * lattice[place])), rest]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "known", "base", "urn", "pieces", "rare"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select(F.col("text").cast("binary"), "doc_id").mapInArrow(read, f"doc_id {kind}, n_tokens long, known long, base double, urn double, pieces double, rare array<struct<word:binary,n:long>>")
    texts = materialize(out.withColumn("row", F.monotonically_increasing_id()), "read-texts")
    asked = texts.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n")
    met = asked.join(words.where(F.col("t") < limit).select("word", "c", "lattice", "p"), "word")
    rest = met.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n"))).alias("known_"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("base_"), F.sum(_rising(F.col("p") + step, F.col("n"))).alias("urn_"), F.sum(F.col("n") * F.col("lattice")).alias("pieces_")
    )
    both = texts.drop("rare").join(rest, "row", "left")
    plus = lambda name: F.col(name) + F.coalesce(F.col(f"{name}_"), F.lit(0))
    goes_on = float(np.log10(max(n_train + 1 - trained, 1) / (n_train + 2)))
    return both.select(
        "doc_id", (~learned(F.col("doc_id"))).alias("held_out"), "n_tokens", plus("known").cast("long").alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"),
        plus("base").alias("base_score"), plus("urn").alias("score"), (plus("pieces") + (F.col("n_tokens") - 1) * goes_on + end).alias("lattice_score"),
    )


def _rising(log_x: Column, n: Column) -> Column:
    """``rising`` as a column expression."""
    x = F.pow(F.lit(10.0), log_x)
    terms = F.aggregate(F.sequence(F.lit(1).cast("long"), F.least(n, F.lit(TERMS).cast("long")) - 1), log_x, lambda a, i: a + F.log10(x + i))
    series = lambda z: (z - 0.5) * F.log(z) - z + 1 / (12 * z) - 1 / (360 * z * z * z)
    return F.when(n == 1, log_x).when(n <= TERMS, terms).otherwise(terms + (series(x + n) - series(x + TERMS)) / float(np.log(10)))
