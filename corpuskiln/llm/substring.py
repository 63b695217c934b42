"""Substring dedup: suffix automata of reference shards give matching statistics; long repeated spans go."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from corpuskiln.llm.common import materialize, new_path
from corpuskiln.llm.words import WordHashes, mix, ngrams, sliced
from corpuskiln.operators.scan import number_rows

#: Words of a window and of an anchor, which is the least hash among the word runs of a window.
WINDOW, ANCHOR = 13, 5
#: Documents that frequent anchors are sought in, and how many of them make an anchor frequent.
SAMPLE, FREQUENT = 8192, 8
#: Parts that the rows of a frequent piece are dealt out to.
SALTS = 64
#: Pieces that one automaton holds, about.
SHARD = 2000
#: Rows of pieces that are judged together, about; a key is never cut.
JUDGED = 1 << 20
#: Bytes of Parquet in a bucket of the working table.
BUCKET_BYTES = 16 << 20
FOUND, OPEN = 1, 2
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class SuffixAutomaton:
    """Suffix automaton of several word sequences; ``longest`` gives the matching statistics of another one."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.size = [-1], [0]

    def _split(self, p: int, q: int, c: bytes) -> int:
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.size.append(self.size[p] + 1)
        clone = len(self.next) - 1
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[bytes]) -> None:
        at = 0
        for c in words:
            q = self.next[at].get(c)
            if q is not None:  # the sequences before have this one too
                at = q if self.size[q] == self.size[at] + 1 else self._split(at, q, c)
                continue
            self.next.append({})
            self.link.append(0)
            self.size.append(self.size[at] + 1)
            new, p = len(self.next) - 1, at
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, q, c)
            at = new

    def longest(self, words: list[bytes]) -> list[int]:
        """For each place the length of the longest match that ends there."""
        out, at, length = [], 0, 0
        for c in words:
            while at and c not in self.next[at]:
                at = self.link[at]
                length = self.size[at]
            if c in self.next[at]:
                at, length = self.next[at][c], length + 1
            out.append(length)
        return out


def pieces(words: np.ndarray) -> tuple[np.ndarray, ...]:
    """Cut the windows of a document to pieces, runs of windows with the same anchor place.

    Arrays by piece: hash of the anchor, hash of all the piece's words, number of its first word and of its windows. Equal
    windows have equal anchors, whatever document they stand in.
    """
    least, done, width = ngrams(words, ANCHOR), 1, WINDOW - ANCHOR + 1
    while done < width:
        step = min(done, width - done)
        least = np.minimum(least[:-step], least[step:])
        done += step
    at = np.arange(len(least))
    stretch = np.maximum.accumulate(np.where(np.r_[True, least[1:] != least[:-1]], at, 0))
    starts = np.flatnonzero((at - stretch) % width == 0)
    counts = np.diff(np.append(starts, len(least)))
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(len(words), _ODD))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(words) * powers)])
        back = np.cumprod(np.full(len(words), _INVERSE))
        content = mix((sums[starts + counts + WINDOW - 1] - sums[starts]) * back[starts] + counts.astype(np.uint64))
    return least[starts], content, starts, counts


def _cut(frequent: np.ndarray, repeated: np.ndarray):
    """Rows (key, content, doc, place) of the pieces of each document; ``frequent`` and ``repeated`` are sorted."""

    def among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.zeros(len(x), bool)
        return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for batch in sliced(batches):
            parts = []
            for doc, row, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = (text or "").encode().split()
                if doc is None or len(words) < WINDOW:
                    continue
                key, content, starts, counts = pieces(memory.of(words))
                often = among(key, frequent)
                if often.any():  # pieces of a frequent anchor are dealt out by their content, frequent pieces also by document
                    with np.errstate(over="ignore"):
                        whole = mix(key ^ content)
                        salted = mix(whole + np.uint64(1 + hash(doc) % SALTS))
                    key = np.where(often, np.where(among(whole, repeated), salted, whole), key)
                parts.append((key, content, np.full(len(key), doc, np.int64), (row << 36) | (starts << 5) | (counts << 1) | often))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in zip(*parts, strict=True)], ["key", "content", "doc", "place"])

    return run


def _judge(shard: int, judged: int = JUDGED):
    """State of pieces that come by key: FOUND if a smaller document has the piece, OPEN if others share its anchor only.

    Frequent pieces come in parts, so the first of each part is OPEN. A key is judged whole; about ``judged`` rows are held at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        rows = 0
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            key = columns[0]
            if not len(key):
                continue
            changes = np.flatnonzero(key[1:] != key[:-1]) + 1
            cut = int(changes[-1]) if len(changes) else 0
            if rows + cut >= judged and (cut or (held and held[-1][0][-1] != key[0])):
                yield _states([*held, [c[:cut] for c in columns]], shard)
                held, rows, columns = [], 0, [c[cut:] for c in columns]
            held.append(columns)
            rows += len(columns[0])
        if held:
            yield _states(held, shard)

    return run


def _states(parts: list[list[np.ndarray]], shard: int) -> pa.RecordBatch:
    key, content, doc, place = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((doc, content, key))
    key, content, doc, place = (x[order] for x in (key, content, doc, place))
    often = (place & 1).astype(bool)
    new_key = np.r_[True, key[1:] != key[:-1]]
    new = new_key | np.r_[True, content[1:] != content[:-1]]
    first = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
    at, group = np.flatnonzero(new_key), np.cumsum(new_key) - 1
    shared = (np.maximum.reduceat(doc, at) != np.minimum.reduceat(doc, at)) & (np.add.reduceat(new.astype(np.int64), at) > 1)
    state = np.where(doc > first, FOUND, np.where(shared[group] | often, OPEN, 0))
    crowded = np.add.reduceat((state == OPEN).astype(np.int64), at) > shard  # more than one automaton should hold: window by window
    often |= crowded[group]
    some = state > 0
    columns = (doc, np.where(often, -1, key), place >> 36, place >> 5 & 0x7FFFFFFF, place >> 1 & 15, state, often)
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_())
    names = [c.split()[0] for c in STATES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c[some]).cast(k) for c, k in zip(columns, kinds, strict=True)], names)


STATES = "doc long, key long, row int, start int, windows int, state int, frequent boolean"
CUT = "key long, content long, doc long, place long"
PIECES = "key long, doc long, row int, start int, words string, frequent boolean"
SPANS = "doc long, row int, start int, size int"


def _open_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of OPEN pieces; those of frequent anchors window by window."""
    for batch in sliced(batches):
        out: list[tuple] = []
        for doc, row, text, states in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = (text or "").encode().split()
            for s in states:
                if s["row"] != row:
                    continue
                start, n = s["start"], s["windows"]
                if s["frequent"]:
                    out += [(-1, doc, row, k, b" ".join(words[k : k + WINDOW]).decode(), True) for k in range(start, start + n)]
                else:
                    out.append((s["key"], doc, row, start, b" ".join(words[start : start + n + WINDOW - 1]).decode(), False))
            if len(out) > 5000:
                yield _batch(out, PIECES)
                out = []
        if out:
            yield _batch(out, PIECES)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    names = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), names, strict=True)], [n for n, _ in names])


def _match(most: int):
    """Rows come by key: whole keys are gathered to shards of ``most`` pieces or a little more, and each document's pieces meet the automaton of the smaller ones."""

    def spans(shard: list[tuple]) -> list[tuple]:
        automaton, waiting, out, last = SuffixAutomaton(), [], [], None
        for doc, row, start, text in sorted(shard):
            if doc != last:
                for words in waiting:
                    automaton.add(words)
                waiting, last = [], doc
            words = text.encode().split()
            ends = [i for i, n in enumerate(automaton.longest(words)) if n >= WINDOW]
            while ends:
                k = 0
                while k + 1 < len(ends) and ends[k + 1] == ends[k] + 1:
                    k += 1
                out.append((doc, row, start + ends[0] - WINDOW + 1, ends[k] - ends[0] + WINDOW))
                ends = ends[k + 1 :]
            waiting.append(words)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []
        last = None
        for batch in batches:
            for key, *rest in zip(*(batch.column(c).to_pylist() for c in ("key", "doc", "row", "start", "words")), strict=True):
                if key != last and len(shard) >= most:
                    if found := spans(shard):
                        yield _batch(found, SPANS)
                    shard = []
                last = key
                shard.append(tuple(rest))
        if found := spans(shard):
            yield _batch(found, SPANS)

    return run


def _bucketed(docs: DataFrame) -> DataFrame:
    """doc, row (numbers the rows of one doc_id) and text, as a table in the shared folder in buckets by doc."""
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").alias("doc"), "text")
    several = source.where("doc is not null").groupBy("doc").count().where("count > 1")
    if several.isEmpty():
        source = source.select("doc", F.lit(0).alias("row"), "text")
    else:
        source = source.select("doc", (F.row_number().over(Window.partitionBy("doc").orderBy("text")) - 1).alias("row"), "text")
    n = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(min(50_000, max(4, n // (2 * BUCKET_BYTES))))
    path = new_path(spark, "substring")
    name = "substring_" + path.rpartition("-")[2]
    # every task writes a part of each bucket; far more tasks than buckets are dealt out by bucket first
    parts = source.repartition(buckets, "doc") if source.rdd.getNumPartitions() > 4 * 64 else source
    parts.write.bucketBy(buckets, "doc").option("path", path).saveAsTable(name)
    found = spark.table(name)
    found.schema  # resolved here; the files stay, and only the name leaves the catalog
    spark.sql(f"drop table {name}")
    return found


def repeated_spans(docs: DataFrame, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """The working table (doc, row, text) of ``docs`` with an integer doc_id, and per doc_id the spans of words that smaller documents have: doc, spans."""
    table = _bucketed(docs)
    total = table.where("doc is not null").count()
    share = min(1.0, SAMPLE / max(1, total))
    sample = table.where(F.pmod(F.xxhash64(F.lit(17), "doc"), F.lit(1 << 20)) < int(share * (1 << 20)))  # about SAMPLE documents
    none = np.zeros(0, np.uint64)

    def often(rows: DataFrame) -> np.ndarray:
        found = rows.groupBy("key").agg(F.count_distinct("doc").alias("n")).where(F.col("n") >= FREQUENT).select("key").toArrow()
        return np.sort(found.column(0).to_numpy().view(np.uint64))  # at most an eighth of the sample's pieces

    frequent = often(sample.mapInArrow(_cut(none, none), CUT))
    repeated = often(sample.mapInArrow(_cut(frequent, none), CUT).where(F.col("place").bitwiseAND(1) == 1)) if len(frequent) else none
    states = table.mapInArrow(_cut(frequent, repeated), CUT).repartition("key").sortWithinPartitions("key").mapInArrow(_judge(shard), STATES)
    per_doc = materialize(states.groupBy("doc").agg(F.collect_list(F.struct(*(c for c in states.columns if c != "doc"))).alias("states")), "states")  # at most the pieces of one document
    waiting = per_doc.select("doc", F.filter("states", lambda s: s["state"] == OPEN).alias("states")).where(F.size("states") > 0)
    opened = table.join(waiting, "doc").select("doc", "row", "text", "states").mapInArrow(_open_pieces, PIECES)
    opened = materialize(opened, "pieces")
    matched = opened.where("not frequent").repartition("key").sortWithinPartitions("key").mapInArrow(_match(shard), SPANS)
    windows = opened.where("frequent")
    smallest = windows.groupBy("words").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("most > least").select("words", "least")
    whole = windows.join(smallest, "words").where("doc > least").select("doc", "row", "start", F.lit(WINDOW).alias("size"))
    late = matched.unionByName(whole).groupBy("doc").agg(F.collect_list(F.struct("row", "start", "size")).alias("late"))
    early = F.transform(F.filter("states", lambda s: s["state"] == FOUND), lambda s: F.struct(s["row"].alias("row"), s["start"].alias("start"), (s["windows"] + WINDOW - 1).alias("size")))
    nothing = F.expr("cast(array() as array<struct<row:int,start:int,size:int>>)")
    both = per_doc.select("doc", early.alias("early")).join(late, "doc", "left")
    return table, both.select("doc", F.concat("early", F.coalesce("late", nothing)).alias("spans"))


def _of_any_ids(docs: DataFrame, shard: int) -> DataFrame:
    """``remove_repeats`` where doc_ids are no integers: each distinct id is numbered in their order, and the numbers stand in for the ids."""
    ids = materialize(number_rows(docs.select(F.col("doc_id").alias("id")).where("id is not null").distinct(), "id", name="number"), "substring-ids")
    numbered = docs.select(F.col("doc_id").alias("id"), "text").join(ids, "id", "left").select(F.col("number").alias("doc_id"), "text")
    out = remove_repeats(materialize(numbered, "substring-docs"), shard).withColumnRenamed("doc_id", "number")
    return out.join(ids, "number", "left").select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept")


def remove_repeats(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """Columns doc_id, n_words, n_removed and kept (the words that stay, joined by one space), one row per row of ``docs``.

    Words stand between ASCII white space. A word goes if a window of ``WINDOW`` words of its document covers it whose words
    also start in a document with a smaller doc_id, in the order that Spark sorts its type by (strings: bytewise); all windows are judged on the input. Rows without doc_id lose
    nothing and count nowhere; null and short texts have no windows; rows of one doc_id are no references for each
    other; other columns are ignored; no rows give no rows.

    An automaton of the whole corpus, or all of its shards one after another, would have to meet every document. Here a
    window's anchor decides its shard, so a document's pieces meet only the automata of shards that can hold their
    windows. Pieces that are equal as wholes are settled by their hashes; the automata judge those that share an anchor
    but differ, each against the pieces of all smaller documents. An anchor with more than ``shard`` such pieces goes window by
    window instead, so that no automaton outgrows two shards.
    """
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        return _of_any_ids(docs, shard)
    table, spans = repeated_spans(docs, shard)
    joined = table.join(spans, "doc", "left").select("doc", "row", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            counts, removed, kept = [], [], []
            flat = batch.column(3).flatten()
            rows, starts, sizes = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            ends = np.cumsum([len(x) if x.is_valid else 0 for x in batch.column(3)])
            for i, (row, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                words = (text or "").encode().split()
                own = slice(ends[i - 1] if i else 0, ends[i])
                own = np.flatnonzero(rows[own] == row) + own.start
                counts.append(len(words))
                if len(own):
                    depth = np.zeros(len(words) + 1, np.int32)
                    np.add.at(depth, starts[own], 1)
                    np.add.at(depth, starts[own] + sizes[own], -1)
                    words = [words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
                removed.append(counts[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")
