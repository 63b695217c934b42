"""Near-duplicate texts by BagMinHash: weighted-Jaccard signatures of shingle multisets, banded and verified."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.llm.common import key_bitmap, keep_rows, lookup_by_hot_key, materialize, row_id, with_hit
from corpuskiln.llm.components import connected_components
from corpuskiln.llm.words import WordHashes, mix, shingles, sliced

BANDS, ROWS = 24, 5
SHINGLE, SIMILARITY = 5, 0.8
#: Frequent buckets that are sought by a sketch; one with more than 1/6144 of the rows is never missed.
HOT_BUCKETS = 8192
#: Texts that meet one copy of their hub's text.
FAN = 500
#: Bytes of text on each side of a tile, about.
TILE_BYTES = 1 << 20
#: Words whose signatures are made together.
BATCH_WORDS = 200_000
#: Room for rounding in distances and weights.
SLACK = 1e-9
_STEP = np.uint64(0xD1B54A32D192ED03)


def bag(words: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The multiset of shingles: sorted hashes and how often each occurs."""
    return np.unique(shingles(words, n), return_counts=True)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of least over sum of largest counts; 0 if a bag is empty."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = int(np.minimum(a[1][i], b[1][j]).sum())
    return low / (int(a[1].sum()) + int(b[1].sum()) - low)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], m: int = BANDS * ROWS) -> np.ndarray:
    """One row of ``m`` times per bag; two rows agree in a component with the probability of the bags' weighted Jaccard.

    Weights, here counts, are cut at the levels 1, 2, 3 and so on. A Poisson process over (level, time) is dealt out to
    the m components; its levels are halved again and again: [0, 1), [1, 2), [2, 4), [4, 8), and a point's place within
    its node is the path down. A bag sees the points below its weight, and each component keeps the earliest. Points come
    in order of time, so a node is left as soon as it is later than all that its bag still needs.
    """
    doc = np.repeat(np.arange(len(bags)), [len(u) for u, _ in bags])
    if not len(doc):
        return np.full((len(bags), m), np.inf)
    shingle, weight = np.concatenate([u for u, _ in bags]).astype(np.uint64), np.concatenate([c for _, c in bags]).astype(np.uint64)
    parts, low, width = [], 0, 1
    while True:
        some = np.flatnonzero(weight > low)
        if not len(some):
            break
        parts.append((some, np.full(len(some), low, np.uint64), np.full(len(some), width, np.uint64)))
        low, width = low + width, max(1, low + width)
    some, low_at, width_at = (np.concatenate(x) for x in zip(*parts, strict=True))
    doc, limit = doc[some], weight[some]
    with np.errstate(over="ignore"):
        seed = mix(shingle[some] ^ mix(low_at + np.uint64(1)))
    time, rate = np.zeros(len(doc)), width_at.astype(np.float64)
    least = np.full(len(bags) * m, np.inf)
    k = np.uint64(0)
    while len(doc):
        with np.errstate(over="ignore"):
            k += np.uint64(1)
            a, b = mix(seed + k * _STEP), mix(seed ^ (k * _STEP))
        time = time - np.log((np.right_shift(a, np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
        component = ((b >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        level = low_at + (((b & np.uint64(0xFFFFFFFF)) * width_at) >> np.uint64(32))
        seen = level < limit
        np.minimum.at(least, doc[seen] * m + component[seen].astype(np.int64), time[seen])
        needed = least.reshape(-1, m).max(axis=1)
        more = time < needed[doc]
        doc, limit, seed, time, rate, low_at, width_at = (x[more] for x in (doc, limit, seed, time, rate, low_at, width_at))
    return least.reshape(-1, m)


def band_keys(rows: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature, different for different bands."""
    bits = rows.view(np.uint64).reshape(len(rows), BANDS, ROWS)
    h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), (len(rows), BANDS)).copy()
    with np.errstate(over="ignore"):
        for i in range(ROWS):
            h = mix(h * _STEP + bits[:, :, i])
    return h.view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memory = WordHashes()

    def made(ids: pa.Array, texts: list[bytes], bags: list) -> pa.RecordBatch:
        keys = band_keys(signatures(bags)).tolist()
        weights = [int(c.sum()) for _, c in bags]
        columns = [
            ids,
            pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
            pa.array(weights, pa.int64()),
            pa.array([k if w else [] for k, w in zip(keys, weights, strict=True)], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "weight", "bands"])

    for batch in sliced(batches):
        texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
        start, words, bags = 0, 0, []
        for i, t in enumerate(texts):
            found = t.split()
            words += len(found)
            bags.append(bag(memory.of(found)))
            if words >= BATCH_WORDS or i + 1 == len(texts):
                yield made(batch.column(0).slice(start, len(bags)), texts[start : i + 1], bags)
                start, words, bags = i + 1, 0, []


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The similarity of texts (b, side, a, text) to the hub b whose own row, of side 0, comes before them."""
    memory, held = WordHashes(), None
    for batch in sliced(batches):
        out: tuple[list, list, list] = ([], [], [])
        for b, side, a, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = bag(memory.of((text or "").encode().split()))
            if side == 0:
                held = own
            else:
                for column, x in zip(out, (a, b, weighted_jaccard(own, held)), strict=True):
                    column.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["a", "b", "similarity"])


def _similarities(rows: DataFrame, hubs: DataFrame) -> DataFrame:
    """Columns a, b, similarity of texts ``rows`` (a, b, parts, text) and their hubs ``hubs`` (b, parts, text).

    A hub with many texts is repeated for ``parts`` parts of them, so no task gets all texts of one hub; each text is moved once.
    """
    salt = F.pmod(F.xxhash64("a"), F.col("parts")).cast("int")
    texts = rows.select("b", salt.alias("salt"), F.lit(1).alias("side"), "a", "text")
    own = hubs.select("b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), F.lit(0).alias("side"), F.col("b").alias("a"), "text")
    dealt = texts.unionByName(own).repartition("b", "salt").sortWithinPartitions("b", "salt", "side")
    return dealt.select("b", "side", "a", "text").mapInArrow(_met, "a long, b long, similarity double")


def _stars(classes: DataFrame, least: float) -> DataFrame:
    """Columns cid, hub (the least cid of a bucket) and ratio (lesser by greater weight, which no similarity exceeds), one row per pair.

    Frequent buckets are found by a frequent-items sketch and their rows are not moved; of the others, one shuffle
    brings together 16 bytes for each text and band.
    """
    members = classes.where("rep is not null").select("cid", F.explode("bands").alias("bucket"))
    sketch = members.agg(F.expr(f"approx_top_k(bucket, {HOT_BUCKETS}, {HOT_BUCKETS})").alias("top"))
    proposed = sketch.select(F.explode("top").alias("x")).where("x.count > 1000").select(F.col("x.item").alias("bucket"))
    hot = members.join(F.broadcast(proposed), "bucket").groupBy("bucket").agg(F.min("cid").alias("hub"))
    hot = materialize(hot.coalesce(1), "hot-buckets")  # HOT_BUCKETS at most
    same = Window.partitionBy("bucket")
    cold = members.join(F.broadcast(hot.select("bucket")), "bucket", "left_anti").withColumns({"hub": F.min("cid").over(same), "n": F.count(F.lit(1)).over(same)})
    pairs = cold.where("n > 1 and cid <> hub").select("cid", "hub").unionByName(members.join(F.broadcast(hot), "bucket").where("cid <> hub").select("cid", "hub")).distinct()
    pairs = pairs.join(classes.select("cid", "weight"), "cid").join(classes.select(F.col("cid").alias("hub"), F.col("weight").alias("hub_weight")), "hub")
    return materialize(pairs.select("cid", "hub", "weight", (F.least("weight", "hub_weight") / F.greatest("weight", "hub_weight")).alias("ratio")), "stars")


def _fans(pairs: DataFrame) -> DataFrame:
    """Columns b and parts, in how many parts the texts a of each hub b meet it."""
    return pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / FAN).cast("int").alias("parts"))


def near_classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Columns doc_id, digest, class_id, class_digest and copies, one row per row of ``docs``; see ``near_duplicates``.

    ``class_digest`` is that of the group's first text: the least digest among the texts of class_id.
    """
    source = docs.select("doc_id", "text")
    kind = dict(docs.dtypes)["doc_id"]
    signed = materialize(source.mapInArrow(_signed, f"doc_id {kind}, digest binary, weight long, bands array<long>"), "signatures")
    total = signed.count()
    classes = signed.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("weight").alias("weight"), F.first("bands").alias("bands"))  # equal texts have equal signatures
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    stars = _stars(classes, least)

    # every text meets the first hub that its weight allows
    able = stars.where(F.col("ratio") >= least)
    first = able.groupBy("cid").agg(F.min("hub").alias("b"))
    fans = materialize(_fans(first), "fans")
    first = first.join(fans, "b").select("cid", "b", "parts")
    needed = stars.select("cid").union(stars.select("hub")).distinct()
    needed = needed.join(classes.select("cid", "rep", "digest"), "cid").join(first, "cid", "left").join(fans.select(F.col("b").alias("cid"), F.col("parts").alias("fan")), "cid", "left")
    needed = materialize(needed, "needed")
    keyed = source.where("doc_id is not null").select(F.col("doc_id").alias("rep"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = with_hit(keyed, key_bitmap(needed, "rep"), "rep").where("hit").select("rep", F.unhex(F.sha2("text", 256)).alias("digest"), "text")
    texts = keyed.groupBy("rep", "digest").agg(F.first("text").alias("text")).join(needed, ["rep", "digest"])
    texts = materialize(texts.select("cid", "b", "parts", "fan", "text"), "texts")
    sims = materialize(_similarities(texts.where("b is not null").select(F.col("cid").alias("a"), "b", "parts", "text"), texts.where("fan is not null").select(F.col("cid").alias("b"), F.col("fan").alias("parts"), "text")), "similarities")

    links = sims.where(F.col("similarity") >= least)
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("component"))  # a forest: every text has one link, to a lesser one
    up = roots.select(F.col("node").alias("component"), F.col("component").alias("above"))
    roots = materialize(roots.join(up, "component", "left").select("node", F.coalesce("above", "component").alias("component")), "roots")
    other = able.select(F.col("cid").alias("a"), F.col("hub").alias("b")).join(sims.select("a", "b"), ["a", "b"], "left_anti")
    other = materialize(_apart(other, roots), "pairs")
    plain = texts.select("cid", "text")
    more = materialize(_pairs_met(other, plain), "similarities")
    links = roots.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more.where(F.col("similarity") >= least).select("a", "b"))
    groups = _grouped(roots, links)
    third = materialize(_rest(_placed(stars, sims.unionByName(more), groups), plain, least), "links")
    groups = groups if third.isEmpty() else _grouped(groups, third)

    groups = groups.unionByName(groups.select(F.col("component").alias("node"), "component")).distinct()  # roots are nodes too
    leads = groups.join(classes.select(F.col("cid").alias("node"), "rep", "digest"), "node").select("node", "component", F.struct("rep", "digest").alias("lead"))
    whole = materialize(leads.groupBy("component").agg(F.min("lead").alias("head"), F.count(F.lit(1)).alias("n")), "heads")
    leads = lookup_by_hot_key(leads.select("node", "component"), whole, "component", total).select("node", "head")
    named = classes.join(leads, classes["cid"] == leads["node"], "left").select("digest", "n", F.coalesce(F.col("head.rep"), "rep").alias("class_id"), F.coalesce(F.col("head.digest"), "digest").alias("class_digest"))
    out = lookup_by_hot_key(signed.select("doc_id", "digest"), materialize(named, "named"), "digest", total)
    return out.select("doc_id", "digest", "class_id", "class_digest", F.col("n").alias("copies"))


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Columns doc_id, class_id (the least doc_id of its group) and copies (rows with an equal text), one row per row of ``docs``.

    Two texts are linked if the weighted Jaccard of their multisets of five-word shingles is ``least`` or more; groups are the
    connected components. Words stand between ASCII white space; a text of one to four words is one shingle, and texts
    without words, null as empty, are grouped only with equal texts. Equal texts are one class and never compared.
    Candidates share a band of their signatures (a pair of 0.8 is missed with a chance of 7e-5); no other pair is left out but by proof.
    Within a band's bucket every text is verified against the bucket's hub. What that leaves apart is compared only where the
    distances to the hub (one less the similarity, which keeps the triangle inequality) and the weights allow a link, so a bucket's texts are
    linked as all its pairs would link them, but most texts of a large group cost one verification. A doc_id that stands with several
    texts takes part with each. Rows without doc_id take part only through an equal text that has one, else
    their class_id is null. Other columns are ignored; no rows give no rows.
    """
    return near_classes(docs, least).select("doc_id", "class_id", "copies")


def _pairs_met(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Columns a, b, similarity of ``pairs`` (a, b), whose texts are looked up in ``texts`` (cid, text)."""
    fans = _fans(pairs)
    rows = pairs.join(fans, "b").join(texts, F.col("a") == F.col("cid")).select("a", "b", "parts", "text")
    return _similarities(rows, fans.join(texts, F.col("b") == F.col("cid")).select("b", "parts", "text"))


def _placed(stars: DataFrame, sims: DataFrame, groups: DataFrame) -> DataFrame:
    """Columns hub, cid, weight, component, core (the hub's component) and low, high: what is known of the distance to the hub."""
    known = sims.select(F.col("a").alias("cid"), F.col("b").alias("hub"), (1 - F.col("similarity")).alias("d"))
    rows = stars.join(known, ["cid", "hub"], "left").join(groups.select(F.col("node").alias("cid"), "component"), "cid", "left")
    rows = rows.join(groups.select(F.col("node").alias("hub"), F.col("component").alias("core")), "hub", "left")
    low, high = F.coalesce("d", F.greatest(1 - F.col("ratio"), F.lit(0.0))), F.coalesce("d", F.lit(1.0))
    return materialize(rows.select("hub", "cid", "weight", F.coalesce("component", "cid").alias("component"), F.coalesce("core", "hub").alias("core"), low.alias("low"), high.alias("high")), "placed")


def _rest(placed: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links (a, b) between texts of one hub that no group joins yet.

    A text is loose beside a hub if it is not in the hub's group. It may be linked to a text whose distance to the hub differs by
    1 - least at most; where a hub's texts fill more than a tile, they are dealt out to cells by that distance, a loose text to all cells that hold
    such texts. Cells without texts of different groups are left; the others are cut to tiles of bounded bytes, from which
    only links leave, so no pairs are written.
    """
    reach = 1 - least
    last = int(1 / reach) + 1
    sized = placed.join(texts.select("cid", F.octet_length("text").alias("size")), "cid")
    loose = placed.where("component <> core").groupBy("hub").agg(F.count(F.lit(1)).alias("loose"))
    whole = sized.groupBy("hub").agg(F.sum("size").alias("bytes"), F.min("component").alias("one"), F.max("component").alias("other")).where("one <> other").join(loose, "hub").select("hub", (F.col("bytes") > TILE_BYTES).alias("large"))
    rows = materialize(sized.join(whole, "hub"), "rest")
    if rows.isEmpty():
        return placed.sparkSession.createDataFrame([], "a long, b long")
    at = lambda x: F.when(F.col("large"), F.least(F.greatest(F.floor(x / reach), F.lit(0)), F.lit(last))).otherwise(0).cast("int")
    every = lambda a, b: F.explode(F.sequence(a, b))
    left = rows.where("component <> core").withColumn("x", every(at(F.col("low") - reach - SLACK), at(F.col("high") + reach + SLACK)))
    right = rows.withColumn("x", every(at(F.col("low")), at(F.col("high"))))
    cell = ["hub", "x"]
    shape = lambda rows, n: rows.groupBy(*cell).agg(F.least(F.floor(F.sum("size") / TILE_BYTES) + 1, F.count(F.lit(1))).cast("int").alias(n), F.min("component").alias(f"{n}_min"), F.max("component").alias(f"{n}_max"))
    shape = shape(left, "n").join(shape(right, "m"), cell).where("n_min <> n_max or m_min <> m_max or n_min <> m_min").select(*cell, "n", "m")
    shape = materialize(shape, "cells")
    block = lambda n: F.pmod(F.xxhash64(F.lit(9), "cid"), F.col(n)).cast("int")
    # a loose text is of both sides; in a cell that is one tile it is moved once
    once = (F.col("n") == 1) & (F.col("m") == 1)
    dealt = left.join(shape, cell).withColumn("i", block("n")).withColumn("j", every(F.lit(0), F.col("m") - 1)).withColumn("side", F.lit(0))
    dealt = dealt.unionByName(right.join(shape, cell).withColumn("j", block("m")).withColumn("i", every(F.lit(0), F.col("n") - 1)).withColumn("side", F.lit(1)))
    dealt = dealt.select(*cell, "i", "j", "side", "cid", "component", "core", "weight", "low", "high", once.alias("once")).where("not (once and side = 1 and component <> core)")
    tiles = dealt.join(texts, "cid")
    return tiles.groupBy(*cell, "i", "j").applyInPandas(lambda pdf: _tile_links(pdf, least), "a long, b long")


def _tile_links(rows: pd.DataFrame, least: float) -> pd.DataFrame:
    """Links (a, b) of the loose texts of a tile, one for each text and group at most; a tile may lack a side, as blocks are cut by a hash.

    Texts of other weights or other distances to the hub than a link allows are passed over. Texts that links have joined are one group from then on.
    """
    rows = rows.sort_values(["weight", "cid"])
    made = {r: bag(memory.of((t or "").encode().split())) for memory in [WordHashes()] for r, t in zip(rows["cid"], rows["text"], strict=True)}
    left, right = rows[rows["side"] == 0], rows[(rows["side"] == 1) | rows["once"]]
    links: list[tuple[int, int]] = []
    if not len(left) or not len(right):
        return pd.DataFrame(links, columns=["a", "b"])
    nodes, weights, low, high = (right[c].to_numpy() for c in ("cid", "weight", "low", "high"))
    names, index = np.unique(np.concatenate([right["component"].to_numpy(), left["component"].to_numpy()]), return_inverse=True)
    of, mine = index[: len(right)].copy(), index[len(right) :].copy()
    hashes, counts = (np.concatenate([made[r][k] for r in nodes]) for k in range(2))
    order = np.argsort(hashes, kind="stable")  # where each shingle occurs on the right side
    hashes, counts, owner = hashes[order], counts[order], np.repeat(np.arange(len(nodes)), [len(made[r][0]) for r in nodes])[order]
    reach = 1 - least + SLACK
    for k, (a, w, lo, hi) in enumerate(zip(*(left[c] for c in ("cid", "weight", "low", "high")), strict=True)):
        first, end = np.searchsorted(weights, w * least * (1 - SLACK), "left"), np.searchsorted(weights, w / least * (1 + SLACK), "right")
        some = slice(first, end)
        open_ = (of[some] != mine[k]) & (lo - high[some] <= reach) & (low[some] - hi <= reach)
        if not open_.any():
            continue
        u, c = made[a]
        begin = np.searchsorted(hashes, u, "left")
        many = np.searchsorted(hashes, u, "right") - begin
        at = np.repeat(begin - np.cumsum(many) + many, many) + np.arange(many.sum())
        both = np.bincount(owner[at], np.minimum(counts[at], np.repeat(c, many)), len(nodes))[some]
        near = first + np.flatnonzero((both / (w + weights[some] - both) >= least) & open_)
        joined, one = np.unique(of[near], return_index=True)
        links += [(a, b) for b in nodes[near[one]]]
        if len(joined):
            of[np.isin(of, joined)] = mine[k]
            mine[np.isin(mine, joined)] = mine[k]
    return pd.DataFrame(links, columns=["a", "b"])


def _grouped(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups`` (node, component; others are their own) after more links (a, b), of which only those between groups matter."""
    of = lambda c: groups.select(F.col("node").alias(c), F.col("component").alias(f"{c}_group"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("a_group", "a").alias("a"), F.coalesce("b_group", "b").alias("b"))
    joined = materialize(connected_components(between, "a", "b"), "joined").select(F.col("node").alias("component"), F.col("component").alias("whole"))
    new = joined.join(groups.select(F.col("node").alias("component")), "component", "left_anti").select(F.col("component").alias("node"), F.col("whole").alias("component"))
    return materialize(groups.join(joined, "component", "left").select("node", F.coalesce("whole", "component").alias("component")).unionByName(new), "groups")


def _apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that no group joins yet."""
    of = lambda c: groups.select(F.col("node").alias(c), F.col("component").alias(f"{c}_group"))
    both = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return both.where(F.coalesce("a_group", "a") != F.coalesce("b_group", "b")).select("a", "b")


def near_dedup(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, with all columns, that are the first text of their group, that of its least doc_id.

    Of rows equal in doc_id and text one stays; a doc_id with several texts keeps each that is first in a group. Rows without doc_id stay. Columns may
    have any names. Only rows that go, or that are repeated, are moved.
    """
    found = near_classes(docs, least).where("doc_id is not null")
    marks = found.groupBy(row_id().alias("id"), "digest").agg(F.count(F.lit(1)).alias("n"), F.first((F.col("doc_id") == F.col("class_id")) & (F.col("digest") == F.col("class_digest"))).alias("keep"))
    marks = marks.where("n > 1 or not keep").drop("n")
    return keep_rows(docs, materialize(marks, "marks"))
