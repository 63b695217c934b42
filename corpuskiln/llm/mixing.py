"""Mixing sources to target weights by subset-sum budget fitting."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.llm.common import lookup_by_hot_key, materialize, row_id, word_count

#: Words that the exact fit may use at most, whatever the size of the source.
DP_WORDS = 1 << 16
#: Documents that are ranked together; larger groups of one source and size are cut by their hash.
RANKED_TOGETHER = 1000


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """Adds ``target`` to ``sizes`` (source, source_size, one row per source).

    Sources by code point, null last, take ``weights`` in turn and share the sum of all sizes by them. A target stops at
    ``max_repeats`` times its source's size; the excess goes to the others by weight until none is above. Only four sums
    go to the driver in each round.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())  # sources, not documents: one row each
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    ranked = materialize(sizes.withColumn("w", w).withColumn("cap", F.col("source_size").cast("double") * max_repeats), "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, capped = None, 0
    while True:
        over = F.lit(False) if level is None else F.col("w") * F.lit(level) >= F.col("cap")
        s = ranked.agg(F.sum(F.when(over, F.col("cap")).otherwise(0.0)).alias("used"), F.sum(F.when(over, 0.0).otherwise(F.col("w"))).alias("w"), F.sum(over.cast("int")).alias("n")).first()
        if not s["w"] or (level is not None and s["n"] == capped):
            break
        level, capped = (total - s["used"]) / s["w"], s["n"]
    share = F.lit(0.0) if level is None else F.col("w") * F.lit(level)
    return ranked.withColumn("target", F.least(share, F.col("cap")))


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int, dp_words: int = DP_WORDS, above: bool = False) -> np.ndarray:
    """How many documents of each size (distinct, above 0) to take, so that their sum comes as near to ``budget`` as can be, not above it unless ``above``.

    All but about ``dp_words`` of the budget is spread evenly over the sizes, each length's rounding being carried on to
    the next shorter one. A bounded knapsack over the documents that are left fits the remaining words: ``first[s]`` is the
    item that first reached the sum s, so the way back needs no table of all items.
    """
    take = np.zeros(len(sizes), dtype=np.int64)
    whole = int((sizes * counts).sum())
    if budget >= whole:
        return counts.astype(np.int64)
    order = np.argsort(-sizes, kind="stable")
    share, carry = max(0, budget - dp_words) / whole, 0.0
    for i in order:
        carry += share * float(sizes[i] * counts[i])
        take[i] = min(int(counts[i]), int(carry // sizes[i]))
        carry -= float(take[i] * sizes[i])
    rest = budget - int((take * sizes).sum())
    for i in order:  # long documents may leave more than the exact fit can hold
        if rest <= dp_words:
            break
        n = min(int(counts[i] - take[i]), (rest - dp_words) // int(sizes[i]))
        take[i] += n
        rest -= n * int(sizes[i])
    left = counts - take
    if rest > 2 * dp_words:  # each document left is longer than rest - dp_words, over half of rest: at most one fits, and no sum of three is near
        some = np.sort(np.repeat(sizes, np.minimum(left, 2)))
        sums = [0, *some.tolist(), *([int(some[:2].sum())] if len(some) > 1 else [])]
        best = min((x for x in sums if x <= rest or above), key=lambda x: (abs(rest - x), x))
        single = sizes[left > 0] == best
        for size in [best] if single.any() else some[:2].tolist() if best else []:
            take[sizes == size] += 1
        return take
    more, at = _knapsack(sizes, left, order, rest, rest)
    if above and at < rest:  # a sum above is nearer only if it is less than rest - at above
        over, up = _knapsack(sizes, left, order, rest, 2 * rest - at - 1)
        more = over if up > rest else more
    return take + more


def _knapsack(sizes: np.ndarray, left: np.ndarray, order: np.ndarray, rest: int, most: int) -> tuple[np.ndarray, int]:
    """Which of the ``left`` documents sum up to ``rest``, or to the least sum above it up to ``most``, else to the largest below; and the sum."""
    take, first, items = np.zeros(len(sizes), dtype=np.int64), np.full(most + 1, -1, dtype=np.int64), []
    reached = np.zeros(most + 1, dtype=bool)
    reached[0] = True
    for i in order:
        n, many = min(int(left[i]), most // int(sizes[i])), 1
        while n > 0 and not reached[rest]:
            many = min(many, n)
            step = many * int(sizes[i])
            new = reached[: most + 1 - step] & ~reached[step:]
            if new.any():
                first[step:][new] = len(items)
                reached[step:] |= new
                items.append((i, many))
            n, many = n - many, many * 2
        if reached[rest]:
            break
    up = np.flatnonzero(reached[rest:])
    at = found = rest + int(up[0]) if len(up) else int(np.flatnonzero(reached)[-1])
    while at:
        i, many = items[first[at]]
        take[i] += many
        at -= many * int(sizes[i])
    return take, found


def _plans(max_repeats: int):
    def plan(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in groups:
            whole, target = int(g["source_size"].iloc[0]), float(g["target"].iloc[0])
            epochs = min(max_repeats, int(target // whole)) if whole else 0
            some = g["size"].to_numpy() > 0
            extra = np.zeros(len(g), dtype=np.int64)
            if epochs < max_repeats and some.any():
                extra[some] = fit(g["size"].to_numpy()[some], g["n"].to_numpy()[some], int(round(target)) - epochs * whole, above=True)
            yield g[["source", "size", "n"]].assign(epochs=epochs, extra=extra)

    return lambda pdf: next(plan(iter([pdf])))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_repeats: int = 3, seed: int = 7, size: Column | None = None) -> DataFrame:
    """Columns doc_id, size, source_size, target, copies and taken (copies times size), one row per row of ``docs``.

    ``size`` is the number of words by default (null text: 0). Each source is repeated as a whole as often as fits its
    target; the rest is a subset of its documents, as near to the target as can be on either side, chosen by ``fit`` over the counts of exact sizes and, within a size, by
    a hash of doc_id and ``seed``, so reruns agree. Documents without words take part in whole repeats only. Equal
    doc_ids are documents of their own; null sources are one source, last in order; no rows give no rows.
    """
    rows = docs.select("doc_id", "source", (word_count(F.col("text")) if size is None else size.cast("long")).alias("size"))
    return _mixed(rows, weights, max_repeats, seed).select("doc_id", "size", "source_size", "target", "copies", "taken")


def _mixed(rows: DataFrame, weights: tuple[float, ...], max_repeats: int, seed: int) -> DataFrame:
    """``rows`` (doc_id, source, size and others) with source_size, target, copies and taken."""
    carried = [c for c in rows.columns if c not in ("doc_id", "source", "size")]
    rows = materialize(rows, "sizes")
    total = rows.count()
    lengths = rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    targets = source_targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, max_repeats)
    targets = materialize(targets.select("source", "source_size", "target"), "targets")
    key = lambda *c: F.xxhash64(*c)
    joined = lengths.withColumn("k", key("source")).join(targets.withColumn("k", key("source")).withColumnRenamed("source", "s"), "k").where(F.col("source").eqNullSafe(F.col("s")))
    plan = joined.groupBy("source").applyInPandas(_plans(max_repeats), "source string, size long, n long, epochs int, extra long")
    plan = materialize(plan, "plan").withColumn("key", F.concat_ws("\x00", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")), "size"))
    keyed = rows.withColumn("key", F.concat_ws("\x00", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")), "size"))
    found = lookup_by_hot_key(keyed, plan.select("key", "n", "epochs", "extra"), "key", total)
    # a uniform hash cuts each group of one source and size into slices of about RANKED_TOGETHER; whole slices are taken by their counts
    h = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 40))
    sliced = found.withColumn("h", h).withColumn("slice", F.floor(F.col("h") * F.ceil(F.col("n") / RANKED_TOGETHER) / F.lit(1 << 40)))
    counts = sliced.groupBy("key", "slice").agg(F.count(F.lit(1)).alias("m"))
    upto = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("before", F.coalesce(F.sum("m").over(upto), F.lit(0))).select("key", "slice", "before")
    rank = F.row_number().over(Window.partitionBy("key", "slice").orderBy("h", "doc_id"))
    placed = sliced.join(before, ["key", "slice"]).withColumn("no", rank + F.col("before"))
    copies = (F.col("epochs") + (F.col("no") <= F.col("extra")).cast("int")).cast("long")
    out = placed.select("doc_id", "source", "size", *carried, copies.alias("copies"), (copies * F.col("size")).alias("taken"))
    by = targets.select(key("source").alias("k"), F.col("source").alias("s"), "source_size", "target")
    return out.withColumn("k", key("source")).join(by, "k").where(F.col("source").eqNullSafe(F.col("s")))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_repeats: int = 3, seed: int = 7) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all columns, which may have any names.

    Rows equal in doc_id, source and text share their copies in order. Texts are moved once, to the copies of their key.
    """
    digest = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    kept = _mixed(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), digest.alias("digest")), weights, max_repeats, seed).where("copies > 0")
    key = ["id", "origin", "digest"]
    origin = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("-")).alias("origin")
    copies = F.collect_list(F.struct("copies", "rows"))  # a few numbers of copies for each key
    picks = kept.groupBy(row_id().alias("id"), origin, "digest", "copies").agg(F.count(F.lit(1)).alias("rows")).groupBy(*key).agg(F.sort_array(copies, asc=False).alias("shares"))
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), row_id().alias("id"), origin, digest.alias("digest"))
    joined = packed.join(picks, key).withColumn("no", F.row_number().over(Window.partitionBy(*key).orderBy("id")))
    start = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("copies"))
    share = lambda a, x: F.when(F.col("no") <= a["upto"], a).otherwise(F.struct((a["upto"] + x["rows"]).alias("upto"), x["copies"].alias("copies")))
    mine = F.aggregate("shares", start, share)
    mine = F.when(F.col("no") <= mine["upto"], mine["copies"]).otherwise(0)
    return joined.where(mine > 0).select("row", F.explode(F.sequence(F.lit(1), mine.cast("int"))).alias("copy")).select("row.*")
