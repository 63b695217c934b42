"""Near-duplicate vectors: int8 tile products with error bounds, pruned by the angles between cells."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.common import lookup_by_hot_key, materialize
from corpuskiln.llm.components import connected_components

#: Cells, vectors that their centres are fitted on (about), and vectors in a block.
CELLS, FIT_ROWS, BLOCK = 64, 8192, 4096
#: Rows of a tile that are multiplied at once, and dimensions whose int8 products stay exact in single precision.
ROWS, EXACT_DIMENSIONS = 64, 1024
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: not null, not zero, all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square over- or underflows."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def quantise(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes of unit rows, the scale of each row, and the length of what the codes leave out."""
    scale = np.abs(rows).max(axis=1) / 127
    codes = np.rint(rows / scale[:, None]).astype(np.int8)
    return codes, scale, np.sqrt(((rows - codes * scale[:, None]) ** 2).sum(axis=1))


def code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 codes; single precision holds sums of up to 1024 of them."""
    total = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], EXACT_DIMENSIONS):
        total += a[:, k : k + EXACT_DIMENSIONS].astype(np.float32) @ b[:, k : k + EXACT_DIMENSIONS].astype(np.float32).T
    return total


def linked(a: np.ndarray, b: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) with a cosine of ``least`` or more between unit rows, some rows of ``a`` at a time.

    With u = s q + e for both rows, their product differs from that of the codes by at most |e| + |f| + |e||f|. Pairs
    that the bound puts above ``least`` are taken, those below are left; only the others are computed anew.
    """
    qa, sa, ea = quantise(a)
    qb, sb, eb = quantise(b)
    for at in range(0, len(a), ROWS):
        part = slice(at, at + ROWS)
        near = code_products(qa[part], qb)
        near *= sa[part, None]
        near *= sb[None, :]
        slack = ea[part].max() + eb + ea[part].max() * eb + SLACK  # by column, for the largest error among these rows
        i, j = np.nonzero(near >= least - slack)
        sure = near[i, j] - slack[j] >= least
        open_ = np.flatnonzero(~sure)
        for k in range(0, len(open_), 1 << 16):
            some = open_[k : k + (1 << 16)]
            sure[some] = (a[at + i[some]] * b[j[some]]).sum(axis=1) >= least
        yield at + i[sure], j[sure]


def lowest_reached(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` nodes the least node that the edges reach."""
    low = np.arange(n)
    while True:
        before = low.copy()
        np.minimum.at(low, left, low[right])
        np.minimum.at(low, right, low[left])
        low = low[low]
        if (low == before).all():
            return low


def _tile(rows: pd.DataFrame, least: float) -> pd.DataFrame:
    """Of each vector with a link in this tile: cid, links (copies of its partners) and the least cid it reaches here."""
    a, b = rows[rows["side"] == 0], rows[rows["side"] == 1]
    own = not len(b)
    b = a if own else b
    if not len(a):
        return pd.DataFrame({"cid": [], "links": [], "root": []})
    ids = a["cid"].to_numpy() if own else np.concatenate([a["cid"].to_numpy(), b["cid"].to_numpy()])
    order = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    pa_, pb = place[: len(a)], place if own else place[len(a) :]
    na, nb = a["n"].to_numpy(), b["n"].to_numpy()
    links, stars = np.zeros(len(ids), np.int64), []
    x, y = np.stack(a["vector"].to_numpy()).astype(np.float64), np.stack(b["vector"].to_numpy()).astype(np.float64)
    x = unit(x)
    y = x if own else unit(y)
    for i, j in linked(x, y, least):
        if own:
            other = i != j
            i, j = i[other], j[other]
            np.add.at(links, pa_[i], nb[j])
        else:
            np.add.at(links, pa_[i], nb[j])
            np.add.at(links, pb[j], na[i])
        low = lowest_reached(pa_[i], pb[j], len(ids))
        some = np.flatnonzero(low != np.arange(len(ids)))
        stars.append((some, low[some]))
    low = lowest_reached(np.concatenate([s for s, _ in stars]), np.concatenate([t for _, t in stars]), len(ids))
    some = np.flatnonzero(links)
    ids = ids[order]
    return pd.DataFrame({"cid": ids[some], "links": links[some], "root": ids[low[some]]})


def fit_centres(sample: np.ndarray, cells: int = CELLS, rounds: int = 8) -> np.ndarray:
    """Centres of a spherical k-means over unit rows, from evenly spread starting rows."""
    centres = sample[np.linspace(0, len(sample) - 1, min(cells, len(sample))).astype(int)]
    for _ in range(rounds):
        near = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), centres)
    return centres


def near_vectors(vectors: DataFrame, least: float = 0.9, column: str = "embedding") -> DataFrame:
    """Columns vec_id, n_links and component_id, one row per row of ``vectors`` (vec_id and an array ``column``).

    Two vectors of one dimension are linked if their cosine in double precision is ``least`` or more; n_links counts the
    other rows linked with a row, component_id is the least vec_id that links reach. Vectors without a direction (null,
    zero, with null or non-finite components) and rows without vec_id link with nothing and are their own component. Equal
    vectors are compared once, with their number as weight. Centres fitted on about ``FIT_ROWS`` vectors only cut the
    work: each vector lies in the cell of its nearest centre, and two cells are compared unless the angles between their
    centres and out to their farthest vectors rule out every link. Cells are cut to blocks of about ``BLOCK``, so each
    task holds one tile; per tile and vector only a count and one star edge leave it. No rows give no rows.
    """
    rows = vectors.select("vec_id", F.col(column).cast("array<double>").alias("vector"))
    good = rows.where(usable(F.col("vector")) & F.col("vec_id").isNotNull())
    classes = good.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "vectors")
    total = classes.agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n")).first()
    alone = rows.where(~usable(F.col("vector")) | F.col("vec_id").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if not total["c"]:
        return alone
    share = min(1.0, FIT_ROWS / total["c"])
    taken = classes.where(F.pmod(F.xxhash64(F.lit(3), "vector"), F.lit(1 << 20)) <= int(share * (1 << 20))).select("vector").toArrow()  # about FIT_ROWS
    by_size: dict[int, list] = {}
    for v in taken.column(0).to_pylist():
        by_size.setdefault(len(v), []).append(v)
    centres = {d: fit_centres(unit(np.array(v)), CELLS) for d, v in by_size.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_pylist()
            cell, angle, by_dim = np.full(len(rows), -1), np.full(len(rows), np.pi), {}
            for i, v in enumerate(rows):
                by_dim.setdefault(len(v), []).append(i)
            for d, at in by_dim.items():
                if d in centres:
                    cosines = unit(np.array([rows[i] for i in at])) @ centres[d].T
                    cell[at], angle[at] = cosines.argmax(axis=1), np.arccos(np.clip(cosines.max(axis=1), -1.0, 1.0))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(cell, pa.int32()), pa.array(angle, pa.float64())], ["vector", "cid", "n", "cell", "angle"])

    placed = classes.select("vector", "cid", "n").mapInArrow(place, "vector array<double>, cid long, n long, cell int, angle double").withColumn("size", F.size("vector"))
    placed = materialize(placed, "cells")
    cells = placed.groupBy("size", "cell").agg(F.count(F.lit(1)).alias("rows"), F.max("angle").alias("reach"))
    found = cells.collect()  # at most CELLS and one for each dimension
    known = {(r["size"], r["cell"]): (-(-r["rows"] // BLOCK), r["reach"]) for r in found}
    sizes = [((r["size"], r["cell"]), -(-r["rows"] // BLOCK), r["rows"]) for r in found]
    limit, partners = float(np.arccos(least)) + 1e-6, []
    for (d, p), (blocks, reach) in sorted(known.items()):
        for (d2, q), (other, far) in sorted(known.items()):
            if d == d2 and p <= q and (p == q or min(p, q) < 0 or np.arccos(np.clip(centres[d][p] @ centres[d][q], -1, 1)) - reach - far <= limit):
                partners.append((d, p, q, blocks, other))
    # where cells rule out too little, plain blocks of all vectors of a dimension are fewer copies of each
    counts = {k: (b, n) for k, b, n in sizes}
    for d in {d for d, _ in known}:
        rows_of = sum(n for (e, _), (_, n) in counts.items() if e == d)
        copies = sum(counts[d, p][1] * o + (counts[d, q][1] * b if p != q else 0) for e, p, q, b, o in partners if e == d)
        whole = -(-rows_of // BLOCK)
        if rows_of * whole <= copies:
            placed = placed.withColumn("cell", F.when(F.col("size") == d, F.lit(-1)).otherwise(F.col("cell")))
            partners = [x for x in partners if x[0] != d] + [(d, -1, -1, whole, whole)]
    spark = vectors.sparkSession
    pairs = F.broadcast(spark.createDataFrame(partners, "size int, p int, q int, p_blocks int, q_blocks int"))  # at most CELLS squared for each dimension
    block = lambda n: F.pmod(F.xxhash64(F.lit(5), "cid"), F.col(n)).cast("int")
    left = placed.join(pairs, (placed["size"] == pairs["size"]) & (placed["cell"] == pairs["p"])).drop(pairs["size"]).withColumn("i", block("p_blocks"))
    left = left.withColumn("j", F.explode(F.sequence(F.when(F.col("p") == F.col("q"), F.col("i")).otherwise(0), F.col("q_blocks") - 1))).withColumn("side", F.lit(0))
    right = placed.join(pairs, (placed["size"] == pairs["size"]) & (placed["cell"] == pairs["q"])).drop(pairs["size"]).withColumn("j", block("q_blocks"))
    right = right.withColumn("i", F.explode(F.sequence(F.lit(0), F.when(F.col("p") == F.col("q"), F.greatest(F.col("j") - 1, F.lit(0))).otherwise(F.col("p_blocks") - 1)))).where("not (p = q and i >= j)").withColumn("side", F.lit(1))
    keep = ["size", "p", "q", "i", "j", "side", "cid", "n", "vector"]
    tiles = left.select(*keep).unionByName(right.select(*keep)).withColumn("vector", F.col("vector").cast("array<float>") if dict(vectors.dtypes)[column] == "array<float>" else F.col("vector"))
    found = materialize(tiles.groupBy("size", "p", "q", "i", "j").applyInPandas(lambda pdf: _tile(pdf, least), "cid long, links long, root long"), "tile-links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = connected_components(found.select("cid", "root"), "cid", "root")
    named = classes.select("vector", "cid", "rep", "n").join(links, "cid", "left").join(groups.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    named = materialize(named, "named")
    least_id = named.groupBy("component").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("n"))
    merged = lookup_by_hot_key(named.select("vector", F.col("n").alias("copies"), "links", "component"), materialize(least_id, "component-ids"), "component", total["c"])
    merged = materialize(merged.select("vector", F.col("copies").alias("n"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "merged")
    out = lookup_by_hot_key(good, merged, "vector", total["n"])
    return out.select("vec_id", "n_links", "component_id").unionByName(alone)
