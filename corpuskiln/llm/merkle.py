"""A Merkle manifest of a table: leaves, a node table, and proofs looked up by the coordinates of siblings. DataFrame functions only."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.common import lookup_by_hot_key, materialize
from corpuskiln.operators import scan

FANOUT = 16
#: A level with so many nodes at most, in all trees together, is broadcast to those who ask for them (about 10 MB); larger ones are joined.
BROADCAST_NODES = 1 << 16
#: The tree over the roots of all groups; groups are numbered from 0.
TOP = -1

_SIBLINGS = "cast(array() as array<struct<level:int,sibling:bigint,hash:binary>>)"


class Manifest(NamedTuple):
    """``leaves``: tree, idx, n (leaves of the tree), hash and what was passed along; ``nodes``: tree, level, idx, n (nodes of the level), hash."""

    leaves: DataFrame
    nodes: DataFrame
    tops: DataFrame
    fanout: int


def leaf_hash(*values: Column) -> Column:
    """SHA-256 in hex of all values in order, each as its UTF-8 length, a colon and the value, or ``-`` for null."""
    one = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*(one(c.cast("string")) for c in values)), 256)


def _text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _width(n: Column, level: Column, fanout: int) -> Column:
    """Nodes on a level of a tree of ``n`` leaves."""
    return F.ceil(n / F.pow(F.lit(fanout), level)).cast("long")


def _grow(leaves: DataFrame, fanout: int) -> DataFrame:
    """The node table over ``leaves`` (tree, idx, n, hash), level by level; a level is stored before the next is made of it."""
    now = leaves.select("tree", F.lit(0).alias("level"), "idx", "n", "hash")
    found, level = now, 0
    while True:
        open_ = now.where("n > 1")
        if open_.isEmpty():
            return found
        level += 1
        run = F.sort_array(F.collect_list(F.struct("idx", "hash")))  # fanout nodes at most
        above = open_.groupBy("tree", F.floor(F.col("idx") / fanout).cast("long").alias("idx")).agg(run.alias("run"), F.ceil(F.max("n") / fanout).cast("long").alias("n"))
        whole = F.array_join(F.transform("run", lambda x: _text(x["hash"])), "")
        now = materialize(above.select("tree", F.lit(level).alias("level"), "idx", "n", F.unhex(F.sha2(whole, 256)).alias("hash")), "merkle-level")
        found = found.unionByName(now)


def build(rows: DataFrame, group: str, key: str, fanout: int = FANOUT) -> Manifest:
    """The manifest of ``rows``, which have ``group``, ``key``, ``leaf`` (hex) and any other columns.

    Per group the leaves ascend by key, then by leaf, null first; equal rows are leaves of their own. Groups ascend null first, then by
    UTF-8 bytes. While a tree has several nodes on a level, each run of ``fanout`` of them (the last may be shorter, even one) is
    hashed to a node above; the roots of the groups, which are their leaves where these are alone, are the leaves of the top tree.
    Indexes are running counts over ranges, so neither a group nor a level is in one task. No rows give an empty manifest.
    """
    named = rows.select(F.col(group).alias("__group"), F.col(key).alias("__key"), "leaf", F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row"))
    one = F.lit(1).cast("long")
    of_group = scan.running(named, ["__group"], ["__key", "leaf"], {"idx": scan.Fold("sum", one)}, {"n": scan.Fold("sum", one)})
    begins = F.when(F.col("idx") == 1, one).otherwise(0)
    numbered = scan.running(of_group, [], ["__group", "__key", "leaf", "idx"], {"tree": scan.Fold("sum", begins)}, {"trees": scan.Fold("sum", begins)})
    leaves = materialize(numbered.select((F.col("tree") - 1).alias("tree"), (F.col("idx") - 1).alias("idx"), "n", "trees", F.unhex("leaf").alias("hash"), "row"), "merkle-leaves")
    nodes = _grow(leaves, fanout)
    roots = nodes.where("n = 1").select("tree", F.col("hash").alias("subroot")).join(leaves.where("idx = 0").select("tree", "n", "trees"), "tree")
    roots = materialize(roots, "merkle-roots")
    top = _grow(roots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.col("trees").alias("n"), F.col("subroot").alias("hash")), fanout)
    every = materialize(nodes.unionByName(top), "merkle-nodes")
    asking = roots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.col("trees").alias("n"), F.struct("tree", "n", "subroot").alias("of"))
    tops = siblings(asking, every, fanout).select("of.*", F.col("siblings").alias("upper"))
    return Manifest(leaves.drop("trees"), every, materialize(tops, "merkle-tops"), fanout)


def siblings(asking: DataFrame, nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``asking`` (tree, idx, n and more; tree and idx are a key) with ``siblings``: (level, sibling, hash) of every node that a proof needs, in order.

    The coordinates follow from index and size alone: on each level with several nodes, the run of the asker's ancestor without itself.
    They are exploded, met by the node table and gathered again by asker. A node of level k is asked for by fanout to the k + 1 rows
    at most; levels of few nodes are broadcast, so no key of the join holds a notable share of the rows.
    """
    def asked(levels: list[int]) -> DataFrame:
        """Coordinates on some levels; each level is exploded once, for the join that it takes part in."""
        open_ = F.filter(F.array(*map(F.lit, levels)), lambda k: _width(F.col("n"), k, fanout) > 1)
        at = asking.select("tree", "idx", "n", F.explode(open_).alias("level"))
        own = F.floor(F.col("idx") / F.pow(F.lit(fanout), F.col("level"))).cast("long")
        first = own - F.pmod(own, F.lit(fanout))
        last = F.least(first + (fanout - 1), _width(F.col("n"), F.col("level"), fanout) - 1)
        return at.withColumn("own", own).select("tree", "idx", "level", "own", F.explode(F.sequence(first, last)).alias("sibling")).where("sibling <> own").drop("own")

    known = nodes.where("n > 1").select(F.col("tree").alias("__tree"), F.col("level").alias("__level"), F.col("idx").alias("__idx"), "hash")
    sizes = known.groupBy("__level").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per level
    few = [r["__level"] for r in sizes if r["n"] <= BROADCAST_NODES]
    many = [r["__level"] for r in sizes if r["n"] > BROADCAST_NODES]
    met = None
    for level, hint in [x for x in ((few, F.broadcast), (many, lambda x: x)) if x[0]]:  # levels shrink by fanout, so few ones together are small too
        here = hint(known.where(F.col("__level").isin(level)))
        part = asked(level).join(here, (F.col("tree") == F.col("__tree")) & (F.col("level") == F.col("__level")) & (F.col("sibling") == F.col("__idx")))
        part = part.groupBy("tree", "idx").agg(F.collect_list(F.struct("level", "sibling", "hash")).alias("s"))
        met = part if met is None else met.unionByName(part)
    if met is None:
        return asking.withColumn("siblings", F.expr(_SIBLINGS))
    gathered = met.groupBy("tree", "idx").agg(F.sort_array(F.flatten(F.collect_list("s"))).alias("siblings"))
    return asking.join(gathered, ["tree", "idx"], "left").withColumn("siblings", F.coalesce("siblings", F.expr(_SIBLINGS)))


def fold(leaf: Column, idx: Column, n: Column, found: Column, fanout: int = FANOUT) -> Column:
    """The root in hex that a leaf (hex), its index, the tree's size and its siblings give; a run of one is hashed too."""

    def step(acc: Column, level: Column) -> Column:
        own = F.floor(idx / F.pow(F.lit(fanout), level))
        texts = lambda keep: F.array_join(F.transform(F.filter(found, lambda s: (s["level"] == level) & keep(s["sibling"], own)), lambda s: _text(s["hash"])), "")
        return F.sha2(F.concat(texts(lambda a, b: a < b), acc, texts(lambda a, b: a > b)), 256)

    levels = F.filter(F.sequence(F.lit(0), F.lit(62)), lambda k: _width(n, k, fanout) > 1)
    return F.aggregate(levels, leaf, step)


def prove(manifest: Manifest, changed: str) -> DataFrame:
    """Per leaf: row, leaf, subroot, root, proof_sha256, and folded_root and verified for the leaf hash in the column ``changed`` of its row, with the untouched siblings."""
    first = manifest.nodes.where(f"tree = {TOP} and n = 1").select("hash").first()
    root = F.lit(first["hash"].hex() if first else None)
    below = siblings(manifest.leaves, manifest.nodes, manifest.fanout).drop("n")
    total = manifest.leaves.count()
    joined = lookup_by_hot_key(below, manifest.tops, "tree", total)
    proof = F.array_join(F.transform(F.concat("siblings", "upper"), lambda s: _text(s["hash"])), "")
    lower = fold(F.col(f"row.{changed}"), F.col("idx"), F.col("n"), F.col("siblings"), manifest.fanout)
    trees = manifest.tops.agg(F.count(F.lit(1)).alias("c")).first()["c"]
    folded = fold(lower, F.col("tree"), F.lit(trees), F.col("upper"), manifest.fanout)
    out = joined.select("row", _text(F.col("hash")).alias("leaf"), _text(F.col("subroot")).alias("subroot"), root.alias("root"), F.sha2(proof, 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def leaves_of(docs: DataFrame) -> DataFrame:
    """doc_id, source, ``leaf`` and ``tampered``, the leaf as it is after a change of the text where 5 divides the CRC-32 of doc_id (a null doc_id: none).

    The change writes A to Z in lower case; a text without them, or null, gives the same leaf.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    touched = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
    leaf = leaf_hash(*fields, F.col("text"))
    return docs.select("doc_id", "source", leaf.alias("leaf"), F.when(touched, leaf_hash(*fields, low)).otherwise(leaf).alias("tampered"))
