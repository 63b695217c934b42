"""A corpus pipeline of five operators: toxicity, exact dedup, near dedup, mixing, SentencePiece encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.llm import bagminhash, exact, mixing, pieces, toxicity
from corpuskiln.llm.common import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on this input's labelled rows, scores below the threshold; columns may have any names."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "text")
    return toxicity.score(packed, model).where(F.col("toxicity.score") < toxicity.THRESHOLD).select("row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the row with the least doc_id."""
    return bagminhash.near_dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; a repeated document is a repeated row."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, the byte span of every id, and n_tokens."""
    out = pieces.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", "ids", "begins", "ends", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact_copies), ("near_dedup", drop_near_copies), ("mixing", mix), ("sentencepiece", encode)]
#: The model of the first stage and the signatures of the third cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
