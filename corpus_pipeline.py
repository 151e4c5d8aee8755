"""A corpus from documents: judged, freed of repeated lines and near copies, mixed to weights, and encoded.

Every stage takes all rows that the one before kept and returns rows with the columns of `documents`, except the
last, which returns the token ids. Tables are written between stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloop.llm import bpe, linededup, mixing, nearjoin, quality, queries
from tabloop.storage import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

MIX_SHARE = 0.8  # of the tokens that reach the mixing stage
MIX_EPOCHS = 1
NEAR_WORDS = 5  # of a shingle in the near-copy stage; op7 has a contract of its own
NEAR_THRESHOLD = (80, 100)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; it is fitted on labelled rows of its input."""
    classifier = quality.fit(docs, queries.table(spark, sf_dir, "labels"))
    return quality.judge(docs, classifier).where("keep").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one are cut out; a document that loses all its lines stays with an empty text."""
    cut = linededup.without_repeats(docs)
    if "n_chars" in docs.columns:
        size = F.when(F.size("removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", size)
    return cut.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: at least 0.8 of their five-word shingles are shared."""
    return nearjoin.without_copies(docs, words=NEAR_WORDS, threshold=NEAR_THRESHOLD)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents taken by the domain, language and source budgets; each at most once."""
    levels, weights = queries.mixing_tree()
    taken = mixing.mix(docs, levels, weights, share=MIX_SHARE, epochs=MIX_EPOCHS)
    return taken.select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it."""
    words = queries.vocabulary()
    rows = bpe.decode(bpe.encode(docs.select("doc_id", "lang", "source", "text"), words), words)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return rows.select("doc_id", "lang", "source", F.size("ids").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_copies),
    ("mixing", mixed),
    ("byte_bpe", encoded),
]

ORACLE_SQL: str | None = None  # no stage but the mixing has an SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
