"""A bounded, repeatable sample of labelled documents for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloop.storage import settle

SAMPLE_ROWS = 20_000
FOLDS = 3
HELD_OUT = 1


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows no label is learnt from: crc32 of the identifier's text leaves 1 when divided by 3; null is not held out."""
    fold = F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, label) of at most `rows` labelled documents that are not held out, in the order of a hash of the id.

    Labels that are null or belong to no document are left out. The sample is drawn from the labels, so at most
    `rows` identifiers are broadcast; a repeated identifier stands for all its rows.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    some = settle(known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows), "labels")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return settle(texts.join(F.broadcast(some), "doc_id").select("text", "label"), "sample")
