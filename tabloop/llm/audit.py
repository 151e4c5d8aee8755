"""How five filters interact: what each removes alone, after others, and over all orders.

A document fails A with under 200 words, B with under half of its words distinct, C with more than 3 % capitals A-Z
among its code points, D with any of # $ % & * |, E where a document of a smaller identifier has the same text. Word
counts are the row sums and nonzero counts of the document-term matrix (`terms.py`); the other flags are attached.

Documents are reduced to the five flags and two labels, per part: 32 patterns at most. Everything about all 120 orders
follows from these counts. Equal texts share the flags A to D, so E needs only the least identifier of each text: rows
are counted by text, part, labels and identifier before they meet, and a hot text is a row like any other.

Texts are told apart by SHA-256; a null text is an empty one. A document without an identifier is no one's original and
never fails E; rows that repeat an identifier and its text do not fail by each other. A null part is the empty
string. Labels belong to all rows of their identifier; where an identifier has several, one label of 1 is enough. An
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloop.llm import terms
from tabloop.operators.skew import lookup_join
from tabloop.storage import arrow_batches, settle

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT = 50  # percent
MOST_CAPITALS = 3  # percent
SYMBOLS = r"[#$%&*|]"
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}


def flags(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """doc_id, part, digest and `fails`, the bits of A to D, of every row."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    many = 100 * F.regexp_count(body, F.lit("[A-Z]")).cast("bigint") > MOST_CAPITALS * F.length(body)
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(body, 256)).alias("digest"),
        _bits(many, "C").bitwiseOR(_bits(body.rlike(SYMBOLS), "D")).alias("marks"),
        body.alias("text"),
    )
    keep = ["doc_id", "part", "digest", "marks"]
    shards, _ = terms.matrix(rows, "text", keep)
    counted = terms.row_counts(shards, keep)
    short = F.col("words") < LEAST_WORDS
    dull = 100 * F.col("distinct_words") < LEAST_DISTINCT * F.col("words")
    return counted.select("doc_id", "part", "digest", F.col("marks").bitwiseOR(_bits(short, "A")).bitwiseOR(_bits(dull, "B")).alias("fails"))


def _bits(condition: Column, name: str) -> Column:
    return F.when(condition, BIT[name]).otherwise(0)


def patterns(flagged: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """part, fails (all five bits), n, good, toxic: counts of documents."""
    known = labels.select(F.col(doc_id).cast("bigint").alias("doc_id"), "quality", "toxic").where("doc_id is not null")
    known = known.groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    rows = lookup_join(flagged, settle(known, "known"), ["doc_id"])
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in ("good", "toxic")})
    kind = ["digest", "part", "fails", "good", "toxic"]
    by_id = rows.groupBy(*kind, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    nameless = F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0))
    by_kind = by_id.groupBy(*kind).agg(
        F.sum("n").alias("n"), nameless.alias("nameless"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("at_least")
    )
    first = F.col("least") == F.min("least").over(Window.partitionBy("digest"))
    original = F.col("nameless") + F.when(first, F.col("at_least")).otherwise(0)
    copies = F.struct(F.col("fails").bitwiseOR(F.lit(BIT["E"])).alias("fails"), (F.col("n") - F.col("originals")).alias("n"))
    rows = by_kind.withColumn("originals", original)
    both = F.array(F.struct("fails", F.col("originals").alias("n")), copies)
    split = rows.select("part", "good", "toxic", F.inline(both))
    labelled = {c: F.coalesce(F.sum(F.when(F.col(c), F.col("n"))), F.lit(0)).alias(c) for c in ("good", "toxic")}
    return split.where("n > 0").groupBy("part", "fails").agg(F.sum("n").alias("n"), *labelled.values())


def interactions(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells"))
    rows = cells.select("part", "cells", F.explode(F.lit(ORDERS)).alias("filter_order"))
    rows = rows.select("part", "cells", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    before = F.substring("filter_order", F.lit(1), F.col("step") - 1)
    own = sum((F.when(letter == f, BIT[f]).otherwise(0) for f in FILTERS), F.lit(0))
    earlier = sum((F.when(F.contains(before, F.lit(f)), BIT[f]).otherwise(0) for f in FILTERS), F.lit(0))
    rows = rows.withColumns({"own": own, "earlier": earlier})

    def total(which, value=lambda c: c.n) -> Column:
        return F.aggregate("cells", F.lit(0).cast("bigint"), lambda sum_, c: sum_ + F.when(which(c.fails), value(c)).otherwise(0))

    def fails(c: Column) -> Column:
        return c.bitwiseAND(F.col("own")) != 0

    def gone(c: Column) -> Column:
        return c.bitwiseAND(F.col("earlier")) != 0

    here = lambda c: fails(c) & ~gone(c)
    before_others = lambda c: (c.n * F.lit(len(ORDERS)) / F.bit_count(c.fails)).cast("bigint")  # noqa: E731  orders in which a failed filter comes first
    return rows.select(
        "part",
        "filter_order",
        "step",
        total(lambda c: ~fails(c) & ~gone(c)).alias("kept"),
        total(here).alias("removed"),
        total(lambda c: fails(c) & gone(c)).alias("redundant"),
        total(lambda c: c == F.col("own")).alias("unique_fails"),
        total(here, lambda c: c.good).alias("good_lost"),
        total(here, lambda c: c.toxic).alias("toxic_lost"),
        total(fails, before_others).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts, for every order of the filters."""
    with arrow_batches(docs.sparkSession):
        flagged = settle(flags(docs), "flags")
    return interactions(patterns(flagged, labels))
