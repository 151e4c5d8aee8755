"""Document fingerprints by consistent weighted sampling, as DataFrame functions only.

A text is a bag of words (lower case, cut at blank bytes); a word weighs as often as it occurs. For each of `samples`
places and each word the hash of both draws r and c from Gamma(2, 1) and b from [0, 1). With weight S, the word's
sample there is t = floor(ln S / r + b), of rank ln c - r (t - b + 1), and the least rank of all words is the
signature's value. Two signatures agree at a place with a probability equal to the generalised Jaccard similarity
sum(min) / sum(max) of the weights. The draws are read from tables of the distribution's quantiles; the table of
ln c is fine towards its low end, where the least ranks come from.

Null and empty texts and texts without words have the empty fingerprint: its likeness to another empty one is 1,
to any other 0. Rows with the same identifier and text are worked on once and returned as often as they came.
Rows that share an identifier are told apart by their text. A null identifier is a value like others, the lowest.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabloop.storage import release_shuffles, settle, small_table

SAMPLES = 64
BLANK = r"[\x20\x09-\x0D]+"
FINE_BITS = 6  # steps of ln c between two powers of two of its probability
POWERS = 16  # powers of two in the table; beyond, ln c falls by ln 2 / 2 each
GAMMA_BITS = 9  # steps of r
SPREAD = 4  # times the shuffle partitions of documents that their words are worked on in
BLOCK_ROWS = 50_000  # documents of one block of the ordered chain
BLOCKS = 1000


def gamma_quantile(p: float) -> float:
    """x with 1 - exp(-x) (1 + x) = p."""
    x = math.sqrt(2 * p) if p < 0.3 else 2.0
    for _ in range(60):
        x = max(x - (-math.expm1(-x) - x * math.exp(-x) - p) / (x * math.exp(-x)), x / 2)
    return x


def _tables(spark: SparkSession) -> tuple[Column, Column]:
    """Quantiles of ln c and r as scalar subqueries of a one-row table.

    As literals every sample had arrays of its own, and each text of the plan that the driver keeps spelt them out.
    """
    steps = 2**FINE_BITS
    ln_c = [
        math.log(gamma_quantile((1 + (m + 0.5) / steps) / 2 ** (j + 1))) for j in range(POWERS) for m in range(steps)
    ]
    r = [gamma_quantile((i + 0.5) / 2**GAMMA_BITS) for i in range(2**GAMMA_BITS)]
    row = small_table(spark, [(ln_c, r)], "ln_c array<double>, r array<double>")
    return row.select("ln_c").scalar(), row.select("r").scalar()


def _constant(values: list[float]) -> Column:
    """A list as one constant, read from its text, instead of a node of the plan for each value. For few uses in a
    plan: each spells the list out."""
    return F.split(F.lit(" ".join(map(repr, values))), " ").cast("array<double>")


def rank(h: Column, ln_weight: Column, tables: tuple[Column, Column]) -> Column:
    """Rank ln c - r (t - b + 1) of a term's sample, drawn from its hash there; the least wins.

    Weights enter by the whole number t alone, so equal t give equal ranks to the last bit.
    """
    ln_c, gamma = tables
    low = h.bitwiseOR(F.lit(1 << 24))
    zeros = F.bit_count(low.bitwiseAND(-low) - 1)
    near = F.least(zeros, F.lit(POWERS - 1))
    fine = F.shiftrightunsigned(h, 24).bitwiseAND(2**FINE_BITS - 1).cast("int")
    c = F.get(ln_c, near * 2**FINE_BITS + fine) - (zeros - near) * F.lit(math.log(2) / 2)
    r = F.get(gamma, F.shiftrightunsigned(h, 64 - 24 - GAMMA_BITS).bitwiseAND(2**GAMMA_BITS - 1).cast("int"))
    b = F.shiftrightunsigned(h, 40).cast("double") * F.lit(2.0**-24)
    return c - r * (F.floor(ln_weight / r + b).cast("double") - b + 1)


def signatures(weights: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """`signature` (array of integers) of each key from rows of key, `term` (integer) and `weight` (above 0)."""
    tables = _tables(weights.sparkSession)
    # a hash is a column of its own: inside the rank it would be made again at each use
    hashed = weights.select(
        *keys, F.log("weight").alias("_ln"), *(F.xxhash64("term", F.lit(i)).alias(f"_h{i}") for i in range(samples))
    )
    least = hashed.groupBy(*keys).agg(
        *(F.min(rank(F.col(f"_h{i}"), F.col("_ln"), tables)).alias(f"_{i}") for i in range(samples))
    )
    return least.select(*keys, F.array(*(F.hash(f"_{i}") for i in range(samples))).alias("signature"))


def likeness(a: Column, b: Column) -> Column:
    """Share of places where two signatures agree; two null ones are alike, a null one and another are not."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.size(a)
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(same)


def text_of(signature: Column) -> Column:
    """Signature as hexadecimal text; empty where it is null."""
    return F.coalesce(F.concat_ws("", F.transform(signature, lambda x: F.lpad(F.hex(x.cast("bigint").bitwiseAND(2**32 - 1)), 8, "0"))), F.lit(""))


def chain(docs: DataFrame) -> DataFrame:
    """Distinct (doc_id, h) with the next of them, by descending doc_id, then h; after the last comes the first.

    `h` is the text's hash. Blocks of identifiers are ordered on their own, and only the first row of each block
    (at most BLOCKS rows) is ordered with those of other blocks.
    """
    size = F.length("text").cast("bigint")
    rows = settle(docs.groupBy("doc_id", F.xxhash64("text").alias("h")).agg(F.max(size).alias("n_chars"), F.count(F.lit(1)).alias("copies")), "chain")
    count = rows.count()
    blocks = min(BLOCKS, -(-count // BLOCK_ROWS))
    cuts = rows.approxQuantile("doc_id", [i / blocks for i in range(1, blocks)], 0.2 / blocks) if blocks > 1 else []
    cuts = sorted({int(c) for c in cuts})
    place = F.size(F.filter(F.lit(cuts), lambda c: c <= F.col("doc_id"))) if cuts else F.lit(0)
    rows = rows.withColumn("block", F.when(F.col("doc_id").isNull(), -1).otherwise(place))
    order = [F.desc_nulls_last("doc_id"), F.col("h")]
    within = Window.partitionBy("block").orderBy(*order)
    here = F.struct("doc_id", "h")
    rows = settle(rows.withColumn("next", F.lead(here).over(within)).withColumn("at", F.row_number().over(within)), "chain")
    heads = rows.where("at = 1").select("block", here.alias("head"))  # one row per block
    ring = Window.partitionBy(F.lit(0)).orderBy(F.desc("block"))
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("block", F.coalesce(F.lead("head").over(ring), F.first("head").over(whole)).alias("after"))
    linked = rows.join(F.broadcast(heads), "block").withColumn("next", F.coalesce("next", "after"))
    return settle(linked.select("doc_id", "h", "n_chars", "copies", F.col("next.doc_id").alias("next_id"), F.col("next.h").alias("next_h")), "chain")


LOWEST = -(2**63)  # stands for a null identifier where rows are dealt out


def with_edits(docs: DataFrame, links: DataFrame) -> DataFrame:
    """(key, h, text, edited) of every distinct row, dealt by (key, h).

    The edited text ends with as many characters of the next text as half its length. A text travels once, and of a
    next text only the part that is needed.
    """
    parts = SPREAD * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id"), F.lit(LOWEST)).alias("key")
    whole = docs.select(key, F.xxhash64("text").alias("h"), "text").repartition(parts, "key", "h")
    whole = whole.groupBy("key", "h").agg(F.first("text").alias("text"))  # sorted as the joins need it
    half = F.floor(F.col("n_chars") / 2).cast("int")
    after = F.coalesce(F.col("next_id"), F.lit(LOWEST)).alias("key")
    begins = links.select(after, F.col("next_h").alias("h"), key.alias("to_key"), F.col("h").alias("to_h"), half.alias("wanted"))
    tails = whole.join(begins.repartition(parts, "key", "h"), ["key", "h"])
    tail = F.substring("text", F.lit(1), F.col("wanted")).alias("tail")
    tails = tails.select(F.col("to_key").alias("key"), F.col("to_h").alias("h"), "wanted", tail)
    rows = whole.join(tails.repartition(parts, "key", "h"), ["key", "h"])
    kept = F.substring("text", F.lit(1), F.length("text") - F.col("wanted"))
    return rows.select("key", "h", "text", F.concat(kept, "tail").alias("edited"))


def word_weights(rows: DataFrame, keys: list[str], texts: list[str]) -> DataFrame:
    """How often each word (as a hash) comes in each of the columns `texts`, numbered by `which`."""
    each = rows.select(*keys, F.posexplode(F.array(*texts)).alias("which", "_text"))
    words = each.select(*keys, "which", F.explode(F.split(F.lower("_text"), BLANK)).alias("_word")).where("_word <> ''")
    return words.groupBy(*keys, "which", F.xxhash64("_word").alias("term")).agg(F.count(F.lit(1)).alias("weight"))


def document_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    The edited text is the text with its last half (rounded down) replaced by as much of the next document's, by
    descending identifier; after the last document comes the first.
    """
    name = F.col(doc_id).cast("bigint").alias("doc_id")
    docs = docs.select(name, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    links = chain(docs)
    rows = with_edits(docs, links)
    signed = signatures(word_weights(rows, ["key", "h"], ["text", "edited"]), ["key", "h", "which"], samples)
    signed = signed.groupBy("key", "h").agg(
        F.first(F.when(F.col("which") == 0, F.col("signature")), True).alias("signature"),
        F.first(F.when(F.col("which") == 1, F.col("signature")), True).alias("edited_signature"),
    )
    digests = rows.select("key", "h", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    made = settle(digests.join(signed, ["key", "h"], "left"), "signatures")
    del rows, signed, digests
    release_shuffles(docs.sparkSession)  # the texts were dealt out for the signatures alone
    key = F.coalesce(F.col("doc_id"), F.lit(LOWEST))
    after = F.coalesce(F.col("next_id"), F.lit(LOWEST))
    ends = links.select(key.alias("key"), "h", "doc_id", "n_chars", "copies", after.alias("next_key"), "next_h")
    following = made.select(F.col("key").alias("next_key"), F.col("h").alias("next_h"), F.col("signature").alias("next_signature"))
    # first the next text's signature alone: the wide rows are dealt out once
    out = ends.join(following, ["next_key", "next_h"]).drop("next_key", "next_h").join(made, ["key", "h"])
    out = out.select(
        "doc_id", "n_chars", "edited_sha256",
        text_of(F.col("signature")).alias("fingerprint"),
        text_of(F.col("edited_signature")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
        "copies",
    )
    again = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy")
    return out.select("*", again).drop("copies", "copy")
