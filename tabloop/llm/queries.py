"""The registered queries of this subpackage, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloop.llm import audit, bpe, fingerprints, linededup, mixing, nearjoin, negatives, quality, shards, toxicity, urls, vectors, warc
from tabloop.llm.labelled import held_out
from tabloop.llm import sql as texts
from tabloop.storage import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def vocabulary() -> bpe.Vocabulary:
    return bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op1_weighted_sampling_fingerprints")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.document_fingerprints(table(spark, sf, "documents"))


def mixing_tree() -> tuple[dict[str, Column], dict[str, Column]]:
    """Levels from domain to source, and the weight of each among its siblings. Sources of a number go to domains."""
    number = F.coalesce(F.regexp_extract("source", r"(\d+)$", 1).try_cast("int"), F.lit(0))
    levels = {"domain": F.concat(F.lit("d"), number % 4), "lang": F.col("lang"), "source": F.col("source")}
    weights = {"domain": 4 - number % 4, "lang": F.when(F.col("lang") == "en", 5).otherwise(2), "source": 1 + number % 3}
    return levels, weights


MIX_SHARE = 0.6


@query("op2_hierarchical_mixing", texts.mixing(MIX_SHARE, mixing.EPOCHS, mixing.SEED))
def op2(spark: SparkSession, sf: str) -> DataFrame:
    levels, weights = mixing_tree()
    docs = table(spark, sf, "documents").withColumn("domain", levels["domain"])
    taken = mixing.mix(docs, levels, weights, share=MIX_SHARE)
    return taken.select("doc_id", "domain", "lang", "source", "n_tokens", "epoch")


@query("op3_toxicity_factorisation_machine")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    machine = toxicity.fit(docs, table(spark, sf, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), machine)
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted)


@query("op4_quality_empirical_bayes")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    classifier = quality.fit(docs, table(spark, sf, "labels"))
    judged = quality.judge(docs, classifier)
    return judged.select("doc_id", held_out().alias("held_out"), "p_document", "site_rate", "quality", "keep")


@query("op5_warc_chunks")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    chunks = warc.read(warc.write(table(spark, sf, "pages"), folder=folder), folder)
    return chunks.where("is_last").select(
        F.col("record_id").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
        "intact",
    )


RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def page_text(html: Column) -> Column:
    """What a page shows: without scripts, styles and tags."""
    bare = F.regexp_replace(html.cast("string"), r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    return F.regexp_replace(bare, r"<[^>]*>", " ")


def content_marks(spark: SparkSession, sf: str, pages: DataFrame) -> DataFrame:
    """(url, bad) of every page with a text: whether the classifiers fitted on the documents' labels find it of low
    quality or toxic. Pages and documents share numbers but no texts, so a document's label says nothing of a page."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = pages.select("url", page_text(F.col("html")).alias("text")).where("trim(text) <> ''")
    scored = quality.evidence(rows, quality.fit(docs, labels))
    scored = toxicity.score(scored, toxicity.fit(docs, labels))
    bad = (F.col("p_document") < quality.THRESHOLD) | (F.col("score") >= toxicity.THRESHOLD)
    return scored.select("url", bad.alias("bad"))


@query("op6_url_association_rules")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return urls.judge(pages.select("page_id", "url"), content_marks(spark, sf, pages), RULES).drop("url")


@query("op7_ngram_jaccard_join", texts.NEAR)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return nearjoin.near_components(table(spark, sf, "documents"))


@query("op8_line_dedup")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    gone = linededup.removals(docs.select("doc_id", "text"))
    size = F.size(F.split("text", "\n", -1)).alias("n_lines")
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), F.when(F.col("text").isNull(), 0).otherwise(size).alias("n_lines"))
    named = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))  # as removals() names a null identifier
    out = rows.withColumn("key", named).join(gone, ["key", "h"], "left")
    return out.select("doc_id", "n_lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


@query("op9_vector_approximation_search", texts.SEARCH)
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.search(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0).withColumn(
        "rank", F.col("rank").cast("int")
    )


@query("op10_byte_bpe")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    words = vocabulary()
    encoded = bpe.encode(table(spark, sf, "documents").select("doc_id", "text"), words).drop("text")
    decoded = bpe.decode(encoded, words)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


SHARDS = 16


@query("op11_weighted_hash_tree_sharding", texts.SHARDING)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    tree = shards.even_tree(SHARDS)
    rows = shards.slots(table(spark, sf, "documents"), tree, shards.grown(tree, SHARDS))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "region", "rack", "shard", "slot", "grown_shard"
    )


@query("op12_filter_interaction_audit", texts.AUDIT)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op13_hard_negatives", texts.HARD)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, label)
