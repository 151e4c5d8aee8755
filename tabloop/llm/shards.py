"""Sharding by a hierarchical weighted hash tree.

Shards are leaves of a tree of regions, racks and shards. A row descends from the root: every child of its node draws
-ln(u) / weight, with u a hash of the row's key and the child's name, and the least draw wins. A child wins in
proportion to its weight, and a draw depends on nothing but the key, the child and the child's weight. When weights
change, rows therefore move only into subtrees whose weight grew or out of subtrees whose weight fell; inside a
subtree whose own weights are unchanged nothing moves. A further shard opened as a region of its own takes rows only
into itself; one put into a standing rack also attracts rows to that rack, which are dealt anew among its shards.

`place` adds the shard to every row without a shuffle. `slots` numbers the rows of each shard from 0 in an order of a
hash of (key, size, checksum): equal rows are counted before the shuffle, the hash cuts each shard into blocks of
bounded size, sums over blocks give each block's first slot, and only blocks are ordered. `write` puts the rows into
one folder per shard; heavy shards are split over tasks.

The tree is a parameter, not data: its nodes are copied to all tasks, at most MAX_NODES of them. The key is the
identifier's text; a null identifier is the key "null", so rows without one share a shard. A null text has no bytes:
size 1 and checksum 0, as an empty text. Repeated rows lie in one shard and get slots of their own. Weights of zero or
below are never drawn. An empty table gives an empty table. Columns named like the outputs are replaced by `place`.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabloop.operators.skew import lookup_join
from tabloop.storage import settle, small_table

MAX_NODES = 65_536
BLOCK_ROWS = 4096  # rows of a shard ordered by one task
COPY_ROWS = 65_536  # copies of one row written out by one task
RACK_SHARDS, REGION_RACKS = 4, 2
LEVELS = ("region", "rack", "shard")
HEX_DIGITS = 13  # of a draw: 52 bits, exact in a double
SEED = 11
CHILDREN = "array<struct<child: int, weight: double>>"


@dataclass(frozen=True)
class Tree:
    """weights: of each shard by its path (region, rack, shard). A node weighs what its shards weigh."""

    weights: dict[tuple[int, int, int], float]

    def children(self) -> list[list[tuple[int, int, int, float]]]:
        """For each level (parent region, parent rack, child, weight); -1 stands for what a level lacks."""
        levels: list[dict[tuple[int, int, int], float]] = [{}, {}, {}]
        for (region, rack, shard), weight in self.weights.items():
            if weight > 0:
                for level, node in zip(levels, ((-1, -1, region), (region, -1, rack), (region, rack, shard))):
                    level[node] = level.get(node, 0.0) + weight
        if sum(map(len, levels)) > MAX_NODES:
            raise ValueError(f"a tree of more than {MAX_NODES} nodes")
        if not levels[0]:
            raise ValueError("no shard has a weight")
        return [[(*node, weight) for node, weight in sorted(level.items())] for level in levels]


def even_tree(shards: int) -> Tree:
    """Shards of weight 1 in racks of four and regions of eight; shard, rack and region are numbered throughout.

    With a multiple of eight shards the next one opens a region of its own."""
    per_region = RACK_SHARDS * REGION_RACKS
    return Tree({(s // per_region, s // RACK_SHARDS, s): 1.0 for s in range(shards)})


def grown(tree: Tree, shard: int, weight: float = 1.0) -> Tree:
    """The tree with one more shard in a new region of its own, so that rows move only to it."""
    region = 1 + max(path[0] for path in tree.weights)
    rack = 1 + max(path[1] for path in tree.weights)
    return Tree({**tree.weights, (region, rack, shard): weight})


def draw(key: Column, level: str, child: Column, weight: Column, seed: int = SEED) -> Column:
    """-ln(u) / weight of one child."""
    bits = F.md5(F.concat(key, F.lit(f":{level}:"), child.cast("string"), F.lit(f":{seed}")))
    number = F.conv(F.substring(bits, 1, HEX_DIGITS), 16, 10).cast("double")
    return -F.ln((number + 0.5) / float(16**HEX_DIGITS)) / weight


def key_text(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))


def place(rows: DataFrame, tree: Tree, doc_id: str = "doc_id", seed: int = SEED, names: Sequence[str] = LEVELS) -> DataFrame:
    """`rows` with the region, rack and shard that their keys descend to; equal draws go to the smaller child."""
    spark = rows.sparkSession
    placed = rows.select(*(c for c in rows.columns if c not in names))
    keep = placed.columns
    out = placed.withColumn("_key", key_text(doc_id)).withColumn("_a", F.lit(-1)).withColumn("_b", F.lit(-1))
    for depth, (level, children) in enumerate(zip(LEVELS, tree.children(), strict=True)):
        if depth == 0:
            top = json.dumps([{"child": child, "weight": weight} for _, _, child, weight in children])
            out = out.withColumn("_children", F.from_json(F.lit(top), CHILDREN))  # folded into a constant
        else:
            out = out.join(F.broadcast(_by_parent(spark, children)), ["_a", "_b"])
        best = F.array_min(F.transform("_children", lambda c: F.struct(draw(F.col("_key"), level, c.child, c.weight, seed), c.child)))
        out = out.withColumn(f"_{depth}", best.child).drop("_children")
        if depth == 0:
            out = out.withColumn("_a", F.col("_0"))
        elif depth == 1:
            out = out.withColumn("_b", F.col("_1"))
    return out.select(*keep, *(F.col(f"_{i}").alias(n) for i, n in enumerate(names)))


def _by_parent(spark: SparkSession, children: list[tuple[int, int, int, float]]) -> DataFrame:
    """One row per parent with its children, made from the tree."""
    parents: dict[tuple[int, int], list[tuple[int, float]]] = {}
    for region, rack, child, weight in children:
        parents.setdefault((region, rack), []).append((child, weight))
    rows = [(*parent, own) for parent, own in parents.items()]
    return small_table(spark, rows, f"_a int, _b int, _children {CHILDREN}")


def slot_key(doc_id: str = "doc_id", seed: int = SEED) -> Column:
    """Where a row stands in its shard: a hash of its key, size and checksum."""
    whole = F.concat_ws(":", key_text(doc_id), F.col("size").cast("string"), F.col("text_crc32").cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(whole), 1, HEX_DIGITS), 16, 10).cast("bigint")


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 of every row."""
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body).cast("bigint").alias("text_crc32"),
    )


def slots(
    docs: DataFrame, tree: Tree, more: Tree | None = None, doc_id: str = "doc_id", text: str = "text", seed: int = SEED,
    block_rows: int = BLOCK_ROWS, copy_rows: int = COPY_ROWS,
) -> DataFrame:
    """doc_id, size, text_crc32, region, rack, shard, slot and, with `more`, the shard in that tree, of every row."""
    rows = measured(docs, doc_id, text).groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    rows = place(rows, tree, seed=seed)
    after = []
    if more is not None:
        rows = place(rows, more, seed=seed, names=("_r", "_k", "grown_shard")).drop("_r", "_k")
        after = ["grown_shard"]
    rows = settle(rows.withColumn("key", slot_key(seed=seed)), "placed")
    largest = rows.groupBy("shard").count().agg(F.coalesce(F.max("count"), F.lit(0)).alias("n")).first().n
    blocks = max(1, -(-largest // block_rows))
    rows = rows.withColumn("block", F.floor(F.col("key") / float(16**HEX_DIGITS) * blocks))
    sums = rows.groupBy("shard", "block").agg(F.sum("copies").alias("_n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(sums.select("shard", "block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")), "starts")
    within = Window.partitionBy("shard", "block").orderBy("key", "doc_id", "size", "text_crc32")
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    ordered = lookup_join(rows, starts, ["shard", "block"], "inner")
    ordered = ordered.withColumn("_start", F.col("_start") + F.coalesce(F.sum("copies").over(within), F.lit(0)))
    keep = ["doc_id", "size", "text_crc32", "region", "rack", "shard"]
    if not rows.where(F.col("copies") > copy_rows).limit(1).count():
        return _written_out(ordered).select(*keep, "slot", *after)
    ordered = settle(ordered, "ordered")
    few, many = ordered.where(F.col("copies") <= copy_rows), ordered.where(F.col("copies") > copy_rows)
    cut = many.withColumn("_cut", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(copy_rows))))
    cut = cut.withColumn("copies", F.least(F.lit(copy_rows).cast("bigint"), F.col("copies") - F.col("_cut")))
    cut = cut.withColumn("_start", F.col("_start") + F.col("_cut")).drop("_cut").repartition("shard", "_start")
    return _written_out(few).unionByName(_written_out(cut)).select(*keep, "slot", *after)


def _written_out(rows: DataFrame) -> DataFrame:
    """Each of a row's copies with its slot."""
    return rows.withColumn("slot", F.explode(F.sequence(F.col("_start"), F.col("_start") + F.col("copies") - 1)))


def write(docs: DataFrame, tree: Tree, folder: str, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> None:
    """All columns of `docs` as Parquet below `folder`, in folders named by region, rack and shard.

    Rows are dealt by shard and blocks of their slot keys. Spark splits what is too large for a task and joins what
    is small, and each file is in the order of slot keys.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = place(docs, tree, doc_id, seed)
    whole = F.concat_ws(":", key_text(doc_id), (F.octet_length(body) + 1).cast("string"), F.crc32(body).cast("string"), F.lit(str(seed)))
    rows = rows.withColumn("_key", F.substring(F.md5(whole), 1, HEX_DIGITS))
    rows = rows.withColumn("_deal", F.substring("_key", 1, 2)).hint("rebalance", "shard", "_deal")
    rows = rows.sortWithinPartitions("shard", "_key").drop("_key", "_deal")
    rows.write.partitionBy(*LEVELS).parquet(folder)
