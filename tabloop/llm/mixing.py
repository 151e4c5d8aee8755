"""Mixing sources to target weights: budgets down a tree, then a token prefix of each leaf.

Documents are leaves' rows in a tree of levels, such as domain, language, source. A node's budget is dealt to its
children by weight. A child takes no more than its capacity (tokens below it, times the epochs allowed); what it
leaves goes to its siblings by weight, and only when all of them are full does the node itself take less, which
leaves the rest to the node's own siblings. A leaf repeats whole epochs of its documents and takes the rest of its
budget from the next epoch, in that epoch's seeded order: documents are taken while the tokens before them are below
the budget, so a leaf passes its budget by less than one document.

The prefix of a leaf is found without ordering it: documents fall into blocks by their seeded keys, sums of blocks
tell which block the budget ends in, and only that block is ordered. The end is one row per leaf, and taking is a
filter. A leaf that holds most rows is therefore no larger task than another.

Documents without tokens (null, empty or blank texts) are never taken. Null level values are nodes of their own.
Nodes of weight zero, below or null get nothing and their documents count nowhere. Rows with one identifier are told
apart by their text; equal rows are taken or left together. An empty table gives an empty table. Columns named like
the outputs `epoch` and `n_tokens` are replaced, others pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloop.functions.keys import KEY_RANGE, hash_key
from tabloop.operators.skew import lookup_join
from tabloop.storage import settle

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_ROWS = 20_000  # documents of one block of a leaf, ordered by one task
SEED = 20
EPOCHS = 2


def token_count(text: Column) -> Column:
    """Words between blank bytes; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def _level(column: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("null"))


def deal(children: DataFrame, parent: Sequence[str], child: str) -> DataFrame:
    """Adds `share` of the parent's `budget` to each child by `weight`, at most its `capacity`.

    Children are ordered by how soon they are full; each is full if the budget, less what the ones before take,
    fills it at the rate of those not yet full.
    """
    soon = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("weight"), child)
    before = soon.rowsBetween(Window.unboundedPreceding, -1)
    onward = soon.rowsBetween(0, Window.unboundedFollowing)
    rows = children.withColumn("_taken", F.coalesce(F.sum("capacity").over(before), F.lit(0.0)))
    rows = rows.withColumn("_open", F.sum("weight").over(onward))
    full = F.col("_taken") + F.col("capacity") / F.col("weight") * F.col("_open") <= F.col("budget")
    rows = rows.withColumn("_full", full)
    all_of = Window.partitionBy(*parent)
    taken = F.coalesce(F.sum(F.when(F.col("_full"), F.col("capacity"))).over(all_of), F.lit(0.0))
    open_ = F.sum(F.when(~F.col("_full"), F.col("weight"))).over(all_of)
    rate = (F.col("budget") - taken) / open_
    share = F.when(F.col("_full"), F.col("capacity")).otherwise(rate * F.col("weight"))
    return rows.withColumn("share", share).drop("_taken", "_open", "_full")


def leaf_quotas(leaves: DataFrame, levels: Sequence[str], budget: float, epochs: int) -> DataFrame:
    """Adds `quota` (tokens) to the leaves: levels, one weight `w_<level>` each, and `supply`."""
    usable = F.lit(True)
    for c in levels:
        usable = usable & F.coalesce(F.col(f"w_{c}") > 0, F.lit(False))
    open_leaves = leaves.where(usable).withColumn("capacity", F.col("supply").cast("double") * epochs)
    total = open_leaves.agg(F.coalesce(F.sum("capacity"), F.lit(0.0)).alias("c")).first().c
    above = None
    for depth, level in enumerate(levels):
        path, parent = list(levels[: depth + 1]), list(levels[:depth])
        nodes = open_leaves.groupBy(*path).agg(
            F.sum("capacity").alias("capacity"), F.max(F.col(f"w_{level}").cast("double")).alias("weight")
        )
        nodes = nodes.join(above, parent) if parent else nodes.withColumn("budget", F.lit(float(min(budget, total))))
        above = deal(nodes, parent, level).select(*path, F.col("share").alias("budget"))
    quota = F.least(F.floor(F.col("budget") + 1e-6), F.col("supply") * epochs)
    return leaves.join(above.select(*levels, "budget"), list(levels), "left").withColumn(
        "quota", F.when(F.col("budget").isNull(), 0).otherwise(quota).cast("bigint")
    )


def mix(
    docs: DataFrame, levels: dict[str, Column], weights: dict[str, Column], budget: int | None = None,
    share: float | None = None, epochs: int = EPOCHS, seed: int = SEED, doc_id: str = "doc_id", text: str = "text",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rows taken, with `n_tokens` and `epoch` (from 1); a document comes once for each epoch it is taken in.

    `levels` gives each level's value from the top down, `weights` each level's weight among its siblings. The
    budget is a number of tokens, or a share of all tokens.
    """
    names = [c for c in docs.columns if c not in ("n_tokens", "epoch")]
    path = [f"l{i}" for i in range(len(levels))]
    rows = docs.select(
        *(F.col(c).alias(f"c{i}") for i, c in enumerate(names)),
        *(_level(c).alias(p) for p, c in zip(path, levels.values(), strict=True)),
        *(weights[name].cast("double").alias(f"w_{p}") for p, name in zip(path, levels)),
    )
    body, name = F.col(f"c{names.index(text)}").cast("string"), F.col(f"c{names.index(doc_id)}")
    rows = rows.withColumn("n_tokens", token_count(body)).withColumn("h", F.md5(F.coalesce(body, F.lit(""))))
    id_text = F.coalesce(name.cast("string"), F.lit("null"))
    slim = rows.where("n_tokens > 0").select(*path, *(f"w_{p}" for p in path), id_text.alias("id"), "h", "n_tokens")
    slim = settle(slim, "tokens")
    each = [F.max(f"w_{p}").alias(f"w_{p}") for p in path]
    leaves = slim.groupBy(*path).agg(F.sum("n_tokens").alias("supply"), F.count(F.lit(1)).alias("rows"), *each)
    leaves = settle(leaves, "leaves")
    total = leaves.agg(F.coalesce(F.sum("supply"), F.lit(0)).alias("n")).first().n
    wanted = budget if budget is not None else int(total * share)
    quotas = leaf_quotas(leaves, path, wanted, epochs).select(
        *path, "quota",
        F.floor(F.col("quota") / F.col("supply")).alias("whole"),
        (F.col("quota") % F.col("supply")).alias("rest"),
        F.ceil(F.col("rows") / block_rows).alias("blocks"),
    )
    quotas = settle(quotas.where("quota > 0"), "quotas")

    key = hash_key(F.col("id"), F.lit(":"), F.col("whole") + 1, F.lit(f":{seed}"))
    dealt = lookup_join(slim, quotas.where("rest > 0"), path, "inner").withColumn("key", key)
    dealt = dealt.withColumn("block", F.floor(F.col("key") * F.col("blocks") / F.lit(KEY_RANGE)))
    sums = dealt.groupBy(*path, "block").agg(F.sum("n_tokens").alias("tokens"), F.max("rest").alias("rest"))
    upto = Window.partitionBy(*path).orderBy("block")
    sums = sums.withColumn("before", F.sum("tokens").over(upto) - F.col("tokens"))
    ends = settle(sums.where("before < rest and rest <= before + tokens").select(*path, "block", "before"), "ends")
    order = ["key", "id", "h"]
    within = Window.partitionBy(*path).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    last = lookup_join(dealt, ends, [*path, "block"], "inner").groupBy(*path, *order, "before", "rest")
    last = last.agg(F.sum("n_tokens").alias("n_tokens"))  # equal rows go together
    last = last.withColumn("before", F.col("before") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    cuts = last.where(F.col("before") < F.col("rest")).groupBy(*path).agg(F.max(F.struct(*order)).alias("cut"))
    plan = settle(quotas.join(cuts, path, "left").select(*path, "whole", "rest", "cut"), "cuts")

    taken = lookup_join(rows.where("n_tokens > 0").withColumn("id", id_text), plan, path, "inner")
    epoch = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("whole") + (F.col("rest") > 0).cast("bigint")))
    taken = taken.where("whole > 0 or rest > 0").withColumn("epoch", epoch)
    own = F.struct(hash_key(F.col("id"), F.lit(":"), F.col("epoch"), F.lit(f":{seed}")).alias("key"), "id", "h")
    taken = taken.where((F.col("epoch") <= F.col("whole")) | (own <= F.col("cut")))
    return taken.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names)), "n_tokens", F.col("epoch").cast("int").alias("epoch"))
