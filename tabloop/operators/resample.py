"""Class rebalancing: synthetic minority rows, undersampling, duplicated extremes."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloop.functions.keys import hash_key, uniform
from tabloop.operators.columns import append
from tabloop.operators.evaluate import collect_counts
from tabloop.operators.neighbours import LEAF_ROWS, knn_lists
from tabloop.operators.ordering import prefix_by_group, shuffled, top_confidence
from tabloop.operators.skew import lookup_join
from tabloop.storage import settle

COPIES_PER_STEP = 1000  # copies of one source row made by one task


def _value_of(group: str, values: Mapping[object, int]):
    column = F.lit(0)
    for g, v in values.items():
        if v:
            column = F.when(F.col(group) == F.lit(g), F.lit(v)).otherwise(column)
    return column


def _copies(df: DataFrame, most: int) -> DataFrame:
    """One row per (row, copy 1..copies); rows with very many copies are spread over tasks first."""
    if most > COPIES_PER_STEP:
        starts = F.sequence(F.lit(0), F.col("copies") - 1, F.lit(COPIES_PER_STEP))
        df = df.withColumn("_start", F.explode(starts)).repartition("_id", "_start")
        stop = F.least(F.col("copies"), F.col("_start") + COPIES_PER_STEP)
        return df.withColumn("copy", F.explode(F.sequence(F.col("_start") + 1, stop))).drop("_start")
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))


def _synthesise(
    df: DataFrame,
    group: str,
    wanted: Mapping[object, int],
    sizes: Mapping[object, int],
    cols: Sequence[str],
    k: int,
    seed: int,
    row_id: str,
    leaf_rows: int,
) -> DataFrame:
    """New rows x + u * (neighbour - x), as many per group as wanted.

    Every row of a group is a source equally often; what does not divide evenly goes to the rows first in
    the seeded order. Neighbour and u come from hashes of (row, copy), so a lost task makes the same rows.
    """
    wanted = {g: n for g, n in wanted.items() if n > 0}
    for g in wanted:
        if sizes[g] <= k:
            raise ValueError(f"{k} neighbours need more than the {sizes[g]} rows of {group} = {g}")
    members = settle(df.where(F.col(group).isin(*wanted)))  # only the rows of classes to raise are written
    whole = {g: n // sizes[g] for g, n in wanted.items()}
    extra = {g: n % sizes[g] for g, n in wanted.items()}
    first = prefix_by_group(members, group, extra, sizes, shuffled(members, seed, row_id))
    sources = members.withColumn("copies", _value_of(group, whole) + F.when(first, 1).otherwise(0))
    sources = sources.where("copies > 0")
    asked = None if all(whole.values()) else sources
    near = knn_lists(members, k, cols, group, asked, row_id, leaf_rows, skip_same_id=True)
    near = near.select(F.col("id").alias("_id"), F.col("entries.nn").alias("_near"))
    made = sources.withColumn("_id", F.col(row_id).cast("bigint")).join(near, "_id")
    made = _copies(made, max(whole.values()) + 1)
    pick = (hash_key(F.col("_id"), ":", F.col("copy"), f":nn:{seed}") % k).cast("int")
    made = made.withColumn("_nn", F.col("_near")[pick]).withColumn(
        "_u", uniform(F.col("_id"), ":", F.col("copy"), f":u:{seed}")
    )
    ends = members.select(F.col(row_id).cast("bigint").alias("_nn"), *[F.col(c).cast("double").alias(f"_n_{c}") for c in cols])
    made = lookup_join(made.drop("_near"), ends, ["_nn"], "inner", settle_left=True)
    between = {c: F.col(c).cast("double") + F.col("_u") * (F.col(f"_n_{c}") - F.col(c).cast("double")) for c in cols}
    return settle(made.withColumns(between).drop("copies", "_id", "_nn", "_u", *[f"_n_{c}" for c in cols]))


def _with_originals(df: DataFrame, made: DataFrame, cols: Sequence[str], label: str, row_id: str) -> DataFrame:
    keep = [F.col(row_id), *[F.col(c).cast("double").alias(c) for c in cols], F.col(label)]
    originals = df.select(*keep, F.lit(0).alias("copy"), F.lit(False).alias("is_synthetic"))
    return originals.unionByName(made.select(*keep, F.col("copy").cast("int"), F.lit(True).alias("is_synthetic")))


def smote(
    df: DataFrame,
    label: str,
    cols: Sequence[str],
    k: int = 5,
    strategy: str = "auto",
    seed: int = 1242,
    row_id: str = "row_id",
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Raise classes to the majority count with synthetic rows; adds `copy` and `is_synthetic`.

    "auto" raises every class, "minority" only the smallest (ties to the smallest label).
    """
    df = settle(df.select(row_id, *cols, label), "classes")  # counted, searched and returned
    sizes = collect_counts(df, label)
    top = max(sizes.values(), default=0)
    if strategy == "auto":
        wanted = {g: top - n for g, n in sizes.items()}
    elif strategy == "minority":
        smallest = min(sizes, key=lambda g: (sizes[g], g))
        wanted = {smallest: top - sizes[smallest]}
    else:
        raise ValueError(f"unknown strategy: {strategy}")
    if not any(wanted.values()):
        return _with_originals(df, df.limit(0).withColumn("copy", F.lit(0)), cols, label, row_id)
    made = _synthesise(df, label, wanted, sizes, cols, k, seed, row_id, leaf_rows)
    return _with_originals(df, made, cols, label, row_id)


def synthetic_only(df: DataFrame) -> DataFrame:
    return df.where("is_synthetic")


def cluster_sparsity(n: int, variance_sum: float) -> float:
    """Weight of a cluster: its root mean squared pair distance, raised with the cluster size, per row."""
    spread = math.sqrt(2.0 * variance_sum)
    return spread ** (math.log(n, 1.6) ** 1.8 * 0.16) / n


def cluster_shares(clusters: Mapping[object, tuple[int, float]]) -> dict[object, float]:
    """Share of each cluster (rows, sum of variances) in the weights, even if all are 0.

    Weights of large clusters exceed what a double holds, so their logarithms are taken relative to the largest.
    """
    logs = {}
    for c, (n, variance_sum) in clusters.items():
        power = math.log(n, 1.6) ** 1.8 * 0.16
        spread = 0.5 * math.log(2.0 * variance_sum) if variance_sum > 0 else -math.inf
        logs[c] = (power * spread if power else 0.0) - math.log(n)
    most = max(logs.values())
    if most == -math.inf:
        return {c: 1 / len(logs) for c in logs}
    weights = {c: math.exp(x - most) for c, x in logs.items()}
    total = sum(weights.values())
    return {c: w / total for c, w in weights.items()}


def cluster_smote(
    df: DataFrame,
    cluster: str,
    label: str,
    cols: Sequence[str],
    k: int = 5,
    seed: int = 1242,
    row_id: str = "row_id",
    balance_threshold: float = 0.5,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """SMOTE of the smallest class inside given clusters that are rich in it.

    A cluster takes part when its share of the class reaches `balance_threshold` and it has more than k of
    its rows. New rows are shared out by sparsity, rounded up per cluster.
    """
    df = settle(df.select(row_id, cluster, *cols, label), "clusters")  # counted, searched and returned
    classes = collect_counts(df, label)
    smallest = min(classes, key=lambda g: (classes[g], g))
    missing = max(classes.values()) - classes[smallest]
    member = F.col(label) == F.lit(smallest)
    spread = sum((F.coalesce(F.var_samp(F.when(member, F.col(c).cast("double"))), F.lit(0.0)) for c in cols), F.lit(0.0))
    stats = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(member).alias("m"), spread.alias("spread")
    ).collect()  # one row per cluster
    rich = [r for r in stats if r.m / r.n >= balance_threshold and r.m > k]
    if not rich:
        raise ValueError("no cluster is rich enough in the smallest class")
    shares = cluster_shares({r[cluster]: (r.m, r.spread) for r in rich})
    wanted = {c: math.ceil(round(missing * share, 9)) for c, share in shares.items()}
    sizes = {r[cluster]: r.m for r in rich}
    made = _synthesise(df.where(member), cluster, wanted, sizes, cols, k, seed, row_id, leaf_rows)
    return _with_originals(df, made, cols, label, row_id)


def undersample(df: DataFrame, label: str = "label", seed: int = 1242, row_id: str | Sequence[str] = "row_id") -> DataFrame:
    """Every class down to the smallest, rows kept by seeded order; nothing is moved or sorted."""
    sizes = collect_counts(df, label)
    if not sizes:
        return df
    smallest = min(sizes.values())
    if isinstance(row_id, str):
        order = shuffled(df, seed, row_id)
    else:
        text = [x for c in row_id for x in (F.col(c), F.lit(":"))]
        order = [hash_key(*text, f":{seed}"), *row_id]
    return df.where(prefix_by_group(df, label, {g: smallest for g in sizes}, sizes, order))


def duplicate_extremes(df: DataFrame, k: int = 5000, row_id: str = "row_id", renumber: bool = False) -> DataFrame:
    """The table plus its k most and k least confident rows once more.

    With `renumber` ids become 3 * id + 0, 1 or 2, so that they stay unique.
    """
    parts = [df, top_confidence(df, k, False, row_id), top_confidence(df, k, True, row_id)]
    if renumber:
        parts = [p.withColumn(row_id, F.col(row_id) * 3 + i) for i, p in enumerate(parts)]
    return append(*parts)
