"""Turning scored, unlabelled rows into training labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloop.functions.numbers import flip
from tabloop.operators import minibatch
from tabloop.operators.columns import append, by_confidence, distinct_rows
from tabloop.operators.neighbours import nearest_centroid
from tabloop.operators.ordering import cut_n
from tabloop.operators.skew import lookup_join
from tabloop.storage import settle, small_table

# fixed values: confidence given to propagated labels, rows that keep the model's label
PROPAGATED_PROB = 0.8
KEPT_ROWS = 8000


def consensus(
    dfs: Sequence[DataFrame], on: str = "row_id", max_dev: float = 0.05, min_prob: float = 0.9
) -> DataFrame:
    """Combine several scorings of the same rows.

    The first table's label stays when all labels are equal, its confidence is within `max_dev` of the mean
    and the smallest confidence reaches `min_prob`; otherwise it is flipped. `prob` becomes the mean. The
    labels of all models are stacked and combined in one shuffle on the unique row id, whatever their number;
    the other columns of the first table meet the result on the same partitioning. A row id that a table repeats or
    lacks is an error. A missing label or confidence is no agreement.
    """
    extras = [c for c in dfs[0].columns if c not in (on, "label_model", "prob")]
    stacked = append(*[d.select(on, F.lit(i).alias("_m"), "label_model", "prob") for i, d in enumerate(dfs)])
    here = [F.col("_m") == i for i in range(len(dfs))]
    grouped = stacked.groupBy(on).agg(
        *[F.count_if(h).alias(f"_n{i}") for i, h in enumerate(here)],
        F.count("label_model").alias("_labels"),
        F.min("label_model").alias("_least"),
        F.max("label_model").alias("_most"),
        F.max(F.when(here[0], F.col("label_model"))).alias("label_model"),
        *[F.max(F.when(h, F.col("prob"))).alias(f"_p{i}") for i, h in enumerate(here)],
    )
    once = F.lit(True)
    for i in range(len(dfs)):
        once = once & (F.col(f"_n{i}") == 1)
    problem = F.concat(F.lit(f"{on} is not once in every table: "), F.coalesce(F.col(on).cast("string"), F.lit("null")))
    grouped = grouped.where(F.when(once, True).otherwise(F.raise_error(problem).cast("boolean")))
    probs = [F.col(f"_p{i}") for i in range(len(dfs))]
    mean = sum(probs[1:], probs[0]) / len(dfs)
    agreed = (F.col("_labels") == len(dfs)) & (F.col("_least") == F.col("_most"))
    agreed = agreed & (F.abs(probs[0] - mean) < max_dev) & (F.least(*probs) >= min_prob)
    label = F.when(F.coalesce(agreed, F.lit(False)), F.col("label_model")).otherwise(flip("label_model"))
    decided = grouped.select(on, label.cast("int").alias("label_model"), mean.alias("prob"))
    return dfs[0].select(on, *extras).join(decided, on) if extras else decided


def model_spread(dfs: Sequence[DataFrame], on: str = "row_id") -> DataFrame:
    """Mean, smallest and largest confidence of every row over several scorings."""
    stacked = append(*[d.select(on, F.lit(i).alias("_m"), "prob") for i, d in enumerate(dfs)])
    probs = [F.col(f"_p{i}") for i in range(len(dfs))]
    wide = stacked.groupBy(on).agg(
        *[F.max(F.when(F.col("_m") == i, F.col("prob"))).alias(f"_p{i}") for i in range(len(dfs))]
    )
    return wide.select(
        on,
        (sum(probs[1:], probs[0]) / len(dfs)).alias("mean_prob"),
        F.least(*probs).alias("min_prob"),
        F.greatest(*probs).alias("max_prob"),
    )


def replace_low_confidence(
    df: DataFrame, other: DataFrame, threshold: float = 0.7, on: str = "row_id", label: str = "label_model"
) -> DataFrame:
    """Rows with prob <= threshold take the other table's label; only those rows are shuffled."""
    low = F.coalesce(F.col("prob") <= threshold, F.lit(False))
    swapped = df.where(low).join(other.select(on, F.col(label).alias("_other")), on, "left")
    return df.where(~low).unionByName(
        swapped.withColumn(label, F.coalesce("_other", label)).drop("_other").select(*df.columns)
    )


def flip_low(df: DataFrame, threshold: float = 0.9, mode: str = "sequential", label: str = "label_model") -> DataFrame:
    """Change labels of rows with prob < threshold.

    "sequential" turns 1 to 0 and then 0 to 1, so that every low 0/1 row ends as 1; "swap" exchanges them.
    """
    low, y = F.col("prob") < threshold, F.col(label)
    if mode == "sequential":
        df = df.withColumn(label, F.when(low & (y == 1), F.lit(0)).otherwise(y))
        return df.withColumn(label, F.when(low & (F.col(label) == 0), F.lit(1)).otherwise(F.col(label)))
    if mode == "swap":
        return df.withColumn(label, F.when(low & (y == 1), F.lit(0)).when(low & (y == 0), F.lit(1)).otherwise(y))
    raise ValueError(f"unknown mode: {mode}")


def gate_positive(df: DataFrame, threshold: float, label: str = "label_model") -> DataFrame:
    """Class 1 below the threshold becomes 0."""
    y = F.col(label)
    return df.withColumn(label, F.when((y == 1) & (F.col("prob") < threshold), F.lit(0)).otherwise(y))


def rows_not_in(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of `a`, with repeats, that equal no row of `b` in every column; a missing value equals nothing.

    Copies of `a` are counted before the shuffle and written out again after it, so one row that makes up
    much of the table is joined once.
    """
    cols = a.columns
    counted = a.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    right = b.select(*cols).distinct().select(*[F.col(c).alias(f"_b_{c}") for c in cols])
    match = F.lit(True)
    for c in cols:
        match = match & (F.col(c) == F.col(f"_b_{c}"))
    left = counted.join(right, match, "left_anti")
    step = 100_000
    spread = left.withColumn("_s", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, F.lit(step).cast("bigint"))))
    many = spread.where(F.col("_n") > step).repartition("_s", *cols)
    few = spread.where(F.col("_n") <= step)
    out = few.unionByName(many)
    times = F.least(F.lit(step).cast("bigint"), F.col("_n") - F.col("_s"))
    return out.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), times))).select(*cols)


def merge_corrected(old: DataFrame, new: DataFrame, threshold: float = 0.9, label: str = "label_model") -> DataFrame:
    """Corrected low-confidence rows, flipped new ones the correction does not hold, and confident new rows.

    Both limits are strict: rows at exactly the threshold are in neither part.
    """
    old, new = distinct_rows(old), distinct_rows(new)
    old_low = by_confidence(old, high=threshold)
    new_low, new_high = by_confidence(new, high=threshold), by_confidence(new, low=threshold)
    unknown = rows_not_in(new_low, old_low.select(*new.columns)).withColumn(label, F.lit(1) - F.col(label))
    return append(unknown, old_low.select(*new.columns), new_high)


def labelled_match_count(requests: DataFrame, labelled: DataFrame, cols: Sequence[str]) -> DataFrame:
    """How many distinct request rows occur in the labelled set, compared on all features, empty equal to empty."""
    left = requests.select(*cols).distinct()
    right = labelled.select(*[F.col(c).alias(f"_l_{c}") for c in cols]).distinct()
    match = F.lit(True)
    for c in cols:
        match = match & F.col(c).eqNullSafe(F.col(f"_l_{c}"))
    return left.join(right, match, "left_semi").agg(F.count(F.lit(1)).alias("n"))


def labelled_matches(requests: DataFrame, labelled: DataFrame, cols: Sequence[str], label: str = "label") -> DataFrame:
    """Distinct request rows with the label of the last labelled row (largest row id) of the same features."""
    last = labelled.groupBy(*cols).agg(F.max_by(label, "row_id").alias(label))
    right = last.select(*[F.col(c).alias(f"_l_{c}") for c in cols], label)
    match = F.lit(True)
    for c in cols:
        match = match & F.col(c).eqNullSafe(F.col(f"_l_{c}"))
    return requests.select(*cols).distinct().join(right, match).select(*cols, label)


def vote(df: DataFrame, cluster: str = "cluster", label: str = "label", ml_type: str = "classification") -> DataFrame:
    """(cluster, label): most frequent label, ties to the smallest; the mean for a regression."""
    if ml_type == "regression":
        return df.groupBy(cluster).agg(F.avg(F.col(label).cast("double")).alias(label))
    counts = df.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min_by(label, F.struct((-F.col("_n")).alias("n"), F.col(label).alias("l")))
    return counts.groupBy(cluster).agg(best.alias("_label")).withColumnRenamed("_label", label)


def propagate_assigned(
    captured: DataFrame, votes: DataFrame, cluster: str = "cluster", label: str = "label", default=0
) -> DataFrame:
    """Give captured rows, already assigned to clusters, their cluster's label; a cluster without votes gives 0."""
    kind = votes.schema[label].dataType
    out = lookup_join(captured, settle(votes.select(cluster, F.col(label).alias("_vote"))), [cluster])
    named = F.coalesce("_vote", F.lit(default).cast(kind))
    return out.withColumn("label_model", named).withColumn("prob", F.lit(PROPAGATED_PROB)).drop("_vote")


def propagate_given(
    labelled: DataFrame,
    captured: DataFrame,
    centroids: DataFrame,
    cols: Sequence[str],
    label: str = "label",
    ml_type: str = "classification",
) -> DataFrame:
    """Cluster label propagation with given centroids."""
    votes = vote(nearest_centroid(labelled, centroids, cols), "cluster", label, ml_type)
    return propagate_assigned(nearest_centroid(captured, centroids, cols), votes, "cluster", label)


def fit_centroids(df: DataFrame, cols: Sequence[str], k: int = minibatch.CLUSTERS, seed: int = 1242) -> DataFrame:
    """(cluster, <cols>): centres of a mini-batch k-means fit; `cols` are number columns or one array column."""
    one_array = len(cols) == 1 and df.schema[cols[0]].dataType.typeName() == "array"
    vec = F.col(cols[0]).cast("array<double>") if one_array else F.array(*[F.col(c).cast("double") for c in cols])
    centres = minibatch.fit(df, vec, k, seed).tolist()
    if one_array:
        rows, kinds = [(i, c) for i, c in enumerate(centres)], f"cluster int, {cols[0]} array<double>"
    else:
        rows, kinds = [(i, *c) for i, c in enumerate(centres)], ", ".join(["cluster int", *[f"{c} double" for c in cols]])
    return small_table(df.sparkSession, rows, kinds)


def propagate(
    labelled: DataFrame,
    captured: DataFrame,
    cols: Sequence[str],
    k: int = minibatch.CLUSTERS,
    keep_first: int = 0,
    label: str = "label",
    seed: int = 1242,
    ml_type: str = "classification",
    row_id: str = "row_id",
) -> DataFrame:
    """Relabel captured rows by the k-means clusters of the labelled rows.

    The first `keep_first` captured rows (by row id) keep the label and confidence they came with.
    """
    centroids = fit_centroids(labelled, cols, k, seed)
    if not keep_first:
        return propagate_given(labelled, captured, centroids, cols, label, ml_type).drop("cluster")
    kept, rest = cut_n(captured, keep_first, [row_id])
    new = propagate_given(labelled, rest.drop("label_model", "prob"), centroids, cols, label, ml_type)
    return append(kept, new.drop("cluster").select(*kept.columns))
