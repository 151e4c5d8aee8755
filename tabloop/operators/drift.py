"""How far captured data has moved from a reference table, per column and per request."""

from __future__ import annotations

import bisect
import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloop.operators.encode import category_count
from tabloop.operators.ordering import sample_exact
from tabloop.operators.ranks import exact_quantiles
from tabloop.operators.skew import lookup_join
from tabloop.storage import settle, small_table

REFERENCE_ROWS = 10_000  # fixed value: rows of the reference sample
THRESHOLD = 0.1  # fixed value: scores above this are drift
WINDOW_ROWS = 500_000  # distinct values that one task may sort
LN2 = math.log(2.0)


def reference_sample(df: DataFrame, n: int = REFERENCE_ROWS, seed: int = 1, row_id: str = "row_id") -> DataFrame:
    """The reference rows that requests are compared with."""
    return sample_exact(df, n, seed, row_id)


def fit_distribution(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(col, category, n, p): counts and shares of the present values of each column."""
    counts = settle(category_count(df, cols))
    totals = {r.col: r.t for r in counts.groupBy("col").agg(F.sum("n").alias("t")).collect()}
    return counts.withColumn("p", F.col("n") / _by_col(totals)) if totals else counts.withColumn("p", F.lit(0.0))


def _by_col(values: dict[str, int]) -> Column:
    return F.create_map(*[x for c, v in values.items() for x in (F.lit(c), F.lit(float(v)))])[F.col("col")]


def _half(p: Column, q: Column) -> Column:
    """p * ln(p / m) for m = (p + q) / 2, zero for p = 0."""
    return F.when(p > 0, p * F.ln(p / ((p + q) / 2))).otherwise(F.lit(0.0))


def _both(stats: DataFrame, current: DataFrame) -> DataFrame:
    """(col, category, p, q) over the categories of either side; one shuffle of counted categories."""
    sides = stats.select("col", "category", F.col("p"), F.lit(0.0).alias("q")).unionByName(
        current.select("col", "category", F.lit(0.0).alias("p"), F.col("p").alias("q"))
    )
    return sides.groupBy("col", "category").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))


def js_distance(stats: DataFrame, current: DataFrame) -> DataFrame:
    """(col, score): Jensen-Shannon distance of two fitted distributions, natural logarithm."""
    p, q = F.col("p"), F.col("q")
    divergence = F.sum(_half(p, q) + _half(q, p)) / 2
    return _both(stats, current).groupBy("col").agg(F.sqrt(F.greatest(divergence, F.lit(0.0))).alias("score"))


def psi(stats: DataFrame, current: DataFrame, floor: float = 1e-4) -> DataFrame:
    """(col, score): population stability index, shares not below `floor`."""
    p, q = F.greatest("p", F.lit(floor)), F.greatest("q", F.lit(floor))
    return _both(stats, current).groupBy("col").agg(F.sum((q - p) * F.ln(q / p)).alias("score"))


def _running(df: DataFrame, window_rows: int) -> tuple[DataFrame, int, int]:
    """(x, next_x, r, c) per distinct value: rows up to x on both sides, and the following value.

    Copies are counted first. When one task should not sort all values they are cut into quantile buckets:
    bucket totals give every bucket its start, so the running sums inside are independent.
    """
    values = settle(df.groupBy("x").agg(F.sum("r").alias("r"), F.sum("c").alias("c")))
    size = values.agg(F.count(F.lit(1)).alias("n"), F.sum("r").alias("r"), F.sum("c").alias("c")).first()
    if not size.n:
        return values.withColumn("next_x", F.col("x")), 0, 0
    if size.n <= window_rows:
        bucketed = values.withColumn("b", F.lit(0))
    else:
        pieces = min(10_000, math.ceil(2 * size.n / window_rows))
        row = values.agg(F.percentile_approx("x", [i / pieces for i in range(1, pieces)], 20 * pieces).alias("s")).first()
        splits = [-math.inf, *sorted(set(row.s)), math.inf]
        bucketed = Bucketizer(splits=splits, inputCol="x", outputCol="b").transform(values)
    totals = bucketed.groupBy("b").agg(F.min("x").alias("lo"), F.sum("r").alias("r"), F.sum("c").alias("c"))
    spans, r, c = [], 0, 0
    rows = totals.orderBy("b").collect()  # one row per bucket
    for i, t in enumerate(rows):
        spans.append((float(t.b), r, c, rows[i + 1].lo if i + 1 < len(rows) else None))
        r, c = r + t.r, c + t.c
    starts = small_table(df.sparkSession, spans, "b double, r0 bigint, c0 bigint, follow double")
    inside = Window.partitionBy("b").orderBy("x")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = (
        bucketed.withColumn("b", F.col("b").cast("double"))
        .join(F.broadcast(starts), "b")
        .select(
            "x",
            F.coalesce(F.lead("x").over(inside), "follow").alias("next_x"),
            (F.sum("r").over(upto) + F.col("r0")).alias("r"),
            (F.sum("c").over(upto) + F.col("c0")).alias("c"),
        )
    )
    return out, size.r, size.c


def _numbers(reference: DataFrame, current: DataFrame, col: str) -> DataFrame:
    x = F.col(col).cast("double").alias("x")
    sides = reference.select(x, F.lit(1).alias("r"), F.lit(0).alias("c")).unionByName(
        current.select(x, F.lit(0).alias("r"), F.lit(1).alias("c"))
    )
    return sides.where(F.col("x").isNotNull())


def wasserstein(reference: DataFrame, current: DataFrame, col: str, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """(col, score): area between the two distribution functions over the reference's standard deviation."""
    running, r, c = _running(_numbers(reference, current, col), window_rows)
    spread = reference.agg(F.stddev_pop(F.col(col).cast("double")).alias("s")).first().s
    gap = F.abs(F.col("r") / max(r, 1) - F.col("c") / max(c, 1)) * (F.col("next_x") - F.col("x"))
    divisor = F.lit(max(spread or 0.0, 0.001))  # fixed value: smallest spread used
    return running.agg((F.coalesce(F.sum(gap), F.lit(0.0)) / divisor).alias("score")).select(F.lit(col).alias("col"), "score")


def ks(reference: DataFrame, current: DataFrame, col: str, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """(col, score): largest gap between the two distribution functions."""
    running, r, c = _running(_numbers(reference, current, col), window_rows)
    gap = F.abs(F.col("r") / max(r, 1) - F.col("c") / max(c, 1))
    return running.agg(F.coalesce(F.max(gap), F.lit(0.0)).alias("score")).select(F.lit(col).alias("col"), "score")


def verdict(scores: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return scores.withColumn("is_drift", F.when(F.col("score") > threshold, 1).otherwise(0))


def default_method(df: DataFrame, col: str) -> str:
    return "js" if df.schema[col].dataType.typeName() in ("string", "boolean") else "wasserstein"


def column_drift(
    reference: DataFrame,
    current: DataFrame,
    cols: Sequence[str] = ("feature3",),
    method: str | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(col, score, is_drift). Method by column type unless named: js, psi, wasserstein or ks."""
    by_method: dict[str, list[str]] = {}
    for c in cols:
        by_method.setdefault(method or default_method(reference, c), []).append(c)
    parts = []
    for name, members in by_method.items():
        if name in ("js", "psi"):
            fitted = [fit_distribution(d, members) for d in (reference, current)]
            parts.append((js_distance if name == "js" else psi)(*fitted))
        elif name in ("wasserstein", "ks"):
            measure = wasserstein if name == "wasserstein" else ks
            parts += [measure(reference, current, c) for c in members]
        else:
            raise ValueError(f"unknown drift method: {name}")
    scores = parts[0]
    for part in parts[1:]:
        scores = scores.unionByName(part)
    return verdict(scores, threshold)


def dataset_drift(columns: DataFrame) -> DataFrame:
    """Number and share of drifted columns."""
    return columns.agg(F.sum("is_drift").alias("n"), F.avg("is_drift").alias("share"))


def fit_bins(df: DataFrame, cols: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Inner quantile boundaries of number columns, to compare them as categories."""
    probs = [i / bins for i in range(1, bins)]
    found = exact_quantiles(df, {c: F.col(c).cast("double") for c in cols}, probs)
    return {c: sorted({v for v in values if v is not None}) for c, values in found.items()}


def apply_bins(df: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """Numbers to bin numbers (as text); missing stays missing."""
    binned = {}
    for c, bounds in cuts.items():
        x, number = F.col(c).cast("double"), F.lit(0)
        for cut in bounds:
            number = F.when(x > F.lit(cut), F.lit(bisect.bisect_right(bounds, cut))).otherwise(number)
        binned[c] = F.when(x.isNotNull(), number).cast("string")
    return df.withColumns(binned)


def drift_per_key(
    stats: DataFrame, df: DataFrame, key: str = "id", col: str = "feature3", threshold: float = THRESHOLD
) -> DataFrame:
    """(key, score, is_drift): Jensen-Shannon distance of every request from the fitted reference, in one job.

    A reference category that a request lacks adds p * ln 2 / 2, so only present categories are joined. A
    request without any present value is fully apart from the reference. Rows without a key are one request.
    """
    return drift_per_key_columns(stats, df, key, [col], threshold).drop("col")


def drift_per_key_columns(
    stats: DataFrame, df: DataFrame, key: str = "id", cols: Sequence[str] = ("feature3",), threshold: float = THRESHOLD
) -> DataFrame:
    """(key, col, score, is_drift) for several columns in one job; numbers are binned first (`fit_bins`)."""
    name = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"))
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("category")) for c in cols]))
    rows = df.select(name.alias("_key"), pairs.alias("_p")).select("_key", "_p.col", "_p.category")
    cells = rows.groupBy("_key", "col", "category").agg(F.count("category").alias("n"))
    side = stats.where(F.col("col").isin(list(cols))).select("col", "category", "p")
    matched = lookup_join(cells, side, ["col", "category"])
    # the window and the aggregate share one partitioning
    total = F.sum("n").over(Window.partitionBy("_key", "col"))
    shares = matched.withColumn("t", total)
    p, q = F.coalesce("p", F.lit(0.0)), F.col("n") / F.col("t")
    present = F.col("n") > 0
    sums = shares.groupBy("_key", "col").agg(
        F.max("t").alias("t"),
        F.sum(F.when(present, _half(p, q) + _half(q, p))).alias("s"),
        F.sum(F.when(present, p)).alias("seen"),
    )
    inside = F.coalesce("s", F.lit(0.0)) + (F.lit(1.0) - F.coalesce("seen", F.lit(0.0))) * LN2
    empty = F.when(F.col("t") == 0, F.lit(2 * LN2)).otherwise(inside)
    score = F.sqrt(F.greatest(empty / 2, F.lit(0.0))).alias("score")
    return verdict(sums.select(F.col("_key.key").alias(key), "col", score), threshold)


def drift_rate(df: DataFrame) -> DataFrame:
    """Drifted requests over all requests."""
    return df.agg(F.avg("is_drift").alias("rate"))
