"""Fitted fills and scales. A fit returns a small (col, stat, value) table; apply turns it into literals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloop.operators.encode import long_values
from tabloop.operators.ranks import exact_quantiles
from tabloop.storage import small_table

STATS_SCHEMA = "col string, stat string, value string"
QUARTILES = (0.25, 0.5, 0.75)


def _stats(df: DataFrame, rows: list[tuple]) -> DataFrame:
    return small_table(df.sparkSession, rows, STATS_SCHEMA)


def _read(stats: DataFrame) -> dict[tuple[str, str], str | None]:
    return {(r.col, r.stat): r.value for r in stats.collect()}  # a few rows per feature column


def fit_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent value of each column, ties to the smallest. Counts are combined before the shuffle."""
    rows = []
    for values in long_values(df, cols).values():
        counts = values.groupBy("col", "category").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("col").agg(F.min_by("category", F.struct((-F.col("n")).alias("n"), "category")).alias("v"))
        rows += [(r.col, "mode", r.v) for r in best.select("col", F.col("v").cast("string")).collect()]
    return _stats(df, rows)


def fit_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean of the present values of each column."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
    return _stats(df, [(c, "mean", None if row[c] is None else repr(row[c])) for c in cols])


def fit_imputer(df: DataFrame, cat_cols: Sequence[str], num_cols: Sequence[str]) -> DataFrame:
    """Fill values: mode for categories, mean for numbers."""
    parts = []
    if cat_cols:
        parts.append(fit_mode(df, cat_cols))
    if num_cols:
        parts.append(fit_mean(df, num_cols))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def apply_imputer(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Fill missing cells with the fitted values; a column without any present value stays empty."""
    fills = {}
    for (col, stat), value in _read(stats).items():
        if stat in ("mode", "mean") and value is not None and col in df.columns:
            kind = "double" if stat == "mean" else df.schema[col].dataType
            fills[col] = F.coalesce(F.col(col).cast(kind), F.lit(value).cast(kind))
    return df.withColumns(fills) if fills else df


def fit_robust(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Quartiles of each column, with linear interpolation; exact=False reads them off one sketch pass."""
    exprs = {c: F.col(c).cast("double") for c in cols}
    if exact:
        quartiles = exact_quantiles(df, exprs, QUARTILES)
    else:
        row = df.agg(*[F.percentile_approx(e, list(QUARTILES), 10_000).alias(c) for c, e in exprs.items()]).first()
        quartiles = {c: row[c] or [None] * 3 for c in cols}
    return _stats(
        df,
        [
            (c, stat, None if value is None else repr(float(value)))
            for c in cols
            for stat, value in zip(("q25", "q50", "q75"), quartiles[c], strict=True)
        ],
    )


def apply_robust(df: DataFrame, stats: DataFrame, centering: bool = False) -> DataFrame:
    """Divide by the interquartile range (a zero range divides by 1), optionally after taking off the median."""
    fitted = _read(stats)
    scaled = {}
    for col in dict.fromkeys(c for c, s in fitted if s == "q25"):
        if col not in df.columns:
            continue
        low, middle, high = (fitted[(col, s)] for s in ("q25", "q50", "q75"))
        x = F.col(col).cast("double")
        if low is not None and high is not None and middle is not None:
            spread = float(high) - float(low)
            if centering:
                x = x - F.lit(float(middle))
            x = x / F.lit(spread if spread else 1.0)
        scaled[col] = x
    return df.withColumns(scaled) if scaled else df
