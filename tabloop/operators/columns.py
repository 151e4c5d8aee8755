"""Projections, renames and value filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloop.functions.numbers import narrow, truncate

# fixed values: columns that scoring adds and training must not see
BOOKKEEPING = ("batch_id", "is_drift", "prob", "label_model", "label", "Cluster")


def select_features(
    df: DataFrame,
    features: Sequence[str],
    missing: str = "error",
    types: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Features in a fixed order after the `keep` columns; an absent one is an error or, with "null", empty."""
    absent = [c for c in features if c not in df.columns]
    if absent and missing == "error":
        raise ValueError(f"missing feature columns: {absent}")
    types = types or {}
    return df.select(
        *keep, *[F.lit(None).cast(types.get(c, "double")).alias(c) if c in absent else F.col(c) for c in features]
    )


def drop_columns(df: DataFrame, names: Sequence[str] = BOOKKEEPING, strict: bool = False) -> DataFrame:
    """Drop columns; with `strict` an absent name is an error."""
    absent = [c for c in names if c not in df.columns]
    if strict and absent:
        raise ValueError(f"no such columns: {absent}")
    return df.drop(*names)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def standardize_names(df: DataFrame) -> DataFrame:
    """Blanks to underscores, lower case."""
    return df.toDF(*[c.replace(" ", "_").lower() for c in df.columns])


def drop_last_columns(df: DataFrame, n: int = 2) -> DataFrame:
    return df.select(*df.columns[: len(df.columns) - n])


def columns_of_type(df: DataFrame, kind: type[T.DataType] = T.StringType) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kind)]


def mask_value(df: DataFrame, col: str | None, value, replacement) -> DataFrame:
    """Replace one value of a column; nothing to do for an absent column or no value."""
    if col is None or value is None or col not in df.columns:
        return df
    return df.withColumn(col, F.when(F.col(col) == F.lit(value), F.lit(replacement)).otherwise(F.col(col)))


def fill_unknown(df: DataFrame, cols: Sequence[str] | None = None, value: str = "Unknown") -> DataFrame:
    """Fill missing categories (all text columns unless named)."""
    return df.fillna(value, subset=list(cols) if cols is not None else columns_of_type(df))


def by_confidence(
    df: DataFrame, low: float | None = None, high: float | None = None, closed: str = "neither"
) -> DataFrame:
    """Rows with low < prob < high; `closed` = "low", "high" or "both" includes those ends."""
    prob = F.col("prob")
    if low is not None:
        df = df.where(prob >= low if closed in ("low", "both") else prob > low)
    if high is not None:
        df = df.where(prob <= high if closed in ("high", "both") else prob < high)
    return df


def mispredictions(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.where(F.col(label) != F.col(prediction))


def constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def truncate_columns(df: DataFrame, cols: Sequence[str], places: int = 8) -> DataFrame:
    return df.withColumns({c: truncate(c, places) for c in cols})


def narrow_numbers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Number columns as the shortest JSON number text."""
    return df.withColumns({c: narrow(c) for c in cols})


def predictions_to_int(df: DataFrame, col: str = "prediction") -> DataFrame:
    return df.withColumn(col, F.col(col).cast("int"))


def distinct_rows(df: DataFrame, row_id: str | None = None) -> DataFrame:
    """Distinct rows; with `row_id` rows that are alike but for it are one, under the smallest id."""
    if row_id is None:
        return df.dropDuplicates()
    rest = [c for c in df.columns if c != row_id]
    return df.groupBy(*rest).agg(F.min(row_id).alias(row_id)).select(*df.columns)


def append(*dfs: DataFrame, source: Sequence[str] | None = None) -> DataFrame:
    """Stack tables by column name, absent columns empty; `source` names each part in a `source` column."""
    if source is not None:
        dfs = tuple(d.withColumn("source", F.lit(s)) for d, s in zip(dfs, source, strict=True))
    stacked = dfs[0]
    for d in dfs[1:]:
        stacked = stacked.unionByName(d, allowMissingColumns=True)
    return stacked


def pair(x: DataFrame, y: DataFrame, on: str = "row_id") -> DataFrame:
    """Features and target of the same rows; keys must be unique and the same on both sides."""
    sides = x.select(on, F.lit(1).alias("_x"), F.lit(0).alias("_y")).unionByName(
        y.select(on, F.lit(0).alias("_x"), F.lit(1).alias("_y"))
    )
    bad = sides.groupBy(on).agg(F.sum("_x").alias("_x"), F.sum("_y").alias("_y")).where("_x <> 1 or _y <> 1")
    if bad.limit(1).count():
        raise ValueError(f"{on} does not pair the two tables one to one")
    return x.join(y, on)
