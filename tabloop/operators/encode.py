"""Category index, integer codes, label map and one-hot columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloop.operators.ordering import number_rows
from tabloop.operators.skew import lookup_join
from tabloop.storage import settle, small_table

LITERAL_CATEGORIES = 64  # per column: codes up to here are part of the expression, no join
SORTED_CATEGORIES = 200_000  # categories of one column that one task may rank
MAX_LABELS = 100_000  # classes of one label


def long_values(df: DataFrame, cols: Sequence[str], name: str = "category") -> dict[str, DataFrame]:
    """Per column type, a (col, value) table of all cells; one scan each, combined before any shuffle."""
    by_type: dict[str, list[str]] = {}
    for c in cols:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    return {
        kind: df.select(*members).unpivot([], members, "col", name).where(F.col(name).isNotNull())
        for kind, members in by_type.items()
    }


def fit_category_index(df: DataFrame, cols: Sequence[str], sorted_limit: int = SORTED_CATEGORIES) -> DataFrame:
    """(col, code, category): sorted distinct values of each column, coded from 0; numbers sort as numbers."""
    parts = []
    for values in long_values(df, cols).values():
        distinct = settle(values.distinct())
        widest = distinct.groupBy("col").count().agg(F.max("count")).first()[0] or 0
        if widest <= sorted_limit:
            rank = F.row_number().over(Window.partitionBy("col").orderBy("category")) - 1
            parts.append(distinct.select("col", rank.cast("int").alias("code"), F.col("category").cast("string")))
        else:
            parts.append(_rank_by_range(distinct))
    index = parts[0]
    for part in parts[1:]:
        index = index.unionByName(part)
    return index


def _rank_by_range(distinct: DataFrame) -> DataFrame:
    """Codes of columns too wide for one task: all values are numbered in order, less each column's start."""
    placed = number_rows(distinct, ["col", "category"], "_n")
    starts = {r.col: r.s for r in placed.groupBy("col").agg(F.min("_n").alias("s")).collect()}
    start = F.create_map(*[x for c, n in starts.items() for x in (F.lit(c), F.lit(n))])[F.col("col")]
    return placed.select("col", (F.col("_n") - start).cast("int").alias("code"), F.col("category").cast("string"))


def _small_columns(stats: DataFrame, cols: Sequence[str], limit: int) -> dict[str, list]:
    """Fitted rows of the columns with at most `limit` categories; at most limit + 1 rows per column are read."""
    first = stats.where(F.col("col").isin(*cols) & (F.col("code") <= limit)).collect()
    rows = {c: sorted((r for r in first if r.col == c), key=lambda r: r.code) for c in cols}
    return {c: found for c, found in rows.items() if len(found) <= limit}


def apply_codes(
    df: DataFrame,
    stats: DataFrame,
    cols: Sequence[str] | None = None,
    unseen: int = -1,
    literal_limit: int = LITERAL_CATEGORIES,
) -> DataFrame:
    """Replace categories by their fitted codes; missing or unseen ones become `unseen`."""
    if cols is None:
        fitted = {r.col for r in stats.select("col").distinct().collect()}
        cols = [c for c in df.columns if c in fitted]
    small = _small_columns(stats, cols, literal_limit) if cols else {}
    types = {c: df.schema[c].dataType for c in cols}
    literal = {}
    for c, rows in small.items():
        if not rows:
            literal[c] = F.lit(unseen)
            continue
        pairs = [x for r in rows for x in (F.lit(r.category).cast(types[c]), F.lit(r.code))]
        literal[c] = F.coalesce(F.element_at(F.create_map(*pairs), F.col(c)), F.lit(unseen))
    order = df.columns
    coded = df.withColumns(literal) if literal else df
    for c in cols:
        if c not in small:
            side = stats.where(F.col("col") == c).select(
                F.col("category").cast(types[c]).alias(c), F.col("code").alias("_code")
            )
            coded = lookup_join(coded, side, [c]).withColumn(c, F.coalesce("_code", F.lit(unseen))).drop("_code")
    return coded.select(*order)


def build_category_features(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Fit the index on a table and code the same table."""
    stats = fit_category_index(df, cols)
    return apply_codes(df, stats, cols), stats


def fit_labels(df: DataFrame, col: str = "label") -> DataFrame:
    """(code, label): sorted classes, coded from 0."""
    return fit_category_index(df, [col]).select("code", F.col("category").alias("label"))


def _labels(stats: DataFrame) -> list:
    rows = stats.orderBy("code").limit(MAX_LABELS + 1).collect()
    if len(rows) > MAX_LABELS:
        raise ValueError("this many distinct labels are not classes")
    return rows


def _look_up(df: DataFrame, col: str, pairs: list[tuple], kinds: str) -> DataFrame:
    """Add `_new`, the second of the pair whose first equals the column."""
    if len(pairs) <= LITERAL_CATEGORIES:
        literal = [x for old, new in pairs for x in (F.lit(old), F.lit(new))]
        old = kinds.split(",")[0].split()[1]
        found = F.element_at(F.create_map(*literal), F.col(col).cast(old)) if literal else F.lit(None)
        return df.withColumn("_new", found)
    side = small_table(df.sparkSession, pairs, kinds)  # at most MAX_LABELS rows
    key = kinds.split(",")[0].split()
    joined = df.withColumn("_old", F.col(col).cast(key[1])).join(F.broadcast(side), "_old", "left")
    return joined.select(*df.columns, "_new")


def encode_labels(df: DataFrame, stats: DataFrame, col: str = "label") -> DataFrame:
    """Replace class names by codes; a class that was not fitted is an error when rows are read."""
    found = _look_up(df, col, [(r.label, r.code) for r in _labels(stats)], "_old string, _new int")
    message = F.concat(F.lit("label not seen when fitting: "), F.coalesce(F.col(col).cast("string"), F.lit("null")))
    code = F.coalesce("_new", F.raise_error(message).cast("int"))
    return found.withColumn(col, code).select(*df.columns)


def decode_labels(df: DataFrame, stats: DataFrame, col: str = "label_model") -> DataFrame:
    """Replace class codes by class names."""
    found = _look_up(df, col, [(r.code, r.label) for r in _labels(stats)], "_old int, _new string")
    return found.withColumn(col, F.col("_new")).select(*df.columns)


def fit_one_hot(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Categories that become columns; the same table as the category index."""
    return fit_category_index(df, cols)


def apply_one_hot(
    df: DataFrame, stats: DataFrame, cols: Sequence[str] | None = None, drop_first: bool = True, max_columns: int = 5000
) -> DataFrame:
    """A 0/1 column `<col>_<category>` per fitted category, without the first of each column."""
    rows = stats.orderBy("col", "code").limit(max_columns + 1).collect()
    if len(rows) > max_columns:
        raise ValueError(f"one-hot of more than {max_columns} categories; code them instead")
    cols = [c for c in df.columns if c in {r.col for r in rows}] if cols is None else list(cols)
    dummies = []
    for c in cols:
        kind = df.schema[c].dataType
        for r in rows:
            if r.col == c and not (drop_first and r.code == 0):
                hit = F.col(c) == F.lit(r.category).cast(kind)
                dummies.append(F.when(hit, 1).otherwise(0).alias(f"{c}_{r.category}"))
    return df.select(*[x for x in df.columns if x not in cols], *dummies)


def align_columns(df: DataFrame, training_columns: Sequence[str]) -> DataFrame:
    """Keep the columns known at training time, in training order; unknown ones go, absent ones are not added."""
    return df.select(*[c for c in training_columns if c in df.columns])


def category_count(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(col, category, n): how often every value occurs."""
    parts = [
        v.groupBy("col", "category").agg(F.count(F.lit(1)).alias("n")) for v in long_values(df, cols).values()
    ]
    out = parts[0].withColumn("category", F.col("category").cast(T.StringType()))
    for part in parts[1:]:
        out = out.unionByName(part.withColumn("category", F.col("category").cast(T.StringType())))
    return out
