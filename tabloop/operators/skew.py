"""Joins to a side with one row per key that stay balanced when a few keys hold most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloop.storage import settle

HOT_ROWS = 2_000_000  # rows of one key that a single task may take
SALTS = 32  # tasks that share a hot key where it is not broadcast
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a (settled or cheap) table is measured to be small enough to copy to every executor."""
    size = F.sum(F.length(F.to_json(F.struct(*df.columns))).cast("bigint"))
    row = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(size, F.lit(0)).alias("b")).first()
    return row.n <= max_rows and row.b <= max_bytes


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    settle_left: bool = False,
) -> DataFrame:
    """Join to `right`, which has one row per key.

    A measured small right side is broadcast. Otherwise rows without a key bypass the shuffle, and keys with
    more than `hot_rows` left rows are joined apart: by broadcasting only their right rows where these are measured
    to be few, else by dealing a key's left rows to `SALTS` tasks that each get its right row. Counting the
    keys reads the left side twice; `settle_left` writes it first when that is dearer than writing it.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join: {how}")
    on = list(on)
    if fits_broadcast(right):
        return left.join(F.broadcast(right), on, how)
    if settle_left:
        left = settle(left)
    has_key = F.lit(True)
    for c in on:
        has_key = has_key & F.col(c).isNotNull()
    keyed = left.where(has_key)
    hot = keyed.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).select(*on)
    parts = []
    if hot.limit(1).count():
        hot = settle(hot, "hot")
        few = F.broadcast(hot) if fits_broadcast(hot) else hot
        parts.append(keyed.join(few, on, "left_anti").join(right, on, how))
        hot_left, hot_right = keyed.join(few, on, "left_semi"), right.join(few, on, "left_semi")
        if fits_broadcast(hot_right):
            parts.append(hot_left.join(F.broadcast(hot_right), on, how))
        else:
            salt = F.pmod(F.xxhash64(*left.columns, F.spark_partition_id()), F.lit(SALTS)).cast("int")
            copies = hot_right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            parts.append(hot_left.withColumn("_salt", salt).join(copies, [*on, "_salt"], how).drop("_salt"))
    else:
        parts.append(keyed.join(right, on, how))
    if how == "left":
        parts.append(left.where(~has_key))
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part, allowMissingColumns=True)
    return joined
