"""Repeatable pseudo-random keys: a recomputed task draws the same values again."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_RANGE = 4294967296.0  # keys are the first 32 bits of an md5 digest


def hash_key(*parts) -> Column:
    """Integer in [0, 2^32) from the text of `parts`."""
    texts = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.conv(F.substring(F.md5(F.concat(*texts)), 1, 8), 16, 10).cast("bigint")


def order_key(row_id, seed: int) -> Column:
    """Key that puts rows in a seeded random order."""
    column = row_id if isinstance(row_id, Column) else F.col(row_id)
    return hash_key(column, f":{seed}")


def uniform(*parts) -> Column:
    """Double in [0, 1) from the text of `parts`."""
    return hash_key(*parts) / F.lit(KEY_RANGE)
