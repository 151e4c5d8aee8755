"""Scalar number helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def truncate(c, places: int = 8) -> Column:
    """Cut to `places` decimals toward zero."""
    scale = float(10**places)
    return (as_column(c) * F.lit(scale)).cast("bigint") / F.lit(scale)


def narrow(c) -> Column:
    """Number as JSON text: integral values lose their fraction."""
    x = as_column(c).cast("double")
    whole = x.cast("bigint")
    return F.when(x == whole.cast("double"), whole.cast("string")).otherwise(x.cast("string"))


def flip(label) -> Column:
    """Binary label turned over: 1 becomes 0, anything else becomes 1."""
    return F.when(as_column(label) == 1, F.lit(0)).otherwise(F.lit(1))
