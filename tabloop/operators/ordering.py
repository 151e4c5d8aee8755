"""Positions made explicit: prefixes, shares, samples, splits and folds of an ordered table.

A prefix is a filter up to a boundary row found by `ranks`; the table itself is neither sorted nor moved.
Orders are lists of numeric or time columns, `-name` for descending, missing values last, and must end in a
unique column.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloop.functions.keys import hash_key, order_key
from tabloop.operators.ranks import BRACKET_ROWS, Nth, nth_values
from tabloop.storage import pin_partitions, small_table

TAKE_ROWS = 100_000  # above this a top-k is cut by a boundary instead of merged in one task


def ascending(df: DataFrame, term: str | Column) -> Column:
    """Expression whose ascending order is the order `term` asks for."""
    if isinstance(term, Column):
        return term
    descending, name = term.startswith("-"), term.lstrip("-")
    x, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        x = x.cast("double")
        return F.coalesce(-x if descending else x, F.lit(float("nan")))
    if isinstance(kind, T.NumericType):
        return -x if descending else x
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        micros = F.unix_micros(x.cast("timestamp"))
        return -micros if descending else micros
    raise TypeError(f"cannot order by {name}: {kind.simpleString()}; derive a number, e.g. with order_key")


def prefix_filters(
    df: DataFrame,
    ns: Sequence[int],
    order: Sequence[str | Column],
    rows: int | None = None,
    bracket_rows: int = BRACKET_ROWS,
) -> list[Column]:
    """For each n the condition that holds for exactly the first n rows of `df` in `order`."""
    terms = [ascending(df, t) for t in order]
    rows = df.count() if rows is None else rows
    inner = sorted({n for n in ns if 0 < n < rows})
    first = nth_values(df, {"k": terms[0]}, {"k": inner}, {"k": rows}, bracket_rows) if inner else {}
    built = {}
    for n in inner:
        built[n] = _upto(df, terms, n, first[("k", n)], bracket_rows)
    return [F.lit(n >= rows) if n <= 0 or n >= rows else built[n] for n in ns]


def _upto(df: DataFrame, terms: Sequence[Column], n: int, at: Nth, bracket_rows: int = BRACKET_ROWS) -> Column:
    """Condition for the first n rows, given the n-th value of the first term; ties go on to the next term."""
    term, value = terms[0], F.lit(at.value)
    need = n - at.below
    if at.equal == need:
        return term <= value
    if len(terms) == 1:
        raise ValueError("the order does not tell all rows apart")
    tied = df.where(term == value)
    following = nth_values(tied, {"k": terms[1]}, {"k": [need]}, {"k": at.equal}, bracket_rows)[("k", need)]
    return (term < value) | ((term == value) & _upto(tied, terms[1:], need, following, bracket_rows))


def prefix_by_group(
    df: DataFrame, group: str, ns: Mapping[object, int], sizes: Mapping[object, int], order: Sequence[str | Column]
) -> Column:
    """Condition that holds for exactly the first ns[g] rows of every group g of `sizes[g]` rows."""
    terms = [ascending(df, t) for t in order]
    inner = {g: n for g, n in ns.items() if 0 < n < sizes[g]}
    names = {g: f"g{i}" for i, g in enumerate(inner)}
    member = {g: F.col(group) == F.lit(g) for g in ns}
    first = (
        nth_values(
            df,
            {names[g]: F.when(member[g], terms[0]) for g in inner},
            {names[g]: [n] for g, n in inner.items()},
            {names[g]: sizes[g] for g in inner},
        )
        if inner
        else {}
    )
    condition = F.lit(False)
    for g, n in ns.items():
        if n >= sizes[g]:
            condition = condition | member[g]
        elif g in inner:
            condition = condition | (member[g] & _upto(df.where(member[g]), terms, n, first[(names[g], n)]))
    return condition


def first_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First n rows (all rows when there are fewer)."""
    return df.where(prefix_filters(df, [n], order)[0])


def after_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Everything but the first n rows."""
    return df.where(~prefix_filters(df, [n], order)[0])


def cut_n(df: DataFrame, n: int, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The first n rows and the rest."""
    head = prefix_filters(df, [n], order)[0]
    return df.where(head), df.where(~head)


def cut_share(df: DataFrame, share: float, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The first int(share * rows) rows and the rest."""
    rows = df.count()
    head = prefix_filters(df, [int(rows * share)], order, rows)[0]
    return df.where(head), df.where(~head)


def first_share(df: DataFrame, share: float, order: Sequence[str]) -> DataFrame:
    return cut_share(df, share, order)[0]


def random_cut(
    df: DataFrame, order: Sequence[str], seed: int, low: float = 0.5, high: float = 1.0
) -> tuple[DataFrame, DataFrame]:
    """Cut at a seeded random position in [low * rows, high * rows)."""
    rows = df.count()
    position = random_position(rows, seed, low, high)
    head = prefix_filters(df, [position], order, rows)[0]
    return df.where(head), df.where(~head)


def random_position(rows: int, seed: int, low: float = 0.5, high: float = 1.0) -> int:
    import hashlib

    key = int(hashlib.md5(f"cut:{seed}".encode()).hexdigest()[:8], 16)
    start, stop = int(rows * low), int(rows * high)
    return start + key * (stop - start) // 2**32


def _sorted_terms(df: DataFrame, order: Sequence[str | Column]) -> list[Column]:
    return [ascending(df, t).asc_nulls_last() for t in order]


def top_confidence(df: DataFrame, k: int, ascending: bool = False, row_id: str = "row_id") -> DataFrame:
    """The k most (or least) confident rows, ties by row id."""
    order = ["prob" if ascending else "-prob", row_id]
    if k > TAKE_ROWS:
        return first_n(df, k, order)
    # the same order as the boundary search uses, missing and not-a-number last
    return df.orderBy(*_sorted_terms(df, order)).limit(k)


def sort_by_confidence(df: DataFrame, ascending: bool = False, row_id: str = "row_id") -> DataFrame:
    prob = F.col("prob").asc_nulls_last() if ascending else F.col("prob").desc_nulls_last()
    return df.orderBy(prob, F.col(row_id))


def shuffled(df: DataFrame, seed: int, row_id: str = "row_id") -> list[Column]:
    """Order terms of a seeded shuffle, for use with the prefix functions."""
    return [order_key(row_id, seed), F.col(row_id)]


def sample_exact(df: DataFrame, n: int, seed: int = 1, row_id: str = "row_id") -> DataFrame:
    """Exactly n rows without replacement; asking for more rows than there are is an error."""
    rows = df.count()
    if n > rows:
        raise ValueError(f"cannot take {n} of {rows} rows without replacement")
    return df.where(prefix_filters(df, [n], shuffled(df, seed, row_id), rows)[0])


def split(
    df: DataFrame, test_share: float = 0.1, seed: int = 1242, exact: bool = True, row_id: str = "row_id"
) -> DataFrame:
    """Add `split` = 'test' for ceil(test_share * rows) seeded rows, else 'train'.

    With exact=False the share holds on average only, and no counting pass is needed.
    """
    if exact:
        rows = df.count()
        test = prefix_filters(df, [math.ceil(test_share * rows)], shuffled(df, seed, row_id), rows)[0]
    else:
        test = hash_key(F.col(row_id), f":{seed}") % 1000 < int(round(test_share * 1000))
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def assign_folds(df: DataFrame, k: int = 5, order: Sequence[str] = ("row_id",)) -> DataFrame:
    """Add `fold` 0..k-1: contiguous stretches in `order` with bounds int(rows * i / k)."""
    rows = df.count()
    bounds = [int(rows * (i / k)) for i in range(1, k)]
    heads = prefix_filters(df, bounds, order, rows)
    fold = F.lit(k - 1)
    for i in reversed(range(k - 1)):
        fold = F.when(heads[i], F.lit(i)).otherwise(fold)
    return df.withColumn("fold", fold)


def fold_split(df: DataFrame, i: int) -> tuple[DataFrame, DataFrame]:
    """Training rows (all other folds) and test rows (fold i)."""
    return df.where(F.col("fold") != i), df.where(F.col("fold") == i)


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_id") -> DataFrame:
    """Add consecutive numbers from 0 in `order`, which may hold text and must be unique.

    Range partitions are written once and counted; each then numbers its own rows from where it starts.
    """
    ordered = pin_partitions(df.repartitionByRange(*order).sortWithinPartitions(*order))
    spot = F.monotonically_increasing_id()  # partition in the upper bits, position in the lower 33
    placed = ordered.select("*", F.shiftright(spot, 33).alias("_p"), spot.bitwiseAND(2**33 - 1).alias("_i"))
    starts, total = [], 0
    for r in placed.groupBy("_p").count().orderBy("_p").collect():  # one row per partition
        starts.append((r._p, total))
        total += r["count"]
    offsets = F.broadcast(small_table(df.sparkSession, starts, "_p bigint, _start bigint"))
    return placed.join(offsets, "_p").select(*df.columns, (F.col("_i") + F.col("_start")).alias(name))
