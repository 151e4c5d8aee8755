"""Exact n-th smallest values without sorting the table.

Each round is one aggregate over the needed columns with partial aggregation on the map side: a quantile
sketch proposes split values around the wanted rank, exact counts say between which of them the rank lies,
and the next round looks only between those. A bracket of at most `BRACKET_ROWS` values is sorted in place.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloop.storage import settle

BRACKET_ROWS = 50_000
SKETCH_ACCURACY = 10_000


@dataclass(frozen=True)
class Nth:
    """Value at a rank, with the number of smaller rows and of rows equal to it."""

    value: object
    below: int
    equal: int


@dataclass(frozen=True)
class _Bracket:
    name: str
    rank: int  # wanted, among all non-null values, from 1
    low: object  # exclusive; None is open
    high: object  # exclusive; None is open
    before: int  # values up to and including `low`
    size: int  # values strictly between the ends

    def inside(self) -> Column:
        x = F.col(self.name)
        keep = x.isNotNull()
        if self.low is not None:
            keep = keep & (x > F.lit(self.low))
        if self.high is not None:
            keep = keep & (x < F.lit(self.high))
        return F.when(keep, x)


def count_values(df: DataFrame, exprs: Mapping[str, Column]) -> dict[str, int]:
    """Non-null values of every expression, in one pass."""
    row = df.agg(*[F.count(e).alias(n) for n, e in exprs.items()]).first()
    return row.asDict()


def nth_values(
    df: DataFrame,
    exprs: Mapping[str, Column],
    ranks: Mapping[str, Sequence[int]],
    sizes: Mapping[str, int] | None = None,
    bracket_rows: int = BRACKET_ROWS,
) -> dict[tuple[str, int], Nth]:
    """Exact value at each 1-based rank of each expression; nulls do not count, ranks outside are an error."""
    base = df.select(*[e.alias(n) for n, e in exprs.items()])
    if sizes is None or any(sizes[n] > bracket_rows for n in ranks):
        base = settle(base, "keys")  # several passes follow; they need not make the columns again
    sizes = dict(sizes) if sizes is not None else count_values(base, {n: F.col(n) for n in exprs})
    pending = []
    for name, wanted in ranks.items():
        for rank in sorted(set(wanted)):
            if not 1 <= rank <= sizes[name]:
                raise ValueError(f"rank {rank} outside the {sizes[name]} values of {name}")
            pending.append(_Bracket(name, rank, None, None, 0, sizes[name]))
    found: dict[tuple[str, int], Nth] = {}
    while pending:
        small = [b for b in pending if b.size <= bracket_rows]
        large = [b for b in pending if b.size > bracket_rows]
        for part in _portions(small, bracket_rows):
            found.update(_read_small(base, part))
        pending = _split_large(base, large, found, bracket_rows) if large else []
    return found


def _portions(brackets: list[_Bracket], bracket_rows: int) -> list[list[_Bracket]]:
    """Brackets in portions whose values together fit one task, whatever the number of brackets."""
    spans: dict[tuple, list[_Bracket]] = {}
    for b in brackets:
        spans.setdefault((b.name, b.low, b.high), []).append(b)
    portions: list[list[_Bracket]] = []
    held = 0
    for members in spans.values():
        if not portions or held + members[0].size > 4 * bracket_rows:
            portions.append([])
            held = 0
        portions[-1] += members
        held += members[0].size
    return portions


def _equals(value: Column):
    return lambda x: x == value


def _read_small(base: DataFrame, brackets: list[_Bracket]) -> dict[tuple[str, int], Nth]:
    spans = list(dict.fromkeys((b.name, b.low, b.high) for b in brackets))
    first = {s: next(b for b in brackets if (b.name, b.low, b.high) == s) for s in spans}
    sorted_values = base.agg(
        *[F.array_sort(F.collect_list(first[s].inside())).alias(f"a{i}") for i, s in enumerate(spans)]
    )
    picks = []
    for i, b in enumerate(brackets):
        values = F.col(f"a{spans.index((b.name, b.low, b.high))}")
        at = F.element_at(values, b.rank - b.before)
        picks += [
            at.alias(f"v{i}"),
            (F.array_position(values, at) - 1).alias(f"l{i}"),
            F.size(F.filter(values, _equals(at))).alias(f"e{i}"),
        ]
    row = sorted_values.select(*picks).first()
    return {
        (b.name, b.rank): Nth(row[f"v{i}"], b.before + row[f"l{i}"], row[f"e{i}"]) for i, b in enumerate(brackets)
    }


def _split_large(base: DataFrame, brackets: list[_Bracket], found: dict, bracket_rows: int) -> list[_Bracket]:
    spans: dict[tuple, list[_Bracket]] = {}
    for b in brackets:
        spans.setdefault((b.name, b.low, b.high), []).append(b)
    sketches = []
    for i, members in enumerate(spans.values()):
        size = members[0].size
        accuracy = min(SKETCH_ACCURACY, max(200, 8 * size // bracket_rows))
        shares = [(b.rank - b.before) / size + step * 2.0 / accuracy for b in members for step in (-1, 0, 1)]
        probs = sorted({min(1.0, max(0.0, s)) for s in shares})
        sketches.append(F.percentile_approx(members[0].inside(), probs, accuracy).alias(f"s{i}"))
        sketches.append(F.min(members[0].inside()).alias(f"m{i}"))
    row = base.agg(*sketches).first()
    # the smallest value is always a split, so every round shrinks the bracket
    splits = [sorted({*row[f"s{i}"], row[f"m{i}"]}) for i in range(len(spans))]
    counts = []
    for i, (name, _, _) in enumerate(spans):
        x = F.col(name)
        for j, value in enumerate(splits[i]):
            counts.append(F.count_if(x < F.lit(value)).alias(f"l{i}_{j}"))
            counts.append(F.count_if(x == F.lit(value)).alias(f"e{i}_{j}"))
    seen = base.agg(*counts).first()
    pending = []
    for i, members in enumerate(spans.values()):
        for b in members:
            low, high, before, end = b.low, b.high, b.before, b.before + b.size
            for j, value in enumerate(splits[i]):
                below, equal = seen[f"l{i}_{j}"], seen[f"e{i}_{j}"]
                if below + equal < b.rank:
                    low, before = value, below + equal
                elif below < b.rank:
                    found[(b.name, b.rank)] = Nth(value, below, equal)
                    break
                else:
                    high, end = value, below
                    pending.append(_Bracket(b.name, b.rank, low, high, before, end - before))
                    break
            else:
                pending.append(_Bracket(b.name, b.rank, low, high, before, end - before))
    return pending


def exact_quantiles(
    df: DataFrame, exprs: Mapping[str, Column], probs: Sequence[float], bracket_rows: int = BRACKET_ROWS
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation between neighbouring ranks; None for a column without values."""
    sizes = count_values(df, exprs)
    ranks = {}
    for name, n in sizes.items():
        if n:
            spots = [p * (n - 1) for p in probs]
            ranks[name] = sorted({int(f(s)) + 1 for s in spots for f in (math.floor, math.ceil)})
    at = nth_values(df, {n: exprs[n] for n in ranks}, ranks, sizes, bracket_rows) if ranks else {}
    result: dict[str, list[float | None]] = {}
    for name, n in sizes.items():
        if not n:
            result[name] = [None] * len(probs)
            continue
        result[name] = []
        for p in probs:
            spot = p * (n - 1)
            low = float(at[(name, math.floor(spot) + 1)].value)
            high = float(at[(name, math.ceil(spot) + 1)].value)
            result[name].append(low + (high - low) * (spot - math.floor(spot)))
    return result
