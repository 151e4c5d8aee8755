"""Optimal binning: the cuts of a column that keep the most information about a 0/1 label.

A column is cut finely first: a number at many quantiles, a category by its values. One aggregate counts events and
non-events of every fine bin of all columns. The rest depends on these counts alone, at most FINE_BINS per column: a
dynamic program over the fine bins finds the cuts with the largest information value such that each bin holds a least
share of the rows and at least one row of each label, there are at most `most_bins` bins, and the event rates follow the
asked trend. Trends: "ascending", "descending", "auto" (the better of both) or None.

Categories are ordered by their event rate, ties by name, so a bin is a set of categories of like rates; those beyond the
FINE_BINS - 1 most frequent are one fine bin together, and values not seen at all belong to no bin. Missing values and
NaN are a bin of their own, "missing", outside the program. Columns whose rows allow no cut have one bin. Ties between
solutions go to fewer bins, then to earlier cuts. Rows without a label do not count.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloop.operators.skew import lookup_join
from tabloop.storage import settle, small_table

FINE_BINS = 64
MOST_BINS = 8
LEAST_SHARE = 0.05
REST = "rest"  # fine bin of infrequent categories
TRENDS = ("ascending", "descending")
BINS = "col string, bin int, lower double, upper double, categories array<string>, rest boolean, events bigint, nonevents bigint, woe double, iv double"


def information(events: float, nonevents: float, all_events: float, all_nonevents: float) -> tuple[float, float]:
    """(weight of evidence, information value) of one bin with rows of both labels."""
    share, other = events / all_events, nonevents / all_nonevents
    woe = math.log(other / share)
    return woe, (other - share) * woe


def best_cuts(
    events: Sequence[int], nonevents: Sequence[int], most_bins: int = MOST_BINS, least_share: float = LEAST_SHARE,
    trend: str | None = "auto", missing: tuple[int, int] = (0, 0),
) -> list[int]:
    """Ends (exclusive) of the bins over the fine bins; the last is their number. One bin if nothing else is allowed.

    For each number of bins and each pair (begin, end) of the last bin, the best value of what ends there: the bin
    before must end at `begin` and have a rate on the right side, so a prefix maximum over its rates suffices. Shares are
    of all rows, with the events and non-events of missing values.
    """
    e, n = np.concatenate([[0], np.cumsum(events)]), np.concatenate([[0], np.cumsum(nonevents)])
    size, all_e, all_n = len(e) - 1, int(e[-1]) + missing[0], int(n[-1]) + missing[1]
    if size == 0 or all_e == 0 or all_n == 0:
        return [size] if size else []
    if trend == "auto":
        found = [best_cuts(events, nonevents, most_bins, least_share, t, missing) for t in TRENDS]
        return max(found, key=lambda ends: (round(total_information(events, nonevents, ends, missing), 12), -len(ends)))
    least = least_share * (all_e + all_n)
    value, rate = {}, {}
    for a in range(size):
        for b in range(a + 1, size + 1):
            x, y = int(e[b] - e[a]), int(n[b] - n[a])
            if x > 0 and y > 0 and x + y >= least:
                value[a, b], rate[a, b] = information(x, y, all_e, all_n)[1], x / (x + y)
    # best[a, b]: (value, bins, cuts) with (a, b) as the last bin
    best: dict[tuple[int, int], tuple[float, tuple[int, ...]]] = {(a, b): (v, (b,)) for (a, b), v in value.items() if a == 0}
    answer = max((best[k] for k in best if k[1] == size), key=_rank, default=(0.0, (size,)))
    for _ in range(most_bins - 1):
        longer: dict[tuple[int, int], tuple[float, tuple[int, ...]]] = {}
        by_end: dict[int, list[tuple[float, tuple[float, tuple[int, ...]]]]] = {}
        for (a, b), state in best.items():
            by_end.setdefault(b, []).append((rate[a, b], state))
        allowed = {b: _Reachable(states, trend) for b, states in by_end.items()}
        for (a, b), v in value.items():
            if a in allowed and (before := allowed[a].up_to(rate[a, b])) is not None:
                longer[a, b] = (before[0] + v, (*before[1], b))
        best = longer
        for k, state in best.items():
            if k[1] == size and _rank(state) > _rank(answer):
                answer = state
    return list(answer[1])


def _rank(state: tuple[float, tuple[int, ...]]) -> tuple:
    """Larger value first, then fewer bins, then earlier cuts."""
    return round(state[0], 12), -len(state[1]), tuple(-c for c in state[1])


class _Reachable:
    """The best of the states whose rate lies on the right side of a following bin's."""

    def __init__(self, states: list, trend: str | None) -> None:
        self.sign = {"ascending": 1, "descending": -1, None: 0}[trend]
        order = sorted(states, key=lambda s: self.sign * s[0])
        self.rates = np.array([self.sign * r for r, _ in order])
        self.best: list = []
        for _, state in order:
            self.best.append(state if not self.best or _rank(state) > _rank(self.best[-1]) else self.best[-1])

    def up_to(self, rate: float):
        """The best state at or before this rate; without a trend, of all."""
        at = int(np.searchsorted(self.rates, self.sign * rate, side="right"))
        return self.best[at - 1] if at else None


def total_information(
    events: Sequence[int], nonevents: Sequence[int], ends: Sequence[int], missing: tuple[int, int] = (0, 0)
) -> float:
    all_e, all_n, begin, total = sum(events) + missing[0], sum(nonevents) + missing[1], 0, 0.0
    for end in ends:
        x, y = sum(events[begin:end]), sum(nonevents[begin:end])
        total += information(x, y, all_e, all_n)[1] if x and y and all_e and all_n else 0.0
        begin = end
    return total


def _present(col: str) -> Column:
    x = F.col(col).cast("double")
    return F.when(~F.isnan(x), x)


def _fine_number(x: Column, cuts: Sequence[float]) -> Column:
    """How many of the sorted cuts lie below the value, by a search over an array constant."""
    return F.when(x.isNotNull(), F.size(F.filter(F.lit(list(cuts)), lambda c: c < x)) if len(cuts) else F.lit(0))


def fine_counts(
    df: DataFrame, cat_cols: Sequence[str], num_cols: Sequence[str], label: str, fine_bins: int = FINE_BINS
) -> tuple[DataFrame, dict[str, list[float]]]:
    """((col, number, value, events, nonevents), cuts): counts of fine bins; a null number and value is missing."""
    shares = [i / fine_bins for i in range(1, fine_bins)]
    cuts: dict[str, list[float]] = {}
    if num_cols:
        row = df.agg(*(F.percentile_approx(_present(c), shares, 100_000).alias(f"q{i}") for i, c in enumerate(num_cols))).first()
        cuts = {c: sorted(set(q or [])) for c, q in zip(num_cols, row)}
    y = F.col(label).cast("bigint")
    cells = [F.struct(F.lit(c).alias("col"), _fine_number(_present(c), cuts[c]).alias("number"), F.lit(None).cast("string").alias("value")) for c in num_cols]
    cells += [F.struct(F.lit(c).alias("col"), F.lit(None).cast("int").alias("number"), F.col(c).cast("string").alias("value")) for c in cat_cols]
    rows = df.where(y.isNotNull()).select(y.alias("_y"), F.inline(F.array(*cells)))
    counts = rows.groupBy("col", "number", "value").agg(F.sum("_y").alias("events"), F.sum(1 - F.col("_y")).cast("bigint").alias("nonevents"))
    return settle(counts, "fine"), cuts


def _frequent(counts: DataFrame, cat_cols: Sequence[str], fine_bins: int) -> DataFrame:
    """Counts with the values beyond the most frequent of each column as one; at most `fine_bins` rows a column."""
    from pyspark.sql import Window

    kept = counts.where(F.col("value").isNotNull())
    order = Window.partitionBy("col").orderBy(F.desc(F.col("events") + F.col("nonevents")), "value")
    top = kept.withColumn("_r", F.row_number().over(order)).where(F.col("_r") < fine_bins).select("col", "value")
    named = kept.join(F.broadcast(top.withColumn("top", F.lit(True))), ["col", "value"], "left")
    own = F.when(F.col("top"), F.col("value"))
    rows = named.groupBy("col", own.alias("value"), F.col("top").isNull().alias("rest"))
    return rows.agg(F.sum("events").alias("events"), F.sum("nonevents").alias("nonevents"))


def fit(
    df: DataFrame, cat_cols: Sequence[str] = (), num_cols: Sequence[str] = (), label: str = "label",
    most_bins: int = MOST_BINS, least_share: float = LEAST_SHARE, trend: str | Mapping[str, str | None] | None = "auto",
    fine_bins: int = FINE_BINS,
) -> DataFrame:
    """(col, bin, lower, upper, categories, rest, events, nonevents, woe, iv), bins from 0, missing values as bin -1.

    A number lies in the bin with lower < x <= upper. `rest` marks the bin of infrequent categories. woe and iv are as
    in `information`; they are null for a bin that lacks a label, and iv counts towards no total there.
    """
    if not cat_cols and not num_cols:
        raise ValueError("no columns to bin")
    counts, cuts = fine_counts(df, cat_cols, num_cols, label, fine_bins)
    trends = trend if isinstance(trend, Mapping) else dict.fromkeys([*cat_cols, *num_cols], trend)
    rows: list[tuple] = []
    numbers = counts.where(F.col("number").isNotNull()).collect()  # fine_bins per column at most, as the next
    values = _frequent(counts.where(F.col("col").isin(list(cat_cols))), cat_cols, fine_bins).collect() if cat_cols else []
    missing = {r.col: r for r in counts.where("number is null and value is null").collect()}
    for c in [*num_cols, *cat_cols]:
        if c in num_cols:
            fine = sorted((r for r in numbers if r.col == c), key=lambda r: r.number)
        else:
            rate = lambda r: (r.events / (r.events + r.nonevents), r.rest, r.value or "")
            fine = sorted((r for r in values if r.col == c), key=rate)
        own_trend = trends.get(c) if c in num_cols or trends.get(c) is None else "ascending"
        gone = missing.get(c)
        apart = (gone.events, gone.nonevents) if gone is not None else (0, 0)
        ends = best_cuts([r.events for r in fine], [r.nonevents for r in fine], most_bins, least_share, own_trend, apart)
        all_e, all_n = sum(r.events for r in fine) + apart[0], sum(r.nonevents for r in fine) + apart[1]
        begin = 0
        for b, end in enumerate(ends):
            part = fine[begin:end]
            lower = upper = names = None
            if c in num_cols:
                lower = cuts[c][fine[begin - 1].number] if begin else None
                upper = cuts[c][part[-1].number] if end < len(fine) else None
            else:
                names = sorted(r.value for r in part if not r.rest)
            rows.append((c, b, lower, upper, names, any(r.rest for r in part) if c not in num_cols else False, *_summed(part, all_e, all_n)))
            begin = end
        if gone is not None:
            rows.append((c, -1, None, None, None, False, *_summed([gone], all_e, all_n)))
    return small_table(df.sparkSession, rows, BINS)


def _summed(part: Sequence, all_events: int, all_nonevents: int) -> tuple:
    events, nonevents = sum(r.events for r in part), sum(r.nonevents for r in part)
    known = information(events, nonevents, all_events, all_nonevents) if events and nonevents else (None, None)
    return events, nonevents, *known


def assign(df: DataFrame, bins: DataFrame, cols: Sequence[str], suffix: str = "_bin") -> DataFrame:
    """Adds the bin number of each column; null for a category that was not seen and belongs to no rest."""
    fitted = bins.collect()  # FINE_BINS per column at most
    for c in cols:
        own = sorted((r for r in fitted if r.col == c), key=lambda r: r.bin)
        numeric = all(r.categories is None for r in own)
        seen = [r for r in own if r.bin >= 0]
        if numeric:
            x = _present(c)
            at = F.when(x.isNotNull(), F.size(F.filter(F.lit([r.upper for r in seen if r.upper is not None]), lambda u: u < x))) if len(seen) > 1 else F.when(x.isNotNull(), F.lit(0))
            number = F.coalesce(at, F.lit(-1) if len(seen) < len(own) else F.lit(None).cast("int"))
        else:
            text = F.col(c).cast("string")
            rest = next((r.bin for r in seen if r.rest), None)
            pairs = [x for r in seen for name in r.categories for x in (F.lit(name), F.lit(r.bin))]
            known = F.element_at(F.create_map(*pairs), text) if pairs else F.lit(None).cast("int")
            gone = F.lit(-1) if len(seen) < len(own) else F.lit(None).cast("int")
            number = F.when(text.isNull(), gone).otherwise(F.coalesce(known, F.lit(rest).cast("int")))
        df = df.withColumn(f"{c}{suffix}", number.cast("int"))
    return df


def apply(df: DataFrame, bins: DataFrame, cols: Sequence[str], missing: float = 0.0) -> DataFrame:
    """Replaces the values of the columns by the weight of evidence of their bins; bins without one give `missing`."""
    order = df.columns
    for c in cols:
        side = bins.where(F.col("col") == c).select(F.col("bin").alias("_bin"), F.col("woe").alias("_woe"))
        df = lookup_join(assign(df, bins, [c], "_b").withColumnRenamed(f"{c}_b", "_bin"), side, ["_bin"])
        df = df.withColumn(c, F.coalesce("_woe", F.lit(float(missing)))).drop("_bin", "_woe")
    return df.select(*order)
