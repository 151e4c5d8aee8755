"""Rows for trees: values become bins once, and rows alike in all bins and the label are one row with their number.

Trees on histograms tell no rows apart that share all bins, so they are grown on the rows that differ, weighted by
their number. A table of few columns has a bounded number of them, whatever its size; the passes of a fit, and the
fits of a search, then no longer read the whole table. One with many columns keeps at most the rows it had.

A column of no more distinct values than bins has a bin for each; others are cut at quantiles of all rows.
"""

from __future__ import annotations

import math
import threading
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloop.storage import settle

BINS = 32  # default of Spark ML's trees
COPIES = "_copies"
TASK_ROWS = 20_000  # compact rows of one task
SKETCH_ACCURACY = 10_000


def _between(low: float, high: float) -> float | None:
    """A finite bound above `low` and not above `high`."""
    middle = low + (high - low) / 2
    if math.isfinite(middle) and low < middle <= high:
        return middle
    return high if math.isfinite(high) else math.nextafter(low, high) if math.isfinite(low) else None


def bounds(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Lower bounds of the bins after the first, ascending, for each column; a value equal to a bound is above it."""
    value = [F.col(c).cast("double") for c in features]
    near = df.agg(*(F.approx_count_distinct(x).alias(f"n{i}") for i, x in enumerate(value))).first()
    few = [near[f"n{i}"] <= 2 * bins for i in range(len(value))]  # the sketch errs by a twentieth
    shares = [i / bins for i in range(1, bins)]
    row = df.agg(
        *(F.collect_set(x).alias(f"v{i}") if f else F.percentile_approx(x, shares, SKETCH_ACCURACY).alias(f"v{i}") for i, (x, f) in enumerate(zip(value, few)))
    ).first()
    out: list[list[float]] = []
    for i in range(len(value)):
        found = sorted({v for v in row[f"v{i}"] or [] if not math.isnan(v)})
        if few[i] and len(found) > bins:
            shared = df.agg(F.percentile_approx(value[i], shares, SKETCH_ACCURACY)).first()[0]
            found = sorted({v for v in shared if math.isfinite(v)})
        elif few[i]:
            found = [b for b in map(_between, found, found[1:]) if b is not None]
        out.append([v for v in found if math.isfinite(v)])
    return out


def binner(features: Sequence[str], cuts: Sequence[Sequence[float]]) -> Bucketizer:
    """Adds the bin of each feature; a column without bounds has all its values in the second of two bins."""
    ends = [[-math.inf, *(c or [-1.7976931348623157e308]), math.inf] for c in cuts]
    return Bucketizer(splitsArray=ends, inputCols=list(features), outputCols=[bin_name(c) for c in features])


def bin_name(feature: str) -> str:
    return f"_bin_{feature}"


def alike(rows: DataFrame, stage: Bucketizer, label: str, *more: str | Column) -> DataFrame:
    """(bins, label, more, COPIES), written: one row for all rows alike in these."""
    doubles = [F.col(c).cast("double").alias(c) for c in stage.getInputCols()]
    placed = stage.transform(rows.select(*doubles, F.col(label).cast("double").alias(label), *more))
    # a Bucketizer marks its column as categories; bins are in order, so trees are to cut them as numbers
    placed = placed.withColumns({c: F.col(c).alias(c, metadata={"ml_attr": {"type": "numeric"}}) for c in stage.getOutputCols()})
    keys = [c for c in placed.columns if c not in stage.getInputCols()]
    found = settle(placed.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias(COPIES)), "alike")
    return found.repartition(max(1, -(-found.count() // TASK_ROWS)))


class Compact:
    """Rows of a search, compacted once for each number of bins that its trials ask for; `held` rows set no bounds."""

    def __init__(self, rows: DataFrame, features: Sequence[str], label: str, held: str):
        self.rows, self.features, self.label, self.held = rows, list(features), label, held
        self._lock, self._made = threading.Lock(), {}

    def of(self, bins: int) -> tuple[Bucketizer, DataFrame]:
        """(binner, alike rows)."""
        with self._lock:
            if bins not in self._made:
                stage = binner(self.features, bounds(self.rows.where(~F.col(self.held)), self.features, bins))
                self._made[bins] = stage, settle(alike(self.rows, stage, self.label, self.held), "compact")
            return self._made[bins]
