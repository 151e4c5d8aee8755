"""Mini-batch k-means: centres drawn on by seeded batches, each centre at a rate of one over what it has seen.

Rows are dealt once to batches of about `batch_rows` by a seeded hash of their values, and written in folders by batch,
so a step reads its own batch alone. A step is one pass: a task finds the nearest centre of its rows and gives away
sums and counts per centre; these are added in decimals, which come out the same in any order. A centre then moves by
(sum - count * centre) / (count seen before + count), and its count grows. The start is the k-means|| choice of
Spark ML, which needs a few passes and no list of rows. Epochs end when centres hardly move, or after `epochs`.

A lost task repeats its part of a batch; batches and their order follow from the seed. Spark's start adds doubles in
any order, so two fits are alike in cost (within a tenth of a whole k-means in the tests), not equal to the bit. Rows with a missing, NaN or
infinite value take no part. Repeated rows count as often as they occur. Fewer distinct rows than clusters give fewer
centres. Ties go to the earlier centre.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloop.storage import scratch_path

register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed

CLUSTERS = 500  # fixed value: the reference's number of clusters
BATCH_ROWS = 100_000
EPOCHS = 10
TOLERANCE = 1e-4  # of the mean square of the values: a smaller mean move of the centres ends the fit
STARTS = 3  # the one of least cost on the first batch is gone on with
SALT_ROWS = 64  # hash values that copies of one row are spread over


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centre of each row, squared distance to it)."""
    at, far = np.empty(len(x), np.int64), np.empty(len(x))
    for begin in range(0, len(x), 4096):
        part = x[begin : begin + 4096]
        square = (part**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1) - 2 * part @ centres.T
        at[begin : begin + 4096] = square.argmin(axis=1)
        far[begin : begin + 4096] = np.maximum(square.min(axis=1), 0)
    return at, far


def _step(rows: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(sums, counts, cost) of the rows nearest to each centre."""
    k, dims = centres.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, cost = np.zeros((k, dims)), np.zeros(k, np.int64), np.zeros(k)
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                at, far = nearest(x, centres)
                np.add.at(sums, at, x)
                counts += np.bincount(at, minlength=k)
                cost += np.bincount(at, far, k)
        own = np.flatnonzero(counts)
        columns = [np.repeat(own, dims), np.tile(np.arange(dims), len(own)), sums[own].ravel(), np.repeat(counts[own], dims), np.repeat(cost[own], dims)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["centre", "dim", "s", "n", "cost"])

    partial = rows.select("x").mapInArrow(run, "centre bigint, dim bigint, s double, n bigint, cost double")
    exact = {c: F.sum(F.col(c).cast("decimal(38,9)")).cast("double").alias(c) for c in ("s", "cost")}
    found = partial.groupBy("centre", "dim").agg(exact["s"], F.sum("n").alias("n"), exact["cost"]).toArrow()  # clusters times columns
    sums, counts, cost = np.zeros((k, dims)), np.zeros(k, np.int64), np.zeros(k)
    centre, dim = found.column("centre").to_numpy(), found.column("dim").to_numpy()
    sums[centre, dim] = found.column("s").to_numpy()
    counts[centre], cost[centre] = found.column("n").to_numpy(), found.column("cost").to_numpy()
    return sums, counts, float(cost.sum())


def cost(df: DataFrame, vector: Column, centres: np.ndarray) -> float:
    """Sum of squared distances to the nearest centres."""
    return _step(df.select(vector.cast("array<double>").alias("x")), np.asarray(centres, float))[2]


def fit(
    df: DataFrame, vector: Column, k: int = CLUSTERS, seed: int = 1242, epochs: int = EPOCHS, batch_rows: int = BATCH_ROWS,
    tolerance: float = TOLERANCE, starts: int = STARTS,
) -> np.ndarray:
    """Centres, a row each; `vector` gives an array of numbers per row."""
    rows = df.select(vector.cast("array<double>").alias("x"))
    fine = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = rows.where(F.col("x").isNotNull() & (F.size("x") > 0) & F.coalesce(fine, F.lit(False)))
    count, spread = rows.agg(F.count(F.lit(1)), F.avg(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v))).first()
    if not count:
        return np.zeros((0, 0))
    batches = max(1, -(-count // batch_rows))
    salt = F.monotonically_increasing_id() % SALT_ROWS  # else all copies of a row are in one batch
    path = scratch_path(df.sparkSession, "batches")
    dealt = rows.withColumn("batch", F.pmod(F.xxhash64("x", salt, F.lit(seed)), F.lit(batches)).cast("int"))
    dealt.write.partitionBy("batch").parquet(path)
    table = df.sparkSession.read.schema("x array<double>, batch int").parquet(path)
    points, first = table.select(array_to_vector("x").alias("features")), table.where("batch = 0")
    found = (KMeans(k=k, seed=seed + i, maxIter=0).fit(points).clusterCenters() for i in range(starts))
    centres = min((np.array([list(c) for c in centres]) for centres in found), key=lambda c: _step(first, c)[2])
    seen = np.zeros(len(centres), np.int64)
    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        before = centres.copy()
        for batch in draw.permutation(batches):
            sums, counts, _ = _step(table.where(F.col("batch") == int(batch)), centres)
            seen = seen + counts
            centres = centres + (sums - counts[:, None] * centres) / np.maximum(seen, 1)[:, None]
        if ((centres - before) ** 2).sum(axis=1).mean() <= tolerance * (spread or 1.0):
            break
    return centres
