"""Support vector machine with a radial kernel, by landmarks, with probabilities.

The kernel exp(-gamma |x - y|^2) is replaced by inner products of short rows (Nystrom): a seeded sample of distinct
rows are the landmarks, a row is its kernel values with them times the inverse root of the landmarks' own kernel. One
linear machine per class is fitted on these rows by Spark ML, on the rows outside a hashed holdout; the holdout gives
each machine the logistic curve from its margin to a probability (Platt), with the usual smoothed targets. The number
of landmarks is a setting and bounds all that comes to the driver; rows stay where they are.

gamma "scale" is 1 / (columns * variance of all values). Missing values and NaN count as 0, the centre of scaled
columns. Copies of a row are one landmark, and one row of the fit that weighs as many. Rows without a label are left out of the fit. Without rows of both kinds a
machine says what share of the rows is its class.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tabloop.storage import settle, small_table

register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed

C = 1.0  # fixed value: the reference's penalty
LANDMARKS, MOST_LANDMARKS = 256, 2048
LEAST_EIGENVALUE = 1e-10  # of the largest
TASK_ROWS = 20_000
HELD_SHARE = 20  # percent of the rows that fit the probabilities
HEAD = "classes int, features array<string>, gamma double, landmarks array<array<double>>, machines array<array<double>>, curves array<array<double>>"


@dataclass
class Kernel:
    classes: int
    features: list[str]
    gamma: float
    landmarks: np.ndarray
    machines: np.ndarray  # per class: coefficients of the short row, then the constant
    curves: np.ndarray  # per class: slope and constant of the logistic curve

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        margins = mapped(x, self.landmarks, root(self.landmarks, self.gamma), self.gamma) @ self.machines[:, :-1].T + self.machines[:, -1]
        p = 1 / (1 + np.exp(-np.clip(margins * self.curves[:, 0] + self.curves[:, 1], -500, 500)))
        if self.classes == 2:
            return np.stack([1 - p[:, 0], p[:, 0]], axis=1)
        return p / np.maximum(p.sum(axis=1, keepdims=True), 1e-300)


def kernel(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    square = (x**2).sum(axis=1)[:, None] + (y**2).sum(axis=1) - 2 * x @ y.T
    return np.exp(-gamma * np.maximum(square, 0))


def root(landmarks: np.ndarray, gamma: float) -> np.ndarray:
    """Inverse root of the landmarks' kernel, without directions that it hardly has."""
    if not len(landmarks):
        return np.zeros((0, 0))
    value, vector = np.linalg.eigh(kernel(landmarks, landmarks, gamma))
    large = value > LEAST_EIGENVALUE * value[-1]
    return vector[:, large] / np.sqrt(value[large])


def mapped(x: np.ndarray, landmarks: np.ndarray, half: np.ndarray, gamma: float) -> np.ndarray:
    """Short rows whose inner products stand for the kernel."""
    return kernel(x, landmarks, gamma) @ half


def _values(features: Sequence[str]) -> Column:
    return F.array(*(F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in features))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def fit(
    df: DataFrame, features: Sequence[str], label: str = "label", classes: int = 2, c: float = C, gamma: float | str = "scale",
    landmarks: int = LANDMARKS, seed: int = 1242, maxIter: int = 50,
) -> Kernel:
    """A machine for integer labels; two classes need one, more classes one each."""
    if not 0 < landmarks <= MOST_LANDMARKS:
        raise ValueError(f"landmarks must be from 1 to {MOST_LANDMARKS}")
    width = len(features)
    known = df.where(F.col(label).isNotNull()).select(_values(features).alias("x"), F.col(label).cast("int").alias("y"))
    known = settle(known, "labelled")
    chosen = known.select("x").distinct().orderBy(F.xxhash64("x", F.lit(seed)), "x").limit(landmarks).collect()
    marks = np.array([r.x for r in chosen]).reshape(-1, width)
    if gamma == "scale":
        spread = known.select(F.explode("x").alias("v")).agg(F.var_pop("v")).first()[0]
        gamma = 1 / (width * spread) if spread else 1.0
    half = root(marks, gamma)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                short = mapped(_matrix(batch.column(0), width), marks, half, gamma)
                yield pa.RecordBatch.from_arrays([pa.array(list(short), pa.list_(pa.float64())), *batch.columns[1:]], names=["z", "y", "held", "n"])

    known = settle(known.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")), "alike")
    known = known.repartition(max(1, -(-known.count() // TASK_ROWS)))  # no more tasks a step than they are worth
    held = F.pmod(F.xxhash64("x", F.lit("held"), F.lit(seed)), F.lit(100)) < HELD_SHARE
    rows = known.select("x", "y", held.alias("held"), "n").mapInArrow(run, "z array<double>, y int, held boolean, n bigint")
    rows = settle(rows.select(array_to_vector("z").alias("z"), "y", "held", F.col("n").cast("double").alias("n")), "mapped")
    machines, curves = [], []
    for k in [1] if classes == 2 else range(classes):
        own = rows.withColumn("t", (F.col("y") == k).cast("double"))
        machine, curve = _machine(own, c, maxIter, half.shape[1])
        machines.append(machine)
        curves.append(curve)
    return Kernel(classes, list(features), float(gamma), marks, np.array(machines), np.array(curves))


def _machine(rows: DataFrame, c: float, iterations: int, width: int) -> tuple[list[float], list[float]]:
    """(coefficients and constant, slope and constant of the curve) of one class against the rest."""
    counts = {(r.held, r.t): int(r.n) for r in rows.groupBy("held", "t").agg(F.sum("n").alias("n")).collect()}
    fitting, hits = counts.get((False, 0.0), 0) + counts.get((False, 1.0), 0), counts.get((False, 1.0), 0)
    share = (sum(n for (_, t), n in counts.items() if t) + 1) / (sum(counts.values()) + 2)
    if not 0 < hits < fitting:
        return [0.0] * (width + 1), [0.0, float(np.log(share / (1 - share)))]
    learner = LinearSVC(featuresCol="z", labelCol="t", weightCol="n", regParam=1 / (c * fitting), maxIter=iterations, standardization=False, rawPredictionCol="r", predictionCol="p")
    found = learner.fit(rows.where("not held"))
    machine = [*found.coefficients.toArray().tolist(), float(found.intercept)]
    yes, no = counts.get((True, 1.0), 0), counts.get((True, 0.0), 0)
    use = "held" if yes and no else "true"  # a holdout without both kinds cannot place the curve
    if use == "true":
        yes, no = hits + yes, fitting - hits + no
    from pyspark.ml.functions import vector_to_array

    margin = found.transform(rows.where(use)).select("t", "n", vector_to_array("r")[1].alias("m"))
    target = F.when(F.col("t") == 1, (yes + 1) / (yes + 2)).otherwise(1 / (no + 2))
    both = F.inline(F.array(F.struct(F.lit(1.0).alias("s"), (F.col("n") * F.col("g")).alias("w")), F.struct(F.lit(0.0).alias("s"), (F.col("n") * (1 - F.col("g"))).alias("w"))))
    weighted = margin.select("m", "n", target.alias("g")).select("m", both)
    curve = LogisticRegression(featuresCol="f", labelCol="s", weightCol="w", maxIter=50).fit(weighted.select(array_to_vector(F.array("m")).alias("f"), "s", "w"))
    return machine, [float(curve.coefficients[0]), float(curve.intercept)]


def score(model: Kernel, df: DataFrame) -> DataFrame:
    """Add `label_model` and `prob`, the largest class probability (ties: the smaller class)."""
    kept = [c for c in df.columns if c not in ("label_model", "prob")]
    rows = df.select(*kept, _values(model.features).alias("_values"))
    added = T._parse_datatype_string("label_model int, prob double").fields
    schema = T.StructType([*(rows.schema[c] for c in kept), *added])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                p = model.probabilities(_matrix(batch.column(batch.num_columns - 1), len(model.features)))
                columns = [*batch.columns[:-1], pa.array(p.argmax(axis=1)), pa.array(p.max(axis=1))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return rows.mapInArrow(run, schema)


def save(model: Kernel, spark: SparkSession, path: str) -> None:
    row = (model.classes, model.features, model.gamma, model.landmarks.tolist(), model.machines.tolist(), model.curves.tolist())
    small_table(spark, [row], HEAD).write.mode("overwrite").parquet(f"{path}/head")


def load(spark: SparkSession, path: str) -> Kernel:
    r = spark.read.parquet(f"{path}/head").first()
    marks = np.array(r.landmarks).reshape(-1, len(r.features))
    return Kernel(r.classes, list(r.features), r.gamma, marks, np.array(r.machines), np.array(r.curves))
