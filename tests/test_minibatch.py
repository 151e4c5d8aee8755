"""Mini-batch k-means against the whole fit, and its edges."""

import math

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabloop.operators import minibatch, relabel


def blobs(spark, count=4000, groups=200, seed=1):
    draw = np.random.default_rng(seed)
    middles = draw.normal(0, 10, (groups, 6))
    x = middles[draw.integers(0, groups, count)] + draw.normal(0, 1, (count, 6))
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "row_id int, v array<double>"), x


def test_cost_is_near_that_of_the_whole_fit(spark):
    df, x = blobs(spark)
    centres = minibatch.fit(df, F.col("v"), k=30, batch_rows=500)
    whole = KMeans(k=30, seed=1242, maxIter=20).fit(df.select(array_to_vector("v").alias("features")))
    best = minibatch.cost(df, F.col("v"), np.array(whole.clusterCenters()))
    own = minibatch.cost(df, F.col("v"), centres)
    assert own <= 1.1 * best and abs(own - minibatch.nearest(x, centres)[1].sum()) < 1e-3
    again = minibatch.fit(df, F.col("v"), k=30, batch_rows=500)
    assert minibatch.cost(df, F.col("v"), again) <= 1.1 * best


def test_a_step_moves_centres_by_their_learning_counts(spark, monkeypatch):
    df, x = blobs(spark, 300, 3)
    centres = np.array([list(x[0]), list(x[1])])
    sums, counts, _ = minibatch._step(df.select(F.col("v").alias("x")), centres)
    at, _ = minibatch.nearest(x, centres)
    for k in range(2):
        assert counts[k] == (at == k).sum() and np.allclose(sums[k], x[at == k].sum(axis=0), atol=1e-6)


def test_copies_bad_rows_and_few_distinct_rows(spark):
    rows = [([1.0, 1.0],)] * 500 + [([5.0, 5.0],)] * 3 + [([math.nan, 1.0],), ([None, 1.0],), (None,), ([],), ([math.inf, 0.0],)]
    df = spark.createDataFrame(rows, "v array<double>")
    centres = minibatch.fit(df, F.col("v"), k=10, batch_rows=50)
    assert sorted(map(tuple, centres.round(9))) == [(1.0, 1.0), (5.0, 5.0)]
    assert minibatch.fit(df.limit(0), F.col("v"), k=3).shape == (0, 0)


def test_propagation_uses_the_centres(spark):
    df, _ = blobs(spark, 600, 4)
    labelled = df.withColumn("label", (F.col("v")[0] > 0).cast("int"))
    out = relabel.propagate(labelled, df, ["v"], k=40)
    right = out.join(labelled.select("row_id", "label"), "row_id").where("label = label_model").count()
    assert out.count() == 600 and right > 540
