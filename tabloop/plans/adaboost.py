"""Multi-class boosting by reweighting (SAMME): weighted trees, each on what the ones before got wrong.

A round fits a Spark ML tree on the weights, and one aggregate gives its weighted error. The tree's weight is
rate * (ln((1 - error) / error) + ln(classes - 1)); rows it gets wrong grow by the exponential of that. Rows alike in
features and label always weigh the same, so they are one row from the start, with their number as weight. Weights are a
column of a written table, made anew each round from the one before, so a lost task repeats one round at most. A tree
without error ends the fit and is kept alone with weight 1 if it is the first; a tree no better than chance ends it
and is dropped.

Probabilities are the softmax of the summed tree weights per class over classes - 1. Rows without a label are left
out of the fit. Ties go to the smaller class.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloop.storage import settle, small_table

ROUNDS, DEPTH, RATE = 50, 1, 1.0  # fixed values: defaults of the reference's library


@dataclass
class Ada:
    classes: int
    features: list[str]
    trees: list[DecisionTreeClassificationModel]
    weights: list[float]


def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="_features").transform(df)


def fit(
    df: DataFrame, features: Sequence[str], label: str = "label", classes: int = 2, rounds: int = ROUNDS,
    depth: int = DEPTH, rate: float = RATE, seed: int = 1242,
) -> Ada:
    """Trees and their weights for integer labels 0 to classes - 1."""
    known = df.where(F.col(label).isNotNull()).select(*features, F.col(label).cast("double").alias("_label"))
    known = known.groupBy(*dict.fromkeys(features), "_label").agg(F.count(F.lit(1)).cast("double").alias("_weight"))
    rows = settle(_assembled(known, features).select("_features", "_label", "_weight"), "weights")
    model = Ada(classes, list(features), [], [])
    total = rows.agg(F.sum("_weight")).first()[0]
    if not total:
        return model
    grower = DecisionTreeClassifier(
        featuresCol="_features", labelCol="_label", weightCol="_weight", maxDepth=depth, seed=seed, predictionCol="_found",
        probabilityCol="_p", rawPredictionCol="_r",
    )
    for number in range(rounds):
        tree = grower.fit(rows)
        judged = tree.transform(rows).withColumn("_wrong", F.col("_found") != F.col("_label"))
        lost, whole = judged.agg(F.coalesce(F.sum(F.when(F.col("_wrong"), F.col("_weight"))), F.lit(0.0)), F.sum("_weight")).first()
        error = lost / whole
        if error <= 0:
            if not model.trees:
                model.trees.append(tree)
                model.weights.append(1.0)
            else:
                model.trees.append(tree)
                model.weights.append(max(model.weights) + sum(model.weights))  # outvotes all before it
            break
        if error >= 1 - 1 / classes:
            break
        weight = rate * (math.log((1 - error) / error) + math.log(classes - 1))
        model.trees.append(tree)
        model.weights.append(weight)
        if number + 1 < rounds:
            grown = F.col("_weight") * F.when(F.col("_wrong"), math.exp(weight)).otherwise(1.0)
            share = F.lit(total / (whole + lost * (math.exp(weight) - 1)))  # weights keep their mean of 1
            rows = settle(judged.select("_features", "_label", (grown * share).alias("_weight")), "weights")
    return model


def score(model: Ada, df: DataFrame) -> DataFrame:
    """Add `label_model` and `prob`, the largest class probability."""
    kept = [c for c in df.columns if c not in ("label_model", "prob")]
    out = _assembled(df.select(*kept), model.features)
    for i, tree in enumerate(model.trees):
        named = tree.copy({tree.predictionCol: f"_t{i}", tree.probabilityCol: "_p", tree.rawPredictionCol: "_r"})
        out = named.transform(out).drop("_p", "_r")

    def votes(k: int) -> Column:
        own = (F.when(F.col(f"_t{i}") == k, w).otherwise(0.0) for i, w in enumerate(model.weights))
        return sum(own, F.lit(0.0)) / (model.classes - 1) / max(1e-300, sum(model.weights) or 1.0)

    out = out.withColumn("_votes", F.array(*(votes(k) for k in range(model.classes))))
    most = F.array_max("_votes")
    rise = F.transform("_votes", lambda v: F.exp(v - most))
    share = 1.0 / F.aggregate(rise, F.lit(0.0), lambda a, v: a + v)
    label = (F.array_position("_votes", most) - 1).cast("int")
    return out.select(*kept, label.alias("label_model"), share.alias("prob"))


def save(model: Ada, spark: SparkSession, path: str) -> None:
    for i, tree in enumerate(model.trees):
        tree.write().overwrite().save(f"{path}/trees/{i}")
    head = [(model.classes, model.features, [float(w) for w in model.weights])]
    small_table(spark, head, "classes int, features array<string>, weights array<double>").write.mode("overwrite").parquet(f"{path}/head")


def load(spark: SparkSession, path: str) -> Ada:
    head = spark.read.parquet(f"{path}/head").first()
    trees = [DecisionTreeClassificationModel.load(f"{path}/trees/{i}") for i in range(len(head.weights))]
    return Ada(head.classes, list(head.features), trees, list(head.weights))
