"""Counts, confusion-matrix metrics and confidence reports, each one aggregate with small state."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloop.storage import small_table

MAX_CLASSES = 10_000


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def collect_counts(df: DataFrame, label: str) -> dict:
    """Class sizes on the driver; refuses a column that does not hold classes."""
    rows = class_counts(df.where(F.col(label).isNotNull()), label).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} distinct values")
    return dict(sorted((r[label], r.n) for r in rows))


def confidence_report(df: DataFrame, label: str = "label_model") -> DataFrame:
    """Shares of all rows below confidence levels, overall and per predicted class."""
    prob, one, zero = F.col("prob"), F.col(label) == 1, F.col(label) == 0

    def share(condition: Column, name: str) -> Column:
        return (F.count_if(condition) / F.count(F.lit(1))).alias(name)

    return df.agg(
        share(prob < 0.8, "below_08"),
        share((prob < 0.8) & one, "below_08_label_1"),
        share((prob < 0.8) & zero, "below_08_label_0"),
        share(prob < 0.7, "below_07"),
        share((prob < 0.7) & one, "below_07_label_1"),
        share((prob < 0.7) & zero, "below_07_label_0"),
        share(prob <= 0.6, "upto_06"),
        share((prob <= 0.6) & one, "upto_06_label_1"),
        share(prob < 0.5, "below_05"),
    )


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator)


def _confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(y & ~p).alias("fn"),
    )


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall, F1; a ratio without cases is 0."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return _confusion(df, label, prediction).select(
        _ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def hard_auc(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Area under the curve of 0/1 predictions: mean of true positive and true negative rate."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return _confusion(df, label, prediction).select(((_ratio(tp, tp + fn) + _ratio(tn, tn + fp)) / 2).alias("auc"))


def score_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the curve of scores, over every distinct score."""
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="_s", labelCol="_y", metricName="areaUnderROC", numBins=0
    )
    pairs = df.select(F.col(score).cast("double").alias("_s"), F.col(label).cast("double").alias("_y"))
    return small_table(df.sparkSession, [(float(evaluator.evaluate(pairs)),)], "auc double")


def micro_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Micro-averaged precision, recall and F1 over all classes."""
    matrix = df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))
    hit = F.sum(F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0))
    share = (hit / F.sum("n")).alias("share")
    return matrix.agg(share).select(*[F.col("share").alias(m) for m in ("accuracy", "precision", "recall", "f1")])


def disagreements(a: DataFrame, b: DataFrame, on: str = "row_id", label: str = "label_model") -> DataFrame:
    """Rows that two scored tables label differently, with both labels and confidences."""
    left = a.select(on, F.col(label).alias("label_a"), F.col("prob").alias("prob_a"))
    right = b.select(on, F.col(label).alias("label_b"), F.col("prob").alias("prob_b"))
    return left.join(right, on).where(F.col("label_a") != F.col("label_b"))


def disagreement_count(a: DataFrame, b: DataFrame, on: str = "row_id", label: str = "label_model") -> DataFrame:
    return disagreements(a, b, on, label).agg(F.count(F.lit(1)).alias("n"))
