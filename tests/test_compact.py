"""Trees on rows that differ, weighted by their number, against trees on all rows."""

import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tabloop.functions.keys import hash_key
from tabloop.plans import compact, search, training

COLS = ["a", "b"]


@pytest.fixture(scope="module")
def rows(spark):
    """Few values, many copies; the label is noisy, so that a limit of rows per node matters."""
    key = hash_key(F.col("id"), ":x")
    return spark.range(3000).select(
        F.col("id").alias("row_id"), (key % 5).cast("double").alias("a"), (F.floor(key / 5) % 7).cast("double").alias("b"),
        (((key % 5 > 2).cast("int") + (F.floor(key / 35) % 9 == 0).cast("int") + (F.floor(key / 5) % 7 == 0).cast("int")) % 2).cast("double").alias("label"),
    ).cache()


def plain(rows, name, **params):
    return training.pipeline(COLS, training.make_estimator(name, 2, 2, "label", **params)).fit(rows)


def answers(model, rows):
    scored = training.score(model, rows)
    return {(r.a, r.b): (r.label_model, round(r.prob, 9)) for r in scored.select("a", "b", "label_model", "prob").distinct().collect()}


def test_few_values_have_a_bin_each_and_many_are_cut_at_quantiles(spark):
    table = spark.range(10_000).select(F.when(F.col("id") == 7, 5.0).otherwise(F.col("id") % 2).alias("few"), F.col("id").cast("double").alias("many"), F.lit(1.0).alias("one"))
    few, many, one = compact.bounds(table, ["few", "many", "one"], 8)
    assert few == [0.5, 3.0] and one == [] and len(many) == 7
    assert all(abs(c - 1250 * (i + 1)) < 10 for i, c in enumerate(many))
    found = compact.alike(table.withColumn("label", F.lit(1)), compact.binner(["few", "many", "one"], [few, many, one]), "label")
    assert found.count() <= 3 * 8 and found.agg(F.sum(compact.COPIES)).first()[0] == 10_000


def test_bounds_lie_between_neighbouring_and_endless_values(spark):
    close = math.nextafter(1.0, 2.0)
    table = spark.createDataFrame([(v,) for v in (-math.inf, 1.0, close, math.inf)], "x double")
    cuts = compact.bounds(table, ["x"], 8)
    found = compact.alike(table.withColumn("label", F.lit(0)), compact.binner(["x"], cuts), "label")
    assert found.count() == 4


@pytest.mark.parametrize("name, params", [
    ("decision_tree", {"maxDepth": 5}), ("decision_tree", {"maxDepth": 5, "minInstancesPerNode": 110}),
    ("decision_tree", {"minInstancesPerNode": 1501}), ("xgb", {"maxIter": 5, "maxDepth": 3}),
])
def test_models_equal_those_of_all_rows(rows, name, params):
    model = training.fit(rows, COLS, name, **params)
    assert len(model.stages) == 3  # bins, vector, trees: before, all rows were fitted
    assert answers(model, rows) == answers(plain(rows, name, **params), rows)
    assert not [c for c in training.score(model, rows).columns if c.startswith("_bin_")]


def test_models_that_draw_rows_see_all_rows(rows):
    assert len(training.fit(rows, COLS, "xgb", maxIter=2, maxDepth=2, subsamplingRate=0.5).stages) == 2
    assert len(training.fit(rows, COLS, "random_forest", numTrees=2, maxDepth=2).stages) == 2


@pytest.mark.parametrize("guided", [False, True])
def test_searches_find_the_accuracy_of_all_rows_from_compact_ones(rows, guided, monkeypatch):
    sizes = []
    kept = training.fit_alike
    monkeypatch.setattr(training, "fit_alike", lambda stage, alike, *a: sizes.append(alike.count()) or kept(stage, alike, *a))
    space = {"maxDepth": [1, 2, 4], "minInstancesPerNode": [1, 150]}
    run = search.guided_search if guided else training.random_search
    board = run(rows, COLS, "decision_tree", space, trials=4, train_share=0.8, parallelism=2).collect()
    assert len(sizes) == 4 and max(sizes) <= 2 * 5 * 7  # before, each trial read the 2,400 rows
    held = hash_key(F.col("row_id"), ":1242") % 1000 >= 800
    for r in board:
        model = plain(rows.where(~held), "decision_tree", **eval(r.params))
        judge = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
        assert judge.evaluate(model.transform(rows.where(held))) == pytest.approx(r.value if guided else r.accuracy)
