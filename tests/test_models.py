"""Estimators, scoring, search, leaderboard and stored models."""

import pytest
from pyspark.sql import functions as F

from tabloop.config import ProblemConfig
from tabloop.operators import encode, stats
from tabloop.plans import training
from tabloop.plans.scoring import Fitted, evaluate, score_table, submit
from tabloop.plans.training import draw_trials, make_estimator
from tabloop.sources import tables

CFG = ProblemConfig("phase-1", "prob-1", categorical=("c",), numerical=("x",))
SMALL = {"xgb": {"maxIter": 3, "maxDepth": 2}, "random_forest": {"numTrees": 3}, "mlp": {"maxIter": 5}, "svm": {"maxIter": 5}, "linear_svm": {"maxIter": 5}, "ada_boost": {"rounds": 3}}


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, "ab"[i % 2], float(i % 10), int(i % 10 > 4), i % 3, f"b{i % 4}") for i in range(200)]
    return spark.createDataFrame(data, "row_id long, c string, x double, label int, kind int, batch_id string")


@pytest.fixture(scope="module")
def fitted(rows):
    index = encode.fit_category_index(rows, ["c"])
    return Fitted(index, stats.fit_robust(encode.apply_codes(rows, index, ["c"]), ["c", "x"]))


@pytest.fixture(scope="module")
def model(rows, fitted):
    ready = stats.apply_robust(encode.apply_codes(rows, fitted.index, ["c"]), fitted.scale)
    return training.fit(ready, CFG.features, "decision_tree")


@pytest.mark.parametrize("name", ["xgb", "random_forest", "decision_tree", "naive_bayes", "mlp", "svm", "linear_svm", "ada_boost"])
@pytest.mark.parametrize("classes", [2, 3])
def test_every_model_scores_with_confidence(rows, name, classes):
    ready = rows.withColumn("c", F.when(F.col("c") == "a", 0.0).otherwise(1.0))
    label = "label" if classes == 2 else "kind"
    fit = training.fit(ready, ["c", "x"], name, label, classes, **SMALL.get(name, {}))
    out = training.score(fit, ready)
    low = out.agg(F.min("prob"), F.max("prob"), F.min("label_model"), F.max("label_model")).first()
    assert 1 / classes - 1e-9 <= low[0] and low[1] <= 1 + 1e-9 and low[2] >= 0 and low[3] < classes
    assert set(out.columns) == {*ready.columns, "label_model", "prob"}


def test_unknown_models_are_refused():
    for name in ("ada_boost", "knn"):
        with pytest.raises(ValueError):
            make_estimator(name)


def test_score_table_keeps_raw_columns(rows, fitted, model):
    out = score_table(rows.withColumn("prob", F.lit(0.1)), model, CFG, fitted)
    assert out.columns == [*rows.columns, "label_model", "prob"]
    assert out.where("label_model <> label").count() == 0
    assert {r.c for r in out.select("c").distinct().collect()} == {"a", "b"}
    auc, wrong = evaluate(rows, model, CFG, fitted)
    assert auc.first().auc == 1.0 and wrong.count() == 0


def test_submission(rows, fitted, model):
    lists = {r.batch_id: r["values"] for r in submit(rows, model, CFG, fitted).collect()}
    assert lists["b1"] == [int(i % 10 > 4) for i in range(1, 200, 4)]


def test_class_names_come_back(rows, fitted, model):
    named = Fitted(fitted.index, fitted.scale, labels=encode.fit_labels(rows.withColumn("n", F.when(F.col("label") == 1, "yes").otherwise("no")), "n"))
    assert {r.label_model for r in score_table(rows, model, CFG, named).select("label_model").distinct().collect()} == {"yes", "no"}


def test_stored_model_checks_its_input(spark, rows, model, tmp_path):
    ready = rows.select(F.lit(0.0).alias("c"), "x")
    tables.save_model(model, ready.schema, str(tmp_path / "m" / "1"))
    loaded, schema = tables.load_model(spark, str(tmp_path / "m" / "1"))
    assert training.score(loaded, tables.check_schema(ready, schema)).count() == 200
    with pytest.raises(ValueError):
        tables.check_schema(rows, schema)


def test_trials_are_distinct_and_bounded():
    space = {"a": [1, 2], "b": [3, 4, 5]}
    points = draw_trials(space, 100, 1)
    assert len(points) == 6 and len({tuple(sorted(p.items())) for p in points}) == 6
    assert draw_trials(space, 4, 1) == draw_trials(space, 4, 1)


def test_leaderboard_and_refit(rows):
    ready = rows.withColumn("c", F.when(F.col("c") == "a", 0.0).otherwise(1.0))
    board = training.compare(ready, ["c", "x"], ["decision_tree", "naive_bayes"], folds=2)
    values = [r.value for r in board.collect()]
    assert values == sorted(values, reverse=True) and board.first().model == "decision_tree"
    best = training.refit_best(board, ready, ["c", "x"])
    assert training.score(best, ready).where("label_model <> label").count() == 0


def test_search_orders_by_accuracy(rows):
    ready = rows.withColumn("c", F.when(F.col("c") == "a", 0.0).otherwise(1.0))
    board = training.random_search(ready, ["c", "x"], "decision_tree", {"maxDepth": [1, 2, 3]}, trials=3, train_share=0.8)
    got = [r.accuracy for r in board.collect()]
    assert len(got) == 3 and got == sorted(got, reverse=True)


def test_run_log_appends(spark, tmp_path):
    for i in range(2):
        tables.log_run(spark, str(tmp_path / "runs"), f"r{i}", tables.experiment_name(CFG, "xgb"), {"depth": 7}, {"f1": 0.5})
    rows = spark.read.parquet(str(tmp_path / "runs")).collect()
    assert len(rows) == 4 and {r.experiment for r in rows} == {"phase-1_prob-1_xgb-1"}
