"""Boosting by reweighting against numpy; the radial kernel machine on rings, its kernel error and its probabilities."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloop.plans import adaboost, kernels, training
from tabloop.sources import tables


def stump(x, label, weight, classes):
    """Best gini split of the weighted rows, and each row's answer."""
    def impurity(rows):
        share = np.array([weight[rows & (label == k)].sum() for k in range(classes)])
        return share.sum() * (1 - ((share / share.sum()) ** 2).sum()) if share.sum() else 0

    everything = np.ones(len(x), bool)
    best = (-1, None)
    for column in range(x.shape[1]):
        for cut in np.unique(x[:, column])[:-1]:
            left = x[:, column] <= cut
            gain = impurity(everything) - impurity(left) - impurity(~left)
            if gain > best[0] + 1e-12:
                best = (gain, left)
    most = lambda rows: np.argmax([weight[rows & (label == k)].sum() for k in range(classes)])
    return np.where(best[1], most(best[1]), most(~best[1]))


def plain(x, label, classes, rounds, rate=1.0):
    weight, out = np.ones(len(x)), []
    for _ in range(rounds):
        wrong = stump(x, label, weight, classes) != label
        error = weight[wrong].sum() / weight.sum()
        out.append(rate * (math.log((1 - error) / error) + math.log(classes - 1)))
        weight = weight * np.where(wrong, math.exp(out[-1]), 1.0)
        weight *= len(x) / weight.sum()
    return out


@pytest.mark.parametrize("classes, rate", [(2, 1.0), (3, 0.5)])
def test_stage_weights_equal_numpy(spark, classes, rate):
    draw = np.random.default_rng(classes)
    x = draw.integers(0, 12, (400, 3)).astype(float)
    label = (x[:, 0] + x[:, 1] > 11).astype(int) + (classes == 3) * (x[:, 2] > 7)
    label[::13] = draw.integers(0, classes, len(label[::13]))
    df = spark.createDataFrame([(*map(float, r), int(y)) for r, y in zip(x, label)], "a double, b double, c double, label int")
    model = adaboost.fit(df, ["a", "b", "c"], classes=classes, rounds=5, rate=rate)
    assert model.weights == pytest.approx(plain(x, label, classes, 5, rate), abs=1e-9)
    scored = adaboost.score(model, df.withColumn("prob", F.lit(0)))
    right = scored.agg(F.avg((F.col("label") == F.col("label_model")).cast("int"))).first()[0]
    assert right > 0.5 and scored.columns == ["a", "b", "c", "label", "label_model", "prob"]


def test_interval_needs_several_stumps_and_models_are_stored(spark, tmp_path):
    rows = [(float(i % 10), int(3 <= i % 10 <= 6)) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, label int")
    model = training.fit(df, ["a"], "ada_boost", rounds=12)
    assert len(model.trees) > 2 and training.score(model, df).where("label <> label_model").count() == 0
    for name, own in (("ada", model), ("svm", training.fit(df, ["a"], "svm", maxIter=10))):
        tables.save_model(own, df.select("a").schema, str(tmp_path / name))
        again, _ = tables.load_model(spark, str(tmp_path / name))
        rows = lambda m: sorted(tuple(r) for r in training.score(m, df).collect())
        assert rows(again) == rows(own)
    sure = training.fit(df.withColumn("label", (F.col("a") > 4).cast("int")), ["a"], "ada_boost")
    assert sure.weights == [1.0]
    empty = adaboost.fit(df.limit(0), ["a"])
    assert empty.trees == [] and adaboost.score(empty, df.limit(3)).where("label_model = 0 and prob = 0.5").count() == 3


def rings(count, seed=0):
    draw = np.random.default_rng(seed)
    label = draw.integers(0, 2, count)
    angle, radius = draw.uniform(0, 2 * np.pi, count), 1 + 1.5 * label + draw.normal(0, 0.15, count)
    return np.stack([radius * np.cos(angle), radius * np.sin(angle)], axis=1), label


def test_separates_rings_with_fair_probabilities(spark):
    x, label = rings(1500)
    df = spark.createDataFrame([(float(a), float(b), int(y)) for (a, b), y in zip(x, label)], "a double, b double, label int")
    model = training.fit(df, ["a", "b"], "svm", landmarks=60, maxIter=30)
    fresh, truth = rings(500, 1)
    p = model.probabilities(fresh)
    assert (p.argmax(axis=1) == truth).mean() > 0.98 and np.allclose(p.sum(axis=1), 1)
    noisy = df.withColumn("label", F.when(F.pmod(F.hash("a"), F.lit(10)) < 2, 1 - F.col("label")).otherwise(F.col("label")))
    p = training.fit(noisy, ["a", "b"], "svm", landmarks=60, maxIter=30).probabilities(fresh)
    inside = np.abs(np.linalg.norm(fresh, axis=1) - 2.5) < 0.2
    assert abs(p[inside, 1].mean() - 0.8) < 0.08  # four in five labels are right


def test_kernel_error_is_bounded():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(400, 5))
    exact, errors = kernels.kernel(x, x, 0.1), []
    for count in (20, 80, 200):
        marks = x[draw.permutation(400)[:count]]
        z = kernels.mapped(x, marks, kernels.root(marks, 0.1), 0.1)
        errors.append(np.abs(z @ z.T - exact).mean())
    assert errors == sorted(errors, reverse=True) and errors[1] < 0.02 and errors[2] < 0.003
    z = kernels.mapped(marks, marks, kernels.root(marks, 0.1), 0.1)
    assert np.allclose(z @ z.T, kernels.kernel(marks, marks, 0.1), atol=1e-4)  # exact at the landmarks


def test_three_classes_missing_values_copies_and_one_class(spark):
    rows = [(float(i % 3) * 4, None if i % 5 == 0 else float(i % 2), i % 3) for i in range(300)] + [(0.0, 0.0, 0)] * 200
    df = spark.createDataFrame(rows, "a double, b double, label int")
    model = kernels.fit(df, ["a", "b"], classes=3, maxIter=15)
    assert len(model.landmarks) == 6 and kernels.score(model, df).where("label <> label_model").count() == 0
    one = kernels.fit(df.where("label = 0"), ["a", "b"])
    assert kernels.score(one, df).select("label_model").distinct().collect() == [(0,)]
    empty = kernels.fit(df.limit(0), ["a", "b"])
    assert kernels.score(empty, df.limit(2)).where("prob = 0.5").count() == 2
    with pytest.raises(ValueError):
        kernels.fit(df, ["a", "b"], landmarks=0)


def test_rows_alike_are_one_row_with_their_number(spark, monkeypatch):
    """The rows of a fit are as many as there are different ones; weights and answers are those of all rows."""
    rows = [(float(i % 4), int(i % 4 in (1, 2)) ^ int(i % 40 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, label int").repartition(5)
    sizes = []

    def settled(module):
        kept = module.settle

        def run(table, name):
            out = kept(table, name)
            sizes.append((name, out.count()))
            return out

        monkeypatch.setattr(module, "settle", run)

    settled(adaboost)
    ada = adaboost.fit(df, ["a"], rounds=3)
    x, label = np.array([r[:1] for r in rows]), np.array([r[1] for r in rows])
    assert ada.weights == pytest.approx(plain(x, label, 2, 3))
    settled(kernels)
    machine = kernels.fit(df, ["a"])
    assert {n for name, n in sizes if name in ("weights", "alike", "mapped")} == {5}
    assert {r.a: r.label_model for r in kernels.score(machine, df).select("a", "label_model").distinct().collect()} == {0.0: 0, 1.0: 1, 2.0: 1, 3.0: 0}
