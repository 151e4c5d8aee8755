"""Softmax boosting against a plain numpy version, against one-vs-rest, and its edges."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloop.plans import boosting, training
from tabloop.sources import tables


def plain(x, label, classes, cuts, rounds, depth, rate=0.3, l1=0.0, l2=1.0, least=1.0):
    """Trees by recursion over rows; sums of rounded gradients, as the job makes them."""
    bins = np.array([[0 if math.isnan(v) else 1 + sum(c < v for c in cuts[j]) for j, v in enumerate(row)] for row in x])
    width = boosting.BINS + 1
    margins = np.zeros((len(x), classes))
    out = []

    def draw(g):
        return math.copysign(max(abs(g) - l1, 0), g)

    def grow(rows, g, h, node, level, tree):
        total_g, total_h = g[rows].sum() / boosting.UNIT, h[rows].sum() / boosting.UNIT
        best = (boosting.LEAST_GAIN, None)
        for column in range(x.shape[1]) if level < depth else ():
            for bound in range(width - 1):
                left = rows & (bins[:, column] <= bound)
                a, b = g[left].sum() / boosting.UNIT, h[left].sum() / boosting.UNIT
                if b < least or total_h - b < least:
                    continue
                gain = draw(a) ** 2 / (b + l2) + draw(total_g - a) ** 2 / (total_h - b + l2) - draw(total_g) ** 2 / (total_h + l2)
                if gain > best[0]:
                    best = (gain, (column, bound))
        if best[1] is None:
            tree.leaves[node] = -rate * draw(total_g) / (total_h + l2)
            margins[rows, tree.k] += tree.leaves[node]
            return
        column, bound = tree.splits[node] = best[1]
        grow(rows & (bins[:, column] <= bound), g, h, 2 * node, level + 1, tree)
        grow(rows & (bins[:, column] > bound), g, h, 2 * node + 1, level + 1, tree)

    for _ in range(rounds):
        g, h, _ = boosting.gradients(margins.copy(), label)
        trees = []
        for k in range(classes):
            tree = boosting.Tree()
            tree.k = k
            grow(np.ones(len(x), bool), g[:, k], h[:, k], 1, 0, tree)
            trees.append(tree)
        if not any(t.splits for t in trees):
            break
        out.append(trees)
    return out


def sample(rows, seed=4):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(rows, 3)).round(2)
    x[::17, 0] = np.nan
    label = (np.nan_to_num(x[:, 0]) > 0.3).astype(int) + (x[:, 1] * x[:, 2] > 0)
    label[::11] = (label[::11] + 1) % 3
    return x, label


def table(spark, x, label):
    rows = [(i, *(None if math.isnan(v) else float(v) for v in row), int(y)) for i, (row, y) in enumerate(zip(x, label))]
    return spark.createDataFrame(rows, "row_id int, a double, b double, c double, label int")


FEATURES = ["a", "b", "c"]


@pytest.mark.parametrize("more", [{}, {"l1": 0.4, "l2": 3.0, "least": 4.0}])
def test_equals_plain_numpy(spark, monkeypatch, more):
    monkeypatch.setattr(boosting, "SETTLE_ROUNDS", 2)
    x, label = sample(150)
    named = {"least": "least_hessian"}
    model = boosting.fit(table(spark, x, label), FEATURES, classes=3, rounds=3, depth=3, **{named.get(k, k): v for k, v in more.items()})
    want = plain(x, label, 3, model.cuts, 3, 3, **more)
    assert len(want) == len(model.rounds) == 3
    for trees, other in zip(model.rounds, want):
        for tree, same in zip(trees, other):
            assert tree.splits == same.splits
            assert tree.leaves == pytest.approx(same.leaves, abs=1e-12)
    train = [v for _, part, v in model.losses if part == "train"]
    assert train[0] == pytest.approx(math.log(3), abs=1e-6) and train == sorted(train, reverse=True) and len(train) == 4


def test_splits_are_chosen_where_the_sums_are(spark, monkeypatch):
    """Beyond the limit only chosen splits come to the driver; the trees stay as they are, also with copies of rows."""
    rng = np.random.default_rng(6)
    x = rng.integers(0, 5, (150, 3)).astype(float)
    rows = [(*map(float, v), int(v.sum()) % 3) for v in x] * 3
    df = spark.createDataFrame(rows, "a double, b double, c double, label int")
    by_driver = boosting.fit(df, ["a", "b", "c"], classes=3, rounds=3, depth=3)
    monkeypatch.setattr(boosting, "DRIVER_CELLS", 0)
    whole = []
    monkeypatch.setattr(boosting, "_whole", lambda partial: whole.append(1) or partial)
    by_tasks = boosting.fit(df, ["a", "b", "c"], classes=3, rounds=3, depth=3)
    assert not whole and list(by_tasks.rows()) == list(by_driver.rows()) and by_tasks.losses == by_driver.losses
    assert any(tree.splits for trees in by_tasks.rounds for tree in trees)


def test_partitions_do_not_matter(spark):
    df = table(spark, *sample(400))
    one = boosting.fit(df.coalesce(1), FEATURES, classes=3, rounds=4, depth=4)
    many = boosting.fit(df.repartition(7), FEATURES, classes=3, rounds=4, depth=4)
    assert list(one.rows()) == list(many.rows()) and one.losses == many.losses


def test_not_worse_than_one_against_the_rest_on_held_rows(spark):
    df = table(spark, *sample(3000, 9)).withColumn("held", F.col("row_id") % 4 == 0)
    train, test = df.where("not held"), df.where("held")
    model = training.fit(train, FEATURES, "xgb", classes=3, maxIter=20, maxDepth=4)
    rest = training.pipeline(FEATURES, training.make_estimator("xgb", 3, maxIter=20, maxDepth=4))
    rest = rest.fit(train.na.fill(-9.0).withColumn("label", F.col("label").cast("double")))
    right = lambda scored: scored.agg(F.avg((F.col("label") == F.col("label_model")).cast("int"))).first()[0]
    own, other = right(training.score(model, test)), right(training.score(rest, test.na.fill(-9.0)))
    assert own >= other - 0.01 and own > 0.8


def test_held_rows_stop_the_fit_and_are_not_learnt_from(spark):
    x, label = sample(600, 2)
    label[::3] = np.random.default_rng(0).integers(0, 3, len(label[::3]))
    df = table(spark, x, label)
    model = boosting.fit(df, FEATURES, classes=3, rounds=60, depth=5, held=F.col("row_id") % 2 == 0, patience=3)
    held = {r: v for r, part, v in model.losses if part == "held"}
    assert len(model.rounds) == min(held, key=lambda r: (held[r], r)) < 60
    alone = boosting.fit(df.where("row_id % 2 = 1"), FEATURES, classes=3, rounds=len(model.rounds), depth=5)
    assert list(alone.rows()) == list(model.rows())


def test_saved_model_scores_alike_and_keeps_columns(spark, tmp_path):
    df = table(spark, *sample(200)).withColumn("prob", F.lit("old"))
    model = training.fit(df, FEATURES, "lightgbm", classes=3, maxIter=3, maxDepth=3)
    tables.save_model(model, df.select(*FEATURES).schema, str(tmp_path / "model"))
    again, schema = tables.load_model(spark, str(tmp_path / "model"))
    assert schema == df.select(*FEATURES).schema and list(again.rows()) == list(model.rows())
    one = boosting.score(model, df, "all").orderBy("row_id").collect()
    two = training.score(again, df).orderBy("row_id").collect()
    assert [(r.label_model, r.prob) for r in one] == [(r.label_model, r.prob) for r in two]
    assert all(abs(sum(r.all) - 1) < 1e-12 and max(r.all) == r.prob and r.all[r.label_model] == r.prob for r in one)
    assert set(one[0].asDict()) == {"row_id", *FEATURES, "label", "label_model", "prob", "all"}


def test_pure_missing_and_empty_inputs(spark):
    schema = "a double, b double, label int"
    pure = spark.createDataFrame([(1.0, None, 1), (2.0, None, 1), (None, None, None)], schema)
    model = boosting.fit(pure, ["a", "b"], classes=2, rounds=3)
    assert model.rounds == [] and boosting.score(model, pure).select("label_model").distinct().count() == 1
    empty = boosting.fit(pure.limit(0), ["a", "b"], classes=3, rounds=3)
    assert empty.rounds == [] and empty.losses == [] and boosting.score(empty, pure.limit(0)).collect() == []
    missing = spark.createDataFrame([(None if i % 2 else 1.0, math.nan, i % 2) for i in range(40)], schema)
    model = boosting.fit(missing, ["a", "b"], classes=2, rounds=10)
    assert boosting.score(model, missing).where("label_model <> label").count() == 0
    with pytest.raises(ValueError):
        boosting.fit(pure, ["a", "b"], classes=1)
    with pytest.raises(ValueError):
        boosting.fit(spark.createDataFrame([(1.0, 1.0, 5)], schema), ["a", "b"], classes=3)
