"""Neighbours and rebalancing against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloop.operators import neighbours, resample, skew


def brute(points, block, k):
    out = {}
    for i in range(len(points)):
        others = np.array([j for j in range(len(points)) if j != i and block[j] == block[i]])
        if not len(others):
            continue
        total = np.zeros(len(others))
        for c in range(points.shape[1]):
            total += (points[i, c] - points[others, c]) ** 2
        order = np.lexsort((others, total))[:k]
        out[i] = [int(others[o]) for o in order]
    return out


@pytest.mark.parametrize("leaf_rows", [40, 100_000])
@pytest.mark.parametrize("broadcastable", [True, False])
def test_knn_with_many_copies(spark, monkeypatch, leaf_rows, broadcastable):
    rng = np.random.default_rng(3)
    points = np.round(rng.normal(size=(600, 3)), 1)
    points[rng.choice(600, 200, replace=False)] = points[0]  # a third of all rows are copies of one
    block = rng.integers(0, 3, 600)
    if not broadcastable:
        monkeypatch.setattr(skew, "fits_broadcast", lambda df: False)
        monkeypatch.setattr(skew, "HOT_ROWS", 20)
    df = spark.createDataFrame(
        [(i, int(block[i]), *map(float, points[i])) for i in range(600)], "row_id long, b int, x double, y double, z double"
    )
    got = {}
    for r in neighbours.knn(df, 4, ["x", "y", "z"], "b", leaf_rows=leaf_rows).collect():
        got.setdefault(r.row_id, {})[r["rank"]] = r.nn_id
    assert {i: [m[j + 1] for j in range(len(m))] for i, m in got.items()} == brute(points, block, 4)


def test_knn_splits_busy_leaves(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "VISIT_ROWS", 7)
    rng = np.random.default_rng(4)
    points = rng.normal(size=(150, 2))
    df = spark.createDataFrame([(i, *map(float, points[i])) for i in range(150)], "row_id long, x double, y double")
    got = {}
    for r in neighbours.knn(df, 3, ["x", "y"], leaf_rows=30).collect():
        got.setdefault(r.row_id, {})[r["rank"]] = r.nn_id
    assert {i: [m[j + 1] for j in range(3)] for i, m in got.items()} == brute(points, np.zeros(150), 3)


def test_visits_grow_with_leaves(spark):
    """Wide vectors: one record per pair of leaves, whatever the rows."""
    rng = np.random.default_rng(8)
    points = rng.normal(size=(800, 24))
    df = spark.createDataFrame([(i, points[i].tolist()) for i in range(800)], "row_id long, vec array<double>")
    packs = neighbours._pack(neighbours._points(df, ["vec"], None, "row_id"), 1)
    assigned, _, leaves = neighbours._plant(packs, 100, neighbours.MAX_LEAVES)
    assigned = assigned.withColumn("radius", F.lit(float("inf"))).cache()
    sizes = [r["count"] for r in assigned.groupBy("leaf").count().collect()]
    assert len(sizes) == leaves and max(sizes) <= 100
    visits = neighbours.leaf_visits(assigned, neighbours._box(assigned, 24), 24)
    assert visits.count() == leaves * (leaves - 1)
    assert "vec" not in visits.columns


def test_wide_vectors_are_compared_in_a_grid(spark, monkeypatch):
    """Where leaves lie near all others a vector is sent once per part of the grid, not once per leaf."""
    rng = np.random.default_rng(10)
    points = np.round(rng.normal(size=(500, 16)), 1)
    points[::7] = points[0]
    df = spark.createDataFrame([(i, points[i].tolist()) for i in range(500)], "row_id long, vec array<double>")
    monkeypatch.setattr(neighbours, "GRID_CELLS", 16 * 200)
    sent = []
    compare = neighbours._compare
    monkeypatch.setattr(neighbours, "_compare", lambda q, *more: sent.append(q.count()) or compare(q, *more))
    got = {}
    for r in neighbours.knn(df, 5, ["vec"], leaf_rows=16).collect():
        got.setdefault(r.row_id, {})[r["rank"]] = r.nn_id
    assert {i: [m[j + 1] for j in range(5)] for i, m in got.items()} == brute(points, np.zeros(500), 5)
    distinct = len(np.unique(points, axis=0))
    assert sum(sent) == distinct * (1 + -(-distinct // 200))  # the own leaf, then each part


def test_a_far_vector_reaches_the_leaves_within_its_radius_only():
    tree = neighbours._Tree()
    low, high = tree.split(0, 0, 0.0)
    tree.split(low, 1, 0.0)
    tree.split(high, 1, 0.0)
    points, radius = np.array([[-1.0, -2.0], [3.0, 1.0]]), np.array([1.5, np.inf])
    row, leaf, gap = neighbours._reached(tree.arrays(), points, radius)
    assert sorted(zip(row.tolist(), leaf.tolist(), gap.tolist())) == [(0, 3, 0.0), (0, 5, 1.0), (1, 3, 10.0), (1, 4, 9.0), (1, 5, 1.0), (1, 6, 0.0)]
    assert tree.join_small({3: 1, 4: 5, 5: 4, 6: 4}, 2)
    assert neighbours._descend(tree.arrays(), points).tolist() == [1, 6]


def test_vectors_with_other_codes_are_not_visited():
    """Parts are cut between codes, so a vector has a distance to the part of the next code."""
    points = np.array([[code, x / 64] for code in (0.0, 1.0, 2.0) for x in range(16)])
    tree = neighbours._Tree()
    tree.grow(0, points, 48.0, 32)
    own = neighbours._descend(tree.arrays(), points)
    row, leaf, _ = neighbours._reached(tree.arrays(), points, np.full(48, 0.2**2))
    assert sorted(zip(row.tolist(), leaf.tolist())) == list(enumerate(own.tolist()))
    values = np.array([1.0, np.nextafter(1.0, 2.0), np.inf])
    assert neighbours._between(values, 1.0) == 1.0 and neighbours._between(values, values[1]) == values[1]


def test_vectors_that_differ_in_the_sign_of_zero_are_alike(spark):
    df = spark.createDataFrame([(1, 0.0), (2, -0.0), (3, 5.0)], "row_id long, x double")
    packs = neighbours._pack(neighbours._points(df, ["x"], None, "row_id"), 3)
    assert sorted(r.ids for r in packs.collect()) == [[1, 2], [3]]


def test_cells_find_most_neighbours(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(20, 16)) * 4
    points = centres[rng.integers(0, 20, 1500)] + rng.normal(size=(1500, 16)) * 0.5
    df = spark.createDataFrame([(i, points[i].tolist()) for i in range(1500)], "row_id long, vec array<double>")
    exact = brute(points, np.zeros(1500), 5)
    got = {}
    for r in neighbours.knn(df, 5, ["vec"], leaf_rows=100, mode="cells", probes=8).collect():
        got.setdefault(r.row_id, set()).add(r.nn_id)
    recall = np.mean([len(got[i] & set(exact[i])) / 5 for i in exact])
    assert recall >= 0.9
    with pytest.raises(ValueError):
        neighbours.knn(df, 5, ["vec"], mode="other")


def test_knn_refuses_missing_values(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None)], "row_id long, x double")
    with pytest.raises(ValueError):
        neighbours.knn(df, 1, ["x"])


def test_nearest_centroid_tie_takes_the_smaller(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 9.0)], "row_id long, x double")
    centres = spark.createDataFrame([(5, 1.0), (3, -1.0)], "cluster int, x double")
    assert {r.row_id: r.cluster for r in neighbours.nearest_centroid(df, centres, ["x"]).collect()} == {1: 3, 2: 5}


@pytest.fixture(scope="module")
def classes(spark):
    rng = np.random.default_rng(8)
    label = ["a"] * 200 + ["b"] * 60 + ["c"] * 30
    rows = [(i, float(rng.normal()), float(rng.integers(0, 4)), label[i]) for i in range(290)]
    return spark.createDataFrame(rows, "row_id long, x double, code double, label string"), rows


def test_large_clusters_share_new_rows_out(spark):
    """Weights of large, wide clusters lie beyond doubles; their shares do not."""
    assert resample.cluster_shares({"a": (500_000, 1e10), "b": (500_000, 1e10)}) == {"a": 0.5, "b": 0.5}
    shares = resample.cluster_shares({"a": (5_000_000, 1e10), "b": (100, 1e10)})
    assert shares["a"] == 1.0 and 0 <= shares["b"] < 1e-9
    small = {"a": (40, 3.0), "b": (25, 9.0), "c": (7, 0.0)}
    weights = {g: resample.cluster_sparsity(*x) for g, x in small.items()}
    assert resample.cluster_shares(small) == pytest.approx({g: w / sum(weights.values()) for g, w in weights.items()}, rel=1e-12)
    assert resample.cluster_shares({"a": (9, 0.0), "b": (7, 0.0)}) == {"a": 0.5, "b": 0.5}


def test_smote_reaches_the_targets(classes):
    df, rows = classes
    raised = resample.smote(df, "label", ["x", "code"])
    assert {r.label: r.n for r in raised.groupBy("label").agg(F.count("*").alias("n")).collect()} == {"a": 200, "b": 200, "c": 200}
    assert raised.where("not is_synthetic").count() == len(rows)
    assert raised.dropDuplicates(["row_id", "copy"]).count() == 600


def test_smote_rows_lie_between_their_parents(classes):
    df, rows = classes
    near = {}
    for r in neighbours.knn(df, 5, ["x", "code"], "label").collect():
        near.setdefault(r.row_id, []).append(r.nn_id)
    at = {r[0]: (r[1], r[2]) for r in rows}
    made = resample.synthetic_only(resample.smote(df, "label", ["x", "code"], seed=5)).collect()

    def between(r, other):
        return all(
            min(a, b) - 1e-9 <= v <= max(a, b) + 1e-9 for a, b, v in zip(at[r.row_id], at[other], (r.x, r.code), strict=True)
        )

    assert made and all(any(between(r, n) for n in near[r.row_id]) for r in made)


def test_smote_minority_raises_only_the_smallest(classes):
    counts = resample.smote(classes[0], "label", ["x"], strategy="minority").groupBy("label").count().collect()
    assert {r.label: r["count"] for r in counts} == {"a": 200, "b": 60, "c": 200}


def test_smote_needs_more_rows_than_neighbours(classes):
    with pytest.raises(ValueError):
        resample.smote(classes[0], "label", ["x"], k=30)


def test_smote_of_balanced_classes_adds_nothing(classes):
    even = classes[0].where("label = 'b'")
    assert resample.smote(even, "label", ["x"]).where("is_synthetic").count() == 0


def test_many_copies_are_spread(classes, monkeypatch):
    df, _ = classes
    want = sorted((r.row_id, r.copy, r.x) for r in resample.smote(df, "label", ["x"]).collect())
    monkeypatch.setattr(resample, "COPIES_PER_STEP", 2)
    assert sorted((r.row_id, r.copy, r.x) for r in resample.smote(df, "label", ["x"]).collect()) == want


def test_smote_is_repeatable(spark, classes):
    df, _ = classes
    total = F.round(F.sum("x"), 9)
    one = resample.smote(df, "label", ["x"]).agg(total).first()[0]
    two = resample.smote(df.repartition(5, "x"), "label", ["x"], leaf_rows=16).agg(total).first()[0]
    assert one == two


def test_cluster_smote_needs_a_rich_cluster(classes):
    df = classes[0].where("label <> 'b'").withColumn("cluster", (F.col("row_id") % 2).cast("int"))
    with pytest.raises(ValueError):
        resample.cluster_smote(df, "cluster", "label", ["x"])
    raised = resample.cluster_smote(df, "cluster", "label", ["x"], balance_threshold=0.05)
    assert raised.where("is_synthetic").count() in (170, 171)


def test_undersample(classes):
    kept = resample.undersample(classes[0], "label").groupBy("label").count().collect()
    assert {r["count"] for r in kept} == {30} and len(kept) == 3


def test_duplicate_extremes(spark):
    df = spark.createDataFrame([(i, i / 10) for i in range(10)], "row_id long, prob double")
    rows = resample.duplicate_extremes(df, 2, renumber=True).collect()
    assert sorted(r.row_id for r in rows) == sorted([i * 3 for i in range(10)] + [25, 28, 2, 5])


@pytest.mark.parametrize("clustered", [False, True])
def test_given_rows_are_made_once(spark, clustered):
    """Before, counts, members and originals each made the rows anew."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def label(i):
        made.add(1)
        return int(i % 4 == 0)

    rows = spark.range(400).select(F.col("id").alias("row_id"), (F.col("id") % 50).cast("double").alias("x"), F.lit(0).alias("cluster"), label("id").alias("label"))
    raise_class = resample.cluster_smote if clustered else resample.smote
    out = raise_class(rows, "cluster", "label", ["x"], balance_threshold=0.2) if clustered else raise_class(rows, "label", ["x"])
    assert out.where("label = 1").count() == 300 and made.value == 400
