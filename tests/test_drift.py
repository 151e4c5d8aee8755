"""Drift scores against direct computation."""

import math
import random

import pytest

from tabloop.operators import drift


def js(p, q):
    keys = set(p) | set(q)
    total = 0.0
    for k in keys:
        a, b = p.get(k, 0), q.get(k, 0)
        m = (a + b) / 2
        total += (a * math.log(a / m) if a else 0) + (b * math.log(b / m) if b else 0)
    return math.sqrt(total / 2)


def shares(values):
    return {v: values.count(v) / len(values) for v in set(values)}


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(1)
    a = [(rng.choice("xxxyz"), round(rng.gauss(0, 1), 1)) for _ in range(700)]
    b = [(rng.choice("xyyw"), round(rng.gauss(0.3, 2), 1)) for _ in range(400)]
    schema = "c string, v double"
    return spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), a, b


def ecdf(values, x):
    return sum(v <= x for v in values) / len(values)


def test_categorical_scores(sides):
    ref, cur, a, b = sides
    row = drift.column_drift(ref, cur, ["c"]).first()
    p, q = shares([r[0] for r in a]), shares([r[0] for r in b])
    assert row.score == pytest.approx(js(p, q)) and row.is_drift == 1
    same = drift.column_drift(ref, ref, ["c"]).first()
    assert same.score == pytest.approx(0) and same.is_drift == 0
    floor = 1e-4
    want = sum((max(q.get(k, 0), floor) - max(p.get(k, 0), floor)) * math.log(max(q.get(k, 0), floor) / max(p.get(k, 0), floor)) for k in set(p) | set(q))
    assert drift.column_drift(ref, cur, ["c"], "psi").first().score == pytest.approx(want)


@pytest.mark.parametrize("window_rows", [5, 100_000])
def test_numeric_scores(sides, window_rows):
    ref, cur, a, b = sides
    x, y = [r[1] for r in a], [r[1] for r in b]
    points = sorted(set(x) | set(y))
    gaps = [abs(ecdf(x, p) - ecdf(y, p)) for p in points]
    mean = sum(x) / len(x)
    spread = math.sqrt(sum((v - mean) ** 2 for v in x) / len(x))
    area = sum(g * (n - p) for g, p, n in zip(gaps, points, points[1:]))
    assert drift.wasserstein(ref, cur, "v", window_rows).first().score == pytest.approx(area / spread)
    assert drift.ks(ref, cur, "v", window_rows).first().score == pytest.approx(max(gaps))


def test_scores_apart(spark):
    ref, cur = (spark.createDataFrame([(c,)] * 5, "c string") for c in "ab")
    assert drift.column_drift(ref, cur, ["c"]).first().score == pytest.approx(math.sqrt(math.log(2)))


def test_unknown_method_is_refused(sides):
    with pytest.raises(ValueError):
        drift.column_drift(sides[0], sides[1], ["c"], "other")


def test_drift_per_key(spark):
    reference = ["x"] * 6 + ["y"] * 3 + ["z"]
    fitted = drift.fit_distribution(spark.createDataFrame([(v,) for v in reference], "feature3 string"), ["feature3"])
    requests = {"a": ["x", "x", "y"], "b": ["w"], "c": ["x", None], "d": [None]}
    df = spark.createDataFrame([(k, v) for k, vs in requests.items() for v in vs], "id string, feature3 string")
    got = {r.id: r.score for r in drift.drift_per_key(fitted, df).collect()}
    p = shares(reference)
    for k in "abc":
        assert got[k] == pytest.approx(js(p, shares([v for v in requests[k] if v])))
    assert got["d"] == pytest.approx(math.sqrt(math.log(2)))
    assert drift.drift_rate(drift.drift_per_key(fitted, df)).first().rate == 1.0


def test_share_of_drifted_columns(sides):
    row = drift.dataset_drift(drift.column_drift(sides[0], sides[1], ["c", "v"])).first()
    assert (row.n, row.share) == (2, 1.0)


def test_threshold_is_strict(spark):
    scores = spark.createDataFrame([(0.1,), (0.1000001,)], "score double")
    assert sorted(r.is_drift for r in drift.verdict(scores).collect()) == [0, 1]


def test_reference_sample_needs_rows(spark):
    with pytest.raises(ValueError):
        drift.reference_sample(spark.range(10).withColumnRenamed("id", "row_id"))


def test_rows_without_a_key_are_one_request(spark):
    rows = [(None, "a"), (None, "b"), ("x", "a"), ("x", "b"), ("y", None)]
    df = spark.createDataFrame(rows, "id string, feature3 string")
    fitted = drift.fit_distribution(df.where("id = 'x'"), ["feature3"])
    got = {r.id: (round(r.score, 9), r.is_drift) for r in drift.drift_per_key(fitted, df).collect()}
    assert got[None] == (0.0, 0) and got["x"] == (0.0, 0) and got["y"][1] == 1 and len(got) == 3
