"""Codes, labels, one-hot, fills, scales and weight of evidence on hand tables."""

import math

import pytest
from pyspark.sql import functions as F

from tabloop.config import ProblemConfig
from tabloop.operators import columns as C
from tabloop.operators import encode, skew, stats, woe


@pytest.fixture(scope="module")
def small(spark):
    rows = [
        (1, "b", 10, 1.0, None, 1),
        (2, "a", 2, 2.0, None, 0),
        (3, None, 10, None, None, 0),
        (4, "a", None, 4.0, None, 1),
        (5, "c", 3, 100.0, None, 0),
    ]
    return spark.createDataFrame(rows, "row_id long, c string, n int, x double, empty string, label int")


def codes(df, *cols):
    return {r.row_id: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.mark.parametrize("sorted_limit", [1, 1000])
def test_index_sorts_numbers_as_numbers(small, sorted_limit):
    index = encode.fit_category_index(small, ["c", "n", "empty"], sorted_limit)
    got = {(r.col, r.category): r.code for r in index.collect()}
    assert got == {("c", "a"): 0, ("c", "b"): 1, ("c", "c"): 2, ("n", "2"): 0, ("n", "3"): 1, ("n", "10"): 2}


@pytest.mark.parametrize("literal_limit", [0, 64])
def test_unseen_and_missing_get_minus_one(spark, small, literal_limit):
    index = encode.fit_category_index(small, ["c", "n"])
    other = spark.createDataFrame([(1, "a", 10), (2, "z", 4), (3, None, None)], "row_id long, c string, n int")
    coded = encode.apply_codes(other, index, ["c", "n"], literal_limit=literal_limit)
    assert codes(coded, "c", "n") == {1: (0, 2), 2: (-1, -1), 3: (-1, -1)}
    assert coded.columns == other.columns


def test_all_null_column_codes_to_minus_one(small):
    index = encode.fit_category_index(small, ["empty", "c"])
    assert set(codes(encode.apply_codes(small, index, ["empty"]), "empty").values()) == {(-1,)}


def test_labels_round_trip_and_refuse_unseen(spark, small, monkeypatch):
    labels = encode.fit_labels(small.where("c is not null"), "c")
    known = small.where("c is not null").select("row_id", "c")
    for limit in (64, 1):
        monkeypatch.setattr(encode, "LITERAL_CATEGORIES", limit)
        coded = encode.encode_labels(known, labels, "c")
        assert codes(coded, "c") == {1: (1,), 2: (0,), 4: (0,), 5: (2,)}
        assert codes(encode.decode_labels(coded, labels, "c"), "c") == codes(known, "c")
        with pytest.raises(Exception, match="not seen"):
            encode.encode_labels(spark.createDataFrame([(1, "q")], "row_id long, c string"), labels, "c").collect()


def test_one_hot_is_the_same_on_every_table(spark, small):
    fitted = encode.fit_one_hot(small, ["c"])
    other = spark.createDataFrame([(9, "c"), (8, "new"), (7, None)], "row_id long, c string")
    wide = encode.apply_one_hot(other, fitted, ["c"])
    assert wide.columns == ["row_id", "c_b", "c_c"]
    assert codes(wide, "c_b", "c_c") == {9: (0, 1), 8: (0, 0), 7: (0, 0)}
    assert encode.apply_one_hot(other, fitted, ["c"], drop_first=False).columns == ["row_id", "c_a", "c_b", "c_c"]
    with pytest.raises(ValueError):
        encode.apply_one_hot(other, fitted, ["c"], max_columns=2)


def test_imputer(small):
    fills = stats.fit_imputer(small, ["c", "n", "empty"], ["x"])
    filled = codes(stats.apply_imputer(small, fills), "c", "n", "x", "empty")
    assert filled[3] == ("a", 10, 26.75, None)
    assert filled[4][1] == 10


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "c string")
    assert stats.fit_mode(df, ["c"]).first().value == "a"


@pytest.mark.parametrize("exact", [True, False])
def test_zero_range_divides_by_one(spark, exact):
    df = spark.createDataFrame([(i, 7.0, float(i)) for i in range(9)], "row_id long, flat double, x double")
    scaled = stats.apply_robust(df, stats.fit_robust(df, ["flat", "x"], exact), centering=True)
    assert codes(scaled, "flat", "x")[8] == (0.0, 1.0)


def test_scale_of_an_empty_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "row_id long, x double")
    assert codes(stats.apply_robust(df, stats.fit_robust(df, ["x"])), "x") == {1: (None,), 2: (None,)}


def test_woe_by_hand(spark):
    rows = [(i, "a" if i < 6 else "b", 1 if i in (0, 6, 7, 8) else 0) for i in range(10)]
    df = spark.createDataFrame(rows, "row_id long, c string, label int")
    fitted = {r.bin: r for r in woe.fit_woe(df, ["c"]).collect()}
    assert fitted["a"].events == 1 and fitted["a"].nonevents == 5
    assert fitted["a"].woe == pytest.approx(math.log((5 / 6) / (1 / 4)))
    coded = woe.apply_woe(spark.createDataFrame([(1, "a"), (2, "zz"), (3, None)], "row_id long, c string"), woe.fit_woe(df, ["c"]), ["c"])
    got = codes(coded, "c")
    assert got[1][0] == math.trunc(fitted["a"].woe * 1e8) / 1e8 and got[2] == got[3] == (0.0,)


def test_woe_bin_without_events_is_finite(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "a", 0), (3, "b", 1), (4, "b", 0)], "row_id long, c string, label int")
    assert all(math.isfinite(r.woe) for r in woe.fit_woe(df, ["c"]).collect())
    joined = woe.apply_woe(df, woe.fit_woe(df, ["c"]), ["c"], literal_limit=0)
    assert codes(joined, "c") == codes(woe.apply_woe(df, woe.fit_woe(df, ["c"]), ["c"]), "c")


def test_hot_keys_join_like_any_other(spark, monkeypatch):
    rows = [(i, None if i % 10 == 0 else "hot" if i % 3 == 0 else f"k{i}") for i in range(600)]
    left = spark.createDataFrame(rows, "row_id long, k string")
    right = spark.createDataFrame([(f"k{i}", i) for i in range(0, 600, 2)] + [("hot", -5)], "k string, v int")
    want = {r.row_id: (r.k, r.v) for r in left.join(right, "k", "left").collect()}
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: False)
    for hot_rows in (50, 10_000):
        got = skew.lookup_join(left, right, ["k"], hot_rows=hot_rows)
        assert {r.row_id: (r.k, r.v) for r in got.collect()} == want and got.count() == 600
    inner = skew.lookup_join(left, right, ["k"], "inner", hot_rows=50)
    assert inner.count() == sum(v is not None for _, v in want.values())


def test_columns(spark, small):
    assert C.standardize_names(spark.createDataFrame([(1, 2)], ["My Name", "B"])).columns == ["my_name", "b"]
    assert C.mask_value(small, "gone", "a", "z") is small and C.mask_value(small, "c", None, "z") is small
    with pytest.raises(ValueError):
        C.drop_columns(small, ["gone"], strict=True)
    with pytest.raises(ValueError):
        C.select_features(small, ["c", "gone"])
    assert C.drop_columns(small, ["gone"]).columns == small.columns
    edge = spark.createDataFrame([(1, 0.9), (2, 0.95), (3, 0.1)], "row_id long, prob double")
    assert C.by_confidence(edge, low=0.9).count() == 1 and C.by_confidence(edge, high=0.9).count() == 1
    assert C.by_confidence(edge, high=0.9, closed="high").count() == 2
    cut = C.truncate_columns(spark.createDataFrame([(-1.239,), (1.239,)], "x double"), ["x"], 2)
    assert sorted(r.x for r in cut.collect()) == [-1.23, 1.23]


def test_pairing_refuses_unequal_keys(spark):
    x = spark.createDataFrame([(1, 5), (2, 6)], "row_id long, f int")
    y = spark.createDataFrame([(1, 0), (3, 1)], "row_id long, label int")
    with pytest.raises(ValueError):
        C.pair(x, y)
    assert C.pair(x, y.withColumn("row_id", F.when(F.col("row_id") == 3, 2).otherwise(F.col("row_id")))).count() == 2


def test_configuration_file(spark, tmp_path):
    path = tmp_path / "features.json"
    path.write_text('{"target_column": "y", "category_columns": ["a"],\n "numeric_columns": ["b"], "ml_type": "classification"}')
    cfg = ProblemConfig.load(spark, str(path), "phase-1", "prob-1")
    assert (cfg.target, cfg.categorical, cfg.numerical, cfg.test_size, cfg.seed) == ("y", ("a",), ("b",), 0.1, 1242)
    assert [f.name for f in cfg.schema().fields] == ["row_id", "a", "b", "y"]
    with pytest.raises(ValueError):
        ProblemConfig("p", "q", categorical=("a",), features=("b",))
