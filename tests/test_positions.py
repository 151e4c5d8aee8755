"""Ranks, prefixes, samples, splits and folds."""

import random

import pytest
from pyspark.sql import functions as F

from tabloop.operators import ordering
from tabloop.operators.ranks import exact_quantiles, nth_values


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(5)
    rows = []
    for i in range(4000):
        tied = rng.random() < 0.35
        rows.append((i, 0.5 if tied else rng.random(), None if rng.random() < 0.1 else rng.randint(-9, 9), f"k{i % 7}"))
    return spark.createDataFrame(rows, "row_id long, prob double, v int, name string"), rows


@pytest.mark.parametrize("bracket_rows", [10, 300, 100_000])
def test_nth_values_are_exact(numbers, bracket_rows):
    df, rows = numbers
    probs, ints = sorted(r[1] for r in rows), sorted(r[2] for r in rows if r[2] is not None)
    ranks = {"p": [1, 7, 2000, 2500, 4000], "v": [1, 100, len(ints)]}
    got = nth_values(df, {"p": F.col("prob"), "v": F.col("v")}, ranks, bracket_rows=bracket_rows)
    for name, values in (("p", probs), ("v", ints)):
        for rank in ranks[name]:
            at = got[(name, rank)]
            assert at.value == values[rank - 1]
            assert at.below == sum(x < at.value for x in values)
            assert at.equal == sum(x == at.value for x in values)


def test_rank_outside_is_refused(numbers):
    with pytest.raises(ValueError):
        nth_values(numbers[0], {"p": F.col("prob")}, {"p": [4001]})


@pytest.mark.parametrize("bracket_rows", [20, 100_000])
def test_quantiles_equal_built_in(numbers, bracket_rows):
    df, _ = numbers
    got = exact_quantiles(df, {"v": F.col("v"), "p": F.col("prob")}, [0.0, 0.25, 0.5, 0.9, 1.0], bracket_rows)
    want = df.agg(F.percentile("v", [0.0, 0.25, 0.5, 0.9, 1.0]).alias("v"), F.percentile("prob", [0.0, 0.25, 0.5, 0.9, 1.0]).alias("p")).first()
    assert got["v"] == pytest.approx(want.v) and got["p"] == pytest.approx(want.p)


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact_quantiles(df, {"x": F.col("x")}, [0.5]) == {"x": [None]}


@pytest.mark.parametrize("n", [0, 1, 1399, 1400, 3999, 4000, 9000])
def test_prefix_has_exactly_n_rows(numbers, n):
    df, rows = numbers
    head, tail = ordering.cut_n(df, n, ["-prob", "row_id"])
    want = [r[0] for r in sorted(rows, key=lambda r: (-r[1], r[0]))][:n]
    assert sorted(r.row_id for r in head.collect()) == sorted(want)
    assert head.count() + tail.count() == len(rows)


def test_missing_values_come_last(spark):
    df = spark.createDataFrame([(1, None), (2, 0.3), (3, 0.9), (4, None)], "row_id long, prob double")
    for order, want in ((["prob", "row_id"], [2, 3, 1]), (["-prob", "row_id"], [3, 2, 1])):
        assert sorted(r.row_id for r in ordering.first_n(df, 3, order).collect()) == sorted(want)


def test_order_that_ties_is_refused(numbers):
    with pytest.raises(ValueError):
        ordering.first_n(numbers[0], 1300, ["-prob"]).count()


def test_text_order_is_refused(numbers):
    with pytest.raises(TypeError):
        ordering.first_n(numbers[0], 3, ["name"])


def test_split_is_a_partition(numbers):
    df, rows = numbers
    parts = ordering.split(df, 0.1)
    counts = {r.split: r["count"] for r in parts.groupBy("split").count().collect()}
    assert counts == {"test": 400, "train": 3600}
    again = {r.row_id for r in ordering.split(df.repartition(3), 0.1).where("split = 'test'").collect()}
    assert again == {r.row_id for r in parts.where("split = 'test'").collect()}


def test_split_rounds_the_test_part_up(spark):
    assert ordering.split(spark.range(11).withColumnRenamed("id", "row_id"), 0.1).where("split = 'test'").count() == 2


def test_folds_cover_every_row_once(numbers):
    folds = {r.row_id: r.fold for r in ordering.assign_folds(numbers[0], 3).collect()}
    assert [folds[i] for i in (0, 1332, 1333, 2665, 2666, 3999)] == [0, 0, 1, 1, 2, 2]
    train, test = ordering.fold_split(ordering.assign_folds(numbers[0], 3), 1)
    assert train.count() + test.count() == 4000 and test.count() == 1333


def test_sample_needs_enough_rows(numbers):
    assert ordering.sample_exact(numbers[0], 123).count() == 123
    with pytest.raises(ValueError):
        ordering.sample_exact(numbers[0], 4001)


def test_random_cut_lies_in_the_upper_half(numbers):
    head, tail = ordering.random_cut(numbers[0], ["prob", "row_id"], seed=9)
    assert 2000 <= head.count() < 4000 and head.count() + tail.count() == 4000


def test_top_confidence(numbers, monkeypatch):
    df, rows = numbers
    want = {r[0] for r in sorted(rows, key=lambda r: (-r[1], r[0]))[:25]}
    assert {r.row_id for r in ordering.top_confidence(df, 25).collect()} == want
    monkeypatch.setattr(ordering, "TAKE_ROWS", 10)
    assert {r.row_id for r in ordering.top_confidence(df, 25).collect()} == want


def test_number_rows(spark):
    df = spark.createDataFrame([(f"n{i % 5}", i) for i in range(500)], "name string, i int").repartition(7)
    rows = ordering.number_rows(df, ["name", "i"]).collect()
    want = {pair: n for n, pair in enumerate(sorted((f"n{i % 5}", i) for i in range(500)))}
    assert {(r.name, r.i): r.row_id for r in rows} == want


def test_prefix_by_group(numbers):
    df, rows = numbers
    sizes = {f"k{i}": sum(r[3] == f"k{i}" for r in rows) for i in range(7)}
    ns = {"k0": 0, "k1": 5, "k2": 200, "k3": sizes["k3"], "k4": 17, "k5": 1, "k6": 9999}
    kept = df.where(ordering.prefix_by_group(df, "name", ns, sizes, ["-prob", "row_id"])).collect()
    for name, n in ns.items():
        want = [r[0] for r in sorted((r for r in rows if r[3] == name), key=lambda r: (-r[1], r[0]))][:n]
        assert sorted(r.row_id for r in kept if r.name == name) == sorted(want)


@pytest.mark.parametrize("partitions", ["1", "8", "64"])
def test_results_do_not_depend_on_shuffle_partitions(spark, numbers, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        kept = ordering.sample_exact(numbers[0], 500, seed=3)
        assert kept.agg(F.sum("row_id")).first()[0] == ordering.sample_exact(numbers[0].repartition(5), 500, seed=3).agg(F.sum("row_id")).first()[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
