"""Relabelling rules, metrics and reports on hand tables."""

import pytest
from pyspark.sql import functions as F

from tabloop.operators import evaluate, relabel
from tabloop.operators.columns import mispredictions


def scored(spark, rows):
    return spark.createDataFrame(rows, "row_id long, label_model int, prob double")


def by_id(df, col="label_model"):
    return {r.row_id: r[col] for r in df.collect()}


def test_consensus_rules(spark):
    tables = [
        scored(spark, [(1, 1, 0.95), (2, 1, 0.95), (3, 0, 0.99), (4, 1, 0.99), (5, 0, 0.9)]),
        scored(spark, [(1, 1, 0.93), (2, 0, 0.95), (3, 0, 0.9), (4, 1, 0.89), (5, 0, 0.9)]),
        scored(spark, [(1, 1, 0.97), (2, 1, 0.95), (3, 0, 0.9), (4, 1, 0.95), (5, 0, 0.9)]),
        scored(spark, [(1, 1, 0.95), (2, 1, 0.95), (3, 0, 0.9), (4, 1, 0.95), (5, 0, 0.9)]),
    ]
    out = relabel.consensus(tables)
    # 2: labels differ; 3: first model 0.0675 above the mean; 4: one below 0.9
    assert by_id(out) == {1: 1, 2: 0, 3: 1, 4: 0, 5: 0}
    assert by_id(out, "prob")[1] == pytest.approx(0.95)


@pytest.mark.parametrize("second", [[(1, 1, 0.95)], [(1, 1, 0.95), (2, 1, 0.95), (2, 1, 0.95)], [(1, 1, 0.95), (3, 1, 0.95)]])
def test_consensus_refuses_repeated_and_missing_rows(spark, second):
    tables = [scored(spark, [(1, 1, 0.95), (2, 1, 0.95)]), scored(spark, second)]
    with pytest.raises(Exception, match="not once in every table"):
        relabel.consensus(tables).collect()


def test_consensus_takes_no_missing_label_for_agreement(spark):
    kinds = "row_id long, label_model int, prob double"
    first = spark.createDataFrame([(1, 1, 0.95)], kinds)
    assert by_id(relabel.consensus([first, spark.createDataFrame([(1, None, 0.95)], kinds)])) == {1: 0}


def test_consensus_flips_other_classes_to_one(spark):
    tables = [scored(spark, [(1, 2, 0.5)])] * 2
    assert by_id(relabel.consensus(tables)) == {1: 1}


def test_consensus_keeps_features_of_the_first_table(spark):
    first = scored(spark, [(1, 1, 0.95)]).withColumn("name", F.lit("x")).withColumn("empty", F.lit(None).cast("double"))
    row = relabel.consensus([first, scored(spark, [(1, 1, 0.95)])]).first()
    assert (row.name, row.empty, row.label_model) == ("x", None, 1)


def test_flips(spark):
    df = scored(spark, [(1, 1, 0.5), (2, 0, 0.5), (3, 1, 0.9), (4, 0, 0.95), (5, 2, 0.1)])
    assert by_id(relabel.flip_low(df)) == {1: 1, 2: 1, 3: 1, 4: 0, 5: 2}
    assert by_id(relabel.flip_low(df, mode="swap")) == {1: 0, 2: 1, 3: 1, 4: 0, 5: 2}
    twice = relabel.flip_low(relabel.flip_low(df, mode="swap"), mode="swap")
    assert by_id(twice) == by_id(df)
    assert by_id(relabel.gate_positive(df, 0.6)) == {1: 0, 2: 0, 3: 1, 4: 0, 5: 2}
    with pytest.raises(ValueError):
        relabel.flip_low(df, mode="other")


def test_replace_low_confidence(spark):
    df = scored(spark, [(1, 1, 0.7), (2, 1, 0.71), (3, 1, None), (4, 1, 0.1)])
    other = scored(spark, [(1, 0, 1.0), (2, 0, 1.0), (3, 0, 1.0)])
    assert by_id(relabel.replace_low_confidence(df, other)) == {1: 0, 2: 1, 3: 1, 4: 1}


def test_rows_not_in_keeps_repeats_and_never_matches_missing(spark):
    schema = "a int, b string"
    a = spark.createDataFrame([(1, "x")] * 3 + [(2, None)] * 2 + [(3, "z")], schema)
    b = spark.createDataFrame([(3, "z"), (2, None), (3, "z")], schema)
    assert sorted((r.a, r.b or "") for r in relabel.rows_not_in(a, b).collect()) == [(1, "x")] * 3 + [(2, "")] * 2


def test_rows_not_in_writes_many_copies(spark):
    a = spark.range(250_001).select(F.lit(7).alias("a"))
    b = spark.createDataFrame([(8,)], "a int")
    assert relabel.rows_not_in(a, b).count() == 250_001


def test_merge_drops_rows_at_the_threshold(spark):
    schema = "f int, label_model int, prob double"
    old = spark.createDataFrame([(1, 0, 0.5), (1, 0, 0.5), (2, 1, 0.9), (3, 1, 0.99)], schema)
    new = spark.createDataFrame([(1, 0, 0.5), (4, 1, 0.6), (5, 0, 0.9), (6, 0, 0.95)], schema)
    merged = sorted(tuple(r) for r in relabel.merge_corrected(old, new).collect())
    assert merged == [(1, 0, 0.5), (4, 0, 0.6), (6, 0, 0.95)]


def test_matches_use_the_last_label_and_missing_equals_missing(spark):
    labelled = spark.createDataFrame([(1, "a", None, 0), (2, "a", None, 1), (3, "b", 1, 0)], "row_id long, x string, y int, label int")
    asked = spark.createDataFrame([("a", None), ("a", None), ("c", 1)], "x string, y int")
    assert relabel.labelled_match_count(asked, labelled, ["x", "y"]).first().n == 1
    assert [tuple(r) for r in relabel.labelled_matches(asked, labelled, ["x", "y"]).collect()] == [("a", None, 1)]


def test_vote_ties_and_empty_clusters(spark):
    labelled = spark.createDataFrame([(0, 3), (0, 1), (1, 2), (1, 2), (1, 5)], "cluster int, label int")
    votes = relabel.vote(labelled)
    assert {r.cluster: r.label for r in votes.collect()} == {0: 1, 1: 2}
    captured = spark.createDataFrame([(10, 0), (11, 1), (12, 7)], "row_id long, cluster int")
    out = relabel.propagate_assigned(captured, votes)
    assert by_id(out) == {10: 1, 11: 2, 12: 0} and set(by_id(out, "prob").values()) == {0.8}
    means = {r.cluster: r.label for r in relabel.vote(labelled, ml_type="regression").collect()}
    assert means == {0: 2.0, 1: 3.0}


def test_propagation_keeps_the_first_rows(spark):
    labelled = spark.createDataFrame([(i, float(i % 2 * 100 + i % 5), i % 2) for i in range(40)], "row_id long, x double, label int")
    captured = spark.createDataFrame([(100 + i, float(i % 2 * 100), 1 - i % 2, 0.6) for i in range(20)], "row_id long, x double, label_model int, prob double")
    out = relabel.propagate(labelled, captured, ["x"], k=2, keep_first=4)
    got = by_id(out)
    assert all(got[100 + i] == 1 - i % 2 for i in range(4)) and all(got[100 + i] == i % 2 for i in range(4, 20))


def test_metrics_without_cases_are_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    row = evaluate.binary_metrics(df).first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (1.0, 0.0, 0.0, 0.0)


def test_metrics_by_hand(spark):
    pairs = [(1, 1)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(0, 0)] * 4
    df = spark.createDataFrame(pairs, "label int, prediction int")
    row = evaluate.binary_metrics(df).first()
    assert (row.accuracy, row.precision, row.recall) == pytest.approx((0.7, 0.6, 0.75))
    assert row.f1 == pytest.approx(2 * 0.6 * 0.75 / 1.35)
    assert evaluate.hard_auc(df).first().auc == pytest.approx((0.75 + 4 / 6) / 2)
    micro = evaluate.micro_metrics(df).first()
    assert micro.accuracy == micro.f1 == pytest.approx(0.7)
    assert mispredictions(df).count() == 3


def test_score_auc_with_ties(spark):
    rows = [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1), (1, 0.5), (0, 0.7)]
    pairs = [(p > q) + 0.5 * (p == q) for y, p in rows if y for z, q in rows if not z]
    got = evaluate.score_auc(spark.createDataFrame(rows, "label int, score double")).first().auc
    assert got == pytest.approx(sum(pairs) / len(pairs))


def test_too_many_classes_are_refused(spark, monkeypatch):
    monkeypatch.setattr(evaluate, "MAX_CLASSES", 5)
    with pytest.raises(ValueError):
        evaluate.collect_counts(spark.range(9), "id")


def test_confidence_report_counts_rows_at_the_limits(spark):
    df = scored(spark, [(1, 1, 0.8), (2, 0, 0.6), (3, 1, 0.6), (4, 1, 0.4)])
    row = evaluate.confidence_report(df).first()
    assert (row.below_08, row.upto_06, row.upto_06_label_1, row.below_05) == (0.75, 0.75, 0.5, 0.25)
