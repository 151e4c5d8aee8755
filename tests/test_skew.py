"""Joins to one row per key, by every path."""

import pytest
from pyspark.sql import functions as F

from tabloop.operators import skew


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("small", [True, False])
def test_hot_keys(spark, monkeypatch, how, small):
    calls = []

    def fits(df):
        calls.append(df)
        return small and len(calls) > 1  # the right side itself is not; hot keys and their rows may be

    monkeypatch.setattr(skew, "fits_broadcast", fits)
    left = spark.range(500).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id")).alias("k"), "id"
    )
    right = spark.createDataFrame([(i, f"v{i}") for i in range(0, 500, 2)], "k long, v string")
    got = skew.lookup_join(left, right, ["k"], how, hot_rows=20)
    expected = left.join(right, ["k"], how)
    assert sorted(got.select("k", "id", "v").collect(), key=repr) == sorted(expected.select("k", "id", "v").collect(), key=repr)
    assert len(calls) == 3
