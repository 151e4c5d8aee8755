"""Optimal binning: the dynamic program against all subsets of cuts, fitted bins against plain counts."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tabloop.operators import binning


def exhaustive(events, nonevents, most_bins, least_share, trend, missing=(0, 0)):
    """Every subset of the inner cuts."""
    size, total = len(events), sum(events) + sum(nonevents) + sum(missing)
    best = ((-1, 0, ()), [size])
    for count in range(min(most_bins, size)):
        for inner in itertools.combinations(range(1, size), count):
            ends, begin, rates, fine = [*inner, size], 0, [], True
            for end in ends:
                e, n = sum(events[begin:end]), sum(nonevents[begin:end])
                fine = fine and e > 0 and n > 0 and e + n >= least_share * total
                rates.append(e / (e + n) if e + n else 0)
                begin = end
            pairs = list(zip(rates, rates[1:]))
            up, down = all(a <= b for a, b in pairs), all(a >= b for a, b in pairs)
            if fine and {"ascending": up, "descending": down, "auto": up or down, None: True}[trend]:
                value = binning.total_information(events, nonevents, ends, missing)
                key = (round(value, 12), -len(ends), tuple(-c for c in ends))
                if key > best[0]:
                    best = (key, ends)
    return best[1]


@pytest.mark.parametrize("trend", ["ascending", "descending", "auto", None])
def test_program_equals_exhaustive_search(trend):
    draw = random.Random(7)
    for trial in range(60):
        size = draw.randrange(1, 10)
        events = [draw.choice([0, 0, 1, 5, 20, 60]) for _ in range(size)]
        nonevents = [draw.choice([0, 1, 5, 20, 60]) for _ in range(size)]
        most, share = draw.choice([2, 3, 8]), draw.choice([0.0, 0.05, 0.2])
        missing = draw.choice([(0, 0), (7, 3)])
        got = binning.best_cuts(events, nonevents, most, share, trend, missing)
        want = exhaustive(events, nonevents, most, share, trend, missing)
        value = lambda ends: round(binning.total_information(events, nonevents, ends, missing), 12)
        assert (value(got), len(got)) == (value(want), len(want)), (trial, events, nonevents, most, share)
        if trend != "auto" and sum(events) + missing[0] and sum(nonevents) + missing[1]:
            assert got == want


def table(spark, rows=4000):
    draw = random.Random(1)
    out = []
    for i in range(rows):
        x = draw.choice([None, math.nan, round(draw.gauss(0, 1), 1)]) if i % 9 == 0 else round(draw.gauss(0, 1), 1)
        c = draw.choice(["a", "b", "c", "d", "e", None]) if i % 50 else f"rare{i}"
        chance = 0.2 + 0.1 * max(-2, min(3, x if x is not None and x == x else 0)) + (0.3 if c in ("b", "d") else 0)
        out.append((i, x, c, None if i % 101 == 0 else int(draw.random() < chance)))
    return spark.createDataFrame(out, "row_id int, x double, c string, label int")


def test_fitted_bins_count_every_row_and_follow_the_trend(spark):
    df = table(spark).cache()
    bins = binning.fit(df, ["c"], ["x"], fine_bins=8).cache()
    rows = df.where("label is not null").collect()
    given = {r.row_id: r for r in binning.assign(df, bins, ["x", "c"]).collect()}
    for col in ("x", "c"):
        fitted = [r for r in bins.collect() if r.col == col]
        assert sum(r.events + r.nonevents for r in fitted) == len(rows)
        events, nonevents = sum(r.events for r in fitted), sum(r.nonevents for r in fitted)
        for r in fitted:
            inside = [x for x in rows if given[x.row_id][f"{col}_bin"] == r.bin]
            assert (sum(x.label for x in inside), sum(1 - x.label for x in inside)) == (r.events, r.nonevents)
            assert (r.woe, r.iv) == pytest.approx(binning.information(r.events, r.nonevents, events, nonevents))
            assert r.bin == -1 or r.events + r.nonevents >= 0.05 * len(rows)
        rates = [r.events / (r.events + r.nonevents) for r in sorted(fitted, key=lambda r: r.bin) if r.bin >= 0]
        assert len(rates) > 2 and rates == sorted(rates)
    rest = [r for r in bins.collect() if r.rest]
    assert len(rest) == 1 and rest[0].col == "c"
    assert given[50].c_bin == rest[0].bin  # rare50


def test_apply_gives_weights_and_keeps_other_columns(spark):
    df = table(spark, 1500)
    bins = binning.fit(df, ["c"], ["x"], fine_bins=8)
    out = binning.apply(df, bins, ["x", "c"], missing=-9.0)
    assert out.columns == df.columns and out.count() == 1500
    weights = {(r.col, r.bin): r.woe for r in bins.collect()}
    given = {r.row_id: r for r in binning.assign(df, bins, ["x", "c"]).collect()}
    for r in out.collect():
        for col in ("x", "c"):
            want = weights.get((col, given[r.row_id][f"{col}_bin"]))
            assert r[col] == pytest.approx(-9.0 if want is None else want)
    unseen = spark.createDataFrame([(1, 5.0, "never")], "row_id int, x double, c string")
    some = binning.fit(df.where("c in ('a', 'b')"), ["c"], [])
    assert binning.apply(unseen, some, ["c"], missing=-9.0).first().c == -9.0


def test_one_label_one_value_and_empty_tables_have_one_bin(spark):
    schema = "x double, c string, label int"
    for rows in ([(1.0, "a", 1), (2.0, "b", 1)], [(1.0, "a", 1), (1.0, "a", 0)]):
        bins = binning.fit(spark.createDataFrame(rows, schema), ["c"], ["x"]).collect()
        assert [(r.col, r.bin) for r in bins] == [("x", 0), ("c", 0)] and sum(r.events + r.nonevents for r in bins) == 4
    empty = spark.createDataFrame([], schema)
    assert binning.fit(empty, ["c"], ["x"]).collect() == []
    nulls = binning.fit(spark.createDataFrame([(None, None, 1), (None, None, 0)], schema), ["c"], ["x"])
    assert [(r.col, r.bin, r.iv) for r in nulls.collect()] == [("x", -1, 0.0), ("c", -1, 0.0)]
    assert binning.assign(empty, nulls, ["x"]).collect() == []
    with pytest.raises(ValueError):
        binning.fit(empty, [], [])


def test_given_trends_per_column(spark):
    df = table(spark, 2000).withColumn("y", -F.col("x"))
    bins = binning.fit(df, [], ["x", "y"], trend={"x": "descending", "y": "descending"}, fine_bins=16).collect()
    assert len([r for r in bins if r.col == "y" and r.bin >= 0]) > 1
    rates = [r.events / (r.events + r.nonevents) for r in bins if r.col == "x" and r.bin >= 0]
    assert rates == sorted(rates, reverse=True)
