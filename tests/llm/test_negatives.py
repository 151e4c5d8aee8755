"""Hard negatives against brute force; intervals hold and filter."""

import math

import numpy as np
from pyspark.sql import functions as F

from tabloop.llm import negatives, queries


def brute(rows, positives=5, others=10, low=30, high=90, scale=256):
    """rows: (id, components, label, anchor), a row is its place."""
    usable = [
        (i, v, [math.floor(scale * float(x)) for x in c], label)
        for i, (v, c, label, _) in enumerate(rows)
        if label is not None and c and all(x is not None and math.isfinite(x) and math.isfinite(scale * x) for x in c)
    ]
    first = lambda s: (-s[0], -(2**63) if s[1] is None else s[1], s[2])
    out = []
    for i, v, x, label in usable:
        if not rows[i][3]:
            continue
        scores = [
            (max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(x, y)))), w, j, m)
            for j, w, y, m in usable
            if j != i and len(x) == len(y)
        ]
        for p, w, _, _ in sorted((s for s in scores if s[3] == label), key=first)[:positives]:
            hard = [s for s in scores if s[3] != label and low * p <= 100 * s[0] <= high * p]
            out += [(v, w, k + 1, s[1], p, s[0]) for k, s in enumerate(sorted(hard, key=first)[:others])]
    return sorted(out, key=repr)


def found(df):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_equals_brute_force_on_the_given_table(spark):
    path = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{path}/embeddings.parquet").collect()
    rows = [
        (r.vec_id, list(r.embedding), (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.vec_id % 100 == 0)
        for r in table
    ]
    want = brute(rows)
    assert want and found(queries.QUERIES["op13_hard_negatives"](spark, path)) == want


def test_small_blocks_ties_copies_and_odd_rows(spark):
    draw = np.random.default_rng(5)
    rows = [(i, draw.normal(size=6).round(1).tolist(), int(draw.integers(0, 3)), i % 4 == 0) for i in range(80)]
    rows += [(200 + i, rows[8][1], i % 2, i == 3) for i in range(40)]  # copies in two labels
    rows += [(8, rows[8][1], 0, True), (8, rows[8][1], 1, False), (None, rows[9][1], 1, True), (None, rows[9][1], 2, False)]
    rows += [(300, None, 1, True), (301, [], 1, True), (302, [1.0, None] * 3, 1, True), (303, [math.nan] * 6, 1, True)]
    rows += [(304, [math.inf] * 6, 1, True), (305, [1e308] * 6, 1, True), (306, rows[3][1], None, True), (307, [0.0] * 6, 1, True)]
    rows += [(400 + i, [1.0 + i, 2.0], i % 2, True) for i in range(4)]  # of another length
    schema = "vec_id bigint, embedding array<double>, label int, asked boolean"
    df = spark.createDataFrame(rows, schema).withColumn("row", F.lit(1)).withColumn("x", F.lit("a clash"))
    got = negatives.mine(df, F.col("asked"), F.col("label"), block_rows=16, tile_rows=8)
    assert found(got) == brute(rows)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_scores_beyond_doubles_stay_exact(spark):
    big = float(2**33)
    rows = [(1, [big, 1.0], 0, True), (2, [big, 3.0], 0, False), (3, [big / 2, 2.0], 1, False), (4, [big / 2, 5.0], 1, False)]
    rows += [(5, [1e200, 1e200], 0, True), (6, [1e200, 0.0], 0, False), (7, [1e-200, 0.0], 1, False)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, asked boolean")
    assert found(negatives.mine(df, F.col("asked"), F.col("label"), scale=1)) == brute(rows, scale=1)


def test_intervals_hold_and_shrink_by_stages():
    draw = np.random.default_rng(1)
    for dims in (1, 3, 64, 65, 200):
        vectors = np.floor(256 * draw.normal(size=(300, dims)))
        codes, aligned, rest = negatives.coded(vectors)
        asked = negatives.Asked(vectors[0])
        scores, widths = vectors @ vectors[0], []
        everything = np.arange(300)

        def keep(low, high):
            assert (low <= scores).all() and (scores <= high).all()
            widths.append((high - low).mean())
            return np.ones(len(low), bool)

        negatives.narrowed(asked, codes, aligned, rest, everything, keep)
        assert len(widths) == len(negatives.STAGES) and (np.diff(widths) <= 0).all()
        assert dims < 64 or widths[-1] < 0.12 * widths[0]


def test_few_pairs_are_scored_exactly(spark):
    """The filter leaves a small part of all pairs of anchors and rows of other labels."""
    table = spark.read.parquet("/root/testdata/check_s/embeddings.parquet")
    rows = table.select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "label", F.col("embedding").cast("array<double>").alias("x")
    ).withColumn("dims", F.size("x")).cache()
    codes = negatives._codes(rows, 256)
    anchors = rows.where("vec_id % 1000 = 0")
    alike = negatives._near(codes, anchors, 3, 1, 256, True, 5)
    pairs = rows.count() * anchors.count()
    assert 0 < alike.count() < 0.02 * pairs
    band = F.struct(F.lit(7000.0).alias("low"), F.lit(21_000.0).alias("high"))
    other = negatives._near(codes, anchors.withColumn("bands", F.array(band)), 3, 1, 256, False, 10)
    assert 0 < other.count() < 0.05 * pairs


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert negatives.mine(df, F.col("vec_id") >= 0, F.col("label")).collect() == []
