"""Vector search against brute force."""

import math

import numpy as np
from pyspark.sql import functions as F

from tabloop.llm import queries, vectors


def brute(rows, k):
    """rows: (id, components, asked), in order; a row is its place."""
    out = []
    usable = [
        (i, v, [math.floor(64 * float(x)) for x in c])
        for i, (v, c, _) in enumerate(rows)
        if c and all(x is not None and math.isfinite(x) for x in c)
    ]
    for i, v, x in usable:
        if rows[i][2]:
            scores = sorted(
                (-sum(a * b for a, b in zip(x, y)), -(2**63) if w is None else w)
                for j, w, y in usable
                if j != i and len(x) == len(y)
            )[:k]
            out += [(v, r + 1, None if w == -(2**63) else w, -s) for r, (s, w) in enumerate(scores)]
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect()), key=repr)


def test_equals_brute_force_on_the_given_table(spark):
    path = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{path}/embeddings.parquet").collect()
    rows = [(r.vec_id, list(r.embedding), r.vec_id % 20 == 0) for r in table]
    assert found(queries.QUERIES["op9_vector_approximation_search"](spark, path)) == brute(rows, 20)


def test_small_blocks_ties_copies_and_bad_vectors(spark):
    draw = np.random.default_rng(5)
    rows = [(i, draw.normal(size=4).round(1).tolist(), i % 3 == 0) for i in range(60)]
    rows += [(7, rows[7][1], False), (9, rows[9][1], True), (9, rows[9][1], True), (None, [1.0, 0.0, 0.0, 0.0], False)]
    rows += [(100, None, True), (101, [], True), (102, [1.0, None, 0.0, 0.0], True), (103, [math.nan] * 4, True)]
    rows += [(104, [math.inf, 0.0, 0.0, 0.0], True), (105, [1.0, 2.0], True), (106, [2.0, 1.0], False)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, asked boolean").withColumn("row", F.lit(1))
    got = vectors.search(df, F.col("asked"), k=5, block_rows=7, query_rows=4)
    assert found(got) == brute(rows, 5)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]


def test_scores_beyond_doubles_stay_exact(spark):
    big = float(2**40)
    rows = [(1, [big, 1.0], True), (2, [big, 3.0], False), (3, [big, 2.0], False), (4, [-big, 5.0], False)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, asked boolean")
    top = [r[2] for r in found(vectors.search(df, F.col("asked"), k=2))]
    assert top == [2, 3]


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert vectors.search(df, F.col("vec_id") >= 0).collect() == []
