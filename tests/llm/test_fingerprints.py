"""Fingerprints: the edited texts exactly, and collision rates against the generalised Jaccard similarity."""

import hashlib
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tabloop.llm import fingerprints, queries


def bag(text):
    return Counter(w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w)


def jaccard(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def edits(rows):
    """Distinct (id, text) to (edited text, next text)."""
    order = sorted(set((i, t or "") for i, t in rows), key=lambda r: (-1 if r[0] is None else r[0]), reverse=True)
    out = {}
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        out[i, t] = (t[: len(t) - half] + after[:half], after)
    return out


def test_given_table(spark):
    path = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    expected = edits(list(texts.items()))
    out = queries.QUERIES["op1_weighted_sampling_fingerprints"](spark, path).collect()
    assert sorted(r.doc_id for r in out) == sorted(texts)
    prints, off = {}, []
    for r in out:
        text = texts[r.doc_id]
        edited, after = expected[r.doc_id, text]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        off.append((r.near_edited - jaccard(bag(text), bag(edited)), r.near_next - jaccard(bag(text), bag(after))))
    off = np.array(off)
    assert np.abs(off.mean(axis=0)).max() < 0.01  # no bias
    assert np.sqrt((off**2).mean(axis=0)).max() < 0.065  # as 64 samples scatter


def test_collision_rate_of_weighted_terms(spark):
    """Many samples of two short bags with weights far from 1."""
    pairs = [
        ({1: 100.0, 2: 1.0, 3: 1.0}, {1: 100.0, 4: 1.0}),
        ({1: 0.5, 2: 3.0}, {1: 2.5, 2: 0.75, 9: 1.0}),
        ({i: 1.0 for i in range(300)}, {i: 1.0 for i in range(150, 450)}),
    ]
    rounds = range(20)  # each with terms of its own, so their samples are independent
    rows = [
        (r, p, side, t, w)
        for r in rounds for p, pair in enumerate(pairs) for side, bag_ in enumerate(pair) for t, w in bag_.items()
    ]
    df = spark.createDataFrame(rows, "r int, p int, side int, name bigint, weight double")
    df = df.select("r", "p", "side", F.xxhash64("name", "r").alias("term"), "weight")
    got = {(x.r, x.p, x.side): x.signature for x in fingerprints.signatures(df, ["r", "p", "side"]).collect()}
    for p, (a, b) in enumerate(pairs):
        estimate = np.mean([np.mean(np.array(got[r, p, 0]) == np.array(got[r, p, 1])) for r in rounds])
        keys = set(a) | set(b)
        exact = sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
        assert abs(estimate - exact) < 0.05, (estimate, exact)


def test_scatter_at_half_likeness(spark):
    """The estimate of one pair scatters as 64 independent samples do; the plan does not hold the tables' values."""
    pairs = 400
    rows = spark.range(pairs).select(F.col("id").alias("p"), F.explode(F.sequence(F.lit(0), F.lit(119))).alias("i"))
    sides = [rows.where(f"i >= {30 * s} and i < {30 * s + 90}").withColumn("side", F.lit(s)) for s in (0, 1)]
    df = sides[0].union(sides[1]).select("p", "side", F.xxhash64("i", "p").alias("term"), F.lit(1.0).alias("weight"))
    signed = fingerprints.signatures(df, ["p", "side"])
    assert len(signed._jdf.queryExecution().analyzed().toJSON()) < 5_000_000
    got = {(r.p, r.side): np.array(r.signature) for r in signed.collect()}
    off = np.array([np.mean(got[p, 0] == got[p, 1]) - 0.5 for p in range(pairs)])
    assert abs(off.mean()) < 0.01 and np.sqrt((off**2).mean()) < 0.067  # 0.0625 by theory; 48 samples have 0.072


def test_tables_are_read_back_exactly(spark):
    values = [-1.0 / 3, 5e-324, 1e22, 0.1, -123456.789e-7]
    assert spark.range(1).select(fingerprints._constant(values).alias("x")).first().x == values


def test_odd_rows(spark):
    rows = [(1, "one two three four"), (2, None), (3, ""), (5, "é" * 11), (5, "other text"), (5, "other text"),
            (None, "no number here"), (9, " \n "), (8, "One two THREE four"), (7, "x " * 5000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("h", F.lit("h")).withColumn("key", F.lit(1))
    out = fingerprints.document_fingerprints(df).collect()
    assert len(out) == len(rows)
    lengths = sorted(len(t or "") for _, t in rows)
    assert sorted(r.n_chars for r in out) == lengths
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].fingerprint == by[8][0].fingerprint != ""
    assert by[2][0].fingerprint == by[3][0].fingerprint == by[9][0].fingerprint == ""
    assert by[3][0].near_next == 1.0 and by[8][0].near_next < 0.2  # 3 and 2 are empty, 8 and 7 share nothing
    assert by[9][0].near_next == 0.0 and by[2][0].edited_sha256 == hashlib.sha256(b"").hexdigest()
    cut = "x " * 2500 + "é" * 0
    after = {r.edited_sha256 for r in by[7]}
    assert after & {hashlib.sha256((cut + t).encode()).hexdigest() for t in ("é" * 11, "other text")}
    assert by[None][0].edited_sha256 == hashlib.sha256(("no number here"[:7] + " \n ").encode()).hexdigest()


def test_one_row_and_empty_table(spark):
    one = fingerprints.document_fingerprints(spark.createDataFrame([(4, "abcd")], "doc_id bigint, text string")).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one[0].near_next == 1.0
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert fingerprints.document_fingerprints(empty).collect() == []


def test_the_plan_holds_the_tables_once(spark):
    """The texts of the plan that the driver keeps grow by some characters per sample, not by all quantiles."""
    weights = spark.createDataFrame([(1, 7, 2), (1, 8, 1), (2, 7, 1)], "key long, term long, weight long")
    signed = fingerprints.signatures(weights, ["key"])
    assert len(signed._jdf.queryExecution().toString()) < 500_000
    assert sorted(len(r.signature) for r in signed.collect()) == [64, 64]


def test_wide_rows_are_dealt_out_once(spark, capsys):
    """What is dealt out by the next text holds no digest and one signature."""
    df = spark.createDataFrame([(i, f"a b {i}") for i in range(8)], "doc_id bigint, text string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = fingerprints.document_fingerprints(df)
        capsys.readouterr()
        out.explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    dealt = [part for part in capsys.readouterr().out.split("\n\n") if "Exchange" in part.split("\n")[0] and "Arguments: hashpartitioning(next_" in part]
    assert len(dealt) == 2
    assert not any("edited" in part for part in dealt) and sum("signature" in part for part in dealt) == 1
