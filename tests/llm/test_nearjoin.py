"""Near-duplicate join against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tabloop.llm import nearjoin, queries


def shingles(text, width=3):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, part=90, whole=100):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    owners = {}
    for i, s in enumerate(sets):
        for x in s:
            owners.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        near = {j for x in s for j in owners[x] if j < i}
        for j in near:
            if find(i) != find(j) and whole * len(s & sets[j]) >= part * len(s | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[find(i)] = min(name, least.get(find(i), name))
    return sorted(((name, len(sets[i]), least.get(find(i))) for i, (name, _) in enumerate(rows)), key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def test_equals_brute_force_on_the_given_table(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    expected = brute(rows)
    assert any(a != c for a, _, c in expected)
    assert found(queries.QUERIES["op7_ngram_jaccard_join"](spark, path)) == expected


def corpus(seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    base = [[draw.choice(words) for _ in range(draw.choice([3, 5, 20, 60]))] for _ in range(12)]
    rows = []
    for i in range(160):
        text = list(draw.choice(base))
        for _ in range(draw.choice([0, 0, 1, 2, 3])):
            text[draw.randrange(len(text))] = draw.choice(words)
        rows.append((i, draw.choice([" ", "\t", "  "]).join(text).title()))
    return rows + [(500, None), (501, ""), (502, " \n"), (503, "a"), (504, "A"), (505, "a b"), (506, "a b c"),
                   (5, rows[5][1]), (5, "other text of that number"), (None, rows[6][1]), (None, "alone with no number")]


@pytest.mark.parametrize("seed, tile_rows, small_rows", [(1, 4096, 64), (2, 7, 2), (3, 4096, 1)])
def test_copies_cut_tiles_and_odd_rows(spark, seed, tile_rows, small_rows):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as n", "'x' as digest", "2 as node")
    assert found(nearjoin.near_components(df, tile_rows=tile_rows, small_rows=small_rows)) == brute(rows)


def test_lower_threshold(spark):
    rows = corpus(3)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(nearjoin.near_components(df, threshold=(80, 100))) == brute(rows, 80)


def test_empty_table_and_long_text(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert nearjoin.near_components(empty).collect() == []
    text = " ".join(f"{i % 50021}" for i in range(600_000))
    rows = [(1, text), (2, text + " end"), (3, "short")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert [(a, c) for a, _, c in found(nearjoin.near_components(df))] == [(1, 1), (2, 1), (3, 3)]


def test_one_identifier_with_thousands_of_texts(spark):
    """Texts of an identifier are told apart before they are joined, so the join makes a row per text."""
    rows = [(7, f"a{i // 2} b{i // 2} c{i // 2} d e f g h i j k l m n o p q r s t u v w x y z {'end' * (i % 2)}") for i in range(2000)]
    rows += [(None, t) for _, t in rows[:100]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    made = nearjoin.hash_arrays(
        df, df.select("doc_id", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"), F.lit(b"").alias("digest")),
        spark.createDataFrame([(0, 1)], "a bigint, b bigint"), 3,
    )
    assert made.count() == 0  # no digest agrees
    assert found(nearjoin.near_components(df)) == brute(rows)
