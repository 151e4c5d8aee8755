"""The stages, each on what the one before kept."""

import public_tokenizers
import test_nearjoin
import tiktoken
from test_linededup import brute as lines_removed
from test_nearjoin import brute as groups

import corpus_pipeline
from tabloop.llm import nearjoin, queries

PATH = "/root/testdata/sf0.01"


def test_each_stage_on_its_input(spark):
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(stage(spark, tables[-1], PATH).cache())
    start, good, cut, single, mixed, last = tables
    for t in tables[:-1]:
        assert t.columns == start.columns
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{PATH}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.collect()}
    assert all((i in kept) == bool(q) for i, q in known.items())

    before = {r.doc_id: r for r in good.collect()}
    expected = lines_removed([(i, r.text) for i, r in before.items()])
    after = {r.doc_id: r for r in cut.collect()}
    assert set(after) == set(before)
    for i, r in after.items():
        assert r.text == "\n".join(x for k, x in enumerate(before[i].text.split("\n")) if k not in expected[i])
        assert r.n_chars == (len(r.text) if expected[i] else before[i].n_chars)

    first = {i for i, _, c in groups([(i, r.text) for i, r in after.items()]) if i == c}
    assert {r.doc_id for r in single.collect()} == first
    assert {r.doc_id for r in mixed.collect()} <= first
    ranks = queries.vocabulary().ranks
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in mixed.collect()}
    out = last.collect()
    assert sorted(r.doc_id for r in out) == sorted(texts)
    for r in out:
        assert r.ids == known.encode_ordinary(texts[r.doc_id]) and r.round_trip and r.n_tokens == len(r.ids)


def test_near_copies_share_five_word_shingles(spark, monkeypatch):
    """Copies with some words replaced, on both sides of 0.8 of the five-word shingles and of 0.9 of the three-word ones."""
    texts = [[f"d{d}w{i}" for i in range(120)] for d in range(8)]
    rows = [(10 * d, " ".join(t)) for d, t in enumerate(texts)]
    for d, t in enumerate(texts):
        for copy in range(1, 4):
            step = 120 // (d + 1)
            rows.append((10 * d + copy, " ".join(w if i % step or i // step >= d else f"new{copy}" for i, w in enumerate(t))))
    three = {i for i, _, c in groups(rows) if i == c}
    monkeypatch.setattr(test_nearjoin.shingles, "__defaults__", (5,))
    five = {i for i, _, c in groups(rows, 80, 100) if i == c}
    assert five < three and len(five) > 8  # the two rules differ here
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, df, PATH).collect()} == five


def test_run_gives_the_last_stage(spark):
    assert set(corpus_pipeline.run(spark, "/root/testdata/sf0.001").columns) == {"doc_id", "lang", "source", "n_tokens", "ids", "round_trip"}


def test_one_document_of_each_group_stays(spark):
    rows = [(3, "a b c d"), (1, "a b c d"), (1, "A b c d"), (1, "a b c d"), (None, "a b c d"), (4, ""), (4, ""), (None, "x y z"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as h", "'s' as stays")
    out = nearjoin.without_copies(df).collect()
    got = sorted(((r.doc_id, r.text) for r in out), key=repr)
    assert [g for g in got if g[1] and "b" in g[1].lower()].__len__() == 1
    assert (None, "x y z") in got and (5, None) in got and (4, "") in got and out[0].h == 1
