"""Byte-level BPE against the library that reads the same rank file, and the round trip."""

import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tabloop.llm import bpe, queries


@pytest.fixture(scope="module")
def vocabulary():
    return queries.vocabulary()


@pytest.fixture(scope="module")
def reference(vocabulary):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={}
    )


def test_perfect_hash_places_every_key_once():
    keys = [f"key {i}".encode() for i in range(5000)]
    table = bpe.PerfectHash(keys)
    assert sorted(table.find(k) for k in keys) == list(range(5000))
    assert table.find(b"no key") == -1 and bpe.PerfectHash([]).find(b"x") == -1


def test_whole_table(spark, reference):
    path = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    import hashlib

    for r in queries.QUERIES["op10_byte_bpe"](spark, path).collect():
        ids = reference.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_odd_texts_and_clashing_columns(spark, vocabulary, reference):
    draw = random.Random(3)
    texts = ["".join(draw.choice("abcab  \n'sé語1İ\U0001f600") for _ in range(draw.randrange(80))) for _ in range(300)]
    texts += [None, "", " ", "a" * 30_000, "<|endoftext|>", "x" * 65 + " " + "x" * 65] * 2
    rows = [(i % 200, t, "old") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string").withColumn("place", F.monotonically_increasing_id())
    encoded = bpe.encode(df, vocabulary)
    out = bpe.decode(encoded.withColumn("decoded", F.lit(1)), vocabulary).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.ids == reference.encode_ordinary(r.text or "")
        assert bytes(r.decoded).decode() == (r.text or "")


def test_output_may_replace_the_text(spark, vocabulary):
    df = spark.createDataFrame([("the cat",)], "text string")
    assert bpe.encode(df, vocabulary, out="text").dtypes == [("text", "array<int>")]


def test_empty_table(spark, vocabulary):
    df = spark.createDataFrame([], "text string")
    assert bpe.decode(bpe.encode(df, vocabulary), vocabulary).collect() == []
