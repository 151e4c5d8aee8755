"""The document-term matrix and the filter audit against plain Python."""

import itertools
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tabloop import storage
from tabloop.llm import audit, terms

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def failed(rows):
    """rows: (doc_id, lang, text); the filters that each fails."""
    least = {}
    for doc_id, _, text in rows:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    for doc_id, _, text in rows:
        text = text or ""
        words = WORD.findall(text.encode())
        marks = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and doc_id > least[text],
        }
        yield {f for f, bad in marks.items() if bad}


def brute(rows, labels):
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    parts, out = defaultdict(list), {}
    for (doc_id, lang, _), fails in zip(rows, failed(rows)):
        parts[lang or ""].append((fails, doc_id in good and doc_id is not None, doc_id in toxic and doc_id is not None))
    for part, docs in parts.items():
        total = Counter()
        for order in itertools.permutations("ABCDE"):
            left = list(docs)
            for step, own in enumerate(order, 1):
                lost = [d for d in left if own in d[0]]
                left = [d for d in left if own not in d[0]]
                gone = [d for d in docs if own in d[0] and d[0] & set(order[: step - 1])]
                total[own] += len(lost)
                alone = sum(d[0] == {own} for d in docs)
                out[part, "".join(order), step] = [
                    len(left), len(lost), len(gone), alone, sum(d[1] for d in lost), sum(d[2] for d in lost)
                ]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(total[order[step - 1]])
    return out


COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def found(df):
    return {(r.part, r.filter_order, r.step): [r[c] for c in COUNTS] for r in df.collect()}


def corpus():
    draw = random.Random(3)
    rows = []
    for i in range(120):
        size = draw.choice([0, 3, 150, 210, 400])
        pool = [draw.choice(["alpha", "Beta", "GAMMA", "delta#", "é中", "x\x0by", "n\xa0b"]) + str(draw.randrange(draw.choice([5, 500]))) for _ in range(size)]
        rows.append((i, draw.choice(["en", "de", None, ""]), draw.choice([" ", "\n", "\t\r"]).join(pool)))
    rows += [(200 + i, draw.choice(["en", "de"]), rows[i % 7][2]) for i in range(40)]
    rows += [(None, "en", rows[2][2]), (None, "en", "no id"), (3, "en", rows[3][2]), (3, "fr", rows[2][2]), (-5, "en", rows[4][2])]
    rows += [(300, "en", None), (301, "en", ""), (302, None, None), (303, "en", "long " * 60_000 + "W" * 3_000_000)]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for i in range(0, 330, 2)]
    return rows, labels + [(2, 1, 0), (2, 0, 1), (None, 1, 1)]


def test_equals_plain_python(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string").withColumn("shard", F.lit(1)).repartition(3)
    got = found(audit.audit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")))
    want = brute(rows, labels)
    assert len(got) == 600 * 4 and got == want


@pytest.mark.parametrize("shard_bytes, bucket_words, piece", [(8 << 20, 131_072, 1 << 20), (2000, 50, 64)])
def test_matrix_holds_every_count(spark, monkeypatch, shard_bytes, bucket_words, piece):
    rows, _ = corpus()
    monkeypatch.setattr(terms.pieces, "__defaults__", (piece,))
    docs = spark.createDataFrame([(i, t) for i, (_, _, t) in enumerate(rows)], "n int, body string").repartition(2)
    shards, dictionary = terms.matrix(docs, "body", ["n"], shard_bytes, bucket_words)
    words = {r.id: r.word for r in dictionary.collect()}
    assert len(words) == len(set(words.values()))
    got = {}
    for r in shards.collect():
        for i, n in enumerate(r.n):
            a, b = r.indptr[i], r.indptr[i + 1]
            assert n not in got
            got[n] = {words[c]: k for c, k in zip(r.indices[a:b], r.data[a:b])}
            assert len(got[n]) == b - a
    assert got == {i: Counter(w.decode() for w in WORD.findall((t or "").encode())) for i, (_, _, t) in enumerate(rows)}
    counts = {r.n: (r.words, r.distinct_words) for r in terms.row_counts(shards, ["n"]).collect()}
    assert counts == {i: (sum(c.values()), len(c)) for i, c in got.items()}


def test_pieces_end_at_blanks():
    text = b"one two  three\tfour" * 7
    assert b"".join(terms.pieces(text, 5)) == text
    assert [w for p in terms.pieces(text, 5) for w in p.split()] == text.split()
    assert list(terms.pieces(b"", 5)) == [] and list(terms.pieces(b"x" * 30, 5)) == [b"x" * 30]


def test_shapley_is_the_sum_over_orders_and_a_lone_part(spark):
    docs = spark.createDataFrame([(1, "en", "A" * 10)] * 2, "doc_id bigint, lang string, text string")
    got = found(audit.audit(docs, spark.createDataFrame([], "doc_id bigint, quality int, toxic int")))
    assert len(got) == 600
    assert got["en", "ABCDE", 1] == [0, 2, 0, 0, 0, 0, 120] and got["en", "ABCDE", 3] == [0, 0, 2, 0, 0, 0, 120]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, lang string, text string")
    assert audit.audit(docs, spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).collect() == []


def test_row_counts_ignore_repeated_columns_of_a_row(spark):
    rows = [(7, [1, 2], [0, 3, 3], [5, 9, 5], [1, 1, 2])]
    shards = spark.createDataFrame(rows, "shard bigint, n array<int>, indptr array<int>, indices array<bigint>, data array<int>")
    got = [(r.n, r.words, r.distinct_words) for r in terms.row_counts(shards, ["n"]).collect()]
    assert got == [(1, 4, 2), (2, 0, 0)] and np.int64(4) == got[0][1]


def test_a_large_shard_is_counted_in_parts():
    draw = np.random.default_rng(5)
    bounds = np.concatenate([[0, 0], np.cumsum(draw.integers(0, 3000, 1500)), [3_000_000, 3_000_000]])
    indices, data = draw.integers(0, 900, bounds[-1]), draw.integers(1, 9, bounds[-1]).astype(np.int32)
    tracemalloc.start()
    words, distinct = terms.shard_counts(bounds, indices, data)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    lone = bounds[-2] - bounds[-3]
    assert peak < 100 * max(lone, terms.COUNT_ENTRIES) < 30 * len(indices)
    rows = list(zip(bounds, bounds[1:]))
    assert words.tolist() == [data[a:b].sum() for a, b in rows]
    assert distinct.tolist() == [len(set(indices[a:b])) for a, b in rows]
    for entries in (1, 700):
        again = terms.shard_counts(bounds, indices, data, entries)
        assert (again[0] == words).all() and (again[1] == distinct).all()


def test_python_gets_batches_of_bounded_size(spark):
    def seen(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    rows = spark.range(0, 40, 1, 1).select(F.array_repeat("id", 100_000).alias("indices"))
    before = spark.conf.get(storage.ARROW_CONF)
    with storage.arrow_batches(spark, 1 << 20):
        assert max(r.n for r in rows.mapInArrow(seen, "n bigint").collect()) <= 2
    assert spark.conf.get(storage.ARROW_CONF) == before
    with pytest.raises(ValueError), storage.arrow_batches(spark):
        raise ValueError
    assert spark.conf.get(storage.ARROW_CONF) == before


def test_the_audit_writes_with_small_batches_and_one_shard_a_row_group(spark, monkeypatch):
    written = {}

    def settle(df, name="table", **options):
        out = storage.settle(df, name, **options)
        written[name] = spark.conf.get(storage.ARROW_CONF), out.inputFiles()
        return out

    monkeypatch.setattr(terms, "settle", settle)
    monkeypatch.setattr(audit, "settle", settle)
    monkeypatch.setattr(terms.matrix, "__defaults__", ("text", ("doc_id",), 1 << 20, 100_000))
    words = "array_join(transform(sequence(0, 1999), i -> concat('word', id * 2000 + i)), ' ')"
    docs = spark.range(0, 400, 1, 1).selectExpr("id doc_id", "'en' lang", f"{words} text")
    assert audit.audit(docs, spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).count() == 600
    small = str(storage.ARROW_BYTES)
    assert {n: w[0] for n, w in written.items() if n != "known"} == dict.fromkeys(("shards", "numbered", "flags"), small)
    groups = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in written["shards"][1]]
    sizes = [m.row_group(i).num_rows for m in groups for i in range(m.num_row_groups)]
    assert len(sizes) > 3 and set(sizes) == {1}


def test_kept_columns_do_not_hold_the_texts():
    batch = pa.RecordBatch.from_pydict({"k0": list(range(100)), "text": [b"x" * 10_000] * 100})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    batch = pa.ipc.open_stream(sink.getvalue()).read_next_batch()
    shard = terms.Shard()
    shard.keep(batch.select(["k0"]).slice(10, 50))
    assert shard.kept[0].column(0).to_pylist() == list(range(10, 60))
    assert shard.kept[0].column(0).buffers()[1].address not in range(batch.column(0).buffers()[1].address, batch.column(1).buffers()[2].address)
