"""Sharding against plain Python: draws, slots, movement, hot and odd rows."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tabloop.llm import queries, shards


def descend(key, tree):
    node = (-1, -1)
    for level, children in zip(shards.LEVELS, tree.children()):
        draws = []
        for region, rack, child, weight in children:
            if (region, rack) == node:
                text = f"{key}:{level}:{child}:{shards.SEED}"
                u = (int(hashlib.md5(text.encode()).hexdigest()[:13], 16) + 0.5) / 16**13
                draws.append((-math.log(u) / weight, child))
        best = min(draws)[1]
        path = (*(x for x in node if x >= 0), best)
        node = (path[0], -1) if len(path) == 1 else path[:2]
    return path


def brute(rows, tree, more):
    """rows: (doc_id, text)."""
    out, inside = [], defaultdict(list)
    for doc_id, text in rows:
        data = (text or "").encode()
        key = "null" if doc_id is None else str(doc_id)
        size, crc = len(data) + 1, zlib.crc32(data)
        place = int(hashlib.md5(f"{key}:{size}:{crc}:{shards.SEED}".encode()).hexdigest()[:13], 16)
        path = descend(key, tree)
        inside[path].append((place, -(2**63) if doc_id is None else doc_id, size, crc, descend(key, more)[2]))
    for path, own in inside.items():
        out += [(d, size, crc, *path, slot, m) for slot, (_, d, size, crc, m) in enumerate(sorted(own))]
    return sorted(out)


def found(df):
    columns = ["size", "text_crc32", "region", "rack", "shard", "slot", "grown_shard"]
    return sorted((-(2**63) if r.doc_id is None else r.doc_id, *(r[c] for c in columns)) for r in df.collect())


ROWS = (
    [(i, f"text {i % 7}" * (i % 5)) for i in range(300)]
    + [(5, "again"), (5, "again"), (5, "again"), (5, None), (5, ""), (None, "no id"), (None, None), (None, "no id")]
    + [(9, "hot")] * 90
    + [(700, "é中\U0001f600" * 20_000)]
)


@pytest.mark.parametrize("block_rows, copy_rows", [(4096, 65_536), (10, 7)])
def test_equals_plain_python(spark, block_rows, copy_rows):
    tree = shards.Tree({(0, 0, 0): 1.0, (0, 0, 1): 2.5, (0, 1, 2): 1.0, (1, 2, 3): 0.5, (1, 2, 4): 3.0, (1, 3, 5): 0.0})
    more = shards.grown(tree, 6, 2.0)
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string").withColumn("slot", F.lit("a clash"))
    got = shards.slots(docs, tree, more, block_rows=block_rows, copy_rows=copy_rows)
    assert found(got) == brute(ROWS, tree, more)
    assert got.columns == ["doc_id", "size", "text_crc32", "region", "rack", "shard", "slot", "grown_shard"]


def test_query_on_the_given_table(spark):
    path = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op11_weighted_hash_tree_sharding"](spark, path).collect()
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    tree = shards.even_tree(16)
    want = brute([tuple(d) for d in docs], tree, shards.even_tree(17))
    assert sorted((r.doc_id, r.size, r.text_crc32, r.region, r.rack, r.shard, r.slot, r.grown_shard) for r in rows) == want
    assert {r.law for r in rows} == {"key"}
    assert all(r.grown_shard in (r.shard, 16) for r in rows)
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r.slot)
    assert len(by_shard) == 16 and all(sorted(s) == list(range(len(s))) for s in by_shard.values())


def test_rows_follow_weights(spark):
    tree = shards.Tree({(0, 0, 0): 1.0, (0, 0, 1): 3.0, (1, 1, 2): 4.0})
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    share = Counter(r.shard for r in shards.place(ids, tree).collect())
    assert [round(share[s] / 20_000, 1) for s in range(3)] == [0.1, 0.4, 0.5]


def test_movement_stays_in_the_subtrees_whose_weights_changed(spark):
    before = shards.even_tree(16)
    heavier = shards.Tree({**before.weights, (0, 1, 5): 2.0})
    lighter = shards.Tree({**before.weights, (0, 1, 5): 0.5})
    ids = spark.range(6000).withColumnRenamed("id", "doc_id")
    at = {r.doc_id: (r.region, r.rack, r.shard) for r in shards.place(ids, before).collect()}
    up = {r.doc_id: (r.region, r.rack, r.shard) for r in shards.place(ids, heavier).collect()}
    down = {r.doc_id: (r.region, r.rack, r.shard) for r in shards.place(ids, lighter).collect()}
    moved_up = [(at[i], up[i]) for i in at if at[i] != up[i]]
    moved_down = [(at[i], down[i]) for i in at if at[i] != down[i]]
    assert moved_up and moved_down
    for old, new in moved_up:  # into the heavier region, the heavier rack or the heavier shard
        assert new[0] == 0 if old[0] != new[0] else new[1] == 1 if old[1] != new[1] else new[2] == 5
    for old, new in moved_down:
        assert old[0] == 0 if old[0] != new[0] else old[1] == 1 if old[1] != new[1] else old[2] == 5


def test_written_shards_hold_all_rows_in_order(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string").withColumn("extra", F.array(F.lit(1)))
    tree = shards.even_tree(16)
    shards.write(docs, tree, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    got = Counter((r.doc_id, r.text, r.region, r.rack, r.shard) for r in back.collect())
    want = Counter((d, t, *descend("null" if d is None else str(d), tree)) for d, t in ROWS)
    assert got == want and "extra" in back.columns


def test_empty_table_and_empty_tree(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert shards.slots(docs, shards.even_tree(3), shards.even_tree(4)).collect() == []
    with pytest.raises(ValueError):
        shards.Tree({(0, 0, 0): 0.0}).children()
