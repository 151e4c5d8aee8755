"""Near-duplicate join of whole texts by exact Jaccard similarity of their word shingles.

1. Every text becomes the sorted distinct hashes of its shingles. Texts with the same set are one node.
2. Hashes are put in one order for all texts: those of hash buckets that many texts use go last. Two sets of
   similarity t or more share one of their first n - ceil(t n) + 1 hashes, so each of these hashes makes a tile.
3. In a tile, nodes are sorted by size; only sizes within t of each other are compared. The parity bitmaps of two
   sets differ in at most as many bits as the sets do in elements, which bounds the overlap from above. What the
   bitmaps do not rule out is verified on the sorted hash arrays.
4. The first pass compares each node of a tile with the smallest one of a fitting size: as many pairs as rows, and
   most groups of copies are one component after it. The second pass takes the pairs of different components: all
   of them from tiles of up to `small_rows` nodes, from larger ones a spanning forest of what the bitmaps allow. The
   third takes all pairs that the bitmaps allow in large tiles and whose ends still lie in different components.
   A large tile leaves a pair to the tile of the first hash that both share.

Tiles of more than `tile_rows` nodes are cut into blocks, and every pair of blocks is a task's work. No pair of
different components is left out by size. Texts without words, empty or null are linked with nothing. Rows may repeat an identifier: rows with
equal sets are linked. A null identifier takes part, but names a component only if no row in it has one; the
component is null then. Extra columns are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloop.llm.components import components
from tabloop.llm.shingles import shingle_sets
from tabloop.operators.skew import fits_broadcast, lookup_join
from tabloop.storage import settle

register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed

WORDS = 3
THRESHOLD = (90, 100)  # links need 100 * intersection >= 90 * union
BUCKETS = 2**18  # of the frequency table that orders hashes; its size never changes
TILE_ROWS = 4096
SMALL_ROWS = 64  # tiles up to this size list their pairs without bitmaps
BITS = (128, 32768)  # narrowest and widest bitmap
LEVEL_BITS = 4

SETS = "doc_id bigint, h bigint, n bigint, digest binary, prefix array<bigint>, bitmap binary"


def prefix_size(n: int, threshold: tuple[int, int]) -> int:
    part, whole = threshold
    return n - -(-n * part // whole) + 1 if n else 0


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """Parity of the hashes that fall on each bit; a wider map folds into a narrower one by exclusive or."""
    wanted = max(BITS[0], min(BITS[1], len(hashes)))
    width = 1 << (wanted - 1).bit_length()
    flips = np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little")


def ordered(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Sort keys of hashes: rare buckets first, then by hash."""
    level = levels[(hashes >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1)].astype(np.uint64)
    return np.sort((level << np.uint64(63 - LEVEL_BITS)) | (hashes >> np.uint64(LEVEL_BITS + 1))).astype(np.int64)


def _pieces(batches: Iterator[pa.RecordBatch], column: int, words: int):
    for batch in batches:
        yield batch, shingle_sets(batch.column(column), words)


def bucket_levels(docs: DataFrame, words: int, threshold: tuple[int, int]) -> np.ndarray:
    """How much more often than the mean a bucket's hashes come first, as a small number per bucket.

    Counted over all texts, on twice as many of a text's lowest hashes as its prefix takes. The driver gets one row
    per bucket, however many texts there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for _, sets in _pieces(batches, 0, words):
            for hashes in sets:
                low = hashes[: 2 * prefix_size(len(hashes), threshold)]
                np.add.at(counts, (low >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1), 1)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], names=["bucket", "n"])

    rows = docs.select("text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = rows.toPandas()
    counts = np.zeros(BUCKETS)
    counts[found["bucket"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.float64)
    mean = max(1.0, counts.sum() / BUCKETS)
    return np.clip(np.ceil(np.log2(np.maximum(counts, 1) / mean)), 0, 2**LEVEL_BITS - 1).astype(np.uint8)


def shingle_rows(docs: DataFrame, levels: np.ndarray, words: int, threshold: tuple[int, int]) -> DataFrame:
    """Per row of (doc_id, text): size, digest, first hashes in order and bitmap of its set."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _pieces(batches, 2, words):
            size, digest, prefix, maps = [], [], [], []
            for hashes in sets:
                n = len(hashes)
                size.append(n)
                digest.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                prefix.append(ordered(hashes, shared.value)[: prefix_size(n, threshold)])
                maps.append(bitmap(hashes).tobytes() if n else b"")
            offsets = np.zeros(len(size) + 1, dtype=np.int32)
            np.cumsum([len(p) for p in prefix], out=offsets[1:])
            flat = np.concatenate([np.empty(0, np.int64), *prefix])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(digest, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(maps, pa.binary())],
                names=["doc_id", "h", "n", "digest", "prefix", "bitmap"],
            )

    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(run, SETS)


def possible(sizes, other_sizes, differing, threshold) -> np.ndarray:
    """Whether sets of these sizes that differ in at least so many elements can reach the threshold."""
    part, whole = threshold
    total = sizes + other_sizes
    return (whole + part) * ((total - differing) // 2) >= part * total


class _Tile:
    """Nodes of one tile with their bitmaps, sorted by size."""

    def __init__(self, nodes, sizes, roots, sides, maps, before, threshold):
        order = np.lexsort((nodes, sizes))
        self.before = [before[i] for i in order]  # the hashes that come before the tile's in each row's order
        self.nodes, self.sizes, self.roots, self.sides = nodes[order], sizes[order], roots[order], sides[order]
        self.threshold = threshold
        maps = [maps[i] for i in order]
        self.widths = np.array([len(m) for m in maps])
        self.maps = {}  # by width, the maps of all nodes at least that wide, folded to it
        for width in np.unique(self.widths).tolist():
            able = self.widths >= width
            stack = np.zeros((len(maps), width // 8), dtype=np.uint64)
            for i in np.flatnonzero(able).tolist():
                m = np.frombuffer(maps[i], dtype=np.uint64)
                while len(m) > width // 8:
                    m = m[: len(m) // 2] ^ m[len(m) // 2 :]
                stack[i] = m
            self.maps[width] = stack

    def near(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of `others` (places of rows not smaller than row i) that may link with row i."""
        part, whole = self.threshold
        n = self.sizes[i]
        others = others[(whole * n >= part * self.sizes[others])]
        if not len(others):
            return others
        width = int(self.widths[i])  # a larger set's map is at least as wide
        maps = self.maps[width]
        differing = np.bitwise_count(maps[others] ^ maps[i]).sum(axis=1, dtype=np.int64)
        return others[possible(n, self.sizes[others], differing, self.threshold)]

    def around(self, i: int, others: np.ndarray) -> np.ndarray:
        """As `near`, for others on either side of row i."""
        part, whole = self.threshold
        low = others[others < i]
        low = low[whole * self.sizes[low] >= part * self.sizes[i]]
        below = [low[:0]]
        for width in np.unique(self.widths[low]).tolist():
            some = low[self.widths[low] == width]
            maps = self.maps[width]
            differing = np.bitwise_count(maps[some] ^ maps[i]).sum(axis=1, dtype=np.int64)
            below.append(some[possible(self.sizes[i], self.sizes[some], differing, self.threshold)])
        return np.concatenate([*below, self.near(i, others[others > i])])

    def first(self, i: int, others: np.ndarray) -> list[int]:
        """Those of `others` that share no earlier hash with row i."""
        mine = self.before[i]
        return [j for j in others.tolist() if mine.isdisjoint(self.before[j])]

    def forest(self) -> Iterator[tuple[int, int]]:
        """Links that span every group of possible links; rows of one root count as linked."""
        waiting = np.ones(len(self.nodes), dtype=bool)
        by_root: dict[int, list[int]] = {}
        for i, root in enumerate(self.roots.tolist()):
            by_root.setdefault(root, []).append(i)
        for first in range(len(self.nodes)):
            if not waiting[first]:
                continue
            waiting[first] = False
            todo = [first]
            for i in by_root[int(self.roots[first])]:
                if waiting[i]:
                    waiting[i] = False
                    todo.append(i)
            while todo:
                i = todo.pop()
                for j in self.first(i, self.around(i, np.flatnonzero(waiting))):
                    if waiting[j]:
                        yield i, j
                        waiting[j] = False
                        todo.append(j)
                        for other in by_root[int(self.roots[j])]:
                            if waiting[other]:
                                waiting[other] = False
                                todo.append(other)

    def every(self) -> Iterator[tuple[int, int]]:
        """All possible links between different roots, and between both blocks of a cut tile."""
        split = self.sides.max() != self.sides.min()
        for i in range(len(self.nodes)):
            others = np.arange(i + 1, len(self.nodes))
            others = others[self.roots[others] != self.roots[i]]
            if split:
                others = others[self.sides[others] != self.sides[i]]
            for j in self.first(i, self.near(i, others)):
                yield i, j


def _tiles(rows: DataFrame, tile_rows: int) -> DataFrame:
    """(key, node, n, root) with block and side: a key of at most `tile_rows` rows is one block with itself."""
    big = settle(
        rows.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > tile_rows)
        .select("key", F.ceil(F.col("_n") / tile_rows).cast("int").alias("blocks")),
        "bigtiles",
    )
    with_blocks = lookup_join(rows, big, ["key"]).withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    with_blocks = with_blocks.withColumn("side", own)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return with_blocks.withColumn("_other", other).select(
        "key", "node", "n", "root", "side",
        F.concat_ws("-", F.least("side", "_other"), F.greatest("side", "_other")).alias("block"),
    )


def candidates(rows: DataFrame, maps: DataFrame, forest: bool, threshold, tile_rows: int) -> DataFrame:
    """Distinct (a, b) pairs of nodes that the bitmaps do not rule out, of tiles that hold bitmaps."""
    tiled = _tiles(rows, tile_rows).join(maps.select("node", "bitmap", "prefix"), "node")

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        whole = {c: group.column(c).to_numpy() for c in ("node", "n", "root", "side")}
        key = group.column("key")[0].as_py()
        before = [set(p.values.to_numpy()[: np.searchsorted(p.values.to_numpy(), key)].tolist()) for p in group.column("prefix")]
        tile = _Tile(*(whole[c] for c in ("node", "n", "root", "side")), group.column("bitmap").to_pylist(), before, threshold)
        pairs = np.array(list(tile.forest() if forest else tile.every()), dtype=np.int64).reshape(-1, 2)
        ends = np.sort(tile.nodes[pairs], axis=1)
        return pa.table({"a": pa.array(ends[:, 1]), "b": pa.array(ends[:, 0])})

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key and block, so one tile at a time is held."""
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = batch.column(0).to_numpy()
            blocks = batch.column(1)
            same = keys[1:] == keys[:-1]
            texts = np.array(blocks.to_pylist(), dtype=object)
            same &= texts[1:] == texts[:-1]
            cuts = [0, *(np.flatnonzero(~same) + 1).tolist(), len(keys)]
            for start, stop in zip(cuts, cuts[1:]):
                name = (keys[start], texts[start])
                if name != last and held:
                    yield from finished(held)
                    held = []
                last = name
                held.append(batch.slice(start, stop - start))
        if held:
            yield from finished(held)

    def finished(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        if sum(b.num_rows for b in held) < 2:
            return []
        return run(pa.Table.from_batches(held)).to_batches()

    dealt = tiled.select("key", "block", "node", "n", "root", "side", "bitmap", "prefix").repartition("key", "block")
    dealt = dealt.sortWithinPartitions("key", "block")
    return settle(dealt.mapInArrow(per_task, "a bigint, b bigint").distinct(), "candidates")


def verified(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Those pairs whose sorted hash arrays reach the threshold."""
    part, whole = threshold
    with_a = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("left")), "a")
    with_b = with_a.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("right")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(side.as_buffer(), dtype=np.uint64) for side in (left, right))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(whole * shared >= part * (len(x) + len(y) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return with_b.select("a", "b", "left", "right").mapInArrow(run, "a bigint, b bigint")


def _unique(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Distinct pairs with the greater end first."""
    ends = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])


def star_pairs(live: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Each row of a tile with the tile's smallest of a fitting size.

    Reads the tiles as they were written, in order. A tile that two tasks or batches share has a star in each; the
    later passes do not rely on these pairs.
    """
    part, whole = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, node, n = (batch.column(i).to_numpy() for i in range(3))
            if not len(key):
                continue
            start = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], np.arange(len(key)), 0))
            pivot = start.copy()
            while True:  # sizes rise inside a tile: step to the first that fits
                off = (whole * n[pivot] < part * n) & (pivot < np.arange(len(key)))
                if not off.any():
                    break
                pivot[off] += 1
            pair = pivot < np.arange(len(key))
            yield _unique(node[pair], node[pivot[pair]])

    return live.select("key", "node", "n").mapInArrow(run, "a bigint, b bigint").distinct()


def small_tile_pairs(rows: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """All pairs of fitting sizes and different roots, of tiles that are small (`big` is false)."""
    part, whole = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(4)]
            if held is not None:
                columns = [np.concatenate(c) for c in zip(held, columns)]
            if not len(columns[0]):
                continue
            whole_keys = int(np.searchsorted(columns[0], columns[0][-1]))  # the last key may go on
            held = [c[whole_keys:] for c in columns]
            if whole_keys:
                yield paired([c[:whole_keys] for c in columns])
        if held is not None:
            yield paired(held)

    def paired(columns: list[np.ndarray]) -> pa.RecordBatch:
        key, node, n, root = columns
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for step in range(1, len(key)):
            same = key[step:] == key[:-step]
            if not same.any():
                break
            fits = same & (whole * n[:-step] >= part * n[step:]) & (root[step:] != root[:-step])
            left.append(node[step:][fits])
            right.append(node[:-step][fits])
        return _unique(np.concatenate(left), np.concatenate(right))

    dealt = rows.where("not big").select("key", "node", "n", "root").repartition("key")
    dealt = dealt.sortWithinPartitions("key", "n", "node")
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def pruned(pairs: DataFrame, maps: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Those pairs whose bitmaps leave enough room for the overlap, as a written table."""
    ends = [maps.select(F.col("node").alias(e), F.col("n").alias(f"n_{e}"), F.col("bitmap").alias(f"m_{e}")) for e in "ab"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [batch.column(i).to_numpy() for i in (2, 3)]
            differing = []
            for x, y in zip(batch.column(4), batch.column(5)):
                x, y = (np.frombuffer(m.as_buffer(), dtype=np.uint64) for m in (x, y))
                while len(x) > len(y):
                    x = x[: len(x) // 2] ^ x[len(x) // 2 :]
                while len(y) > len(x):
                    y = y[: len(y) // 2] ^ y[len(y) // 2 :]
                differing.append(int(np.bitwise_count(x ^ y).sum()))
            keep = possible(*sizes, np.array(differing, dtype=np.int64), threshold)
            yield batch.select([0, 1]).filter(pa.array(keep))

    joined = pairs.join(ends[0], "a").join(ends[1], "b").select("a", "b", "n_a", "n_b", "m_a", "m_b")
    return settle(joined.mapInArrow(run, "a bigint, b bigint"), "candidates")


def near_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
    threshold: tuple[int, int] = THRESHOLD, tile_rows: int = TILE_ROWS, small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest identifier reachable by links) of every row."""
    judged = _judged(docs, doc_id, text, words, threshold, tile_rows, small_rows)
    return judged.select("doc_id", "n_shingles", "component_id")


def without_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, threshold: tuple[int, int] = THRESHOLD
) -> DataFrame:
    """One row of each component, that with the smallest identifier, and every row that is linked with nothing.

    Rows of that identifier that are alike count as one. Columns stay as they are.
    """
    judged = _judged(docs, doc_id, text, words, threshold, TILE_ROWS, SMALL_ROWS)
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63))).alias("_key")
    decided = judged.groupBy(key, F.col("h").alias("_h")).agg(F.max("stays").alias("_stays"), F.count(F.lit(1)).alias("_c"))
    decided = settle(decided.where("not _stays or _c > 1"), "copies")
    rows = docs.withColumns({"_key": F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(2**63))), "_h": F.xxhash64(F.col(text).cast("string"))})
    marked = lookup_join(rows, decided, ["_key", "_h"])
    several = marked.where("_stays and _c > 1")
    kept = marked.where("_c is null")
    if decided.where("_stays").limit(1).count():
        kept = kept.unionByName(several.dropDuplicates(["_key", "_h"]))
    return kept.select(*docs.columns)


def _judged(docs: DataFrame, doc_id: str, text: str, words: int, threshold, tile_rows: int, small_rows: int) -> DataFrame:
    """doc_id, h, n_shingles, component_id, and whether the row is its component's first."""
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    levels = bucket_levels(docs, words, threshold)
    rows = shingle_rows(docs, levels, words, threshold).withColumn("row", F.monotonically_increasing_id())
    rows = settle(rows, "shingles")
    pick = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")  # the smallest identifier, nulls last
    nodes = settle(
        rows.where("n > 0").groupBy("digest").agg(F.min("row").alias("node"), F.min(pick).alias("pick")), "nodes"
    )
    kept = rows.join(nodes.select(F.col("node").alias("row")), "row", "left_semi")
    kept = kept.select(F.col("row").alias("node"), "n", "prefix", "bitmap")
    live = settle(_shared(kept.select("node", "n", F.explode("prefix").alias("key"))), "tiles")
    maps = kept.select("node", "n", "bitmap", "prefix").join(live.select("node").distinct(), "node", "left_semi")
    maps = settle(maps, "bitmaps")

    found = pruned(star_pairs(live, threshold), maps, threshold)
    links = settle(verified(found, hash_arrays(docs, rows, found, words), threshold), "links")
    big = settle(live.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > small_rows).select("key", F.lit(True).alias("big")), "big")
    flagged = lookup_join(live, big, ["key"]).withColumn("big", F.coalesce("big", F.lit(False)))
    roots = settle(components(links), "roots")
    mixed = _with_roots(flagged, roots)
    any_big = big.limit(1).count() > 0
    more = small_tile_pairs(mixed, threshold)
    if any_big:
        more = more.unionByName(candidates(mixed.where("big"), maps, True, threshold, tile_rows)).distinct()
    more = pruned(more.join(found, ["a", "b"], "left_anti"), maps, threshold)
    links = links.unionByName(settle(verified(more, hash_arrays(docs, rows, more, words), threshold), "links"))
    roots = settle(components(links), "roots")
    if any_big:
        rest = candidates(_with_roots(flagged.where("big"), roots), maps, False, threshold, tile_rows)
        rest = settle(rest.join(found, ["a", "b"], "left_anti").join(more, ["a", "b"], "left_anti"), "candidates")
        last = settle(verified(rest, hash_arrays(docs, rows, rest, words), threshold), "links")
        if last.limit(1).count():
            roots = settle(components(links.unionByName(last)), "roots")

    member = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = member.groupBy("root").agg(F.min("pick").alias("first"))
    by_digest = member.join(named, "root").select(
        "digest", F.col("first.doc_id").alias("component_id"), F.col("first.row").alias("first_row")
    )
    by_digest = settle(by_digest, "members")
    known = F.when(F.col("n") > 0, F.col("digest")).alias("digest")
    out = lookup_join(rows.select("row", "doc_id", "h", F.col("n").alias("n_shingles"), known), by_digest, ["digest"])
    alone = F.col("digest").isNull()
    stays = alone | (F.col("row") == F.col("first_row"))
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "h", "n_shingles", component.alias("component_id"), stays.alias("stays"))


def _with_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return lookup_join(rows, roots, ["node"]).withColumn("root", F.coalesce("root", "node"))


def _shared(tokens: DataFrame) -> DataFrame:
    """Rows of keys that at least two nodes have: other keys cannot make a pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = None, None  # held: a batch's last row, whose key the next batch may go on with
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            again = np.zeros(len(keys), dtype=bool)
            again[1:] = keys[1:] == keys[:-1]
            again[:-1] |= keys[:-1] == keys[1:]
            if last == keys[0]:
                again[0] = True
                if held is not None:
                    yield held
            last = keys[-1]
            held = None if again[-1] else batch.slice(len(keys) - 1)
            yield batch.filter(pa.array(again))

    dealt = tokens.select("key", "node", "n").repartition("key").sortWithinPartitions("key", "n", "node")
    return dealt.mapInArrow(run, "key bigint, node bigint, n bigint")


def hash_arrays(docs: DataFrame, rows: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """Sorted hashes of the nodes that take part in a pair, made again from their texts."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    ids = settle(rows.join(wanted, F.col("row") == F.col("node")).select("doc_id", "h", "node", "digest"), "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _pieces(batches, 2, words):
            hashes = [s.tobytes() for s in sets]
            same = [
                hashlib.blake2b(h, digest_size=16).digest() == d
                for h, d in zip(hashes, batch.column(1).to_pylist(), strict=True)
            ]
            made = pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes, pa.binary())], names=["node", "hashes"])
            yield made.filter(pa.array(same, pa.bool_()))

    named = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    ids = ids.select(named.alias("key"), "h", "node", "digest")
    texts = docs.select(named.alias("key"), F.xxhash64("text").alias("h"), "text")  # an identifier may have many texts
    with_text = texts.join(F.broadcast(ids) if fits_broadcast(ids) else ids, ["key", "h"])
    return with_text.select("node", "digest", "text").mapInArrow(run, "node bigint, hashes binary").dropDuplicates(["node"])
