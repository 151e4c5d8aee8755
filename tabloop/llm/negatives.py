"""Hard negatives by rotated one-bit codes with score intervals.

A vector is rotated by a seeded orthogonal matrix and coded by the signs of its components; stored beside the code is
its alignment, the inner product of the vector with the unit vector of its code. What the code leaves over, the
residual, is coded by its signs again, and so on; each stage keeps the alignments that leave the least, and how much
they leave.

An anchor is rotated alike and cut into bit planes. Popcounts of planes and code give the anchor's inner product with a
code vector, and the sum of alignments times these products estimates the score. By Cauchy-Schwarz the residual's share
of the score is at most its length times the anchor's; in the first stage, where it is orthogonal to the code vector,
times that of the anchor's part orthogonal to it. That is a deterministic interval around the estimate. After each
stage, rows whose interval cannot reach the result are dropped. Only codes meet the anchors, a block of them at a time;
then the k-th sure bound of an anchor over all blocks filters once more, and only surviving pairs fetch their exact
vectors and are scored with integers. The result equals brute force.

First an anchor's positives are found among the rows of its label. Their scores set a band for each positive, in which
the first negatives of other labels are found. Copies of one vector and label beyond the few that can be in a result
are left out before the search: they have the same score and larger identifiers.

Rows take part with a label and a vector of finite components that stay finite when multiplied; vectors are compared
with vectors of their length. Rows may repeat an identifier: each is a row of its own, and an anchor's own row is
neither its positive nor its negative. A null identifier sorts first. Ties go to the smaller identifier. Scores beyond
a 64-bit integer are held at its ends. Extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloop.operators.skew import lookup_join
from tabloop.storage import settle

register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed

SCALE = 256
STAGES = (1, 4, 8)  # codes used after each stage of the filter
PLANES = 8  # bits of an anchor's component
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
BLOCK_ROWS = 4096
TILE_ROWS = 4096  # anchors
SEED = 13
SLACK = 1e-9  # of the product of two lengths, for rounding of doubles
EXACT = 2.0**62


@functools.lru_cache(maxsize=4)
def rotation(dims: int) -> np.ndarray:
    """A seeded orthogonal matrix."""
    return np.linalg.qr(np.random.default_rng(SEED).normal(size=(dims, dims)))[0]


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    size = -(-bits.shape[1] // 64) * 64
    wide = np.zeros((len(bits), size), bool)
    wide[:, : bits.shape[1]] = bits
    return np.packbits(wide, axis=1).view(np.uint64)


def coded(vectors: np.ndarray, stages: tuple[int, ...] = STAGES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes: rows, codes, words; alignments: rows, those of each stage in turn; lengths left: rows, stages)."""
    turned = vectors @ rotation(vectors.shape[1])
    left, signs, codes, aligned, rest = turned, [], [], [], []
    for count in range(1, max(stages) + 1):
        signs.append(np.where(left >= 0, 1.0, -1.0) / np.sqrt(turned.shape[1]))
        codes.append(packed(signs[-1] > 0))
        units = np.stack(signs, axis=1)
        square = units @ units.transpose(0, 2, 1) + (count > 1) * 1e-9 * np.eye(count)  # codes may repeat
        along = np.linalg.solve(square, (units @ turned[:, :, None]))[:, :, 0]
        left = turned - (along[:, None, :] @ units)[:, 0, :]
        if count in stages:
            aligned.append(along)
            rest.append(np.sqrt((left**2).sum(axis=1)))
    return np.stack(codes, axis=1), np.concatenate(aligned, axis=1), np.stack(rest, axis=1)


class Asked:
    """An anchor in bit planes."""

    def __init__(self, vector: np.ndarray) -> None:
        self.dims = len(vector)
        turned = vector @ rotation(self.dims)
        self.length = float(np.sqrt((turned**2).sum()))
        self.low = float(turned.min())
        self.step = max((float(turned.max()) - self.low) / (2**PLANES - 1), 1e-300)
        number = np.rint((turned - self.low) / self.step).astype(np.int64)
        self.total = int(number.sum())
        self.error = float(np.abs(turned - self.low - self.step * number).sum()) / np.sqrt(self.dims)
        self.planes = packed((number[None, :] >> np.arange(PLANES)[:, None]) & 1 > 0)

    def along(self, codes: np.ndarray) -> np.ndarray:
        """Inner products with the unit vectors of codes, right to `error`."""
        inner = np.zeros(len(codes), np.int64)
        for j, plane in enumerate(self.planes):
            inner += np.bitwise_count(codes & plane).sum(axis=1, dtype=np.int64) << j
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        return (self.low * (2 * ones - self.dims) + self.step * (2 * inner - self.total)) / np.sqrt(self.dims)


Bounds = Callable[[np.ndarray, np.ndarray], np.ndarray]


def narrowed(asked: Asked, codes: np.ndarray, aligned: np.ndarray, rest: np.ndarray, some: np.ndarray, keep: Bounds):
    """(places, lower, upper) of the rows of `some` that `keep` of their intervals leaves after the last stage."""
    along = np.zeros((len(some), 0))
    length = np.abs(aligned[some, 0]) + rest[some, 0]
    low, high = np.full(len(some), -np.inf), np.full(len(some), np.inf)
    first = 0
    for stage, count in enumerate(STAGES):
        if not len(some):
            break
        fresh = [asked.along(codes[some, layer]) for layer in range(along.shape[1], count)]
        along = np.concatenate([along, np.stack(fresh, axis=1)], axis=1)
        weights = aligned[some, first : first + count]
        first += count
        estimate = (weights * along).sum(axis=1)
        error = np.abs(weights).sum(axis=1) * asked.error
        sure = np.maximum(np.abs(along[:, 0]) - asked.error, 0) if stage == 0 else 0.0
        across = rest[some, stage] * np.sqrt(np.maximum(asked.length**2 - sure**2, 0))
        width = error + across + SLACK * asked.length * length
        low = np.fmax(low, np.nan_to_num(estimate - width, nan=-np.inf))
        high = np.fmin(high, np.nan_to_num(estimate + width, nan=np.inf))
        left = keep(low, high)
        some, along, length, low, high = (x[left] for x in (some, along, length, low, high))
    return some, low, high


def kth(values: np.ndarray, k: int) -> float:
    """The k-th largest, or less than any if there are fewer."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(x * scale)


def usable(vector: Column, scale: int) -> Column:
    """Whether all components are finite, also when multiplied."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= sys.float_info.max / scale))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False))


def _codes(rows: DataFrame, scale: int) -> DataFrame:
    """row, label, dims, codes, aligned, rest of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for size in np.unique(dims):
                part = batch.take(pa.array(np.flatnonzero(dims == size)))
                x = part.column(3).flatten().to_numpy().reshape(-1, size)
                with np.errstate(all="ignore"):
                    codes, aligned, rest = coded(whole(x, scale))
                lists = [list(codes.reshape(len(x), -1).view(np.int64)), list(aligned), list(rest)]
                kinds = [pa.int64(), pa.float64(), pa.float64()]
                arrays = [pa.array(v, pa.list_(k)) for v, k in zip(lists, kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), *arrays], names=names)

    names = ["row", "label", "dims", "codes", "aligned", "rest"]
    kinds = "row bigint, label int, dims int, codes array<bigint>, aligned array<double>, rest array<double>"
    return rows.select("row", "label", "dims", "x").mapInArrow(run, kinds)


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _near(codes: DataFrame, anchors: DataFrame, blocks: int, tiles: int, scale: int, same: bool, k: int) -> DataFrame:
    """anchor, place, row, low, high, sure: pairs whose interval may reach the first k.

    Without `same`, rows of other labels inside the bands of the anchor, one place per band.
    """
    spot = F.xxhash64("row")
    scanned = codes.select("*", F.pmod(spot, F.lit(blocks)).alias("block"), F.explode(_numbers(tiles)).alias("tile"))
    asking = anchors.select("*", F.pmod(spot, F.lit(tiles)).alias("tile"), F.explode(_numbers(blocks)).alias("block"))

    def run(block: pa.Table, tile: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if block.num_rows and tile.num_rows:
            dims, n = block.column("dims")[0].as_py(), block.num_rows
            words = -(-dims // 64)
            bits = _matrix(block.column("codes"), n).view(np.uint64).reshape(n, -1, words)
            aligned, rest = _matrix(block.column("aligned"), n), _matrix(block.column("rest"), n)
            label, row = block.column("label").to_numpy(), block.column("row").to_numpy()
            vectors = whole(_matrix(tile.column("x"), tile.num_rows), scale)
            own_label, own_row = tile.column("label").to_numpy(), tile.column("row").to_numpy()
            bands = None if same else tile.column("bands").to_pylist()
            with np.errstate(all="ignore"):
                for i, vector in enumerate(vectors):
                    limits = [(-np.inf, np.inf)] if same else [(b["low"], b["high"]) for b in bands[i]]
                    some = np.flatnonzero((label == own_label[i]) & (row != own_row[i]) if same else label != own_label[i])
                    asked = Asked(vector)

                    def reach(low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
                        masks = []
                        for least, most in limits:
                            inside = (low >= least) & (high <= most)
                            masks.append((high >= max(least, kth(low[inside], k))) & (low <= most))
                        return masks

                    some, low, high = narrowed(asked, bits, aligned, rest, some, lambda a, b: np.logical_or.reduce(reach(a, b)))
                    for place, ((least, most), mask) in enumerate(zip(limits, reach(low, high))):
                        at = np.flatnonzero(mask)
                        sure = (low[at] >= least) & (high[at] <= most)
                        found.append((np.full(len(at), own_row[i]), np.full(len(at), place), row[some[at]], low[at], high[at], sure))
        columns = [np.concatenate([f[j] for f in found]) for j in range(6)] if found else [[]] * 6
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["anchor", "place", "row", "low", "high", "sure"])

    keys = ["dims", "block", "tile"]
    schema = "anchor bigint, place int, row bigint, low double, high double, sure boolean"
    pairs = settle(scanned.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInArrow(run, schema), "pairs")
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("low"))
    sure = pairs.where("sure").select("anchor", "place", "low", F.row_number().over(order).alias("n")).where(F.col("n") <= k)
    bound = sure.groupBy("anchor", "place").agg(F.min("low").alias("bound"), F.count(F.lit(1)).alias("n"))
    bound = settle(bound.where(F.col("n") == k).select("anchor", "place", "bound"), "bounds")
    left = lookup_join(pairs, bound, ["anchor", "place"])
    return left.where("bound is null or high >= bound").select("anchor", "row").distinct()


def _scored(pairs: DataFrame, rows: DataFrame, anchors: DataFrame, scale: int) -> DataFrame:
    """anchor, row, vec_id, score: pairs with their integer scores."""
    known = lookup_join(pairs, rows.select("row", "vec_id", "x"), ["row"], "inner")
    asked = anchors.select(F.col("row").alias("anchor"), F.col("x").alias("q"))
    known = lookup_join(known, asked, ["anchor"], "inner").select("anchor", "row", "vec_id", "x", "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(3), batch.column(4)
            starts = a.offsets.to_numpy() - a.offsets[0].as_py()
            x, q = whole(a.flatten().to_numpy(), scale), whole(b.flatten().to_numpy(), scale)
            most = np.diff(starts).max(initial=0)
            if most * np.abs(x).max(initial=0) * np.abs(q).max(initial=0) < EXACT:
                sums = np.concatenate([[0], np.cumsum(x.astype(np.int64) * q.astype(np.int64))]) if len(x) else np.zeros(1, np.int64)
                scores = sums[starts[1:]] - sums[starts[:-1]]  # sums may wrap, their differences do not
            else:
                scores = [
                    max(-(2**63), min(2**63 - 1, sum(int(c) * int(d) for c, d in zip(x[i:j], q[i:j]))))
                    for i, j in zip(starts[:-1], starts[1:])
                ]
            columns = [batch.column(0), batch.column(1), batch.column(2), pa.array(scores, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "row", "vec_id", "score"])

    return known.mapInArrow(run, "anchor bigint, row bigint, vec_id bigint, score bigint")


def _numbers(count: int) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint"))


def mine(
    vectors: DataFrame, is_anchor: Column, label: Column, vec_id: str = "vec_id", embedding: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
    block_rows: int = BLOCK_ROWS, tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each row where `is_anchor`, its first positives of its `label` and for each of them the first negatives of
    other labels with low * positive_score <= 100 * negative_score <= high * positive_score.
    """
    slim = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        label.cast("int").alias("label"),
        F.col(embedding).cast("array<double>").alias("x"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    slim = slim.where(F.col("label").isNotNull() & usable(F.col("x"), scale)).withColumn("dims", F.size("x"))
    rows = settle(slim.withColumn("row", F.monotonically_increasing_id()), "vectors")
    copies = Window.partitionBy("x", "label").orderBy("vec_id", "row")
    few = rows.withColumn("_n", F.row_number().over(copies)).where(F.col("_n") <= max(positives + 1, negatives))
    codes = settle(_codes(few, scale), "codes")
    anchors = rows.where("is_anchor").select("row", "vec_id", "label", "dims", "x")
    blocks = max(1, -(-codes.count() // block_rows))
    tiles = max(1, -(-anchors.count() // tile_rows))

    alike = _near(codes, anchors, blocks, tiles, scale, True, positives)
    alike = _scored(alike, rows, anchors, scale)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id", "row")
    found = alike.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    found = settle(found.select("anchor", F.col("row").alias("positive"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    ends = [F.col("positive_score") * (end / 100) for end in (low, high)]
    spare = F.abs("positive_score") * 1e-12 + 1e-9
    band = F.struct((ends[0] - spare).alias("low"), (ends[1] + spare).alias("high"))
    bands = found.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(band).alias("bands"))
    banded = lookup_join(anchors, settle(bands, "bands"), ["row"], "inner")
    other = _scored(_near(codes, banded, blocks, tiles, scale, False, negatives), rows, anchors, scale)
    pairs = lookup_join(
        found.alias("p"), anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), ["anchor"], "inner"
    ).join(other.select("anchor", F.col("row").alias("negative"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")), "anchor")
    p, n = F.col("positive_score").cast("decimal(20,0)"), F.col("negative_score").cast("decimal(20,0)")
    pairs = pairs.where((low * p <= 100 * n) & (100 * n <= high * p))
    first = Window.partitionBy("anchor", "positive").orderBy(F.desc("negative_score"), "negative_id", "negative")
    ranked = pairs.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
