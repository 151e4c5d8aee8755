"""Exact search of the k highest inner products by vector approximations.

Vectors are dealt into blocks. A task gets one block and one block of queries. It quantises the block's components
into cells, scans the cells for an upper and a lower bound of every score, and reads exact vectors in the order of
their upper bounds until the k-th best score exceeds the next bound. Only the best k of a query and block leave the
task. The result equals brute force.

Components x become floor(scale * x), with x as double. Vectors that are null, empty or hold a null or non-finite
component take no part; only vectors of one length are compared with each other. Rows may repeat an identifier:
every row is a candidate of its own, and a query's own row (not its copies) is left out. A null identifier is kept
and sorts first. Scores beyond a 64-bit integer are held at its ends. Extra columns are ignored. Ties go to the
smaller identifier.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloop.storage import settle

register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed

K = 20
SCALE = 64
CELLS = 16  # per component
BLOCK_ROWS = 4096
QUERY_ROWS = 2048
TILE_ROWS = 256  # queries whose bounds are held at a time
READ_ROWS = 32  # exact vectors read at a time
EXACT = 2.0**52  # doubles below are exact integers

FOUND = "query_row bigint, query_id bigint, vec_id bigint, vec_row bigint, score bigint"


def best(vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int):
    """For each query the places and scores of its best k vectors of one block."""
    if len(vectors) == 0 or len(queries) == 0:
        return
    top = float(np.abs(vectors).max(initial=1)) * float(np.abs(queries).max(initial=1)) * vectors.shape[1]
    exact = vectors.astype(np.float64)
    if top >= EXACT:
        exact, wide = vectors.astype(object), queries.astype(object)
    else:
        wide = queries.astype(np.float64)
    low = vectors.min(axis=0).astype(np.float64)
    width = np.maximum((vectors.max(axis=0).astype(np.float64) - low + 1) / CELLS, 1e-9)
    cells = np.clip((vectors - low) // width, 0, CELLS - 1).astype(np.uint8)
    slack = np.abs(vectors).max(initial=1) * 1e-9 if top >= EXACT else 0.0
    floor_ = np.ceil(low + cells * width - 1e-6) - slack  # least and greatest integer of a cell
    ceiling = np.floor(low + (cells + 1.0) * width + 1e-6) + slack
    for begin in range(0, len(queries), TILE_ROWS):
        part = queries[begin : begin + TILE_ROWS].astype(np.float64)
        up, down = np.maximum(part, 0), np.minimum(part, 0)
        upper = up @ ceiling.T + down @ floor_.T
        lower = up @ floor_.T + down @ ceiling.T
        if top >= EXACT:
            error = top * 1e-9
            upper, lower = upper + error, lower - error
        for q in range(len(part)):
            at = begin + q
            allowed = rows != own[at]
            count = int(allowed.sum())
            if not count:
                continue
            sure = lower[q][allowed]
            least = np.partition(sure, count - k)[count - k] if count > k else -np.inf
            some = np.flatnonzero(allowed & (upper[q] >= least))
            some = some[np.argsort(-upper[q][some], kind="stable")]
            scores: list = []
            read = 0
            while read < len(some):
                step = some[read : read + READ_ROWS]
                scores.extend((exact[step] @ wide[at]).tolist())
                read += len(step)
                if len(scores) >= k and read < len(some):
                    kth = sorted(scores, reverse=True)[k - 1]
                    if kth > upper[q][some[read]]:
                        break
            found = sorted(zip((-s for s in scores), ids[some[:read]].tolist(), some[:read].tolist()))[:k]
            for negative, _, place in found:
                yield at, place, max(-(2**63), min(2**63 - 1, int(-negative)))


def usable(vector: Column) -> Column:
    """Whether all components are finite numbers."""
    x = vector
    return (
        x.isNotNull()
        & (F.size(x) > 0)
        & F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))), F.lit(False))
    )


def search(
    vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K,
    scale: int = SCALE, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row where `is_query` its best k of all other rows."""
    slim = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(embedding).cast("array<double>").alias("x"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    rows = settle(slim.where(usable(F.col("x"))).withColumn("row", F.monotonically_increasing_id()), "vectors")
    rows = rows.withColumn("dims", F.size("x"))
    count = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("q")).first()
    blocks, tiles = max(1, -(-count.n // block_rows)), max(1, -(-count.q // query_rows))
    place = F.xxhash64("row")
    asked = rows.where("is_query").select(
        F.lit(True).alias("asked"), "vec_id", "row", "x", "dims",
        F.pmod(place, F.lit(tiles)).alias("tile"),
        F.explode(_numbers(blocks)).alias("block"),
    )
    scanned = rows.select(
        F.lit(False).alias("asked"), "vec_id", "row", "x", "dims",
        F.explode(_numbers(tiles)).alias("tile"),
        F.pmod(place, F.lit(blocks)).alias("block"),
    )

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        dims = group.column("dims")[0].as_py()
        flat = group.column("x").combine_chunks().flatten().to_numpy().reshape(-1, dims)
        whole = np.floor(flat * scale)
        whole = whole.astype(np.int64) if np.abs(whole).max(initial=0) < 2**62 else _integers(whole)
        asks = group.column("asked").to_numpy(zero_copy_only=False)
        row, name = group.column("row").to_numpy(), group.column("vec_id")
        order = name.to_pandas().fillna(-(2**63)).to_numpy().astype(np.int64) if name.null_count else name.to_numpy()
        at_q, at_v = np.flatnonzero(asks), np.flatnonzero(~asks)
        hits = list(best(whole[at_v], order[at_v], row[at_v], whole[at_q], row[at_q], k))
        q = at_q[[h[0] for h in hits]] if hits else np.empty(0, np.int64)
        v = at_v[[h[1] for h in hits]] if hits else np.empty(0, np.int64)
        return pa.table(
            {
                "query_row": row[q], "query_id": name.take(pa.array(q)), "vec_id": name.take(pa.array(v)),
                "vec_row": row[v], "score": pa.array([h[2] for h in hits], pa.int64()),
            }
        )

    found = asked.unionByName(scanned).groupBy("block", "tile", "dims").applyInArrow(run, FOUND)
    first = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "vec_row")
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _numbers(count: int) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint"))


def _integers(values: np.ndarray) -> np.ndarray:
    """Python integers, for components that no 64-bit integer holds."""
    return np.array([[int(c) for c in row] for row in values], dtype=object)
