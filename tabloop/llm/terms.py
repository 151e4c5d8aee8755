"""A sparse document-term matrix: words encoded by one dictionary of the whole table, rows in CSR shards.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; case counts. The first pass cuts the rows into shards
of bounded size and encodes each by its own words: row bounds, word numbers, counts. The words of a shard, ordered by
checksum, are then dealt to buckets by ranges of that checksum, in one piece per shard and bucket. A bucket numbers its
distinct words; the numbers go back to the shards. A word that every document holds is one entry per shard in one
bucket, so no word makes a large task; the number of buckets follows the number of entries, so their size is bounded.

Number of a word: (bucket << 32) + its place in the bucket. Numbers are unique, not dense. A null or empty text is a row
without words. Texts are taken in pieces, so a very long text needs memory for its distinct words only. Repeated rows
are rows of their own. An empty table gives no shards. Kept columns may have any names but those of the matrix.

A task holds one large shard at a time, however many it makes or reads: it ends its row group, rows reach Python in
batches of bounded size (`storage.arrow_batches`), and the rows of a shard are counted in parts of bounded size.
"""

from __future__ import annotations

import itertools
import re
import sys
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloop.storage import arrow_batches, settle

register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed

SHARD_BYTES = 8 * 1024 * 1024  # of text
PIECE_BYTES = 1024 * 1024  # of a text that are split at a time
BUCKET_WORDS = 131_072  # entries (word of a shard) numbered by one task
COUNT_ENTRIES = 131_072  # entries of a shard's rows that are counted at a time
#: A row group ends with the shard that takes it to 1 MB; Spark reads no more than one group at a time.
GROUP_PER_ROW = {"parquet.block.size": 1 << 20, "parquet.page.size.row.check.min": 1, "parquet.block.size.row.check.min": 1}
BLANK = re.compile(rb"[\x20\x09-\x0D]")
OWN = ("shard", "indptr", "indices", "data")


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """A text in parts that end at blanks."""
    at = 0
    while at < len(text):
        end = BLANK.search(text, at + size) if len(text) - at > size else None
        stop = end.end() if end else len(text)
        yield text[at:stop]
        at = stop


class Shard:
    """Rows that are encoded by their own words."""

    def __init__(self) -> None:
        self.codes: dict[bytes, int] = defaultdict(itertools.count().__next__)
        self.rows: list[tuple[np.ndarray, np.ndarray]] = []
        self.kept: list[pa.RecordBatch] = []
        self.bytes = 0

    def add(self, text: bytes | None) -> None:
        parts = []
        for piece in pieces(text or b""):
            words = piece.split()  # at exactly the bytes 0x20 and 0x09-0x0D
            parts.append(np.unique(np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words)), return_counts=True))
        if len(parts) > 1:
            found, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            parts = [(found, np.bincount(back, np.concatenate([p[1] for p in parts])).astype(np.int64))]
        found, times = parts[0] if parts else (np.empty(0, np.int64), np.empty(0, np.int64))
        self.rows.append((found.astype(np.int32), times.astype(np.int32)))
        self.bytes += len(text or b"")

    def keep(self, columns: pa.RecordBatch) -> None:
        """A copy, as a part of a batch holds all of its memory, with the texts."""
        self.kept.append(columns.take(pa.array(range(columns.num_rows), pa.int64())))

    def table(self, number: int, schema: pa.Schema) -> pa.RecordBatch:
        """One row, its words in the order of their checksums."""
        words = list(self.codes)
        order = np.argsort(np.fromiter(map(zlib.crc32, words), np.int64, len(words)), kind="stable")
        rank = np.empty(len(words), np.int32)
        rank[order] = np.arange(len(words), dtype=np.int32)
        kept = pa.Table.from_batches(self.kept).combine_chunks()
        values = {
            "shard": number,
            "indptr": np.cumsum([0, *(len(c) for c, _ in self.rows)]).astype(np.int32),
            "codes": rank[np.concatenate([c for c, _ in self.rows])],
            "data": np.concatenate([n for _, n in self.rows]),
            "n_words": len(words),
            "words": b" ".join(words[i] for i in order),
        }
        columns = []
        for field in schema:
            if field.name in values and field.name not in kept.column_names:
                value = values[field.name]
                own = _listed(pa.array(value), field.type) if isinstance(value, np.ndarray) else pa.array([value], field.type)
            else:
                own = _listed(kept.column(field.name).combine_chunks(), field.type)
            columns.append(own)
        return pa.RecordBatch.from_arrays(columns, schema=schema)


def _listed(values: pa.Array, kind: pa.DataType) -> pa.Array:
    """All values as the one list of a row."""
    if isinstance(values, pa.ChunkedArray):
        values = values.chunk(0) if values.num_chunks else pa.array([], values.type)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(kind.value_type)).cast(kind)


def local_shards(docs: DataFrame, text: str, keep: Sequence[str], shard_bytes: int) -> DataFrame:
    """One row per shard: the kept columns as lists, and its rows by the shard's own words."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    names = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(*(F.col(c).alias(n) for n, c in zip(names, keep)), F.col(text).cast("string").cast("binary").alias("text"))
    lists = [T.StructField(n, T.ArrayType(rows.schema[n].dataType)) for n in names]
    own = "shard bigint, indptr array<int>, codes array<int>, data array<int>, n_words int, words binary"
    schema = T.StructType([*lists, *T._parse_datatype_string(own)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        shard, made = Shard(), 0
        for batch in batches:
            texts = batch.column(len(names))
            begin = 0
            for i in range(len(texts)):
                shard.add(texts[i].as_py())
                if shard.bytes >= shard_bytes:
                    shard.keep(batch.select(names).slice(begin, i + 1 - begin))
                    whole = shard.table(first + made, arrow)
                    shard, made, begin = Shard(), made + 1, i + 1
                    yield whole
                    del whole
                    pa.default_memory_pool().release_unused()
            if begin < len(texts):
                shard.keep(batch.select(names).slice(begin))
        if shard.rows:
            yield shard.table(first + made, arrow)

    return rows.mapInArrow(run, schema)


def _dealt(shards: DataFrame, buckets: int) -> DataFrame:
    """bucket, shard, start, words: each shard's words cut by ranges of their checksums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = blob.as_py().split(b" ") if len(blob.as_py()) else []
                bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) * buckets >> 32
                starts = np.flatnonzero(np.diff(bucket, prepend=-1))
                ends = [*starts[1:], len(words)]
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(bucket[starts]), "shard": pa.array([shard] * len(starts), pa.int64()),
                    "start": pa.array(starts, pa.int32()),
                    "words": pa.array([b" ".join(words[a:b]) for a, b in zip(starts, ends)], pa.binary()),
                })

    return shards.select("shard", "words").mapInArrow(run, "bucket bigint, shard bigint, start int, words binary")


def _number(group: pa.Table) -> pa.Table:
    """The numbers of the words of one bucket for each shard; a row without a shard lists the bucket's words."""
    bucket = group.column("bucket")[0].as_py()
    numbers: dict[bytes, int] = defaultdict(itertools.count(bucket << 32).__next__)
    ids = [[numbers[w] for w in blob.as_py().split(b" ")] for blob in group.column("words")]
    return pa.table({
        "bucket": pa.array([bucket] * (len(ids) + 1), pa.int64()),
        "shard": pa.array([*group.column("shard").to_pylist(), None], pa.int64()),
        "start": pa.array([*group.column("start").to_pylist(), None], pa.int32()),
        "ids": pa.array([*ids, None], pa.list_(pa.int64())),
        "words": pa.array([*[None] * len(ids), b" ".join(numbers)], pa.binary()),
    })


def matrix(
    docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), shard_bytes: int = SHARD_BYTES,
    bucket_words: int = BUCKET_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """(shards, dictionary): the kept columns as lists with shard, indptr, indices and data; and word, id."""
    if set(keep) & set(OWN):
        raise ValueError(f"columns named {OWN} cannot be kept")
    spark = docs.sparkSession
    with arrow_batches(spark):
        local = settle(local_shards(docs, text, keep, shard_bytes), "shards", **GROUP_PER_ROW)
    total = local.agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("n")).first().n
    dealt = _dealt(local, max(1, -(-total // bucket_words)))
    kinds = "bucket bigint, shard bigint, start int, ids array<bigint>, words binary"
    with arrow_batches(spark):
        numbered = settle(dealt.groupBy("bucket").applyInArrow(_number, kinds), "numbered")
    names = [f"k{i}" for i in range(len(keep))]
    whole = local.select("shard", *names, "indptr", "codes", "data")
    from pyspark.sql import types as T

    fields = [T.StructField(c, local.schema[n].dataType) for c, n in zip(keep, names)]
    out = T.StructType([*fields, *T._parse_datatype_string("shard bigint, indptr array<int>, indices array<bigint>, data array<int>")])

    def encoded(shard: pa.Table, ids: pa.Table) -> pa.Table:
        order = np.argsort(ids.column("start").to_numpy())
        parts = ids.column("ids").combine_chunks()
        known = [parts[int(i)].values.to_numpy() for i in order]
        known = np.concatenate(known) if known else np.empty(0, np.int64)
        codes = shard.column("codes").combine_chunks()[0].values.to_numpy()
        indices = _listed(pa.array(known[codes]), pa.list_(pa.int64()))
        given = {n: shard.column(n) for n in shard.column_names}
        return pa.table([*(given[n] for n in names), given["shard"], given["indptr"], indices, given["data"]], names=out.names)

    parts = numbered.where("shard is not null").select("shard", "start", "ids")
    shards = whole.groupBy("shard").cogroup(parts.groupBy("shard")).applyInArrow(encoded, out)
    listed = numbered.where("shard is null and length(words) > 0").select("bucket", F.split(F.col("words").cast("string"), " ").alias("w"))
    listed = listed.select("bucket", F.posexplode("w").alias("at", "word"))
    return shards, listed.select("word", (F.shiftleft("bucket", 32) + F.col("at")).alias("id"))


def _parts(bounds: np.ndarray, entries: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold so many entries at most, or a single row."""
    first = 0
    while first < len(bounds) - 1:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + entries, side="right")) - 1)
        yield first, last
        first = last


def shard_counts(bounds: np.ndarray, indices: np.ndarray, data: np.ndarray, entries: int = COUNT_ENTRIES) -> tuple[np.ndarray, np.ndarray]:
    """The sum of the data and the number of distinct indices of every row of a shard."""
    words, distinct = np.zeros(len(bounds) - 1, np.int64), np.zeros(len(bounds) - 1, np.int64)
    for first, last in _parts(bounds, entries):
        own = slice(bounds[first], bounds[last])
        at = bounds[first : last + 1] - bounds[first]
        sums = np.concatenate([[0], np.cumsum(data[own], dtype=np.int64)])
        owner = np.repeat(np.arange(last - first), np.diff(at))
        order = np.lexsort((indices[own], owner))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (np.diff(indices[own][order]) != 0) | (np.diff(owner[order]) != 0)
        words[first:last] = sums[at[1:]] - sums[at[:-1]]
        distinct[first:last] = np.bincount(owner[order][fresh], minlength=last - first)
    return words, distinct


def row_counts(shards: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The kept columns of every row with its `words` (row sum) and `distinct_words` (nonzero columns)."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = [T.StructField(c, shards.schema[c].dataType.elementType) for c in keep]
    schema = T.StructType([*fields, *T._parse_datatype_string("words bigint, distinct_words bigint")])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(j)[i].values for j, n in enumerate(batch.schema.names)}
                counts = shard_counts(*(row[n].to_numpy() for n in OWN[1:]))
                yield pa.RecordBatch.from_arrays([row[c].cast(f.type) for c, f in zip(keep, arrow)] + [*map(pa.array, counts)], schema=arrow)

    return shards.select(*keep, "indptr", "indices", "data").mapInArrow(run, schema)
