"""Byte-level BPE: text to token ids by a rank file, and back.

A pre-token that is a whole vocabulary entry is resolved by a minimal perfect hash (hash and displace). Any other
is merged byte by byte: its parts form a linked list over the bytes, and a heap hands out the pair of the lowest
rank, leftmost first. Results of pre-tokens are remembered in a table of bounded size per task process.

Null and empty texts have no ids. Repeated rows are encoded alike. All other columns pass through; a column that
already has the name of the output is replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import heapq
import sys
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import types as T

register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed

MEMO_ENTRIES = 250_000  # pre-tokens remembered by one task process
MEMO_LENGTH = 64  # longer pre-tokens are encoded each time
SLICE_BYTES = 4 * 1024 * 1024  # text encoded before its ids leave Python
MASK = 2**64 - 1


def _slot(digest: int, displacement: int, size: int) -> int:
    mixed = (digest ^ (displacement * 0x9E3779B97F4A7C15)) & MASK
    mixed = ((mixed ^ (mixed >> 31)) * 0xBF58476D1CE4E5B9) & MASK
    return (mixed ^ (mixed >> 29)) % size


class PerfectHash:
    """Each of `keys` to its own place among len(keys) places; a foreign key is told by comparing."""

    def __init__(self, keys: list[bytes]):
        self.size = len(keys)
        self.buckets = max(1, self.size)
        self.shift = [0] * self.buckets  # d >= 0: displacement; below: place -d - 1 of a bucket's only key
        self.keys: list[bytes | None] = [None] * self.size
        self.place: dict[bytes, int] = {}
        members: list[list[tuple[int, bytes]]] = [[] for _ in range(self.buckets)]
        for key in keys:
            digest = xxhash.xxh3_64_intdigest(key)
            members[digest % self.buckets].append((digest, key))
        order = sorted(range(self.buckets), key=lambda b: -len(members[b]))
        for bucket in (b for b in order if len(members[b]) > 1):
            displacement = 0
            while True:
                places = [_slot(digest, displacement, self.size) for digest, _ in members[bucket]]
                if len(set(places)) == len(places) and all(self.keys[p] is None for p in places):
                    break
                displacement += 1
            self.shift[bucket] = displacement
            for place, (_, key) in zip(places, members[bucket], strict=True):
                self.keys[place] = key
        free = iter([p for p, key in enumerate(self.keys) if key is None])
        for bucket in (b for b in order if len(members[b]) == 1):
            place = next(free)
            self.shift[bucket] = -place - 1
            self.keys[place] = members[bucket][0][1]

    def find(self, key: bytes) -> int:
        """Place of the key, or -1."""
        if not self.size:
            return -1
        digest = xxhash.xxh3_64_intdigest(key)
        shift = self.shift[digest % self.buckets]
        place = _slot(digest, shift, self.size) if shift >= 0 else -shift - 1
        return place if self.keys[place] == key else -1


class Vocabulary:
    """Ranks of a file with one `base64 rank` line per token, the pattern that cuts texts, and both lookups."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = pattern
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=0)
        self.table = PerfectHash(list(ranks))
        self.ids = [ranks[key] for key in self.table.keys]
        self.memo: dict[str, tuple[int, ...]] = {}

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token that is no vocabulary entry itself."""
        ranks, longest, size = self.ranks, self.longest, len(piece)
        end = list(range(1, size + 1))  # end of the part that begins here, 0 where no part begins any more
        before = list(range(-1, size - 1))  # where the part to the left begins
        heap = []
        for start in range(size - 1):
            rank = ranks.get(piece[start : start + 2])
            if rank is not None:
                heap.append((rank, start, start + 2))
        heapq.heapify(heap)
        while heap:
            _, start, stop = heapq.heappop(heap)
            middle = end[start]
            if not middle or middle >= size or end[middle] != stop:
                continue  # one of both parts has changed since
            end[start], end[middle] = stop, 0
            if stop < size:
                before[stop] = start
                if end[stop] - start <= longest:
                    rank = ranks.get(piece[start : end[stop]])
                    if rank is not None:
                        heapq.heappush(heap, (rank, start, end[stop]))
            left = before[start]
            if left >= 0 and stop - left <= longest:
                rank = ranks.get(piece[left:stop])
                if rank is not None:
                    heapq.heappush(heap, (rank, left, stop))
        out, start = [], 0
        while start < size:
            out.append(ranks[piece[start : end[start]]])
            start = end[start]
        return out

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of one pre-token."""
        raw = text.encode()
        place = self.table.find(raw)
        return (self.ids[place],) if place >= 0 else tuple(self.merge(raw))


class _Memo(dict):
    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, text: str) -> tuple[int, ...]:
        ids = self.vocabulary.piece(text)
        if len(text) <= MEMO_LENGTH:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[text] = ids
        return ids


def _replaced(df: DataFrame, name: str, kind: T.DataType) -> tuple[list[str], T.StructType]:
    kept = [c for c in df.columns if c != name]
    return kept, T.StructType([*(df.schema[c] for c in kept), T.StructField(name, kind)])


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", out: str = "ids") -> DataFrame:
    """Adds the token ids of `text` as an array of integers; special tokens are never recognised."""
    kept, schema = _replaced(df, out, T.ArrayType(T.IntegerType(), False))
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = regex.compile(shared.value.pattern).findall
        look = _Memo(shared.value).__getitem__
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            sizes = np.cumsum(np.frombuffer(_lengths(column), dtype=np.int64)) // SLICE_BYTES
            for start, stop in _runs(sizes):
                found = [
                    list(chain.from_iterable(map(look, words(value)))) if value else []
                    for value in column.slice(start, stop - start).to_pylist()
                ]
                offsets = np.zeros(len(found) + 1, dtype=np.int32)
                np.cumsum([len(ids) for ids in found], out=offsets[1:])
                flat = np.fromiter(chain.from_iterable(found), dtype=np.int32, count=offsets[-1])
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                rest = [batch.column(batch.schema.get_field_index(c)).slice(start, stop - start) for c in kept]
                yield pa.RecordBatch.from_arrays([*rest, ids], names=[*kept, out])

    needed = df if text in kept else df.withColumnRenamed(out, text)
    return needed.mapInArrow(run, schema)


def _lengths(column: pa.Array) -> bytes:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column).cast(pa.int64()), 0).to_numpy(zero_copy_only=False).tobytes()


def _runs(groups: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of equal neighbours."""
    if not len(groups):
        return []
    cuts = np.flatnonzero(np.diff(groups)) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(groups)]))


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes of an array of ids; a null array has none, an id outside the vocabulary is an error."""
    kept, schema = _replaced(df, out, T.BinaryType())
    tokens = [b""] * (max(vocabulary.ranks.values(), default=-1) + 1)
    for token, rank in vocabulary.ranks.items():
        tokens[rank] = token
    shared = df.sparkSession.sparkContext.broadcast(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            rest = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            texts = []
            for value in column:
                numbers = value.values
                texts.append(b"" if numbers is None else b"".join(map(token, numbers.to_numpy().tolist())))
            yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.binary())], names=[*kept, out])

    return df.mapInArrow(run, schema)
