"""Word shingles of whole texts as 64-bit hashes, computed on the bytes of Arrow batches.

Texts are lower-cased in A-Z and cut into words at the bytes 0x09-0x0D and 0x20. A shingle is a run of `width`
words; a text with fewer words is one shingle of all its words, a text without words has none.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed

PIECE_BYTES = 1024 * 1024  # bytes hashed at a time
BASE = 0x9E3779B97F4A7C15 | 1  # odd, so it has an inverse
MASK = 2**64 - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, size: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < size:
        known = np.full(size, base, dtype=np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if size <= 4 * PIECE_BYTES:
            _POWERS[base] = known
    return known[:size]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def _blank(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def _spans(data: np.ndarray, starts: np.ndarray):
    """Where the words of one piece begin, their lengths, and the sums and inverse powers that hash them."""
    inside = ~_blank(data)
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edge = starts[(starts > 0) & (starts < len(data))]
    opens[edge] = inside[edge]
    closes[edge - 1] = inside[edge - 1]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(data)), out=sums[1:])
    return begin, end - begin, sums, _powers(pow(BASE, -1, 2**64), len(data))


def word_spans(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple]:
    """Per piece of the bytes: ((begins in the piece, begins in all), lengths, sums, inverse powers).

    Pieces end at a blank byte or at the end; no word spans one of `starts`. The hash of the bytes from b to e is
    (sums[e] - sums[b]) * inverse[b].
    """
    at = 0
    while at < len(data):
        stop = min(len(data), at + PIECE_BYTES)
        while stop < len(data) and not _blank(data[stop : stop + 1])[0]:
            found = np.flatnonzero(_blank(data[stop : stop + PIECE_BYTES]))
            stop = stop + int(found[0]) if len(found) else min(len(data), stop + PIECE_BYTES)
        begin, length, sums, inverse = _spans(data[at:stop], starts[(starts > at) & (starts < stop)] - at)
        yield (begin, begin + at), length, sums, inverse
        at = stop


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in the bytes, and where they begin."""
    hashes, places = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for (begin, place), length, sums, inverse in word_spans(lowered(data), starts):
        hashes.append(mixed((sums[begin + length] - sums[begin]) * inverse[begin]))
        places.append(place)
    return np.concatenate(hashes), np.concatenate(places)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    texts = texts.cast(pa.large_binary())
    size = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=size + 1, offset=texts.offset * 8)
    whole = texts.buffers()[2]
    buffer = np.frombuffer(whole, dtype=np.uint8) if whole is not None and whole.size else np.empty(0, np.uint8)
    at = 0
    while at < size:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE_BYTES, "right")) - 1)
        bounds = offsets[at : to + 1] - offsets[at]
        hashed, begin = word_hashes(buffer[offsets[at] : offsets[to]], bounds[:-1])
        cut = np.searchsorted(begin, bounds)
        joined = hashed
        for step in range(1, width):
            joined = mixed(joined[:-1] * np.uint64(BASE) + hashed[step:]) if len(joined) > 1 else joined[:0]
        for i in range(to - at):
            first, last = int(cut[i]), int(cut[i + 1])
            words = last - first
            if not words:
                yield np.empty(0, np.uint64)
            elif words < width:
                short = np.uint64(words)
                for h in hashed[first:last]:
                    short = mixed(np.array([(int(short) * BASE + int(h)) & MASK], np.uint64))[0]
                yield np.array([short], np.uint64)
            else:
                yield np.unique(joined[first : last - width + 1])
        at = to
