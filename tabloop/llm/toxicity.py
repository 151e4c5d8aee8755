"""Toxicity scores by a factorisation machine over hashed terms.

A text's terms are its words and the first four and five bytes of its words, hashed to a fixed number of places; A-Z
are lower-cased and all other ASCII bytes but digits and letters separate words. Of the labelled sample's places
those that depart most from independence of the label are kept (G statistic), at most `FEATURES`. The machine adds
to the linear weights the inner products of every two terms' factor vectors, so a pair of terms can weigh what
neither does alone. Fitting is seeded and takes the same steps for the same sample.

Null and empty texts have no terms and get the machine's constant. A sample without both labels gives every text the
share of label 1. Repeated rows are scored alike; extra columns pass through, and columns named as the outputs are
replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloop.llm.labelled import SAMPLE_ROWS, sample
from tabloop.llm.shingles import BASE, PIECE_BYTES, mixed, word_spans

register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed

PLACES = 2**20
FEATURES = 4096
LEAST_G = 12.0
LEAST_ROWS = 5  # of the sample, that have a kept term
FACTORS = 8
EPOCHS = 12
LEAST_STEPS = 2000  # small samples are gone through more often
BATCH = 128
RATE = 0.02
DECAY = 1e-4
PREFIXES = (4, 5)
THRESHOLD = 0.7

#: A-Z to a-z; other ASCII bytes but a-z and 0-9 to a blank.
FOLD = np.array(
    [c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256)], np.uint8
)


def term_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct places of each text's terms."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1, offset=texts.offset * 8)
    whole = texts.buffers()[2]
    buffer = np.frombuffer(whole, dtype=np.uint8) if whole is not None and whole.size else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE_BYTES, "right")) - 1)
        bounds = offsets[at : to + 1] - offsets[at]
        kinds, places = [], []
        for begin, length, sums, inverse in word_spans(FOLD[buffer[offsets[at] : offsets[to]]], bounds[:-1]):
            found = []
            for kind, size in enumerate((None, *PREFIXES)):
                end = begin[0] + (length if size is None else np.minimum(length, size))
                raw = (sums[end] - sums[begin[0]]) * inverse[begin[0]]
                found.append((mixed(raw * np.uint64(BASE) + np.uint64(kind)) % np.uint64(PLACES)).astype(np.int32))
            places.append(np.stack(found))
            kinds.append(begin[1])
        place = np.concatenate(places, axis=1) if places else np.empty((1 + len(PREFIXES), 0), np.int32)
        starts = np.concatenate(kinds) if kinds else np.empty(0, np.int64)
        cut = np.searchsorted(starts, bounds)
        for i in range(to - at):
            yield np.unique(place[:, cut[i] : cut[i + 1]])
        at = to


class Machine:
    """Kept places, constant, weights and factors."""

    def __init__(self, place: np.ndarray, constant: float, weights: np.ndarray, factors: np.ndarray):
        self.index = np.full(PLACES, -1, dtype=np.int32)
        self.index[place] = np.arange(len(place), dtype=np.int32)
        self.constant, self.weights, self.factors = constant, weights, factors

    def score(self, places: np.ndarray) -> float:
        known = self.index[places]
        known = known[known >= 0]
        v = self.factors[known]
        both = 0.5 * float((v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum())
        margin = self.constant + float(self.weights[known].sum()) + both
        return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def fit_machine(rows: list[np.ndarray], labels: np.ndarray, size: int, seed: int = 17):
    """Constant, weights and factors by Adam on the logistic loss; `rows` hold indices below `size`."""
    draw = np.random.default_rng(seed)
    share = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    parts = [np.full(1, np.log(share / (1 - share))), np.zeros(size), draw.normal(0, 0.01, (size, FACTORS))]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    step = 0
    epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // max(len(rows), 1)))
    for _ in range(epochs if size else 0):
        order = draw.permutation(len(rows))
        for begin in range(0, len(order), BATCH):
            some = order[begin : begin + BATCH]
            x = np.zeros((len(some), size))
            for i, r in enumerate(some):
                x[i, rows[r]] = 1
            constant, weights, factors = parts
            inner = x @ factors
            margin = constant + x @ weights + 0.5 * (inner**2 - x @ (factors**2)).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[some]) / len(some)
            by_term = x.T @ error
            slopes = [
                error.sum(keepdims=True),
                by_term + DECAY * weights,
                x.T @ (error[:, None] * inner) - by_term[:, None] * factors + DECAY * factors,
            ]
            step += 1
            for p, a, b, g in zip(parts, first, second, slopes):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return float(parts[0][0]), parts[1], parts[2]


def dependence(n: np.ndarray, positive: np.ndarray, rows: int, positives: int) -> np.ndarray:
    """G statistic of each term against the label."""
    table = [(positive, n * positives), (n - positive, n * (rows - positives)),
             (positives - positive, (rows - n) * positives), (rows - n - positives + positive, (rows - n) * (rows - positives))]
    total = np.zeros(len(n))
    for seen, product in table:
        expected = product / max(rows, 1)
        total += np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0.0)
    return 2 * total


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS) -> Machine:
    """Machine from at most `rows` labelled documents that are not held out.

    The driver gets the kept terms (at most FEATURES) and the places of those terms in the sample's texts.
    """
    labelled = sample(docs, labels, label, rows)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, positive = np.zeros(PLACES, np.int64), np.zeros(PLACES, np.int64)
        for batch in batches:
            marks = batch.column(1).to_numpy(zero_copy_only=False)
            for mark, places in zip(marks, term_sets(batch.column(0))):
                n[places] += 1
                if mark:
                    positive[places] += 1
        found = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(n[found]), pa.array(positive[found])], names=["place", "n", "positive"]
        )

    total = labelled.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("p")).first()
    if not total.n or total.p in (0, total.n):
        share = min(max(total.p / total.n if total.n else 0.5, 1e-3), 1 - 1e-3)
        empty = np.empty(0, np.int64)
        return Machine(empty, float(np.log(share / (1 - share))), np.empty(0), np.empty((0, FACTORS)))
    counts = labelled.mapInArrow(counted, "place bigint, n bigint, positive bigint").groupBy("place")
    counts = counts.agg(F.sum("n").alias("n"), F.sum("positive").alias("positive")).where(F.col("n") >= LEAST_ROWS)
    kept = _strongest(counts, total.n, total.p)
    index = np.full(PLACES, -1, dtype=np.int32)
    index[kept] = np.arange(len(kept), dtype=np.int32)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows_ = [index[places] for places in term_sets(batch.column(0))]
            rows_ = [np.sort(r[r >= 0]).tolist() for r in rows_]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows_, pa.list_(pa.int32())), batch.column(1)], names=["terms", "label"]
            )

    found = sorted((tuple(r.terms), r.label) for r in labelled.mapInArrow(known, "terms array<int>, label int").collect())
    terms = [np.array(t, dtype=np.int64) for t, _ in found]
    return Machine(kept, *fit_machine(terms, np.array([float(y) for _, y in found]), len(kept)))


def _strongest(counts: DataFrame, rows: int, positives: int) -> np.ndarray:
    """Places of the FEATURES terms that depart most from independence; only those reach the driver."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, positive = (batch.column(i).to_numpy().astype(np.float64) for i in (1, 2))
            g = dependence(n, positive, rows, positives)
            made = pa.RecordBatch.from_arrays([batch.column(0), pa.array(g)], names=["place", "g"])
            yield made.filter(pa.array(g >= LEAST_G))

    top = counts.mapInArrow(judged, "place bigint, g double").orderBy(F.desc("g"), "place").limit(FEATURES)
    return np.array(sorted(r.place for r in top.collect()), dtype=np.int64)


def score(docs: DataFrame, machine: Machine, text: str = "text", out: str = "score") -> DataFrame:
    """Adds the probability of label 1."""
    kept = [c for c in docs.columns if c != out]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(out, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            scores = pa.array([shared.value.score(places) for places in term_sets(texts)], pa.float64())
            rest = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*rest, scores], names=[*kept, out])

    return docs.mapInArrow(run, schema)
