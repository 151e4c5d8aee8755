"""Quality by hierarchical empirical Bayes: a document's own evidence and what its host and path have shown.

The classifier is a logistic model over binned measures of the text (lengths, letter cases, digits, symbols, repeated
words and lines). Its probabilities are summed by host and by path below the host. A host's rate of good documents
is drawn towards the global rate, a path's rate towards its host's, each with a strength taken from the data: the
between-group variance that is left beside the sampling variance (method of moments). Sparse sites therefore stay
near their parent. A document is judged by the log-odds of its own probability plus those of its path's rate without
itself, less those of the global rate.

Only group totals are shuffled, combined before the shuffle; a hot host is a row like any other. Null and empty
texts have measures of zero. Null hosts and paths are groups of their own. Rows may repeat; each counts. Without
both labels in the sample every text gets the share of label 1. Columns with the names of the outputs are replaced,
others pass through. An empty table gives an empty table.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloop.llm.labelled import SAMPLE_ROWS, sample
from tabloop.llm.shingles import PIECE_BYTES, _blank, lowered, mixed, word_spans
from tabloop.operators.skew import lookup_join
from tabloop.storage import settle

register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed

MEASURES = (
    "words", "word_length", "distinct_words", "top_word", "repeats_before", "capitals", "digits", "symbols",
    "bare_symbols", "marked_words", "wide_bytes", "lines", "line_words", "longest_word",
)
BINS = 16
RIDGE = 1.0
THRESHOLD = 0.5
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1e6
EDGE = 1e-6  # probabilities are held this far from 0 and 1


def measures(texts: pa.Array) -> np.ndarray:
    """One row of MEASURES per text."""
    texts = texts.cast(pa.large_binary())
    size = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=size + 1, offset=texts.offset * 8)
    whole = texts.buffers()[2]
    buffer = np.frombuffer(whole, dtype=np.uint8) if whole is not None and whole.size else np.empty(0, np.uint8)
    out = np.zeros((size, len(MEASURES)))
    at = 0
    while at < size:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE_BYTES, "right")) - 1)
        data, bounds = buffer[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        out[at:to] = _measured(data, bounds)
        at = to
    return out


def _measured(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    lower = lowered(data)
    hashes, begins, lengths = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for (begin, place), length, sums, inverse in word_spans(lower, bounds[:-1]):
        hashes.append(mixed((sums[begin + length] - sums[begin]) * inverse[begin]))
        begins.append(place)
        lengths.append(length)
    hashes, begins, lengths = np.concatenate(hashes), np.concatenate(begins), np.concatenate(lengths)
    cut = np.searchsorted(begins, bounds)

    def counted(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return (sums[bounds[1:]] - sums[bounds[:-1]]).astype(np.float64)

    letter = (lower >= 97) & (lower <= 122) | (data >= 128)
    digit = (data >= 48) & (data <= 57)
    symbol = ~letter & ~digit & ~_blank(data)
    mark = symbol & ~np.isin(data, np.frombuffer(b".,;:'\"-", np.uint8))
    n_bytes = np.maximum(np.diff(bounds), 1).astype(np.float64)
    words = np.diff(cut).astype(np.float64)
    some = np.maximum(words, 1)
    lines = counted(data == 10) + 1
    last = np.zeros(len(begins), dtype=bool)
    if len(begins):
        ends = begins + lengths - 1
        last = mark[ends] | (mark[begins] & (lengths == 1))
    bare = (lengths == 1) & mark[begins] if len(begins) else last
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = hashes[1:] == hashes[:-1]

    def by_word(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return (sums[cut[1:]] - sums[cut[:-1]]).astype(np.float64)

    distinct, top, longest = np.ones(len(words)), np.zeros(len(words)), np.zeros(len(words))
    for i in range(len(words)):
        part = np.sort(hashes[cut[i] : cut[i + 1]])
        if len(part):
            edge = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
            distinct[i], top[i] = (len(edge) - 1) / len(part), np.diff(edge).max() / len(part)
            longest[i] = lengths[cut[i] : cut[i + 1]].max()
    return np.stack(
        [
            np.log1p(words), by_word(lengths) / some, distinct, top, by_word(same) / some,
            counted((data >= 65) & (data <= 90)) / n_bytes, counted(digit) / n_bytes, counted(symbol) / n_bytes,
            by_word(bare) / some, by_word(last) / some, counted(data >= 128) / n_bytes, np.log1p(lines),
            np.log1p(words / lines), np.log1p(longest),
        ],
        axis=1,
    )


class Classifier:
    """Bin edges of each measure, a constant and a weight per bin."""

    def __init__(self, edges: list[np.ndarray], constant: float, weights: np.ndarray):
        self.edges, self.constant, self.weights = edges, constant, weights

    def binned(self, x: np.ndarray) -> np.ndarray:
        """Place of each measure's weight."""
        return np.stack([np.searchsorted(e, x[:, i], "left") + i * BINS for i, e in enumerate(self.edges)], axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin = self.constant + self.weights[self.binned(x)].sum(axis=1)
        return np.clip(1 / (1 + np.exp(-np.clip(margin, -30, 30))), EDGE, 1 - EDGE)


def fit_classifier(x: np.ndarray, y: np.ndarray) -> Classifier:
    """Newton steps on the ridge-penalised logistic loss over binned measures."""
    inner = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = [np.quantile(x[:, i], inner) if len(x) else np.zeros(BINS - 1) for i in range(len(MEASURES))]
    share = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
    model = Classifier(edges, float(np.log(share / (1 - share))), np.zeros(BINS * len(MEASURES)))
    if not len(y) or y.min() == y.max():
        return model
    places = model.binned(x)
    beta = np.concatenate([[model.constant], model.weights])
    penalty = np.full(len(beta), RIDGE)
    penalty[0] = 0
    design = np.zeros((len(x), len(beta)), dtype=np.float32)
    design[:, 0] = 1
    design[np.arange(len(x))[:, None], places + 1] = 1
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (p - y) + penalty * beta
        curve = (design * (p * (1 - p))[:, None].astype(np.float32)).T @ design + np.diag(penalty + 1e-6)
        move = np.linalg.solve(curve.astype(np.float64), slope)
        beta -= move * min(1.0, 4.0 / max(np.abs(move).max(), 1e-9))
        if np.abs(move).max() < 1e-6:
            break
    model.constant, model.weights = float(beta[0]), beta[1:]
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Classifier:
    """Classifier from the measures (a few numbers each) of at most `rows` labelled documents not held out."""
    labelled = sample(docs, labels, label, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = measures(batch.column(0))
            columns = [pa.array(x[:, i]) for i in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays([batch.column(1), *columns], names=["label", *MEASURES])

    found = labelled.mapInArrow(run, ", ".join(["label int", *(f"{m} double" for m in MEASURES)])).toPandas()
    found = found.sort_values(["label", *MEASURES])  # sums do not depend on which task came first
    return fit_classifier(found[list(MEASURES)].to_numpy(np.float64), found["label"].to_numpy(np.float64))


def evidence(docs: DataFrame, classifier: Classifier, text: str = "text", out: str = "p_document") -> DataFrame:
    """Adds the classifier's probability that a document is good."""
    kept = [c for c in docs.columns if c != out]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(out, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = shared.value.probability(measures(batch.column(batch.schema.get_field_index(text))))
            rest = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(p)], names=[*kept, out])

    return docs.mapInArrow(run, schema)


def strength(groups: DataFrame, n: str, good: str, centre: Column) -> float:
    """Prior rows of a Beta distribution around `centre`, from the scatter of the groups' rates (one aggregate)."""
    rate = F.col(good) / F.col(n)
    scatter = F.sum(F.col(n) * F.pow(rate - centre, 2))
    row = groups.agg(
        F.sum(n).alias("n"), F.count(F.lit(1)).alias("groups"), scatter.alias("scatter"),
        F.sum(centre * (1 - centre)).alias("noise"), F.sum(F.col(n) * centre * (1 - centre)).alias("spread"),
    ).first()
    if not row.n:
        return LEAST_STRENGTH
    between = (row.scatter - row.noise) / row.n  # mean squared distance of the true rates
    spread = row.spread / row.n
    return MOST_STRENGTH if between <= 0 else float(min(max(spread / between - 1, LEAST_STRENGTH), MOST_STRENGTH))


def site_rates(scored: DataFrame, host: str, path: str, p: str = "p_document") -> tuple[DataFrame, float, dict]:
    """Totals per (host, path) with the host's, the global rate, and both strengths."""
    groups = scored.groupBy(F.col(host).alias("_host"), F.col(path).alias("_path"))
    paths = settle(groups.agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(p).alias("good")), "paths")
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    total = paths.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    rate = min(max(total.good / total.n if total.n else 0.5, EDGE), 1 - EDGE)
    of_hosts = strength(hosts, "host_n", "host_good", F.lit(rate))
    both = settle(paths.join(hosts, paths["_host"].eqNullSafe(hosts["_host"])).drop(hosts["_host"]), "sites")
    drawn = (F.lit(of_hosts * rate) + F.col("host_good")) / (F.lit(of_hosts) + F.col("host_n"))
    of_paths = strength(both, "n", "good", drawn)
    return both, rate, {"host": of_hosts, "path": of_paths}


def judge(
    docs: DataFrame, classifier: Classifier, host: str = "source", path: str = "lang", text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Adds p_document, site_rate, quality and keep (quality >= threshold) to every row."""
    outputs = ["p_document", "site_rate", "quality", "keep"]
    docs = docs.drop(*outputs)
    names = docs.columns
    docs = docs.toDF(*(f"c{i}" for i in range(len(names))))
    host, path, text = (f"c{names.index(c)}" for c in (host, path, text))
    slim = evidence(docs.select(host, path, text), classifier, text).drop(text)
    sites, rate, strengths = site_rates(slim, host, path)
    scored = evidence(docs, classifier, text)
    # null sites are matched by a text of their own
    keys = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")).alias(k) for c, k in ((host, "_h"), (path, "_p"))]
    site_keys = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")).alias(k) for c, k in (("_host", "_h"), ("_path", "_p"))]
    joined = lookup_join(scored.select("*", *keys), settle(sites.select(*site_keys, "n", "good", "host_n", "host_good"), "sites"), ["_h", "_p"])
    own, a, b = F.col("p_document"), strengths["host"], strengths["path"]
    host_rate = (F.lit(a * rate) + F.col("host_good") - own) / (F.lit(a) + F.col("host_n") - 1)
    site = (F.lit(b) * host_rate + F.col("good") - own) / (F.lit(b) + F.col("n") - 1)
    site = F.least(F.greatest(site, F.lit(EDGE)), F.lit(1 - EDGE))
    odds = F.log(own / (1 - own)) + F.log(F.col("site_rate") / (1 - F.col("site_rate"))) - F.lit(float(np.log(rate / (1 - rate))))
    out = joined.withColumn("site_rate", site).withColumn("quality", 1 / (1 + F.exp(-odds)))
    out = out.withColumn("keep", F.col("quality") >= threshold)
    return out.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names)), *outputs)
