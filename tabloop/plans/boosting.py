"""Softmax boosting: one regression tree per class and round, grown on histograms of gradients.

Values become bins once: bounds are quantiles of each column, a missing value has a bin of its own below all others. A
level of all trees of a round is one pass over the rows. Rows alike in bins, label and part are one row with their
number, so a table of few columns has a bounded number of them. A task places its rows in the nodes so far, adds gradients
and hessians up by (class, node, column, bin) and gives only these sums away; they are summed by one shuffle and the
best split of each node is chosen from them. Up to DRIVER_CELLS sums of a level come to the driver; of more, Spark
chooses the splits and only these come. Sums of the children follow from the split, so the last level needs no pass.

Gradients are rounded to whole multiples of 1 / UNIT, so sums are exact whatever the order of tasks, and a task that
runs again gives the same tree. Margins are written every SETTLE_ROUNDS rounds and otherwise follow from the trees
since; no pass depends on an executor's memory.

A leaf is the Newton step -T(G) / (H + l2), with T drawing G towards zero by l1, times the rate. Splits need a hessian of
`least_hessian` on both sides and a gain. Equal gains go to the earlier column, then to the lower bin. Fitting ends
early when no tree of a round splits, or when the loss of the held-out rows has not fallen for `patience` rounds.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloop.storage import settle, small_table

register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed

# fixed values: rounds, depth and rate of the reference settings and their library's defaults
ROUNDS, DEPTH, RATE, L1, L2, LEAST_HESSIAN = 200, 7, 0.3, 0.0, 1.0, 1.0
BINS = 64
UNIT = float(2**24)
MAX_CELLS = 2**23
DRIVER_CELLS = 2**14
SETTLE_ROUNDS = 20
TASK_ROWS = 20_000
LEAST_GAIN = 1e-6
NODES = "round int, class int, node int, column int, bin int, cut double, value double"
CELLS = "class int, node int, cell int, g bigint, h bigint"
CHOICES = "class int, node int, gain double, column int, bin int, g bigint, h bigint, left_g bigint, left_h bigint"
CHOICE_KINDS = pa.schema([(n, {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}[k]) for n, k in (x.split() for x in CHOICES.split(", "))])


@dataclass
class Tree:
    """Nodes by their number (root 1, children 2n and 2n + 1): a split (column, bin) or a leaf's value."""

    splits: dict[int, tuple[int, int]] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = max([1, *self.leaves, *(2 * n + 1 for n in self.splits)]) + 1
        column, bound, value = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
        for node, (c, b) in self.splits.items():
            column[node], bound[node] = c, b
        for node, v in self.leaves.items():
            value[node] = v
        return column, bound, value

    def place(self, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(node each row ends in, value there)."""
        column, bound, value = self.arrays()
        node = np.ones(len(bins), np.int64)
        rows = np.arange(len(bins))
        while True:
            moving = column[node] >= 0
            if not moving.any():
                return node, value[node]
            right = bins[rows, np.maximum(column[node], 0)] > bound[node]
            node = np.where(moving, 2 * node + right, node)


@dataclass
class Boosted:
    """A fitted model: class count, columns, their cuts, and trees by round and class; `losses` (round, part, loss)."""

    classes: int
    features: list[str]
    cuts: list[np.ndarray]
    rounds: list[list[Tree]]
    losses: list[tuple[int, str, float]]

    def rows(self) -> Iterator[tuple]:
        """All nodes, as rows of NODES."""
        for r, trees in enumerate(self.rounds):
            for k, tree in enumerate(trees):
                for node, (c, b) in sorted(tree.splits.items()):
                    cut = float(self.cuts[c][b - 1]) if b else None
                    yield r, k, node, c, b, cut, None
                for node, value in sorted(tree.leaves.items()):
                    yield r, k, node, None, None, None, value

    def table(self, spark: SparkSession) -> DataFrame:
        return small_table(spark, list(self.rows()), NODES)

    def loss_table(self, spark: SparkSession) -> DataFrame:
        return small_table(spark, self.losses, "round int, part string, loss double")


def fit_cuts(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper bounds of the bins of each column: quantiles, without repeats; a value equal to a bound is below it."""
    shares = [i / bins for i in range(1, bins)]
    finite = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in features]
    row = df.agg(*(F.percentile_approx(x, shares, 100_000).alias(f"q{i}") for i, x in enumerate(finite))).first()
    return [np.unique(np.array([] if q is None else q, dtype=np.float64)) for q in row]


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bins of rows of values: 0 for missing, else 1 + the bounds below the value."""
    out = np.zeros(x.shape, np.int64)
    for j, cut in enumerate(cuts):
        out[:, j] = np.where(np.isnan(x[:, j]), 0, np.searchsorted(cut, x[:, j], side="left") + 1)
    return out


def _values(features: Sequence[str]) -> Column:
    return F.array(*(F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in features))


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def chances(margins: np.ndarray) -> np.ndarray:
    """Softmax of each row."""
    rise = np.exp(margins - margins.max(axis=1, keepdims=True))
    return rise / rise.sum(axis=1, keepdims=True)


def gradients(margins: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gradients, hessians, losses) in whole units, a column per class."""
    p = chances(margins)
    hit = np.zeros_like(p)
    hit[np.arange(len(label)), label] = 1
    share = margins.shape[1] / (margins.shape[1] - 1)
    loss = -np.log(np.maximum(p[np.arange(len(label)), label], 1e-15))
    return tuple(np.rint(x * UNIT).astype(np.int64) for x in (p - hit, share * p * (1 - p), loss))


def margins_of(bins: np.ndarray, start: np.ndarray, rounds: Sequence[Sequence[Tree]]) -> np.ndarray:
    out = start.copy()
    for trees in rounds:
        for k, tree in enumerate(trees):
            out[:, k] += tree.place(bins)[1]
    return out


def best_split(g: np.ndarray, h: np.ndarray, l1: float, l2: float, least_hessian: float) -> tuple[float, int, int]:
    """(gain, column, bin) for sums (columns, bins) of one node; rows at or below the bin go left."""
    def score(a, b):
        drawn = np.sign(a) * np.maximum(np.abs(a) - l1, 0)
        return drawn**2 / (b + l2)

    left_g, left_h = np.cumsum(g, axis=1)[:, :-1] / UNIT, np.cumsum(h, axis=1)[:, :-1] / UNIT
    all_g, all_h = g[0].sum() / UNIT, h[0].sum() / UNIT
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = score(left_g, left_h) + score(all_g - left_g, all_h - left_h) - score(all_g, all_h)
    allowed = (left_h >= least_hessian) & (all_h - left_h >= least_hessian) & ~np.isnan(gain)
    gain = np.where(allowed, gain, -np.inf)
    at = int(np.argmax(gain)) if gain.size else 0
    return (float(gain.flat[at]), *divmod(at, gain.shape[1])) if gain.size else (-np.inf, 0, 0)


def leaf(g: int, h: int, l1: float, l2: float, rate: float) -> float:
    g, h = g / UNIT, h / UNIT
    return -rate * float(np.sign(g) * max(abs(g) - l1, 0)) / (h + l2) if h + l2 > 0 else 0.0


def _sums(rows: DataFrame, done: list[list[Tree]], growing: list[Tree], open_nodes: list[list[int]], classes: int, width: int):
    """Sums of the open nodes by class, node and cell (column * width + bin); class -1 holds losses by part."""
    first_level = open_nodes == [[1]] * classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        losses: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, label, held = _matrix(batch.column(0), np.int64), batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
            copies = batch.column(4).to_numpy()
            g, h, loss = gradients(margins_of(bins, _matrix(batch.column(3), np.float64), done), label)
            g, h, loss = g * copies[:, None], h * copies[:, None], loss * copies
            exact = float(copies.sum()) * UNIT < 2**53  # then sums in doubles are whole numbers
            if first_level:
                for part in (0, 1):
                    own = held == bool(part)
                    losses[part] = losses.get(part, np.zeros(2, np.int64)) + [loss[own].sum(), copies[own].sum()]
            bins, g, h = bins[~held], g[~held], h[~held]
            cells = bins + np.arange(bins.shape[1]) * width
            for k, tree in enumerate(growing):
                node = tree.place(bins)[0]
                for n in open_nodes[k]:
                    own = node == n
                    at = cells[own].ravel()
                    both = sums.setdefault((k, n), np.zeros((2, bins.shape[1] * width), np.int64))
                    for i, x in enumerate((g, h)):
                        each = np.repeat(x[own, k], bins.shape[1])
                        if exact:
                            both[i] += np.bincount(at, each, both.shape[1]).astype(np.int64)
                        else:
                            np.add.at(both[i], at, each)
        columns: list[list] = [[], [], [], [], []]
        for (k, n), (g, h) in sums.items():
            some = np.flatnonzero((g != 0) | (h != 0))
            for c, v in zip(columns, (np.full(len(some), k), np.full(len(some), n), some, g[some], h[some])):
                c.append(v)
        for part, (total, count) in losses.items():
            for c, v in zip(columns, (-1, part, 0, total, count)):
                c.append(np.array([v]))
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        arrays = [pa.array(np.concatenate(c) if c else [], t) for c, t in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=["class", "node", "cell", "g", "h"])

    return rows.select("bins", "label", "held", "margins", "copies").mapInArrow(run, CELLS)


def _whole(partial: DataFrame) -> DataFrame:
    return partial.groupBy("class", "node", "cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def _choices(partial: DataFrame, width: int, l1: float, l2: float, least_hessian: float) -> DataFrame:
    """CHOICES: the best split of each node as `best_split` finds it; losses (class -1) as they are, in g and h."""

    def choose(nodes: pa.Table) -> pa.Table:
        g, h = nodes["g"].to_numpy(), nodes["h"].to_numpy()
        row = {"class": nodes["class"][0].as_py(), "node": nodes["node"][0].as_py()}
        cell = nodes["cell"].to_numpy()
        size = (int(cell.max()) // width + 1) * width
        sums = [np.bincount([], minlength=size).astype(np.int64) for _ in range(2)]
        for total, x in zip(sums, (g, h)):
            np.add.at(total, cell, x)
        if row["class"] < 0:
            found = (0.0, 0, 0, int(sums[0][0]), int(sums[1][0]), 0, 0)
        else:
            found = _split_and_sums(*(x.reshape(-1, width) for x in sums), l1, l2, least_hessian)
        names = ("gain", "column", "bin", "g", "h", "left_g", "left_h")
        return pa.Table.from_pylist([row | dict(zip(names, found))], schema=CHOICE_KINDS)

    return partial.groupBy("class", "node").applyInArrow(choose, CHOICES)


def _split_and_sums(g: np.ndarray, h: np.ndarray, l1: float, l2: float, least_hessian: float) -> tuple:
    """(gain, column, bin, sums of the node, sums of its left child)."""
    gain, column, bound = best_split(g, h, l1, l2, least_hessian)
    left = (int(x[column, : bound + 1].sum()) for x in (g, h))
    return gain, column, bound, int(g[0].sum()), int(h[0].sum()), *left


def _advance(rows: DataFrame, done: list[list[Tree]]) -> DataFrame:
    """Rows with their margins after the trees so far, written."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = rows.schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = _matrix(batch.column(3), np.float64)
            if len(margins):
                margins = margins_of(_matrix(batch.column(0), np.int64), margins, done)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(list(margins), arrow.field(3).type), batch.column(4)], schema=arrow)

    return settle(rows.mapInArrow(run, schema), "margins")


def fit(
    df: DataFrame, features: Sequence[str], label: str = "label", classes: int = 2, rounds: int = ROUNDS, depth: int = DEPTH,
    rate: float = RATE, l1: float = L1, l2: float = L2, least_hessian: float = LEAST_HESSIAN, bins: int = BINS,
    held: Column | None = None, patience: int | None = None, stop: Callable[[float], bool] | None = None,
) -> Boosted:
    """Trees for integer labels 0 to classes - 1; rows where `held` only count for the held-out loss.

    Rows without a label are left out. `stop` is told the held-out loss after each round and may end the fit there.
    `losses` holds the mean loss before the first round and after each.
    """
    if classes < 2:
        raise ValueError("boosting needs two classes at least")
    features = list(features)
    width = bins + 1
    if classes * 2 ** max(depth - 1, 0) * len(features) * width > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} sums in a level; use fewer bins or less depth")
    held = F.coalesce(held, F.lit(False)) if held is not None else F.lit(False)
    known = df.where(F.col(label).isNotNull()).select(
        F.col(label).cast("int").alias("label"), held.alias("held"), _values(features).alias("x")
    )
    known = settle(known, "labelled")
    ends = known.where(~F.col("held")).select(*(F.col("x")[i].alias(f"x{i}") for i in range(len(features))))
    cuts = fit_cuts(ends, [f"x{i}" for i in range(len(features))], bins)
    least, most = known.agg(F.min("label"), F.max("label")).first()
    if least is not None and not 0 <= least <= most < classes:
        raise ValueError(f"labels from {least} to {most} for {classes} classes")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(2), np.float64) if batch.num_rows else np.zeros((0, len(cuts)))
            columns = [pa.array(list(binned(x, cuts)), pa.list_(pa.int32())), batch.column(0), batch.column(1)]
            yield pa.RecordBatch.from_arrays(columns, names=["bins", "label", "held"])

    placed = known.mapInArrow(coded, "bins array<int>, label int, held boolean")
    alike = settle(placed.groupBy("bins", "label", "held").agg(F.count(F.lit(1)).alias("copies")), "alike")
    count = alike.count()
    start = F.array(*(F.lit(0.0) for _ in range(classes))).alias("margins")
    tasks = max(1, -(-count // TASK_ROWS))  # no more tasks a level than they are worth
    rows = settle(alike.select("bins", "label", "held", start, "copies").repartition(tasks), "bins")
    model, since, best = Boosted(classes, features, cuts, [], []), [], (np.inf, -1)
    for number in range(rounds + 1):
        trees = [Tree() for _ in range(classes)]
        open_nodes = [[1] for _ in range(classes)]
        for level in range(max(depth, 1)):
            if not any(open_nodes):
                break
            partial = _sums(rows, since, trees, open_nodes, classes, width)
            few = sum(map(len, open_nodes)) * len(features) * width <= DRIVER_CELLS
            table = (_whole(partial) if few else _choices(partial, width, l1, l2, least_hessian)).toArrow()
            found = {c: table.column(c).to_numpy() for c in table.column_names}
            if level == 0:
                for part, name in enumerate(("train", "held")):
                    own = (found["class"] == -1) & (found["node"] == part) & (found["h"] > 0)
                    if own.any():
                        model.losses.append((number, name, float(found["g"][own][0] / UNIT / found["h"][own][0])))
                told = stop is not None and number > 0 and model.losses[-1][1] == "held" and stop(model.losses[-1][2])
                if number == rounds or told:
                    return model
            for k, tree in enumerate(trees):
                fresh = []
                for n in open_nodes[k]:
                    own = (found["class"] == k) & (found["node"] == n)
                    if few:
                        g, h = np.zeros(len(features) * width, np.int64), np.zeros(len(features) * width, np.int64)
                        g[found["cell"][own]], h[found["cell"][own]] = found["g"][own], found["h"][own]
                        chosen = _split_and_sums(g.reshape(-1, width), h.reshape(-1, width), l1, l2, least_hessian)
                    elif own.any():
                        chosen = tuple(found[c][own][0] for c in ("gain", "column", "bin", "g", "h", "left_g", "left_h"))
                    else:
                        chosen = (-np.inf, 0, 0, 0, 0, 0, 0)  # all sums are 0
                    gain, column, bound, g, h, left_g, left_h = chosen
                    if gain > LEAST_GAIN and level < depth:
                        tree.splits[n] = (int(column), int(bound))
                        sides = ((2 * n, int(left_g), int(left_h)), (2 * n + 1, int(g - left_g), int(h - left_h)))
                        if level + 1 < depth:
                            fresh += [side[0] for side in sides]
                        else:
                            tree.leaves |= {node: leaf(a, b, l1, l2, rate) for node, a, b in sides}
                    else:
                        tree.leaves[n] = leaf(int(g), int(h), l1, l2, rate)
                open_nodes[k] = fresh
        held_loss = next((x for r, part, x in reversed(model.losses) if part == "held" and r == number), None)
        if held_loss is not None and held_loss < best[0]:
            best = (held_loss, number)
        stale = patience is not None and held_loss is not None and number - best[1] >= patience
        if stale:
            del model.rounds[best[1] :]
            return model
        if not any(tree.splits for tree in trees):
            return model
        model.rounds.append(trees)
        since.append(trees)
        if len(since) >= SETTLE_ROUNDS:
            rows, since = _advance(rows, since), []
    return model


def score(model: Boosted, df: DataFrame, probabilities: str | None = None) -> DataFrame:
    """Add `label_model` and `prob`, the largest probability (ties: the smaller class), and all of them if named."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    own = ["label_model", "prob", *([probabilities] if probabilities else [])]
    kept = [c for c in df.columns if c not in own]
    rows = df.select(*kept, _values(model.features).alias("_values"))
    added = [T.StructField("label_model", T.IntegerType()), T.StructField("prob", T.DoubleType())]
    if probabilities:
        added.append(T.StructField(probabilities, T.ArrayType(T.DoubleType())))
    schema = T.StructType([*(rows.schema[c] for c in kept), *added])
    arrow = to_arrow_schema(schema)
    shared = df.sparkSession.sparkContext.broadcast((model.cuts, model.rounds, model.classes))  # size: the trees

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, rounds, classes = shared.value
        for batch in batches:
            n = batch.num_rows
            x = _matrix(batch.column(batch.num_columns - 1), np.float64) if n else np.zeros((0, len(cuts)))
            p = chances(margins_of(binned(x, cuts), np.zeros((n, classes)), rounds)) if n else np.zeros((0, classes))
            columns = [*batch.columns[:-1], pa.array(p.argmax(axis=1), pa.int32()), pa.array(p.max(axis=1) if n else [], pa.float64())]
            if probabilities:
                columns.append(pa.array(list(p), pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return rows.mapInArrow(run, schema)


def save(model: Boosted, spark: SparkSession, path: str) -> None:
    """Nodes, cuts, losses and the head of the model as tables below `path`."""
    model.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    model.loss_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/losses")
    head = [(model.classes, model.features, [[float(v) for v in c] for c in model.cuts], len(model.rounds))]
    small_table(spark, head, "classes int, features array<string>, cuts array<array<double>>, rounds int").write.mode("overwrite").parquet(f"{path}/head")


def load(spark: SparkSession, path: str) -> Boosted:
    head = spark.read.parquet(f"{path}/head").first()
    rounds = [[Tree() for _ in range(head.classes)] for _ in range(head.rounds)]
    for r in spark.read.parquet(f"{path}/nodes").toLocalIterator():
        tree = rounds[r.round][r["class"]]
        if r.value is None:
            tree.splits[r.node] = (r.column, r.bin)
        else:
            tree.leaves[r.node] = r.value
    losses = [(r.round, r.part, r.loss) for r in spark.read.parquet(f"{path}/losses").orderBy("round", "part").collect()]
    return Boosted(head.classes, list(head.features), [np.array(c) for c in head.cuts], rounds, losses)
