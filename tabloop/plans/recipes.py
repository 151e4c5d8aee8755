"""Training-set recipes: the plan of each phase and problem, up to the model. Fitted values are found on the way.

Every result has row_id, the features, the target, `copy`, `is_synthetic` and `source`. Row ids must be
unique over the tables of one recipe.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloop.config import ProblemConfig
from tabloop.operators.columns import append, distinct_rows, drop_columns
from tabloop.operators.encode import apply_codes, encode_labels, fit_labels
from tabloop.operators.neighbours import nearest_centroid
from tabloop.operators.ordering import cut_n, cut_share, first_n, first_share, random_cut, shuffled, split
from tabloop.operators.relabel import fit_centroids
from tabloop.operators.resample import cluster_smote, duplicate_extremes, smote, undersample
from tabloop.operators.stats import apply_robust, fit_robust
from tabloop.storage import settle

# fixed values of the recipes, the defaults of RecipeInputs
SCORED_TRAIN_ROWS = 50_000
EXTREME_ROWS = 5_000
CAPTURED_ROWS = 5_000
SHUFFLED_SHARE = 0.7
CONFIDENT_SHARE = 0.95
EARLIER_TEST_SHARE, EARLIER_SEED = 0.3, 42
KMEANS_CLUSTERS = 8


@dataclass(frozen=True)
class RecipeInputs:
    """Tables of a recipe. `train` and `test` hold codes; the other tables hold raw categories."""

    cfg: ProblemConfig
    index: DataFrame
    train: DataFrame | None = None
    test: DataFrame | None = None
    captured: DataFrame | None = None
    scored: DataFrame | None = None  # labelled rows with `prob`, phase 2 prob 1
    earlier: DataFrame | None = None  # labelled rows of the phase before, phase 3
    centroids: DataFrame | None = None  # clusters for phase 1 prob 2; fitted when absent
    seed: int = 1242
    balance_threshold: float = 0.5
    scored_train_rows: int = SCORED_TRAIN_ROWS  # phase 2 prob 1: most confident scored rows that train, the rest tests
    extreme_rows: int = EXTREME_ROWS  # phase 2 prob 1: captured rows repeated from either end
    captured_rows: int | None = CAPTURED_ROWS  # phase 2 prob 2: captured rows that take part, all with None
    shuffled_share: float = SHUFFLED_SHARE  # phase 3 prob 1: share of captured rows that takes part
    confident_share: float = CONFIDENT_SHARE  # phase 3 prob 2: share of captured rows, most confident first


def _columns(cfg: ProblemConfig) -> list[str]:
    return ["row_id", *cfg.features, cfg.target]


def _coded(df: DataFrame, inp: RecipeInputs) -> DataFrame:
    return apply_codes(df, inp.index, inp.cfg.categorical)


def _captured(df: DataFrame, inp: RecipeInputs) -> DataFrame:
    """Captured rows with codes; the model's label is their target."""
    cfg = inp.cfg
    labelled = drop_columns(df, ["batch_id", "is_drift", "prob", "label", "Cluster"])
    return _coded(labelled.withColumnRenamed("label_model", cfg.target), inp).select(*_columns(cfg))


def _plain(df: DataFrame, cfg: ProblemConfig) -> DataFrame:
    doubles = [F.col(c).cast("double").alias(c) for c in cfg.features]
    return df.select("row_id", *doubles, cfg.target, F.lit(0).alias("copy"), F.lit(False).alias("is_synthetic"))


def _smote(df: DataFrame, inp: RecipeInputs, strategy: str = "auto", k: int = 5) -> DataFrame:
    return smote(df, inp.cfg.target, inp.cfg.features, k, strategy, inp.seed)


def _named(parts: dict[str, DataFrame | None]) -> DataFrame:
    present = {n: d for n, d in parts.items() if d is not None}
    return append(*present.values(), source=list(present))


def _phase1(inp: RecipeInputs, add_captured: bool, clustered: bool) -> tuple[DataFrame, DataFrame]:
    cfg = inp.cfg
    scale = fit_robust(inp.train, cfg.features)
    train = _smote(apply_robust(inp.train.select(*_columns(cfg)), scale), inp)
    extra = None
    if add_captured:
        scaled = apply_robust(_captured(inp.captured, inp), scale)
        if clustered:
            centroids = inp.centroids
            if centroids is None:
                centroids = fit_centroids(scaled, cfg.features, KMEANS_CLUSTERS, inp.seed)
            assigned = nearest_centroid(scaled, centroids, cfg.features)
            extra = cluster_smote(
                assigned, "cluster", cfg.target, cfg.features, 5, inp.seed, balance_threshold=inp.balance_threshold
            )
        else:
            extra = _smote(scaled, inp, "minority")
    test = _plain(apply_robust(inp.test.select(*_columns(cfg)), scale), cfg)
    return _named({"train": train, "captured": extra}), _named({"test": test})


def _phase2_binary(inp: RecipeInputs, add_captured: bool) -> tuple[DataFrame, DataFrame]:
    cfg = inp.cfg
    head, tail = cut_n(inp.scored, inp.scored_train_rows, ["-prob", "row_id"])
    train, test = (_plain(_coded(d, inp).select(*_columns(cfg)), cfg) for d in (head, tail))
    if not add_captured:
        return _named({"train": train}), _named({"test": test})
    more = settle(duplicate_extremes(inp.captured, inp.extreme_rows, renumber=True), "more")
    kept, _ = random_cut(more, ["prob", "row_id"], inp.seed)
    made = _smote(_captured(kept, inp), inp, "auto", 10)
    return _named({"captured": made}), _named({"test": test, "train": train})


def _phase2_multi(inp: RecipeInputs, add_captured: bool) -> tuple[DataFrame, DataFrame]:
    cfg = inp.cfg
    labels = fit_labels(inp.train, cfg.target)
    scale = fit_robust(inp.train, cfg.features)
    coded = encode_labels(inp.train.select(*_columns(cfg)), labels, cfg.target)
    train = _smote(apply_robust(coded, scale), inp)
    extra = None
    if add_captured:
        taken = inp.captured
        if inp.captured_rows is not None:
            taken = first_n(taken, inp.captured_rows, shuffled(taken, inp.seed))
        rows = apply_robust(encode_labels(_captured(taken, inp), labels, cfg.target), scale)
        extra = _smote(rows, inp, "minority")
    test = encode_labels(inp.test.select(*_columns(cfg)), labels, cfg.target)
    return _named({"train": train, "captured": extra}), _named({"test": _plain(apply_robust(test, scale), cfg)})


def _phase3_binary(inp: RecipeInputs, add_captured: bool) -> tuple[DataFrame, DataFrame]:
    cfg = inp.cfg
    earlier = _coded(distinct_rows(inp.earlier.select(*_columns(cfg)), "row_id"), inp)
    both = append(inp.train.select(*_columns(cfg)), earlier)
    scale = fit_robust(inp.train, cfg.features)
    raised = _smote(apply_robust(both, scale), inp)
    train = undersample(raised, cfg.target, inp.seed, ["row_id", "copy"])
    extra = None
    if add_captured:
        taken = first_share(inp.captured, inp.shuffled_share, shuffled(inp.captured, inp.seed))
        extra = _smote(apply_robust(_captured(taken, inp), scale), inp, "minority")
    test = _plain(apply_robust(inp.test.select(*_columns(cfg)), scale), cfg)
    return _named({"train": train, "captured": extra}), _named({"test": test})


def _phase3_multi(inp: RecipeInputs, add_captured: bool) -> tuple[DataFrame, DataFrame]:
    cfg = inp.cfg
    labels = fit_labels(inp.train, cfg.target)
    scale = fit_robust(inp.train, cfg.features)

    def ready(df: DataFrame) -> DataFrame:
        return apply_robust(encode_labels(df.select(*_columns(cfg)), labels, cfg.target), scale)

    earlier = split(distinct_rows(inp.earlier.select(*_columns(cfg)), "row_id"), EARLIER_TEST_SHARE, EARLIER_SEED)
    earlier_train = _plain(ready(_coded(earlier.where("split = 'train'"), inp)), cfg)
    earlier_test = _plain(ready(_coded(earlier.where("split = 'test'"), inp)), cfg)
    train = _smote(ready(inp.train), inp)
    extra = None
    if add_captured:
        taken, _ = cut_share(inp.captured, inp.confident_share, ["-prob", "row_id"])
        extra = _smote(ready(_captured(taken, inp)), inp, "minority")
    test = _plain(ready(inp.test), cfg)
    return (
        _named({"train": train, "captured": extra, "earlier": earlier_train}),
        _named({"test": test, "earlier": earlier_test}),
    )


def captured_left_out(phase: str, problem: str, inp: RecipeInputs) -> DataFrame:
    """Captured rows that a cut by number or share leaves out; none where the recipe has no such cut."""
    rows, key = inp.captured, (phase, problem)
    if key == ("phase-2", "prob-2") and inp.captured_rows is not None:
        return rows.join(first_n(rows, inp.captured_rows, shuffled(rows, inp.seed)).select("row_id"), "row_id", "left_anti")
    if key == ("phase-3", "prob-1"):
        return rows.join(first_share(rows, inp.shuffled_share, shuffled(rows, inp.seed)).select("row_id"), "row_id", "left_anti")
    if key == ("phase-3", "prob-2"):
        return cut_share(rows, inp.confident_share, ["-prob", "row_id"])[1]
    return rows.limit(0)


def recipe(phase: str, problem: str, inputs: RecipeInputs, add_captured: bool = True) -> tuple[DataFrame, DataFrame]:
    """(train, test) of a phase and problem. Tables that several steps read are written once."""
    key = (phase, problem)
    read_often = {"train": True, "scored": key == ("phase-2", "prob-1"), "captured": add_captured}
    tables = {n: getattr(inputs, n) for n, used in read_often.items() if used}
    inputs = replace(inputs, **{n: settle(df, n) for n, df in tables.items() if df is not None})
    if key == ("phase-1", "prob-1"):
        return _phase1(inputs, add_captured, clustered=False)
    if key == ("phase-1", "prob-2"):
        return _phase1(inputs, add_captured, clustered=True)
    if key == ("phase-2", "prob-1"):
        return _phase2_binary(inputs, add_captured)
    if key == ("phase-2", "prob-2"):
        return _phase2_multi(inputs, add_captured)
    if key == ("phase-3", "prob-1"):
        return _phase3_binary(inputs, add_captured)
    if key == ("phase-3", "prob-2"):
        return _phase3_multi(inputs, add_captured)
    raise ValueError(f"no recipe for {phase} {problem}")
