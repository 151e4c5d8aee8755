"""Whole training jobs: recipe, model, metrics of train and test rows, run log, saved model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from tabloop.operators.evaluate import binary_metrics, hard_auc, micro_metrics
from tabloop.operators.ordering import split
from tabloop.operators.woe import woe_pipeline
from tabloop.plans import training
from tabloop.plans.recipes import RecipeInputs, recipe
from tabloop.sources.tables import experiment_name, log_run, model_path, save_model
from tabloop.storage import settle

HOLDOUT_SHARE, HOLDOUT_SEED = 0.2, 101  # fixed values of the boosting check


def part_metrics(scored: DataFrame, target: str, classes: int) -> dict[str, float]:
    """Metrics of one scored table: with the hard AUC for two classes, micro-averaged for more."""
    if classes > 2:
        return micro_metrics(scored, target, "label_model").first().asDict()
    found = binary_metrics(scored, target, "label_model").first().asDict()
    return found | hard_auc(scored, target, "label_model").first().asDict()


def train_model(
    phase: str,
    problem: str,
    inputs: RecipeInputs,
    name: str = "xgb",
    root: str | None = None,
    run_id: str = "run-1",
    add_captured: bool = True,
    **params,
) -> tuple[PipelineModel, DataFrame, DataFrame, dict[str, float]]:
    """(model, scored train, scored test, metrics) of a recipe; with `root` also logged and saved.

    Test rows take no part in the fit. Metrics are named `train_accuracy`, `test_auc` and so on. The model is saved
    with the schema of its features below `root`/models, the run below `root`/runs.
    """
    cfg = inputs.cfg
    train, test = (settle(part, "recipe") for part in recipe(phase, problem, inputs, add_captured))
    classes = train.select(cfg.target).distinct().count()
    model = training.fit(train, cfg.features, name, cfg.target, max(2, classes), **params)
    scored = {"train": training.score(model, train), "test": training.score(model, test)}
    metrics = {f"{part}_{k}": v for part, df in scored.items() for k, v in part_metrics(df, cfg.target, classes).items()}
    if root is not None:
        spark = train.sparkSession
        log_run(spark, f"{root}/runs", run_id, experiment_name(cfg, name), {"model": name, **params}, metrics)
        save_model(model, train.select(*cfg.features).schema, model_path(f"{root}/models", experiment_name(cfg, name), run_id))
    return model, scored["train"], scored["test"], metrics


def train_on_woe(
    df: DataFrame, features: Sequence[str], num_cols: Sequence[str], label: str = "label", name: str = "xgb", **params
) -> tuple[PipelineModel, DataFrame, dict[str, float]]:
    """(model, scored holdout, metrics): boosting on weights of evidence that are fitted on the training part only."""
    parts = settle(split(df, HOLDOUT_SHARE, HOLDOUT_SEED), "holdout")
    train, test = (parts.where(f"split = '{p}'").drop("split") for p in ("train", "test"))
    transform, _ = woe_pipeline(train, features, num_cols, label)
    model = training.fit(transform(train), features, name, label, **params)
    scored = training.score(model, transform(test))
    return model, scored, part_metrics(scored, label, 2)
