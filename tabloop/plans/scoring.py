"""Batch scoring of captured tables, batch submissions and evaluation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloop.config import ProblemConfig
from tabloop.operators.columns import mispredictions, select_features
from tabloop.operators.encode import apply_codes, decode_labels
from tabloop.operators.evaluate import hard_auc
from tabloop.operators.relabel import replace_low_confidence
from tabloop.operators.stats import apply_imputer, apply_robust
from tabloop.plans.training import score
from tabloop.sources.requests import collect_per_key
from tabloop.sources.tables import check_schema
from tabloop.storage import settle

ADDED = ("label_model", "prob")


@dataclass(frozen=True)
class Fitted:
    """What was fitted on the training table: codes, scale, and optionally fills and class names."""

    index: DataFrame
    scale: DataFrame | None = None
    fills: DataFrame | None = None
    labels: DataFrame | None = None


def prepare(df: DataFrame, cfg: ProblemConfig, fitted: Fitted, keep: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """Features as the model expects them, beside the `keep` columns."""
    rows = select_features(df, cfg.features, keep=keep)
    if fitted.fills is not None:
        rows = apply_imputer(rows, fitted.fills)
    rows = apply_codes(rows, fitted.index, cfg.categorical)
    return apply_robust(rows, fitted.scale) if fitted.scale is not None else rows


def score_table(
    df: DataFrame,
    model: PipelineModel,
    cfg: ProblemConfig,
    fitted: Fitted,
    other: DataFrame | None = None,
    threshold: float = 0.7,
    schema: T.StructType | None = None,
) -> DataFrame:
    """The raw table with `label_model` and `prob`; low-confidence labels come from `other` when given.

    The raw columns travel through the model step as a struct, so nothing is joined back. With the `schema` a model
    was saved with, rows that do not fit it are refused.
    """
    raw = df.drop(*ADDED)
    carried = raw.select("*", F.struct(*raw.columns).alias("_raw"))
    ready = prepare(carried, cfg, fitted, ("_raw",))
    scored = score(model, ready if schema is None else check_schema(ready, schema))
    if fitted.labels is not None:
        scored = decode_labels(scored, fitted.labels)
    out = scored.select("_raw.*", *ADDED)
    return out if other is None else replace_low_confidence(settle(out, "scored"), other, threshold)


def submit(
    df: DataFrame, model: PipelineModel, cfg: ProblemConfig, fitted: Fitted, schema: T.StructType | None = None
) -> DataFrame:
    """(batch_id, part, values): predicted classes of every batch in row order."""
    scored = score_table(df, model, cfg, fitted, schema=schema)
    return collect_per_key(scored, "batch_id", F.col("label_model").cast("int"))


def evaluate(df: DataFrame, model: PipelineModel, cfg: ProblemConfig, fitted: Fitted) -> tuple[DataFrame, DataFrame]:
    """(auc, mispredicted rows) of labelled data; the confidence is the largest class probability."""
    scored = score_table(df, model, cfg, fitted)
    return hard_auc(scored, cfg.target, "label_model"), mispredictions(scored, cfg.target, "label_model")
