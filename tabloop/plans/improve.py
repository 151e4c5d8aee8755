"""The improvement loop: captured requests become training rows for the next model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloop.config import ProblemConfig
from tabloop.operators.ordering import number_rows, sample_exact
from tabloop.operators.relabel import consensus
from tabloop.plans.scoring import Fitted, score_table
from tabloop.sources.requests import latest_requests, parse_requests

SAMPLE_ROWS = 50_000  # fixed value: captured rows taken per round where a sample is asked for


def captured_table(requests: DataFrame, cfg: ProblemConfig, sample: int | None = None, seed: int = 1) -> DataFrame:
    """Rows of the latest request of every id, numbered by (id, position); all of them, or an exact sample."""
    rows, _ = parse_requests(latest_requests(requests), cfg)
    table = number_rows(rows.select(F.col("id").alias("batch_id"), "row_pos", *cfg.features), ["batch_id", "row_pos"])
    return table if sample is None else sample_exact(table, sample, seed)


def consensus_labels(
    captured: DataFrame, models: Sequence[PipelineModel], cfg: ProblemConfig, fitted: Fitted
) -> DataFrame:
    """Score the captured rows with several models and keep the labels they agree on, flipping the others."""
    scored = [score_table(captured, m, cfg, fitted) for m in models]
    return consensus([scored[0], *[s.select("row_id", "label_model", "prob") for s in scored[1:]]])
