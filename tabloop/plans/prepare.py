"""Raw labelled table to coded, split training tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tabloop.config import ProblemConfig
from tabloop.operators.columns import distinct_rows
from tabloop.operators.encode import build_category_features
from tabloop.operators.ordering import split
from tabloop.storage import settle


def process_raw(df: DataFrame, cfg: ProblemConfig) -> tuple[DataFrame, DataFrame]:
    """(coded rows with `split`, category index). The index covers the rows of both parts.

    Rows with the same features and target count once, whatever their row id.
    """
    rows = settle(distinct_rows(df, "row_id"))
    coded, index = build_category_features(rows, cfg.categorical)
    return split(coded, cfg.test_size, cfg.seed), index
