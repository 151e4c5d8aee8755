"""Labelled and scored tables, fitted tables, run logs and models on shared storage."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloop.config import ProblemConfig
from tabloop.plans.training import KINDS, Model
from tabloop.storage import small_table


def read_labelled(spark: SparkSession, path: str, cfg: ProblemConfig) -> DataFrame:
    """Labelled table with the declared schema."""
    return spark.read.schema(cfg.schema()).parquet(path)


def write_split(df: DataFrame, path: str) -> None:
    """One table with a folder per `split` value; readers of one part touch no file of the other."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("split") == split).drop("split")


def features_and_target(df: DataFrame, target: str, row_id: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """X and y views of one table; both keep the row id, which is what pairs them."""
    return df.drop(target), df.select(row_id, target)


def read_scored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Scored or captured CSV with a header; empty cells are null."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def write_scored(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_pseudo_labels(df: DataFrame, path: str, cfg: ProblemConfig, label: str = "label_model") -> None:
    """Captured features with their new label, one table: row_id, features, label."""
    df.select("row_id", *cfg.features, F.col(label).alias(cfg.target)).write.mode("overwrite").parquet(path)


def read_captured(spark: SparkSession, path: str, target: str = "label") -> tuple[DataFrame, DataFrame]:
    return features_and_target(spark.read.parquet(path), target)


def write_folds(df: DataFrame, path: str) -> None:
    """A folder per fold; fold i is test, all others train."""
    df.write.mode("overwrite").partitionBy("fold").parquet(path)


def write_fitted(stats: DataFrame, path: str) -> None:
    """Category index, label map, fills, scales or bins as a small table."""
    stats.write.mode("overwrite").parquet(path)


def read_fitted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


RUN_SCHEMA = "run_id string, experiment string, kind string, name string, value string"


def experiment_name(cfg: ProblemConfig, model_name: str) -> str:
    return f"{cfg.phase_id}_{cfg.prob_id}_{model_name}-1"


def run_rows(
    spark: SparkSession, run_id: str, experiment: str, params: Mapping[str, object], metrics: Mapping[str, float]
) -> DataFrame:
    rows = [(run_id, experiment, "param", k, str(v)) for k, v in params.items()]
    rows += [(run_id, experiment, "metric", k, repr(float(v))) for k, v in metrics.items()]
    return small_table(spark, rows, RUN_SCHEMA)


def log_run(
    spark: SparkSession, path: str, run_id: str, experiment: str, params: Mapping[str, object], metrics: Mapping[str, float]
) -> None:
    """Append parameters and metrics of a run as (run_id, experiment, kind, name, value)."""
    run_rows(spark, run_id, experiment, params, metrics).coalesce(1).write.mode("append").parquet(path)


def save_model(model: Model, schema: T.StructType, path: str) -> None:
    """Fitted model with its input schema and kind beside it."""
    spark = SparkSession.getActiveSession()
    if type(model) in KINDS:
        KINDS[type(model)].save(model, spark, f"{path}/model")
    else:
        model.write().overwrite().save(f"{path}/model")
    small_table(spark, [(type(model).__name__,)], "value string").write.mode("overwrite").text(f"{path}/kind")
    small_table(spark, [(schema.json(),)], "value string").write.mode("overwrite").text(f"{path}/schema")


def load_model(spark: SparkSession, path: str) -> tuple[Model, T.StructType]:
    schema = T.StructType.fromJson(json.loads(spark.read.text(f"{path}/schema").first().value))
    own = {kind.__name__: module for kind, module in KINDS.items()}
    kind = spark.read.text(f"{path}/kind").first().value
    if kind in own:
        return own[kind].load(spark, f"{path}/model"), schema
    return PipelineModel.load(f"{path}/model"), schema


def model_path(root: str, name: str, version: int | str) -> str:
    return f"{root.rstrip('/')}/{name}/{version}"


def check_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Refuse a table that lacks or mistypes a column the model was fitted on."""
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f.name for f in schema.fields if have.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"input does not fit the model: {wrong}")
    return df


def capture_inventory(spark: SparkSession, roots: Sequence[str], pattern: str = "*.json") -> DataFrame:
    """(problem, files): captured files per folder; only file listings are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(list(roots)).select("path")
    folder = F.regexp_extract("path", r"([^/]+/[^/]+)/[^/]+$", 1)
    return files.groupBy(folder.alias("problem")).agg(F.count(F.lit(1)).alias("files"))
