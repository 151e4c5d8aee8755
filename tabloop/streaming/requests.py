"""Arriving requests: capture, score, flag drift, answer; one idempotent write per micro-batch."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabloop.config import ProblemConfig
from tabloop.operators.drift import THRESHOLD, drift_per_key
from tabloop.plans.scoring import Fitted, prepare
from tabloop.plans.training import score
from tabloop.sources.requests import REQUEST, parse_requests
from tabloop.sources.tables import run_rows


def read_request_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Request files as they arrive."""
    reader = (
        spark.readStream.schema(REQUEST)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .option("pathGlobFilter", "*.json")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path).select(
        "*", F.col("_metadata.file_modification_time").alias("arrival"), F.col("_metadata.file_path").alias("path")
    )


def respond(
    requests: DataFrame,
    cfg: ProblemConfig,
    fitted: Fitted,
    model: PipelineModel | None = None,
    reference: DataFrame | None = None,
    drift_col: str = "feature3",
    threshold: float = THRESHOLD,
) -> tuple[DataFrame, DataFrame]:
    """(responses, rejects) of a table of requests with a `request` key; every request is answered.

    A row that cannot be scored is answered with 0 and counted in `errors`, also when the whole request is
    rejected; without rows the list is empty. Lists are rebuilt from the rows of one input record, so they are as
    long as that record.
    """
    rows, rejects = parse_requests(requests, cfg, carry=["request"])
    keys = ("request", "id", "row_pos", "error")
    ready = prepare(rows, cfg, fitted, keys)
    complete = ~F.col("error")
    for c in cfg.features:
        complete = complete & F.col(c).isNotNull()
    good = ready.where(complete)
    good = score(model, good) if model is not None else good.withColumn("label_model", F.lit(0))
    answered = good.select("request", "id", "row_pos", F.col("label_model").cast("double").alias("prediction"), F.lit(0).alias("bad"))
    failed = ready.where(~complete).select("request", "id", "row_pos", F.lit(0.0).alias("prediction"), F.lit(1).alias("bad"))
    lists = answered.unionByName(failed).groupBy("request").agg(
        F.array_sort(F.collect_list(F.struct("row_pos", "prediction"))).alias("_l"), F.sum("bad").alias("errors")
    )
    lists = lists.select("request", F.col("_l.prediction").alias("_made"), F.col("errors").alias("_errors"))
    size = F.coalesce(F.size("rows"), F.lit(0))
    size = F.greatest(size, F.lit(0))  # the size of a missing list may be given as -1
    zeros = F.array_repeat(F.lit(0.0), size)
    out = requests.select("request", "id", zeros.alias("_zeros"), size.cast("bigint").alias("_rows"))
    out = out.join(lists, "request", "left").select(
        "request", "id", F.coalesce("_made", "_zeros").alias("predictions"), F.coalesce("_errors", "_rows").alias("errors")
    )
    if reference is not None:
        flags = drift_per_key(reference, rows, "request", drift_col, threshold)
        out = out.join(flags.select("request", F.col("is_drift").alias("drift")), "request", "left")
    else:
        out = out.withColumn("drift", F.lit(0))
    return out.withColumn("drift", F.coalesce("drift", F.lit(0))), rejects


def score_stream(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    cfg: ProblemConfig,
    fitted: Fitted,
    model: PipelineModel | None = None,
    reference: DataFrame | None = None,
    max_files: int | None = None,
    **trigger,
) -> StreamingQuery:
    """Answer arriving requests. Each micro-batch writes its own folder, so a repeated batch replaces itself."""

    def handle(batch: DataFrame, number: int) -> None:
        # a number per record tells repeated ids apart; files are cut the same way when read again
        batch = batch.withColumn("request", F.monotonically_increasing_id()).persist()
        try:
            folder = f"batch={number}"
            batch.select("id", "rows", "columns", "request", "arrival", "path").write.mode("overwrite").parquet(
                f"{out_dir}/captured/{folder}"
            )
            responses, rejects = respond(batch, cfg, fitted, model, reference)
            responses.write.mode("overwrite").parquet(f"{out_dir}/responses/{folder}")
            rejects.write.mode("overwrite").parquet(f"{out_dir}/rejects/{folder}")
        finally:
            batch.unpersist()

    return (
        read_request_stream(spark, in_dir, max_files)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def progress_rows(spark: SparkSession, query: StreamingQuery, run_id: str, experiment: str) -> DataFrame:
    """Latency and throughput of the query's recent batches, in the run log's form."""
    metrics = {}
    for progress in query.recentProgress:
        p = progress if isinstance(progress, dict) else json.loads(progress.json)
        metrics[f"batch_{p['batchId']}_ms"] = p["durationMs"].get("triggerExecution", 0)
        metrics[f"batch_{p['batchId']}_rows_per_second"] = p.get("processedRowsPerSecond") or 0.0
    return run_rows(spark, run_id, experiment, {}, metrics)
