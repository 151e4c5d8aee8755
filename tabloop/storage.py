"""Where intermediate tables go: the shared folder the session names, never a worker's own disk."""

from __future__ import annotations

import contextlib
import gc
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

CHECKPOINT_CONF = "spark.checkpoint.dir"
RELEASE_S = 0.5  # until the JVM knows which tables Python has dropped
ARROW_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
ARROW_BYTES = 4 * 1024 * 1024


def checkpoint_root(spark: SparkSession) -> str:
    """Folder the session names: its checkpoint folder, else one in its warehouse."""
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tabloop"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table; all of an application's lie in one folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def scratch_root(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables."""
    return f"{checkpoint_root(spark).rstrip('/')}/tabloop-{spark.sparkContext.applicationId}"


def remove_scratch(spark: SparkSession) -> bool:
    """Deletes this application's intermediate tables, once nothing reads them any more; whether there were any."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, name: str = "table", **options: int) -> DataFrame:
    """Write `df` once as Parquet and read it back: later uses scan only the columns they need, and neither
    repeat its work nor depend on the executors that did it. `options` are the writer's."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, most: int = ARROW_BYTES) -> Iterator[None]:
    """What is written meanwhile sends rows to Python in batches of `most` bytes, or of the row that goes beyond it.

    By default a batch has 64 MB, in the JVM beside its heap and again in the worker. The session's own setting comes back.
    """
    was = spark.conf.get(ARROW_CONF, None)
    spark.conf.set(ARROW_CONF, most)
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(ARROW_CONF)
        else:
            spark.conf.set(ARROW_CONF, was)


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of tables that nothing refers to any more, before a large next step.

    Spark's cleaner acts when the driver's JVM collects its garbage, which a quiet driver does rarely. Python tells the
    JVM of tables it has dropped from a thread that looks every 0.1 s; collecting before that would find them in use.
    """
    gc.collect()
    time.sleep(RELEASE_S)
    spark._jvm.System.gc()


def pin_partitions(df: DataFrame) -> DataFrame:
    """Like `settle`, but partitions and the order of rows inside them stay as they are."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A handful of rows as a table that lives in the plan; no job is needed to read it."""
    kinds = to_arrow_schema(T._parse_datatype_string(schema))
    columns = zip(*rows) if rows else ([] for _ in kinds)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, kinds, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=kinds))
