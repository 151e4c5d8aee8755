"""Inputs of the registered queries, derived from the given tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloop.config import ProblemConfig
from tabloop.functions.keys import hash_key

FEATURES = ("feature1", "feature2", "feature3", "feature4")
CATEGORICAL = ("feature3", "feature4")
NUMERICAL = ("feature1", "feature2")


def config(phase: str = "phase-1", problem: str = "prob-1", target: str = "label") -> ProblemConfig:
    return ProblemConfig(phase, problem, target, CATEGORICAL, NUMERICAL, features=FEATURES)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def h(text: str) -> str:
    """SQL of functions.keys.hash_key."""
    return f"(('0x'||substr(md5({text}),1,8))::bigint)"


def sql(*ctes: str, final: str) -> str:
    return ("with " + ",\n".join(ctes) + "\n" if ctes else "") + final


# labelled rows: orders with their customer; some cells are missing


def labelled(spark: SparkSession, sf: str, gaps: bool = True) -> DataFrame:
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    if gaps:
        price = F.when(hash_key(key, ":tp") % 20 != 0, price)
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        key.alias("row_id"),
        price.alias("feature1"),
        F.col("c_acctbal").alias("feature2"),
        F.when(hash_key(key, ":pr") % 20 != 0, F.col("o_orderpriority")).alias("feature3"),
        F.col("c_mktsegment").alias("feature4"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        F.col("o_orderstatus").alias("label_multi"),
    )


def _labelled_sql(name: str, price: str) -> str:
    return f"""{name} as (
  select o_orderkey as row_id, {price} as feature1, c_acctbal as feature2,
    case when {h("o_orderkey||':pr'")} % 20 <> 0 then o_orderpriority end as feature3,
    c_mktsegment as feature4, cast(o_orderstatus = 'F' as integer) as label, o_orderstatus as label_multi
  from orders join customer on o_custkey = c_custkey)"""


LABELLED = _labelled_sql("labelled", f"case when {h("o_orderkey||':tp'")} % 20 <> 0 then o_totalprice end")
COMPLETE = _labelled_sql("complete", "o_totalprice")

# scored rows: events with the label and confidence of a model


def scored(spark: SparkSession, sf: str, model: str = "m1", base: int = 9000, span: int = 1000) -> DataFrame:
    k = hash_key(F.col("event_id"), f":{model}")
    positive = F.col("event_id") % 3 == 0
    return (
        table(spark, sf, "events")
        .withColumn("k", k)
        .select(
            F.col("event_id").alias("row_id"),
            F.col("value").alias("feature2"),
            F.col("event_type").alias("feature3"),
            F.when(F.col("k") % 20 == 0, ~positive).otherwise(positive).cast("int").alias("label_model"),
            ((F.col("k") % span + base) / 10000).alias("prob"),
        )
    )


def scored_sql(name: str, model: str = "m1", base: int = 9000, span: int = 1000) -> str:
    k = h(f"event_id||':{model}'")
    return f"""{name} as (
  select event_id as row_id, value as feature2, event_type as feature3,
    cast(case when {k} % 20 = 0 then event_id % 3 <> 0 else event_id % 3 = 0 end as integer) as label_model,
    ({k} % {span} + {base}) / 10000 as prob
  from events)"""


def truth(df: DataFrame) -> DataFrame:
    """Scored rows with the label they should have had."""
    return df.withColumn("label", (F.col("row_id") % 3 == 0).cast("int"))


# requests: events of a user and day; the column order differs from the feature order

REQUEST_COLUMNS = ("feature2", "feature3", "feature1")


def request_config() -> ProblemConfig:
    return ProblemConfig(
        "phase-3",
        "prob-1",
        categorical=("feature3",),
        numerical=("feature1", "feature2"),
        features=("feature1", "feature2", "feature3"),
        types={"feature1": "int"},
    )


def request_rows(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_format("ts", "yyyyMMdd")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("row_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), day).alias("id"),
        F.hour("ts").alias("feature1"),
        F.col("value").alias("feature2"),
        F.col("event_type").alias("feature3"),
    )


REQUEST_ROWS = """request_rows as (
  select event_id as row_id, user_id||'-'||strftime(ts, '%Y%m%d') as id,
    cast(hour(ts) as integer) as feature1, value as feature2, event_type as feature3
  from events)"""

# small imbalanced table: labelled documents

QUALITY_FEATURES = ("feature1", "feature2")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "documents")
        .join(table(spark, sf, "labels"), "doc_id")
        .select(
            F.col("doc_id").alias("row_id"),
            F.col("n_chars").cast("double").alias("feature1"),
            F.length("source").cast("double").alias("feature2"),
            F.col("lang").alias("feature3"),
            F.col("source").alias("feature4"),
            F.col("quality").alias("label"),
        )
    )


DOCUMENTS = """docs as (
  select documents.doc_id as row_id, cast(n_chars as double) as feature1, cast(length(source) as double) as feature2,
    lang as feature3, source as feature4, quality as label
  from documents join labels on documents.doc_id = labels.doc_id)"""

# vectors of ten classes

DIMS = 64
VECTOR_FEATURES = tuple(f"e{i}" for i in range(DIMS))


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.col("embedding").cast("array<double>").alias("vec"), "label"
    )


def wide_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return vectors(spark, sf).select("row_id", *[F.col("vec")[i].alias(f"e{i}") for i in range(DIMS)], "label")


VECTORS = (
    "vectors as (select vec_id as row_id, "
    + ", ".join(f"cast(embedding[{i + 1}] as double) as e{i}" for i in range(DIMS))
    + ", label from embeddings)"
)

# captured rows with the model's label: orders at half price

CAPTURED_FIRST = 1_000_000_000_000


def captured(spark: SparkSession, sf: str, multi: bool = False) -> DataFrame:
    rows = labelled(spark, sf, gaps=False).join(
        table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("batch_id")), "row_id"
    )
    k = F.col("k")
    binary = F.when(k % 10 < 3, 1).otherwise(0)
    classes = F.when(k % 10 < 6, "O").when(k % 10 < 9, "F").otherwise("P")
    return rows.withColumn("k", hash_key(F.col("row_id"), ":captured")).select(
        (F.col("row_id") + CAPTURED_FIRST).alias("row_id"),
        "batch_id",
        F.lit(0).alias("is_drift"),
        (F.col("feature1") / 2).alias("feature1"),
        "feature2",
        "feature3",
        "feature4",
        (classes if multi else binary).alias("label_model"),
        ((k % 5000 + 5000) / 10000).alias("prob"),
    )


def captured_sql(name: str = "captured", multi: bool = False) -> str:
    k = h("row_id||':captured'")
    binary = f"case when {k} % 10 < 3 then 1 else 0 end"
    classes = f"case when {k} % 10 < 6 then 'O' when {k} % 10 < 9 then 'F' else 'P' end"
    return f"""{name} as (
  select row_id + {CAPTURED_FIRST} as row_id, feature1 / 2 as feature1, feature2, feature3, feature4,
    {classes if multi else binary} as label_model, ({k} % 5000 + 5000) / 10000 as prob
  from complete)"""


# labelled rows of an earlier phase: customers with their nation


def earlier(spark: SparkSession, sf: str, multi: bool = False) -> DataFrame:
    nation = F.col("c_nationkey") % 3
    classes = F.when(nation == 0, "F").when(nation == 1, "O").otherwise("P")
    joined = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        (-1 - F.col("c_custkey")).alias("row_id"),
        (F.col("c_acctbal") * 10).alias("feature1"),
        F.col("c_acctbal").alias("feature2"),
        F.col("n_name").alias("feature3"),
        F.col("c_mktsegment").alias("feature4"),
        (classes if multi else (nation == 0).cast("int")).alias("label"),
    )


def earlier_sql(name: str = "earlier", multi: bool = False) -> str:
    classes = "case c_nationkey % 3 when 0 then 'F' when 1 then 'O' else 'P' end"
    return f"""{name} as (
  select -1 - c_custkey as row_id, c_acctbal * 10 as feature1, c_acctbal as feature2, n_name as feature3,
    c_mktsegment as feature4, {classes if multi else "cast(c_nationkey % 3 = 0 as integer)"} as label
  from customer join nation on c_nationkey = n_nationkey)"""


def rounded(df: DataFrame, cols, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), places) for c in cols})


