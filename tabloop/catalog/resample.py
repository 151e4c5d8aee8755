"""Class rebalancing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloop.catalog import query
from tabloop.catalog import steps as s
from tabloop.catalog.fixtures import (
    COMPLETE,
    DOCUMENTS,
    LABELLED,
    QUALITY_FEATURES,
    VECTOR_FEATURES,
    VECTORS,
    documents,
    h,
    labelled,
    rounded,
    sql,
    table,
    wide_vectors,
)
from tabloop.operators import resample

SMOTED = f"row_id, {s.rounded_columns(QUALITY_FEATURES)}, label, copy, is_synthetic"


def _documents(spark, sf):
    return documents(spark, sf).select("row_id", *QUALITY_FEATURES, "label")


@query("smote_binary", sql(DOCUMENTS, *s.smote_sql("sm", "docs", "label", QUALITY_FEATURES), final=f"select {SMOTED} from sm"))
def smote_binary(spark, sf):
    return rounded(resample.smote(_documents(spark, sf), "label", QUALITY_FEATURES), QUALITY_FEATURES)


@query(
    "smote_k10_synthetic",
    sql(
        DOCUMENTS,
        *s.smote_sql("sm", "docs", "label", QUALITY_FEATURES, k=10, seed=42),
        final=f"select {SMOTED} from sm where is_synthetic",
    ),
)
def smote_k10_synthetic(spark, sf):
    raised = resample.smote(_documents(spark, sf), "label", QUALITY_FEATURES, k=10, seed=42)
    return rounded(resample.synthetic_only(raised), QUALITY_FEATURES)


@query(
    "smote_multiclass",
    sql(
        VECTORS,
        *s.smote_sql("sm", "vectors", "label", VECTOR_FEATURES),
        final=f"select row_id, {s.rounded_columns(VECTOR_FEATURES)}, label, copy, is_synthetic from sm",
    ),
)
def smote_multiclass(spark, sf):
    return rounded(resample.smote(wide_vectors(spark, sf), "label", VECTOR_FEATURES), VECTOR_FEATURES)


@query(
    "smote_minority",
    sql(
        VECTORS,
        *s.smote_sql("sm", "vectors", "label", VECTOR_FEATURES, strategy="minority"),
        final="select label, is_synthetic, count(*) as n, round(sum(e0), 6) as sum_e0, round(sum(e63), 6) as sum_e63 from sm group by 1, 2",
    ),
)
def smote_minority(spark, sf):
    raised = resample.smote(wide_vectors(spark, sf), "label", VECTOR_FEATURES, strategy="minority")
    return raised.groupBy("label", "is_synthetic").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("e0"), 6).alias("sum_e0"), F.round(F.sum("e63"), 6).alias("sum_e63")
    )


ORDER_FEATURES = ("feature1", "feature2")


@query(
    "smote_orders",
    sql(
        COMPLETE,
        *s.smote_sql("sm", "complete", "label", ORDER_FEATURES),
        final=f"select row_id, {s.rounded_columns(ORDER_FEATURES)}, label, copy, is_synthetic from sm",
    ),
)
def smote_orders(spark, sf):
    """Larger classes: neighbours are searched over several leaves."""
    rows = labelled(spark, sf, gaps=False).select("row_id", *ORDER_FEATURES, "label")
    return rounded(resample.smote(rows, "label", ORDER_FEATURES, leaf_rows=1024), ORDER_FEATURES)


@query(
    "smote_cluster_given",
    sql(
        COMPLETE,
        "stats as (select feature4 as c, count(*) as n, count(*) filter (where label = 1) as m, "
        "coalesce(var_samp(feature1) filter (where label = 1), 0) + coalesce(var_samp(feature2) filter (where label = 1), 0) as v from complete group by 1)",
        "rich as (select *, sqrt(2 * v) ** ((ln(m) / ln(1.6::double)) ** 1.8::double * 0.16::double) / m as w from stats where m / n >= 0.2::double and m > 5)",
        "missing as (select count(*) filter (where label = 0) - count(*) filter (where label = 1) as x from complete)",
        "want as (select c as g, m as n, cast(ceil(round((select x from missing) * (w / (select sum(w) from rich)), 9)) as bigint) as w from rich)",
        "minority as (select * from complete where label = 1)",
        *s.synthesise_sql("made", "minority", "label", ORDER_FEATURES, "feature4", "want", 5, 1242),
        final=f"""select row_id, {s.rounded_columns(ORDER_FEATURES)}, label, copy, is_synthetic from made where is_synthetic
union all select row_id, {s.rounded_columns(ORDER_FEATURES)}, label, 0, false from complete""",
    ),
)
def smote_cluster_given(spark, sf):
    """New rows inside given clusters, shared out by sparsity."""
    rows = labelled(spark, sf, gaps=False)
    raised = resample.cluster_smote(rows, "feature4", "label", ORDER_FEATURES, balance_threshold=0.2)
    return rounded(raised, ORDER_FEATURES)


@query(
    "undersample",
    sql(
        LABELLED,
        final=f"""select row_id, label_multi from labelled
qualify row_number() over (partition by label_multi order by {h("row_id||':1242'")}, row_id)
  <= (select min(n) from (select count(*) as n from labelled group by label_multi))""",
    ),
)
def undersample(spark, sf):
    return resample.undersample(labelled(spark, sf).select("row_id", "label_multi"), "label_multi")


@query(
    "undersample_events",
    sql(
        final=f"""select event_type, event_id from events
qualify row_number() over (partition by event_type order by {h("event_id||':7'")}, event_id)
  <= (select min(n) from (select count(*) as n from events group by event_type))"""
    ),
)
def undersample_events(spark, sf):
    return resample.undersample(table(spark, sf, "events").select("event_type", "event_id"), "event_type", 7, "event_id")
