"""Drift of captured data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloop.catalog import query
from tabloop.catalog.fixtures import REQUEST_ROWS, h, request_rows, sql, table
from tabloop.catalog.requests import JS
from tabloop.operators import drift

CUT = "2024-01-16"
SIDES = f"""ref as (select event_type, value from events where ts < timestamp '{CUT}'),
cur as (select event_type, value from events where ts >= timestamp '{CUT}')"""


def sides(spark, sf):
    events = table(spark, sf, "events")
    before = F.col("ts") < F.lit(CUT).cast("timestamp")
    cols = ["event_type", "value"]
    return events.where(before).select(*cols), events.where(~before).select(*cols)


def shares(col: str, ref: str = "ref", cur: str = "cur") -> str:
    return f"""p as (select {col} as k, count(*) / (select count({col}) from {ref}) as p from {ref} group by 1),
q as (select {col} as k, count(*) / (select count({col}) from {cur}) as q from {cur} group by 1),
pq as (select coalesce(p, 0) as p, coalesce(q, 0) as q from p full join q on p.k = q.k)"""


JS_SUM = "sqrt(sum(case when p > 0 then p * ln(p / ((p + q) / 2)) else 0 end + case when q > 0 then q * ln(q / ((p + q) / 2)) else 0 end) / 2)"


def _scored(df):
    return df.withColumn("score", F.round("score", 6))


def _verdict(col: str, expression: str, source: str) -> str:
    return f"""select '{col}' as col, round(score, 6) as score, cast(score > 0.1::double as integer) as is_drift
from (select {expression} as score from {source})"""


@query(
    "distribution",
    sql(SIDES, final="select 'event_type' as col, event_type as category, count(*) as n, round(count(*) / (select count(*) from ref), 6) as p from ref group by event_type"),
)
def distribution(spark, sf):
    return drift.fit_distribution(sides(spark, sf)[0], ["event_type"]).withColumn("p", F.round("p", 6))


@query("drift_js", sql(SIDES, shares("event_type"), final=_verdict("event_type", JS_SUM, "pq")))
def drift_js(spark, sf):
    return _scored(drift.column_drift(*sides(spark, sf), ["event_type"]))


PRIORITY = """ref as (select o_orderpriority as v from orders),
cur as (select case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'HIGH' else o_orderpriority end as v from orders)"""


@query("drift_js_moved", sql(PRIORITY, shares("v"), final=_verdict("v", JS_SUM, "pq")))
def drift_js_moved(spark, sf):
    """Two categories merged into a new one: drift."""
    orders = table(spark, sf, "orders")
    merged = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "HIGH").otherwise(F.col("o_orderpriority"))
    return _scored(drift.column_drift(orders.select(F.col("o_orderpriority").alias("v")), orders.select(merged.alias("v")), ["v"]))


PSI_SUM = "sum((greatest(q, 0.0001::double) - greatest(p, 0.0001::double)) * ln(greatest(q, 0.0001::double) / greatest(p, 0.0001::double)))"


@query("drift_psi", sql(PRIORITY, shares("v"), final=_verdict("v", PSI_SUM, "pq")))
def drift_psi(spark, sf):
    orders = table(spark, sf, "orders")
    merged = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "HIGH").otherwise(F.col("o_orderpriority"))
    return _scored(
        drift.column_drift(orders.select(F.col("o_orderpriority").alias("v")), orders.select(merged.alias("v")), ["v"], "psi")
    )


ECDF = """v as (select value as x, 1 as r, 0 as c from ref union all select value, 0, 1 from cur),
g as (select x, sum(r) as r, sum(c) as c from v where x is not null group by x),
f as (select x, lead(x) over (order by x) - x as step, sum(r) over (order by x) / (select count(value) from ref) as a,
  sum(c) over (order by x) / (select count(value) from cur) as b from g)"""


@query(
    "drift_wasserstein",
    sql(SIDES, ECDF, final=_verdict("value", "sum(abs(a - b) * step) / (select stddev_pop(value) from ref)", "f")),
)
def drift_wasserstein(spark, sf):
    return _scored(drift.column_drift(*sides(spark, sf), ["value"]))


@query("drift_ks", sql(SIDES, ECDF, final=_verdict("value", "max(abs(a - b))", "f")))
def drift_ks(spark, sf):
    return _scored(drift.column_drift(*sides(spark, sf), ["value"], "ks"))


LINES = """ref as (select l_extendedprice as value from lineitem where l_returnflag = 'N'),
cur as (select l_extendedprice * 1.5::double as value from lineitem where l_returnflag <> 'N')"""


@query(
    "drift_wasserstein_buckets",
    sql(
        LINES, ECDF,
        final="select 'value' as col, round(sum(abs(a - b) * step) / (select stddev_pop(value) from ref), 6) as score from f",
    ),
)
def drift_wasserstein_buckets(spark, sf):
    """Running sums over many quantile buckets."""
    rows = table(spark, sf, "lineitem")
    kept = F.col("l_returnflag") == "N"
    reference = rows.where(kept).select(F.col("l_extendedprice").alias("value"))
    current = rows.where(~kept).select((F.col("l_extendedprice") * 1.5).alias("value"))
    return _scored(drift.wasserstein(reference, current, "value", window_rows=2000))


@query(
    "drift_sampled_reference",
    sql(
        f"""ref as (select o_orderpriority as v from orders qualify row_number() over (order by {h("o_orderkey||':1'")}, o_orderkey) <= (select count(*) // 2 from orders)),
cur as (select o_orderpriority as v from orders)""",
        shares("v"),
        final=_verdict("v", JS_SUM, "pq"),
    ),
)
def drift_sampled_reference(spark, sf):
    """A seeded sample of exact size as the reference."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_orderpriority").alias("v"))
    sample = drift.reference_sample(orders, orders.count() // 2)
    return _scored(drift.column_drift(sample, orders, ["v"]))


@query(
    "drift_share",
    sql(
        SIDES,
        shares("event_type"),
        ECDF,
        f"scores as (select {JS_SUM} as score from pq union all select sum(abs(a - b) * step) / (select stddev_pop(value) from ref) from f)",
        final="select cast(count(*) filter (where score > 0.1::double) as bigint) as n, avg(cast(score > 0.1::double as integer)) as share from scores",
    ),
)
def drift_share(spark, sf):
    return drift.dataset_drift(drift.column_drift(*sides(spark, sf), ["event_type", "value"]))


@query(
    "drift_per_request",
    sql(REQUEST_ROWS, JS, final="select id, round(score, 6) as score, cast(score > 0.1::double as integer) as is_drift from js"),
)
def drift_per_request(spark, sf):
    rows = request_rows(spark, sf)
    return _scored(drift.drift_per_key(drift.fit_distribution(rows, ["feature3"]), rows))


@query("drift_rate", sql(REQUEST_ROWS, JS, final="select avg(cast(score > 0.1::double as integer)) as rate from js"))
def drift_rate(spark, sf):
    rows = request_rows(spark, sf)
    return drift.drift_rate(drift.drift_per_key(drift.fit_distribution(rows, ["feature3"]), rows))


BINS = """cuts as (select list_sort(list_distinct(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) as c from r0),
ref as (select len(list_filter(c, lambda x: value > x)) as v from r0, cuts),
cur as (select len(list_filter(c, lambda x: value > x)) as v from c0, cuts)"""


@query(
    "drift_binned",
    sql(SIDES.replace("ref as", "r0 as").replace("cur as", "c0 as"), BINS, shares("v"), final=_verdict("value", JS_SUM, "pq")),
)
def drift_binned(spark, sf):
    """A number compared by the reference's decile bins."""
    reference, current = sides(spark, sf)
    cuts = drift.fit_bins(reference, ["value"])
    binned = [drift.apply_bins(d.select("value"), cuts) for d in (reference, current)]
    return _scored(drift.column_drift(*binned, ["value"], "js"))


@query(
    "drift_by_request_day",
    sql(
        "request_rows as (select strftime(ts, '%Y%m%d') as id, event_type as feature3 from events)",
        JS,
        final="select id, round(score, 6) as score, cast(score > 0.1::double as integer) as is_drift from js",
    ),
)
def drift_by_request_day(spark, sf):
    rows = table(spark, sf, "events").select(F.date_format("ts", "yyyyMMdd").alias("id"), F.col("event_type").alias("feature3"))
    return _scored(drift.drift_per_key(drift.fit_distribution(rows, ["feature3"]), rows))


LONG = """ev as (select *, case when event_id % 7 <> 0 then strftime(ts, '%Y%m%d') end as id from events),
cuts as (select list_sort(list_distinct(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) as c from events),
long as (select id, 'event_type' as col, event_type as category from ev
  union all select id, 'value', cast(len(list_filter(c, lambda x: value > x)) as varchar) from ev, cuts),
ref as (select col, category, count(*) / sum(count(*)) over (partition by col) as p from long group by 1, 2),
cur as (select id, col, category, count(*) / sum(count(*)) over (partition by id, col) as q from long group by 1, 2, 3),
cross_ as (select k.id, k.col, r.p, coalesce(c.q, 0) as q from (select distinct id, col from long) k join ref r on r.col = k.col
  left join cur c on c.id is not distinct from k.id and c.col = k.col and c.category = r.category),
js as (select id, col, sqrt(sum(p * ln(p / ((p + q) / 2)) + case when q > 0 then q * ln(q / ((p + q) / 2)) else 0 end) / 2) as score
  from cross_ group by id, col)"""


@query(
    "drift_per_key_columns",
    sql(LONG, final="select id, col, round(score, 6) as score, cast(score > 0.1::double as integer) as is_drift from js"),
)
def drift_per_key_columns(spark, sf):
    """Several columns per day, a number among them by its decile bins; events without a day are one key."""
    events = table(spark, sf, "events")
    day = F.when(F.col("event_id") % 7 != 0, F.date_format("ts", "yyyyMMdd")).alias("id")
    cols = ["event_type", "value"]
    rows = drift.apply_bins(events.select(day, *cols), drift.fit_bins(events, ["value"]))
    return _scored(drift.drift_per_key_columns(drift.fit_distribution(rows, cols), rows, cols=cols))
