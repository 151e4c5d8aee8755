"""Captured requests: parse, export, capture, answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloop.catalog import query
from tabloop.catalog.fixtures import (
    REQUEST_COLUMNS,
    REQUEST_ROWS,
    h,
    request_config,
    request_rows,
    scored,
    scored_sql,
    sql,
    table,
)
from tabloop.operators import drift, encode
from tabloop.operators import stats as fitted_stats
from tabloop.plans.improve import captured_table
from tabloop.plans.scoring import Fitted
from tabloop.sources import requests as R
from tabloop.sources.tables import capture_inventory
from tabloop.storage import scratch_path
from tabloop.streaming.requests import respond, score_stream

PLACED = "placed as (select *, cast(row_number() over (partition by id order by row_id) - 1 as integer) as row_pos from request_rows)"


def requests(spark, sf):
    """The request records as captured."""
    return R.export_requests(request_rows(spark, sf), "id", REQUEST_COLUMNS).drop("part")


def captured_folder(spark, sf) -> str:
    path = scratch_path(spark, "captured")
    R.capture(requests(spark, sf), path)
    return path


@query(
    "request_export",
    sql(
        REQUEST_ROWS,
        final="""select id, 0::bigint as part, list([case when feature2 = trunc(feature2) then cast(cast(feature2 as bigint) as varchar) else cast(feature2 as varchar) end,
  feature3, cast(feature1 as varchar)] order by row_id) as rows, ['feature2', 'feature3', 'feature1'] as columns
from request_rows group by id""",
    ),
)
def request_export(spark, sf):
    return R.export_requests(request_rows(spark, sf), "id", REQUEST_COLUMNS)


@query(
    "request_parse",
    sql(REQUEST_ROWS, PLACED, final="select id, row_pos, feature1, feature2, feature3, false as error from placed"),
)
def request_parse(spark, sf):
    """Requests written as JSON, read back and typed."""
    return R.parse_requests(R.read_requests(spark, captured_folder(spark, sf)), request_config())[0]


@query(
    "request_rejects",
    sql(
        REQUEST_ROWS,
        "ids as (select distinct id, " + h("id") + " % 10 as k from request_rows)",
        final="select id, case when k < 2 then 'no rows' else 'no columns' end as reason from ids where k < 4",
    ),
)
def request_rejects(spark, sf):
    """Requests that lost their rows or columns are set aside with the reason."""
    k = R.hash_key(F.col("id")) % 10
    broken = requests(spark, sf).select(
        "id", F.when(k >= 2, F.col("rows")).alias("rows"), F.when((k < 2) | (k >= 4), F.col("columns")).alias("columns")
    )
    return R.parse_requests(broken, request_config())[1]


@query(
    "request_bad_cells",
    sql(
        "c as (select doc_id as row_id, lang, try_cast(regexp_extract(text, '^\\S+') as double) as x, regexp_extract(text, '^\\S+') as t from documents)",
        final="select cast(row_id as varchar) as id, 0 as row_pos, cast(null as integer) as feature1, x as feature2, lang as feature3, x is null and t is not null as error from c",
    ),
)
def request_bad_cells(spark, sf):
    """Cells that are no numbers where one is declared: the row is flagged, its value missing."""
    word = F.regexp_extract("text", r"^\S+", 0)
    records = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.array(F.array(word, F.col("lang"))).alias("rows"),
        F.array(F.lit("feature2"), F.lit("feature3")).alias("columns"),
    )
    return R.parse_requests(records, request_config())[0]


@query(
    "latest_capture",
    sql(
        REQUEST_ROWS,
        "sent as (select cast(split_part(id, '-', 1) as varchar) as id, max(split_part(id, '-', 2)) as arrival from request_rows group by 1)",
        "last as (select s.id, s.arrival, r.row_id from sent s join request_rows r on r.id = s.id||'-'||s.arrival)",
        final="select id, arrival, cast(count(*) as integer) as n from last group by id, arrival",
    ),
)
def latest_capture(spark, sf):
    """One id per user, sent every day: the last day's request stays."""
    both = F.split("id", "-")
    sent = requests(spark, sf).select(both[0].alias("id"), "rows", "columns", both[1].alias("arrival"))
    return R.latest_requests(sent).select("id", "arrival", F.size("rows").alias("n"))


@query(
    "latest_capture_unnamed",
    sql(
        REQUEST_ROWS,
        "cells as (select id, 'v'||case when feature2 = trunc(feature2) then cast(cast(feature2 as bigint) as varchar) else cast(feature2 as varchar) end||'|v'||feature3||'|v'||feature1||'|' as t from request_rows)",
        "named as (select id as sent, cast(sum(" + h("t") + ") as varchar) as id, cast(count(*) as integer) as n from cells group by 1)",
        final="select distinct id, n from named",
    ),
)
def latest_capture_unnamed(spark, sf):
    """Requests without an id, or a blank one, are named by their rows, so none replaces another."""
    k = R.hash_key(F.col("id")) % 2
    sent = requests(spark, sf).select(F.when(k == 0, " ").alias("id"), "rows", "columns", F.lit(1).alias("arrival"))
    return R.latest_requests(sent).select("id", F.size("rows").alias("n"))


BROKEN = "sent as (select id, count(*) as n, " + h("id") + " % 10 as k from request_rows group by 1)"


@query(
    "respond_all",
    sql(
        REQUEST_ROWS,
        BROKEN,
        final="""select id as request, case when k = 3 then ' ' when k <> 4 then id end as id,
  case when k < 2 then [] else list_transform(range(n), lambda i: 0.0::double) end as predictions,
  case when k = 2 or k = 5 then n else 0 end as errors, 0 as drift from sent""",
    ),
)
def respond_all(spark, sf):
    """One answer per request: without rows, with an empty list, without columns, blank or null id, a bad cell."""
    k = R.hash_key(F.col("id")) % 10
    bad = F.transform("rows", lambda r: F.concat(F.array(F.lit("x")), F.slice(r, 2, 2)))
    rows = F.when(k == 1, F.array().cast("array<array<string>>")).when(k == 5, bad).when(k > 1, F.col("rows"))
    sent = requests(spark, sf).select(
        F.col("id").alias("request"), F.when(k == 3, " ").when(k != 4, F.col("id")).alias("id"), rows.alias("rows"),
        F.when(k != 2, F.col("columns")).alias("columns"),
    )
    source, cfg = request_rows(spark, sf), request_config()
    fitted = Fitted(encode.fit_category_index(source, cfg.categorical))
    return respond(sent, cfg, fitted)[0].select("request", "id", "predictions", "errors", "drift")


@query(
    "content_id",
    sql(
        REQUEST_ROWS,
        "named as (select id as request, case when feature1 % 2 = 0 then ' ' else '' end as given, "
        + h("'v'||feature2||'|v'||feature3||'|'")
        + " as k from request_rows)",
        final="select request, cast(sum(k) as varchar) as name from named group by request",
    ),
)
def content_id(spark, sf):
    """Blank ids are replaced by a hash of the rows, whatever their order."""
    rows = request_rows(spark, sf)
    blank = F.when(F.col("feature1") % 2 == 0, " ").otherwise("")
    return R.content_id(rows.select(F.col("id").alias("request"), blank.alias("id"), "feature2", "feature3"), ["feature2", "feature3"])


@query("content_id_given", sql(REQUEST_ROWS, final="select distinct id as request, id as name from request_rows"))
def content_id_given(spark, sf):
    rows = request_rows(spark, sf)
    return R.content_id(rows.withColumn("request", F.col("id")), ["feature2", "feature3"])


@query("batch_submission", sql(scored_sql("m"), final="""select user_id as batch_id, 0::bigint as part, list(label_model order by row_id) as "values"
from m join events on event_id = row_id group by user_id"""))
def batch_submission(spark, sf):
    """Labels per batch in row order; a batch is a user's events."""
    users = table(spark, sf, "events").select(F.col("event_id").alias("row_id"), F.col("user_id").alias("batch_id"))
    return R.collect_per_key(scored(spark, sf).join(users, "row_id"), "batch_id", F.col("label_model"))


@query("batch_submission_parts", """select batch_id, part, list(label order by event_id) as "values" from (
  select event_type as batch_id, event_id, cast(event_id % 3 as integer) as label,
    (row_number() over (partition by event_type order by event_id) - 1) // 100 as part from events) group by 1, 2""")
def batch_submission_parts(spark, sf):
    """Batches above the list limit come in consecutive parts of bounded length."""
    rows = table(spark, sf, "events").select(
        F.col("event_type").alias("batch_id"), F.col("event_id").alias("row_id"), (F.col("event_id") % 3).cast("int").alias("label")
    )
    return R.collect_per_key(rows, "batch_id", F.col("label"), limit=100)


@query("batch_keys", "select distinct user_id as batch_id from events")
def batch_keys(spark, sf):
    return table(spark, sf, "events").select(F.col("user_id").alias("batch_id")).distinct()


@query("capture_inventory")
def inventory(spark, sf):
    """Files per captured folder; the number of files follows Spark's own writing."""
    return capture_inventory(spark, [captured_folder(spark, sf)])


@query(
    "captured_rows_csv",
    sql(REQUEST_ROWS, final="select id, count(*) as n, round(sum(feature2), 4) as total from request_rows group by 1"),
)
def captured_rows_csv(spark, sf):
    """Request rows as CSV, a bounded number of files for all ids, read back."""
    path = scratch_path(spark, "rows")
    R.capture_rows(request_rows(spark, sf).select("id", "feature1", "feature2"), path, files=8)
    back = spark.read.schema("id string, feature1 int, feature2 double").option("header", True).csv(path)
    return back.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("feature2"), 4).alias("total"))


@query(
    "captured_table",
    sql(
        REQUEST_ROWS,
        PLACED,
        "numbered as (select row_number() over (order by id, row_pos) - 1 as row_id, id as batch_id, row_pos, feature1, feature2, feature3 from placed)",
        final=f"""select * from numbered
qualify row_number() over (order by {h("row_id||':1'")}, row_id) <= (select count(*) // 2 from numbered)""",
    ),
)
def captured_rows(spark, sf):
    """Latest requests as one table, sampled to an exact size."""
    records = requests(spark, sf).withColumn("arrival", F.lit(0))
    rows = captured_table(records, request_config(), sample=None)
    return captured_table(records, request_config(), sample=rows.count() // 2)


STREAMED = """answers as (select id, cast(0 as integer) as drift, list(0.0::double order by row_pos) as predictions, cast(0 as bigint) as errors from placed group by id)"""


@query("stream_capture", sql(REQUEST_ROWS, PLACED, STREAMED, final="select id, predictions, errors from answers"))
def stream_capture(spark, sf):
    """Requests streamed from files and answered by the rule that scores every row 0."""
    folder, out = captured_folder(spark, sf), scratch_path(spark, "answers")
    rows = request_rows(spark, sf)
    cfg = request_config()
    fitted = Fitted(encode.fit_category_index(rows, cfg.categorical), fitted_stats.fit_robust(rows, cfg.features[:2]))
    score_stream(spark, folder, out, scratch_path(spark, "offsets"), cfg, fitted).awaitTermination()
    return spark.read.parquet(f"{out}/responses").select("id", "predictions", "errors")


JS = """ref as (select feature3, count(*) / (select count(*) from request_rows) as p from request_rows group by 1),
cur as (select id, feature3, count(*) / sum(count(*)) over (partition by id) as q from request_rows group by 1, 2),
cross_ as (select i.id, r.feature3, r.p, coalesce(c.q, 0) as q from (select distinct id from request_rows) i cross join ref r
  left join cur c on c.id = i.id and c.feature3 = r.feature3),
js as (select id, sqrt(sum(case when p > 0 then p * ln(p / ((p + q) / 2)) else 0 end + case when q > 0 then q * ln(q / ((p + q) / 2)) else 0 end) / 2) as score
  from cross_ group by id)"""


@query(
    "stream_drift",
    sql(REQUEST_ROWS, JS, final="select id, cast(score > 0.1::double as integer) as drift from js"),
)
def stream_drift(spark, sf):
    """Drift flags attached to streamed answers."""
    folder, out = captured_folder(spark, sf), scratch_path(spark, "answers")
    rows = request_rows(spark, sf)
    cfg = request_config()
    fitted = Fitted(encode.fit_category_index(rows, cfg.categorical))
    reference = drift.fit_distribution(rows, ["feature3"])
    score_stream(spark, folder, out, scratch_path(spark, "offsets"), cfg, fitted, reference=reference).awaitTermination()
    return spark.read.parquet(f"{out}/responses").select("id", "drift")
