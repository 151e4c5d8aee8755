"""Projections, encoders, fills, scales, splits and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloop.catalog import query
from tabloop.catalog import steps as s
from tabloop.catalog.fixtures import (
    CATEGORICAL,
    COMPLETE,
    DOCUMENTS,
    FEATURES,
    LABELLED,
    NUMERICAL,
    config,
    documents,
    earlier,
    earlier_sql,
    h,
    labelled,
    rounded,
    scored,
    scored_sql,
    sql,
    table,
)
from tabloop.functions.keys import order_key
from tabloop.operators import columns as C
from tabloop.operators import binning, encode, ordering, stats, woe
from tabloop.operators.evaluate import class_counts
from tabloop.plans.prepare import process_raw
from tabloop.sources import tables
from tabloop.storage import scratch_path

KEY = h("row_id||':1242'")
CLEAN = f"clean as (select min(row_id) as row_id, {', '.join(FEATURES)}, label from labelled group by {', '.join(FEATURES)}, label)"
PREPARED = [
    LABELLED,
    CLEAN,
    s.index_sql("idx", "clean"),
    s.coded_sql("coded", "clean", "idx", "row_id, feature1, feature2, label"),
    s.split_sql("parts", "coded"),
]


def features(spark: SparkSession, sf: str) -> DataFrame:
    return labelled(spark, sf).select("row_id", *FEATURES, "label")


# whole preparation: distinct rows, index, codes, split, scale


@query("dedup_encode_split", sql(*PREPARED, final="select * from parts"))
def dedup_encode_split(spark, sf):
    return process_raw(features(spark, sf), config())[0]


@query(
    "prepared_training_table",
    sql(
        *PREPARED,
        s.robust_sql("st", "(select * from parts where split = 'train')", FEATURES),
        s.scaled_sql("ready", "parts", "st", "split, label"),
        final=f"""select split, label, count(*) as n, {', '.join(f'round(avg({c}), 6) as mean_{c}' for c in FEATURES)}
from ready group by split, label""",
    ),
)
def prepared_training_table(spark, sf):
    """Coded, scaled, split training table, summed up per part and class."""
    parts, _ = process_raw(features(spark, sf), config())
    scale = stats.fit_robust(parts.where("split = 'train'"), FEATURES)
    ready = stats.apply_robust(parts, scale)
    return ready.groupBy("split", "label").agg(
        F.count(F.lit(1)).alias("n"), *[F.round(F.avg(c), 6).alias(f"mean_{c}") for c in FEATURES]
    )


@query("distinct_rows", "select distinct l_returnflag, l_linestatus, l_linenumber, l_quantity, l_discount, l_tax from lineitem")
def distinct_rows(spark, sf):
    cols = ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_discount", "l_tax"]
    return C.distinct_rows(table(spark, sf, "lineitem").select(*cols))


@query(
    "distinct_features",
    """select min(l_orderkey * 8 + l_linenumber) as row_id, l_returnflag, l_linestatus, l_discount, l_tax from lineitem
group by l_returnflag, l_linestatus, l_discount, l_tax""",
)
def distinct_features(spark, sf):
    """Rows alike in all but their id are one; here few remain of the whole table."""
    row_id = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id")
    rows = table(spark, sf, "lineitem").select(row_id, "l_returnflag", "l_linestatus", "l_discount", "l_tax")
    return C.distinct_rows(rows, "row_id")


@query("class_counts", "select l_returnflag, count(*) as n from lineitem group by l_returnflag")
def counts(spark, sf):
    return class_counts(table(spark, sf, "lineitem"), "l_returnflag")


# encoders


@query("category_index", sql(LABELLED, s.index_sql("idx", "labelled"), final="select * from idx"))
def category_index(spark, sf):
    return encode.fit_category_index(labelled(spark, sf), CATEGORICAL)


WIDE = ["p_name", "p_size", "p_type"]


@query("category_index_wide", sql(s.index_sql("idx", "part", WIDE), final="select * from idx"))
def category_index_wide(spark, sf):
    """Columns with many categories, one of them of numbers, numbered over range partitions."""
    return encode.fit_category_index(table(spark, sf, "part"), WIDE, sorted_limit=10)


@query(
    "apply_codes",
    sql(
        LABELLED,
        s.index_sql("idx", "labelled"),
        "masked as (select * replace (case when feature3 = '1-URGENT' then 'NEW' else feature3 end as feature3) from labelled)",
        s.coded_sql("coded", "masked", "idx", "row_id"),
        final="select * from coded",
    ),
)
def apply_codes(spark, sf):
    rows = labelled(spark, sf)
    index = encode.fit_category_index(rows, CATEGORICAL)
    masked = C.mask_value(rows, "feature3", "1-URGENT", "NEW").select("row_id", *CATEGORICAL)
    return encode.apply_codes(masked, index, CATEGORICAL)


@query(
    "apply_codes_joined",
    sql(
        s.index_sql("idx", "part", ["p_name"]),
        "named as (select l_orderkey, l_linenumber, l_partkey, l_quantity, p_name from lineitem join part on l_partkey = p_partkey)",
        final="""select l_orderkey, l_linenumber, l_partkey, l_quantity, coalesce(code, -1) as p_name
from named left join idx on named.p_name = idx.category""",
    ),
)
def apply_codes_joined(spark, sf):
    """A column with too many categories for an expression: codes come from a join."""
    part, lineitem = table(spark, sf, "part"), table(spark, sf, "lineitem")
    index = encode.fit_category_index(part, ["p_name"])
    named = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
    named = named.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "p_name")
    return encode.apply_codes(named, index, ["p_name"], literal_limit=1)


@query(
    "label_encode",
    sql(
        LABELLED,
        s.index_sql("idx", "labelled", ["label_multi"]),
        final="select row_id, code as label_multi from labelled join idx on label_multi = category",
    ),
)
def label_encode(spark, sf):
    rows = labelled(spark, sf).select("row_id", "label_multi")
    return encode.encode_labels(rows, encode.fit_labels(rows, "label_multi"), "label_multi")


@query("label_decode", sql(LABELLED, final="select row_id, label_multi from labelled"))
def label_decode(spark, sf):
    rows = labelled(spark, sf).select("row_id", "label_multi")
    labels = encode.fit_labels(rows, "label_multi")
    return encode.decode_labels(encode.encode_labels(rows, labels, "label_multi"), labels, "label_multi")


# fixed values: order priorities and market segments of the given tables, in order
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _dummies() -> list[tuple[str, str, str]]:
    pairs = [("feature3", v) for v in PRIORITIES[1:]] + [("feature4", v) for v in SEGMENTS[1:]]
    return [(c, v, f"{c}_{v}".replace(" ", "_").lower()) for c, v in pairs]


@query(
    "one_hot",
    sql(
        LABELLED,
        final="select row_id, "
        + ", ".join(f"cast(coalesce({c} = '{v}', false) as integer) as \"{name}\"" for c, v, name in _dummies())
        + " from labelled",
    ),
)
def one_hot(spark, sf):
    rows = labelled(spark, sf).select("row_id", *CATEGORICAL)
    return C.standardize_names(encode.apply_one_hot(rows, encode.fit_one_hot(rows, CATEGORICAL), CATEGORICAL))


@query(
    "one_hot_align",
    sql(
        LABELLED,
        final="""select row_id, cast(coalesce(feature4 = 'BUILDING', false) as integer) as feature4_building,
  cast(coalesce(feature4 = 'MACHINERY', false) as integer) as feature4_machinery from labelled""",
    ),
)
def one_hot_align(spark, sf):
    """Dummies that training did not know go, absent ones are not added."""
    rows = labelled(spark, sf).select("row_id", "feature4")
    wide = C.standardize_names(encode.apply_one_hot(rows, encode.fit_one_hot(rows, ["feature4"]), ["feature4"]))
    return encode.align_columns(wide, ["row_id", "feature4_building", "feature4_machinery", "feature4_shipping"])


@query(
    "category_counts",
    sql(
        LABELLED,
        final="""select 'feature3' as col, feature3 as category, count(*) as n from labelled where feature3 is not null group by feature3
union all select 'feature4', feature4, count(*) from labelled group by feature4""",
    ),
)
def category_counts(spark, sf):
    return encode.category_count(labelled(spark, sf), CATEGORICAL)


# fills


@query(
    "mask_fill_unknown",
    sql(
        LABELLED,
        final="""select row_id, coalesce(case when feature3 = '5-LOW' then 'LOWEST' else feature3 end, 'Unknown') as feature3,
  coalesce(feature4, 'Unknown') as feature4 from labelled""",
    ),
)
def mask_fill_unknown(spark, sf):
    rows = labelled(spark, sf).select("row_id", *CATEGORICAL)
    return C.fill_unknown(C.mask_value(rows, "feature3", "5-LOW", "LOWEST"))


@query(
    "impute_mode_mean",
    sql(
        LABELLED,
        "top as (select feature3 as v from labelled where feature3 is not null group by feature3 order by count(*) desc, feature3 limit 1)",
        final="""select row_id, round(coalesce(feature1, (select avg(feature1) from labelled)), 6) as feature1,
  coalesce(feature3, (select v from top)) as feature3 from labelled""",
    ),
)
def impute_mode_mean(spark, sf):
    rows = labelled(spark, sf).select("row_id", "feature1", "feature3")
    return rounded(stats.apply_imputer(rows, stats.fit_imputer(rows, ["feature3"], ["feature1"])), ["feature1"])


@query(
    "impute_fitted_elsewhere",
    sql(
        LABELLED,
        earlier_sql(),
        "top as (select feature3 as v from earlier group by feature3 order by count(*) desc, feature3 limit 1)",
        final="""select row_id, round(coalesce(feature1, (select avg(feature1) from earlier)), 6) as feature1,
  coalesce(feature3, (select v from top)) as feature3 from labelled""",
    ),
)
def impute_fitted_elsewhere(spark, sf):
    """Fills fitted on one table, applied to another."""
    fills = stats.fit_imputer(earlier(spark, sf), ["feature3"], ["feature1"])
    return rounded(stats.apply_imputer(labelled(spark, sf).select("row_id", "feature1", "feature3"), fills), ["feature1"])


@query(
    "fitted_statistics",
    sql(
        LABELLED,
        final="""select 'feature1' as col, 'mean' as stat, round(avg(feature1), 6) as number, null as category from labelled
union all select 'feature2', 'mean', round(avg(feature2), 6), null from labelled
union all (select 'feature3', 'mode', null, feature3 from labelled where feature3 is not null group by feature3 order by count(*) desc, feature3 limit 1)
union all (select 'feature4', 'mode', null, feature4 from labelled group by feature4 order by count(*) desc, feature4 limit 1)""",
    ),
)
def fitted_statistics(spark, sf):
    fills = stats.fit_imputer(labelled(spark, sf), CATEGORICAL, NUMERICAL)
    number = F.when(F.col("stat") == "mean", F.round(F.col("value").try_cast("double"), 6))
    return fills.select("col", "stat", number.alias("number"), F.when(F.col("stat") == "mode", F.col("value")).alias("category"))


# scales

LINE_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "quartiles",
    sql(
        final=" union all ".join(
            f"select '{c}' as col, round(quantile_cont({c}, 0.25), 6) as q25, round(quantile_cont({c}, 0.5), 6) as q50, "
            f"round(quantile_cont({c}, 0.75), 6) as q75 from lineitem"
            for c in LINE_NUMBERS
        )
    ),
)
def quartiles(spark, sf):
    fitted = stats.fit_robust(table(spark, sf, "lineitem"), LINE_NUMBERS)
    named = [F.round(F.max(F.when(F.col("stat") == q, F.col("value").cast("double"))), 6).alias(q) for q in ("q25", "q50", "q75")]
    return fitted.groupBy("col").agg(*named)


def _scale_sql(centering: bool) -> str:
    body = ", ".join(f"round({s.scaled(c, 'st', centering)}, 6) as {c}" for c in NUMERICAL)
    return sql(LABELLED, s.robust_sql("st", "labelled", NUMERICAL), final=f"select row_id, {body} from labelled, st")


@query("robust_scale", _scale_sql(False))
def robust_scale(spark, sf):
    rows = labelled(spark, sf).select("row_id", *NUMERICAL)
    return rounded(stats.apply_robust(rows, stats.fit_robust(rows, NUMERICAL)), NUMERICAL)


@query("robust_scale_centered", _scale_sql(True))
def robust_scale_centered(spark, sf):
    rows = labelled(spark, sf).select("row_id", *NUMERICAL)
    return rounded(stats.apply_robust(rows, stats.fit_robust(rows, NUMERICAL), centering=True), NUMERICAL)


# weight of evidence


def _woe_cells(col: str, expression: str, source: str) -> str:
    return f"select '{col}' as col, cast({expression} as varchar) as bin, label from {source} where {expression} is not null"


WOE = """tot as (select col, sum(label) as e, sum(1 - label) as n from cells group by col),
bins as (select col, bin, cast(sum(label) as bigint) as events, cast(sum(1 - label) as bigint) as nonevents from cells group by col, bin),
adj as (select bins.*, e, n, case when events = 0 or nonevents = 0 then 0.5::double else 0 end as a from bins join tot using (col)),
woe as (select col, bin, events, nonevents, (events + a) / (e + a) as es, (nonevents + a) / (n + a) as ns, ln(ns / es) as woe from adj)"""


@query(
    "woe_categorical",
    sql(
        DOCUMENTS,
        f"cells as ({_woe_cells('feature3', 'feature3', 'docs')} union all {_woe_cells('feature4', 'feature4', 'docs')})",
        WOE,
        final="select col, bin, events, nonevents, round(woe, 6) as woe, round((ns - es) * woe, 6) as iv from woe",
    ),
)
def woe_categorical(spark, sf):
    fitted = woe.fit_woe(documents(spark, sf), ["feature3", "feature4"])
    return rounded(fitted.drop("upper"), ["woe", "iv"])


BINNED = """cuts as (select list_sort(list_distinct(quantile_cont(feature1, [0.2, 0.4, 0.6, 0.8]))) as c from labelled),
numbered as (select row_id, label, feature3,
  case when feature1 is not null then len(list_filter(c, lambda x: feature1 > x)) end as b from labelled, cuts)"""

@query(
    "woe_numeric",
    sql(
        LABELLED,
        BINNED,
        f"cells as ({_woe_cells('feature1', 'b', 'numbered')})",
        WOE,
        final="select col, bin, events, nonevents, round(woe, 6) as woe, round((ns - es) * woe, 6) as iv from woe",
    ),
)
def woe_numeric(spark, sf):
    return rounded(woe.fit_woe(labelled(spark, sf), [], ["feature1"]).drop("upper"), ["woe", "iv"])


@query(
    "woe_pipeline",
    sql(
        LABELLED,
        BINNED,
        f"cells as ({_woe_cells('feature1', 'b', 'numbered')} union all {_woe_cells('feature3', 'feature3', 'labelled')})",
        WOE,
        final="""select row_id,
  round(coalesce((select woe from woe w where w.col = 'feature1' and w.bin = cast(b as varchar)), 0), 5) as feature1,
  round(coalesce((select woe from woe w where w.col = 'feature3' and w.bin = feature3), 0), 5) as feature3
from numbered""",
    ),
)
def woe_pipeline(spark, sf):
    rows = labelled(spark, sf)
    transform, _ = woe.woe_pipeline(rows, ["feature1", "feature3"], ["feature1"])
    return rounded(transform(rows).select("row_id", "feature1", "feature3"), ["feature1", "feature3"], 5)


# every subset of the inner cuts between the values of a column, as the bits of a number; at most 8 bins of 5 % each
BEST_BINS = """
rows_ as (select case when l_tax = 0.08 then null else l_discount end as x,
    cast(l_quantity + 200 * l_discount > 35 as bigint) as y from lineitem),
fine as (select x, row_number() over (order by x) - 1 as i, sum(y) as e, sum(1 - y) as n
  from rows_ where x is not null group by x),
size as (select count(*) as k, (select sum(y) from rows_) as es, (select sum(1 - y) from rows_) as ns from fine),
cells as (
  select m, fine.*, bit_count(cast(m & ((1 << cast(i as integer)) - 1) as bigint)) as bin
  from fine, size, (select unnest(range(0, 1 << cast((select k from size) - 1 as integer))) as m)),
parts as (
  select m, cast(bin as integer) as bin, max(x) as top, cast(sum(e) as bigint) as e, cast(sum(n) as bigint) as n, max(i) as last
  from cells group by m, bin),
valued as (
  select parts.*, es, ns, e / (e + n) as rate, (n / ns - e / es) * ln((n / ns) / (e / es)) as iv,
    lag(e / (e + n)) over (partition by m order by bin) as before
  from parts, size),
best as (
  select m, round(sum(iv), 12) as total, count(*) as bins, list(last order by bin) as ends from valued group by m
  having bool_and(e > 0 and n > 0 and e + n >= 0.05 * (es + ns)) and count(*) <= 8
    and (bool_and(before is null or rate >= before) or bool_and(before is null or rate <= before))
  order by total desc, bins, ends limit 1),
chosen as (select valued.*, lag(top) over (order by bin) as lower, max(bin) over () as most from valued join best using (m))"""


@query(
    "optimal_bins",
    "with " + BEST_BINS + """
select 'x' as col, bin, lower, case when bin < most then top end as upper, e as events, n as nonevents,
  round(ln((n / ns) / (e / es)), 9) as woe, round(iv, 9) as iv from chosen
union all
select 'x', -1, null, null, cast(sum(y) as bigint), cast(sum(1 - y) as bigint), round(ln((sum(1 - y) / ns) / (sum(y) / es)), 9),
  round((sum(1 - y) / ns - sum(y) / es) * ln((sum(1 - y) / ns) / (sum(y) / es)), 9)
from rows_, size where x is null group by ns, es""",
)
def optimal_bins(spark, sf):
    """The cuts of a discount that tell most about a label; the SQL tries all subsets of cuts."""
    rows = table(spark, sf, "lineitem").select(
        F.when(F.col("l_tax") != 0.08, F.col("l_discount")).alias("x"),
        (F.col("l_quantity") + 200 * F.col("l_discount") > 35).cast("int").alias("label"),
    )
    return rounded(binning.fit(rows, [], ["x"]).drop("categories", "rest"), ["woe", "iv"], 9)


# positions, samples, splits


@query("split_exact", sql(LABELLED, s.split_sql("parts", "labelled"), final="select row_id, split from parts"))
def split_exact(spark, sf):
    return ordering.split(labelled(spark, sf)).select("row_id", "split")


@query(
    "split_hashed",
    sql(LABELLED, final=f"select row_id, case when {KEY} % 1000 < 100 then 'test' else 'train' end as split from labelled"),
)
def split_hashed(spark, sf):
    return ordering.split(labelled(spark, sf), exact=False).select("row_id", "split")


@query(
    "contiguous_folds",
    sql(
        LABELLED,
        "n as (select count(*) as n from labelled)",
        "placed as (select row_id, row_number() over (order by row_id) as p from labelled)",
        final="""select row_id, cast(case when p <= trunc(n * 0.2::double) then 0 when p <= trunc(n * 0.4::double) then 1
  when p <= trunc(n * 0.6::double) then 2 when p <= trunc(n * 0.8::double) then 3 else 4 end as integer) as fold from placed, n""",
    ),
)
def contiguous_folds(spark, sf):
    return ordering.assign_folds(labelled(spark, sf)).select("row_id", "fold")


@query(
    "fold_split",
    sql(
        LABELLED,
        "n as (select count(*) as n from labelled)",
        "placed as (select row_id, row_number() over (order by row_id) as p from labelled)",
        final="""select row_id, case when p > trunc(n * 0.2::double) and p <= trunc(n * 0.4::double) then 'test' else 'train' end as part
from placed, n""",
    ),
)
def fold_split(spark, sf):
    train, test = ordering.fold_split(ordering.assign_folds(labelled(spark, sf)), 1)
    parts = [d.select("row_id", F.lit(n).alias("part")) for n, d in (("train", train), ("test", test))]
    return C.append(*parts)


@query(
    "sample_exact",
    sql(
        LABELLED,
        final=f"""select row_id, feature2 from labelled
qualify row_number() over (order by {h("row_id||':1'")}, row_id) <= (select count(*) // 2 from labelled)""",
    ),
)
def sample_exact(spark, sf):
    rows = labelled(spark, sf).select("row_id", "feature2")
    return ordering.sample_exact(rows, rows.count() // 2, seed=1)


@query("shuffle_keys", sql(LABELLED, final=f"select row_id, {KEY} as key from labelled"))
def shuffle_keys(spark, sf):
    return labelled(spark, sf).select("row_id", order_key("row_id", 1242).alias("key"))


@query(
    "confident_share",
    sql(
        scored_sql("m"),
        final="""select row_id, prob from m
qualify row_number() over (order by prob desc, row_id) <= trunc((select count(*) from m) * 0.95::double)""",
    ),
)
def confident_share(spark, sf):
    """First 95 % by confidence; half of the confidences repeat."""
    return ordering.first_share(scored(spark, sf).select("row_id", "prob"), 0.95, ["-prob", "row_id"])


@query(
    "random_cut",
    sql(
        scored_sql("m"),
        f"n as (select count(*) as n, {h("'cut:1242'")} as k from m)",
        "cut as (select n // 2 + (k::hugeint * (n - n // 2)) // 4294967296 as c from n)",
        final="""select row_id, case when row_number() over (order by prob, row_id) <= (select c from cut) then 'head' else 'tail' end as part
from m""",
    ),
)
def random_cut(spark, sf):
    head, tail = ordering.random_cut(scored(spark, sf).select("row_id", "prob"), ["prob", "row_id"], 1242)
    return C.append(*[d.select("row_id", F.lit(n).alias("part")) for n, d in (("head", head), ("tail", tail))])


@query("row_numbers", sql(final="select p_partkey, p_name, row_number() over (order by p_name, p_partkey) - 1 as row_id from part"))
def row_numbers(spark, sf):
    """Rows numbered over range partitions in text order."""
    return ordering.number_rows(table(spark, sf, "part").select("p_partkey", "p_name"), ["p_name", "p_partkey"])


# projections


@query(
    "reindex_features",
    sql(LABELLED, final="select row_id, feature1, feature2, feature3, feature4, cast(null as double) as feature5 from labelled"),
)
def reindex_features(spark, sf):
    return C.select_features(labelled(spark, sf), [*FEATURES, "feature5"], "null", keep=("row_id",))


@query("strict_features", sql(LABELLED, final="select feature4, feature2 from labelled"))
def strict_features(spark, sf):
    return C.select_features(labelled(spark, sf), ["feature4", "feature2"])


@query("drop_bookkeeping", sql(scored_sql("m"), final="select row_id, feature2, feature3 from m"))
def drop_bookkeeping(spark, sf):
    return C.drop_columns(scored(spark, sf))


@query("drop_strict", sql(LABELLED, final="select * exclude (label, label_multi) from labelled"))
def drop_strict(spark, sf):
    return C.drop_columns(labelled(spark, sf), ["label", "label_multi"], strict=True)


@query("rename_scores", sql(scored_sql("m"), final="select row_id, feature2, feature3, label_model as label, prob from m"))
def rename_scores(spark, sf):
    raw = scored(spark, sf).withColumnsRenamed({"label_model": "prediction_label", "prob": "prediction_score"})
    return C.rename(raw, {"prediction_label": "label", "prediction_score": "prob"})


@query("drop_last_columns", sql(LABELLED, final="select row_id, feature1, feature2, feature3, feature4 from labelled"))
def drop_last_columns(spark, sf):
    return C.drop_last_columns(labelled(spark, sf), 2)


@query("columns_by_type", sql(LABELLED, final="select feature3, feature4, label_multi from labelled"))
def columns_by_type(spark, sf):
    rows = labelled(spark, sf)
    return rows.select(*C.columns_of_type(rows, T.StringType))


@query(
    "narrow_numbers",
    "select p_partkey, case when p_retailprice = trunc(p_retailprice) then cast(cast(p_retailprice as bigint) as varchar) "
    "else cast(p_retailprice as varchar) end as price, cast(p_size as varchar) as size from part",
)
def narrow_numbers(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.col("p_retailprice").alias("price"), F.col("p_size").alias("size"))
    return C.narrow_numbers(part, ["price", "size"])


@query("truncate_decimals", "select l_orderkey, l_linenumber, l_partkey, trunc(l_extendedprice / 7 * 100) / 100 as share from lineitem")
def truncate_decimals(spark, sf):
    rows = table(spark, sf, "lineitem")
    share = rows.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_extendedprice") / 7).alias("share"))
    return C.truncate_columns(share, ["share"], 2)


@query("predictions_to_int", sql(scored_sql("m"), final="select row_id, label_model as prediction from m"))
def predictions_to_int(spark, sf):
    rows = scored(spark, sf).select("row_id", F.col("label_model").cast("double").alias("prediction"))
    return C.predictions_to_int(rows)


@query("constant_confidence", sql(LABELLED, final="select row_id, 0.8::double as prob from labelled"))
def constant_confidence(spark, sf):
    return C.constant(labelled(spark, sf).select("row_id"), "prob", 0.8)


@query(
    "append_by_name",
    sql(
        LABELLED,
        earlier_sql(),
        final="""select row_id, feature1, feature2, feature3, feature4, label, label_multi, 'train' as source from labelled
union all select row_id, feature1, feature2, feature3, feature4, label, null, 'earlier' from earlier""",
    ),
)
def append_by_name(spark, sf):
    return C.append(labelled(spark, sf), earlier(spark, sf), source=["train", "earlier"])


@query("pair_features_target", sql(LABELLED, final="select row_id, feature1, feature2, feature3, feature4, label from labelled"))
def pair_features_target(spark, sf):
    x, y = tables.features_and_target(features(spark, sf), "label")
    return C.pair(x, y)


# written and read back


@query("split_round_trip", sql(*PREPARED, final="select * exclude (split) from parts where split = 'test'"))
def split_round_trip(spark, sf):
    path = scratch_path(spark, "split")
    tables.write_split(process_raw(features(spark, sf), config())[0], path)
    return tables.read_split(spark, path, "test")


@query("scored_round_trip", sql(scored_sql("m"), final="select * from m"))
def scored_round_trip(spark, sf):
    path, rows = scratch_path(spark, "scored"), scored(spark, sf)
    tables.write_scored(rows, path)
    return tables.read_scored(spark, path, rows.schema)


@query("fitted_round_trip", sql(LABELLED, s.index_sql("idx", "labelled"), final="select * from idx"))
def fitted_round_trip(spark, sf):
    path = scratch_path(spark, "index")
    tables.write_fitted(encode.fit_category_index(labelled(spark, sf), CATEGORICAL), path)
    return tables.read_fitted(spark, path)


@query(
    "folds_round_trip",
    sql(
        LABELLED,
        "n as (select count(*) as n from labelled)",
        "placed as (select row_id, row_number() over (order by row_id) as p from labelled)",
        final="""select cast(least(4, case when p <= trunc(n * 0.2::double) then 0 when p <= trunc(n * 0.4::double) then 1
  when p <= trunc(n * 0.6::double) then 2 when p <= trunc(n * 0.8::double) then 3 else 4 end) as integer) as fold,
  count(*) as n, min(row_id) as first_row, max(row_id) as last_row from placed, n group by 1""",
    ),
)
def folds_round_trip(spark, sf):
    path = scratch_path(spark, "folds")
    tables.write_folds(ordering.assign_folds(labelled(spark, sf)), path)
    return spark.read.parquet(path).groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.min("row_id").alias("first_row"), F.max("row_id").alias("last_row")
    )


@query(
    "read_labelled",
    sql(COMPLETE, final="select row_id, feature3, feature4, feature1, feature2, label from complete"),
)
def read_labelled(spark, sf):
    cfg = config()
    path = scratch_path(spark, "labelled")
    labelled(spark, sf, gaps=False).drop("label_multi").write.parquet(path)
    return tables.read_labelled(spark, path, cfg)
