"""Training sets of every phase and problem, up to the model."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tabloop.catalog import query
from tabloop.catalog import steps as s
from tabloop.catalog.fixtures import (
    COMPLETE,
    FEATURES,
    captured,
    captured_sql,
    config,
    earlier,
    earlier_sql,
    h,
    labelled,
    rounded,
    sql,
)
from tabloop.operators.columns import append
from tabloop.operators.stats import apply_robust, fit_robust
from tabloop.plans.prepare import process_raw
from tabloop.plans.recipes import CAPTURED_ROWS, RecipeInputs, captured_left_out, recipe
from tabloop.storage import small_table

SCORED_CUT, EXTREMES = 1000, 400  # below the rows of the given tables, so that the cuts cut
KEEP = "row_id, feature1, feature2, label"
OUT = f"part, source, row_id, copy, is_synthetic, label, {s.rounded_columns(FEATURES)}"
COLUMNS = f"row_id, {', '.join(FEATURES)}, label, copy, is_synthetic"
PLAIN = f"row_id, {', '.join(f'cast({c} as double) as {c}' for c in FEATURES)}, label, 0 as copy, false as is_synthetic"


def prepared(multi: bool) -> list[str]:
    """Coded train and test rows."""
    label = "label_multi" if multi else "label"
    return [
        COMPLETE,
        f"raw as (select min(row_id) as row_id, {', '.join(FEATURES)}, {label} as label from complete group by all)",
        s.index_sql("idx", "raw"),
        s.coded_sql("coded", "raw", "idx", KEEP),
        s.split_sql("parts", "coded"),
        "train0 as (select * exclude (split) from parts where split = 'train')",
        "test0 as (select * exclude (split) from parts where split = 'test')",
    ]


def classes(name: str, source: str) -> str:
    """Class names to codes of the sorted training classes."""
    return f"""{name} as (select * replace ((select cast(c as integer) from (select label as l, row_number() over (order by label) - 1 as c
  from (select distinct label from train0)) where l = label) as label) from {source})"""


def assembled(train: dict[str, str], test: dict[str, str]) -> str:
    parts = [
        f"select '{part}' as part, '{source}' as source, {COLUMNS} from {name}"
        for part, members in (("train", train), ("test", test))
        for source, name in members.items()
    ]
    return f"select {OUT} from ({' union all '.join(parts)})"


def result(pair):
    train, test = pair
    out = append(train, test.withColumn("part", F.lit("test"))).withColumn("part", F.coalesce("part", F.lit("train")))
    return rounded(out.select("part", "source", "row_id", "copy", "is_synthetic", "label", *FEATURES), FEATURES)


def inputs(spark, sf, phase: str, problem: str, multi: bool = False, **more) -> RecipeInputs:
    cfg = config(phase, problem)
    rows = labelled(spark, sf, gaps=False)
    label = "label_multi" if multi else "label"
    raw = rows.select("row_id", *FEATURES, F.col(label).alias("label"))
    parts, index = process_raw(raw, cfg)
    return RecipeInputs(
        cfg=cfg,
        index=index,
        train=parts.where("split = 'train'").drop("split"),
        test=parts.where("split = 'test'").drop("split"),
        captured=captured(spark, sf, multi),
        **more,
    )


SCALE = s.robust_sql("st", "train0", FEATURES)


def scaled(name: str, source: str) -> str:
    return s.scaled_sql(name, source, "st", "row_id, label")


@query(
    "recipe_1_1",
    sql(
        *prepared(False),
        SCALE,
        scaled("train1", "train0"),
        scaled("test1", "test0"),
        *s.smote_sql("train2", "train1", "label", FEATURES),
        captured_sql(),
        s.coded_sql("cap0", "(select *, label_model as label from captured)", "idx", KEEP),
        scaled("cap1", "cap0"),
        *s.smote_sql("cap2", "cap1", "label", FEATURES, strategy="minority"),
        f"test2 as (select {PLAIN} from test1)",
        final=assembled({"train": "train2", "captured": "cap2"}, {"test": "test2"}),
    ),
)
def recipe_1_1(spark, sf):
    return result(recipe("phase-1", "prob-1", inputs(spark, sf, "phase-1", "prob-1")))


CENTRES = (
    "centres as (select feature4 as c, "
    + ", ".join(f"round(avg({c}), 6) as {c}" for c in FEATURES)
    + " from train1 group by feature4),\n"
    "numbered as (select cast(row_number() over (order by c) - 1 as integer) as cluster, * exclude (c) from centres)"
)


@query(
    "recipe_1_2",
    sql(
        *prepared(False),
        SCALE,
        scaled("train1", "train0"),
        scaled("test1", "test0"),
        *s.smote_sql("train2", "train1", "label", FEATURES),
        captured_sql(),
        s.coded_sql("cap0", "(select *, label_model as label from captured)", "idx", KEEP),
        scaled("cap1", "cap0"),
        CENTRES,
        f"near as (select a.row_id, min({{'d': {s.distance(FEATURES)}, 'c': b.cluster}}).c as cluster from cap1 a, numbered b group by 1)",
        "assigned as (select cap1.*, cluster from cap1 join near using (row_id))",
        "stats as (select cluster as c, count(*) as n, count(*) filter (where label = 1) as m, "
        + " + ".join(f"coalesce(var_samp({c}) filter (where label = 1), 0)" for c in FEATURES)
        + " as v from assigned group by 1)",
        "rich as (select *, sqrt(2 * v) ** ((ln(m) / ln(1.6::double)) ** 1.8::double * 0.16::double) / m as w from stats where m / n >= 0.2::double and m > 5)",
        "missing as (select count(*) filter (where label = 0) - count(*) filter (where label = 1) as x from assigned)",
        "want as (select c as g, m as n, cast(ceil(round((select x from missing) * (w / (select sum(w) from rich)), 9)) as bigint) as w from rich)",
        "minority as (select * from assigned where label = 1)",
        *s.synthesise_sql("made", "minority", "label", FEATURES, "cluster", "want", 5, 1242),
        f"cap2 as (select {PLAIN} from cap1 union all select * from made where is_synthetic)",
        f"test2 as (select {PLAIN} from test1)",
        final=assembled({"train": "train2", "captured": "cap2"}, {"test": "test2"}),
    ),
)
def recipe_1_2(spark, sf):
    """Captured rows are raised inside given clusters: the mean rows per segment."""
    given = inputs(spark, sf, "phase-1", "prob-2", balance_threshold=0.2)
    train = apply_robust(given.train, fit_robust(given.train, FEATURES))
    means = train.groupBy(F.col("feature4").alias("c")).agg(*[F.round(F.avg(c), 6).alias(c) for c in FEATURES]).collect()
    centres = [(i, *[r[c] for c in FEATURES]) for i, r in enumerate(sorted(means, key=lambda r: r.c))]
    kinds = ", ".join(["cluster int", *[f"{c} double" for c in FEATURES]])
    fixed = replace(given, centroids=small_table(spark, centres, kinds))
    return result(recipe("phase-1", "prob-2", fixed))


SCORED_KEY = h("row_id||':scored'")


@query(
    "recipe_2_1",
    sql(
        *prepared(False),
        f"scored as (select *, ({SCORED_KEY} % 5000 + 5000) / 10000 as prob from coded)",
        f"placed as (select {PLAIN}, row_number() over (order by prob desc, row_id) as p from scored)",
        f"train1 as (select {COLUMNS} from placed where p <= {SCORED_CUT})",
        f"test1 as (select {COLUMNS} from placed where p > {SCORED_CUT})",
        captured_sql(),
        f"""more as (select * replace (row_id * 3 as row_id) from captured
  union all (select * replace (row_id * 3 + 1 as row_id) from captured order by prob desc, captured.row_id limit {EXTREMES})
  union all (select * replace (row_id * 3 + 2 as row_id) from captured order by prob, captured.row_id limit {EXTREMES}))""",
        f"n as (select count(*) as n, {h("'cut:1242'")} as k from more)",
        "cut as (select n // 2 + (k::hugeint * (n - n // 2)) // 4294967296 as c from n)",
        "kept as (select *, label_model as label from more qualify row_number() over (order by prob, row_id) <= (select c from cut))",
        s.coded_sql("cap0", "kept", "idx", KEEP),
        *s.smote_sql("cap1", "cap0", "label", FEATURES, k=10),
        final=assembled({"captured": "cap1"}, {"test": "test1", "train": "train1"}),
    ),
)
def recipe_2_1(spark, sf):
    given = inputs(spark, sf, "phase-2", "prob-1")
    raw = labelled(spark, sf, gaps=False).select("row_id", *FEATURES, "label")
    key = F.conv(F.substring(F.md5(F.concat(F.col("row_id").cast("string"), F.lit(":scored"))), 1, 8), 16, 10).cast("bigint")
    scored = raw.withColumn("prob", (key % 5000 + 5000) / 10000)
    given = replace(given, scored=scored, scored_train_rows=SCORED_CUT, extreme_rows=EXTREMES)
    return result(recipe("phase-2", "prob-1", given))


@query(
    "recipe_2_2",
    sql(
        *prepared(True),
        SCALE,
        classes("train_c", "train0"),
        classes("test_c", "test0"),
        scaled("train1", "train_c"),
        scaled("test1", "test_c"),
        *s.smote_sql("train2", "train1", "label", FEATURES),
        captured_sql(multi=True),
        f"""taken as (select *, label_model as label from captured
  qualify row_number() over (order by {h("row_id||':1242'")}, row_id) <= {CAPTURED_ROWS})""",
        s.coded_sql("cap0", "taken", "idx", KEEP),
        classes("cap_c", "cap0"),
        scaled("cap1", "cap_c"),
        *s.smote_sql("cap2", "cap1", "label", FEATURES, strategy="minority"),
        f"test2 as (select {PLAIN} from test1)",
        final=assembled({"train": "train2", "captured": "cap2"}, {"test": "test2"}),
    ),
)
def recipe_2_2(spark, sf):
    return result(recipe("phase-2", "prob-2", inputs(spark, sf, "phase-2", "prob-2", multi=True)))


@query(
    "recipe_3_1",
    sql(
        *prepared(False),
        SCALE,
        earlier_sql(),
        "earlier_d as (select min(row_id) as row_id, * exclude (row_id) from earlier group by all)",
        s.coded_sql("earlier0", "earlier_d", "idx", KEEP),
        f"both0 as (select {KEEP}, feature3, feature4 from train0 union all select {KEEP}, feature3, feature4 from earlier0)",
        scaled("both1", "both0"),
        scaled("test1", "test0"),
        *s.smote_sql("raised", "both1", "label", FEATURES),
        f"""train2 as (select * from raised
  qualify row_number() over (partition by label order by {h("row_id||':'||copy||':'||':1242'")}, row_id, copy)
    <= (select min(n) from (select count(*) as n from raised group by label)))""",
        captured_sql(),
        f"""taken as (select *, label_model as label from captured
  qualify row_number() over (order by {h("row_id||':1242'")}, row_id) <= trunc((select count(*) from captured) * 0.7::double))""",
        s.coded_sql("cap0", "taken", "idx", KEEP),
        scaled("cap1", "cap0"),
        *s.smote_sql("cap2", "cap1", "label", FEATURES, strategy="minority"),
        f"test2 as (select {PLAIN} from test1)",
        final=assembled({"train": "train2", "captured": "cap2"}, {"test": "test2"}),
    ),
)
def recipe_3_1(spark, sf):
    given = inputs(spark, sf, "phase-3", "prob-1", earlier=earlier(spark, sf))
    return result(recipe("phase-3", "prob-1", given))


@query(
    "recipe_3_2",
    sql(
        *prepared(True),
        SCALE,
        classes("train_c", "train0"),
        classes("test_c", "test0"),
        scaled("train1", "train_c"),
        scaled("test1", "test_c"),
        *s.smote_sql("train2", "train1", "label", FEATURES),
        captured_sql(multi=True),
        """taken as (select *, label_model as label from captured
  qualify row_number() over (order by prob desc, row_id) <= trunc((select count(*) from captured) * 0.95::double))""",
        s.coded_sql("cap0", "taken", "idx", KEEP),
        classes("cap_c", "cap0"),
        scaled("cap1", "cap_c"),
        *s.smote_sql("cap2", "cap1", "label", FEATURES, strategy="minority"),
        earlier_sql(multi=True),
        "earlier_d as (select min(row_id) as row_id, * exclude (row_id) from earlier group by all)",
        s.split_sql("earlier_p", "earlier_d", 0.3, 42),
        s.coded_sql("earlier0", "earlier_p", "idx", f"{KEEP}, split"),
        classes("earlier_c", "earlier0"),
        s.scaled_sql("earlier1", "earlier_c", "st", "row_id, label, split"),
        f"earlier_train as (select {PLAIN} from earlier1 where split = 'train')",
        f"earlier_test as (select {PLAIN} from earlier1 where split = 'test')",
        f"test2 as (select {PLAIN} from test1)",
        final=assembled(
            {"train": "train2", "captured": "cap2", "earlier": "earlier_train"}, {"test": "test2", "earlier": "earlier_test"}
        ),
    ),
)
def recipe_3_2(spark, sf):
    given = inputs(spark, sf, "phase-3", "prob-2", multi=True, earlier=earlier(spark, sf, multi=True))
    return result(recipe("phase-3", "prob-2", given))


@query(
    "captured_left_out",
    sql(
        COMPLETE,
        captured_sql(),
        final="""select 'share' as cut, row_id from captured
  qualify row_number() over (order by prob desc, row_id) > trunc((select count(*) from captured) * 0.95::double)
union all select 'number', row_id from captured qualify row_number() over (order by """
        + h("row_id||':1242'")
        + ", row_id) > 700",
    ),
)
def left_out(spark, sf):
    """Captured rows that the cuts of two recipes do not take."""
    given = replace(inputs(spark, sf, "phase-3", "prob-2"), captured_rows=700)
    by_share = captured_left_out("phase-3", "prob-2", given).select(F.lit("share").alias("cut"), "row_id")
    by_number = captured_left_out("phase-2", "prob-2", given).select(F.lit("number").alias("cut"), "row_id")
    return by_share.unionByName(by_number)
