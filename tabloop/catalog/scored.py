"""Relabelling, metrics and reports over scored rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloop.catalog import query
from tabloop.catalog import steps as s
from tabloop.catalog.fixtures import (
    COMPLETE,
    FEATURES,
    LABELLED,
    VECTOR_FEATURES,
    VECTORS,
    captured,
    captured_sql,
    config,
    earlier,
    earlier_sql,
    labelled,
    scored,
    scored_sql,
    sql,
    table,
    truth,
    vectors,
    wide_vectors,
)
from tabloop.operators import columns as C
from tabloop.operators import evaluate, neighbours, ordering, relabel, resample
from tabloop.sources.tables import read_captured, write_pseudo_labels
from tabloop.storage import scratch_path

MODELS = ("m1", "m2", "m3", "m4")
FOUR = [scored_sql(m, m) for m in MODELS]
LOW = {"base": 5000, "span": 5000}  # confidences from 0.5 to 1


def low(spark, sf, model="m1"):
    return scored(spark, sf, model, **LOW)


def low_sql(name="m", model="m1"):
    return scored_sql(name, model, **LOW)


# several models


@query(
    "consensus4",
    sql(
        *FOUR,
        "joined as (select a.row_id, a.feature2, a.feature3, a.label_model as l1, b.label_model as l2, c.label_model as l3, "
        "d.label_model as l4, a.prob as p1, b.prob as p2, c.prob as p3, d.prob as p4, (a.prob + b.prob + c.prob + d.prob) / 4 as mean "
        "from m1 a join m2 b using (row_id) join m3 c using (row_id) join m4 d using (row_id))",
        final="""select row_id, feature2, feature3, cast(case when l1 = l2 and l2 = l3 and l3 = l4 and abs(p1 - mean) < 0.05::double
  and least(p1, p2, p3, p4) >= 0.9::double then l1 when l1 = 1 then 0 else 1 end as integer) as label_model,
  round(mean, 6) as prob from joined""",
    ),
)
def consensus4(spark, sf):
    return relabel.consensus([scored(spark, sf, m) for m in MODELS]).withColumn("prob", F.round("prob", 6))


@query(
    "model_spread",
    sql(
        *FOUR,
        "u as (" + " union all ".join(f"select row_id, prob from {m}" for m in MODELS) + ")",
        final="select row_id, round(avg(prob), 6) as mean_prob, min(prob) as min_prob, max(prob) as max_prob from u group by row_id",
    ),
)
def model_spread(spark, sf):
    spread = relabel.model_spread([scored(spark, sf, m) for m in MODELS])
    return spread.withColumn("mean_prob", F.round("mean_prob", 6))


@query(
    "disagreement_rows",
    sql(
        *FOUR[:2],
        final="""select a.row_id, a.label_model as label_a, a.prob as prob_a, b.label_model as label_b, b.prob as prob_b
from m1 a join m2 b using (row_id) where a.label_model <> b.label_model""",
    ),
)
def disagreement_rows(spark, sf):
    return evaluate.disagreements(scored(spark, sf, "m1"), scored(spark, sf, "m2"))


@query(
    "disagreement_count",
    sql(*FOUR[:2], final="select count(*) as n from m1 a join m2 b using (row_id) where a.label_model <> b.label_model"),
)
def disagreement_count(spark, sf):
    return evaluate.disagreement_count(scored(spark, sf, "m1"), scored(spark, sf, "m2"))


# labels changed by confidence


@query(
    "flip_sequential",
    sql(low_sql(), final="select row_id, cast(case when prob < 0.9::double and label_model in (0, 1) then 1 else label_model end as integer) as label_model from m"),
)
def flip_sequential(spark, sf):
    return relabel.flip_low(low(spark, sf)).select("row_id", "label_model")


@query(
    "flip_swap",
    sql(low_sql(), final="select row_id, cast(case when prob < 0.9::double then 1 - label_model else label_model end as integer) as label_model from m"),
)
def flip_swap(spark, sf):
    return relabel.flip_low(low(spark, sf), mode="swap").select("row_id", "label_model")


@query(
    "gate_positive",
    sql(low_sql(), final="select row_id, cast(case when label_model = 1 and prob < 0.75::double then 0 else label_model end as integer) as label_model from m"),
)
def gate_positive(spark, sf):
    return relabel.gate_positive(low(spark, sf), 0.75).select("row_id", "label_model")


@query(
    "confidence_filter",
    sql(
        low_sql(),
        final="""select 'above' as part, row_id from m where prob > 0.9::double union all select 'below', row_id from m where prob < 0.9::double
union all select 'upto', row_id from m where prob <= 0.6::double""",
    ),
)
def confidence_filter(spark, sf):
    rows = low(spark, sf)
    parts = {
        "above": C.by_confidence(rows, low=0.9),
        "below": C.by_confidence(rows, high=0.9),
        "upto": C.by_confidence(rows, high=0.6, closed="high"),
    }
    return C.append(*[d.select(F.lit(n).alias("part"), "row_id") for n, d in parts.items()])


@query(
    "replace_low_confidence",
    sql(
        low_sql("a"),
        low_sql("b", "m2"),
        final="""select a.row_id, a.feature2, a.feature3, case when a.prob <= 0.7::double then b.label_model else a.label_model end as label_model, a.prob
from a join b using (row_id)""",
    ),
)
def replace_low_confidence(spark, sf):
    return relabel.replace_low_confidence(low(spark, sf), low(spark, sf, "m2"))


@query(
    "merge_corrected",
    sql(
        low_sql("a"),
        low_sql("b", "m2"),
        "old as (select distinct feature2, feature3, label_model, prob from a)",
        "new as (select distinct feature2, feature3, label_model, prob from b)",
        "fresh as (select * from new n where prob < 0.9::double and not exists (select 1 from old o where o.prob < 0.9::double "
        "and o.feature2 = n.feature2 and o.feature3 = n.feature3 and o.label_model = n.label_model and o.prob = n.prob))",
        final="""select feature2, feature3, 1 - label_model as label_model, prob from fresh
union all select * from old where prob < 0.9::double union all select * from new where prob > 0.9::double""",
    ),
)
def merge_corrected(spark, sf):
    cols = ["feature2", "feature3", "label_model", "prob"]
    return relabel.merge_corrected(low(spark, sf).select(*cols), low(spark, sf, "m2").select(*cols))


@query(
    "rows_not_in",
    """select l_returnflag, l_linenumber, l_quantity from lineitem l
where not exists (select 1 from (select distinct l_returnflag as f, l_linenumber as n, l_quantity as q from lineitem where l_linestatus = 'O' and l_tax > 0.07::double) o
  where o.f = l_returnflag and o.n = l_linenumber and o.q = l_quantity)""",
)
def rows_not_in(spark, sf):
    """Copies stay: few distinct rows make up the whole table."""
    cols = ["l_returnflag", "l_linenumber", "l_quantity"]
    rows = table(spark, sf, "lineitem")
    taxed = rows.where((F.col("l_linestatus") == "O") & (F.col("l_tax") > 0.07))
    return relabel.rows_not_in(rows.select(*cols), taxed.select(*cols))


# matches with labelled rows


@query(
    "labelled_match_count",
    sql(
        LABELLED,
        earlier_sql(),
        final="""select count(*) as n from (select distinct feature2, feature4 from earlier) e
where exists (select 1 from labelled l where l.feature2 = e.feature2 and l.feature4 = e.feature4)""",
    ),
)
def labelled_match_count(spark, sf):
    return relabel.labelled_match_count(earlier(spark, sf), labelled(spark, sf), ["feature2", "feature4"])


@query(
    "labelled_matches",
    sql(
        LABELLED,
        earlier_sql(),
        "last as (select feature2, feature4, arg_max(label, row_id) as label from labelled group by 1, 2)",
        final="select distinct e.feature2, e.feature4, l.label from earlier e join last l on e.feature2 = l.feature2 and e.feature4 = l.feature4",
    ),
)
def labelled_matches(spark, sf):
    return relabel.labelled_matches(earlier(spark, sf), labelled(spark, sf), ["feature2", "feature4"])


# clusters

CENTRES = "centres as (select label as cluster, " + ", ".join(f"round(avg({c}), 6) as {c}" for c in VECTOR_FEATURES) + " from vectors group by label)"
NEAREST = (
    "assigned as (select a.row_id, a.label, min({'d': "
    + s.distance(VECTOR_FEATURES)
    + ", 'c': b.cluster}).c as cluster from vectors a, centres b group by a.row_id, a.label)"
)


def centres(spark, sf):
    mean = [F.round(F.avg(c), 6).alias(c) for c in VECTOR_FEATURES]
    return wide_vectors(spark, sf).groupBy(F.col("label").alias("cluster")).agg(*mean)


@query("nearest_centroid", sql(VECTORS, CENTRES, NEAREST, final="select row_id, cluster from assigned"))
def nearest_centroid(spark, sf):
    return neighbours.nearest_centroid(wide_vectors(spark, sf), centres(spark, sf), VECTOR_FEATURES).select("row_id", "cluster")


VOTES = (
    "tally as (select cluster, label, count(*) as n from assigned group by 1, 2),\n"
    "votes as (select cluster, label from tally qualify row_number() over (partition by cluster order by n desc, label) = 1)"
)


@query("cluster_vote", sql(VECTORS, CENTRES, NEAREST, VOTES, final="select cluster, label from votes"))
def cluster_vote(spark, sf):
    assigned = neighbours.nearest_centroid(wide_vectors(spark, sf), centres(spark, sf), VECTOR_FEATURES)
    return relabel.vote(assigned)


@query(
    "cluster_vote_mean",
    sql(VECTORS, CENTRES, NEAREST, final="select cluster, round(avg(label), 6) as label from assigned group by cluster"),
)
def cluster_vote_mean(spark, sf):
    assigned = neighbours.nearest_centroid(wide_vectors(spark, sf), centres(spark, sf), VECTOR_FEATURES)
    return relabel.vote(assigned, ml_type="regression").withColumn("label", F.round("label", 6))


@query(
    "propagate_given_centroids",
    sql(
        VECTORS, CENTRES, NEAREST, VOTES,
        final="""select row_id, a.cluster, coalesce(v.label, 0) as label_model, 0.8::double as prob
from assigned a left join votes v on a.cluster = v.cluster""",
    ),
)
def propagate_given_centroids(spark, sf):
    rows = wide_vectors(spark, sf)
    out = relabel.propagate_given(rows, rows.drop("label"), centres(spark, sf), VECTOR_FEATURES)
    return out.select("row_id", "cluster", "label_model", "prob")


@query(
    "keep_prefix_relabel_rest",
    sql(
        COMPLETE,
        captured_sql(),
        "placed as (select *, row_number() over (order by row_id) as p from captured)",
        "votes as (select feature4, label from (select feature4, label, count(*) as n from complete group by 1, 2) "
        "qualify row_number() over (partition by feature4 order by n desc, label) = 1)",
        final="""select row_id, p.feature4, case when p <= 8000 then label_model else label end as label_model,
  case when p <= 8000 then prob else 0.8::double end as prob from placed p join votes v on p.feature4 = v.feature4""",
    ),
)
def keep_prefix_relabel_rest(spark, sf):
    """The first 8,000 captured rows keep their label, the others take their group's vote."""
    rows = captured(spark, sf).select("row_id", "feature4", "label_model", "prob")
    kept, rest = ordering.cut_n(rows, relabel.KEPT_ROWS, ["row_id"])
    votes = relabel.vote(labelled(spark, sf), "feature4", "label")
    return C.append(kept, relabel.propagate_assigned(rest, votes, "feature4").select(*kept.columns))


@query(
    "pseudo_labels_round_trip",
    sql(
        COMPLETE,
        captured_sql(),
        "votes as (select feature4, label from (select feature4, label, count(*) as n from complete group by 1, 2) "
        "qualify row_number() over (partition by feature4 order by n desc, label) = 1)",
        final=f"select row_id, {', '.join(f'captured.{c}' for c in FEATURES)}, label from captured join votes using (feature4)",
    ),
)
def pseudo_labels_round_trip(spark, sf):
    """Captured features and their new label, written as training data and read back."""
    path = scratch_path(spark, "captured")
    votes = relabel.vote(labelled(spark, sf), "feature4", "label")
    write_pseudo_labels(relabel.propagate_assigned(captured(spark, sf), votes, "feature4"), path, config())
    return C.pair(*read_captured(spark, path))


# neighbours


@query(
    "knn_vectors",
    sql(
        VECTORS,
        f"near as (select a.row_id, min({{'d': {s.distance(VECTOR_FEATURES)}, 'i': b.row_id}}, 5) as l "
        "from vectors a join vectors b on a.label = b.label and a.row_id <> b.row_id group by 1)",
        final="""select row_id, cast(i as integer) as rank, l[i].i as nn_id, round(sqrt(l[i].d), 6) as distance
from near, unnest(range(1, len(l) + 1)) as r(i)""",
    ),
)
def knn_vectors(spark, sf):
    near = neighbours.knn(vectors(spark, sf), 5, ["vec"], "label")
    return near.withColumn("distance", F.round("distance", 6))


@query(
    "knn_wide",
    sql(
        VECTORS,
        f"near as (select a.row_id, min({{'d': {s.distance(VECTOR_FEATURES)}, 'i': b.row_id}}, 5) as l "
        "from vectors a join vectors b on a.row_id <> b.row_id group by 1)",
        final="""select row_id, cast(i as integer) as rank, l[i].i as nn_id, round(sqrt(l[i].d), 6) as distance
from near, unnest(range(1, len(l) + 1)) as r(i)""",
    ),
)
def knn_wide(spark, sf):
    """Neighbours among all vectors of 64 columns, over leaves that split."""
    near = neighbours.knn(vectors(spark, sf), 5, ["vec"], leaf_rows=64)
    return near.withColumn("distance", F.round("distance", 6))


@query(
    "knn_leaves",
    sql(
        "points as (select event_id as row_id, event_type, value as x, user_id::double as y from events)",
        f"near as (select a.row_id, min({{'d': {s.distance(('x', 'y'))}, 'i': b.row_id}}, 3) as l "
        "from points a join points b on a.event_type = b.event_type and a.row_id <> b.row_id group by 1)",
        final="""select row_id, cast(i as integer) as rank, l[i].i as nn_id, round(sqrt(l[i].d), 6) as distance
from near, unnest(range(1, len(l) + 1)) as r(i)""",
    ),
)
def knn_leaves(spark, sf):
    """Neighbours of all events of the same type, searched over many leaves."""
    points = table(spark, sf, "events").select(
        F.col("event_id").alias("row_id"), "event_type", F.col("value").alias("x"), F.col("user_id").cast("double").alias("y")
    )
    near = neighbours.knn(points, 3, ["x", "y"], "event_type", leaf_rows=1024)
    return near.withColumn("distance", F.round("distance", 6))


@query(
    "knn_vote",
    sql(
        VECTORS,
        "queries as (select row_id + 1000000 as row_id, "
        + ", ".join(f"{c} * 0.9::double as {c}" for c in VECTOR_FEATURES)
        + " from vectors)",
        f"near as (select a.row_id, min({{'d': {s.distance(VECTOR_FEATURES)}, 'i': b.row_id}}, 20) as l from queries a, vectors b group by 1)",
        "votes as (select n.row_id, v.label, count(*) as n from near n, unnest(n.l) as u(e) join vectors v on v.row_id = u.e.i group by 1, 2)",
        final="""select row_id, label as label_model, n / 20 as prob from votes
qualify row_number() over (partition by row_id order by n desc, label) = 1""",
    ),
)
def knn_vote(spark, sf):
    train = vectors(spark, sf)
    queries = train.select((F.col("row_id") + 1_000_000).alias("row_id"), F.transform("vec", lambda x: x * 0.9).alias("vec"))
    return neighbours.knn_vote(train, queries, ["vec"])


# orders by confidence


@query(
    "top_bottom_confidence",
    sql(
        low_sql(),
        final="""select row_id * 3 as row_id, prob from m
union all (select row_id * 3 + 1, prob from m order by prob desc, row_id limit 500)
union all (select row_id * 3 + 2, prob from m order by prob, row_id limit 500)""",
    ),
)
def top_bottom_confidence(spark, sf):
    return resample.duplicate_extremes(low(spark, sf).select("row_id", "prob"), 500, renumber=True)


@query(
    "sorted_by_confidence",
    sql(low_sql(), final="select row_id, prob from m order by prob desc, row_id"),
)
def sorted_by_confidence(spark, sf):
    return ordering.sort_by_confidence(low(spark, sf).select("row_id", "prob"))


# reports


def _share(condition: str, name: str) -> str:
    return f"count(*) filter (where {condition}) / count(*) as {name}"


@query(
    "confidence_report",
    sql(
        low_sql(),
        final="select "
        + ", ".join(
            [
                _share("prob < 0.8::double", "below_08"),
                _share("prob < 0.8::double and label_model = 1", "below_08_label_1"),
                _share("prob < 0.8::double and label_model = 0", "below_08_label_0"),
                _share("prob < 0.7::double", "below_07"),
                _share("prob < 0.7::double and label_model = 1", "below_07_label_1"),
                _share("prob < 0.7::double and label_model = 0", "below_07_label_0"),
                _share("prob <= 0.6::double", "upto_06"),
                _share("prob <= 0.6::double and label_model = 1", "upto_06_label_1"),
                _share("prob < 0.5::double", "below_05"),
            ]
        )
        + " from m",
    ),
)
def confidence_report(spark, sf):
    return evaluate.confidence_report(low(spark, sf))


TRUTH = "t as (select *, cast(row_id % 3 = 0 as integer) as label from m)"
CONFUSION = (
    "c as (select count(*) filter (where label = 1 and label_model = 1) as tp, count(*) filter (where label = 0 and label_model = 1) as fp, "
    "count(*) filter (where label = 0 and label_model = 0) as tn, count(*) filter (where label = 1 and label_model = 0) as fn from t)"
)


@query(
    "binary_metrics",
    sql(
        low_sql(), TRUTH, CONFUSION,
        final="select (tp + tn) / (tp + fp + tn + fn) as accuracy, tp / (tp + fp) as precision, tp / (tp + fn) as recall, "
        "2 * tp / (2 * tp + fp + fn) as f1 from c",
    ),
)
def binary_metrics(spark, sf):
    return evaluate.binary_metrics(truth(low(spark, sf)), "label", "label_model")


@query("hard_auc", sql(low_sql(), TRUTH, CONFUSION, final="select (tp / (tp + fn) + tn / (tn + fp)) / 2 as auc from c"))
def hard_auc(spark, sf):
    return evaluate.hard_auc(truth(low(spark, sf)), "label", "label_model")


@query(
    "score_auc",
    sql(
        low_sql(), TRUTH,
        "r as (select label, rank() over (order by s) + (count(*) over (partition by s) - 1) / 2 as r "
        "from (select label, case when label_model = 1 then prob else 1 - prob end as s from t))",
        "n as (select sum(label) as p, sum(1 - label) as q from t)",
        final="select round((sum(r) filter (where label = 1) - any_value(p) * (any_value(p) + 1) / 2) / (any_value(p) * any_value(q)), 6) as auc from r, n",
    ),
)
def score_auc(spark, sf):
    rows = truth(low(spark, sf))
    chance = F.when(F.col("label_model") == 1, F.col("prob")).otherwise(1 - F.col("prob"))
    return evaluate.score_auc(rows.withColumn("score", chance)).withColumn("auc", F.round("auc", 6))


@query(
    "micro_metrics",
    sql(
        LABELLED,
        "g as (select label_multi, case when row_id % 4 = 0 then 'F' else 'O' end as guess from labelled)",
        "a as (select count(*) filter (where label_multi = guess) / count(*) as share from g)",
        final="select share as accuracy, share as precision, share as recall, share as f1 from a",
    ),
)
def micro_metrics(spark, sf):
    guess = F.when(F.col("row_id") % 4 == 0, "F").otherwise("O").alias("guess")
    return evaluate.micro_metrics(labelled(spark, sf).select("label_multi", guess), "label_multi", "guess")


@query("mispredictions", sql(low_sql(), TRUTH, final="select * from t where label <> label_model"))
def mispredictions(spark, sf):
    return C.mispredictions(truth(low(spark, sf)), "label", "label_model")
