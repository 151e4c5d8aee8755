"""Training and scoring with models.

The labels of these queries are a function of one category, so a model must learn them exactly and SQL can tell every
answer. Decision trees and forests run with their default settings. Queries without SQL: those whose result is a
model's own confidence, search or clustering, the comparison of models, and stream timings.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tabloop.catalog import query
from tabloop.catalog.fixtures import (
    CATEGORICAL,
    COMPLETE,
    FEATURES,
    NUMERICAL,
    REQUEST_ROWS,
    captured,
    captured_sql,
    config,
    h,
    labelled,
    request_config,
    request_rows,
    sql,
)
from tabloop.catalog.fixtures import VECTOR_FEATURES as V
from tabloop.catalog.fixtures import wide_vectors
from tabloop.catalog.recipes import inputs as recipe_inputs
from tabloop.catalog.requests import JS, PLACED, captured_folder
from tabloop.functions.keys import hash_key
from tabloop.operators import drift, encode, relabel, stats
from tabloop.operators.evaluate import binary_metrics, confidence_report, micro_metrics
from tabloop.plans import search, training
from tabloop.plans.improve import consensus_labels
from tabloop.plans.jobs import train_model, train_on_woe
from tabloop.plans.scoring import Fitted, evaluate, prepare, score_table, submit
from tabloop.sources import tables
from tabloop.sources.requests import read_requests
from tabloop.storage import scratch_path, settle, small_table
from tabloop.streaming.requests import progress_rows, respond, score_stream

HIGH = ("HOUSEHOLD", "MACHINERY")  # categories of label 1; neighbours in code order, so rows between them agree
RULE = f"cast(feature4 in {HIGH} as integer)"
RULED = f"ruled as (select * replace ({RULE} as label) from complete)"
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def ruled(rows, name: str = "label"):
    return rows.withColumn(name, F.col("feature4").isin(*HIGH).cast("int"))


SMALL = {"maxIter": 5, "maxDepth": 3}


def fitted_on(rows, labels: bool = False) -> Fitted:
    index = encode.fit_category_index(rows, CATEGORICAL)
    coded = encode.apply_codes(rows, index, CATEGORICAL)
    names = encode.fit_labels(rows, "label_multi") if labels else None
    return Fitted(index, stats.fit_robust(coded, FEATURES), labels=names)


def training_rows(spark, sf):
    """(rows, fitted, coded and scaled rows with their label)."""
    rows = ruled(labelled(spark, sf, gaps=False))
    fitted = fitted_on(rows)
    ready = prepare(rows, config(), fitted, ("row_id", "label"))
    return rows, fitted, settle(ready)


def tree(spark, sf):
    rows, fitted, ready = training_rows(spark, sf)
    return rows, fitted, training.fit(ready, FEATURES, "decision_tree")


FLIPPED = f"""wrong as (select *, {RULE} as label_model, 1.0::double as prob,
    case when {h("row_id||':flip'")} % 20 = 0 then 1 - {RULE} else {RULE} end as truth from complete),
mixed as (select * exclude (truth) replace (truth as label) from wrong)"""


def _flipped(rows):
    """One label in twenty turned round, so that there is something to find."""
    return rows.withColumn("label", F.when(hash_key(F.col("row_id"), ":flip") % 20 == 0, 1 - F.col("label")).otherwise(F.col("label")))


@query(
    "train_gbt",
    sql(
        COMPLETE,
        FLIPPED,
        """counts as (select count(*) as n, count(*) filter (where label = label_model) as same,
    count(*) filter (where label = 1 and label_model = 1) as hits, count(*) filter (where label = 1) as truths,
    count(*) filter (where label_model = 1) as found from mixed)""",
        final="""select same / n as accuracy, hits / found as precision, hits / truths as recall,
  2 * (hits / found) * (hits / truths) / (hits / found + hits / truths) as f1 from counts""",
    ),
)
def train_gbt(spark, sf):
    """Metrics of boosted trees of their default rounds and depth, on rows with one label in twenty turned round."""
    _, _, ready = training_rows(spark, sf)
    model = training.fit(ready, FEATURES, "xgb")
    return binary_metrics(training.score(model, _flipped(ready)), "label", "label_model")


@query("train_multiclass")
def train_multiclass(spark, sf):
    """Softmax boosting of ten classes with its default rounds and depth, stopped by a held-out fifth; micro metrics."""
    rows = wide_vectors(spark, sf)
    held = hash_key(F.col("row_id"), ":held") % 5 == 0
    model = training.fit(rows, V, "lightgbm", classes=10, held=held, patience=10)
    return micro_metrics(training.score(model, rows), "label", "label_model")


MIDDLE = ("BUILDING", "FURNITURE", "HOUSEHOLD")  # neighbours in code order, with others on both sides
BETWEEN = f"select row_id, cast(feature4 in {MIDDLE} as integer) as label_model, true as sure from complete"


def _middle(spark, sf, name: str):
    """A model of rows whose label is 1 for the middle categories, which no single cut tells."""
    rows = labelled(spark, sf, gaps=False)
    fitted = fitted_on(rows)
    ready = prepare(rows.withColumn("label", F.col("feature4").isin(*MIDDLE).cast("int")), config(), fitted, ("row_id", "label"))
    ready = settle(ready)
    model = training.fit(ready, ["feature4"], name)
    return training.score(model, ready).select("row_id", "label_model", (F.col("prob") > 0.5).alias("sure"))


@query("train_ada_boost", sql(COMPLETE, final=BETWEEN))
def train_ada_boost(spark, sf):
    """Stumps of the default rounds and depth."""
    return _middle(spark, sf, "ada_boost")


@query("train_svm", sql(COMPLETE, final=BETWEEN))
def train_svm(spark, sf):
    """The radial kernel machine with its default settings."""
    return _middle(spark, sf, "svm")


SEGMENT = " ".join(f"when '{s}' then {i}" for i, s in enumerate(SEGMENTS))


@query(
    "train_softmax",
    sql(COMPLETE, final=f"select row_id, case feature4 {SEGMENT} end as label_model, true as sure from complete"),
)
def train_softmax(spark, sf):
    """Five classes told by one category, learnt by softmax boosting of the default rounds and depth."""
    rows = labelled(spark, sf, gaps=False)
    ready = settle(prepare(rows, config(), fitted_on(rows), ("row_id",)))
    classes = rows.select("row_id", (F.array_position(F.lit(list(SEGMENTS)), F.col("feature4")) - 1).alias("label"))
    model = training.fit(ready.join(classes, "row_id"), FEATURES, "xgb", classes=len(SEGMENTS))
    return training.score(model, ready).select("row_id", "label_model", (F.col("prob") > 0.5).alias("sure"))


SCORED = f"select row_id, {', '.join(FEATURES)}, {RULE} as label_model, 1.0::double as prob from captured"


@query("score_confidence", sql(COMPLETE, captured_sql(), final=SCORED))
def score_confidence(spark, sf):
    """Captured rows scored by a model trained on the labelled ones."""
    _, fitted, model = tree(spark, sf)
    return score_table(captured(spark, sf).drop("batch_id", "is_drift"), model, config(), fitted)


REPORT = ("below_08", "below_08_label_1", "below_08_label_0", "below_07", "below_07_label_1", "below_07_label_0", "upto_06",
          "upto_06_label_1", "below_05")


@query("score_report", "select " + ", ".join(f"0.0::double as {c}" for c in REPORT))
def score_report(spark, sf):
    """A tree with pure leaves is sure of every row."""
    _, fitted, model = tree(spark, sf)
    return confidence_report(score_table(captured(spark, sf), model, config(), fitted))


@query(
    "score_replace_low",
    sql(COMPLETE, captured_sql(), final=f"select row_id, {', '.join(FEATURES)}, label_model, 1.0::double as prob from captured"),
)
def score_replace_low(spark, sf):
    """Labels up to full confidence, here all, taken from the captured label."""
    _, fitted, model = tree(spark, sf)
    rows = captured(spark, sf).drop("batch_id", "is_drift")
    return score_table(rows, model, config(), fitted, other=rows.select("row_id", "label_model"), threshold=1.0)


@query("score_named", sql(COMPLETE, RULED, final="select row_id, label as prediction_label, true as sure from ruled"))
def score_named(spark, sf):
    """A forest of the default size, its scores told apart from even chances."""
    _, _, ready = training_rows(spark, sf)
    scored = training.score_named(training.fit(ready, FEATURES, "random_forest"), ready)
    return scored.select("row_id", "prediction_label", (F.col("prediction_score") > 0.5).alias("sure"))


@query(
    "score_submission",
    sql(
        COMPLETE,
        captured_sql(),
        f"""owned as (select o_custkey as batch_id, c.row_id, {RULE} as label
  from complete c join orders on o_orderkey = c.row_id)""",
        final='select batch_id, 0::bigint as part, list(label order by row_id) as "values" from owned group by 1',
    ),
)
def score_submission(spark, sf):
    _, fitted, model = tree(spark, sf)
    return submit(captured(spark, sf), model, config(), fitted)


@query(
    "evaluate_labelled",
    sql(
        COMPLETE,
        FLIPPED,
        final="""select (count(*) filter (where label = 1 and label_model = 1) / count(*) filter (where label = 1)
  + count(*) filter (where label = 0 and label_model = 0) / count(*) filter (where label = 0)) / 2 as auc from mixed""",
    ),
)
def evaluate_labelled(spark, sf):
    rows, fitted, model = tree(spark, sf)
    return evaluate(_flipped(rows), model, config(), fitted)[0]


@query("evaluate_mispredictions", sql(COMPLETE, FLIPPED, final="select * from mixed where label <> label_model"))
def evaluate_mispredictions(spark, sf):
    rows, fitted, model = tree(spark, sf)
    return evaluate(_flipped(rows), model, config(), fitted)[1]


@query("model_round_trip", sql(COMPLETE, RULED, final="select label as label_model, count(*) as n from ruled group by 1"))
def model_round_trip(spark, sf):
    """A saved model with its input schema, loaded again and used."""
    _, _, ready = training_rows(spark, sf)
    inputs = ready.select(*FEATURES)
    path = tables.model_path(scratch_path(spark, "models"), "gbt", 1)
    tables.save_model(training.fit(ready, FEATURES, "xgb", **SMALL), inputs.schema, path)
    model, schema = tables.load_model(spark, path)
    return training.score(model, tables.check_schema(ready, schema)).groupBy("label_model").agg(F.count(F.lit(1)).alias("n"))


TREE_SPACE = {
    "maxDepth": {"low": 1, "high": 10},
    "maxBins": [8, 16, 32, 64],
    "minInstancesPerNode": {"low": 1, "high": 200, "log": True},
    "minInfoGain": {"low": 0.0, "high": 0.2},
}


@query("random_search")
def random_search(spark, sf):
    _, _, ready = training_rows(spark, sf)
    return training.random_search(ready, FEATURES, "decision_tree", TREE_SPACE, parallelism=8)


@query("guided_search")
def guided_search(spark, sf):
    """A hundred trials proposed by densities of the good and the poor ones before."""
    _, _, ready = training_rows(spark, sf)
    return search.guided_search(ready, FEATURES, "decision_tree", TREE_SPACE, trials=100, parallelism=8)


@query("leaderboard")
def leaderboard(spark, sf):
    _, _, ready = training_rows(spark, sf)
    small = {"random_forest": {"numTrees": 5, "maxDepth": 3}, "decision_tree": {"maxDepth": 3}}
    return training.compare(ready, FEATURES, ["decision_tree", "random_forest", "naive_bayes"], folds=2, params=small)


@query(
    "log_run",
    """select 'run-1' as run_id, 'phase-1_prob-1_xgb-1' as experiment, kind, name, value from (values
  ('param', 'maxIter', '5'), ('param', 'maxDepth', '3'), ('metric', 'accuracy', '1.0'), ('metric', 'precision', '1.0'),
  ('metric', 'recall', '1.0'), ('metric', 'f1', '1.0')) as v(kind, name, value)""",
)
def log_run(spark, sf):
    """Parameters and metrics of a run appended to the run log."""
    _, _, ready = training_rows(spark, sf)
    model = training.fit(ready, FEATURES, "xgb", **SMALL)
    metrics = binary_metrics(training.score(model, ready), "label", "label_model").first().asDict()
    path = scratch_path(spark, "runs")
    tables.log_run(spark, path, "run-1", tables.experiment_name(config(), "xgb"), SMALL, metrics)
    return spark.read.schema(tables.RUN_SCHEMA).parquet(path)


def _metric_rows(spark, metrics: dict):
    rows = sorted((name, round(float(value), 6)) for name, value in metrics.items())
    return small_table(spark, rows, "name string, value double")


ALL_RIGHT = "select name, 1.0::double as value from (values " + ", ".join(
    f"('{part}_{m}')" for part in ("train", "test") for m in ("accuracy", "precision", "recall", "f1", "auc")
) + ") as v(name)"


def _training_job(spark, sf, phase: str, **more):
    """A recipe's model of default settings, scored on rows it has not seen, logged, saved and loaded again."""
    given = recipe_inputs(spark, sf, phase, "prob-1", **more)
    high = [r.code for r in given.index.where(F.col("col") == "feature4").collect() if r.category in HIGH]
    codes = lambda df: df.withColumn("label", F.col("feature4").isin(*high).cast("int"))
    given = replace(given, train=codes(given.train), test=codes(given.test), captured=ruled(given.captured, "label_model"))
    if given.earlier is not None:
        given = replace(given, earlier=ruled(given.earlier))
    if given.scored is not None:
        given = replace(given, scored=ruled(given.scored))
    root = scratch_path(spark, "job")
    _, _, test, metrics = train_model(phase, "prob-1", given, "decision_tree", root, "run-1")
    name = tables.experiment_name(given.cfg, "decision_tree")
    model, schema = tables.load_model(spark, tables.model_path(f"{root}/models", name, "run-1"))
    again = training.score(model, tables.check_schema(test.drop("label_model", "prob"), schema))
    assert spark.read.parquet(f"{root}/runs").where("kind = 'metric'").count() == len(metrics)
    return _metric_rows(spark, metrics | {"test_accuracy": again.agg(F.avg((F.col("label") == F.col("label_model")).cast("int"))).first()[0]})


@query("train_job_phase_1", ALL_RIGHT)
def train_job_phase_1(spark, sf):
    return _training_job(spark, sf, "phase-1")


@query("train_job_phase_2", ALL_RIGHT)
def train_job_phase_2(spark, sf):
    rows = labelled(spark, sf, gaps=False).select("row_id", *FEATURES, "label")
    scored = rows.withColumn("prob", (hash_key(F.col("row_id"), ":scored") % 5000 + 5000) / 10000)
    return _training_job(spark, sf, "phase-2", scored=scored, scored_train_rows=1000, extreme_rows=400)


@query("train_job_phase_3", ALL_RIGHT)
def train_job_phase_3(spark, sf):
    from tabloop.catalog.fixtures import earlier

    return _training_job(spark, sf, "phase-3", earlier=earlier(spark, sf))


@query(
    "train_woe_boosting",
    "select name, 1.0::double as value from (values ('accuracy'), ('precision'), ('recall'), ('f1'), ('auc')) as v(name)",
)
def train_woe_boosting(spark, sf):
    """Boosting on weights of evidence, judged on a holdout of a fifth."""
    rows = ruled(labelled(spark, sf, gaps=False)).select("row_id", *FEATURES, "label")
    return _metric_rows(spark, train_on_woe(rows, FEATURES, NUMERICAL, **SMALL)[2])


@query("propagate_kmeans")
def propagate_kmeans(spark, sf):
    """Vectors relabelled by 500 mini-batch clusters of all labelled vectors."""
    rows = wide_vectors(spark, sf)
    out = relabel.propagate(rows, rows.drop("label"), V)
    return out.select("row_id", "label_model", "prob")


@query("consensus_models")
def consensus_models(spark, sf):
    """Captured rows labelled by the agreement of several models."""
    _, fitted, ready = training_rows(spark, sf)
    models = [
        training.fit(ready, FEATURES, "xgb", **SMALL),
        training.fit(ready, FEATURES, "random_forest", numTrees=5, maxDepth=4),
        training.fit(ready, FEATURES, "naive_bayes"),
    ]
    return consensus_labels(captured(spark, sf), models, config(), fitted)


def _request_model(spark, sf):
    cfg = request_config()
    rows = request_rows(spark, sf)
    fitted = Fitted(encode.fit_category_index(rows, cfg.categorical), stats.fit_robust(rows, ["feature1", "feature2"]))
    rows_ = rows.withColumn("label", (F.col("feature3") == "error").cast("int"))
    ready = prepare(rows_, cfg, fitted, ("row_id", "label"))
    return cfg, fitted, training.fit(ready, cfg.features, "decision_tree"), drift.fit_distribution(rows, ["feature3"])


ANSWERS = sql(
    REQUEST_ROWS,
    PLACED,
    JS,
    "lists as (select id, list(case when feature3 = 'error' then 1.0 else 0.0 end::double order by row_pos) as predictions from placed group by id)",
    final="select id, predictions, 0::bigint as errors, cast(score > 0.1::double as integer) as drift from lists join js using (id)",
)


@query("respond_requests", ANSWERS)
def respond_requests(spark, sf):
    """All captured requests answered in one batch job."""
    cfg, fitted, model, reference = _request_model(spark, sf)
    found = read_requests(spark, captured_folder(spark, sf)).withColumn("request", F.col("id"))
    return respond(found, cfg, fitted, model, reference)[0].select("id", "predictions", "errors", "drift")


@query("stream_score", ANSWERS)
def stream_score(spark, sf):
    """The same requests arriving as a stream of files."""
    cfg, fitted, model, reference = _request_model(spark, sf)
    out = scratch_path(spark, "answers")
    stream = score_stream(
        spark, captured_folder(spark, sf), out, scratch_path(spark, "offsets"), cfg, fitted, model, reference, max_files=4
    )
    stream.awaitTermination()
    return spark.read.parquet(f"{out}/responses").select("id", "predictions", "errors", "drift")


@query("stream_latency")
def stream_latency(spark, sf):
    """Time and throughput of every micro-batch."""
    cfg, fitted, model, _ = _request_model(spark, sf)
    out = scratch_path(spark, "answers")
    stream = score_stream(spark, captured_folder(spark, sf), out, scratch_path(spark, "offsets"), cfg, fitted, model)
    stream.awaitTermination()
    return progress_rows(spark, stream, "stream-1", "requests")
