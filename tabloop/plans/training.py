"""Estimators by name, fitting, scoring, search and comparison, all with Spark ML."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloop.functions.keys import hash_key
from tabloop.plans import adaboost, boosting, compact, kernels
from tabloop.storage import settle, small_table

# fixed values: boosted trees of the reference settings
BOOSTING = {"maxIter": 200, "maxDepth": 7}
HIDDEN_LAYER = 100
BOOSTED = ("xgb", "lightgbm", "gbt")
SOFTMAX = {"maxIter": "rounds", "maxDepth": "depth", "stepSize": "rate", "maxBins": "bins"}  # names in boosting.fit
OWN_MODELS = {"ada_boost": adaboost, "svm": kernels}  # fitted and scored by modules of this package
KINDS = {boosting.Boosted: boosting, adaboost.Ada: adaboost, kernels.Kernel: kernels}
Model = PipelineModel | boosting.Boosted | adaboost.Ada | kernels.Kernel
KNN_NEIGHBOURS = 20  # used by neighbours.knn_vote, the "knn" choice


def make_estimator(name: str, classes: int = 2, inputs: int | None = None, label: str = "label", **params):
    """Classifier of Spark ML by name; here, boosting of more than two classes is one against the rest (see `fit`)."""
    common = {"featuresCol": "features", "labelCol": label}
    if name in BOOSTED:
        boosted = GBTClassifier(**{**BOOSTING, "seed": 1242, **params}, **common)
        return boosted if classes <= 2 else OneVsRest(classifier=boosted, **common)
    if name == "random_forest":
        return RandomForestClassifier(**{"numTrees": 100, "seed": 1242, **params}, **common)
    if name == "decision_tree":
        return DecisionTreeClassifier(**{"maxDepth": 10, "seed": 1242, **params}, **common)
    if name == "naive_bayes":
        return NaiveBayes(**{"modelType": "gaussian", **params}, **common)
    if name == "mlp":
        if inputs is None:
            raise ValueError("mlp needs the number of inputs")
        layers = [inputs, HIDDEN_LAYER, classes]
        return MultilayerPerceptronClassifier(**{"layers": layers, "seed": 1242, **params}, **common)
    if name == "linear_svm":
        linear = LinearSVC(**params, **common)
        return linear if classes <= 2 else OneVsRest(classifier=linear, **common)
    if name in OWN_MODELS:
        raise ValueError(f"{name} is no estimator of Spark ML; use fit")
    if name == "knn":
        raise ValueError("knn has no fit step; use operators.neighbours.knn_vote")
    raise ValueError(f"unknown model: {name}")


def pipeline(features: Sequence[str], estimator) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), estimator])


def compacts(name: str, classes: int, params: Mapping[str, object]) -> bool:
    """Whether a fit sees only bins and numbers of rows: trees that draw no rows and take no weights of their own."""
    tree = name == "decision_tree" or (name in BOOSTED and classes <= 2)
    own = params.keys() & {"weightCol", "validationIndicatorCol", "featuresCol"}
    return tree and not own and params.get("subsamplingRate", 1.0) == 1.0


def fit_alike(
    stage: Bucketizer, alike: DataFrame, features: Sequence[str], name: str, classes: int, label: str, params: Mapping[str, object]
) -> PipelineModel:
    """A tree or boosted trees of the rows of `compact.alike`, with the step that bins raw rows before it.

    Nodes have rows by their number: `minInstancesPerNode` is a share of the weights here.
    """
    given = dict(params)
    least = given.pop("minInstancesPerNode", 1)
    if least > 1:
        total = alike.agg(F.sum(compact.COPIES)).first()[0] or 0.0
        share = max(given.get("minWeightFractionPerNode", 0.0), (least - 0.5) / max(total, 1.0))
        if share < 0.5:
            given["minWeightFractionPerNode"] = share
        else:
            given["maxDepth"] = 0  # no two parts have so many rows
    estimator = make_estimator(name, classes, len(features), label, weightCol=compact.COPIES, **given)
    fitted = pipeline([compact.bin_name(c) for c in features], estimator).fit(alike)
    return PipelineModel([stage, *fitted.stages])


def fit(
    df: DataFrame, features: Sequence[str], name: str = "xgb", label: str = "label", classes: int = 2, **params
) -> Model:
    """Fit a model on coded, scaled rows with an integer label; boosting of more than two classes is softmax boosting."""
    if name in OWN_MODELS:
        return OWN_MODELS[name].fit(df, features, label, classes, **params)
    if name in BOOSTED and classes > 2:
        given = {SOFTMAX.get(k, k): v for k, v in params.items()}
        return boosting.fit(df, features, label, classes, **given)
    rows = df.select(*features, F.col(label).cast("double").alias(label))
    if compacts(name, classes, params):
        rows = settle(rows, "labelled")
        stage = compact.binner(features, compact.bounds(rows, features, params.get("maxBins", compact.BINS)))
        return fit_alike(stage, compact.alike(rows, stage, label), features, name, classes, label, params)
    return pipeline(features, make_estimator(name, classes, len(features), label, **params)).fit(rows)


def score(model: Model, df: DataFrame) -> DataFrame:
    """Add `label_model` (class code) and `prob`, the largest class probability.

    Models without probabilities get the logistic of their margins, normalised over the classes.
    """
    if type(model) in KINDS:
        return KINDS[type(model)].score(model, df)
    out = model.transform(df)
    if "probability" in out.columns:
        chances = vector_to_array("probability")
    else:
        margins = F.transform(vector_to_array("rawPrediction"), lambda m: 1.0 / (1.0 + F.exp(-2.0 * m)))
        total = F.aggregate(margins, F.lit(0.0), lambda a, x: a + x)
        chances = F.transform(margins, lambda m: m / total)
    scored = out.withColumn("label_model", F.col("prediction").cast("int")).withColumn("prob", F.array_max(chances))
    bins = [c for stage in model.stages if isinstance(stage, Bucketizer) for c in stage.getOutputCols()]
    return scored.drop("features", "rawPrediction", "probability", "prediction", *bins)


def score_named(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Score with the column names `prediction_label` and `prediction_score`."""
    return score(model, df).withColumnsRenamed({"label_model": "prediction_label", "prob": "prediction_score"})


def draw_value(rng: random.Random, values):
    """One value of a list, or of a range (low, high[, step]) given as a dict; `log` draws evenly in logarithms."""
    if not isinstance(values, Mapping):
        return rng.choice(list(values))
    low, high, step = values["low"], values["high"], values.get("step")
    if values.get("log"):
        drawn = math.exp(rng.uniform(math.log(low), math.log(high)))
        return min(high, max(low, round(drawn) if isinstance(low, int) and isinstance(high, int) else drawn))
    if isinstance(low, int) and isinstance(high, int):
        return rng.randrange(low, high + 1, step or 1)
    return low + step * rng.randrange(int((high - low) / step + 1e-9) + 1) if step else rng.uniform(low, high)


def draw_trials(space: Mapping[str, object], trials: int, seed: int) -> list[dict]:
    """Distinct random points of a space of value lists and ranges; a value may be a function of the point so far.

    A function that returns None leaves its parameter out. Spaces with fewer points give those they have.
    """
    rng, seen, misses = random.Random(seed), [], 0
    while len(seen) < trials and misses < 50 * trials:
        point: dict = {}
        for k, values in space.items():
            chosen = values(point) if callable(values) else values
            if chosen is not None:
                point[k] = draw_value(rng, chosen)
        if point in seen:
            misses += 1
        else:
            seen.append(point)
    return seen


def holdout_accuracy(rows: DataFrame, features: Sequence[str], name: str, label: str, classes: int) -> Callable[[Mapping], float]:
    """Accuracy on the `_held` rows of a setting fitted on the others; fits that allow it share the compact rows."""
    few = compact.Compact(rows, features, label, "_held")

    def tried(point: Mapping) -> float:
        held = F.col("_held")
        if compacts(name, classes, point):
            stage, alike = few.of(point.get("maxBins", compact.BINS))
            model = fit_alike(stage, alike.where(~held), features, name, classes, label, point)
            judged = PipelineModel(model.stages[1:]).transform(alike.where(held))
            weighted = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy", weightCol=compact.COPIES)
            return float(weighted.evaluate(judged))
        model = pipeline(features, make_estimator(name, classes, len(features), label, **point)).fit(rows.where(~held))
        evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
        return float(evaluator.evaluate(model.transform(rows.where(held))))

    return tried


def random_search(
    df: DataFrame,
    features: Sequence[str],
    name: str,
    space: Mapping[str, object],
    trials: int = 100,
    seed: int = 1242,
    label: str = "label",
    train_share: float = 0.9,
    parallelism: int = 4,
    classes: int = 2,
    row_id: str = "row_id",
) -> DataFrame:
    """(trial, params, accuracy): accuracy of each drawn setting on a holdout, best first.

    The holdout follows the hash of the row id, so it does not move with the partitioning.
    """
    points = draw_trials(space, trials, seed)
    held = hash_key(F.col(row_id), f":{seed}") % 1000 >= int(round(train_share * 1000))
    rows = settle(df.select(*features, F.col(label).cast("double").alias(label), held.alias("_held")), "search")
    tried = holdout_accuracy(rows, features, name, label, classes)
    with ThreadPool(parallelism) as pool:
        metrics = pool.map(inheritable_thread_target(df.sparkSession)(tried), points)
    board = [(i, str(dict(sorted(p.items()))), m) for i, (p, m) in enumerate(zip(points, metrics, strict=True))]
    return small_table(df.sparkSession, board, "trial int, params string, accuracy double").orderBy(
        F.desc("accuracy"), "trial"
    )


def compare(
    df: DataFrame,
    features: Sequence[str],
    names: Sequence[str],
    folds: int = 3,
    label: str = "label",
    classes: int = 2,
    params: Mapping[str, Mapping] | None = None,
    row_id: str = "row_id",
    parallelism: int = 2,
) -> DataFrame:
    """(model, metric, value): cross-validated accuracy per model, best first; folds follow the row id hash."""
    rows = df.select(
        *features,
        F.col(label).cast("double").alias(label),
        (hash_key(F.col(row_id), ":fold") % folds).cast("int").alias("fold"),
    ).persist()
    board = []
    try:
        for name in names:
            estimator = make_estimator(name, classes, len(features), label, **(params or {}).get(name, {}))
            check = CrossValidator(
                estimator=pipeline(features, estimator),
                estimatorParamMaps=ParamGridBuilder().build(),
                evaluator=MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy"),
                numFolds=folds,
                foldCol="fold",
                parallelism=parallelism,
            )
            board.append((name, "accuracy", float(check.fit(rows).avgMetrics[0])))
    finally:
        rows.unpersist()
    return small_table(df.sparkSession, board, "model string, metric string, value double").orderBy(
        F.desc("value"), "model"
    )


def refit_best(board: DataFrame, df: DataFrame, features: Sequence[str], label: str = "label", classes: int = 2, **params) -> PipelineModel:
    """Fit the best model of a leaderboard on all rows."""
    best = board.agg(F.max_by("model", F.struct("value", "model")).alias("model")).first().model
    return fit(df, features, best, label, classes, **params)
