"""Guided search for settings: Parzen densities propose trials, a median rule stops the poor ones early.

Trials run in generations of `parallelism`. The first `startup` are drawn at random. After that a parameter is proposed
from two densities: one over its values in the best share of the finished trials, one over its values in the others;
of CANDIDATES drawn from the first, the one with the largest ratio of the densities is taken. Trials of the same
generation that are already proposed count as poor, so a generation spreads out. All draws follow from the seed and the
trial's number, and what a trial may know is the generations before its own: a search gives the same table again,
however its trials were timed.

Numbers have a mixture of normal densities around the values seen, cut off at the ends of their range, and one broad
density over the whole range; `log` ranges are handled in logarithms and steps are rounded to. Listed values have
counts, one added to each. A value that depends on the point so far is a function of it; None leaves it out.

A trial reports the loss of held-out rows each round. From `warmup` rounds on, and with `startup` finished trials, it
stops when its least loss so far is above the median of the finished trials' least losses up to that round.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from statistics import median

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloop.functions.keys import hash_key
from tabloop.plans import boosting
from tabloop.plans.training import BOOSTED, SOFTMAX, draw_value, holdout_accuracy
from tabloop.storage import settle, small_table

# fixed values: trials and warm-up rounds of the reference settings
TRIALS, WARMUP = 500, 30
STARTUP = 10
GOOD_SHARE, MOST_GOOD = 0.1, 25
CANDIDATES = 24
BOARD = "trial int, params string, value double, rounds int, stopped boolean, saved_rounds int"


@dataclass
class Trial:
    number: int
    point: dict
    value: float | None = None
    losses: list[float] = field(default_factory=list)
    stopped: bool = False
    asked: int = 0  # rounds of the whole trial

    def least(self, rounds: int) -> float:
        return min(self.losses[:rounds])


Report = Callable[[int, float], bool]
Objective = Callable[[dict, Report], float]


def _scale(values: Mapping) -> tuple[float, float, Callable[[float], float]]:
    turn = math.log if values.get("log") else float
    return turn(values["low"]), turn(values["high"]), turn


def density(values: Mapping, seen: Sequence[float]) -> Callable[[float], float]:
    """Logarithm of the density of a number: normals around the values seen and one over the range, cut off at its ends."""
    low, high, turn = _scale(values)
    wide = max(high - low, 1e-12)
    width = max(wide / math.sqrt(len(seen) + 1) / 2, wide * 1e-3)
    parts = [((low + high) / 2, wide), *((turn(v), width) for v in seen)]

    def inside(mean: float, sd: float) -> float:
        at = lambda x: 0.5 * (1 + math.erf((x - mean) / (sd * math.sqrt(2))))
        return max(at(high) - at(low), 1e-12)

    def log_density(value: float) -> float:
        x = turn(value)
        total = sum(math.exp(-0.5 * ((x - m) / s) ** 2) / (s * inside(m, s)) for m, s in parts)
        return math.log(max(total / len(parts), 1e-300))

    return log_density


def _draw_number(rng: random.Random, values: Mapping, seen: Sequence[float]):
    """One value from the density over the values seen, within the range and on its steps."""
    low, high, turn = _scale(values)
    wide = max(high - low, 1e-12)
    width = max(wide / math.sqrt(len(seen) + 1) / 2, wide * 1e-3)
    at = rng.randrange(len(seen) + 1)
    mean, sd = ((low + high) / 2, wide) if at == len(seen) else (turn(seen[at]), width)
    x = next((x for x in (rng.gauss(mean, sd) for _ in range(100)) if low <= x <= high), min(high, max(low, mean)))
    value = math.exp(x) if values.get("log") else x
    step = values.get("step") or (1 if isinstance(values["low"], int) and isinstance(values["high"], int) else None)
    if step:
        value = values["low"] + step * round((value - values["low"]) / step)
        value = type(values["low"])(value) if isinstance(values["low"], int) and isinstance(step, int) else value
    return min(values["high"], max(values["low"], value))


def propose(space: Mapping[str, object], finished: Sequence[Trial], pending: Sequence[dict], seed: int, number: int, startup: int = STARTUP) -> dict:
    """The next point, given finished trials and points that are being tried."""
    rng = random.Random(f"{seed}:{number}")
    point: dict = {}
    done = sorted((t for t in finished if t.value is not None), key=lambda t: (-t.value, t.number))
    good = done[: min(MOST_GOOD, math.ceil(GOOD_SHARE * len(done)))]
    poor = [t.point for t in done[len(good) :]] + list(pending)
    for name, given in space.items():
        values = given(point) if callable(given) else given
        if values is None:
            continue
        if len(done) < startup:
            point[name] = draw_value(rng, values)
            continue
        near, far = [t.point[name] for t in good if name in t.point], [p[name] for p in poor if name in p]
        if isinstance(values, Mapping):
            inside = lambda v, r=values: r["low"] <= v <= r["high"]
            near, far = [v for v in near if inside(v)], [v for v in far if inside(v)]
            drawn = [_draw_number(rng, values, near) for _ in range(CANDIDATES)]
            up, down = density(values, near), density(values, far)
        else:
            listed = list(values)
            weights = [1 + near.count(v) for v in listed]
            drawn = rng.choices(listed, weights, k=CANDIDATES)
            up = lambda v, s=near, n=len(listed): math.log((1 + s.count(v)) / (n + len(s)))
            down = lambda v, s=far, n=len(listed): math.log((1 + s.count(v)) / (n + len(s)))
        point[name] = max(drawn, key=lambda v: up(v) - down(v))
    return point


def should_stop(losses: Sequence[float], finished: Sequence[Trial], warmup: int = WARMUP, startup: int = STARTUP) -> bool:
    """The median rule for a trial with these losses so far, one a round; stopped trials count up to where they got."""
    rounds = len(losses)
    peers = [t.least(rounds) for t in finished if len(t.losses) >= rounds]
    return rounds > warmup and len(peers) >= startup and min(losses) > median(peers)


def search(
    objective: Objective, space: Mapping[str, object], trials: int = TRIALS, seed: int = 1242, parallelism: int = 4,
    startup: int = STARTUP, warmup: int = WARMUP, spark: SparkSession | None = None,
) -> list[Trial]:
    """All trials, in order; `objective` gives a value to be large and may ask whether to go on."""
    finished: list[Trial] = []
    while len(finished) < trials:
        generation: list[Trial] = []
        for number in range(len(finished), min(trials, len(finished) + parallelism)):
            pending = [t.point for t in generation]
            generation.append(Trial(number, propose(space, finished, pending, seed, number, startup)))

        def run(trial: Trial, known: list[Trial] = finished) -> None:
            def report(asked: int, loss: float) -> bool:
                trial.asked = asked
                trial.losses.append(loss)
                trial.stopped = should_stop(trial.losses, known, warmup, startup) and len(trial.losses) < asked
                return trial.stopped

            trial.value = objective(trial.point, report)

        with ThreadPool(parallelism) as pool:
            pool.map(inheritable_thread_target(spark)(run) if spark else run, generation)
        finished = [*finished, *generation]
    return finished


def board(spark: SparkSession, trials: Sequence[Trial]) -> DataFrame:
    """Trials, best first, with the rounds they ran and those that stopping saved."""
    rows = [
        (t.number, str(dict(sorted(t.point.items()))), t.value, len(t.losses), t.stopped, max(0, t.asked - len(t.losses)))
        for t in sorted(trials, key=lambda t: (-t.value, t.number))
    ]
    return small_table(spark, rows, BOARD)


def guided_search(
    df: DataFrame, features: Sequence[str], name: str, space: Mapping[str, object], trials: int = TRIALS, seed: int = 1242,
    label: str = "label", train_share: float = 0.9, parallelism: int = 4, classes: int = 2, row_id: str = "row_id",
    startup: int = STARTUP, warmup: int = WARMUP,
) -> DataFrame:
    """(trial, params, value, rounds, stopped, saved_rounds): accuracy of each setting on a holdout, best first.

    The holdout follows the hash of the row id. Boosting reports its held-out loss every round and may be stopped; a
    stopped trial is judged by the rounds it has. Other models report nothing and run to their end.
    """
    held = hash_key(F.col(row_id), f":{seed}") % 1000 >= int(round(train_share * 1000))
    rows = settle(df.where(F.col(label).isNotNull()).select(*features, F.col(label).cast("double").alias(label), held.alias("_held")), "search")
    test = rows.where("_held")
    tried = holdout_accuracy(rows, features, name, label, classes)
    right = F.avg((F.col(label).cast("int") == F.col("label_model")).cast("double"))

    def boosted(point: dict, report: Report) -> float:
        given = {SOFTMAX.get(k, k): v for k, v in point.items()}
        asked = given.get("rounds", boosting.ROUNDS)
        model = boosting.fit(rows, features, label, classes, held=F.col("_held"), stop=lambda loss: report(asked, loss), **given)
        return float(boosting.score(model, test).agg(right).first()[0] or 0.0)

    def fitted(point: dict, report: Report) -> float:
        return tried(point)

    found = search(boosted if name in BOOSTED else fitted, space, trials, seed, parallelism, startup, warmup, df.sparkSession)
    return board(df.sparkSession, found)
