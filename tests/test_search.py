"""Guided search: proposals against a plain version, the stopping rule, repeatability, and boosting under it."""

import math
import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from tabloop.plans import search
from tabloop.plans.search import Trial

SPACE = {
    "depth": {"low": 1, "high": 9},
    "rate": {"low": 0.001, "high": 1.0, "log": True},
    "share": {"low": 0.0, "high": 1.0, "step": 0.25},
    "kind": ["a", "b", "c"],
    "more": lambda p: [1, 2] if p["kind"] == "b" else None,
}


def quality(p):
    return -((p["depth"] - 6) ** 2) - (math.log10(p["rate"]) + 2) ** 2 - (p["kind"] != "b") * 4 - abs(p["share"] - 0.5)


def plain_number(rng, lo, hi, seen, far, log, step, whole):
    """Candidates and their ratio of mixtures, written out."""
    turn = math.log if log else float
    a, b = turn(lo), turn(hi)

    def mixture(values):
        return [((a + b) / 2, b - a)] + [(turn(v), max((b - a) / math.sqrt(len(values) + 1) / 2, (b - a) / 1000)) for v in values]

    def pdf(x, parts):
        out = 0
        for m, s in parts:
            area = (math.erf((b - m) / s / math.sqrt(2)) - math.erf((a - m) / s / math.sqrt(2))) / 2
            out += math.exp(-((x - m) ** 2) / (2 * s * s)) / s / max(area, 1e-12)
        return out / len(parts)

    drawn = []
    for _ in range(24):
        at = rng.randrange(len(seen) + 1)
        m, s = (mixture(seen)[1:] + mixture(seen)[:1])[at]
        x = rng.gauss(m, s)
        while not a <= x <= b:
            x = rng.gauss(m, s)
        v = math.exp(x) if log else x
        if step:
            v = lo + step * round((v - lo) / step)
            v = int(v) if whole else v
        drawn.append(min(hi, max(lo, v)))
    return max(drawn, key=lambda v: math.log(pdf(turn(v), mixture(seen))) - math.log(pdf(turn(v), mixture(far))))


def test_proposals_equal_a_plain_version():
    rng = random.Random(3)
    trials = []
    for i in range(40):
        p = search.propose(SPACE, [], [], 5, i)
        trials.append(Trial(i, p, quality(p) + rng.random()))
    pending = [trials[3].point]
    done = sorted(trials, key=lambda t: (-t.value, t.number))
    good, poor = [t.point for t in done[:4]], [t.point for t in done[4:]] + pending
    for number in range(60, 70):
        own = random.Random(f"9:{number}")
        want = {}
        for name, log, step, whole in (("depth", 0, 1, 1), ("rate", 1, None, 0), ("share", 0, 0.25, 0)):
            r = SPACE[name]
            want[name] = plain_number(own, r["low"], r["high"], [p[name] for p in good], [p[name] for p in poor], log, step, whole)
        for name, listed in (("kind", ["a", "b", "c"]), ("more", [1, 2])):
            if name == "more" and want["kind"] != "b":
                continue
            near, far = [p[name] for p in good if name in p], [p[name] for p in poor if name in p]
            drawn = own.choices(listed, [1 + near.count(v) for v in listed], k=24)
            ratio = {v: (1 + near.count(v)) / (len(listed) + len(near)) / ((1 + far.count(v)) / (len(listed) + len(far))) for v in listed}
            want[name] = max(drawn, key=lambda v: math.log(ratio[v]))
        got = search.propose(SPACE, trials, pending, 9, number)
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_points_stay_in_their_space_and_gather_near_the_best():
    found = search.search(lambda p, _: quality(p), SPACE, trials=120, seed=2)
    for t in found:
        p = t.point
        assert p["depth"] in range(1, 10) and 0.001 <= p["rate"] <= 1 and p["share"] in (0, 0.25, 0.5, 0.75, 1)
        assert p["kind"] in "abc" and ("more" in p) == (p["kind"] == "b")
    first, last = found[:10], found[-40:]
    assert sum(t.value for t in last) / 40 > sum(t.value for t in first) / 10 + 3
    again = search.search(lambda p, _: quality(p), SPACE, trials=120, seed=2)
    assert [t.point for t in again] == [t.point for t in found]


def test_median_rule():
    curves = [[1.0 - 0.01 * i * k for i in range(50)] for k in range(11)]
    peers = [Trial(i, {}, 0.0, c) for i, c in enumerate(curves)]
    at = median(min(c[:35]) for c in curves)
    losses = [1.0] * 34
    assert search.should_stop([*losses, at + 1e-9], peers) and not search.should_stop([*losses, at], peers)
    assert not search.should_stop([1.0] * 30, peers) and search.should_stop([1.0] * 31, peers)
    assert not search.should_stop([1.0] * 40, peers[:9])  # too few peers
    short = [Trial(i, {}, 0.0, c[:32]) for i, c in enumerate(curves)]
    assert not search.should_stop([1.0] * 40, short)


def test_stopped_trials_and_saved_rounds_are_in_the_result(spark):
    def objective(point, report):
        for i in range(60):
            if report(60, 1 / (1 + i * point["x"])):
                break
        return point["x"]

    found = search.search(objective, {"x": {"low": 0.0, "high": 1.0}}, trials=40, parallelism=3)
    rows = search.board(spark, found).collect()
    assert [r.value for r in rows] == sorted((r.value for r in rows), reverse=True)
    assert any(r.stopped for r in rows) and not all(r.stopped for r in rows)
    assert all(r.rounds + r.saved_rounds == 60 and r.stopped == (r.saved_rounds > 0) for r in rows)
    for t in found:
        if t.stopped:
            known = found[: t.number - t.number % 3]
            assert search.should_stop(t.losses, known) and not search.should_stop(t.losses[:-1], known)


def test_boosting_is_searched_and_stopped(spark):
    rows = [(i, float(i % 7), float(i % 5), int(i % 7 > 3 or i % 5 == 0)) for i in range(140)]
    df = spark.createDataFrame(rows, "row_id int, a double, b double, label int")
    space = {"maxDepth": {"low": 1, "high": 3}, "stepSize": {"low": 0.01, "high": 0.5, "log": True}, "maxIter": [4]}
    out = search.guided_search(df, ["a", "b"], "xgb", space, trials=6, startup=2, warmup=1, train_share=0.7).collect()
    assert len(out) == 6 and all(0 <= r.value <= 1 for r in out) and out[0].value == max(r.value for r in out)
    assert all(r.rounds + r.saved_rounds == 4 for r in out if r.stopped)
    tree = search.guided_search(df.withColumn("b", F.col("b") + 0), ["a", "b"], "decision_tree", {"maxDepth": [1, 4]}, trials=3)
    assert {r.rounds for r in tree.collect()} == {0}
