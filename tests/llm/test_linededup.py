"""Line dedup against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tabloop.llm import linededup, queries


def tokens(line, words=5):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", line.lower()) if x]
    if len(w) < words:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1))


def brute(rows, part=80, whole=100, words=5):
    """(id, text) to numbers of removed lines; ids are distinct and not null."""
    lines = [(i, k, tokens(x, words)) for i, t in sorted(rows) for k, x in enumerate((t or "").split("\n")) if t is not None]
    owners, out = {}, {i: [] for i, _ in rows}
    for place, (i, k, s) in enumerate(lines):
        near = {j for x in s for j in owners.get(x, ())}
        for j in near:
            shared = len(s & lines[j][2])
            if whole * shared >= part * (len(s) + len(lines[j][2]) - shared):
                out[i].append(k)
                break
        for x in s:
            owners.setdefault(x, []).append(place)
    return out


def test_equals_brute_force_on_the_given_table(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    expected = brute(rows)
    got = {r.doc_id: (r.n_lines, list(r.removed)) for r in queries.QUERIES["op8_line_dedup"](spark, path).collect()}
    assert got == {i: (len(t.split("\n")), expected[i]) for i, t in rows}
    assert sum(map(len, expected.values())) > 100


def corpus(seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    base = [[draw.choice(words) for _ in range(draw.choice([1, 3, 5, 30, 60]))] for _ in range(15)]
    rows = []
    for i in range(90):
        lines = []
        for _ in range(draw.randrange(1, 5)):
            line = list(draw.choice(base))
            for _ in range(draw.choice([0, 0, 1, 1, 2])):
                line[draw.randrange(len(line))] = draw.choice(words)
            lines.append(draw.choice(["", " "]) + draw.choice([" ", "\t"]).join(line).title())
        rows.append((i, "\n".join(lines + draw.choice([[], ["", "  "]]))))
    return rows


@pytest.mark.parametrize("seed, often", [(1, 32), (2, 0)])
def test_near_copies(spark, monkeypatch, seed, often):
    if not often:  # every bucket that two lines use counts as frequent
        monkeypatch.setattr(linededup, "OFTEN", 1)
        monkeypatch.setattr(linededup, "BUCKETS", 64)
    rows = corpus(seed) + [(500, None), (501, ""), (502, "\n\n")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("removed", F.lit("x")).withColumn("line", F.lit(1))
    out = linededup.without_repeats(df).collect()
    expected = brute(rows)
    texts = dict(rows)
    assert len(out) == len(rows) and any(expected.values())
    for r in out:
        assert list(r.removed) == expected[r.doc_id], r.doc_id
        if texts[r.doc_id] is None:
            assert r.text is None and r.n_lines == 0
        else:
            lines = texts[r.doc_id].split("\n")
            assert r.n_lines == len(lines)
            assert r.text == "\n".join(x for k, x in enumerate(lines) if k not in expected[r.doc_id])
        assert r.line == 1


def test_short_tokens_and_other_threshold(spark):
    rows = corpus(5)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r.doc_id: list(r.removed) for r in linededup.without_repeats(df, threshold=(60, 100), words=1).collect()}
    assert out == brute(rows, 60, 100, 1)


def test_repeated_and_null_identifiers(spark):
    rows = [(1, "a b c d e f\nown line one"), (1, "a b c d e f\nown line one"), (1, "a b c d e f\nother"), (None, "A B C D E F"), (2, "other")]
    out = linededup.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(out) == 5
    assert [r.text for r in out if r.doc_id is None] == ["A B C D E F"]  # a null identifier comes first
    assert [r.text for r in out if r.doc_id == 2] == [""]
    assert sorted(r.text for r in out if r.doc_id == 1) == ["other", "own line one", "own line one"]


def test_empty_table(spark):
    assert linededup.without_repeats(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_query_reports_the_lines_of_a_null_identifier(spark, monkeypatch):
    rows = [(None, "a b c d e f\nother\na b c d e f"), (1, "a b c d e f\nown line")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(queries, "table", lambda *_: df)
    out = queries.QUERIES["op8_line_dedup"](spark, "").collect()
    assert {r.doc_id: (r.n_lines, list(r.removed)) for r in out} == {None: (3, [2]), 1: (2, [0])}


def test_lines_that_share_a_passage_only_make_no_pairs(spark, monkeypatch):
    draw = random.Random(7)
    passage = [f"p{i}" for i in range(60)]
    own = [[f"o{draw.randrange(10**6)}" for _ in range(50)] for _ in range(200)]
    rows = [(i, " ".join(w[:25] + passage + w[25:])) for i, w in enumerate(own)]
    rows.append((900, " ".join(own[3][:25] + passage + own[3][25:49] + ["new"])))
    written = {}
    settle = linededup.settle
    monkeypatch.setattr(linededup, "settle", lambda df, name: written.setdefault(name, []).append(settle(df, name)) or written[name][-1])
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r.key: list(r.removed) for r in linededup.removals(df).collect()}
    assert out == {900: [0]} == {i: v for i, v in brute(rows).items() if v}
    assert written["ids"][0].count() > 150  # they share a first token by hash
    assert sum(p.count() for p in written["pairs"]) == 1


def test_hot_tokens_take_the_balanced_join(spark, monkeypatch):
    monkeypatch.setattr(linededup, "HOT_ROWS", 2)
    rows = corpus(3)
    out = {r.key: list(r.removed) for r in linededup.removals(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out == {i: v for i, v in brute(rows).items() if v}


def test_lines_that_share_one_token_by_chance_are_not_listed(spark, monkeypatch):
    """Each line shares its first token by hash, and no more of them, with another line; two lines are alike."""
    draw = random.Random(11)
    rows = [(i, " ".join(f"o{draw.randrange(10**9)}" for _ in range(54))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    words = {i: t.split(" ") for i, t in rows}
    runs = [(i, k, " ".join(w[k : k + 5])) for i, w in words.items() for k in range(50)]
    hashed = spark.createDataFrame(runs, "doc_id bigint, at bigint, run string").select("doc_id", "at", linededup.tokens_of(F.col("run"))[0].alias("t"))
    at = {r.doc_id: r["at"] for r in hashed.groupBy("doc_id").agg(F.min_by("at", "t").alias("at")).collect()}
    rows += [(100 + i, " ".join(words[i][at[i] : at[i] + 5] + [f"x{draw.randrange(10**9)}" for _ in range(49)])) for i in at]
    rows.append((999, " ".join(words[7][:53] + ["new"])))
    written = {}
    settle = linededup.settle
    monkeypatch.setattr(linededup, "settle", lambda df, name: written.setdefault(name, []).append(settle(df, name)) or written[name][-1])
    out = {r.key: list(r.removed) for r in linededup.removals(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out == {999: [0]} == {i: v for i, v in brute(rows).items() if v}
    assert len(at) == 60 and written["ids"][0].count() > 110 and written["sets"][0].count() < 10


def test_own_words_of_lines_leave_no_room_for_a_pair(spark):
    """Lines of one passage and nine own words share first tokens, but no pair of them passes the positional filter."""
    draw = random.Random(13)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(f"o{draw.randrange(10**9)}" for _ in range(9)) + " " + " ".join(passage)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = df.select(F.col("doc_id").alias("id"), linededup.tokens_of(F.col("text")).alias("t"))
    live = linededup.firsts_by_use(sets, (80, 100))
    other = live.select("token", *(F.col(a).alias(b) for a, b in zip(["id", "n", "at", "shared"], ["other", "m", "bt", "also"])))
    both = live.join(other, "token").where("id < other")
    assert both.count() > 700 and both.where(linededup._fits((80, 100))).count() == 0
    assert not any(brute(rows).values())
