"""Mixing against plain Python: budgets by repeated dealing, prefixes by sorting."""

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from tabloop.llm import mixing


def dealt(budget, children):
    """children: name to (capacity, weight); hand out by weight, again and again, until nothing is left over."""
    got = dict.fromkeys(children, 0.0)
    open_ = {c for c, (cap, w) in children.items() if w > 0}
    left = min(budget, sum(children[c][0] for c in open_))
    while open_ and left > 1e-9:
        total = sum(children[c][1] for c in open_)
        give = {c: left * children[c][1] / total for c in open_}
        full = {c for c in open_ if got[c] + give[c] >= children[c][0] - 1e-9}
        if not full:
            for c in open_:
                got[c] += give[c]
            break
        for c in full:
            left -= children[c][0] - got[c]
            got[c] = children[c][0]
        open_ -= full
    return got


def key(name, epoch, seed):
    return int(hashlib.md5(f"{name}:{epoch}:{seed}".encode()).hexdigest()[:8], 16)


def brute(rows, weights, share, epochs, seed):
    """rows: (id, level values, text); weights: one dict per level."""
    words = [(i, path, len((t or "").split()), hashlib.md5((t or "").encode()).hexdigest()) for i, path, t in rows]
    words = [w for w in words if w[2]]
    supply = defaultdict(int)
    for _, path, n, _ in words:
        supply[path] += n
    ok = {p: n for p, n in supply.items() if all(weights[d].get(p[d], 1) > 0 for d in range(len(p)))}
    budgets = {(): min(int(sum(supply.values()) * share), sum(ok.values()) * epochs)}
    depth = len(weights)
    for d in range(depth):
        below = {}
        for node, budget in budgets.items():
            children = defaultdict(float)
            for p, n in ok.items():
                if p[:d] == node:
                    children[p[: d + 1]] += n * epochs
            below |= dealt(budget, {c: (cap, weights[d].get(c[d], 1)) for c, cap in children.items()})
        budgets = below
    out = []
    for path, budget in budgets.items():
        whole, rest = divmod(min(int(budget + 1e-6), ok[path] * epochs), ok[path])
        mine = [w for w in words if w[1] == path]
        for epoch in range(1, whole + 1):
            out += [(i, epoch) for i, _, _, _ in mine]
        before = 0
        groups = defaultdict(list)
        for i, _, n, h in mine:
            groups[key("null" if i is None else i, whole + 1, seed), "null" if i is None else str(i), h].append((i, n))
        for k in sorted(groups):
            if before < rest:
                out += [(i, whole + 1) for i, _ in groups[k]]
            before += sum(n for _, n in groups[k])
    return sorted(out, key=repr)


def corpus():
    rows = []
    for i in range(600):
        source = "hot" if i % 3 == 0 else f"s{i % 7}"
        path = (f"d{i % 2}" if source != "hot" else "d0", None if i % 5 == 0 else "en", source)
        rows.append((i, path, "w " * (1 + (i * 37) % 50)))
    return rows + [(7, rows[7][1], "other text"), (8, rows[8][1], rows[8][2]), (None, rows[9][1], "no number"),
                   (700, rows[9][1], None), (701, rows[9][1], " "), (702, ("zero", "en", "s"), "never taken")]


def taken(spark, rows, weights, **options):
    flat = [(i, *path, t, "x") for i, path, t in rows]
    df = spark.createDataFrame(flat, "doc_id bigint, a string, b string, c string, text string, epoch string")
    levels = {n: F.col(n) for n in "abc"}
    columns = {}
    for n, by in zip("abc", weights):
        columns[n] = F.lit(1)
        for value, weight in by.items():
            columns[n] = F.when(F.col(n) == value, weight).otherwise(columns[n])
    out = mixing.mix(df, levels, columns, **options)
    return sorted(((r.doc_id, r.epoch) for r in out.collect()), key=repr)


def test_equals_plain_python(spark):
    rows = corpus()
    weights = [{"d0": 5, "zero": 0}, {"en": 3}, {"s1": 10, "hot": 2}]
    for share, epochs in ((0.5, 1), (1.3, 2), (0.9, 3), (9.0, 2)):
        got = taken(spark, rows, weights, share=share, epochs=epochs, block_rows=10)
        assert got == brute(rows, weights, share, epochs, mixing.SEED), share


def test_blocks_do_not_change_what_is_taken(spark):
    rows = corpus()
    assert taken(spark, rows, [{}, {}, {}], share=0.4, block_rows=3) == taken(spark, rows, [{}, {}, {}], share=0.4)


def test_empty_table_and_no_budget(spark):
    assert taken(spark, [], [{}, {}, {}], share=0.5) == []
    assert taken(spark, corpus(), [{}, {}, {}], budget=0) == []
