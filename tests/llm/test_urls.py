"""URL rules: parsing, the longest given rule, and mined combinations against brute force."""

from itertools import combinations
from urllib.parse import urlsplit

from pyspark.sql import functions as F

from tabloop.llm import queries, urls

ODD = [
    None, "", "no scheme/en/", "://", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "http://example.com", "http://example.com?/en/",
    "http://x.net/es/1", "http://net/es/", "http://xnet/es/", "http://a.b.net/fr", "http://a.b.net/fr/#", "a://b://c/d", "http://exampleÉ.com/É",
    "http://www.example.com/en/1", "http://m.example.com/en/1", "http://notexample.com/en/1", "http://e.com/" + "x/" * 20000,
]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    path = rest[cut:]
    end = min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    return host, path[:end]


def given(host, path):
    fits = [r for r in queries.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return (best[1] + best[2], best[0]) if best else (None, None)


def test_given_table(spark):
    path = "/root/testdata/sf0.01"
    table = {r.page_id: r.url for r in spark.read.parquet(f"{path}/pages.parquet").collect()}
    out = queries.QUERIES["op6_url_association_rules"](spark, path).collect()
    assert sorted(r.page_id for r in out) == sorted(table)
    for r in out:
        assert (r.host, r.path) == split(table[r.page_id])
        assert urlsplit(table[r.page_id]).netloc == r.host
        name, verdict = given(r.host, r.path)
        assert r.rule == name
        assert r.verdict == (verdict or ("block" if r.mined_rule else "allow"))


def test_odd_urls_and_clashing_columns(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(ODD + ODD)], "page_id bigint, url string, verdict string")
    none = spark.createDataFrame([], "url string, bad boolean")
    out = urls.judge(df, none, queries.RULES).collect()
    assert len(out) == 2 * len(ODD)
    for r in out:
        assert (r.host, r.path) == split(r.url), r.url
        name, verdict = given(r.host, r.path)
        assert (r.rule, r.verdict) == (name, verdict or "allow"), r.url
    assert urls.judge(df.limit(0), none, queries.RULES).collect() == []


def labelled_urls():
    rows = []
    for i in range(400):
        host, path = f"h{i % 4}.org", ("en", "de", "win")[i % 3]
        rows.append((f"http://{host}/{path}/{i}?id={i}", (i % 4 == 1 and i % 3 == 2) or i % 40 == 0))
    return rows + [(None, True), ("http://h1.org/win/", None)]


def test_mined_combinations_equal_brute_force(spark):
    rows = labelled_urls()
    df = spark.createDataFrame(rows, "url string, bad boolean")
    tokens = df.where("bad is not null").select(urls.tokens_of(F.col("url")).alias("tokens"), "bad")
    got = {tuple(sorted(r.tokens)): (round(r.confidence, 9), round(r.support, 9)) for r in urls.mine(tokens).collect()}
    sets = [(frozenset(r.tokens), r.bad) for r in tokens.collect()]
    n = len(sets)
    share = sum(b for _, b in sets) / n
    least = max(urls.MIN_SUPPORT, urls.MIN_ROWS / n)
    items = {t for s, _ in sets for t in s}
    seen = {t: sum(t in s for s, _ in sets) for t in items}
    items = sorted(t for t in items if least * n <= seen[t] <= urls.COMMON * n)
    rules = {}
    for size in range(1, 6):
        for c in combinations(items, size):
            hits = [b for s, b in sets if s.issuperset(c)]
            if hits and sum(hits) >= least * n and sum(hits) / len(hits) >= max(urls.MIN_CONFIDENCE, urls.MIN_LIFT * share):
                rules[c] = (round(sum(hits) / len(hits), 9), round(sum(hits) / n, 9))
    rules = {c: v for c, v in rules.items() if not any(set(d) < set(c) and rules[d][0] >= v[0] for d in rules)}
    assert got == rules and rules
    pages = spark.createDataFrame([(1, "http://h1.org/win/5?id=1"), (2, "http://h1.org/de/5"), (3, "http://h2.org/win/5")], "page_id int, url string")
    assert {r.page_id: r.verdict for r in urls.judge(pages, df, []).collect()} == {1: "block", 2: "allow", 3: "allow"}


def test_blocked_sets_hold_all_tokens_of_a_rule(spark):
    sets = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a", "c"]), (3, ["b"]), (4, [])], "key bigint, tokens array<string>")
    rules = spark.createDataFrame([(["a", "b"], "b", 0.9, 0.1), (["c"], "c", 0.7, 0.2)], "tokens array<string>, anchor string, confidence double, support double")
    got = {r.key: r.mined_rule for r in urls.blocked_sets(sets, rules).collect()}
    assert got == {1: ["a", "b"], 2: ["c"]}


def test_query_mines_from_what_pages_say(spark, monkeypatch):
    """Pages of one host hold low-quality texts; the numbers of the pages carry no label."""
    path = "/root/testdata/sf0.01"
    tables = {name: spark.read.parquet(f"{path}/{name}.parquet") for name in ("documents", "labels")}
    texts = tables["documents"].join(tables["labels"], "doc_id").where("length(text) > 200")
    bad = texts.where("quality = 0").limit(40).withColumn("host", F.lit("junk.org"))
    fine = texts.where("quality = 1 and toxic = 0").limit(120).withColumn("host", F.lit("fine.org"))
    rows = bad.unionByName(fine).withColumn("page_id", 10**9 + F.col("doc_id"))
    url = F.concat(F.lit("http://"), "host", F.lit("/p/"), F.col("page_id").cast("string")).alias("url")
    html = F.concat(F.lit("<html><script>x</script><p>"), "text", F.lit("</p></html>")).alias("html")
    tables["pages"] = rows.select("page_id", url, html)
    monkeypatch.setattr(queries, "table", lambda _, sf, name: tables[name])
    out = queries.QUERIES["op6_url_association_rules"](spark, path).collect()
    assert {(r.host, r.verdict) for r in out} == {("junk.org", "block"), ("fine.org", "allow")}
    assert all(r.mined_rule == ["host=junk"] for r in out if r.host == "junk.org")
