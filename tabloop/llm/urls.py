"""URL filters: given host and path rules, and rules mined from labelled urls by FP-growth.

A url is a set of tokens: scheme, host labels, path segments (numbers as one token), file ending, names of query
fields, fragment. FP-growth mines the token combinations that come together with the label `bad`. A combination
becomes a blocking rule when enough labelled urls have it (support), enough of those are bad (confidence), at least
twice the general share (lift), and no smaller rule inside it is as sure. Rules are indexed by their rarest token; a
url's token set looks up its tokens there and then must hold all tokens of a rule. Equal token sets are judged once.

Null urls and urls without `://` have empty host, path and token set, so no rule fits them. Repeated rows are judged
alike. Null labels are left out, as are labels of no page. Without labels nothing is mined. Extra columns pass
through; columns with the names of the outputs are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloop.operators.skew import lookup_join
from tabloop.storage import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "label=bad"
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.6
MIN_LIFT = 2.0
MIN_ROWS = 20  # labelled urls that a rule needs, however few there are in all
COMMON = 0.9  # a token of more labelled urls than this share tells nothing
TOKENS = 24  # of a url's frequent tokens, the rarest that a combination may be made of

Rule = tuple[str, str, str]  # verdict, host, path


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """After the first `://` up to /, ?, # or the end, A-Z lower-cased; empty without one."""
    raw = F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^[^/?#]*", 0)
    return F.translate(raw, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ?, # or the end."""
    rest = F.coalesce(_rest(url), F.lit(""))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule whose host is the url's or above it and whose path begins the url's."""
    name = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def tokens_of(url: Column) -> Column:
    """Sorted distinct tokens; none where there is no `://`."""
    rest = F.coalesce(_rest(url), F.lit(""))
    text = F.translate(rest, UPPER, LOWER)
    scheme = F.translate(F.substring_index(url, "://", 1), UPPER, LOWER)
    path = F.regexp_extract(text, r"^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(text, r"^[^?#]*\?([^#]*)", 1)
    parts = [
        F.array(F.concat(F.lit("scheme="), scheme)),
        F.transform(F.split(F.regexp_extract(text, r"^[^/?#]*", 0), r"\."), lambda x: F.concat(F.lit("host="), x)),
        F.transform(
            F.split(F.regexp_replace(path, r"\.[a-z0-9]{1,5}$", ""), "/"),
            lambda x: F.when(x == "", F.lit(None)).when(x.rlike(r"^\d+$"), "path=#").otherwise(F.concat(F.lit("path="), x)),
        ),
        F.array(F.when(path.rlike(r"\.[a-z0-9]{1,5}$"), F.concat(F.lit("ending="), F.regexp_extract(path, r"\.([a-z0-9]{1,5})$", 1)))),
        F.transform(F.split(query, "&"), lambda x: F.when(x != "", F.concat(F.lit("query="), F.substring_index(x, "=", 1)))),
        F.array(F.when(F.contains(rest, F.lit("#")), F.lit("fragment"))),
    ]
    made = F.array_sort(F.array_distinct(F.array_compact(F.concat(*parts))))
    return F.when(F.instr(url, "://") > 0, made).otherwise(F.array().cast("array<string>"))


def mine(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
    min_lift: float = MIN_LIFT,
) -> DataFrame:
    """(tokens, anchor, confidence, support): rules from rows of `tokens` and `bad`.

    Tokens rarer than the support or in nearly all urls make no rule, so they are taken out before mining; what is
    frequent has at most (tokens per url / support) members whatever the number of urls. Of a url with very many
    frequent tokens the rarest TOKENS take part in mining.
    """
    empty = "tokens array<string>, anchor string, confidence double, support double"
    spark = labelled.sparkSession
    rows = settle(labelled.select("tokens", "bad"), "labelled")
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("bad").cast("int")), F.lit(0)).alias("bad")).first()
    if total.bad in (0, total.n) or total.n < MIN_ROWS:
        return spark.createDataFrame([], empty)
    min_support = max(min_support, MIN_ROWS / total.n)
    counts = rows.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.where((F.col("n") >= min_support * total.n) & (F.col("n") <= COMMON * total.n))
    frequent = {r.token: r.n for r in counts.collect()}  # at most tokens per url / min_support rows
    if not frequent:
        return spark.createDataFrame([], empty)
    rarest = sorted(frequent, key=lambda t: (frequent[t], t))
    place = F.lit(rarest)
    known = F.filter(F.transform("tokens", lambda t: F.array_position(place, t)), lambda p: p > 0)
    some = F.transform(F.slice(F.array_sort(known), 1, TOKENS), lambda p: F.element_at(place, p.cast("int")))
    items = F.when(F.col("bad"), F.concat(some, F.array(F.lit(BAD)))).otherwise(some)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(rows.select(items.alias("items")))
    share = total.bad / total.n
    sure = model.associationRules.where(
        (F.element_at("consequent", 1) == BAD) & (F.col("confidence") >= max(min_confidence, min_lift * share))
    )
    rules = settle(sure.select(F.array_sort("antecedent").alias("tokens"), "confidence", "support"), "rules")
    a, b = rules.alias("a"), rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("as_sure"))
    anchored = rules.select("*", F.explode("tokens").alias("one")).alias("a")
    smaller = b.withColumn("one", F.element_at("part", 1))
    inside = (F.size("part") < F.size("tokens")) & (F.size(F.array_except("part", "tokens")) == 0)
    worse = anchored.join(smaller, "one").where(inside & (F.col("as_sure") >= F.col("confidence"))).select("tokens").distinct()
    kept = rules.join(worse, "tokens", "left_anti")
    first = F.array_min(F.transform("tokens", lambda t: F.array_position(place, t))).cast("int")
    return settle(kept.select("tokens", F.element_at(place, first).alias("anchor"), "confidence", "support"), "rules")


def blocked_sets(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Those rows of `sets` (key, tokens) that hold all tokens of some rule, with the surest rule's tokens."""
    index = settle(
        rules.groupBy("anchor").agg(F.collect_list(F.struct("confidence", "support", "tokens")).alias("rules")), "index"
    )
    looked = lookup_join(sets.select("key", "tokens", F.explode("tokens").alias("anchor")), index, ["anchor"], "inner")
    held = F.filter("rules", lambda r: F.size(F.array_except(r["tokens"], F.col("tokens"))) == 0)
    best = looked.select("key", F.array_max(held).alias("rule")).where("rule is not null")
    return best.groupBy("key").agg(F.max("rule").alias("rule")).select("key", F.col("rule.tokens").alias("mined_rule"))


def judge(
    pages: DataFrame, labelled: DataFrame, rules: Sequence[Rule], url: str = "url", min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Adds host, path, rule, verdict and mined_rule to every row.

    `labelled` has `url` and a boolean `bad`. The verdict is the given rule's, else `block` where a mined rule fits,
    else `allow`.
    """
    outputs = ["host", "path", "rule", "verdict", "mined_rule"]
    names = [c for c in pages.columns if c not in outputs]
    rows = pages.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(names)), F.col(url).cast("string").alias("_url"))
    host, path = host_of(F.col("_url")), path_of(F.col("_url"))
    known = labelled.where("bad is not null").select(tokens_of(F.col("url").cast("string")).alias("tokens"), "bad")
    mined = mine(known, min_support, min_confidence)
    rows = rows.withColumn("_tokens", tokens_of(F.col("_url"))).withColumn("_key", F.xxhash64("_tokens"))
    if mined.limit(1).count():
        sets = rows.groupBy(F.col("_key").alias("key")).agg(F.first("_tokens").alias("tokens"))
        found = settle(blocked_sets(sets, mined).withColumnRenamed("key", "_key"), "blocked")
        rows = lookup_join(rows, found, ["_key"])
    else:
        rows = rows.withColumn("mined_rule", F.lit(None).cast("array<string>"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")
    out = rows.withColumns({"host": host, "path": path}).withColumns({"rule": name, "verdict": F.coalesce(verdict, method)})
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)), *outputs)
