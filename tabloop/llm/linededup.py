"""Removal of repeated lines by an exact set-similarity join, as DataFrame functions only.

A line's tokens are its distinct runs of five words (lower case, cut at blank bytes); a line of fewer words is one
token, a line without words has none and is never removed. A line goes when an earlier line of the corpus, by
identifier and line number, has a Jaccard similarity of the token sets of at least `threshold`. Whether that earlier
line stays does not matter, so the first of a group of alike lines always stays.

1. Equal lines are grouped by hash; only the first of each group goes on.
2. Tokens are ordered by rarity: those whose hash bucket is used far more than the mean come last, then by hash.
   Alike lines share one of their first n - ceil(t n) + 1 tokens, and 1 + e of their first n - ceil(t n) + 1 + e. Lines
   of which fewer are used by any other line end here; one token alone is often shared by chance in a large corpus.
3. For what is left, the token sets are made from the texts and ordered anew by exact use among these lines. A line
   that shares fewer than ceil(t n) of its tokens ends here too, such as one that repeats a passage within a text of
   its own; tokens that one line alone has come first in the order and need no row.
4. Lines of a token group are in order of position. Each line is first compared with the group's first line and the
   one just before it, with length and positional filters; most copies end here. What is left is joined with the
   earlier lines of its token groups that pass these filters; a pair goes on if its number of common first tokens
   leaves room for the overlap. Tokens of one line alone leave no room, so lines that share a passage but not their own
   words pass no filter.
5. Pairs are verified on the token sets.

No list of a group's lines is ever gathered. Null texts have no lines. Rows with one identifier and text are one
document; all of them get the same result. A null identifier comes first. Repeated identifiers with different texts
are told apart by the text's hash. Extra columns pass through. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloop.operators.skew import HOT_ROWS, fits_broadcast, lookup_join
from tabloop.storage import release_shuffles, settle

BLANK = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
WORDS = 5
THRESHOLD = (80, 100)  # lines match when 100 * intersection >= 80 * union
BUCKETS = 2**18  # of the table of token use; its size never changes
OFTEN = 32  # a bucket used this many times more than the mean is frequent: at most BUCKETS / OFTEN are
AHEAD = 1  # lines just before a line that it is compared with at once
WANTED_ROWS = 2_000_000  # hashes of lines that may be copied to every task, if they take no more than 64 MB


def tokens_of(line: Column, words: int = WORDS) -> Column:
    """Distinct token hashes of a line, sorted."""
    text = F.btrim(F.lower(line), F.lit(BLANKS))
    hashes = F.transform(F.split(text, BLANK), lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - words)
        many = F.transform(starts, lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(words))))
        return F.when(F.size(h) >= words, many).otherwise(F.array(F.xxhash64(h)))

    # a one-element array lets the word hashes be used many times and made once
    made = F.element_at(F.transform(F.array(hashes), runs), 1)
    return F.when(text == "", F.array().cast("array<bigint>")).otherwise(F.sort_array(F.array_distinct(made)))


def overlap(n: Column, threshold: tuple[int, int]) -> Column:
    """Tokens that a line of n has in common with any line alike; a line alike has as many tokens at least."""
    part, whole = threshold
    return F.ceil(n * part / F.lit(float(whole)) - 1e-9).cast("int")


def first_size(n: Column, threshold: tuple[int, int]) -> Column:
    return n - overlap(n, threshold) + 1


def spare(n: Column, threshold: tuple[int, int]) -> Column:
    """Tokens of `low` behind the first ones, where frequent tokens leave gaps."""
    return F.greatest(F.lit(2), F.floor(first_size(n, threshold) / 2).cast("int"))


def extra(n: Column, threshold: tuple[int, int]) -> Column:
    """Tokens behind the first ones by which lines are found; it never falls as n grows."""
    return F.floor(spare(n, threshold) / 2).cast("int")


def listed_size(n: Column, threshold: tuple[int, int]) -> Column:
    return F.least(n, first_size(n, threshold) + extra(n, threshold))


def shared_least(n: Column, threshold: tuple[int, int]) -> Column:
    """How many of a line's listed tokens each line alike lists too; the shortest one alike has overlap(n) tokens."""
    least = overlap(n, threshold)
    return F.least(1 + F.least(extra(n, threshold), extra(least, threshold)), least)


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, h, line_no, line) of all lines, from (doc_id, text)."""
    texts = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("h"), "text")  # one hash a text, not a line
    rows = texts.select("doc_id", "h", F.posexplode(F.split("text", "\n", -1)))
    return rows.select("doc_id", "h", F.col("pos").alias("line_no"), F.col("col").alias("line"))


def _keys(line: Column) -> list[Column]:
    """96 bits that tell lines apart."""
    return [F.xxhash64(line).alias("k1"), F.hash(line).alias("k2")]


def _place() -> Column:
    return F.struct("doc_id", "h", "line_no")


def removed_lines(docs: DataFrame, threshold: tuple[int, int] = THRESHOLD, words: int = WORDS) -> DataFrame:
    """(doc_id, h, line_no) of the lines that go; `h` is the hash of the text. Takes (doc_id, text)."""
    part, whole = threshold
    some = lines_of(docs).where(F.btrim("line", F.lit(BLANKS)) != "")  # a filter on the tokens would make them twice
    made = some.select("doc_id", "h", "line_no", *_keys(F.col("line")), tokens_of(F.col("line"), words).alias("t"))
    made = made.withColumn("n", F.size("t"))
    n = F.col("n")
    low = F.slice("t", F.lit(1), F.least(n, first_size(n, threshold) + spare(n, threshold)))
    lines = settle(made.select("doc_id", "h", "line_no", "k1", "k2", "n", low.alias("low")), "lines")

    same = lines.groupBy("k1", "k2").agg(F.min(_place()).alias("first"), F.count(F.lit(1)).alias("c"))
    same = settle(same.where("c > 1").select("k1", "k2", "first"), "equal")
    marked = lookup_join(lines, same, ["k1", "k2"])
    alone = marked.where(F.col("first").isNull() | (F.col("first") == _place()))
    copies = marked.where(F.col("first") != _place()).select("doc_id", "h", "line_no")

    bucket = F.pmod(F.col("token"), F.lit(BUCKETS))
    use = alone.select(F.explode("low").alias("token")).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("c"))
    use = settle(use, "use")
    total = use.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("c")).first().c
    often = [r.bucket for r in use.where(F.col("c") > max(OFTEN * total / BUCKETS, OFTEN)).select("bucket").collect()]
    rare = F.filter("low", lambda t: ~F.pmod(t, F.lit(BUCKETS)).isin(often)) if often else F.col("low")
    listed = alone.select("k1", rare.alias("rare"), listed_size(n, threshold).alias("p"), shared_least(n, threshold).alias("least"))
    short = F.size("rare") < F.col("p")  # more of these lines' tokens are frequent than `low` can tell
    rows = listed.where(~short).select("k1", "least", F.explode(F.slice("rare", F.lit(1), F.col("p"))).alias("token"))
    if often:
        again = settle(listed.where(short).select("k1").distinct(), "short")
        if again.limit(1).count():
            whole_sets = token_sets(docs, again, words)
            in_order = F.array_sort(F.transform("t", lambda t: F.struct(F.pmod(t, F.lit(BUCKETS)).isin(often).alias("often"), t.alias("t"))))
            first = F.slice(F.transform(in_order, lambda s: s["t"]), F.lit(1), listed_size(F.size("t"), threshold))
            least = shared_least(F.size("t"), threshold).alias("least")
            rows = rows.unionByName(whole_sets.select(F.col("id").alias("k1"), least, F.explode(first).alias("token")))

    group = Window.partitionBy("token")
    shared = rows.withColumn("low_id", F.min("k1").over(group)).withColumn("high_id", F.max("k1").over(group))
    shared = shared.where("low_id <> high_id").groupBy("k1").agg(F.count(F.lit(1)).alias("c"), F.min("least").alias("least"))
    ids = settle(shared, "ids").where("c >= least").select("k1")
    release_shuffles(docs.sparkSession)  # all lines' first tokens were dealt out for these identifiers alone
    places = lookup_join(alone.select("k1", "doc_id", "h", "line_no"), ids, ["k1"], "inner")
    places = settle(places.groupBy(F.col("k1").alias("id")).agg(F.min(_place()).alias("place")), "places")
    sets = settle(token_sets(docs, ids, words), "sets")
    live = settle(firsts_by_use(sets, threshold).join(places, "id"), "live")
    release_shuffles(docs.sparkSession)

    earlier = Window.partitionBy("token").orderBy("place", "id")
    here = F.struct("id", "n", "at", "shared")
    near = [F.first(here).over(earlier), *(F.lag(here, i).over(earlier) for i in range(1, AHEAD + 1))]
    own, others = ["id", "n", "at", "shared"], ["other", "m", "bt", "also"]
    tried = live.select(*own, F.array(*near).alias("near")).select(*own, F.explode("near").alias("y"))
    tried = tried.select(*own, *(F.col(f"y.{a}").alias(b) for a, b in zip(own, others)))
    tried = tried.where(F.col("other").isNotNull() & (F.col("other") != F.col("id")) & _fits(threshold))
    tried = settle(tried.select("id", "other").distinct(), "pairs")
    found = settle(_alike(tried, sets, threshold), "matches")
    release_shuffles(docs.sparkSession)

    left = live.join(found.select("id").distinct(), "id", "left_anti").select("token", *own, "place")
    later = live.select("token", *(F.col(a).alias(b) for a, b in zip(own, others)), F.col("place").alias("before"))
    both = left.join(later, "token").where((F.col("before") < F.col("place")) & (F.col("other") != F.col("id")) & _fits(threshold))
    shared_firsts = both.groupBy("id", "other", "n", "m").agg(F.count(F.lit(1)).alias("c")).where(_enough(threshold))
    rest = settle(shared_firsts.select("id", "other").join(tried, ["id", "other"], "left_anti"), "pairs")
    release_shuffles(docs.sparkSession)
    if rest.limit(1).count():
        found = found.unionByName(_alike(rest, sets, threshold))
    gone = settle(found.select("id").distinct(), "gone")
    firsts = lookup_join(alone.select("doc_id", "h", "line_no", "k1"), gone.withColumnRenamed("id", "k1"), ["k1"], "inner")
    return copies.unionByName(firsts.select("doc_id", "h", "line_no"))


def firsts_by_use(sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """(token, id, n, at, shared): the first tokens of each line of `sets` by rarity, with their places in the line's
    order, and among those of the line's tokens that other lines hold too.

    Tokens are ordered by the number of these lines that hold them, then by hash. Tokens of one line come first in it
    and give no row; a line that shares fewer tokens than a partner must have gives none at all.
    """
    part, whole = threshold
    tokens = sets.select("id", F.size("t").alias("n"), F.explode("t").alias("token"))
    use = settle(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "use")
    hot = use.where(F.col("c") > HOT_ROWS).limit(1).count()
    marked = lookup_join(tokens, use, ["token"], "inner") if hot else tokens.join(use, "token")
    lists = marked.groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("c", "token"))).alias("s"))
    lists = lists.where(whole * F.size("s") >= part * F.col("n")).withColumn("alone", F.col("n") - F.size("s"))
    firsts = F.slice("s", F.lit(1), first_size(F.col("n"), threshold) - F.col("alone"))
    rows = lists.select("id", "n", "alone", F.posexplode(firsts).alias("i", "x"))
    return rows.select(F.col("x.token").alias("token"), "id", "n", (F.col("i") + F.col("alone")).alias("at"), F.col("i").alias("shared"))


def _fits(threshold: tuple[int, int]) -> Column:
    """Length filter, and the positional bound on the overlap when this token is at `at` and `bt`.

    Of the tokens before it only those count that other lines hold too: `shared` and `also` many.
    """
    part, whole = threshold
    n, m = F.col("n"), F.col("m")
    most = F.least("shared", "also") + 1 + F.least(n - F.col("at") - 1, m - F.col("bt") - 1)
    return (whole * F.least(n, m) >= part * F.greatest(n, m)) & ((whole + part) * most >= part * (n + m))


def _enough(threshold: tuple[int, int]) -> Column:
    """Whether `c` common tokens among the first ones leave room for the overlap.

    Of the lists of first tokens one ends no later in the order than the other; any further common token lies behind
    that end, so its line has at most n - p more of them.
    """
    part, whole = threshold
    n, m = F.col("n"), F.col("m")
    most = F.col("c") + F.greatest(n - first_size(n, threshold), m - first_size(m, threshold))
    return (whole + part) * most >= part * (n + m)


def token_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(id, t): token sets of the lines whose hash is in `wanted` (k1), from the texts."""
    lines = lines_of(docs).select(F.xxhash64("line").alias("k1"), "line")
    some = lines.join(F.broadcast(wanted) if fits_broadcast(wanted, WANTED_ROWS) else wanted, "k1")
    one = some.groupBy("k1").agg(F.first("line").alias("line"))
    return one.select(F.col("k1").alias("id"), tokens_of(F.col("line"), words).alias("t"))


def _alike(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Those pairs whose token sets reach the threshold."""
    part, whole = threshold
    named = settle(pairs.select("id").union(pairs.select("other")).distinct(), "named")
    sets = sets.join(F.broadcast(named) if fits_broadcast(named, WANTED_ROWS) else named, "id", "left_semi")
    both = pairs.join(sets, "id").join(sets.select(F.col("id").alias("other"), F.col("t").alias("u")), "other")
    shared = F.size(F.array_intersect("t", "u"))
    return both.where(whole * shared >= part * (F.size("t") + F.size("u") - shared)).select("id", "other")


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: tuple[int, int] = THRESHOLD, words: int = WORDS
) -> DataFrame:
    """All rows, the removed lines taken out of `text`; adds `n_lines` and `removed` (numbers of removed lines).

    A document all of whose lines go keeps its row with an empty text.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "removed")]
    rows = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(names)))
    name, body = f"c{names.index(doc_id)}", f"c{names.index(text)}"
    gone = removals(docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")), threshold, words)
    key = F.coalesce(F.col(name).cast("bigint"), F.lit(-(2**63)))
    rows = rows.withColumns({"key": key, "h": F.xxhash64(F.col(body).cast("string"))})
    joined = lookup_join(rows, settle(gone, "removed"), ["key", "h"])
    every = F.split(F.col(body).cast("string"), "\n", -1)
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    lines = F.when(F.col(body).isNotNull(), F.size(every)).otherwise(0)
    stays = F.filter(F.transform(every, lambda x, i: F.when(~F.array_contains(removed, i), x)), lambda x: x.isNotNull())
    text_out = F.when(F.size(removed) > 0, F.concat_ws("\n", stays)).otherwise(F.col(body).cast("string"))
    made = joined.select("*", lines.alias("n_lines"), removed.alias("_removed"), text_out.alias("_text"))
    columns = [F.col("_text" if f"c{i}" == body else f"c{i}").alias(c) for i, c in enumerate(names)]
    return made.select(*columns, "n_lines", F.col("_removed").alias("removed"))


def removals(docs: DataFrame, threshold: tuple[int, int] = THRESHOLD, words: int = WORDS) -> DataFrame:
    """(key, h, removed): sorted numbers of the removed lines of each document that loses any."""
    gone = removed_lines(docs, threshold, words).distinct()
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63))).alias("key")
    return gone.groupBy(key, "h").agg(F.sort_array(F.collect_list("line_no")).alias("removed"))
