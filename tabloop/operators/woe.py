"""Weight of evidence of categories and of quantile bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloop.functions.numbers import truncate
from tabloop.operators.ranks import exact_quantiles
from tabloop.operators.skew import lookup_join
from tabloop.storage import settle

SMOOTH = 0.5  # added to every count and total when a bin lacks one of the two classes


def fit_cuts(df: DataFrame, cols: Sequence[str], bins: int = 5) -> dict[str, list[float]]:
    """Inner quantile boundaries of each column, without repeats."""
    probs = [i / bins for i in range(1, bins)]
    cuts = exact_quantiles(df, {c: F.col(c).cast("double") for c in cols}, probs)
    return {c: sorted({v for v in values if v is not None}) for c, values in cuts.items()}


def bin_number(col: str, cuts: Sequence[float]) -> Column:
    """How many boundaries lie below the value; null stays null."""
    x = F.col(col).cast("double")
    number = F.lit(0)
    for i, cut in enumerate(cuts):
        number = F.when(x > F.lit(cut), F.lit(i + 1)).otherwise(number)
    return F.when(x.isNotNull(), number).cast("string")


def fit_woe(
    df: DataFrame, cat_cols: Sequence[str], num_cols: Sequence[str] = (), label: str = "label", bins: int = 5
) -> DataFrame:
    """(col, bin, upper, events, nonevents, woe, iv) for every category and quantile bin.

    woe = ln(share of non-events / share of events); `upper` is the upper boundary of a numeric bin.
    """
    cuts = fit_cuts(df, num_cols, bins) if num_cols else {}
    y = F.col(label).cast("bigint")
    binned = df.select(
        y.alias("_y"),
        *[F.col(c).cast("string").alias(c) for c in cat_cols],
        *[bin_number(c, cuts[c]).alias(c) for c in num_cols],
    )
    cols = [*cat_cols, *num_cols]
    cells = binned.unpivot(["_y"], cols, "col", "bin").where(F.col("bin").isNotNull() & F.col("_y").isNotNull())
    table = settle(
        cells.groupBy("col", "bin").agg(
            F.sum("_y").alias("events"), F.sum(F.lit(1) - F.col("_y")).cast("bigint").alias("nonevents")
        )
    )
    totals = {
        r.col: (r.e, r.n)
        for r in table.groupBy("col").agg(F.sum("events").alias("e"), F.sum("nonevents").alias("n")).collect()
    }
    if not totals:
        return table.select("col", "bin", F.lit(None).cast("double").alias("upper"), "events", "nonevents").withColumns(
            {"woe": F.lit(None).cast("double"), "iv": F.lit(None).cast("double")}
        )
    pairs = [(F.lit(c), F.lit(float(e)), F.lit(float(n))) for c, (e, n) in totals.items()]
    all_events = F.create_map(*[x for c, e, _ in pairs for x in (c, e)])[F.col("col")]
    all_nonevents = F.create_map(*[x for c, _, n in pairs for x in (c, n)])[F.col("col")]
    lacking = (F.col("events") == 0) | (F.col("nonevents") == 0)
    add = F.when(lacking, F.lit(SMOOTH)).otherwise(F.lit(0.0))
    event_share = (F.col("events") + add) / (all_events + add)
    nonevent_share = (F.col("nonevents") + add) / (all_nonevents + add)
    woe = F.ln(nonevent_share / event_share)
    bounds = [x for c, values in cuts.items() for i, v in enumerate(values) for x in (F.lit(f"{c}:{i}"), F.lit(v))]
    upper = (
        F.element_at(F.create_map(*bounds), F.concat_ws(":", "col", "bin")) if bounds else F.lit(None).cast("double")
    )
    return settle(
        table.select(
            "col", "bin", upper.alias("upper"), "events", "nonevents",
            woe.alias("woe"), ((nonevent_share - event_share) * woe).alias("iv"),
        )
    )


def apply_woe(
    df: DataFrame,
    stats: DataFrame,
    cat_cols: Sequence[str] = (),
    num_cols: Sequence[str] = (),
    missing: float = 0.0,
    literal_limit: int = 64,
) -> DataFrame:
    """Replace values by the weight of evidence of their bin, cut to 8 decimals; unseen or missing: `missing`."""
    order = df.columns
    sizes = {r.col: r["count"] for r in stats.groupBy("col").count().collect()}
    for c in [*num_cols, *cat_cols]:
        fitted = stats.where(F.col("col") == c)
        numeric = c in num_cols
        if numeric or sizes.get(c, 0) <= literal_limit:
            rows = fitted.collect()  # numeric bins are few by construction, categories checked above
            key = bin_number(c, sorted(r.upper for r in rows if r.upper is not None)) if numeric else F.col(c).cast("string")
            pairs = [x for r in rows for x in (F.lit(r.bin), F.lit(r.woe))]
            woe = F.element_at(F.create_map(*pairs), key) if pairs else F.lit(None).cast("double")
            df = df.withColumn(c, truncate(F.coalesce(woe, F.lit(float(missing)))))
        else:
            side = fitted.select(F.col("bin").alias("_bin"), F.col("woe").alias("_woe"))
            df = lookup_join(df.withColumn("_bin", F.col(c).cast("string")), side, ["_bin"])
            df = df.withColumn(c, truncate(F.coalesce("_woe", F.lit(float(missing))))).drop("_bin", "_woe")
    return df.select(*order)


def woe_pipeline(df: DataFrame, features: Sequence[str], num_cols: Sequence[str], label: str = "label", bins: int = 5):
    """Select the features and fit their encoding; returns a function for further tables and the fitted table."""
    cats = [c for c in features if c not in num_cols]
    stats = fit_woe(df, cats, num_cols, label, bins)

    def transform(other: DataFrame) -> DataFrame:
        absent = [c for c in features if c not in other.columns]
        if absent:
            raise ValueError(f"missing feature columns: {absent}")
        return apply_woe(other, stats, cats, num_cols)

    return transform, stats
