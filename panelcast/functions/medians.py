"""Exact medians of many columns, by group, without one task that holds a column (AGG-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.metrics import finite

#: Ranges that each column's values are cut into.
RANGES = 64


def grouped_medians(df: DataFrame, cols, group: str) -> dict:
    """Median per value of ``group`` and column (NaN and infinite values ignored): {group: {column: median or None}}.

    Values are counted per (group, column, value), pre-aggregated, and cut into
    ranges at approximate quantiles (a table of groups x columns x ranges
    numbers). The ranges' totals show which range holds the middle ranks; only
    that range is put in order.
    """
    cols = list(dict.fromkeys(cols))
    if not cols:
        return {r[0]: {} for r in df.select(group).distinct().collect()}
    wide = df.select(F.col(group).alias("_g"), *[finite(F.col(c).cast("double")).alias(c) for c in cols])
    long = wide.unpivot(["_g"], cols, "feature", "v")
    key = ["_g", "feature"]
    counted = long.groupBy(*key, "v").agg(F.count(F.lit(1)).alias("n"))
    points = [i / RANGES for i in range(1, RANGES)]
    cuts = long.groupBy(*key).agg(F.array_distinct(F.percentile_approx("v", points, 10 * RANGES)).alias("cuts"))
    # groups and columns are parameters of a run, so the cuts are few
    ranged = counted.where(F.col("v").isNotNull()).join(F.broadcast(cuts), key).select(
        *key, "v", "n", F.size(F.filter("cuts", lambda x: x <= F.col("v"))).alias("range"))
    by_column = Window.partitionBy(*key)
    totals = ranged.groupBy(*key, "range").agg(F.sum("n").alias("k")).select(
        *key, "range", (F.sum("k").over(by_column.orderBy("range")) - F.col("k")).alias("below"), "k",
        F.sum("k").over(by_column).alias("all"))
    totals = totals.withColumn("lo", F.floor((F.col("all") + 1) / 2)).withColumn("hi", F.floor(F.col("all") / 2) + 1)
    holds = [(F.col("below") < F.col(r)) & (F.col(r) <= F.col("below") + F.col("k")) for r in ("lo", "hi")]
    pick = totals.where(holds[0] | holds[1]).select(*key, "range", "below", "lo", "hi")
    inside = ranged.join(F.broadcast(pick), [*key, "range"])  # two rows per group and column at most
    last = F.col("below") + F.sum("n").over(Window.partitionBy(*key, "range").orderBy("v"))
    placed = inside.withColumn("last", last).withColumn("first", F.col("last") - F.col("n") + 1)
    found = placed.select(*key, *[
        F.when((F.col("first") <= F.col(r)) & (F.col(r) <= F.col("last")), F.col("v")).alias(r) for r in ("lo", "hi")
    ]).groupBy(*key).agg(((F.max("lo") + F.max("hi")) / 2).alias("median"))
    # a column without values keeps its row
    out: dict = {}
    for r in cuts.select(*key).join(found, key, "left").collect():
        out.setdefault(r["_g"], {})[r["feature"]] = r["median"]
    return out


def exact_medians(df: DataFrame, cols) -> dict:
    """Median per column (NaN and infinite values ignored); None for a column without values."""
    cols = list(dict.fromkeys(cols))
    if not cols:
        return {}
    got = grouped_medians(df.select(F.lit(0).alias("_one"), *cols), cols, "_one").get(0, {})
    return {c: got.get(c) for c in cols}
