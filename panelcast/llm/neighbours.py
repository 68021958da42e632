"""The next row in descending key order, for a table of any size, by one shuffle (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a bucket that are aimed at, and buckets at most (their tops are broadcast: two longs each).
BUCKET_ROWS, BUCKETS = 512, 100_000
#: Segments that are cut at quantiles of the key; each is divided evenly into its buckets.
SEGMENTS = 128


def _segment(key: Column, cuts: list[int], low: int = 0) -> Column:
    """Number of cuts at or below the key, as a balanced tree of comparisons."""
    if not cuts:
        return F.lit(low)
    mid = len(cuts) // 2
    return F.when(key < cuts[mid], _segment(key, cuts[:mid], low)).otherwise(_segment(key, cuts[mid + 1 :], low + mid + 1))


def bucket_of(rows: DataFrame, key: str, bucket_rows: int = BUCKET_ROWS) -> Column:
    """Number of the key's bucket, rising with the key; -1 for a null key.

    Cuts lie at quantiles, so however the keys lie a segment holds its share of
    the rows (rows of one and the same key apart).
    """
    n = rows.select(key).where(F.col(key).isNotNull()).count()
    buckets = max(1, min(BUCKETS, -(-n // bucket_rows)))
    segments = min(SEGMENTS, buckets)
    per = -(-buckets // segments)
    edges = rows.approxQuantile(key, [i / segments for i in range(segments + 1)], 0.1 / segments) if n else []
    edges = sorted({int(x) for x in edges})
    if len(edges) < 2:
        return F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.lit(0)).cast("long")
    cuts = edges[1:-1]
    segment = _segment(F.col(key), cuts)
    lows = F.array(*(F.lit(x) for x in edges[:-1]))
    widths = F.array(*(F.lit((b - a) / per) for a, b in zip(edges, edges[1:])))
    inside = F.floor((F.col(key) - lows[segment]) / widths[segment])
    return F.when(F.col(key).isNull(), F.lit(-1)).otherwise(segment * per + F.least(F.greatest(inside, F.lit(0)), F.lit(per - 1))).cast("long")


def with_next(rows: DataFrame, key: str, ties: list[str], prepared: dict[str, Column], name: str = "next", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``rows`` with the ``prepared`` columns, and as struct ``name`` those of the next row.

    Order: key descending, nulls last, then ``ties``; the last row's next is the
    first. Rows go to the bucket of their key; the top rows of each bucket go as
    guests to the bucket above it too (those of the highest to the lowest), so
    every row finds its next inside its bucket. The prepared columns are made
    once, after the only shuffle of whole rows.
    """
    placed = rows.withColumn("__bucket", bucket_of(rows, key, bucket_rows))
    tops = placed.groupBy("__bucket").agg(F.max(key).alias("__top"))
    order = Window.orderBy("__bucket")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tops = tops.select(
        F.col("__bucket").alias("__from"), "__top",
        F.coalesce(F.lead("__bucket").over(order), F.min("__bucket").over(whole)).alias("__to"),
    )
    met = placed.join(
        F.broadcast(tops), (F.col("__bucket") == F.col("__from")) & F.col(key).eqNullSafe(F.col("__top")), "left"
    )
    seats = F.when(F.col("__to").isNull(), F.array(F.struct(F.col("__bucket").alias("at"), F.lit(0).alias("guest")))).otherwise(
        F.array(F.struct(F.col("__bucket").alias("at"), F.lit(0).alias("guest")), F.struct(F.col("__to").alias("at"), F.lit(1).alias("guest")))
    )
    dealt = met.select(*rows.columns, F.inline(seats).alias("__at", "__guest")).repartition("__at")
    made = dealt.select("*", *(c.alias(n) for n, c in prepared.items()))
    line = Window.partitionBy("__at").orderBy("__guest", F.desc_nulls_last(key), *ties)
    return (
        made.withColumn(name, F.lead(F.struct(*prepared)).over(line))
        .where("__guest = 0").drop("__at", "__guest")
    )
