"""Exact quantiles of groups of any size, by counting selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.sources.scratch import discard, stored

#: Counts of one pass for each value that is looked for.
BUCKETS = 4096


def _stretch(v: Column, low: Column, high: Column, buckets: int) -> Column:
    """Where in the range a value lies, rising with the value: its ends alone, by sign if it has both, by magnitude if it is wide, else evenly."""

    def between(at: Column, a: Column, b: Column) -> Column:
        share = F.try_divide(at - a, b - a)
        return F.when(F.coalesce(F.isnan(share), F.lit(True)), buckets // 2).otherwise(1 + F.least(F.floor(share * (buckets - 2)), F.lit(buckets - 3)))

    sign = F.when(v < 0, 1).when(v == 0, buckets // 2).otherwise(buckets - 2)
    up, down = between(F.ln(v), F.ln(low), F.ln(high)), between(-F.ln(-v), -F.ln(-low), -F.ln(-high))
    inside = F.when((low < 0) & (high > 0), sign).when((low > 0) & (high / 65536 > low), up).when((high < 0) & (low / 65536 < high), down).otherwise(between(v, low, high))
    return F.when(v == low, 0).when(v == high, buckets - 1).otherwise(inside).cast("int")


def exact_quantile(df: DataFrame, by: list[str], value: str, q: float, name: str = "quantile", buckets: int = BUCKETS) -> DataFrame:
    """(*by, name): the quantile of each group's values that aren't null, with linear interpolation, as ``percentile`` gives it.

    ``percentile`` holds all values of a group in one buffer. Here a pass counts values by ``buckets`` stretches of the range in which the wanted one
    lies, and goes on in its stretch, until that has one value: some three to seven passes. No task holds more than these counts of a
    group. Groups without values have no row; infinite values are values.
    """
    counted = stored(df.select(*by, F.col(value).cast("double").alias("__v")).filter(F.col("__v").isNotNull()).groupBy(*by, "__v").agg(F.count("*").alias("__n")))
    totals = counted.groupBy(*by).agg(F.sum("__n").alias("__total"), F.min("__v").alias("__low"), F.max("__v").alias("__high"))
    place = F.lit(q) * (F.col("__total") - 1)
    ranks = F.array_distinct(F.array(F.floor("__place").cast("long"), F.ceil("__place").cast("long")))
    wanted = totals.withColumn("__place", place).select(*by, "__place", F.explode(ranks).alias("__rank"), "__low", "__high", F.lit(0).cast("long").alias("__below"))
    rounds = [stored(wanted)]
    keys = [*by, "__place", "__rank"]
    while not (todo := rounds[-1].filter("__low < __high")).isEmpty():
        # the values that are still possible, by stretch of the range
        rows = counted.join(todo, by).filter("__v BETWEEN __low AND __high")
        stretch = _stretch(F.col("__v"), F.col("__low"), F.col("__high"), buckets)
        counts = rows.groupBy(*keys, "__below", stretch.alias("__stretch")).agg(F.sum("__n").alias("__n"), F.min("__v").alias("__low"), F.max("__v").alias("__high"))
        until = F.col("__below") + F.sum("__n").over(Window.partitionBy(*keys).orderBy("__stretch"))
        found = counts.withColumn("__until", until).filter("__rank < __until AND __rank >= __until - __n")
        narrowed = found.select(*keys, "__low", "__high", (F.col("__until") - F.col("__n")).alias("__below"))
        rounds.append(stored(narrowed.unionByName(rounds[-1].filter("__low >= __high").select(*narrowed.columns))))
    low, high = F.min_by("__low", "__rank"), F.max_by("__low", "__rank")
    rank = F.min("__rank")
    upper = F.col("__place") - F.col("__first")
    out = rounds[-1].groupBy(*by, "__place").agg(low.alias("__a"), high.alias("__b"), rank.alias("__first"))
    out = out.select(*by, F.when(F.col("__a") == F.col("__b"), F.col("__a")).otherwise((1 - upper) * F.col("__a") + upper * F.col("__b")).alias(name))
    discard(counted, *rounds[:-1])
    return out
