"""Places of rows in a total order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.files import written


def ranked(rows: DataFrame, order: list[str | Column], group: list[str] | None = None, place: str = "place", parts: int | None = None) -> DataFrame:
    """``rows`` with their place, from 0, in the order of ``order`` within their ``group``.

    Rows are dealt out by ranges, whose bounds are sampled, and sorted in them;
    then only the number of rows of each range and group has to be summed up. Nulls
    come first, also as groups. Rows of equal order are placed by chance, and all
    in one range, so add a column that tells them apart where they may be many.
    ``parts`` is the number of ranges, by default the session's.
    """
    group = group or []
    keys = [F.col(g).asc_nulls_first() for g in group] + [(F.col(c) if isinstance(c, str) else c).asc_nulls_first() for c in order]
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    # the upper bits are the range, the lower ones the place in it
    dealt = written(dealt.withColumn("_at", F.monotonically_increasing_id()), "ranged")
    names = [f"_g{i}" for i in range(len(group))]
    at = F.shiftright("_at", 33)
    runs = dealt.groupBy(at.alias("_range"), *[F.col(g).alias(n) for g, n in zip(group, names, strict=True)]).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*names).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(runs.select(*names, "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")), "ranges")
    same = at == F.col("_range")
    for g, n in zip(group, names, strict=True):
        same &= F.col(g).eqNullSafe(F.col(n))
    return dealt.join(starts, same).withColumn(place, F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift", *names)


def medians(rows: DataFrame, keys: list[str], value: str, parts: int | None = None) -> DataFrame:
    """``keys, middle, upper_middle, n``: exact medians of a column of numbers; the mean of two middles, and the higher.

    Equal values of a group are counted first. Different ones are dealt out by
    ranges of group and value, so a group of any size is held by no task; counts
    summed up within ranges and over them tell which values stand in the middle.
    Nulls don't count; a group of nulls has no row.
    """
    spark, order = rows.sparkSession, [F.col(k).asc_nulls_first() for k in keys] + [F.col(value).asc()]
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    dealt = counts.repartitionByRange(parts or int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    dealt = written(dealt.withColumn("_range", F.shiftright(F.monotonically_increasing_id(), 33)), "values")
    names = [f"_g{i}" for i in range(len(keys))]
    sums = dealt.groupBy("_range", *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).agg(F.sum("_n").alias("_m"))
    before = Window.partitionBy(*names).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(sums.select(*names, F.col("_range").alias("_r"), F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_start"), F.sum("_m").over(Window.partitionBy(*names)).alias("n")), "ranges")
    same = F.col("_range") == F.col("_r")
    for k, n in zip(keys, names, strict=True):
        same &= F.col(k).eqNullSafe(F.col(n))
    upto = F.sum("_n").over(Window.partitionBy("_range", *keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    placed = dealt.withColumn("_upto", upto).join(starts, same)
    last = F.col("_start") + F.col("_upto")
    holds = lambda i: (last - F.col("_n") <= i) & (i < last)
    low, high = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
    middles = placed.filter(holds(low) | holds(high)).groupBy(*keys).agg(F.min(value).alias("_low"), F.max(value).alias("upper_middle"), F.first("n").alias("n"))
    return middles.select(*keys, ((F.col("_low") + F.col("upper_middle")) / 2).alias("middle"), "upper_middle", "n")
