"""Nearest-in-time lookups and series overlays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def nearest(left: DataFrame, right: DataFrame, keys: list[str], at: str, value: str, bucket: int = 30 * 86400) -> DataFrame:
    """``left`` with ``nearest_at`` and ``nearest_value``: the right row of the same keys closest in time.

    Both sides are merged into one sorted stream per key and stretch of ``bucket`` time units, so a hot key is split along
    time; the last and first right row of the neighbouring stretches are carried in from a table with one row per stretch.
    No pair is formed. Equal distances go to the earlier row; right rows with a NULL value or time are skipped; of several
    at one time the least value is taken. ``at`` is a whole number (seconds, days). Left rows with a NULL time or key, or
    without any right row, get NULLs.
    """
    stretch = F.floor(F.col("_t") / bucket).alias("_b")
    points = right.filter(F.col(value).isNotNull() & F.col(at).isNotNull()).groupBy(*keys, F.col(at).alias("_t")).agg(F.min(value).alias("_v"))
    marks = points.select(*keys, "_t", stretch, F.struct(F.col("_t").alias("t"), F.col("_v").alias("v")).alias("_p"))
    asks = left.withColumn("_row", F.struct(*left.columns)).select(*keys, F.col(at).alias("_t"), "_row").select("*", stretch)

    ends = marks.groupBy(*keys, "_b").agg(F.min("_p").alias("_lo"), F.max("_p").alias("_hi"))
    places = asks.select(*keys, "_b").distinct().join(ends, [*keys, "_b"], "full")
    up, down = Window.partitionBy(*keys).orderBy("_b"), Window.partitionBy(*keys).orderBy(F.desc("_b"))
    strictly = (Window.unboundedPreceding, -1)
    carried = places.select(
        *keys, "_b", F.last("_hi", ignorenulls=True).over(up.rowsBetween(*strictly)).alias("_from"), F.last("_lo", ignorenulls=True).over(down.rowsBetween(*strictly)).alias("_to")
    )

    stream = asks.withColumn("_side", F.lit(1)).unionByName(marks.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    part = Window.partitionBy(*keys, "_b")
    so_far = (Window.unboundedPreceding, 0)
    before = F.last("_p", ignorenulls=True).over(part.orderBy("_t", "_side").rowsBetween(*so_far))
    after = F.last("_p", ignorenulls=True).over(part.orderBy(F.desc("_t"), "_side").rowsBetween(*so_far))
    met = stream.withColumns({"_before": before, "_after": after}).filter("_side = 1").join(carried, [*keys, "_b"], "left")
    b, a = F.coalesce("_before", "_from"), F.coalesce("_after", "_to")
    closer = F.when(a.isNull() | (F.col("_t") - b["t"] <= a["t"] - F.col("_t")), b).otherwise(a)
    return met.withColumn("_n", F.when(F.col("_t").isNotNull(), closer)).select("_row.*", F.col("_n.t").alias("nearest_at"), F.col("_n.v").alias("nearest_value"))


def measured(start: Column, end: Column) -> dict[str, Column]:
    """Absolute and relative difference of a value between two instants; percent is NULL from a base of 0."""
    return {"delta": end - start, "pct": (end / F.nullif(start, F.lit(0.0)) - 1) * 100}


def overlay(series: dict[str, DataFrame], day: str = "date") -> DataFrame:
    """Named (day, value) series side by side on the days that all of them span; a day one lacks is NULL there.

    Each series has one row per day. The common span is one row.
    """
    spans, out = None, None
    for name, s in series.items():
        kept = s.filter(F.col(day).isNotNull()).select(day, F.col("value").alias(name))
        span = kept.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
        spans = span if spans is None else spans.unionByName(span)
        out = kept if out is None else out.join(kept, day, "full")
    common = spans.agg(F.max("lo").alias("lo"), F.min("hi").alias("hi"))
    return out.join(F.broadcast(common), F.col(day).between(F.col("lo"), F.col("hi"))).drop("lo", "hi")


def by_key(series: DataFrame, names: list[str]) -> DataFrame:
    """``symbol, series`` for every name; NULL where a symbol has no series."""
    wanted = series.sparkSession.createDataFrame([(n,) for n in names], "symbol string")
    return wanted.join(series.select("symbol", F.struct(*[c for c in series.columns if c != "symbol"]).alias("series")), "symbol", "left")
