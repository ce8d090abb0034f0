"""Trailing totals over calendar days by binary doubling.

Totals of 2, 4, 8, ... days come from adding a block to itself shifted by its own length; any window is then the sum of
shifted blocks along its binary digits (30 = 16 + 8 + 4 + 2). Work per day is the logarithm of the window, and all
shifts share one partitioning and one sort. Groups are at most one row per calendar day, whatever the number of records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def densify(df: DataFrame, entity: list[str], day: str, values: list[str]) -> DataFrame:
    """One row per entity and calendar day from its first to its last; days without a row get 0 in every value.

    ``df`` has at most one row per entity and day. NULL values become 0; rows without a day or an entity are dropped.
    """
    w = Window.partitionBy(*entity).orderBy(day)
    known = df
    for c in (*entity, day):
        known = known.filter(F.col(c).isNotNull())
    following = F.coalesce(F.lead(day).over(w), F.date_add(day, 1))
    spans = known.select(*entity, day, *values, following.alias("_next"), F.min(day).over(Window.partitionBy(*entity)).alias("first_day"))
    days = spans.select(*entity, "first_day", F.col(day).alias("_from"), *values, F.explode(F.sequence(F.col(day), F.date_sub("_next", 1))).alias("_day"))
    fill = [F.when(F.col("_day") == F.col("_from"), F.coalesce(F.col(v), F.lit(0))).otherwise(F.lit(0)).alias(v) for v in values]
    return days.select(*entity, "first_day", F.col("_day").alias(day), *fill)


def trailing_totals(df: DataFrame, entity: list[str], day: str, values: list[str], windows: list[int]) -> DataFrame:
    """Adds ``{value}_{w}d``, the total over the ``w`` calendar days ending on each day, for dense rows of ``densify``.

    Days before an entity's first one count as 0, so a window that reaches back further is the total since the start.
    """
    w = Window.partitionBy(*entity).orderBy(day)

    def shifted(column: str, by: int) -> Column:
        return F.col(column) if by == 0 else F.coalesce(F.lag(column, by).over(w), F.lit(0))

    top = max(windows).bit_length() - 1
    out = df.withColumns({f"_{v}_0": F.col(v) for v in values})
    for k in range(top):
        out = out.withColumns({f"_{v}_{k + 1}": F.col(f"_{v}_{k}") + shifted(f"_{v}_{k}", 1 << k) for v in values})
    totals = {}
    for size in windows:
        for v in values:
            offset, parts = 0, []
            for k in reversed(range(top + 1)):
                if size >> k & 1:
                    parts.append(shifted(f"_{v}_{k}", offset))
                    offset += 1 << k
            totals[f"{v}_{size}d"] = sum(parts[1:], parts[0])
    return out.withColumns(totals).drop(*[f"_{v}_{k}" for v in values for k in range(top + 1)])


def latest_edition(df: DataFrame, entity: list[str], day: str, edition: str, values: list[str]) -> DataFrame:
    """One row per entity and day: that of the latest ``edition``; ties go to the greater values, NULL lowest."""
    best = F.max(F.struct(F.col(edition), *values)).alias("_b")
    return df.groupBy(*entity, day).agg(best).select(*entity, day, *[F.col("_b")[v].alias(v) for v in values])
