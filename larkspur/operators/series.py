"""Daily, tag and weekly series over items joined with their enrichment.

All series are keyed by venue as well, so many of them are built side by side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larkspur.functions import times


def union_kinds(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Posts and comments as one table with their kinds set."""
    return posts.withColumn("kind", F.lit("post")).unionByName(comments.withColumn("kind", F.lit("comment")))


def first_settled(items: DataFrame, keys: list[str], stamped: Column, seen: list[str], columns: list[str]) -> DataFrame:
    """One row per key: the first seen of the stamped copies, else the first seen of all. Rows with a NULL key go.

    ``seen`` orders the deliveries. ``rn = 1`` is applied per task before the shuffle, so a key with any number of copies
    sends one row per task.
    """
    known = items
    for key in keys:
        known = known.filter(F.col(key).isNotNull())
    w = Window.partitionBy(*keys).orderBy(stamped.desc(), *[F.col(s).asc_nulls_last() for s in seen])
    return known.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select(*columns)


def joined(items: DataFrame, enriched: DataFrame) -> DataFrame:
    """``subreddit, day, kind, author, tags, vader_compound, vader_label``: items that have an enrichment record."""
    side = enriched.select("kind", "id", "tags", "vader_compound", "vader_label")
    return items.join(side, ["kind", "id"]).select("subreddit", times.day_of(F.col("created_utc")).alias("day"), "kind", "author", "tags", "vader_compound", "vader_label")


def mean4(value: Column, weight: Column | None = None) -> Column:
    """Mean (weighted) of a value of four decimals, to four decimals.

    Adds whole ten-thousandths, so the result does not depend on the order of rows and ties round alike everywhere.
    """
    units = F.round(value * 10000).cast("long")
    if weight is None:
        total, n = F.sum(units), F.count(value)
    else:
        total, n = F.sum(units * weight), F.sum(F.when(value.isNotNull(), weight))
    return F.round(total / F.nullif(n, F.lit(0))) / 10000


def median4(value: Column) -> Column:
    """Exact median of a value of four decimals, to four decimals."""
    return F.round(F.median(F.round(value * 10000).cast("long"))) / 10000


def _share(label: str) -> Column:
    return F.round(F.count_if(F.col("vader_label") == label) / F.nullif(F.count("vader_compound"), F.lit(0)), 4)


def _counts() -> list[Column]:
    return [F.count_if(F.col("kind") == "post").alias("num_posts"), F.count_if(F.col("kind") == "comment").alias("num_comments")]


def filled(daily: DataFrame, keys: list[str], day: str, zero: list[str]) -> DataFrame:
    """The series without gaps: absent days have 0 in the ``zero`` columns and NULL elsewhere.

    ``daily`` has one row per key and day. Each row is stretched to the day before the next one, so the calendar needs no
    join and the series is computed once; rows without a day are dropped.
    """
    following = F.coalesce(F.lead(day).over(Window.partitionBy(*keys).orderBy(day)), F.date_add(day, 1))
    spans = daily.filter(F.col(day).isNotNull()).withColumn("_next", following)
    days = spans.withColumn("_day", F.explode(F.sequence(F.col(day), F.date_sub("_next", 1))))
    own = F.col("_day") == F.col(day)
    rest = [c for c in daily.columns if c not in (*keys, day)]
    values = [F.when(own, F.coalesce(c, F.lit(0))).otherwise(0).alias(c) if c in zero else F.when(own, F.col(c)).alias(c) for c in rest]
    return days.select(*keys, F.col("_day").alias(day), *values)


def daily_volume(items: DataFrame) -> DataFrame:
    """``subreddit, date, num_posts, num_comments, num_unique_authors`` for every day; authors count once over both kinds."""
    days = items.select("subreddit", times.day_of(F.col("created_utc")).alias("date"), "kind", "author")
    daily = days.groupBy("subreddit", "date").agg(*_counts(), F.countDistinct("author").alias("num_unique_authors"))
    return filled(daily, ["subreddit"], "date", ["num_posts", "num_comments", "num_unique_authors"])


def daily_sentiment(rows: DataFrame) -> DataFrame:
    """The full daily series over ``joined`` rows: counts, scored items, mean, exact median and label shares."""
    c = F.col("vader_compound")
    daily = rows.groupBy("subreddit", F.col("day").alias("date")).agg(
        *_counts(), F.countDistinct("author").alias("num_unique_authors"), F.count(c).alias("num_scored"), mean4(c).alias("mean_compound"),
        median4(c).alias("median_compound"), _share("pos").alias("pct_pos"), _share("neg").alias("pct_neg"), _share("neu").alias("pct_neu"),
    )
    return filled(daily, ["subreddit"], "date", ["num_posts", "num_comments", "num_unique_authors", "num_scored"])


def tag_daily(rows: DataFrame) -> DataFrame:
    """The sparse series per venue, day and tag."""
    each = rows.select("subreddit", F.col("day").alias("date"), F.explode("tags").alias("tag"), "kind", "vader_compound", "vader_label")
    return each.groupBy("subreddit", "date", "tag").agg(
        F.count(F.lit(1)).alias("num_items"), *_counts(), mean4(F.col("vader_compound")).alias("mean_compound"), _share("pos").alias("pct_pos"), _share("neg").alias("pct_neg")
    )


def tag_weekly(daily: DataFrame, keys: list[str]) -> DataFrame:
    """Monday weeks: items, and the item-weighted mean over the days that have one."""
    mean = mean4(F.col("mean_compound"), F.col("num_items"))
    return daily.groupBy(*keys, times.week_of(F.col("date")).alias("week")).agg(F.sum("num_items").alias("items"), mean.alias("mean_compound"))


def receipt(series: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, first and last date and totals of a series, one row per key."""
    return series.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.sum("num_posts").alias("total_posts"), F.sum("num_comments").alias("total_comments")
    )


def counts_by_month(items: DataFrame) -> DataFrame:
    """``subreddit, month_label, posts, comments`` and a grand total row whose subreddit and month are NULL."""
    counts = [F.count_if(F.col("kind") == "post").alias("posts"), F.count_if(F.col("kind") == "comment").alias("comments")]
    return items.groupingSets([["subreddit", "month_label"], []], "subreddit", "month_label").agg(*counts)
