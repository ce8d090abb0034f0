"""Trailing baselines, the activity and sentiment gauge, period changes and the closest past stretch.

Input is a dense series per venue (``date`` and values, one row per calendar day). Everything is window functions over
one partitioning by venue, so a venue is at most one row per day in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larkspur.functions.text import band
from larkspur.operators.series import mean4

# Lengths in days and limits of the gauge.
SHORT, BASELINE, LEAST_POINTS, PARTIAL, LIMIT = 7, 365, 60, 2, 3.0
STRETCH, GAP = 30, 60
PERIODS = {"week": 7, "month": 30, "quarter": 91, "year": 365}
TAG_BASELINE, TAG_TAIL = 90, 180


def _order(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("date")


def window_mean(value: Column, keys: list[str], size: int = SHORT) -> Column:
    """Mean of the non-null values among the last ``size`` rows, to 12 places so that equal windows have equal means; NULL
    while there are fewer rows, or no value."""
    w = _order(keys)
    return F.when(F.row_number().over(w) >= size, F.round(F.avg(value).over(w.rowsBetween(1 - size, 0)), 12))


def _trailing(frame: DataFrame, keys: list[str], names: list[str], size: int) -> DataFrame:
    """Adds ``_n_, _s_, _q_, _lo_, _hi_`` of each named column over the last ``size`` rows: count, sum, sum of squares,
    least and greatest of its non-null values, by binary doubling (a row costs the logarithm of the window)."""
    w, top = _order(keys), size.bit_length() - 1

    def shifted(column: str, by: int) -> Column:
        return F.lag(column, by).over(w) if by else F.col(column)

    out = frame
    for x in names:
        m = F.col(x)
        out = out.withColumns({f"_n_{x}_0": m.isNotNull().cast("int"), f"_s_{x}_0": F.coalesce(m, F.lit(0.0)), f"_q_{x}_0": F.coalesce(m * m, F.lit(0.0)), f"_lo_{x}_0": m, f"_hi_{x}_0": m})
    for k in range(top):
        step = {}
        for x in names:
            for a in "nsq":
                step[f"_{a}_{x}_{k + 1}"] = F.col(f"_{a}_{x}_{k}") + F.coalesce(shifted(f"_{a}_{x}_{k}", 1 << k), F.lit(0))
            step[f"_lo_{x}_{k + 1}"] = F.least(f"_lo_{x}_{k}", shifted(f"_lo_{x}_{k}", 1 << k))
            step[f"_hi_{x}_{k + 1}"] = F.greatest(f"_hi_{x}_{k}", shifted(f"_hi_{x}_{k}", 1 << k))
        out = out.withColumns(step)
    last = {}
    for x in names:
        for a in "nsq":
            offset, parts = 0, []
            for k in reversed(range(top + 1)):
                if size >> k & 1:
                    parts.append(F.coalesce(shifted(f"_{a}_{x}_{k}", offset), F.lit(0)))
                    offset += 1 << k
            last[f"_{a}_{x}"] = sum(parts[1:], parts[0])
        rest = size - (1 << top)
        last[f"_lo_{x}"] = F.least(f"_lo_{x}_{top}", shifted(f"_lo_{x}_{top}", rest)) if rest else F.col(f"_lo_{x}_{top}")
        last[f"_hi_{x}"] = F.greatest(f"_hi_{x}_{top}", shifted(f"_hi_{x}_{top}", rest)) if rest else F.col(f"_hi_{x}_{top}")
    return out.withColumns(last).drop(*[f"_{a}_{x}_{k}" for x in names for a in ("n", "s", "q", "lo", "hi") for k in range(top + 1)])


def _zscore(m: Column, n: Column, s: Column, q: Column, lo: Column, hi: Column) -> Column:
    """z of ``m`` against a baseline given by its moments: NULL below 60 points, 0 where it does not vary."""
    spread = F.sqrt(F.greatest(q / n - (s / n) * (s / n), F.lit(0.0)))
    return F.when(m.isNotNull() & (n >= LEAST_POINTS), F.when(lo == hi, 0.0).otherwise(F.coalesce((m - s / n) / F.nullif(spread, F.lit(0.0)), F.lit(0.0))))


def with_zscores(series: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """Adds ``{name}_7d`` and ``{name}_z``: the short mean, and its z-score among those of the last 365 rows.

    NULL below 60 baseline points, 0 where the baseline does not vary. The row itself is part of its baseline.
    """
    names = [f"{n}_7d" for n in values]
    out = _trailing(series.withColumns({f"{n}_7d": window_mean(v, keys) for n, v in values.items()}), keys, names, BASELINE)
    scores = {f"{n}_z": _zscore(*[F.col(f"{a}{n}_7d") for a in ("", "_n_", "_s_", "_q_", "_lo_", "_hi_")]) for n in values}
    return out.withColumns(scores).drop(*[f"_{a}_{x}" for x in names for a in ("n", "s", "q", "lo", "hi")])


def _latest_zscore(mean: str) -> Column:
    """The z-score at ``asof`` as an aggregate over a venue's rows up to it."""
    m = F.col(mean)
    near = F.when(F.col("date") > F.date_sub("asof", BASELINE), m)
    now = F.max(F.when(F.col("date") == F.col("asof"), m))
    return _zscore(now, F.count(near), F.sum(near), F.sum(near * near), F.min(near), F.max(near))


def standing(series: DataFrame, keys: list[str]) -> DataFrame:
    """The series with volume and sentiment z-scores and ``asof``: the last day but the two that are still filling."""
    items = (F.col("num_posts") + F.col("num_comments")).alias("items")
    base = series.select(*keys, "date", items, "mean_compound", F.date_sub(F.max("date").over(Window.partitionBy(*keys)), PARTIAL).alias("asof"))
    return with_zscores(base.filter("date <= asof"), keys, {"volume": F.log1p("items"), "sentiment": F.col("mean_compound")})


def clamp(x: Column, limit: float = LIMIT) -> Column:
    return F.greatest(F.lit(-limit), F.least(F.lit(limit), x))


def gauge(series: DataFrame, keys: list[str]) -> DataFrame:
    """One row per venue: value, its parts, band, 7-day volume, all-time percentile and 7-day sentiment as of ``asof``.

    Venues without both z-scores have no row.
    """
    asof = F.date_sub(F.max("date").over(Window.partitionBy(*keys)), PARTIAL)
    base = series.select(*keys, "date", (F.col("num_posts") + F.col("num_comments")).alias("items"), "mean_compound", asof.alias("asof")).filter("date <= asof")
    means = base.withColumns({"volume_7d": window_mean(F.log1p("items"), keys), "sentiment_7d": window_mean(F.col("mean_compound"), keys)})
    at = F.col("date") == F.col("asof")
    now = F.max(F.when(at, F.col("volume_7d"))).over(Window.partitionBy(*keys))
    ranked = means.withColumn("_at_most", (F.col("volume_7d") <= now).cast("double"))
    week = F.when(F.col("date") > F.date_sub("asof", SHORT), F.col("items"))
    latest = ranked.groupBy(*keys, "asof").agg(
        _latest_zscore("volume_7d").alias("vz"), _latest_zscore("sentiment_7d").alias("sz"), F.avg(week).alias("vol"), F.avg("_at_most").alias("pct"), F.max(F.when(at, F.col("sentiment_7d"))).alias("sent")
    )
    value = clamp((F.col("vz") + F.col("sz")) / 2)
    return latest.filter("vz IS NOT NULL AND sz IS NOT NULL").select(
        *keys, F.round(value, 2).alias("value"), F.round("vz", 2).alias("volume_z"), F.round("sz", 2).alias("sentiment_z"), band(value).alias("band"),
        F.round("vol", 1).alias("vol_7d"), F.round("pct", 3).alias("vol_pctile_alltime"), F.round("sent", 4).alias("sent_7d"), "asof",
    )


def volume_changes(series: DataFrame, keys: list[str]) -> DataFrame:
    """Mean daily items of each period up to ``asof`` against the period before; periods without 2 full lengths are out."""
    asof = F.date_sub(F.max("date").over(Window.partitionBy(*keys)), PARTIAL)
    back = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("date")))
    dated = series.select(*keys, "date", (F.col("num_posts") + F.col("num_comments")).alias("items"), asof.alias("asof")).filter("date <= asof").withColumn("_back", back)
    rows = []
    for days in PERIODS.values():
        rows += [F.sum(F.when(F.col("_back") <= days, F.col("items"))).alias(f"_c{days}"), F.sum(F.when(F.col("_back").between(days + 1, 2 * days), F.col("items"))).alias(f"_p{days}")]
    sums = dated.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *rows)
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("period"), F.lit(d).alias("days"), F.col(f"_c{d}").alias("c"), F.col(f"_p{d}").alias("p")) for n, d in PERIODS.items()])).alias("x")
    current, previous = F.col("x.c") / F.col("x.days"), F.col("x.p") / F.col("x.days")
    return sums.select(*keys, "_n", each).filter("_n >= 2 * x.days").select(
        *keys, "x.period", F.round(current, 1).alias("current"), F.round(previous, 1).alias("previous"), F.round(current / F.nullif(previous, F.lit(0.0)) - 1, 3).alias("delta")
    )


def analog(series: DataFrame, keys: list[str]) -> DataFrame:
    """The past stretch of 30 days whose z-scores are closest to the latest one's, at least 60 days back.

    ``start, end, band, similarity`` per venue; the earliest of equally close stretches. A venue's latest vector
    is handed to its other rows by a window, so each past day meets one row.
    """
    w = _order(keys).rowsBetween(1 - STRETCH, 0)
    stretch = standing(series, keys).select(
        *keys, "date", "asof", F.collect_list("volume_z").over(w).alias("v"), F.collect_list("sentiment_z").over(w).alias("s"),
        F.min("date").over(w).alias("start"), clamp((F.col("volume_z") + F.col("sentiment_z")) / 2).alias("value"),
    ).filter((F.size("v") == STRETCH) & (F.size("s") == STRETCH))
    now = F.max(F.when(F.col("date") == F.col("asof"), F.concat("v", "s"))).over(Window.partitionBy(*keys))
    past = stretch.withColumn("now", now).filter((F.col("date") <= F.date_sub("asof", GAP)) & F.col("now").isNotNull())
    gaps = F.zip_with(F.concat("v", "s"), "now", lambda a, b: (a - b) * (a - b))
    distance = F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda a, b: a + b) / (2 * STRETCH))
    best = past.withColumn("distance", distance).groupBy(*keys).agg(F.min(F.struct(F.round("distance", 12).alias("d"), "date", "start", "value", "distance")).alias("b"))
    return best.select(*keys, F.col("b.start").alias("start"), F.col("b.date").alias("end"), band(F.col("b.value")).alias("band"), F.round(1 / (1 + F.col("b.distance")), 3).alias("similarity"))


def tag_summary(daily: DataFrame, keys: list[str]) -> DataFrame:
    """Per venue and tag: items of 7 days, change against the mean of 90 days, weighted sentiment and dense volume z.

    ``asof`` is the venue's last tag day less the partial ones; tags without a day up to it have zeros and NULLs. ``daily``
    is read three times: pass a stored table.
    """
    asof = F.date_sub(F.max("date").over(Window.partitionBy(*keys)), PARTIAL)
    dated = daily.withColumn("asof", asof)
    n, mean, full = F.col("num_items"), F.col("mean_compound"), F.col("date") <= F.col("asof")
    recent = full & (F.col("date") > F.date_sub("asof", SHORT))
    base = full & (F.col("date") > F.date_sub("asof", TAG_BASELINE))
    sums = dated.groupBy(*keys, "tag", "asof").agg(
        F.sum(F.when(recent, n).otherwise(0)).alias("items_7d"), F.sum(F.when(base, n).otherwise(0)).alias("_base"),
        mean4(F.when(recent, mean), n).alias("sent_7d"), F.min("date").alias("first_date"),
    )
    own = [*keys, "tag"]
    bounds = dated.filter(full).groupBy(*own, "asof").agg(F.min("date").alias("_lo"))
    # The z-score reads the last 365 short means, so no day before them (and their own 7 days) is filled in.
    first = F.greatest("_lo", F.date_sub("asof", BASELINE + SHORT))
    days = bounds.select(*own, "asof", "_lo", F.explode(F.sequence(first, "asof")).alias("date"))
    dense = days.join(dated.filter(full).select(*own, "date", "num_items"), [*own, "date"], "left").select(*own, "asof", "_lo", "date", F.log1p(F.coalesce("num_items", F.lit(0))).alias("x"))
    means = dense.withColumn("x_7d", window_mean(F.col("x"), own)).filter(F.col("date") >= F.date_add("_lo", SHORT - 1))
    scores = means.groupBy(*own, "asof").agg(F.round(_latest_zscore("x_7d"), 2).alias("volume_z")).drop("asof")
    delta = (F.col("items_7d") / SHORT) / F.nullif(F.col("_base") / TAG_BASELINE, F.lit(0.0)) - 1
    return sums.join(scores, own, "left").select(*own, "asof", "items_7d", F.round(delta, 3).alias("delta_vs_90d"), "sent_7d", "volume_z", "first_date")


def rebased(series: DataFrame, keys: list[str], value: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """``indexed``: the value as percent of that on the first day in range; NULL where that is 0 or NULL."""
    kept = series.filter((F.lit(True) if first is None else F.col("date") >= F.lit(first).cast("date")) & (F.lit(True) if last is None else F.col("date") <= F.lit(last).cast("date")))
    base = F.first(value).over(_order(keys).rowsBetween(Window.unboundedPreceding, 0))
    return kept.withColumn("indexed", 100 * F.col(value) / F.nullif(base, F.lit(0).cast("double")))


def last_change(series: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Each row with the one before it: ``previous``, ``change`` and ``change_pct``."""
    before = F.lag(value).over(_order(keys))
    out = series.withColumn("previous", before)
    return out.withColumns({"change": F.col(value) - F.col("previous"), "change_pct": F.col(value) / F.nullif(F.col("previous"), F.lit(0.0)) - 1})
