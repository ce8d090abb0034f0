"""Agreement between two raters, per-tag scores and label checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LEVELS = [-2, -1, 0, 1, 2]


def last_score(scores: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key: the last of its scores."""
    rest = [c for c in scores.columns if c not in (key, order)]
    best = F.max_by(F.struct(*rest), F.struct(F.col(order), *rest))
    return scores.filter(F.col(key).isNotNull()).groupBy(key).agg(best.alias("_b")).select(key, *[F.col("_b")[c].alias(c) for c in rest])


def agreement(pairs: DataFrame) -> DataFrame:
    """``n, exact, within_one`` of (gold, scored) pairs; rows with a NULL side are left out."""
    gap = F.abs(F.col("gold") - F.col("scored"))
    return pairs.filter(gap.isNotNull()).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg((gap == 0).cast("int")), 6).alias("exact"), F.round(F.avg((gap <= 1).cast("int")), 6).alias("within_one"))


def confusion(pairs: DataFrame, levels: list[int] = LEVELS) -> DataFrame:
    """``gold, scored, n`` for all pairs of levels, 0 where none occurs."""
    grid = pairs.sparkSession.createDataFrame([(g, s) for g in levels for s in levels], "gold int, scored int")
    counts = pairs.groupBy(F.col("gold").cast("int").alias("gold"), F.col("scored").cast("int").alias("scored")).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(counts, ["gold", "scored"], "left").select("gold", "scored", F.coalesce("n", F.lit(0)).alias("n"))


def kappa(pairs: DataFrame) -> DataFrame:
    """``kappa``, weighted by squared distance; 1 where chance leaves no disagreement.

    The expected part needs the raters' moments only: the mean of (g - s)^2 over independent draws is
    E g^2 - 2 E g E s + E s^2, so no table of marginals is formed.
    """
    g, s = F.col("gold").cast("double"), F.col("scored").cast("double")
    moments = pairs.filter(g.isNotNull() & s.isNotNull()).agg(F.avg((g - s) * (g - s)).alias("seen"), (F.avg(g * g) - 2 * F.avg(g) * F.avg(s) + F.avg(s * s)).alias("chance"))
    return moments.select(F.round(F.when(F.abs("chance") < 1e-12, 1.0).otherwise(1 - F.col("seen") / F.nullif(F.col("chance"), F.lit(0.0))), 6).alias("kappa"))


def tag_scores(pairs: DataFrame) -> DataFrame:
    """``tag, tp, fp, fn, precision, recall, f1`` for every tag of ``gold_tags``; 0 where undefined."""
    sides = lambda c: F.array_distinct(F.array_compact(F.coalesce(c, F.array().cast("array<string>"))))
    both = F.array_distinct(F.concat(sides("gold_tags"), sides("scored_tags")))
    each = pairs.select(F.explode(both).alias("tag"), "gold_tags", "scored_tags")
    gold, scored = (F.coalesce(F.array_contains(c, F.col("tag")), F.lit(False)) for c in ("gold_tags", "scored_tags"))
    counts = each.groupBy("tag").agg(F.count_if(gold & scored).alias("tp"), F.count_if(~gold & scored).alias("fp"), F.count_if(gold & ~scored).alias("fn")).filter("tp + fn > 0")
    precision = F.coalesce(F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0)), F.lit(0.0))
    recall = F.coalesce(F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0)), F.lit(0.0))
    f1 = F.coalesce(2 * F.col("tp") / F.nullif(2 * F.col("tp") + F.col("fp") + F.col("fn"), F.lit(0)), F.lit(0.0))
    return counts.select("tag", "tp", "fp", "fn", F.round(precision, 6).alias("precision"), F.round(recall, 6).alias("recall"), F.round(f1, 6).alias("f1"))


def label_problems(keys: list[str], levels: list[int] = LEVELS, confidences: tuple[str, ...] = ("high", "medium", "low")) -> Column:
    """``array<string>`` of what is wrong with a label row (``tags, overall_sentiment, no_sentiment, tag_sentiment,
    confidence, rationale``); empty if nothing is. An absent field ends the check."""
    fields = ["tags", "overall_sentiment", "no_sentiment", "tag_sentiment", "confidence", "rationale"]
    absent = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in sorted(fields)]))
    known, scale = F.array(*map(F.lit, keys)).cast("array<string>"), F.array(*map(F.lit, levels))
    unknown = F.array_except("tags", known)
    stray = F.array_except(F.map_keys("tag_sentiment"), "tags")
    off_scale = F.map_filter("tag_sentiment", lambda _, v: ~F.coalesce(F.array_contains(scale, v), F.lit(False)))
    checks = [
        (F.size(unknown) > 0, F.concat(F.lit("unknown tags: "), F.array_join(F.array_sort(unknown), ", "))),
        (F.size("tags") == 0, F.lit("no tags")),
        (~F.col("overall_sentiment").isin(levels), F.concat(F.lit("overall_sentiment off the scale: "), F.col("overall_sentiment").cast("string"))),
        (F.col("no_sentiment") & (F.col("overall_sentiment") != 0), F.lit("no_sentiment with a sentiment")),
        (F.size(stray) > 0, F.concat(F.lit("tag_sentiment of other tags: "), F.array_join(F.array_sort(stray), ", "))),
        (F.size(off_scale) > 0, F.concat(F.lit("tag_sentiment off the scale: "), F.array_join(F.array_sort(F.map_keys(off_scale)), ", "))),
        (~F.col("confidence").isin(*confidences), F.concat(F.lit("confidence: "), F.col("confidence"))),
        (F.trim("rationale") == "", F.lit("empty rationale")),
    ]
    found = F.array_compact(F.array(*[F.when(c, m) for c, m in checks]))
    return F.when(F.size(absent) > 0, F.array(F.concat(F.lit("missing: "), F.array_join(absent, ", ")))).otherwise(found)


def histogram(rows: DataFrame, fields: list[str]) -> DataFrame:
    """``field_name, value, n``: how often each value of each field occurs, in one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("value")) for f in fields])).alias("p")
    return rows.select(pairs).groupBy("p.field_name", "p.value").agg(F.count(F.lit(1)).alias("n"))


def element_counts(rows: DataFrame, field: str) -> DataFrame:
    """``element, n``: in how many rows an element of an array column occurs, repeats within a row counted once."""
    return rows.select(F.explode(F.array_distinct(F.array_compact(field))).alias("element")).groupBy("element").agg(F.count(F.lit(1)).alias("n"))


def misses(scored: DataFrame, compound: str, label: Column, gold: Column) -> DataFrame:
    """Rows whose label is not the gold one, with both, in order of ``compound``; rows without either are no misses."""
    return scored.withColumns({"label": label, "gold_label": gold}).filter(F.col("label") != F.col("gold_label")).orderBy(compound)
