"""The collection layer: partitions of raw objects, fingerprints, receipts and settlement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions import times

# Object keys of the raw layer, and the limits of the reconcile sweep.
RAW_KEY = r"^raw/([^/]+)/([0-9]{4}-(?:0[1-9]|1[0-2]))/(posts|comments)-(?:recent-([0-9]{8}T[0-9]{2})-)?part-([0-9]{4,})\.jsonl\.gz$"
RECEIPT_KEY = r"^receipts/([^/]+)/([0-9]{4}-(?:0[1-9]|1[0-2]))-(posts|comments)\.json$"
LEGACY_MARGIN, MOST_FILL_MONTHS, GIVE_UP_HOURS = 30 * 86400, 24, 720


def parsed_keys(objects: DataFrame, key: str = "object_key", pattern: str = RAW_KEY) -> DataFrame:
    """Objects of the raw layer with ``subreddit, month_label, kind, hour_stamp, part``; any other key is left out."""
    at = lambda i: F.regexp_extract(key, pattern, i)
    hit = objects.filter(F.col(key).rlike(pattern))
    return hit.withColumns({"subreddit": at(1), "month_label": at(2), "kind": at(3), "hour_stamp": F.nullif(at(4), F.lit("")), "part": at(5).cast("int")})


def receipt_keys(objects: DataFrame, key: str = "object_key") -> DataFrame:
    """``subreddit, month_label, kind`` of well-formed receipt names; month 13 and other names are left out."""
    at = lambda i: F.regexp_extract(key, RECEIPT_KEY, i)
    return objects.filter(F.col(key).rlike(RECEIPT_KEY)).select(at(1).alias("subreddit"), at(2).alias("month_label"), at(3).alias("kind"))


def backfill_key(subreddit: Column, month: Column, kind: Column, part: Column) -> Column:
    return F.concat(F.lit("raw/"), F.lower(subreddit), F.lit("/"), month, F.lit("/"), kind, F.lit("-part-"), F.lpad(part.cast("string"), 4, "0"), F.lit(".jsonl.gz"))


def recent_key(subreddit: Column, month: Column, kind: Column, stamp: Column, part: Column) -> Column:
    return F.concat(F.lit("raw/"), F.lower(subreddit), F.lit("/"), month, F.lit("/"), kind, F.lit("-recent-"), stamp, F.lit("-part-"), F.lpad(part.cast("string"), 4, "0"), F.lit(".jsonl.gz"))


def fingerprints(objects: DataFrame) -> DataFrame:
    """``subreddit, month_label, kind, n_objects, fingerprint``: sha256 of the sorted ``key:etag:size`` lines of a partition.

    The list gathered per partition is its objects, not their records.
    """
    line = F.concat_ws(":", "object_key", "etag", F.col("size_bytes").cast("string"))
    parts = parsed_keys(objects).groupBy("subreddit", "month_label", "kind")
    return parts.agg(F.count(F.lit(1)).alias("n_objects"), F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("fingerprint"))


def enrich_fingerprint(etag: Column, version: Column) -> Column:
    return F.sha2(F.concat_ws(":", etag, version), 256)


def stale(partitions: DataFrame, manifest: DataFrame, keys: list[str], full: bool = False) -> DataFrame:
    """Partitions whose fingerprint is not the manifest's; all of them if ``full``."""
    if full:
        return partitions
    known = manifest.select(*keys, F.col("fingerprint").alias("_held"))
    return partitions.join(known, keys, "left").filter(~F.col("fingerprint").eqNullSafe(F.col("_held"))).drop("_held")


def stale_parts(objects: DataFrame, written: DataFrame) -> DataFrame:
    """Backfill parts to delete: index not below ``parts_written`` and uploaded before the run; hourly parts never."""
    keys = ["subreddit", "month_label", "kind"]
    parts = parsed_keys(objects).filter(F.col("hour_stamp").isNull()).join(written.select(*keys, "parts_written", "written_before"), keys)
    return parts.filter((F.col("part") >= F.col("parts_written")) & (F.col("uploaded_at") < F.col("written_before"))).select("object_key")


def settlement(items: DataFrame, keys: list[str], at: Column, give_up_hours: int = GIVE_UP_HOURS) -> DataFrame:
    """Per partition: rows, ``rows_unsettled``, ``oldest_unsettled_created_utc`` (0 for none) and ``rows_abandoned``.

    Rows have ``engagement_settled`` and ``created_utc``; one without a time is pending until it settles.
    """
    from larkspur.functions.clean import engagement_state

    state = engagement_state(F.coalesce("engagement_settled", F.lit(False)), F.col("created_utc"), at, give_up_hours)
    rows = items.withColumn("_state", state)
    pending = F.col("_state") == "pending"
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.max("created_utc").alias("last_created_utc"), F.count_if(pending).alias("rows_unsettled"),
        F.coalesce(F.min(F.when(pending, F.col("created_utc"))), F.lit(0)).alias("oldest_unsettled_created_utc"), F.count_if(F.col("_state") == "abandoned").alias("rows_abandoned"),
    )


def is_final(unsettled: Column, collected_at: Column, month: Column) -> Column:
    """A receipt without unsettled rows; an old one without that count if it was made over 30 days past its month's end."""
    end = F.unix_timestamp(F.add_months(F.to_date(F.concat(month, F.lit("-01")), "yyyy-MM-dd"), 1).cast("timestamp"))
    legacy = F.coalesce(F.unix_timestamp(F.try_to_timestamp(collected_at)) - end > LEGACY_MARGIN, F.lit(False))
    return F.when(unsettled.isNotNull(), unsettled == 0).otherwise(legacy)


def open_partitions(receipts: DataFrame, at: int, tail_months: int = 2) -> DataFrame:
    """``subreddit, month_label, kind`` to read again: the tail, filled forward from the newest receipt up to 24 months,
    and every collected partition that is not final."""
    spark = receipts.sparkSession
    now = times.month_number(*times.parse_month(times.recent_months(at, 1)[0]))
    number = F.substring("month_label", 1, 4).cast("int") * 12 + F.substring("month_label", 6, 2).cast("int") - 1
    newest = receipts.groupBy("subreddit").agg(F.max(number).alias("_new"))
    count = F.least(F.greatest(F.lit(tail_months), F.lit(now) - F.col("_new") + 1), F.lit(MOST_FILL_MONTHS))
    back = newest.select("subreddit", F.explode(F.sequence(F.lit(0), count - 1)).alias("_back"))
    months = spark.createDataFrame([(b, times.month_label(now - b)) for b in range(MOST_FILL_MONTHS)], "_back int, month_label string")
    kinds = F.explode(F.array(F.lit("posts"), F.lit("comments"))).alias("kind")
    tail = back.join(F.broadcast(months), "_back").select("subreddit", "month_label", kinds)
    keys = ["subreddit", "month_label", "kind"]
    waiting = receipts.filter(~is_final(F.col("rows_unsettled"), F.col("collected_at"), F.col("month_label"))).select(*keys)
    return tail.unionByName(waiting.join(tail, keys, "left_anti")).distinct()


def run_totals(receipts: DataFrame) -> DataFrame:
    """Totals of a run over its receipts."""
    unproven = F.coalesce(F.sum("seconds_unproven"), F.lit(0))
    return receipts.agg(F.count(F.lit(1)).alias("partitions"), F.coalesce(F.sum("keys_written"), F.lit(0)).alias("keys_written"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                        unproven.alias("seconds_unproven"), F.count_if(F.coalesce(F.col("rows_unsettled") > 0, F.lit(False))).alias("partitions_unsettled"))


def is_stale(generated_at: Column, now: Column, limit: int = 3 * 3600) -> Column:
    return F.coalesce(now - generated_at > limit, F.lit(True))


def healthy(partitions: DataFrame, manifest: DataFrame, keys: list[str]) -> bool:
    """No partition is stale."""
    return stale(partitions, manifest, keys).isEmpty()
