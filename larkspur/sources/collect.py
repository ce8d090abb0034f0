"""Collection jobs: months of backfill and the hourly tail, each with its receipts.

Lines lie under ``subreddit=/month_label=/kind=/origin=``; a job replaces just the origins that it writes, so running it
again is harmless and parts of an earlier, longer run do not survive. Receipts are replaced by partition.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import clean, times
from larkspur.operators.collection import settlement
from larkspur.scratch import discard, materialize
from larkspur.sources import schemas
from larkspur.sources.derived import exists

KEYS = ["subreddit", "month_label", "kind"]


class EmptyMonth(RuntimeError):
    pass


def read_pages(spark: SparkSession, window: times.Window, subreddits: list[str], kinds: list[str], source: str = "paged_archive", **options: str) -> DataFrame:
    """The registered source's rows and notes of a window, with each row's own month; read once and stored."""
    reader = spark.read.format(source).options(after=window.after, before=window.before, subreddits=",".join(subreddits), kinds=",".join(kinds), **options)
    return materialize(reader.load().withColumn("month_label", times.month_of(F.col("created_utc"))), "pages")


def write_origin(lines: DataFrame, root: str, origin: str) -> None:
    placed = lines.filter("record_json IS NOT NULL").select(F.lower("subreddit").alias("subreddit"), "month_label", "kind", F.lit(origin).alias("origin"), F.col("record_json").alias("value"))
    writer = placed.hint("rebalance", *[F.col(k) for k in KEYS]).write.partitionBy(*KEYS, "origin")
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip").text(root)


def read_origins(spark: SparkSession, root: str) -> DataFrame:
    """``subreddit, month_label, kind, origin, record_json`` of everything collected."""
    schema = "value string, subreddit string, month_label string, kind string, origin string"
    return spark.read.schema(schema).text(root).select(*KEYS, "origin", F.col("value").alias("record_json"))


def receipts_of(pages: DataFrame, at: int) -> DataFrame:
    """One receipt per partition of the pages read: rows (re-read seconds count twice), settlement and proof of wholeness."""
    doc = F.try_parse_json("record_json")
    rows = pages.filter("record_json IS NOT NULL").select(F.lower("subreddit").alias("subreddit"), "month_label", "kind", "created_utc", clean.has_settled_engagement(doc, by_key=True).alias("engagement_settled"))
    notes = pages.filter("note IS NOT NULL").groupBy(F.lower("subreddit").alias("subreddit"), "month_label", "kind").agg(
        F.sort_array(F.collect_set(F.when(F.col("note") == "unproven", F.col("created_utc")))).alias("unproven_at"), F.sort_array(F.collect_set(F.when(F.col("note") == "floor", F.col("created_utc")))).alias("floor_violation_at")
    )
    none = F.array().cast("array<bigint>")
    stamp = datetime.fromtimestamp(at, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    out = settlement(rows, KEYS, F.lit(at)).join(notes, KEYS, "left").withColumns({"unproven_at": F.coalesce("unproven_at", none), "floor_violation_at": F.coalesce("floor_violation_at", none)})
    out = out.withColumns({"collected_at": F.lit(stamp), "keys_written": F.lit(1).cast("long"), "seconds_unproven": F.size("unproven_at").cast("long")})
    names = [f.strip().split(" ")[0] for f in schemas.RECEIPT.split(",") if " " in f.strip()]
    return out.select(*names)


def read_receipts(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.RECEIPT)
    return spark.read.schema(schemas.RECEIPT).parquet(path)


def _write_receipts(receipts: DataFrame, path: str) -> None:
    receipts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*KEYS).parquet(path)


def collect_month(spark: SparkSession, root: str, receipts_path: str, window: times.Window, subreddit: str, kind: str, at: int, source: str = "paged_archive", **options: str) -> dict:
    """Read one month and replace its backfill lines and receipt; returns the receipt.

    A month that had rows before and has none now is an error, and nothing is replaced.
    """
    pages = read_pages(spark, window, [subreddit], [kind], source, **options)
    made = [r.asDict() for r in receipts_of(pages, at).filter(F.col("month_label") == window.label).collect()]  # one partition
    if not made:
        held = read_receipts(spark, receipts_path).filter((F.col("subreddit") == subreddit.lower()) & (F.col("month_label") == window.label) & (F.col("kind") == kind) & (F.col("rows") > 0))
        if not held.isEmpty():
            raise EmptyMonth(f"{subreddit} {window.label} {kind} had rows and now has none")
        return {"subreddit": subreddit.lower(), "month_label": window.label, "kind": kind, "rows": 0, "rows_unsettled": 0, "rows_abandoned": 0, "seconds_unproven": 0}
    write_origin(pages.filter(F.col("month_label") == window.label), root, "backfill")
    _write_receipts(spark.createDataFrame([tuple(made[0][f.name] for f in spark.createDataFrame([], schemas.RECEIPT).schema)], schemas.RECEIPT), receipts_path)
    discard(pages)
    return made[0]


def collect_tail(spark: SparkSession, root: str, at: int, hours: int, subreddits: list[str], source: str = "paged_archive", **options: str) -> str:
    """Read the trailing window of both kinds; rows go to their own months under an origin named by the hour."""
    pages = read_pages(spark, times.trailing_window(at, hours), subreddits, ["posts", "comments"], source, **options)
    origin = f"recent-{times.hour_stamp(at)}"
    write_origin(pages, root, origin)
    discard(pages)
    return origin


def retried(step: Callable[[], dict], attempts: int = 5, first_wait: float = 30.0, sleep: Callable[[float], None] = time.sleep) -> dict:
    """Run a step again after a failure, with waits that double; a month that came back empty is no such failure."""
    for attempt in range(attempts):
        try:
            return step()
        except EmptyMonth:
            raise
        except Exception:
            if attempt + 1 == attempts:
                raise
            sleep(first_wait * 2**attempt)
    raise ValueError("no attempts")


def allowed(subreddits: list[str], allow: list[str] | None, block: list[str] = ()) -> list[str]:
    """Venues to collect, lower case, each once: those of the allow-list if there is one, none of the block-list."""
    names = dict.fromkeys(s.lower() for s in subreddits)
    allow, block = {s.lower() for s in allow} if allow is not None else set(names), {s.lower() for s in block}
    return [n for n in names if n in allow and n not in block]


def backfill_year(spark: SparkSession, root: str, receipts_path: str, year: int, now: int, subreddits: list[str], source: str = "paged_archive", at_once: int = 4, **options: str) -> list[dict]:
    """All settled months of a year, up to 48 hours ago; a month is one retried job, ``at_once`` of them side by side."""
    due = [(s, w, k) for s in subreddits for w in times.settled_months(year, times.backfill_cutoff(now)) for k in ("posts", "comments")]
    run = lambda d: retried(lambda: collect_month(spark, root, receipts_path, d[1], d[0], d[2], now, source, **options))
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(run, due))
