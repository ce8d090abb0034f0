"""Published documents and the functions that serve them."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators import gauge, series


def series_document(daily: DataFrame, keys: list[str], versions: dict[str, str], generated_at: int) -> DataFrame:
    """One row per venue: daily rows, gauge, volume changes and analog as nested columns, ready for ``write_json``.

    The gathered list is a venue's days.
    """
    day = F.struct(F.col("date").cast("string").alias("d"), F.col("num_posts").alias("p"), F.col("num_comments").alias("c"), F.col("num_unique_authors").alias("a"), F.col("mean_compound").alias("s"), F.col("pct_pos").alias("pos"), F.col("pct_neg").alias("neg"))
    days = daily.groupBy(*keys).agg(F.array_sort(F.collect_list(day)).alias("daily"), F.date_sub(F.max("date"), gauge.PARTIAL).cast("string").alias("partial_after"))
    own = lambda df, name: df.select(*keys, F.struct(*[c for c in df.columns if c not in keys]).alias(name))
    changes = gauge.volume_changes(daily, keys)
    changed = changes.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("period", F.struct("current", "previous", "delta"))))).alias("volume_changes"))
    out = days.join(own(gauge.gauge(daily, keys), "gauge"), keys, "left").join(changed, keys, "left").join(own(gauge.analog(daily, keys), "analog"), keys, "left")
    return out.withColumns({"versions": F.create_map(*[F.lit(x) for kv in versions.items() for x in kv]), "generated_at": F.lit(generated_at)})


def tags_document(tags: DataFrame, keys: list[str], generated_at: int) -> DataFrame:
    """One row per venue: its tags by items of the last 7 days (ties by first appearance), each with weeks and daily tail."""
    summary = gauge.tag_summary(tags, keys)
    dated = tags.join(summary.select(*keys, "tag", "asof"), [*keys, "tag"]).filter("date <= asof")
    weeks = series.tag_weekly(dated, [*keys, "tag"]).groupBy(*keys, "tag").agg(F.array_sort(F.collect_list(F.struct(F.col("week").cast("string").alias("w"), "items", "mean_compound"))).alias("weekly"))
    tail = dated.filter(F.col("date") > F.date_sub("asof", gauge.TAG_TAIL)).groupBy(*keys, "tag").agg(F.array_sort(F.collect_list(F.struct(F.col("date").cast("string").alias("d"), "num_items", "mean_compound"))).alias("daily"))
    each = summary.join(weeks, [*keys, "tag"], "left").join(tail, [*keys, "tag"], "left")
    row = F.struct((-F.col("items_7d")).alias("_order"), F.col("first_date").alias("_first"), F.col("tag").alias("key"), "items_7d", "delta_vs_90d", "sent_7d", "volume_z", "weekly", "daily")
    docs = each.groupBy(*keys).agg(F.max("asof").cast("string").alias("asof"), F.array_sort(F.collect_list(row)).alias("_rows"))
    shown = F.transform("_rows", lambda r: F.struct(*[r[c].alias(c) for c in ("key", "items_7d", "delta_vs_90d", "sent_7d", "volume_z", "weekly", "daily")]))
    return docs.select(*keys, "asof", shown.alias("tags"), F.lit(generated_at).alias("generated_at"))


def split_active(summary: DataFrame) -> DataFrame:
    return summary.agg(F.count_if(F.col("items_7d") > 0).alias("active"), F.count_if(F.col("items_7d") <= 0).alias("quiet"))


def serve(folder: str | Path, route: str, symbols: list[str], now: int) -> tuple[int, str]:
    """(status, JSON text) of ``/api/series``, ``/api/tags``, ``/api/prices`` and ``/api/status``; 503 for what is not
    published yet, 404 for other routes."""
    folder = Path(folder)

    def held(name: str):
        path = folder / f"{name}.json"
        return json.loads(path.read_text()) if path.exists() else None

    if route in ("/api/series", "/api/tags"):
        document = held(route.rsplit("/", 1)[1])
        return (200, json.dumps(document)) if document is not None else (503, json.dumps({"error": f"{route[5:]} is not published yet"}))
    if route == "/api/prices":
        return 200, json.dumps({s: held(f"prices/{s}") for s in symbols})
    if route == "/api/status":
        document, price = held("series") or {}, held(f"prices/{symbols[0]}") if symbols else None
        made = document.get("generated_at")
        return 200, json.dumps({"generated_at": made, "partial_after": document.get("partial_after"), "prices_updated_at": (price or {}).get("updated_at"), "stale": made is None or now - made > 3 * 3600})
    return 404, json.dumps({"error": "not found"})
