"""Queries that write a layer and read it back, and those of published documents and reports, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import text
from larkspur.operators import collection, evaluate, gauge, series, threads
from larkspur.plans import forum, forum_sql
from larkspur.scratch import fresh_path, materialize
from larkspur.session import table
from larkspur.sources import collect, derived, prices, raw, reports
from larkspur.streaming import incremental

VENUE = ["subreddit"]


def raw_parts(spark: SparkSession, d: str) -> DataFrame:
    """Lines written as gz parts and read back: their order and a digest of each."""
    path = fresh_path(spark, "parts")
    raw.write_parts(table(spark, d, "raw_records"), path)
    lines = raw.read_parts(spark, path)
    first = lines.groupBy("file_key").agg(F.min("line_no").alias("_first"))
    return lines.join(first, "file_key").select("file_key", (F.col("line_no") - F.col("_first")).alias("place"), F.md5("record_json").alias("digest"))


def derived_layer(spark: SparkSession, d: str) -> DataFrame:
    """Items written by partition and read back, each kind by a filter that prunes partitions."""
    path = fresh_path(spark, "derived")
    items = forum._items(spark, d, "subreddit", "month_label", "created_utc", "score").filter("subreddit IS NOT NULL AND month_label IS NOT NULL")
    derived.write_partitions(items, path)
    kinds = [derived.read(spark, path).filter(F.col("kind") == k) for k in ("post", "comment")]
    both = kinds[0].unionByName(kinds[1])
    both = both.join(derived.partitions(derived.read(spark, path), ["kind", "subreddit", "month_label"]), ["kind", "subreddit", "month_label"])
    return both.groupBy("kind", "subreddit", "month_label").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.max("created_utc").alias("last_utc"), F.sum(F.col("score").cast("long")).alias("sum_score"))


def series_layer(spark: SparkSession, d: str) -> DataFrame:
    """A stored series' receipt as it was written beside it."""
    path = fresh_path(spark, "series")
    said = derived.write_series(forum._series(spark, d), path, VENUE)
    return spark.read.schema(said.schema).json(f"{path}/receipt").drop("note")


def series_days(spark: SparkSession, d: str) -> DataFrame:
    """The published series documents, written as JSON and read back, a row a day in their order."""
    path = fresh_path(spark, "documents")
    full = forum._series(spark, d).withColumns({c: F.lit(None).cast("double") for c in ("pct_pos", "pct_neg")})
    docs = reports.series_document(materialize(full, "series"), VENUE, {"lexicon": "seed-1", "tags": "tags-1"}, forum.AT)
    derived.write_json(docs, path)
    back = derived.read_jsonl(spark, path, "subreddit string, daily array<struct<d: string, p: long, c: long, a: long, s: double>>, partial_after string, versions map<string,string>, generated_at long")
    days = back.select("subreddit", "partial_after", F.col("versions")["tags"].alias("tags_version"), F.posexplode("daily").alias("place", "x"))
    return days.select("subreddit", "place", F.col("x.d").alias("day"), F.col("x.p").alias("num_posts"), F.col("x.c").alias("num_comments"), F.col("x.a").alias("num_authors"), F.round("x.s", 6).alias("mean_compound"), (F.col("x.d") > F.col("partial_after")).alias("partial"), "tags_version")


def tags_ranked(spark: SparkSession, d: str) -> DataFrame:
    """The published tag documents: each venue's tags in the order shown, with the lengths of their weeks and daily tails."""
    docs = reports.tags_document(materialize(series.tag_daily(forum._joined(spark, d)), "tag-daily"), VENUE, forum.AT)
    shown = docs.select("subreddit", F.posexplode("tags").alias("place", "t"))
    return shown.select("subreddit", "place", F.col("t.key").alias("tag"), F.col("t.items_7d").alias("items_7d"))


def tag_activity(spark: SparkSession, d: str) -> DataFrame:
    return reports.split_active(forum.tag_summary(spark, d))


def tag_counts(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.element_counts(table(spark, d, "enrich"), "tags")


def compound_misses(spark: SparkSession, d: str) -> DataFrame:
    """Items whose polarity has another sign than their rating."""
    rows = forum._rated(spark, d)
    sign = text.polarity_label(F.col("vader_compound"), None, 0.3, -0.2)
    gold = F.when(F.col("scored") > 0, "pos").when(F.col("scored") < 0, "neg").when(F.col("scored") == 0, "neu")
    return evaluate.misses(rows, "vader_compound", sign, gold).select("kind", "id", "vader_compound", "label", "gold_label")


def _charts(spark: SparkSession, d: str) -> DataFrame:
    """Each venue's daily comments as a nested chart payload, days without a count as null closes."""
    days = forum._series(spark, d).select("subreddit", F.unix_timestamp(F.col("date").cast("timestamp")).alias("t"), F.when(F.col("num_comments") > 0, F.col("num_comments") * 1.25).alias("close"))
    held = days.groupBy("subreddit").agg(F.array_sort(F.collect_list(F.struct("t", "close"))).alias("x"))  # a venue's days
    quote = F.struct(F.array(F.struct(F.col("x.close").alias("close"))).alias("quote"))
    result = F.struct(F.struct(F.lit("USD").alias("currency")).alias("meta"), F.col("x.t").alias("timestamp"), quote.alias("indicators"))
    return held.select(F.col("subreddit").alias("symbol"), F.to_json(F.struct(F.struct(F.array(result).alias("result")).alias("chart")), {"ignoreNullFields": "false"}).alias("payload"))


def chart_rows(spark: SparkSession, d: str) -> DataFrame:
    return prices.parse_chart(_charts(spark, d))


def chart_checks(spark: SparkSession, d: str) -> DataFrame:
    """New series against the ones before: venues whose name has an odd length had twice as many rows."""
    rows = materialize(prices.parse_chart(_charts(spark, d)), "closes")
    odd = rows.filter(F.length("symbol") % 2 == 1)
    return prices.checked(rows, rows.unionByName(odd))


def review_merge(spark: SparkSession, d: str) -> DataFrame:
    """Labels exported for review, read back, and merged as edits of the labels they came from."""
    tone = F.map_from_arrays(F.coalesce("tags", F.array().cast("array<string>")), F.transform(F.coalesce("tags", F.array().cast("array<string>")), lambda t: F.length(t) % 3))
    labels = forum._rated(spark, d).filter("gold IS NOT NULL AND scored IS NOT NULL").select(
        F.concat_ws("/", "kind", "id").alias("doc_id"), F.coalesce("tags", F.array().cast("array<string>")).alias("tags"), F.col("gold").alias("overall_sentiment"), (F.col("gold") == 0).alias("no_sentiment"),
        tone.alias("tag_sentiment"), F.when(F.col("scored") > 1, "high").when(F.col("scored") > 0, "medium").otherwise("low").alias("confidence"), F.concat(F.lit('said "'), F.coalesce("vader_label", F.lit("none")), F.lit('",\nso it is')).alias("rationale"),
    )
    labels = materialize(labels, "labels")
    path = fresh_path(spark, "review")
    derived.export_review(labels.withColumn("overall_sentiment", F.when(F.col("confidence") == "low", F.lit(0)).otherwise(F.col("overall_sentiment"))), path)
    merged = threads.updated(labels, derived.import_review(spark, path), "doc_id")
    return merged.select("doc_id", F.array_join("tags", ";").alias("tags"), "overall_sentiment", "no_sentiment", F.size("tag_sentiment").alias("n_tones"), "confidence", "rationale")


def page_receipts(spark: SparkSession, d: str) -> DataFrame:
    """Receipts of the stored lines as a collector would have left them."""
    lines = collection.parsed_keys(table(spark, d, "raw_records"), "file_key")
    created = F.try_variant_get(F.try_parse_json("record_json"), "$.created_utc", "double").cast("long")
    pages = lines.select("subreddit", "month_label", "kind", created.alias("created_utc"), "record_json", F.lit(None).cast("string").alias("note"))
    return collect.receipts_of(pages, forum.AT).select("subreddit", "month_label", "kind", "rows", "last_created_utc", "seconds_unproven", "collected_at")


def incremental_build(spark: SparkSession, d: str) -> DataFrame:
    """A build of what had been uploaded before 2023, then one of everything: how often each partition was built, and its
    fingerprint in the manifest."""
    objects, built = table(spark, d, "raw_objects"), fresh_path(spark, "built")
    manifest = derived.Manifest(spark, fresh_path(spark, "manifest"))
    build = lambda parts: parts.withColumn("label", F.concat_ws("/", *incremental.KEYS)).select("label").write.mode("append").parquet(built)
    incremental.rebuild(objects.filter(F.col("uploaded_at") < F.lit("2023-01-01").cast("timestamp")), manifest, build)
    incremental.rebuild(objects, manifest, build)
    times = spark.read.schema("label string").parquet(built).groupBy("label").agg(F.count(F.lit(1)).alias("n_builds"))
    return manifest.table().join(times, "label").select("label", "n_builds", "fingerprint")


def allocation_kept(spark: SparkSession, d: str) -> DataFrame:
    """Whether the stratified sample has its size, holds nothing twice and meets what it owes the rare cases."""
    picked = forum.allocate_strata(spark, d)
    return picked.agg(
        F.count(F.lit(1)).alias("n_picked"), (F.countDistinct("kind", "id") == F.count(F.lit(1))).alias("each_once"), (F.count_if(F.col("pick_reason") == "no_hit") <= 50).alias("no_hit_kept"), (F.count_if(F.col("pick_reason") == "removed") <= 15).alias("removed_kept")
    )


QUERIES = {
    f.__name__: f
    for f in (
        raw_parts, derived_layer, series_layer, series_days, tags_ranked, tag_activity, tag_counts, compound_misses, chart_rows, chart_checks, review_merge, page_receipts,
        incremental_build, allocation_kept,
    )
}

_TAG_SUMMARY = forum_sql.SQL["tag_summary"]
_CLOSES = f"WITH {forum_sql._SERIES}, closes AS (SELECT subreddit AS symbol, date, round(num_comments * 1.25::DOUBLE, 2) AS close FROM series WHERE num_comments > 0)"

SQL = {
    "raw_parts": "SELECT file_key, row_number() OVER (PARTITION BY file_key ORDER BY line_no) - 1 AS place, md5(record_json) AS digest FROM raw_records WHERE file_key IS NOT NULL AND trim(record_json, ' ') <> ''",
    "derived_layer": f"""WITH {forum_sql._ITEMS} SELECT kind, subreddit, month_label, count(*) AS n, min(id) AS first_id, max(created_utc) AS last_utc, CAST(sum(score) AS BIGINT) AS sum_score
FROM items WHERE subreddit IS NOT NULL AND month_label IS NOT NULL GROUP BY ALL""",
    "series_layer": forum_sql.SQL["series_receipt"],
    "series_days": f"""WITH {forum_sql._SERIES} SELECT subreddit, CAST(row_number() OVER (PARTITION BY subreddit ORDER BY date) - 1 AS INTEGER) AS place, strftime(date, '%Y-%m-%d') AS day, num_posts, num_comments, num_unique_authors AS num_authors,
  round(mean_compound, 6) AS mean_compound, date > max(date) OVER (PARTITION BY subreddit) - 2 AS partial, 'tags-1' AS tags_version FROM series""",
    "tags_ranked": f"SELECT subreddit, CAST(row_number() OVER (PARTITION BY subreddit ORDER BY items_7d DESC, first_date, tag) - 1 AS INTEGER) AS place, tag, items_7d FROM ({_TAG_SUMMARY})",
    "tag_activity": f"SELECT count(*) FILTER (WHERE items_7d > 0) AS active, count(*) FILTER (WHERE items_7d <= 0) AS quiet FROM ({_TAG_SUMMARY})",
    "tag_counts": "SELECT element, count(*) AS n FROM (SELECT unnest(list_distinct(tags)) AS element FROM enrich) WHERE element IS NOT NULL GROUP BY element",
    "compound_misses": f"""WITH {forum_sql._RATED} SELECT * FROM (SELECT kind, id, vader_compound, CASE WHEN vader_compound >= 0.3 THEN 'pos' WHEN vader_compound <= -0.2 THEN 'neg' WHEN vader_compound IS NOT NULL THEN 'neu' END AS label,
  CASE WHEN scored > 0 THEN 'pos' WHEN scored < 0 THEN 'neg' WHEN scored = 0 THEN 'neu' END AS gold_label FROM rated) WHERE label <> gold_label""",
    "chart_rows": _CLOSES + " SELECT symbol, 'USD' AS currency, date, close FROM closes",
    "chart_checks": _CLOSES
    + """ SELECT symbol, n AS rows, CASE WHEN lo < 0.01 OR hi > 10000 THEN 'a close out of range' WHEN length(symbol) % 2 = 1 THEN 'series shrank ' || 2 * n || ' to ' || n END AS problem
FROM (SELECT symbol, count(*) AS n, min(close) AS lo, max(close) AS hi FROM closes GROUP BY symbol)""",
    "review_merge": f"""WITH {forum_sql._RATED} SELECT kind || '/' || id AS doc_id, array_to_string(coalesce(tags, []), ';') AS tags, CASE WHEN scored > 0 THEN gold ELSE 0 END AS overall_sentiment, gold = 0 AS no_sentiment, CAST(len(coalesce(tags, [])) AS INTEGER) AS n_tones,
  CASE WHEN scored > 1 THEN 'high' WHEN scored > 0 THEN 'medium' ELSE 'low' END AS confidence, 'said "' || coalesce(vader_label, 'none') || '",' || chr(10) || 'so it is' AS rationale FROM rated WHERE gold IS NOT NULL AND scored IS NOT NULL""",
    "page_receipts": f"""SELECT subreddit, month_label, kind, count(*) AS rows, max(created_utc) AS last_created_utc, CAST(0 AS BIGINT) AS seconds_unproven, '2025-01-01T00:00:00Z' AS collected_at FROM (
  SELECT lower(regexp_extract(file_key, '{forum_sql._RAW_KEY}', 1)) AS subreddit, regexp_extract(file_key, '{forum_sql._RAW_KEY}', 2) AS month_label, regexp_extract(file_key, '{forum_sql._RAW_KEY}', 3) AS kind,
    CAST(trunc(TRY_CAST(json_extract_string(record_json, '$.created_utc') AS DOUBLE)) AS BIGINT) AS created_utc FROM raw_records WHERE regexp_matches(file_key, '{forum_sql._RAW_KEY}') AND record_json IS NOT NULL) GROUP BY ALL""",
    "incremental_build": f"""WITH {forum_sql._PARTS}, early AS (SELECT * FROM parts WHERE uploaded_at < TIMESTAMPTZ '2023-01-01 00:00:00+00'), a AS ({forum_sql._PRINTS.format("parts")}), b AS ({forum_sql._PRINTS.format("early")})
SELECT a.subreddit || '/' || a.month_label || '/' || a.kind AS label, CAST(CASE WHEN b.fingerprint IS NULL OR b.fingerprint = a.fingerprint THEN 1 ELSE 2 END AS BIGINT) AS n_builds, a.fingerprint FROM a LEFT JOIN b USING (subreddit, month_label, kind)""",
    "allocation_kept": f"""WITH {forum_sql._ITEMS}, {forum_sql._ENRICHED} SELECT least(450, count(*)) AS n_picked, TRUE AS each_once, TRUE AS no_hit_kept, TRUE AS removed_kept FROM items i JOIN enriched e ON i.kind = e.kind AND i.id = e.id
WHERE trim(CASE WHEN i.kind = 'post' THEN concat_ws(' ', title, selftext) ELSE coalesce(body, '') END, ' ') <> ''""",
}
