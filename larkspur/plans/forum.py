"""Queries of the archive's own operators over posts, comments, enrichment and series, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import clean, sentiment, text, times
from larkspur.operators import asof, collection, evaluate, fit, gauge, rolling, sampling, series, threads
from larkspur.scratch import fresh_path, materialize
from larkspur.session import table
from larkspur.sources import raw, reports, taxonomy

SEEN = ["ingested_at", "batch_key", "line_no"]
VENUE = ["subreddit"]
AT = 1735689600  # 2025-01-01, the instant that settlement and staleness are judged at


def _deliveries(spark: SparkSession, d: str) -> DataFrame:
    return series.union_kinds(table(spark, d, "posts"), table(spark, d, "comments"))


def _items(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """One copy per (kind, id)."""
    return series.first_settled(_deliveries(spark, d), ["kind", "id"], F.col("retrieved_2nd_on").isNotNull(), SEEN, ["kind", "id", *columns])


def _enriched(spark: SparkSession, d: str) -> DataFrame:
    """The latest record per (kind, id), each tag once."""
    rows = table(spark, d, "enrich").filter(F.col("id").isNotNull()).withColumn("tags", F.array_sort(F.array_distinct(F.array_compact("tags"))))
    best = F.max(F.struct("enrich_version", "vader_compound", "vader_label", "tags")).alias("b")
    return rows.groupBy("kind", "id").agg(best).select("kind", "id", "b.*")


def _joined(spark: SparkSession, d: str) -> DataFrame:
    return series.joined(_items(spark, d, "subreddit", "author", "created_utc"), _enriched(spark, d))


def _series(spark: SparkSession, d: str) -> DataFrame:
    """The stored daily series without gaps."""
    values = ["num_posts", "num_comments", "num_unique_authors", "num_scored", "mean_compound"]
    latest = rolling.latest_edition(table(spark, d, "daily_sentiment"), VENUE, "activity_date", "generated_at", values).withColumnRenamed("activity_date", "date")
    return series.filled(latest, VENUE, "date", values[:4])


def daily_activity(spark, d):
    return series.daily_volume(_items(spark, d, "subreddit", "author", "created_utc"))


def daily_sentiment(spark, d):
    return series.daily_sentiment(_joined(spark, d))


def tag_daily(spark, d):
    return series.tag_daily(_joined(spark, d))


def tag_weekly(spark, d):
    return series.tag_weekly(series.tag_daily(_joined(spark, d)), ["subreddit", "tag"])


def tag_summary(spark, d):
    return gauge.tag_summary(materialize(series.tag_daily(_joined(spark, d)), "tag-daily"), VENUE)


def series_receipt(spark, d):
    return series.receipt(_series(spark, d), VENUE)


def counts_by_month(spark, d):
    return series.counts_by_month(_deliveries(spark, d))


def dedup_priority(spark, d):
    keys = ["subreddit", "month_label", "kind", "id"]
    return series.first_settled(_deliveries(spark, d), keys, F.col("retrieved_2nd_on").isNotNull(), SEEN, [*keys, "score", "retrieved_2nd_on", "batch_key", "line_no"])


def rolling_7d_mean(spark, d):
    s = _series(spark, d)
    return s.select("subreddit", "date", F.round(gauge.window_mean(F.log1p(F.col("num_posts") + F.col("num_comments")), VENUE), 6).alias("volume_7d"), F.round(gauge.window_mean(F.col("mean_compound"), VENUE), 6).alias("sentiment_7d"))


def trailing_zscore(spark, d):
    return gauge.standing(_series(spark, d), VENUE).select("subreddit", "date", F.round("volume_z", 6).alias("volume_z"), F.round("sentiment_z", 6).alias("sentiment_z"))


def gauge_latest(spark, d):
    return gauge.gauge(_series(spark, d), VENUE)


def volume_changes(spark, d):
    return gauge.volume_changes(_series(spark, d), VENUE)


def analog_window(spark, d):
    return gauge.analog(_series(spark, d), VENUE)


def rebase_100(spark, d):
    s = _series(spark, d).select("subreddit", "date", (F.col("num_posts") + F.col("num_comments")).cast("double").alias("items"))
    return gauge.rebased(s, VENUE, "items", first="2023-01-01").withColumn("indexed", F.round("indexed", 6))


def lag_change(spark, d):
    s = _series(spark, d).select("subreddit", "date", F.col("num_comments").cast("double").alias("n"))
    return gauge.last_change(s, VENUE, "n").withColumn("change_pct", F.round("change_pct", 6))


def nearest_comment(spark, d):
    posts = _items(spark, d, "subreddit", "created_utc").filter("kind = 'post'").select("id", "subreddit", "created_utc")
    comments = _items(spark, d, "subreddit", "created_utc").filter("kind = 'comment'").select(F.col("id").alias("comment_id"), "subreddit", "created_utc")
    return asof.nearest(posts, comments, VENUE, "created_utc", "comment_id")


def overlay_window(spark, d):
    s = _series(spark, d).groupBy("date").agg(F.sum("num_posts").cast("double").alias("posts"), F.sum("num_comments").cast("double").alias("comments"))
    sides = {"posts": s.filter("posts > 0").select("date", F.col("posts").alias("value")), "comments": s.filter("comments > 0").select("date", F.col("comments").alias("value"))}
    return asof.overlay(sides)


def thread_context(spark, d):
    items = _items(spark, d, "title", "body", "link_id", "parent_id")
    return threads.with_context(items.filter("kind = 'comment'").drop("kind"), items.filter("kind = 'post'").drop("kind"), parent_chars=text.MOST_CHARS)


def semi_teacher(spark, d):
    """Items of the archive whose record carries a tag."""
    wanted = _enriched(spark, d).filter(F.size("tags") > 0)
    return threads.only(_items(spark, d, "score"), wanted, ["kind", "id"]).select("kind", "id", "score")


def anti_holdout(spark, d):
    return threads.without(_items(spark, d, "score"), _enriched(spark, d), ["kind", "id"]).select("kind", "id", "score")


def date_range(spark, d):
    c = F.col("created_utc")
    return _items(spark, d, "created_utc").filter(times.between_days(c, "2024-01-15", "2024-02-01")).select("kind", "id", times.day_of(c).alias("day"))


def text_clean(spark, d):
    return table(spark, d, "documents").select("doc_id", clean.clean_text(F.col("text")).alias("text"), clean.clean_author(F.col("author")).alias("author"))


def text_join(spark, d):
    t, s = F.col("title"), F.col("selftext")
    return _items(spark, d, "title", "selftext").filter("kind = 'post'").select("id", text.enrich_text(t, s).alias("enrich_text"), text.post_text(t, s).alias("post_text"), text.sample_text(t, s).alias("sample_text"))


def regex_tags(spark, d):
    tags = taxonomy.default()
    return table(spark, d, "documents").select("doc_id", text.tags_joined(F.col("text"), tags).alias("tags"))


def word_length_era(spark, d):
    rows = table(spark, d, "documents").filter(text.is_filled(F.col("text")))
    words = text.word_count(F.col("text"))
    return rows.select("doc_id", words.alias("words"), text.length_bucket(words).alias("length"), times.year_of(F.col("created_utc")).alias("era"))


def text_views(spark, d):
    c = F.col("text")
    return table(spark, d, "documents").filter(c.isNotNull()).select("doc_id", F.md5(text.truncated(c)).alias("cut_md5"), text.slug(F.col("source")).alias("slug"))


def polarity_labels(spark, d):
    c = F.col("vader_compound")
    return _enriched(spark, d).select("kind", "id", text.polarity_label(c, 1 - F.abs(c), 0.3, -0.2, 0.8).alias("label"))


def vader_scores(spark, d):
    scored = table(spark, d, "documents").select("doc_id", sentiment.polarity_scores(F.col("text")).alias("s"))
    lex = sentiment.Lexicon()
    return scored.select("doc_id", "s.compound", "s.neu", text.polarity_label(F.col("s.compound"), F.col("s.neu"), lex.pos, lex.neg, lex.neu_min).alias("label"))


def enrich_items(spark, d):
    """Tags and polarity of every item, as the enrichment layer stores them."""
    body = F.when(F.col("kind") == "post", text.enrich_text(F.col("title"), F.col("selftext"))).otherwise(F.coalesce("body", F.lit("")))
    rows = _items(spark, d, "title", "selftext", "body").select("kind", "id", body.alias("text"))
    lex = sentiment.Lexicon()
    scored = rows.select("kind", "id", text.tags_for(F.col("text"), taxonomy.default()).alias("tags"), sentiment.polarity_scores(F.col("text"), lex).alias("s"))
    return scored.select("kind", "id", "tags", F.col("s.compound").alias("vader_compound"), text.polarity_label(F.col("s.compound"), F.col("s.neu"), lex.pos, lex.neg, lex.neu_min).alias("vader_label"), F.lit(f"{lex.version}+tags-1").alias("enrich_version"))


def md5_per_year(spark, d):
    rows = _items(spark, d, "created_utc").select("kind", "id", times.year_of(F.col("created_utc")).alias("era"))
    return sampling.first_by_hash_per(rows, ["kind", "era"], 400)


def md5_top_n(spark, d):
    return sampling.first_by_hash(_items(spark, d), 500, ties=["kind"])


def md5_parts(spark, d):
    return _items(spark, d).select("kind", "id", sampling.hash_part(F.col("id")).alias("part"))


def _level_sql(x, cuts):
    a, b, c, e = cuts
    return F.when(x <= a, -2).when(x <= b, -1).when(x < c, 0).when(x < e, 1).when(x.isNotNull(), 2)


def _rated(spark: SparkSession, d: str) -> DataFrame:
    """Two ratings per item on the scale -2..2: by its text's compound, and by its score."""
    rows = _items(spark, d, "score").join(_enriched(spark, d), ["kind", "id"])
    return rows.select("kind", "id", "tags", "vader_compound", "vader_label", _level_sql(F.col("vader_compound"), (-0.6, -0.05, 0.05, 0.6)).alias("gold"), _level_sql(F.col("score"), (-5, -1, 3, 20)).alias("scored"))


def exact_within_one(spark, d):
    return evaluate.agreement(_rated(spark, d))


def confusion(spark, d):
    return evaluate.confusion(_rated(spark, d).filter("gold IS NOT NULL AND scored IS NOT NULL"))


def kappa(spark, d):
    return evaluate.kappa(_rated(spark, d))


def kappa_three_way(spark, d):
    return evaluate.kappa(_rated(spark, d).select(text.three_way(F.col("gold")).alias("gold"), text.three_way(F.col("scored")).alias("scored")))


def tag_prf(spark, d):
    """Stored tags as gold against the tags found in the text."""
    body = F.when(F.col("kind") == "post", text.enrich_text(F.col("title"), F.col("selftext"))).otherwise(F.coalesce("body", F.lit("")))
    found = _items(spark, d, "title", "selftext", "body").select("kind", "id", text.tags_for(body, taxonomy.default()).alias("scored_tags"))
    return evaluate.tag_scores(found.join(_enriched(spark, d).withColumnRenamed("tags", "gold_tags"), ["kind", "id"]))


def histogram(spark, d):
    return evaluate.histogram(_rated(spark, d), ["kind", "gold", "scored", "vader_label"])


def validate_labels(spark, d):
    keys = ["ORE_SPOT", "ORE_TERM", "ENRICHMENT", "NEW_BUILD", "RESTART", "MEME"]
    tone = F.when(F.col("scored").isNotNull(), F.map_from_arrays("tags", F.transform("tags", lambda t: F.col("scored") + F.length(t) % 3)))
    rows = _rated(spark, d).select(
        "kind", "id", "tags", F.col("gold").alias("overall_sentiment"), (F.abs("vader_compound") < 0.2).alias("no_sentiment"), tone.alias("tag_sentiment"),
        F.when(F.col("scored") > 1, "high").when(F.col("scored") > 0, "sure").otherwise("low").alias("confidence"), F.coalesce("vader_label", F.lit(" ")).alias("rationale"),
    )
    return rows.select("kind", "id", F.array_join(evaluate.label_problems(keys), "; ").alias("problems"))


def quota_split(spark, d):
    rows = _rated(spark, d).filter("gold IS NOT NULL").select("kind", "id", "gold", F.abs("vader_compound").alias("sure"))
    return sampling.quota_split(rows, ["kind", "gold"], "id", F.col("sure"), 450)


def exemplars(spark, d):
    return sampling.first_per_level(_rated(spark, d).filter("gold IS NOT NULL").select("kind", "id", "gold"), "gold", 4, "id", ties=["kind"])


def allocate_strata(spark, d):
    return sampling.stratified(_items(spark, d, "title", "selftext", "body", "created_utc", "removal_category"), _enriched(spark, d))


def _bodies(spark: SparkSession, d: str) -> DataFrame:
    """Texts of both kinds with the sign of their polarity."""
    body = F.when(F.col("kind") == "post", text.enrich_text(F.col("title"), F.col("selftext"))).otherwise(F.col("body"))
    rows = _items(spark, d, "title", "selftext", "body").withColumn("text", body).filter("text IS NOT NULL").join(_enriched(spark, d), ["kind", "id"])
    return rows.filter("vader_compound IS NOT NULL").select("id", "text", F.signum(F.round("vader_compound", 1)).cast("int").alias("y"))


def token_docfreq(spark, d):
    return fit.doc_frequency(_bodies(spark, d))


def token_association(spark, d):
    return fit.associations(materialize(_bodies(spark, d), "docs")).withColumn("association", F.round("association", 6))


def top_terms(spark, d):
    return fit.learned_lexicon(fit.associations(materialize(_bodies(spark, d), "docs"), least_docs=20), scale=4.0, least=0.02)


def grid_argmax(spark, d):
    rows = _rated(spark, d).select(F.col("vader_compound").alias("compound"), (1 - F.abs("vader_compound")).alias("neu"), F.col("scored").alias("gold"))
    return fit.best_thresholds(rows, fit.grid(fit.GRID_POS, fit.GRID_NEG, fit.GRID_NEU))


def project_raw(spark, d):
    return raw.derive(table(spark, d, "raw_records"), strict=False).drop("kind").withColumn("upvote_ratio", F.round("upvote_ratio", 6))


def engagement_state(spark, d):
    rows = _items(spark, d, "created_utc", "engagement_settled")
    state = clean.engagement_state(F.coalesce("engagement_settled", F.lit(False)), F.col("created_utc"), F.lit(AT))
    return rows.groupBy("kind", state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


def settlement_tally(spark, d):
    return collection.settlement(_deliveries(spark, d), ["subreddit", "month_label", "kind"], F.lit(AT))


def discover_partitions(spark, d):
    parts = collection.parsed_keys(table(spark, d, "raw_objects"))
    return parts.groupBy("subreddit", "month_label", "kind").agg(F.count(F.lit(1)).alias("n_parts"), F.count("hour_stamp").alias("n_recent"), F.max("part").alias("last_part"))


def fingerprint(spark, d):
    return collection.fingerprints(table(spark, d, "raw_objects"))


def stale_partitions(spark, d):
    """Partitions that a build of what had been uploaded before 2023 would have to do again."""
    objects = table(spark, d, "raw_objects")
    keys = ["subreddit", "month_label", "kind"]
    held = collection.fingerprints(objects.filter(F.col("uploaded_at") < F.lit("2023-01-01").cast("timestamp")))
    return collection.stale(collection.fingerprints(objects), held, keys).select(*keys)


def stale_parts(spark, d):
    objects = table(spark, d, "raw_objects")
    keys = ["subreddit", "month_label", "kind"]
    written = collection.parsed_keys(objects).filter("hour_stamp IS NULL").groupBy(*keys).agg(F.max("part").alias("parts_written"), F.max("uploaded_at").alias("_at"))
    return collection.stale_parts(objects, written.withColumn("written_before", F.col("_at") + F.expr("INTERVAL 1 SECOND")))


def _receipts(spark: SparkSession, d: str) -> DataFrame:
    """Receipts as a collector of the stored deliveries would have left them at the end of 2024."""
    rows = _deliveries(spark, d).withColumn("kind", F.concat("kind", F.lit("s")))
    tally = collection.settlement(rows, ["subreddit", "month_label", "kind"], F.lit(AT))
    legacy = F.col("month_label") < "2022-01"
    return tally.select("subreddit", "month_label", "kind", F.lit("2025-01-01T00:00:00Z").alias("collected_at"), F.lit(1).cast("long").alias("keys_written"), "rows", F.lit(0).cast("long").alias("seconds_unproven"), F.when(~legacy, F.col("rows_unsettled")).alias("rows_unsettled"))


def open_partitions(spark, d):
    return collection.open_partitions(_receipts(spark, d), AT)


def run_totals(spark, d):
    return collection.run_totals(_receipts(spark, d))


def months_left_receipts(spark, d):
    """Stored rows per partition beside the collector's receipt of it."""
    counts = _items(spark, d, "subreddit", "month_label").groupBy("subreddit", "month_label", F.concat("kind", F.lit("s")).alias("kind")).agg(F.count(F.lit(1)).alias("stored"))
    return counts.join(_receipts(spark, d).select("subreddit", "month_label", "kind", "rows", "rows_unsettled"), ["subreddit", "month_label", "kind"], "left")


def raw_types(spark, d):
    """Lenient typing of polymorphic fields, record by record."""
    docs = table(spark, d, "raw_records").select("file_key", "line_no", F.try_parse_json("record_json").alias("doc"))
    doc = F.col("doc")
    return docs.select(
        "file_key", "line_no", clean.int_at(doc, "$.created_utc").alias("created_utc"), clean.int_at(doc, "$.score", "int").alias("score"), clean.was_edited(doc).alias("edited"),
        clean.stamp_at(doc).alias("stamp"), clean.is_stamped(doc).alias("is_stamped"), clean.has_settled_engagement(doc).alias("settled"), clean.has_settled_engagement(doc, by_key=True).alias("settled_by_key"),
    )


def series_json(spark, d):
    full = _series(spark, d).withColumns({c: F.lit(None).cast("double") for c in ("pct_pos", "pct_neg")})
    docs = reports.series_document(materialize(full, "series"), VENUE, {"lexicon": "seed-1", "tags": "tags-1"}, AT)
    return docs.select("subreddit", F.to_json(F.struct(*[c for c in docs.columns if c != "subreddit"])).alias("document"))


def tags_json(spark, d):
    docs = reports.tags_document(materialize(series.tag_daily(_joined(spark, d)), "tag-daily"), VENUE, AT)
    return docs.select("subreddit", F.to_json(F.struct("asof", "generated_at", "tags")).alias("document"))


def stream_merge(spark, d):
    """Both kinds replayed file by file through the streaming merge."""
    from larkspur.plans.general import _delivery_order
    from larkspur.streaming.merge import merge_stream, merged

    out = None
    for name, kind in (("posts", "post"), ("comments", "comment")):
        files = table(spark, d, name)
        reader = spark.readStream.schema(files.schema).option("maxFilesPerTrigger", 8)
        # A table of one file is found by its name in its folder, one of several is a folder.
        single = all(f.rstrip("/").endswith(f"/{name}.parquet") for f in files.inputFiles())
        stream = reader.option("pathGlobFilter", f"{name}.parquet").parquet(d) if single else reader.parquet(f"{d}/{name}.parquet")
        path = fresh_path(spark, "stream")
        merge_stream(stream, f"{path}/store", ["id"], _delivery_order, "month_label", f"{path}/checkpoint").awaitTermination()
        own = merged(spark, f"{path}/store", ["id"], _delivery_order(), "month_label").select(F.lit(kind).alias("kind"), "id", "score", "created_utc", "retrieved_2nd_on", "batch_key", "line_no", "n_copies")
        out = own if out is None else out.unionByName(own)
    return out


def receipt_names(spark, d):
    return collection.receipt_keys(table(spark, d, "raw_objects"))


def enrich_fingerprint(spark, d):
    """Fingerprints of the enrichment layer: object and configuration version together."""
    parts = collection.parsed_keys(table(spark, d, "raw_objects"))
    return parts.select("object_key", collection.enrich_fingerprint(F.col("etag"), F.lit("seed-1+tags-1")).alias("fingerprint"))


def last_score_agreement(spark, d):
    """Labels of the first enrichment version against the last stored one of each record."""
    rows = table(spark, d, "enrich").filter("id IS NOT NULL AND kind IS NOT NULL").select(F.concat_ws("/", "kind", "id").alias("doc_id"), "enrich_version", _level_sql(F.col("vader_compound"), (-0.6, -0.05, 0.05, 0.6)).alias("level"))
    gold = rows.groupBy("doc_id").agg(F.min(F.struct("enrich_version", "level")).alias("g")).select("doc_id", F.col("g.level").alias("gold"))
    scored = evaluate.last_score(rows, "doc_id", "enrich_version").withColumnRenamed("level", "scored")
    return evaluate.agreement(gold.join(scored, "doc_id"))


def teacher_slices(spark, d):
    """Sampled items per slice, those already enriched left out."""
    free = threads.without(_items(spark, d, "created_utc"), _enriched(spark, d).filter("size(tags) > 1"), ["kind", "id"])
    return sampling.slices(free, {"spike": ("2024-01-15", "2024-02-01", 200), "calm": ("2023-05-01", "2023-07-01", 100)}, 400)


def range_presets(spark, d):
    """Days and items of each venue's series within the display ranges."""
    s = _series(spark, d)
    last = s.groupBy("subreddit").agg(F.max("date").alias("last"))
    both = s.join(last, "subreddit")
    parts = []
    for name in ("1M", "3M", "6M", "1Y", "ALL"):
        inside = F.coalesce(F.col("date") >= times.range_start(F.col("last"), name), F.lit(True))
        parts.append(both.filter(inside).groupBy("subreddit").agg(F.lit(name).alias("preset"), F.count(F.lit(1)).alias("days"), F.sum(F.col("num_posts") + F.col("num_comments")).alias("items")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def measured_change(spark, d):
    """Change of each venue's comments between the days nearest to two instants."""
    s = _series(spark, d).select("subreddit", F.datediff("date", F.lit("1970-01-01").cast("date")).alias("t"), F.col("num_comments").cast("double").alias("v"))
    venues = s.select("subreddit").distinct()
    at = lambda day: asof.nearest(venues.withColumn("t", F.datediff(F.lit(day).cast("date"), F.lit("1970-01-01").cast("date"))), s, VENUE, "t", "v", bucket=400)
    ends = at("2023-01-15").select("subreddit", F.col("nearest_value").alias("a")).join(at("2024-06-15").select("subreddit", F.col("nearest_value").alias("b")), "subreddit")
    change = asof.measured(F.col("a"), F.col("b"))
    return ends.select("subreddit", change["delta"].alias("delta"), F.round(change["pct"], 6).alias("pct"))


def distilled_lexicon(spark, d):
    """Thresholds and scale of the lexicon learned from posts and comments, with its size."""
    banned = fit.entity_tokens([t.text for tag in taxonomy.default() for t in tag.terms]) + sorted({*sentiment.DEGREES, *sentiment.NEGATIONS})
    best = fit.distill(materialize(_bodies(spark, d), "docs"), sentiment.SEED, banned, fit.SCALES, fit.grid(fit.DISTILL_BAND, [-x for x in fit.DISTILL_BAND], [2.0]), least_docs=20, least=0.02)
    rows = [] if best is None else [(best["scale"], best["pos"], best["neg"], best["neu_min"], best["accuracy"], len(best["lexicon"]))]
    return spark.createDataFrame(rows, "scale double, pos double, neg double, neu_min double, accuracy double, n_words int")


QUERIES = {
    f.__name__: f
    for f in (
        daily_activity, daily_sentiment, tag_daily, tag_weekly, tag_summary, series_receipt, counts_by_month, dedup_priority, rolling_7d_mean, trailing_zscore, gauge_latest,
        volume_changes, analog_window, rebase_100, lag_change, nearest_comment, overlay_window, thread_context, semi_teacher, anti_holdout, date_range, text_clean, text_join,
        regex_tags, word_length_era, text_views, polarity_labels, vader_scores, enrich_items, md5_per_year, md5_top_n, md5_parts, exact_within_one, confusion, kappa, kappa_three_way,
        tag_prf, histogram, validate_labels, quota_split, exemplars, allocate_strata, token_docfreq, token_association, top_terms, grid_argmax, project_raw, engagement_state,
        settlement_tally, discover_partitions, fingerprint, stale_partitions, stale_parts, open_partitions, run_totals, months_left_receipts, raw_types, series_json, tags_json, stream_merge,
        receipt_names, enrich_fingerprint, last_score_agreement, teacher_slices, range_presets, measured_change, distilled_lexicon,
    )
}
