"""Queries of the general data-processing problems (p1 to p6) and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators import drift, exactly_once, hierarchy, hotkeys, references, rolling
from larkspur.scratch import fresh_path
from larkspur.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return hotkeys.heavy_keys(table(spark, d, "comments"), ["link_id", "author"], percent=2).select("field_name", "key_value")


def p1_key_totals(spark: SparkSession, d: str) -> DataFrame:
    measures = {
        "n_rows": F.count(F.lit(1)), "n_items": F.count("id"), "sum_score": F.sum(F.col("score").cast("long")), "min_score": F.min("score"), "max_score": F.max("score"),
        "first_utc": F.min("created_utc"), "last_utc": F.max("created_utc"), "n_stamped": F.count("retrieved_2nd_on"),
    }
    out = hotkeys.combine_by_key(table(spark, d, "comments"), ["link_id", "author"], measures, ["id", "score", "created_utc", "retrieved_2nd_on"])
    return out.filter(F.col("key_value").isNotNull())


def _references(spark: SparkSession, d: str) -> DataFrame:
    comments, posts, enrich = (table(spark, d, t) for t in ("comments", "posts", "enrich"))
    refs = references.prefixed_references(comments, "comments", "comment", ["link_id", "parent_id"], "ingested_at", "month_label")
    own = enrich.filter(F.col("id").isNotNull()).select(
        F.lit("enrich").alias("table_name"), "kind", "id", F.lit("id").alias("field_name"), F.when(F.col("kind").isin("post", "comment"), F.col("kind")).alias("space"),
        F.col("id").alias("target"), F.lit(None).cast("timestamp").alias("arrived"), F.col("month_label").alias("period"),
    )
    removed = F.col("removal_category").isNotNull()
    parents = references.parent_intervals(comments, "comment", "ingested_at", removed).unionByName(references.parent_intervals(posts, "post", "ingested_at", removed))
    return references.resolve(refs.unionByName(own), parents)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _references(spark, d).filter(F.col("status") == "missing").select("table_name", "kind", "id", "field_name").distinct()


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    return references.dangling_report(_references(spark, d))


def _delivery_order() -> list[Column | str]:
    """A settled copy beats a provisional one; then the later stamp, the later creation time, the first seen."""
    return [F.col("retrieved_2nd_on").isNotNull(), "retrieved_2nd_on", "created_utc", -F.unix_micros("ingested_at"), "batch_key", "line_no"]


def _deliver(spark: SparkSession, d: str, incoming_days: int = 90) -> DataFrame:
    """History first, then the last ``incoming_days`` of deliveries, through one store per kind."""
    out = []
    for name, kind in (("posts", "post"), ("comments", "comment")):
        rows = table(spark, d, name)
        last = rows.agg(F.max("ingested_at")).collect()[0][0]
        store = exactly_once.MessageStore(spark, fresh_path(spark, f"messages-{kind}"), ["id"], _delivery_order(), "month_label", total_order=True)
        cut = F.col("ingested_at") > F.lit(last) - F.make_dt_interval(F.lit(incoming_days))
        store.apply(rows.filter(~F.coalesce(cut, F.lit(False))), "history")
        store.apply(rows.filter(F.coalesce(cut, F.lit(False))), "incoming")
        out.append(store.read().withColumn("kind", F.lit(kind)))
    return reduce(DataFrame.unionByName, out)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _deliver(spark, d).filter(F.col("n_copies") > 1).select("kind", "id")


def p3_messages(spark: SparkSession, d: str) -> DataFrame:
    return _deliver(spark, d).select("kind", "id", "author", "created_utc", "score", "title", "selftext", "body", "parent_id", "link_id", "retrieved_2nd_on", "month_label", "batch_key", "line_no", "n_copies")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    comments = table(spark, d, "comments").select("id", "parent_id", "link_id")
    return hierarchy.hierarchy(comments, with_path=False, only_loops=True).select("id", "cycle_id")


def p4_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    comments = table(spark, d, "comments").select("id", "parent_id", "link_id")
    return hierarchy.hierarchy(comments)


def p4_paths(spark: SparkSession, d: str) -> DataFrame:
    return p4_hierarchy(spark, d).drop("entry", "exit")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.field_changes(table(spark, d, "raw_records")).select("file_key", "field_name")


def p5_steps(spark: SparkSession, d: str) -> DataFrame:
    return drift.migration_steps(table(spark, d, "raw_records"))


def p5_versions(spark: SparkSession, d: str) -> DataFrame:
    return drift.schema_versions(table(spark, d, "raw_records"))


def p5_table(spark: SparkSession, d: str) -> DataFrame:
    return drift.consistent_table(table(spark, d, "raw_records"))


def p5_rest(spark: SparkSession, d: str) -> DataFrame:
    """What the consistent table has no column for: per field and type its records and the first and last file."""
    rest = drift.unruled_fields(table(spark, d, "raw_records"))
    return rest.groupBy("field_name", F.coalesce(drift.variant_type(F.col("value")), F.lit("null")).alias("type")).agg(F.count(F.lit(1)).alias("n"), F.min("file_key").alias("first_file"), F.max("file_key").alias("last_file"))


def _daily(spark: SparkSession, d: str) -> DataFrame:
    counts = ["num_posts", "num_comments"]
    days = rolling.latest_edition(table(spark, d, "daily_sentiment"), ["subreddit"], "activity_date", "generated_at", counts)
    return rolling.densify(days, ["subreddit"], "activity_date", counts)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    days = _daily(spark, d).withColumn("n", F.col("num_posts") + F.col("num_comments")).drop("num_posts", "num_comments")
    totals = rolling.trailing_totals(days, ["subreddit"], "activity_date", ["n"], [7, 30])
    hit = (F.col("activity_date") >= F.date_add("first_day", 29)) & (F.col("n_30d") >= 20) & (10 * F.col("n_7d") >= 7 * F.col("n_30d"))
    return totals.filter(hit).select("subreddit", F.date_format("activity_date", "yyyy-MM-dd").alias("day_label"))


def p6_daily(spark: SparkSession, d: str) -> DataFrame:
    totals = rolling.trailing_totals(_daily(spark, d), ["subreddit"], "activity_date", ["num_posts", "num_comments"], [7, 30])
    means = {f"avg_{c}_{w}d": F.round(F.col(f"{c}_{w}d") / w, 4) for c in ("num_posts", "num_comments") for w in (7, 30)}
    return totals.withColumns(means).drop("first_day")


def p6_compound(spark: SparkSession, d: str) -> DataFrame:
    """Per subreddit and day, ``vader_compound`` of enrich dated by its item, over the last 7 and 30 days."""
    scored = table(spark, d, "enrich").filter(F.col("id").isNotNull()).groupBy("kind", "id").agg(F.max(F.struct("enrich_version", "vader_compound", "subreddit")).alias("e"))
    items = None
    for name, kind in (("posts", "post"), ("comments", "comment")):
        own = table(spark, d, name).filter(F.col("id").isNotNull()).groupBy("id").agg(F.min("created_utc").alias("created_utc")).select(F.lit(kind).alias("kind"), "id", "created_utc")
        items = own if items is None else items.unionByName(own)
    # Scores have at most four decimals: whole ten-thousandths add up exactly in any order.
    score = F.round(F.col("e.vader_compound") * 10000).cast("long")
    day = F.to_date(F.timestamp_seconds("created_utc"))
    days = scored.join(items, ["kind", "id"]).groupBy(F.col("e.subreddit").alias("subreddit"), day.alias("day")).agg(F.coalesce(F.sum(score), F.lit(0)).alias("score"), F.count(score).alias("n_scored"))
    dense = rolling.densify(days, ["subreddit"], "day", ["score", "n_scored"])
    totals = rolling.trailing_totals(dense, ["subreddit"], "day", ["score", "n_scored"], [7, 30])
    out = {f"sum_compound_{w}d": F.round(F.col(f"score_{w}d") / 10000, 4) for w in (7, 30)} | {f"avg_compound_{w}d": F.round(F.col(f"score_{w}d") / F.nullif(F.col(f"n_scored_{w}d"), F.lit(0)) / 10000, 10) for w in (7, 30)}
    return totals.withColumns(out).select("subreddit", "day", "n_scored_7d", "n_scored_30d", *out)


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_key_totals, p2_found, p2_report, p3_found, p3_messages, p4_found, p4_hierarchy, p4_paths, p5_found, p5_steps, p5_versions, p5_table, p5_rest, p6_found, p6_daily, p6_compound)
}

_REFS = """
WITH parents AS (
  SELECT 'comment' AS space, id AS target, min(ingested_at) AS valid_from, min(ingested_at) FILTER (WHERE removal_category IS NOT NULL) AS valid_to
  FROM comments WHERE id IS NOT NULL GROUP BY id
  UNION ALL
  SELECT 'post', id, min(ingested_at), min(ingested_at) FILTER (WHERE removal_category IS NOT NULL) FROM posts WHERE id IS NOT NULL GROUP BY id
), refs AS (
  SELECT 'comments' AS table_name, 'comment' AS kind, id, field_name, CASE substr(value, 1, 3) WHEN 't1_' THEN 'comment' WHEN 't3_' THEN 'post' END AS space,
         substr(value, 4) AS target, arrived, period
  FROM (SELECT id, 'link_id' AS field_name, link_id AS value, ingested_at AS arrived, month_label AS period FROM comments
        UNION ALL SELECT id, 'parent_id', parent_id, ingested_at, month_label FROM comments)
  WHERE id IS NOT NULL AND value IS NOT NULL
  UNION ALL
  SELECT 'enrich', kind, id, 'id', CASE WHEN kind IN ('post', 'comment') THEN kind END, id, NULL, month_label FROM enrich WHERE id IS NOT NULL
), resolved AS (
  SELECT r.*, CASE WHEN r.space IS NULL OR r.target IS NULL THEN 'malformed' WHEN p.target IS NULL THEN 'missing' WHEN r.arrived < p.valid_from THEN 'late'
                   WHEN r.arrived >= p.valid_to THEN 'deleted' ELSE 'ok' END AS status
  FROM refs r LEFT JOIN parents p ON r.space = p.space AND r.target = p.target
)"""

_WINNERS = """
SELECT '{kind}' AS kind, id, author, created_utc, score, title, selftext, body, parent_id, link_id, retrieved_2nd_on, month_label, batch_key, line_no, n_copies
FROM (SELECT *, count(*) OVER (PARTITION BY id) AS n_copies,
             row_number() OVER (PARTITION BY id ORDER BY (retrieved_2nd_on IS NOT NULL) DESC, retrieved_2nd_on DESC NULLS LAST, created_utc DESC NULLS LAST, ingested_at, batch_key DESC, line_no DESC) AS rn
      FROM {table} WHERE id IS NOT NULL) WHERE rn = 1"""

_TREES = """
WITH RECURSIVE nodes AS (SELECT id, min(CASE WHEN starts_with(parent_id, 't1_') THEN substr(parent_id, 4) END) AS parent FROM comments WHERE id IS NOT NULL GROUP BY id),
edges AS (SELECT a.id, a.parent FROM nodes a JOIN nodes b ON a.parent = b.id),
fine AS (SELECT id FROM nodes WHERE id NOT IN (SELECT id FROM edges) UNION SELECT e.id FROM edges e JOIN fine f ON e.parent = f.id),
caught AS (SELECT e.id, e.parent FROM edges e WHERE e.id NOT IN (SELECT id FROM fine)),
walk AS (SELECT id, parent AS seen FROM caught UNION SELECT w.id, c.parent FROM walk w JOIN caught c ON w.seen = c.id),
loops AS (SELECT id, min(seen) AS cycle_id FROM walk GROUP BY id HAVING bool_or(seen = id)),
caught_by AS (SELECT w.id, min(l.cycle_id) AS cycle_id FROM walk w JOIN loops l ON w.seen = l.id GROUP BY w.id)"""

_TOURED = """, cut AS (SELECT n.id, CASE WHEN n.id IN (SELECT id FROM loops) THEN NULL ELSE e.parent END AS up, e.parent FROM nodes n LEFT JOIN edges e ON e.id = n.id),
tree AS (SELECT id, id AS root, 0 AS depth, id AS path FROM cut WHERE up IS NULL UNION ALL SELECT c.id, t.root, t.depth + 1, t.path || '/' || c.id FROM cut c JOIN tree t ON c.up = t.id),
below AS (SELECT anc, count(*) - 1 AS n_descendants FROM (SELECT unnest(string_split(path, '/')) AS anc FROM tree) GROUP BY anc)"""

_STATES = """
WITH docs AS (SELECT file_key, record_json AS j FROM raw_records),
fields AS (SELECT file_key, k AS field_name, json_type(json_extract(j, '$."' || k || '"')) AS t FROM (SELECT file_key, j, unnest(json_keys(j)) AS k FROM docs)),
states AS (
  SELECT file_key, field_name, array_to_string(list_sort(list_distinct(list(CASE t WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' ELSE 'number' END) FILTER (WHERE t <> 'NULL'))), '+') AS state
  FROM fields GROUP BY file_key, field_name
), filled AS (SELECT file_key, field_name, coalesce(state, '') AS state FROM states),
files AS (
  SELECT file_key, lag(file_key) OVER (PARTITION BY regexp_extract(file_key, '^raw/([^/]+)/', 1), regexp_extract(file_key, '/(posts|comments)-', 1) ORDER BY file_key) AS prev_file
  FROM (SELECT DISTINCT file_key FROM raw_records)
), names AS (
  SELECT f.file_key, f.prev_file, s.field_name FROM files f JOIN filled s ON s.file_key = f.file_key WHERE prev_file IS NOT NULL
  UNION SELECT f.file_key, f.prev_file, s.field_name FROM files f JOIN filled s ON s.file_key = f.prev_file
), changes AS (
  SELECT n.file_key, n.field_name, coalesce(b.state, 'absent') AS before, coalesce(a.state, 'absent') AS after
  FROM names n LEFT JOIN filled a ON a.file_key = n.file_key AND a.field_name = n.field_name LEFT JOIN filled b ON b.file_key = n.prev_file AND b.field_name = n.field_name
  WHERE coalesce(b.state, 'absent') <> coalesce(a.state, 'absent')
)"""

_DENSE = """
WITH latest AS (
  SELECT subreddit, activity_date, num_posts, num_comments FROM (
    SELECT *, row_number() OVER (PARTITION BY subreddit, activity_date ORDER BY generated_at DESC NULLS LAST, num_posts DESC NULLS LAST, num_comments DESC NULLS LAST) AS rn
    FROM daily_sentiment WHERE subreddit IS NOT NULL AND activity_date IS NOT NULL) WHERE rn = 1
), bounds AS (SELECT subreddit, min(activity_date) AS lo, max(activity_date) AS hi FROM latest GROUP BY subreddit),
spine AS (SELECT subreddit, lo, CAST(unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day FROM bounds),
dense AS (
  SELECT s.subreddit, s.lo, s.day, coalesce(num_posts, 0) AS num_posts, coalesce(num_comments, 0) AS num_comments
  FROM spine s LEFT JOIN latest l ON l.subreddit = s.subreddit AND l.activity_date = s.day
), totals AS (
  SELECT subreddit, lo, day, num_posts, num_comments,
    sum(num_posts) OVER w7 AS p7, sum(num_posts) OVER w30 AS p30, sum(num_comments) OVER w7 AS c7, sum(num_comments) OVER w30 AS c30
  FROM dense WINDOW w7 AS (PARTITION BY subreddit ORDER BY day ROWS 6 PRECEDING), w30 AS (PARTITION BY subreddit ORDER BY day ROWS 29 PRECEDING)
)"""

SQL = {
    "p1_found": """
WITH total AS (SELECT count(*) AS n FROM comments),
counts AS (SELECT 'link_id' AS field_name, link_id AS key_value, count(*) AS n FROM comments GROUP BY link_id UNION ALL SELECT 'author', author, count(*) FROM comments GROUP BY author)
SELECT field_name, key_value FROM counts, total WHERE key_value IS NOT NULL AND counts.n * 100 >= total.n * 2""",
    "p1_key_totals": """
SELECT field_name, key_value, count(*) AS n_rows, count(id) AS n_items, CAST(sum(score) AS BIGINT) AS sum_score, min(score) AS min_score, max(score) AS max_score,
       min(created_utc) AS first_utc, max(created_utc) AS last_utc, count(retrieved_2nd_on) AS n_stamped
FROM (SELECT 'link_id' AS field_name, link_id AS key_value, * FROM comments UNION ALL SELECT 'author', author, * FROM comments)
WHERE key_value IS NOT NULL GROUP BY field_name, key_value""",
    "p2_found": _REFS + " SELECT DISTINCT table_name, kind, id, field_name FROM resolved WHERE status = 'missing'",
    "p2_report": _REFS
    + """, first AS (
  SELECT *, row_number() OVER (PARTITION BY table_name, kind, id, field_name ORDER BY coalesce(arrived, TIMESTAMPTZ '1970-01-01 00:00:00+00'), CASE WHEN status = 'ok' THEN 1 ELSE 0 END, period NULLS FIRST, status) AS rn
  FROM resolved)
SELECT table_name, period AS month_label, field_name, status, count(*) AS n_refs FROM first WHERE rn = 1 GROUP BY ALL""",
    "p3_found": """
SELECT 'post' AS kind, id FROM posts WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1
UNION ALL SELECT 'comment', id FROM comments WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1""",
    "p3_messages": _WINNERS.format(kind="post", table="posts") + " UNION ALL " + _WINNERS.format(kind="comment", table="comments"),
    "p4_found": _TREES + " SELECT * FROM caught_by",
    "p4_paths": _TREES + _TOURED + " SELECT t.id, c.parent, t.root, t.depth, b.n_descendants, t.path, k.cycle_id FROM tree t JOIN cut c ON c.id = t.id JOIN below b ON b.anc = t.id LEFT JOIN caught_by k ON k.id = t.id",
    "p4_hierarchy": _TREES
    + _TOURED
    + """, ahead AS (SELECT c.id, c.up, coalesce(sum(2 * (b.n_descendants + 1)) OVER (PARTITION BY c.up ORDER BY c.id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM cut c JOIN below b ON b.anc = c.id),
tour AS (SELECT id, CAST(0 AS BIGINT) AS entry FROM cut WHERE up IS NULL UNION ALL SELECT a.id, t.entry + 1 + CAST(a.before AS BIGINT) FROM ahead a JOIN tour t ON a.up = t.id)
SELECT t.id, c.parent, t.root, t.depth, b.n_descendants, o.entry, o.entry + 2 * b.n_descendants + 1 AS exit, t.path, k.cycle_id
FROM tree t JOIN cut c ON c.id = t.id JOIN below b ON b.anc = t.id JOIN tour o ON o.id = t.id LEFT JOIN caught_by k ON k.id = t.id""",
    "p5_found": _STATES + " SELECT file_key, field_name FROM changes",
    "p6_found": _DENSE + " SELECT subreddit, strftime(day, '%Y-%m-%d') AS day_label FROM totals WHERE day >= lo + 29 AND p30 + c30 >= 20 AND 10 * (p7 + c7) >= 7 * (p30 + c30)",
    "p6_daily": _DENSE
    + """ SELECT subreddit, day AS activity_date, num_posts, num_comments, CAST(p7 AS BIGINT) AS num_posts_7d, CAST(c7 AS BIGINT) AS num_comments_7d, CAST(p30 AS BIGINT) AS num_posts_30d, CAST(c30 AS BIGINT) AS num_comments_30d,
  round(p7 / 7.0::DOUBLE, 4) AS avg_num_posts_7d, round(p30 / 30.0::DOUBLE, 4) AS avg_num_posts_30d, round(c7 / 7.0::DOUBLE, 4) AS avg_num_comments_7d, round(c30 / 30.0::DOUBLE, 4) AS avg_num_comments_30d FROM totals""",
    "p6_compound": """
WITH scored AS (
  SELECT kind, id, vader_compound, subreddit FROM (
    SELECT *, row_number() OVER (PARTITION BY kind, id ORDER BY enrich_version DESC NULLS LAST, vader_compound DESC NULLS LAST, subreddit DESC NULLS LAST) AS rn FROM enrich WHERE id IS NOT NULL) WHERE rn = 1
), items AS (SELECT 'post' AS kind, id, min(created_utc) AS c FROM posts WHERE id IS NOT NULL GROUP BY id UNION ALL SELECT 'comment', id, min(created_utc) FROM comments WHERE id IS NOT NULL GROUP BY id),
days AS (
  SELECT s.subreddit, CAST(make_timestamp(c * 1000000) AS DATE) AS day, CAST(coalesce(sum(CAST(round(vader_compound * 10000) AS BIGINT)), 0) AS BIGINT) AS score, count(vader_compound) AS n
  FROM scored s JOIN items i ON s.kind = i.kind AND s.id = i.id GROUP BY ALL
), bounds AS (SELECT subreddit, min(day) AS lo, max(day) AS hi FROM days WHERE day IS NOT NULL AND subreddit IS NOT NULL GROUP BY subreddit),
spine AS (SELECT subreddit, CAST(unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day FROM bounds),
dense AS (SELECT s.subreddit, s.day, coalesce(score, 0) AS score, coalesce(n, 0) AS n FROM spine s LEFT JOIN days d ON d.subreddit = s.subreddit AND d.day = s.day),
totals AS (
  SELECT subreddit, day, sum(score) OVER w7 AS s7, sum(score) OVER w30 AS s30, sum(n) OVER w7 AS n7, sum(n) OVER w30 AS n30
  FROM dense WINDOW w7 AS (PARTITION BY subreddit ORDER BY day ROWS 6 PRECEDING), w30 AS (PARTITION BY subreddit ORDER BY day ROWS 29 PRECEDING)
)
SELECT subreddit, day, CAST(n7 AS BIGINT) AS n_scored_7d, CAST(n30 AS BIGINT) AS n_scored_30d, round(s7 / 10000.0::DOUBLE, 4) AS sum_compound_7d, round(s30 / 10000.0::DOUBLE, 4) AS sum_compound_30d,
  round(s7 / nullif(n7, 0)::DOUBLE / 10000, 10) AS avg_compound_7d, round(s30 / nullif(n30, 0)::DOUBLE / 10000, 10) AS avg_compound_30d FROM totals""",
    "p5_steps": _STATES
    + """, canon AS (
  SELECT *, CASE field_name WHEN 'removal_reason' THEN 'removed_by_category' WHEN 'retrieved_utc' THEN 'retrieved_on' ELSE field_name END AS canonical FROM changes
), swaps AS (SELECT file_key, canonical, bool_or(after = 'absent') AND bool_or(before = 'absent') AS swap FROM canon GROUP BY ALL)
SELECT c.file_key, field_name, CASE WHEN swap AND (after = 'absent' OR before = 'absent') THEN 'renamed' WHEN after = 'absent' THEN 'removed' WHEN before = 'absent' THEN 'added' ELSE 'retyped' END AS step, before, after
FROM canon c JOIN swaps s ON c.file_key = s.file_key AND c.canonical = s.canonical""",
}


_NUMERIC = ("UBIGINT", "BIGINT", "DOUBLE")


def _rule_sql(rule: drift.FieldRule) -> str:
    picks = []
    for name in (rule.name, *rule.renamed_from):
        kind, text = f"json_type(j, '$.{name}')", f"json_extract_string(j, '$.{name}')"
        scalar = f"{kind} IN ('VARCHAR', 'UBIGINT', 'BIGINT', 'DOUBLE')"
        number = f"CASE WHEN {scalar} THEN TRY_CAST({text} AS DOUBLE) END"
        picks.append({
            "string": f"CASE WHEN {scalar} THEN {text} END",
            "boolean": f"CASE WHEN {kind} = 'BOOLEAN' THEN CAST({text} AS BOOLEAN) WHEN {kind} IN {_NUMERIC} THEN CAST({text} AS DOUBLE) > 0 END",
            "double": number,
            "bigint": f"TRY_CAST(trunc({number}) AS BIGINT)",
        }[rule.kind])
    if rule.default is not None:
        picks.append(str(rule.default).upper())
    return f"coalesce({', '.join([*picks, 'NULL'])}) AS {rule.name}"


_DEFAULTS = [r.name for r in drift.RULES if r.default is not None]
_OLDER = {old: r for r in drift.RULES for old in r.renamed_from}
_NATURAL = {r.name: drift.NATURAL[r.kind] for r in drift.RULES} | {o: drift.NATURAL[r.kind] for o, r in _OLDER.items()}
_RENAMED = "CASE field_name " + " ".join(f"WHEN '{o}' THEN 'rename:{o}>{r.name}'" for o, r in _OLDER.items()) + " END"
_CASTS = "CASE WHEN state NOT IN ('', CASE field_name " + " ".join(f"WHEN '{n}' THEN '{t}'" for n, t in _NATURAL.items()) + " ELSE state END) THEN 'cast:' || field_name END"

_RULED = ", ".join(f"'{n}'" for r in drift.RULES for n in (r.name, *r.renamed_from))
_CASTS_META = "CASE WHEN field_name = '_meta' AND state NOT IN ('', 'object') THEN 'cast:_meta' END"
_CASTS = f"coalesce({_CASTS}, {_CASTS_META})"

SQL |= {
    "p5_rest": f"""SELECT k AS field_name, CASE json_type(v) WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'NULL' THEN 'null' ELSE 'number' END AS type,
  count(*) AS n, min(file_key) AS first_file, max(file_key) AS last_file
FROM (SELECT file_key, k, json_extract(j, '$."' || k || '"') AS v FROM (SELECT file_key, record_json AS j, unnest(json_keys(record_json)) AS k FROM raw_records WHERE file_key IS NOT NULL)) WHERE k NOT IN ({_RULED}) GROUP BY ALL""",
    # _meta is read by its own text: an object as it stands, a string by what it says if that is an object.
    "p5_table": f"""SELECT file_key, line_no, {", ".join(map(_rule_sql, drift.RULES))},
  CASE WHEN json_type(m, '$.retrieved_2nd_on') IN ('VARCHAR', 'UBIGINT', 'BIGINT', 'DOUBLE') THEN TRY_CAST(trunc(TRY_CAST(m->>'$.retrieved_2nd_on' AS DOUBLE)) AS BIGINT) END AS retrieved_2nd_on,
  CASE WHEN json_type(m, '$.is_edited') = 'BOOLEAN' THEN CAST(m->>'$.is_edited' AS BOOLEAN) WHEN json_type(m, '$.is_edited') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST(m->>'$.is_edited' AS DOUBLE) > 0 END AS is_edited
FROM (SELECT *, CASE WHEN json_type(j, '$._meta') = 'OBJECT' THEN json_extract(j, '$._meta') WHEN json_type(j, '$._meta') = 'VARCHAR' AND json_valid(j->>'$._meta') THEN (j->>'$._meta')::JSON END AS m
      FROM (SELECT file_key, line_no, record_json::JSON AS j FROM raw_records WHERE file_key IS NOT NULL))""",
    "p5_versions": _STATES
    + f""", marked AS (
  SELECT file_key, list_sort(list(field_name || ':' || state)) AS states, list_sort(list({_RENAMED}) FILTER (WHERE {_RENAMED} IS NOT NULL)) AS renames, list_sort(list({_CASTS}) FILTER (WHERE {_CASTS} IS NOT NULL)) AS casts, list(field_name) AS names
  FROM filled GROUP BY file_key
), printed AS (
  SELECT file_key, regexp_extract(file_key, '^raw/([^/]+)/', 1) AS venue, regexp_extract(file_key, '/(posts|comments)-', 1) AS kind, sha256(array_to_string(states, chr(10))) AS fingerprint,
    list_concat(list_sort(list_concat(coalesce(renames, []), coalesce(casts, []))), list_filter([{", ".join(f"CASE WHEN NOT list_contains(names, '{n}') THEN 'default:{n}' END" for n in _DEFAULTS)}], lambda x: x IS NOT NULL)) AS steps FROM marked
), moved AS (SELECT *, CASE WHEN lag(fingerprint) OVER w IS DISTINCT FROM fingerprint THEN 1 ELSE 0 END AS moved FROM printed WINDOW w AS (PARTITION BY venue, kind ORDER BY file_key))
SELECT file_key, venue, kind, fingerprint, CAST(sum(moved) OVER (PARTITION BY venue, kind ORDER BY file_key) AS BIGINT) AS version, array_to_string(steps, ';') AS steps FROM moved""",
}
