"""The SQL that checks the queries of ``forum``."""

from __future__ import annotations

from larkspur.functions import text
from larkspur.operators.fit import GRID_NEG, GRID_NEU, GRID_POS
from larkspur.plans.forum import AT
from larkspur.sources import taxonomy

_COMMON = "subreddit, month_label, id, author, created_utc, score, title, selftext, body, parent_id, link_id, removal_category, engagement_settled, retrieved_2nd_on, ingested_at, batch_key, line_no"
_ALL = f"all_rows AS (SELECT 'post' AS kind, {_COMMON} FROM posts UNION ALL SELECT 'comment', {_COMMON} FROM comments)"
_ITEMS = f"""{_ALL}, items AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kind, id ORDER BY (retrieved_2nd_on IS NOT NULL) DESC, ingested_at NULLS LAST, batch_key NULLS LAST, line_no NULLS LAST) AS rn FROM all_rows WHERE id IS NOT NULL) WHERE rn = 1)"""
_ENRICHED = """enriched AS (
  SELECT kind, id, enrich_version, vader_compound, vader_label, tags FROM (
    SELECT *, row_number() OVER (PARTITION BY kind, id ORDER BY enrich_version DESC NULLS LAST, vader_compound DESC NULLS LAST, vader_label DESC NULLS LAST, tags DESC NULLS LAST) AS rn
    FROM (SELECT kind, id, enrich_version, vader_compound, vader_label, list_sort(list_filter(list_distinct(tags), lambda t: t IS NOT NULL)) AS tags FROM enrich WHERE id IS NOT NULL)) WHERE rn = 1)"""
_DAY = "CAST(make_timestamp(created_utc * 1000000) AS DATE)"
_JOINED = f"{_ITEMS}, {_ENRICHED}, joined AS (SELECT i.subreddit, {_DAY} AS day, i.kind, author, tags, vader_compound, vader_label FROM items i JOIN enriched e ON i.kind = e.kind AND i.id = e.id)"


def _filled(source: str, key: str, day: str, zero: list[str], rest: list[str]) -> str:
    values = ", ".join([f"coalesce(x.{c}, 0) AS {c}" for c in zero] + [f"x.{c}" for c in rest])
    return f"""SELECT s.{key}, s.day AS date, {values} FROM (
  SELECT {key}, CAST(unnest(generate_series(min({day})::TIMESTAMP, max({day})::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day FROM {source} WHERE {day} IS NOT NULL GROUP BY {key}
) s LEFT JOIN {source} x ON x.{key} IS NOT DISTINCT FROM s.{key} AND x.{day} = s.day"""


_COUNTS = "count(*) FILTER (WHERE kind = 'post') AS num_posts, count(*) FILTER (WHERE kind = 'comment') AS num_comments"
_SHARE = "round(count(*) FILTER (WHERE vader_label = '{0}') / nullif(count(vader_compound), 0)::DOUBLE, 4) AS pct_{0}"
_TAG_DAILY = f"""{_JOINED}, tag_rows AS (SELECT subreddit, day, unnest(tags) AS tag, kind, vader_compound, vader_label FROM joined),
tag_daily AS (SELECT subreddit, day AS date, tag, count(*) AS num_items, {_COUNTS}, round(sum(CAST(round(vader_compound * 10000) AS BIGINT)) / nullif(count(vader_compound), 0)::DOUBLE) / 10000 AS mean_compound, {_SHARE.format('pos')}, {_SHARE.format('neg')} FROM tag_rows GROUP BY ALL)"""

_SERIES = f"""latest AS (
  SELECT subreddit, activity_date, num_posts, num_comments, num_unique_authors, num_scored, mean_compound FROM (
    SELECT *, row_number() OVER (PARTITION BY subreddit, activity_date ORDER BY generated_at DESC NULLS LAST, num_posts DESC NULLS LAST, num_comments DESC NULLS LAST, num_unique_authors DESC NULLS LAST, num_scored DESC NULLS LAST, mean_compound DESC NULLS LAST) AS rn
    FROM daily_sentiment) WHERE rn = 1),
series AS ({_filled('latest', 'subreddit', 'activity_date', ['num_posts', 'num_comments', 'num_unique_authors', 'num_scored'], ['mean_compound'])})"""


def _zscores(source: str, keys: str, values: dict[str, str]) -> str:
    """CTEs ``means`` (with short means) and ``scores`` (with z) over a source that has ``date`` and the keys."""
    means = ", ".join(f"CASE WHEN row_number() OVER w >= 7 THEN round(avg({v}) OVER (w ROWS 6 PRECEDING), 12) END AS {n}_7d" for n, v in values.items())
    zs = ", ".join(
        f"CASE WHEN {n}_7d IS NOT NULL AND count({n}_7d) OVER b >= 60 THEN CASE WHEN min({n}_7d) OVER b = max({n}_7d) OVER b THEN 0.0 ELSE ({n}_7d - avg({n}_7d) OVER b) / stddev_pop({n}_7d) OVER b END END AS {n}_z"
        for n in values
    )
    means = means.replace("OVER (w ROWS", f"OVER (PARTITION BY {keys} ORDER BY date ROWS").replace("OVER w", f"OVER (PARTITION BY {keys} ORDER BY date)")
    return f"means AS (SELECT *, {means} FROM {source}), scores AS (SELECT *, {zs} FROM means WINDOW b AS (PARTITION BY {keys} ORDER BY date ROWS 364 PRECEDING))"


_STANDING = f"""{_SERIES}, based AS (
  SELECT * FROM (SELECT subreddit, date, num_posts + num_comments AS items, mean_compound, max(date) OVER (PARTITION BY subreddit) - 2 AS upto FROM series) WHERE date <= upto),
{_zscores('based', 'subreddit', {'volume': 'ln(1 + items)', 'sentiment': 'mean_compound'})}"""
_BAND = "CASE WHEN {0} <= -1.5 THEN 'peak despair' WHEN {0} <= -0.5 THEN 'despondent' WHEN {0} < 0.5 THEN 'neutral' WHEN {0} < 1.5 THEN 'excited' WHEN {0} IS NOT NULL THEN 'peak exuberance' END"
_LEVEL = "CASE WHEN {0} <= {1} THEN -2 WHEN {0} <= {2} THEN -1 WHEN {0} < {3} THEN 0 WHEN {0} < {4} THEN 1 WHEN {0} IS NOT NULL THEN 2 END"
_RATED = f"""{_ITEMS}, {_ENRICHED}, rated AS (
  SELECT i.kind, i.id, e.tags, e.vader_compound, e.vader_label, {_LEVEL.format('e.vader_compound', -0.6, -0.05, 0.05, 0.6)} AS gold, {_LEVEL.format('i.score', -5, -1, 3, 20)} AS scored
  FROM items i JOIN enriched e ON i.kind = e.kind AND i.id = e.id)"""
_KAPPA = """SELECT round(CASE WHEN abs(chance) < 1e-12 THEN 1.0 ELSE 1 - seen / chance END, 6) AS kappa FROM (
  SELECT avg((g - s) ** 2) AS seen, avg(g * g) - 2 * avg(g) * avg(s) + avg(s * s) AS chance FROM (SELECT {0}::DOUBLE AS g, {1}::DOUBLE AS s FROM rated) WHERE g IS NOT NULL AND s IS NOT NULL)"""
_BODY_TEXT = "CASE WHEN i.kind = 'post' THEN concat_ws(chr(10) || chr(10), nullif(title, ''), nullif(selftext, '')) ELSE coalesce(body, '') END"


def _tag_list(x: str) -> str:
    hits = []
    for tag in taxonomy.default():
        pattern = text.tag_pattern(tag).replace("'", "''")
        hits.append(f"CASE WHEN regexp_matches({x}, '{pattern}') THEN '{tag.key}' END")
    return f"list_filter([{', '.join(hits)}], lambda t: t IS NOT NULL)"


_DOCS = f"""{_ITEMS}, {_ENRICHED}, docs AS (
  SELECT i.id, lower(CASE WHEN i.kind = 'post' THEN concat_ws(chr(10) || chr(10), nullif(title, ''), nullif(selftext, '')) ELSE body END) AS text, CAST(sign(round(vader_compound, 1)) AS INTEGER) AS y
  FROM items i JOIN enriched e ON i.kind = e.kind AND i.id = e.id WHERE (i.kind = 'post' OR body IS NOT NULL) AND vader_compound IS NOT NULL),
freq AS (
  SELECT token, count(*) AS n, count(*) FILTER (WHERE y > 0) AS n_pos, count(*) FILTER (WHERE y < 0) AS n_neg
  FROM (SELECT y, unnest(list_distinct(regexp_extract_all(text, '[a-z][a-z''’\\-]{{1,24}}'))) AS token FROM docs) GROUP BY token),
rates AS (SELECT avg((y > 0)::INTEGER) AS pp, avg((y < 0)::INTEGER) AS pn FROM docs),
assoc AS (SELECT token, n, (n_pos + 30 * pp) / (n + 30) - (n_neg + 30 * pn) / (n + 30) - (pp - pn) AS association FROM freq, rates)"""
_RAW_KEY = "^raw/([^/]+)/([0-9]{4}-(?:0[1-9]|1[0-2]))/(posts|comments)-(?:recent-([0-9]{8}T[0-9]{2})-)?part-([0-9]{4,})\\.jsonl\\.gz$"
_PARTS = f"""parts AS (SELECT *, regexp_extract(object_key, '{_RAW_KEY}', 1) AS subreddit, regexp_extract(object_key, '{_RAW_KEY}', 2) AS month_label, regexp_extract(object_key, '{_RAW_KEY}', 3) AS kind,
  nullif(regexp_extract(object_key, '{_RAW_KEY}', 4), '') AS hour_stamp, CAST(regexp_extract(object_key, '{_RAW_KEY}', 5) AS INTEGER) AS part FROM raw_objects WHERE regexp_matches(object_key, '{_RAW_KEY}'))"""
_PRINTS = "SELECT subreddit, month_label, kind, count(*) AS n_objects, sha256(array_to_string(list_sort(list(object_key || ':' || etag || ':' || size_bytes)), chr(10))) AS fingerprint FROM {0} GROUP BY ALL"
_STATE = f"CASE WHEN coalesce(engagement_settled, FALSE) THEN 'settled' WHEN {AT} - created_utc > 720 * 3600 THEN 'abandoned' ELSE 'pending' END"
_TALLY = f"""tally AS (
  SELECT subreddit, month_label, kind, count(*) AS rows, max(created_utc) AS last_created_utc, count(*) FILTER (WHERE s = 'pending') AS rows_unsettled,
    coalesce(min(created_utc) FILTER (WHERE s = 'pending'), 0) AS oldest_unsettled_created_utc, count(*) FILTER (WHERE s = 'abandoned') AS rows_abandoned
  FROM (SELECT *, {_STATE} AS s FROM all_rows) GROUP BY ALL)"""
_RECEIPTS = f"""{_ITEMS}, {_TALLY}, receipts AS (
  SELECT subreddit, month_label, kind || 's' AS kind, rows, CASE WHEN month_label < '2022-01' THEN NULL ELSE rows_unsettled END AS rows_unsettled FROM tally)"""
_JSON_NUMBER = "json_type(j, '{0}') IN ('UBIGINT', 'BIGINT', 'DOUBLE')"


def _number(path: str) -> str:
    return f"CASE WHEN {_JSON_NUMBER.format(path)} THEN CAST(json_extract(j, '{path}') AS DOUBLE) END"


def _settled(stamp: str) -> str:
    arms = [f"{_number('$.created_utc')} < 1688169600", stamp, f"{_number('$.score')} <> 1", f"{_number('$.num_comments')} <> 0", f"{_number('$.upvote_ratio')} <> 1"]
    return " OR ".join(f"coalesce({a}, FALSE)" for a in arms)


_GRID = ", ".join(f"({i}, {p}, {n}, {u})" for i, (p, n, u) in enumerate((p, n, u) for p in GRID_POS for n in GRID_NEG for u in GRID_NEU))
_KEYS = ["ORE_SPOT", "ORE_TERM", "ENRICHMENT", "NEW_BUILD", "RESTART", "MEME"]

SQL = {
    "daily_activity": f"""WITH {_ITEMS}, daily AS (SELECT subreddit, {_DAY} AS day, {_COUNTS}, count(DISTINCT author) AS num_unique_authors FROM items GROUP BY ALL)
{_filled('daily', 'subreddit', 'day', ['num_posts', 'num_comments', 'num_unique_authors'], [])}""",
    "daily_sentiment": f"""WITH {_JOINED}, daily AS (
  SELECT subreddit, day, {_COUNTS}, count(DISTINCT author) AS num_unique_authors, count(vader_compound) AS num_scored, round(sum(CAST(round(vader_compound * 10000) AS BIGINT)) / nullif(count(vader_compound), 0)::DOUBLE) / 10000 AS mean_compound, round(median(CAST(round(vader_compound * 10000) AS BIGINT))) / 10000 AS median_compound,
    {_SHARE.format('pos')}, {_SHARE.format('neg')}, {_SHARE.format('neu')} FROM joined GROUP BY ALL)
{_filled('daily', 'subreddit', 'day', ['num_posts', 'num_comments', 'num_unique_authors', 'num_scored'], ['mean_compound', 'median_compound', 'pct_pos', 'pct_neg', 'pct_neu'])}""",
    "tag_daily": f"WITH {_TAG_DAILY} SELECT * FROM tag_daily",
    "tag_weekly": f"""WITH {_TAG_DAILY} SELECT subreddit, tag, CAST(date_trunc('week', date) AS DATE) AS week, CAST(sum(num_items) AS BIGINT) AS items,
  round(sum(CAST(round(mean_compound * 10000) AS BIGINT) * num_items) / (sum(num_items) FILTER (WHERE mean_compound IS NOT NULL))::DOUBLE) / 10000 AS mean_compound FROM tag_daily GROUP BY ALL""",
    "tag_summary": f"""WITH {_TAG_DAILY}, dated AS (SELECT *, max(date) OVER (PARTITION BY subreddit) - 2 AS upto FROM tag_daily),
sums AS (SELECT subreddit, tag, upto, CAST(coalesce(sum(num_items) FILTER (WHERE date <= upto AND date > upto - 7), 0) AS BIGINT) AS items_7d, coalesce(sum(num_items) FILTER (WHERE date <= upto AND date > upto - 90), 0) AS base,
  round((sum(CAST(round(mean_compound * 10000) AS BIGINT) * num_items) FILTER (WHERE date <= upto AND date > upto - 7)) / nullif(sum(num_items) FILTER (WHERE date <= upto AND date > upto - 7 AND mean_compound IS NOT NULL), 0)::DOUBLE) / 10000 AS sent_7d, min(date) AS first_date
  FROM dated GROUP BY ALL),
bounds AS (SELECT subreddit, tag, upto, min(date) AS lo FROM dated WHERE date <= upto GROUP BY ALL),
days AS (SELECT subreddit, tag, upto, CAST(unnest(generate_series(lo::TIMESTAMP, upto::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds),
dense AS (SELECT d.subreddit, d.tag, d.upto, d.date, ln(1 + coalesce(t.num_items, 0)) AS x FROM days d LEFT JOIN tag_daily t ON t.subreddit = d.subreddit AND t.tag = d.tag AND t.date = d.date),
{_zscores('dense', 'subreddit, tag', {'x': 'x'})}
SELECT s.subreddit, s.tag, s.upto AS "asof", items_7d, round((items_7d / 7.0::DOUBLE) / nullif(base / 90.0::DOUBLE, 0) - 1, 3) AS delta_vs_90d, sent_7d, round(z.x_z, 2) AS volume_z, first_date
FROM sums s LEFT JOIN scores z ON z.subreddit = s.subreddit AND z.tag = s.tag AND z.date = s.upto""",
    "series_receipt": f"""WITH {_SERIES} SELECT subreddit, count(*) AS rows, min(date) AS first_date, max(date) AS last_date, CAST(sum(num_posts) AS BIGINT) AS total_posts, CAST(sum(num_comments) AS BIGINT) AS total_comments FROM series GROUP BY subreddit""",
    "counts_by_month": f"""WITH {_ALL}, months AS (SELECT subreddit, month_label, count(*) FILTER (WHERE kind = 'post') AS posts, count(*) FILTER (WHERE kind = 'comment') AS comments FROM all_rows GROUP BY ALL)
SELECT * FROM months UNION ALL SELECT NULL, NULL, CAST(sum(posts) AS BIGINT), CAST(sum(comments) AS BIGINT) FROM months""",
    "dedup_priority": f"""WITH {_ALL} SELECT subreddit, month_label, kind, id, score, retrieved_2nd_on, batch_key, line_no FROM (
  SELECT *, row_number() OVER (PARTITION BY subreddit, month_label, kind, id ORDER BY (retrieved_2nd_on IS NOT NULL) DESC, ingested_at, batch_key, line_no) AS rn FROM all_rows WHERE id IS NOT NULL AND subreddit IS NOT NULL AND month_label IS NOT NULL) WHERE rn = 1""",
    "rolling_7d_mean": f"""WITH {_SERIES}, based AS (SELECT *, num_posts + num_comments AS items FROM series), {_zscores('based', 'subreddit', {'volume': 'ln(1 + items)', 'sentiment': 'mean_compound'})}
SELECT subreddit, date, round(volume_7d, 6) AS volume_7d, round(sentiment_7d, 6) AS sentiment_7d FROM means""",
    "trailing_zscore": f"WITH {_STANDING} SELECT subreddit, date, round(volume_z, 6) AS volume_z, round(sentiment_z, 6) AS sentiment_z FROM scores",
    "gauge_latest": f"""WITH {_STANDING}, now AS (SELECT subreddit, upto, volume_7d, sentiment_7d, volume_z, sentiment_z, greatest(-3.0, least(3.0, (volume_z + sentiment_z) / 2)) AS v FROM scores WHERE date = upto AND volume_z IS NOT NULL AND sentiment_z IS NOT NULL)
SELECT n.subreddit, round(v, 2) AS value, round(n.volume_z, 2) AS volume_z, round(n.sentiment_z, 2) AS sentiment_z, {_BAND.format('v')} AS band,
  round((SELECT avg(items) FROM based b WHERE b.subreddit = n.subreddit AND b.date > n.upto - 7), 1) AS vol_7d,
  round((SELECT avg((m.volume_7d <= n.volume_7d)::INTEGER) FROM means m WHERE m.subreddit = n.subreddit AND m.volume_7d IS NOT NULL), 3) AS vol_pctile_alltime, round(n.sentiment_7d, 4) AS sent_7d, n.upto AS "asof" FROM now n""",
    "volume_changes": f"""WITH {_SERIES}, dated AS (SELECT * FROM (SELECT subreddit, date, num_posts + num_comments AS items, max(date) OVER (PARTITION BY subreddit) - 2 AS upto FROM series) WHERE date <= upto),
ranked AS (SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY date DESC) AS back FROM dated), periods(period, days) AS (VALUES ('week', 7), ('month', 30), ('quarter', 91), ('year', 365)),
sums AS (SELECT subreddit, period, days, count(*) AS n, sum(items) FILTER (WHERE back <= days) / days::DOUBLE AS c, sum(items) FILTER (WHERE back > days AND back <= 2 * days) / days::DOUBLE AS p FROM ranked, periods GROUP BY subreddit, period, days)
SELECT subreddit, period, round(c, 1) AS current, round(p, 1) AS previous, round(c / nullif(p, 0) - 1, 3) AS delta FROM sums WHERE n >= 2 * days""",
    "analog_window": f"""WITH {_STANDING}, rows AS (SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY date) AS i FROM scores),
ends AS (SELECT subreddit, date, upto, i, greatest(-3.0, least(3.0, (volume_z + sentiment_z) / 2)) AS v, count(volume_z) OVER w AS nv, count(sentiment_z) OVER w AS ns, min(date) OVER w AS start FROM rows WINDOW w AS (PARTITION BY subreddit ORDER BY date ROWS 29 PRECEDING)),
now AS (SELECT subreddit, i FROM ends WHERE date = upto AND nv = 30 AND ns = 30),
newest_days AS (SELECT r.subreddit, n.i - r.i AS o, r.volume_z AS nv, r.sentiment_z AS ns FROM rows r JOIN now n ON n.subreddit = r.subreddit WHERE r.i BETWEEN n.i - 29 AND n.i),
gaps0 AS (SELECT r.subreddit, r.i + l.o AS i, sqrt(sum((r.volume_z - l.nv) ** 2 + (r.sentiment_z - l.ns) ** 2) / 60) AS d FROM rows r JOIN newest_days l ON l.subreddit = r.subreddit GROUP BY r.subreddit, r.i + l.o HAVING count(r.volume_z + r.sentiment_z) = 30),
gaps AS (SELECT e.subreddit, e.date, e.start, e.v, g.d FROM gaps0 g JOIN ends e ON e.subreddit = g.subreddit AND e.i = g.i WHERE e.date <= e.upto - 60)
SELECT subreddit, start, date AS "end", {_BAND.format('v')} AS band, round(1 / (1 + d), 3) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY round(d, 12), date) AS rn FROM gaps) WHERE rn = 1""",
    "rebase_100": f"""WITH {_SERIES}, kept AS (SELECT subreddit, date, (num_posts + num_comments)::DOUBLE AS items FROM series WHERE date >= DATE '2023-01-01')
SELECT *, round(100 * items / nullif(first_value(items) OVER (PARTITION BY subreddit ORDER BY date), 0), 6) AS indexed FROM kept""",
    "lag_change": f"""WITH {_SERIES}, lagged AS (SELECT subreddit, date, num_comments::DOUBLE AS n, lag(num_comments::DOUBLE) OVER (PARTITION BY subreddit ORDER BY date) AS previous FROM series)
SELECT *, n - previous AS change, round(n / nullif(previous, 0) - 1, 6) AS change_pct FROM lagged""",
    "nearest_comment": f"""WITH {_ITEMS}, points AS (SELECT subreddit, created_utc AS t, min(id) AS v FROM items WHERE kind = 'comment' AND created_utc IS NOT NULL GROUP BY ALL), asks AS (SELECT id, subreddit, created_utc FROM items WHERE kind = 'post'),
b AS (SELECT a.*, p.t AS bt, p.v AS bv FROM asks a ASOF LEFT JOIN points p ON a.subreddit = p.subreddit AND a.created_utc >= p.t), c AS (SELECT b.*, p.t AS at_, p.v AS av FROM b ASOF LEFT JOIN points p ON b.subreddit = p.subreddit AND b.created_utc <= p.t)
SELECT id, subreddit, created_utc, CASE WHEN at_ IS NULL OR created_utc - bt <= at_ - created_utc THEN bt ELSE at_ END AS nearest_at, CASE WHEN at_ IS NULL OR created_utc - bt <= at_ - created_utc THEN bv ELSE av END AS nearest_value FROM c""",
    "overlay_window": f"""WITH {_SERIES}, s AS (SELECT date, sum(num_posts)::DOUBLE AS posts, sum(num_comments)::DOUBLE AS comments FROM series GROUP BY date),
p AS (SELECT date, posts FROM s WHERE posts > 0), c AS (SELECT date, comments FROM s WHERE comments > 0)
SELECT coalesce(p.date, c.date) AS date, posts, comments FROM p FULL JOIN c ON p.date = c.date
WHERE coalesce(p.date, c.date) BETWEEN (SELECT greatest((SELECT min(date) FROM p), (SELECT min(date) FROM c))) AND (SELECT least((SELECT max(date) FROM p), (SELECT max(date) FROM c)))""",
    "thread_context": f"""WITH {_ITEMS}, c AS (SELECT * FROM items WHERE kind = 'comment'), looked AS (
  SELECT a.id, a.link_id, a.parent_id, a.body, p.title AS post_title, b.body AS parent_body FROM c a LEFT JOIN items p ON p.kind = 'post' AND p.id = replace(a.link_id, 't3_', '') LEFT JOIN c b ON a.parent_id LIKE 't1_%' AND b.id = substr(a.parent_id, 4))
SELECT *, concat_ws(chr(10), 'Post: ' || post_title, 'Parent: ' || substr(parent_body, 1, 8000)) AS context_text FROM looked""",
    "semi_teacher": f"WITH {_ITEMS}, {_ENRICHED} SELECT kind, id, score FROM items WHERE (kind, id) IN (SELECT (kind, id) FROM enriched WHERE kind IS NOT NULL AND len(tags) > 0)",
    "anti_holdout": f"WITH {_ITEMS}, {_ENRICHED} SELECT kind, id, score FROM items WHERE (kind, id) NOT IN (SELECT (kind, id) FROM enriched WHERE kind IS NOT NULL)",
    "date_range": f"WITH {_ITEMS} SELECT kind, id, {_DAY} AS day FROM items WHERE {_DAY} >= DATE '2024-01-15' AND {_DAY} < DATE '2024-02-01'",
    "text_clean": r"""SELECT doc_id, CASE WHEN t NOT IN ('', '[deleted]', '[removed]', '[deleted by user]') THEN text END AS text, CASE WHEN author NOT IN ('', '[deleted]', '[removed]') THEN author END AS author
FROM (SELECT *, regexp_replace(regexp_replace(text, '^[\s\p{Z}\x0b]+', ''), '[\s\p{Z}\x0b]+$', '') AS t FROM documents)""",
    "text_join": f"""WITH {_ITEMS} SELECT id, concat_ws(chr(10) || chr(10), nullif(title, ''), nullif(selftext, '')) AS enrich_text, coalesce(title, '') || coalesce(chr(10) || chr(10) || selftext, '') AS post_text,
  concat_ws(' ', title, selftext) AS sample_text FROM items WHERE kind = 'post'""",
    "regex_tags": f"SELECT doc_id, array_to_string({_tag_list('text')}, ';') AS tags FROM documents",
    "word_length_era": r"""SELECT doc_id, words, CASE WHEN words < 25 THEN 'short' WHEN words > 150 THEN 'long' ELSE 'medium' END AS length, strftime(make_timestamp(created_utc * 1000000), '%Y') AS era
FROM (SELECT *, CAST(len(string_split_regex(trim(text, ' '), '[ \t\n\f\r]+')) AS INTEGER) AS words FROM documents WHERE text IS NOT NULL AND trim(text, ' ') <> '')""",
    "text_views": r"""SELECT doc_id, md5(CASE WHEN length(text) > 8000 THEN substr(text, 1, 8000) || chr(10) || '[truncated]' ELSE text END) AS cut_md5,
  regexp_replace(regexp_replace(lower(source), '[^a-z0-9.-]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM documents WHERE text IS NOT NULL""",
    "polarity_labels": f"""WITH {_ENRICHED} SELECT kind, id, CASE WHEN vader_compound IS NULL THEN NULL WHEN 1 - abs(vader_compound) >= 0.8 THEN 'neu' WHEN vader_compound >= 0.3 THEN 'pos' WHEN vader_compound <= -0.2 THEN 'neg' ELSE 'neu' END AS label FROM enriched""",
    "md5_per_year": f"""WITH {_ITEMS} SELECT kind, id, era FROM (SELECT *, row_number() OVER (PARTITION BY kind, era ORDER BY md5(id), id) AS n FROM (SELECT kind, id, strftime(make_timestamp(created_utc * 1000000), '%Y') AS era FROM items)) WHERE n <= 400""",
    "md5_top_n": f"WITH {_ITEMS} SELECT kind, id FROM items ORDER BY md5(id), id, kind LIMIT 500",
    "md5_parts": f"WITH {_ITEMS} SELECT kind, id, CAST(md5_number(id) % 5 AS INTEGER) AS part FROM items",
    "exact_within_one": f"WITH {_RATED} SELECT count(*) AS n, round(avg((gold = scored)::INTEGER), 6) AS exact, round(avg((abs(gold - scored) <= 1)::INTEGER), 6) AS within_one FROM rated WHERE gold IS NOT NULL AND scored IS NOT NULL",
    "confusion": f"WITH {_RATED}, levels(v) AS (VALUES (-2), (-1), (0), (1), (2)) SELECT g.v AS gold, s.v AS scored, count(r.id) AS n FROM levels g JOIN levels s ON TRUE LEFT JOIN rated r ON r.gold = g.v AND r.scored = s.v GROUP BY ALL",
    "kappa": f"WITH {_RATED} {_KAPPA.format('gold', 'scored')}",
    "kappa_three_way": f"WITH {_RATED} {_KAPPA.format('sign(gold)', 'sign(scored)')}",
    "tag_prf": f"""WITH {_ITEMS}, {_ENRICHED}, pairs AS (SELECT e.tags AS g, {_tag_list(_BODY_TEXT)} AS s FROM items i JOIN enriched e ON i.kind = e.kind AND i.id = e.id),
each AS (SELECT tag, bool_or(side = 'g') AS in_g, bool_or(side = 's') AS in_s FROM (SELECT r, 'g' AS side, unnest(g) AS tag FROM (SELECT row_number() OVER () AS r, * FROM pairs) UNION ALL SELECT r, 's', unnest(s) FROM (SELECT row_number() OVER () AS r, * FROM pairs)) GROUP BY r, tag),
n AS (SELECT tag, count(*) FILTER (WHERE in_g AND in_s) AS tp, count(*) FILTER (WHERE NOT in_g) AS fp, count(*) FILTER (WHERE NOT in_s) AS fn FROM each GROUP BY tag)
SELECT tag, tp, fp, fn, round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1 FROM n WHERE tp + fn > 0""",
    "histogram": f"WITH {_RATED} SELECT field_name, value, count(*) AS n FROM (SELECT 'kind' AS field_name, kind AS value FROM rated UNION ALL SELECT 'gold', gold::VARCHAR FROM rated UNION ALL SELECT 'scored', scored::VARCHAR FROM rated UNION ALL SELECT 'vader_label', vader_label FROM rated) GROUP BY ALL",
    "validate_labels": f"""WITH {_RATED}, labels AS (
  SELECT kind, id, tags, gold AS os, abs(vader_compound) < 0.2 AS ns, list_filter(tags, lambda t: scored + length(t) % 3 > 2) AS off, CASE WHEN scored > 1 THEN 'high' WHEN scored > 0 THEN 'sure' ELSE 'low' END AS c, coalesce(vader_label, ' ') AS r,
    list_sort(list_filter(tags, lambda t: NOT list_contains({_KEYS}, t))) AS unknown,
    list_filter([CASE WHEN vader_compound IS NULL THEN 'no_sentiment' END, CASE WHEN gold IS NULL THEN 'overall_sentiment' END, CASE WHEN tags IS NULL OR scored IS NULL THEN 'tag_sentiment' END, CASE WHEN tags IS NULL THEN 'tags' END], lambda x: x IS NOT NULL) AS missing FROM rated)
SELECT kind, id, CASE WHEN len(missing) > 0 THEN 'missing: ' || array_to_string(missing, ', ') ELSE array_to_string(list_filter([
  CASE WHEN len(unknown) > 0 THEN 'unknown tags: ' || array_to_string(unknown, ', ') END, CASE WHEN len(tags) = 0 THEN 'no tags' END, CASE WHEN ns AND os <> 0 THEN 'no_sentiment with a sentiment' END,
  CASE WHEN len(off) > 0 THEN 'tag_sentiment off the scale: ' || array_to_string(list_sort(off), ', ') END, CASE WHEN c = 'sure' THEN 'confidence: sure' END, CASE WHEN trim(r) = '' THEN 'empty rationale' END], lambda x: x IS NOT NULL), '; ') END AS problems FROM labels""",
    "quota_split": f"""WITH {_RATED}, kept AS (SELECT kind, id, gold, abs(vader_compound) AS sure FROM rated WHERE gold IS NOT NULL), sizes AS (SELECT kind, gold, count(*) AS size FROM kept GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (ORDER BY size DESC, kind, gold) AS place, count(*) OVER () AS groups FROM sizes),
want AS (SELECT kind, gold, least(450 // groups + CASE WHEN place <= 450 - (450 // groups) * groups THEN 1 ELSE 0 END, greatest(1, size // 2)) AS want FROM ranked)
SELECT k.kind, k.id, k.gold, k.sure, CASE WHEN row_number() OVER (PARTITION BY k.kind, k.gold ORDER BY sure DESC, md5('1:' || id), id) <= want THEN 'exemplar' ELSE 'holdout' END AS split FROM kept k JOIN want w ON w.kind = k.kind AND w.gold = k.gold""",
    "exemplars": f"WITH {_RATED} SELECT kind, id, gold FROM (SELECT kind, id, gold, row_number() OVER (PARTITION BY gold ORDER BY id, kind) AS n FROM rated WHERE gold IS NOT NULL) WHERE n <= 4",
    "token_docfreq": f"WITH {_DOCS} SELECT token, n, n_pos, n_neg FROM freq",
    "token_association": f"WITH {_DOCS} SELECT token, n, round(association, 6) AS association FROM assoc WHERE n >= 50",
    "top_terms": f"""WITH {_DOCS} SELECT token, round(greatest(-3.5, least(3.5, association * 4.0)), 2) AS valence, abs(association) * ln(n) AS weight FROM assoc WHERE n >= 20 AND abs(association) >= 0.02 ORDER BY weight DESC, token LIMIT 400""",
    "grid_argmax": f"""WITH {_RATED}, rows AS (SELECT vader_compound AS c, 1 - abs(vader_compound) AS u, sign(scored) AS y FROM rated WHERE vader_compound IS NOT NULL AND scored IS NOT NULL), grid(place, pos, neg, neu_min) AS (VALUES {_GRID})
SELECT pos::DOUBLE AS pos, neg::DOUBLE AS neg, neu_min::DOUBLE AS neu_min, round(accuracy, 6) AS accuracy FROM (
  SELECT place, pos, neg, neu_min, avg((CASE WHEN u >= neu_min::DOUBLE THEN 0 WHEN c >= pos::DOUBLE THEN 1 WHEN c <= neg::DOUBLE THEN -1 ELSE 0 END = y)::INTEGER) AS accuracy FROM rows, grid GROUP BY ALL ORDER BY accuracy DESC, place LIMIT 1)""",
    "engagement_state": f"WITH {_ITEMS} SELECT kind, {_STATE} AS state, count(*) AS n FROM items GROUP BY ALL",
    "settlement_tally": f"WITH {_ALL}, {_TALLY} SELECT * FROM tally",
    "discover_partitions": f"WITH {_PARTS} SELECT subreddit, month_label, kind, count(*) AS n_parts, count(hour_stamp) AS n_recent, max(part) AS last_part FROM parts GROUP BY ALL",
    "fingerprint": f"WITH {_PARTS} {_PRINTS.format('parts')}",
    "stale_partitions": f"""WITH {_PARTS}, now AS ({_PRINTS.format('parts')}), held AS ({_PRINTS.format("(SELECT * FROM parts WHERE uploaded_at < TIMESTAMPTZ '2023-01-01 00:00:00+00')")})
SELECT n.subreddit, n.month_label, n.kind FROM now n LEFT JOIN held h ON h.subreddit = n.subreddit AND h.month_label = n.month_label AND h.kind = n.kind WHERE n.fingerprint IS DISTINCT FROM h.fingerprint""",
    "stale_parts": f"""WITH {_PARTS}, backfill AS (SELECT * FROM parts WHERE hour_stamp IS NULL), written AS (SELECT subreddit, month_label, kind, max(part) AS n, max(uploaded_at) AS last_at FROM backfill GROUP BY ALL)
SELECT b.object_key FROM backfill b JOIN written w ON w.subreddit = b.subreddit AND w.month_label = b.month_label AND w.kind = b.kind WHERE b.part >= w.n AND b.uploaded_at < w.last_at + INTERVAL 1 SECOND""",
    "open_partitions": f"""WITH {_RECEIPTS}, newest AS (SELECT subreddit, max(CAST(substr(month_label, 1, 4) AS INTEGER) * 12 + CAST(substr(month_label, 6, 2) AS INTEGER) - 1) AS n FROM receipts GROUP BY subreddit),
tail AS (SELECT subreddit, strftime(DATE '2025-01-01' - to_months(CAST(b AS INTEGER)), '%Y-%m') AS month_label, kind FROM newest, range(24) r(b), (VALUES ('posts'), ('comments')) k(kind) WHERE b < least(greatest(2, 2025 * 12 - n + 1), 24)),
waiting AS (SELECT subreddit, month_label, kind FROM receipts WHERE NOT (CASE WHEN rows_unsettled IS NOT NULL THEN rows_unsettled = 0 ELSE date_diff('second', CAST(month_label || '-01' AS TIMESTAMP) + INTERVAL 1 MONTH, TIMESTAMP '2025-01-01') > 2592000 END))
SELECT * FROM tail UNION SELECT * FROM waiting""",
    "run_totals": f"WITH {_RECEIPTS} SELECT count(*) AS partitions, count(*) AS keys_written, CAST(sum(rows) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS seconds_unproven, count(*) FILTER (WHERE rows_unsettled > 0) AS partitions_unsettled FROM receipts",
    "months_left_receipts": f"""WITH {_RECEIPTS}, counts AS (SELECT subreddit, month_label, kind || 's' AS kind, count(*) AS stored FROM items GROUP BY ALL)
SELECT c.*, r.rows, r.rows_unsettled FROM counts c LEFT JOIN receipts r ON r.subreddit = c.subreddit AND r.month_label = c.month_label AND r.kind = c.kind""",
    "raw_types": f"""WITH docs AS (SELECT file_key, line_no, record_json::JSON AS j FROM raw_records)
SELECT file_key, line_no, CAST(trunc({_number('$.created_utc')}) AS BIGINT) AS created_utc, CAST(trunc({_number('$.score')}) AS INTEGER) AS score,
  CASE WHEN json_type(j, '$.edited') = 'BOOLEAN' THEN CAST(json_extract(j, '$.edited') AS BOOLEAN) WHEN {_JSON_NUMBER.format('$.edited')} THEN CAST(json_extract(j, '$.edited') AS DOUBLE) > 0 ELSE FALSE END AS edited,
  CAST(trunc({_number('$._meta.retrieved_2nd_on')}) AS BIGINT) AS stamp, json_type(j, '$._meta.retrieved_2nd_on') IS NOT NULL AS is_stamped,
  {_settled(f"{_number('$._meta.retrieved_2nd_on')} IS NOT NULL")} AS settled, {_settled("json_type(j, '$._meta.retrieved_2nd_on') IS NOT NULL")} AS settled_by_key FROM docs""",
    "stream_merge": " UNION ALL ".join(f"""SELECT '{kind}' AS kind, id, score, created_utc, retrieved_2nd_on, batch_key, line_no, n_copies FROM (
  SELECT *, count(*) OVER (PARTITION BY id) AS n_copies, row_number() OVER (PARTITION BY id ORDER BY (retrieved_2nd_on IS NOT NULL) DESC, retrieved_2nd_on DESC NULLS LAST, created_utc DESC NULLS LAST, ingested_at, batch_key DESC, line_no DESC) AS rn FROM {name} WHERE id IS NOT NULL) WHERE rn = 1""" for name, kind in (("posts", "post"), ("comments", "comment"))),
}


def _text(path: str) -> str:
    return f"CASE WHEN json_type(j, '{path}') = 'VARCHAR' THEN json_extract_string(j, '{path}') END"


def _flag(path: str) -> str:
    return f"CASE WHEN json_type(j, '{path}') = 'BOOLEAN' THEN CAST(json_extract(j, '{path}') AS BOOLEAN) END"


def _kept(x: str) -> str:
    bare = f"regexp_replace(regexp_replace({x}, '^[\\s\\p{{Z}}\\x0b]+', ''), '[\\s\\p{{Z}}\\x0b]+$', '')"
    return f"CASE WHEN {bare} NOT IN ('', '[deleted]', '[removed]', '[deleted by user]') THEN {x} END"


_POST, _COMMENT = "CASE WHEN kind = 'posts' THEN {0} END", "CASE WHEN kind = 'comments' THEN {0} END"
_PROJECTED = {
    "id": _text("$.id"),
    "author": f"CASE WHEN {_text('$.author')} NOT IN ('', '[deleted]', '[removed]') THEN {_text('$.author')} END",
    "created_utc": f"CAST(trunc({_number('$.created_utc')}) AS BIGINT)",
    "score": f"CAST(trunc({_number('$.score')}) AS INTEGER)",
    "upvote_ratio": _POST.format(f"round({_number('$.upvote_ratio')}, 6)"),
    "num_comments": _POST.format(f"CAST(trunc({_number('$.num_comments')}) AS INTEGER)"),
    "title": _POST.format(_kept(_text("$.title"))),
    "selftext": _POST.format(_kept(_text("$.selftext"))),
    "body": _COMMENT.format(_kept(_text("$.body"))),
    "parent_id": _COMMENT.format(_text("$.parent_id")),
    "link_id": _COMMENT.format(_text("$.link_id")),
    "is_self": _POST.format(_flag("$.is_self")),
    "over_18": _flag("$.over_18"),
    "stickied": _flag("$.stickied"),
    "distinguished": _text("$.distinguished"),
    "edited": f"CASE WHEN json_type(j, '$.edited') = 'BOOLEAN' THEN CAST(json_extract(j, '$.edited') AS BOOLEAN) WHEN {_JSON_NUMBER.format('$.edited')} THEN CAST(json_extract(j, '$.edited') AS DOUBLE) > 0 ELSE FALSE END",
    "author_flair_text": _text("$.author_flair_text"),
    "link_flair_text": _POST.format(_text("$.link_flair_text")),
    "removal_category": f"coalesce(nullif({_text('$.removed_by_category')}, ''), {_text('$.removal_reason')})",
    "engagement_settled": _settled(f"{_number('$._meta.retrieved_2nd_on')} IS NOT NULL"),
    "retrieved_2nd_on": f"CAST(trunc({_number('$._meta.retrieved_2nd_on')}) AS BIGINT)",
}
SQL["project_raw"] = f"""WITH docs AS (
  SELECT file_key, line_no, record_json::JSON AS j, regexp_extract(file_key, '{_RAW_KEY}', 1) AS subreddit, regexp_extract(file_key, '{_RAW_KEY}', 2) AS month_label, regexp_extract(file_key, '{_RAW_KEY}', 3) AS kind
  FROM raw_records WHERE regexp_matches(file_key, '{_RAW_KEY}')),
projected AS (SELECT {", ".join(f"{x} AS {n}" for n, x in _PROJECTED.items())}, subreddit, month_label, kind, file_key, line_no, json_type(j, '$._meta.retrieved_2nd_on') IS NOT NULL AS stamped FROM docs)
SELECT {", ".join(_PROJECTED)}, subreddit, month_label FROM (
  SELECT *, row_number() OVER (PARTITION BY subreddit, month_label, kind, id ORDER BY stamped DESC, file_key, line_no) AS rn FROM projected WHERE nullif(id, '') IS NOT NULL) WHERE rn = 1"""

_RECEIPT_KEY = "^receipts/([^/]+)/([0-9]{4}-(?:0[1-9]|1[0-2]))-(posts|comments)\\.json$"
_PRESETS = {"1M": "s.last - INTERVAL 1 MONTH", "3M": "s.last - INTERVAL 3 MONTH", "6M": "s.last - INTERVAL 6 MONTH", "1Y": "s.last - INTERVAL 12 MONTH", "ALL": "DATE '0001-01-01'"}
SQL |= {
    "receipt_names": f"SELECT regexp_extract(object_key, '{_RECEIPT_KEY}', 1) AS subreddit, regexp_extract(object_key, '{_RECEIPT_KEY}', 2) AS month_label, regexp_extract(object_key, '{_RECEIPT_KEY}', 3) AS kind FROM raw_objects WHERE regexp_matches(object_key, '{_RECEIPT_KEY}')",
    "enrich_fingerprint": f"WITH {_PARTS} SELECT object_key, sha256(concat_ws(':', etag, 'seed-1+tags-1')) AS fingerprint FROM parts",
    "last_score_agreement": f"""WITH levels AS (SELECT kind || '/' || id AS doc_id, enrich_version AS v, {_LEVEL.format('vader_compound', -0.6, -0.05, 0.05, 0.6)} AS level FROM enrich WHERE id IS NOT NULL AND kind IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY v NULLS FIRST, level NULLS FIRST) AS first_n, row_number() OVER (PARTITION BY doc_id ORDER BY v DESC NULLS LAST, level DESC NULLS LAST) AS last_n FROM levels),
rated AS (SELECT g.level AS gold, s.level AS scored FROM ranked g JOIN ranked s ON s.doc_id = g.doc_id WHERE g.first_n = 1 AND s.last_n = 1)
SELECT count(*) AS n, round(avg((gold = scored)::INTEGER), 6) AS exact, round(avg((abs(gold - scored) <= 1)::INTEGER), 6) AS within_one FROM rated WHERE gold IS NOT NULL AND scored IS NOT NULL""",
    "teacher_slices": f"""WITH {_ITEMS}, {_ENRICHED}, free AS (SELECT kind, id, created_utc, {_DAY} AS day FROM items WHERE created_utc IS NOT NULL AND (kind, id) NOT IN (SELECT (kind, id) FROM enriched WHERE kind IS NOT NULL AND len(tags) > 1))
SELECT kind, id, created_utc, 'per_year' AS slice FROM (SELECT *, row_number() OVER (PARTITION BY year(day) ORDER BY md5(id), id, kind) AS n FROM free) WHERE n <= 400
UNION ALL SELECT kind, id, created_utc, 'spike' FROM (SELECT *, row_number() OVER (ORDER BY md5(id), id, kind) AS n FROM free WHERE day >= DATE '2024-01-15' AND day < DATE '2024-02-01') WHERE n <= 200
UNION ALL SELECT kind, id, created_utc, 'calm' FROM (SELECT *, row_number() OVER (ORDER BY md5(id), id, kind) AS n FROM free WHERE day >= DATE '2023-05-01' AND day < DATE '2023-07-01') WHERE n <= 100""",
    "range_presets": f"WITH {_SERIES}, s AS (SELECT *, max(date) OVER (PARTITION BY subreddit) AS last FROM series) "
    + " UNION ALL ".join(f"SELECT subreddit, '{n}' AS preset, count(*) AS days, CAST(sum(num_posts + num_comments) AS BIGINT) AS items FROM s WHERE date >= {first} GROUP BY subreddit" for n, first in _PRESETS.items()),
    "measured_change": f"""WITH {_SERIES}, a AS (SELECT subreddit, arg_min(num_comments, (abs(date_diff('day', DATE '2023-01-15', date)) * 2 + (date > DATE '2023-01-15')::INTEGER)) AS v FROM series GROUP BY subreddit),
b AS (SELECT subreddit, arg_min(num_comments, (abs(date_diff('day', DATE '2024-06-15', date)) * 2 + (date > DATE '2024-06-15')::INTEGER)) AS v FROM series GROUP BY subreddit)
SELECT a.subreddit, (b.v - a.v)::DOUBLE AS delta, round((b.v / nullif(a.v, 0)::DOUBLE - 1) * 100, 6) AS pct FROM a JOIN b ON a.subreddit = b.subreddit""",
}
