"""Queries of the training-data problems (p7 to p10) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import cooccurrence, mixing, packing, spans, tokens
from larkspur.scratch import materialize
from larkspur.session import table


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    found = cooccurrence.associations(table(spark, d, "enrich"), ["kind", "id"], "tags")
    times = cooccurrence.product
    hit = (times("n_ab", "n_all") >= times("n_a", "n_b", 4)) & (F.col("n_ab") * 500 >= F.col("n_all"))
    return found.filter(hit).select(F.col("item_a").alias("tag_a"), F.col("item_b").alias("tag_b"))


def p7_associations(spark: SparkSession, d: str) -> DataFrame:
    found = cooccurrence.associations(table(spark, d, "enrich"), ["kind", "id"], "tags")
    return found.select(F.col("item_a").alias("tag_a"), F.col("item_b").alias("tag_b"), "n_ab", "n_a", "n_b", "n_all", cooccurrence.lift().alias("lift"))


def p7_monthly(spark: SparkSession, d: str) -> DataFrame:
    """Tags used in the same subreddit and month: baskets of far more rows than a chunk."""
    found = cooccurrence.associations(table(spark, d, "enrich"), ["subreddit", "month_label"], "tags")
    return found.select(F.col("item_a").alias("tag_a"), F.col("item_b").alias("tag_b"), "n_ab", "n_a", "n_b", "n_all", cooccurrence.lift().alias("lift"))


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    return materialize(tokens.token_counts(table(spark, d, "documents"), keep=("doc_id", "source")), "sizes")


def p8_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(_sizes(spark, d), table(spark, d, "pack_sizes"))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    containers = table(spark, d, "pack_sizes")
    return packing.fill_report(packing.pack(_sizes(spark, d), containers), containers)


def p8_breeding(spark: SparkSession, d: str) -> DataFrame:
    return packing.breeding_report(_sizes(spark, d), table(spark, d, "pack_sizes"))


def p8_whole(spark: SparkSession, d: str) -> DataFrame:
    """Per container and document: whether its pieces are numbered without a gap and hold its tokens, and per container
    the share of bins within the capacity."""
    sizes, containers = _sizes(spark, d), table(spark, d, "pack_sizes")
    packed = materialize(packing.pack(sizes, containers), "packing")
    fill = packed.groupBy("container_name", "bin_id").agg(F.sum("n_tokens").alias("t")).join(containers, "container_name").groupBy("container_name").agg(F.count_if(F.col("t") > F.col("capacity_tokens")).alias("over_full"))
    per = packed.groupBy("container_name", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("piece").alias("k"), F.max("piece").alias("last"), F.sum("n_tokens").alias("t"), F.max("n_tokens").alias("longest"))
    checked = per.join(sizes, "doc_id").join(containers, "container_name").join(fill, "container_name")
    cut_only_if_longer = (F.col("n") == 1) | ((F.col("n_tokens") > F.col("capacity_tokens")) & (F.col("longest") == F.col("capacity_tokens")))
    once = (F.col("n") == F.col("k")) & (F.col("last") == F.col("n") - 1) & (F.col("t") == F.col("n_tokens"))
    return checked.select("container_name", "doc_id", once.alias("packed_once"), cut_only_if_longer.alias("cut_only_if_longer"), "over_full")


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(_sizes(spark, d), table(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    targets = table(spark, d, "mix_targets")
    return mixing.shares(mixing.mix(_sizes(spark, d), targets), targets)


def p9_kept(spark: SparkSession, d: str) -> DataFrame:
    """Per target: whether its share of the mix, of what the sources with documents can give, is met within a thousandth or,
    in a mix of few documents, within the source's largest one; and whether no document occurs more often than allowed."""
    targets = table(spark, d, "mix_targets")
    sizes = _sizes(spark, d)
    mixed = materialize(mixing.mix(sizes, targets), "mix")
    filled = sizes.filter("n_tokens > 0").groupBy("source").agg(F.lit(True).alias("has_documents"), F.max("n_tokens").alias("_largest"))
    known = mixing.shares(mixed, targets).join(filled, "source", "left").join(targets.select("source", "max_repeats"), "source")
    whole = known.agg(F.sum(F.when(F.col("has_documents"), F.col("target_share"))).alias("_whole"), F.sum("n_tokens").alias("_all"))
    due = F.when(F.col("has_documents"), F.col("target_share") / F.col("_whole")).otherwise(0.0)
    off = F.abs(F.col("n_tokens") - due * F.col("_all"))
    met = off <= F.greatest(F.coalesce("_largest", F.lit(0)), 0.001 * F.col("_all"))
    return known.join(F.broadcast(whole)).select("source", F.coalesce("has_documents", F.lit(False)).alias("has_documents"), met.alias("share_met"), (F.coalesce("most_copies", F.lit(0)) <= F.col("max_repeats")).alias("repeats_kept"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spans.sharing_pairs(table(spark, d, "documents"))


def p10_spans(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_spans(table(spark, d, "documents"))


def p10_factors(spark: SparkSession, d: str) -> DataFrame:
    return spans.factors(table(spark, d, "documents"))


def p10_portion(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_portion(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p7_found, p7_associations, p7_monthly, p8_packing, p8_fill, p8_breeding, p8_whole, p9_mix, p9_shares, p9_kept, p10_found, p10_spans, p10_factors, p10_portion)}

_PAIRS = """
WITH sets AS (
  SELECT kind, id, list_distinct(flatten(list(tags))) AS items FROM (SELECT {k1} AS kind, {k2} AS id, tags FROM enrich) WHERE kind IS NOT NULL AND id IS NOT NULL AND tags IS NOT NULL GROUP BY kind, id
), each AS (SELECT kind, id, tag FROM (SELECT kind, id, unnest(items) AS tag FROM sets) WHERE tag IS NOT NULL),
total AS (SELECT count(*) AS n_all FROM (SELECT DISTINCT kind, id FROM each)),
single AS (SELECT tag, count(*) AS n FROM each GROUP BY tag),
pairs AS (SELECT a.tag AS tag_a, b.tag AS tag_b, count(*) AS n_ab FROM each a JOIN each b ON a.kind = b.kind AND a.id = b.id AND a.tag < b.tag GROUP BY ALL)"""

_LIFTS = """ SELECT tag_a, tag_b, n_ab, x.n AS n_a, y.n AS n_b, n_all, round(n_ab::DOUBLE * n_all / (x.n::DOUBLE * y.n), 6) AS lift
FROM pairs JOIN single x ON x.tag = tag_a JOIN single y ON y.tag = tag_b, total"""

_GRAMS = """
WITH grams AS (SELECT DISTINCT doc_id, hash(substr(text, p, 150)) AS g FROM (SELECT doc_id, text, unnest(range(1, length(text) - 148)) AS p FROM documents WHERE length(text) >= 150))"""

SQL = {
    "p7_found": _PAIRS.format(k1="kind", k2="id")
    + """ SELECT tag_a, tag_b FROM pairs JOIN single x ON x.tag = tag_a JOIN single y ON y.tag = tag_b, total
WHERE n_ab::HUGEINT * n_all >= 4::HUGEINT * x.n * y.n AND 500 * n_ab >= n_all""",
    "p7_associations": _PAIRS.format(k1="kind", k2="id") + _LIFTS,
    "p7_monthly": _PAIRS.format(k1="subreddit", k2="month_label") + _LIFTS,
    "p8_whole": "SELECT container_name, doc_id, TRUE AS packed_once, TRUE AS cut_only_if_longer, CAST(0 AS BIGINT) AS over_full FROM documents, pack_sizes",
    "p9_kept": """SELECT source, EXISTS (SELECT 1 FROM documents d WHERE d.source = t.source AND text <> '') AS has_documents, TRUE AS share_met, TRUE AS repeats_kept FROM mix_targets t""",
    "p10_found": _GRAMS + " SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id",
    "p10_spans": """
WITH grams AS (SELECT doc_id, p - 1 AS pos, hash(substr(text, p, 150)) AS g FROM (SELECT doc_id, text, unnest(range(1, length(text) - 148)) AS p FROM documents WHERE length(text) >= 150)),
hits AS (SELECT doc_id, pos FROM grams WHERE g IN (SELECT g FROM grams GROUP BY g HAVING count(DISTINCT doc_id) > 1)),
marked AS (SELECT *, CASE WHEN pos <= lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 150 THEN 0 ELSE 1 END AS is_new FROM hits),
runs AS (SELECT *, sum(is_new) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM marked)
SELECT doc_id, min(pos) AS span_start, max(pos) + 150 AS span_end FROM runs GROUP BY doc_id, run""",
    "p10_factors": """
WITH RECURSIVE grams AS (SELECT doc_id, p - 1 AS pos, hash(substr(text, p, 150)) AS g FROM (SELECT doc_id, text, unnest(range(1, length(text) - 148)) AS p FROM documents WHERE length(text) >= 150)),
met AS (SELECT a.doc_id, a.pos, b.doc_id AS source_doc, b.pos - a.pos AS shift FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id),
marked AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, source_doc, shift ORDER BY pos) AS run FROM met),
matches AS (SELECT doc_id, source_doc, shift, min(pos) AS s, max(pos) AS last FROM marked GROUP BY doc_id, source_doc, shift, run),
hits AS (SELECT DISTINCT doc_id, pos FROM met),
best AS (
  SELECT * FROM (SELECT h.doc_id, h.pos, m.s, m.last, m.source_doc, m.s + m.shift AS source_start,
                        row_number() OVER (PARTITION BY h.doc_id, h.pos ORDER BY m.last DESC, m.s, m.source_doc, m.shift) AS rn
                 FROM hits h JOIN matches m ON m.doc_id = h.doc_id AND h.pos BETWEEN m.s AND m.last) WHERE rn = 1),
onward AS (SELECT b.doc_id, b.pos, min(h.pos) AS next FROM best b JOIN hits h ON h.doc_id = b.doc_id AND h.pos > b.last GROUP BY b.doc_id, b.pos),
parse AS (
  SELECT doc_id, min(pos) AS pos FROM hits GROUP BY doc_id
  UNION ALL SELECT p.doc_id, o.next FROM parse p JOIN onward o ON o.doc_id = p.doc_id AND o.pos = p.pos)
SELECT b.doc_id, b.s AS factor_start, b.last + 150 AS factor_end, b.source_doc, b.source_start FROM parse p JOIN best b ON b.doc_id = p.doc_id AND b.pos = p.pos""",
    "p10_portion": """
WITH grams AS (SELECT doc_id, p - 1 AS pos, hash(substr(text, p, 150)) AS g FROM (SELECT doc_id, text, unnest(range(1, length(text) - 148)) AS p FROM documents WHERE length(text) >= 150)),
hits AS (SELECT doc_id, pos FROM grams WHERE g IN (SELECT g FROM grams GROUP BY g HAVING count(DISTINCT doc_id) > 1)),
steps AS (SELECT *, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS prev FROM hits),
sums AS (SELECT doc_id, count(*) FILTER (WHERE prev IS NULL OR pos > prev + 150) AS n_spans, CAST(sum(least(150, coalesce(pos - prev, 150))) AS BIGINT) AS shared_chars FROM steps GROUP BY doc_id)
SELECT d.doc_id, coalesce(length(text), 0) AS n_chars, coalesce(n_spans, 0) AS n_spans, coalesce(shared_chars, 0) AS shared_chars, round(coalesce(shared_chars::DOUBLE / nullif(length(text), 0), 0), 6) AS shared_share FROM documents d LEFT JOIN sums s ON s.doc_id = d.doc_id""",
}
