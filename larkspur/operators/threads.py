"""Comments with their thread and parent, and semi and anti selections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import context


def with_context(comments: DataFrame, posts: DataFrame, parent_chars: int | None = None) -> DataFrame:
    """``id, link_id, parent_id, body, post_title, parent_body, context_text``; absent posts and parents are NULL.

    ``comments`` and ``posts`` hold one row per id. Only parents that are comments are looked up; a hot thread's comments
    are split over tasks by adaptive skew handling.
    """
    titles = posts.select(F.concat(F.lit("t3_"), "id").alias("link_id"), F.col("title").alias("post_title"))
    bodies = comments.select(F.concat(F.lit("t1_"), "id").alias("_parent"), F.col("body").alias("parent_body"))
    looked = F.when(F.col("parent_id").like("t1_%"), F.col("parent_id"))
    both = comments.select("id", "link_id", "parent_id", "body").join(titles, "link_id", "left").withColumn("_parent", looked).join(bodies, "_parent", "left")
    return both.select("id", "link_id", "parent_id", "body", "post_title", "parent_body", context(F.col("post_title"), F.col("parent_body"), parent_chars).alias("context_text"))


def only(rows: DataFrame, wanted: DataFrame, key: str | list[str] = "id") -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    return rows.join(wanted.select(*keys), keys, "left_semi")


def without(rows: DataFrame, done: DataFrame, key: str | list[str] = "id") -> DataFrame:
    """Rows whose key is not among the done ones; rows with a NULL key stay."""
    keys = [key] if isinstance(key, str) else key
    return rows.join(done.select(*keys), keys, "left_anti")


def updated(rows: DataFrame, edits: DataFrame, key: str) -> DataFrame:
    """``rows`` with the non-null columns of ``edits`` put in; an edit of an unknown key is an error."""
    unknown = edits.join(rows.select(key), key, "left_anti").limit(3).collect()
    if unknown:
        raise ValueError(f"edits of unknown rows: {[r[key] for r in unknown]}")
    changed = [c for c in edits.columns if c != key]
    side = edits.select(key, *[F.col(c).alias(f"_new_{c}") for c in changed])
    out = rows.join(side, key, "left")
    return out.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in changed else F.col(c) for c in rows.columns])
