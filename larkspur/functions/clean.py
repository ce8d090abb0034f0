"""Lenient typing and cleaning of raw records, as column expressions.

Absence and wrong types become NULL; no row is ever dropped here. ``doc`` is a VARIANT column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands for a deleted author or text, and the first second that carries a second retrieval.
NO_AUTHOR = ("", "[deleted]", "[removed]")
NO_TEXT = ("", "[deleted]", "[removed]", "[deleted by user]")
EXEMPT_BEFORE = 1688169600


def strip(x: Column) -> Column:
    """Trim all Unicode white space at both ends."""
    return F.regexp_replace(F.regexp_replace(x, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def clean_text(x: Column) -> Column:
    """NULL for blank text and placeholders; other text unchanged, not trimmed."""
    return F.when(~strip(x).isin(*NO_TEXT), x)


def clean_author(x: Column) -> Column:
    return F.when(~x.isin(*NO_AUTHOR), x)


def kind_of(doc: Column, path: str) -> Column:
    """``string``, ``number``, ``boolean``, ``object``, ``array``, ``null``; NULL where the path leads nowhere."""
    name = F.schema_of_variant(F.try_variant_get(doc, path, "variant"))
    return (
        F.when(name == "VOID", "null").when(name == "STRING", "string").when(name == "BOOLEAN", "boolean").when(name.startswith("OBJECT"), "object")
        .when(name.startswith("ARRAY"), "array").when(name.isNotNull(), "number")
    )


def text_at(doc: Column, path: str) -> Column:
    """A JSON string; any other type is NULL."""
    return F.when(kind_of(doc, path) == "string", F.try_variant_get(doc, path, "string"))


def number_at(doc: Column, path: str) -> Column:
    """A JSON number as double; booleans and numeric text are NULL."""
    return F.when(kind_of(doc, path) == "number", F.try_variant_get(doc, path, "double"))


def int_at(doc: Column, path: str, kind: str = "bigint") -> Column:
    """A JSON number cut toward zero; NULL beyond the type's range."""
    return number_at(doc, path).try_cast(kind)


def bool_at(doc: Column, path: str) -> Column:
    return F.when(kind_of(doc, path) == "boolean", F.try_variant_get(doc, path, "boolean"))


def was_edited(doc: Column, path: str = "$.edited") -> Column:
    """A boolean as it is, a positive number (a time) as true, everything else as false; never NULL."""
    return F.coalesce(bool_at(doc, path), number_at(doc, path) > 0, F.lit(False))


def stamp_at(doc: Column) -> Column:
    """The numeric second-retrieval stamp, else NULL."""
    return int_at(doc, "$._meta.retrieved_2nd_on")


def is_stamped(doc: Column) -> Column:
    """Whether the stamp's key is present, even with a null value."""
    return F.try_variant_get(doc, "$._meta.retrieved_2nd_on", "variant").isNotNull()


def has_settled_engagement(doc: Column, by_key: bool = False, exempt_before: int = EXEMPT_BEFORE) -> Column:
    """Engagement is final: before the exempt time, stamped, or any of the counters is off its placeholder.

    ``by_key`` takes the stamp's presence instead of its number; the two differ only for null and non-numeric stamps.
    """
    arms = [
        number_at(doc, "$.created_utc") < exempt_before,
        is_stamped(doc) if by_key else stamp_at(doc).isNotNull(),
        number_at(doc, "$.score") != 1,
        number_at(doc, "$.num_comments") != 0,
        number_at(doc, "$.upvote_ratio") != 1,
    ]
    settled = F.lit(False)
    for arm in arms:
        settled = settled | F.coalesce(arm, F.lit(False))
    return settled


def engagement_state(settled: Column, created: Column, at: Column, give_up_hours: int = 720) -> Column:
    """``settled``, ``abandoned`` (older than the retry horizon) or ``pending``."""
    return F.when(settled, "settled").when(at - created > give_up_hours * 3600, "abandoned").otherwise("pending")


def removal_category(by: Column, reason: Column) -> Column:
    """The first non-empty one of the two fields; an empty second field stays empty."""
    return F.coalesce(F.nullif(by, F.lit("")), reason)


def project(doc: Column, kind: Column, exempt_before: int = EXEMPT_BEFORE) -> dict[str, Column]:
    """The fixed 22-column row of a raw record. ``kind`` is ``post`` or ``comment``; the other kind's fields are NULL."""
    post = lambda c: F.when(kind == "post", c)
    comment = lambda c: F.when(kind == "comment", c)
    return {
        "id": text_at(doc, "$.id"),
        "kind": kind,
        "author": clean_author(text_at(doc, "$.author")),
        "created_utc": int_at(doc, "$.created_utc"),
        "score": int_at(doc, "$.score", "int"),
        "upvote_ratio": post(number_at(doc, "$.upvote_ratio")),
        "num_comments": post(int_at(doc, "$.num_comments", "int")),
        "title": post(clean_text(text_at(doc, "$.title"))),
        "selftext": post(clean_text(text_at(doc, "$.selftext"))),
        "body": comment(clean_text(text_at(doc, "$.body"))),
        "parent_id": comment(text_at(doc, "$.parent_id")),
        "link_id": comment(text_at(doc, "$.link_id")),
        "is_self": post(bool_at(doc, "$.is_self")),
        "over_18": bool_at(doc, "$.over_18"),
        "stickied": bool_at(doc, "$.stickied"),
        "distinguished": text_at(doc, "$.distinguished"),
        "edited": was_edited(doc),
        "author_flair_text": text_at(doc, "$.author_flair_text"),
        "link_flair_text": post(text_at(doc, "$.link_flair_text")),
        "removal_category": removal_category(text_at(doc, "$.removed_by_category"), text_at(doc, "$.removal_reason")),
        "engagement_settled": has_settled_engagement(doc, exempt_before=exempt_before),
        "retrieved_2nd_on": stamp_at(doc),
    }
