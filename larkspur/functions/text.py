"""Text expressions: assembling, measuring, tagging, labels and JSON found in prose."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur.sources.taxonomy import Tag

# Bounds of the length buckets and of the text handed to scorers, and the token pattern of the term statistics.
SHORT_WORDS, LONG_WORDS, MOST_CHARS = 25, 150, 8000
TOKEN = r"[a-z][a-z'’\-]{1,24}"


def enrich_text(title: Column, selftext: Column) -> Column:
    """Non-empty parts joined by a blank line; empty text where there are none."""
    return F.concat_ws("\n\n", F.nullif(title, F.lit("")), F.nullif(selftext, F.lit("")))


def post_text(title: Column, selftext: Column) -> Column:
    """Title, and the text below it if there is one; a missing title is empty."""
    head = F.coalesce(title, F.lit(""))
    return F.when(selftext.isNotNull(), F.concat(head, F.lit("\n\n"), selftext)).otherwise(head)


def sample_text(title: Column, selftext: Column) -> Column:
    return F.concat_ws(" ", title, selftext)


def is_filled(x: Column) -> Column:
    return x.isNotNull() & (F.trim(x) != "")


def word_count(x: Column) -> Column:
    return F.size(F.split(F.trim(x), r"[ \t\n\f\r]+"))  # the reference's white space: no vertical tab


def length_bucket(words: Column) -> Column:
    return F.when(words < SHORT_WORDS, "short").when(words > LONG_WORDS, "long").otherwise("medium")


def truncated(x: Column, most: int = MOST_CHARS) -> Column:
    return F.when(F.length(x) > most, F.concat(F.substring(x, 1, most), F.lit("\n[truncated]"))).otherwise(x)


def slug(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(x), r"[^a-z0-9.-]+", "-"), r"^-+|-+$", "")


def context(title: Column, parent_body: Column, most: int | None = None) -> Column:
    """Thread title and parent comment as labelled lines; ``most`` cuts the parent."""
    parent = parent_body if most is None else F.substring(parent_body, 1, most)
    return F.concat_ws("\n", F.when(title.isNotNull(), F.concat(F.lit("Post: "), title)), F.when(parent.isNotNull(), F.concat(F.lit("Parent: "), parent)))


# A word character of any script, written so that Java and RE2 agree on it; their own word boundaries differ.
WORD = r"\p{L}\p{N}_"


def _edge(character: str, anchor: str) -> str:
    """What stands beside a term's first or last character at a word boundary."""
    return rf"(?:{anchor}|[^{WORD}])" if character.isalnum() or character == "_" else f"[{WORD}]"


def tag_pattern(tag: Tag) -> str | None:
    """One alternation of all of a tag's terms, to be searched for; None for a tag without terms.

    Terms count as whole words in any case, strict ones as written or, in any case, behind a dollar sign.
    """
    ways = []
    for term in tag.terms:
        word, left, right = re.escape(term.text), _edge(term.text[0], "^"), _edge(term.text[-1], r"\z")
        ways += [f"{left}{word}{right}", rf"\$(?i:{word}){right}"] if term.strict else [f"{left}(?i:{word}){right}"]
    return "|".join(ways) or None


def tag_hit(x: Column, tag: Tag) -> Column:
    pattern = tag_pattern(tag)
    return F.coalesce(x.rlike(pattern), F.lit(False)) if pattern else F.lit(False)


def tags_for(x: Column, taxonomy: list[Tag]) -> Column:
    """Keys of the tags that occur, in taxonomy order; an empty array for NULL text."""
    return F.array_compact(F.array(*[F.when(tag_hit(x, t), F.lit(t.key)) for t in taxonomy])) if taxonomy else F.array().cast("array<string>")


def tags_joined(x: Column, taxonomy: list[Tag]) -> Column:
    return F.array_join(tags_for(x, taxonomy), ";")


def polarity_label(compound: Column, neutral: Column | None, pos: float, neg: float, neu_min: float = 2.0) -> Column:
    """``neu`` if the neutral share reaches ``neu_min`` (beyond 1: never), else by the compound's thresholds; NULL stays."""
    by_value = F.when(compound.isNull(), None).when(compound >= pos, "pos").when(compound <= neg, "neg").otherwise("neu")
    return by_value if neutral is None else F.when(compound.isNotNull() & (neutral >= neu_min), "neu").otherwise(by_value)


def three_way(level: Column) -> Column:
    return F.signum(level).cast("int")


# Names of the gauge's five bands from low to high, and the bounds between them.
BANDS = ("peak despair", "despondent", "neutral", "excited", "peak exuberance")
BAND_BOUNDS = (-1.5, -0.5, 0.5, 1.5)


def band(value: Column) -> Column:
    """Name of a gauge value; NULL for none. The two lower bounds belong to the lower band, the two upper ones to the higher."""
    a, b, c, d = BAND_BOUNDS
    level = F.when(value <= a, 1).when(value <= b, 2).when(value < c, 3).when(value < d, 4).when(value.isNotNull(), 5)
    return F.coalesce(*[F.when(level == i, F.lit(name)) for i, name in enumerate(BANDS, 1)])


def tokens(x: Column) -> Column:
    """Distinct lower-case tokens of a text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(x), F.lit(TOKEN), F.lit(0)))


def json_object_in(x: Column) -> Column:
    """The widest ``{...}`` of a text as VARIANT; NULL if there is none or it is no JSON."""
    return F.try_parse_json(F.nullif(F.regexp_extract(x, r"(?s)\{.*\}", 0), F.lit("")))


def json_array_in(x: Column) -> Column:
    """The widest ``[...]`` of a text as VARIANT."""
    return F.try_parse_json(F.nullif(F.regexp_extract(x, r"(?s)\[.*\]", 0), F.lit("")))
