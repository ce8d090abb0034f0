"""Explicit schemas; nothing is inferred."""

from __future__ import annotations

DERIVED = (
    "id string, kind string, author string, created_utc long, score int, upvote_ratio double, num_comments int, title string, selftext string, body string, "
    "parent_id string, link_id string, is_self boolean, over_18 boolean, stickied boolean, distinguished string, edited boolean, author_flair_text string, "
    "link_flair_text string, removal_category string, engagement_settled boolean, retrieved_2nd_on long"
)
ENRICH = "id string, tags array<string>, vader_compound double, vader_label string, enrich_version string"
RECEIPT = (
    "subreddit string, month_label string, kind string, collected_at string, keys_written long, rows long, last_created_utc long, seconds_unproven long, "
    "unproven_at array<long>, floor_violation_at array<long>, rows_unsettled long, oldest_unsettled_created_utc long, rows_abandoned long"
)
LABEL = (
    "doc_id string, doc_type string, tags array<string>, overall_sentiment int, no_sentiment boolean, tag_sentiment map<string,int>, confidence string, "
    "rationale string, reviewed boolean, split string"
)
REVIEW = "doc_id string, tags string, overall_sentiment string, no_sentiment string, tag_sentiment string, confidence string, rationale string"
