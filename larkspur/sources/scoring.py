"""Scoring items with an external labelling service: prompt text, batched calls, resumable results."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import MOST_CHARS
from larkspur.operators.threads import without
from larkspur.sources.taxonomy import Tag

SCORE = "doc_id string, overall_sentiment int, tags array<string>, confidence string"
RETRIED = (429, 500, 502, 503, 504)


def prompt(rubric: str, taxonomy: list[Tag], exemplars: list[dict]) -> str:
    """The fixed part of the instruction: rubric, tags with their cues, and reviewed examples as JSON lines."""
    tags = [f"* {t.key}: {t.entity}" + (f" ({t.cues})" if t.cues else "") for t in taxonomy]
    shown = [json.dumps({"text": e["text"], "label": e["label"]}, ensure_ascii=False, sort_keys=True) for e in exemplars]
    return "\n\n".join([rubric.strip(), "Tags:\n" + "\n".join(tags), "Examples:\n" + "\n".join(shown)])


def item_view(row: dict, most: int = MOST_CHARS) -> dict:
    text = row["text"] or ""
    return {"doc_id": row["doc_id"], "context": row.get("context_text"), "text": text if len(text) <= most else text[:most] + "\n[truncated]"}


def _found(pattern: str, reply: str, kind: type):
    hit = re.search(pattern, reply, re.DOTALL)
    try:
        value = json.loads(hit[0]) if hit else None
    except ValueError:
        return None
    return value if isinstance(value, kind) else None


def object_in(reply: str) -> dict | None:
    return _found(r"\{.*\}", reply, dict)


def array_in(reply: str) -> list | None:
    return _found(r"\[.*\]", reply, list)


def ask(call: Callable[[str, list[dict]], tuple[int, str]], fixed: str, items: list[dict], tries: int = 4) -> str | None:
    for _ in range(tries):
        status, reply = call(fixed, items)
        if status == 200:
            return reply
        if status not in RETRIED:
            raise RuntimeError(f"the scorer said {status}: {reply[:200]}")
    return None


def score(items: DataFrame, call: Callable[[str, list[dict]], tuple[int, str]], fixed: str, keys: list[str], batch: int = 20) -> DataFrame:
    """``doc_id, overall_sentiment, tags, confidence``: items go out in batches; those a reply misses are asked for alone.

    ``call(fixed text, items)`` gives (status, reply text) and travels to the executors. Items without a valid label have
    no row.
    """

    def valid(label) -> bool:
        return isinstance(label, dict) and label.get("overall_sentiment") in (-2, -1, 0, 1, 2) and isinstance(label.get("tags"), list) and set(label["tags"]) <= set(keys)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows, out = [item_view(r) for r in frame.to_dict("records")], []
            for at in range(0, len(rows), batch):
                asked = rows[at : at + batch]
                labels = {x.get("doc_id"): x for x in array_in(ask(call, fixed, asked) or "") or [] if isinstance(x, dict)}
                for item in asked:
                    label = labels.get(item["doc_id"])
                    if not valid(label):
                        label = object_in(ask(call, fixed, [item]) or "")
                    if valid(label):
                        out.append((item["doc_id"], label["overall_sentiment"], label["tags"], label.get("confidence")))
            yield pd.DataFrame(out, columns=["doc_id", "overall_sentiment", "tags", "confidence"])

    return items.select("doc_id", "context_text", "text").mapInPandas(run, SCORE)


def score_missing(items: DataFrame, path: str, call, fixed: str, keys: list[str], batch: int = 20) -> int:
    """Score what ``path`` does not hold yet and append it; running it again goes on. Returns how many were added."""
    from larkspur.sources.derived import exists

    spark = items.sparkSession
    done = spark.read.schema(SCORE).json(path).select("doc_id").distinct() if exists(spark, path) else spark.createDataFrame([], "doc_id string")
    before = done.count()
    score(without(items.filter(F.col("doc_id").isNotNull()), done, "doc_id"), call, fixed, keys, batch).write.mode("append").json(path)
    return spark.read.schema(SCORE).json(path).select("doc_id").distinct().count() - before
