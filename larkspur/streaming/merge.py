"""Structured Streaming into the exactly-once store: every micro-batch is one keyed merge.

There is no watermark: a correction that comes weeks late still replaces the copy it settles. A batch that Spark replays
after a failure carries the same id and is not applied twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from larkspur.operators.exactly_once import MessageStore


def merge_stream(stream: DataFrame, path: str, keys: list[str], order: Callable[[], list[Column | str]], partition: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Start merging a stream of deliveries into the store at ``path``; ``once`` takes what is there and stops."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        MessageStore(batch.sparkSession, path, keys, order(), partition).apply(batch, f"stream-{batch_id}")

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def merged(spark: SparkSession, path: str, keys: list[str], order: list[Column | str], partition: str) -> DataFrame:
    return MessageStore(spark, path, keys, order, partition).read()
