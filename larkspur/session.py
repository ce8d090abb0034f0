"""Session settings every plan here relies on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",  # batches of very long texts must fit a worker
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def session(app: str = "larkspur", **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` adds to or replaces them (dots as double underscores)."""
    own = {key.replace("__", "."): value for key, value in conf.items()}
    return SparkSession.builder.appName(app).config(map=SETTINGS | own).getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable settings to a session somebody else made."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")
