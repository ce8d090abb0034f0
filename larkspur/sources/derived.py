"""The derived layer: partitioned Parquet, series with receipts, compact JSON, review files and manifests."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.sources import schemas


def write_partitions(rows: DataFrame, path: str, keys: tuple[str, ...] = ("kind", "subreddit", "month_label"), mode: str = "overwrite") -> None:
    """zstd Parquet by partition, sorted by (created_utc or 0, id) in each file; only the partitions present are replaced.

    Rows are rebalanced by partition key, so a partition is one file until it outgrows the advised size.
    """
    order = [*keys, F.coalesce("created_utc", F.lit(0)), "id"] if "created_utc" in rows.columns else [*keys, "id"]
    spread = rows.hint("rebalance", *[F.col(k) for k in keys]).sortWithinPartitions(*order)
    spread.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*keys).parquet(path)


def read(spark: SparkSession, *paths: str) -> DataFrame:
    """One or several partitioned tables as one; filters on the keys prune partitions."""
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    return spark.read.parquet(*paths)


def partitions(table: DataFrame, keys: list[str]) -> DataFrame:
    return table.select(*keys).distinct()


def write_series(series: DataFrame, path: str, keys: list[str], note: str = "the last two days are partial") -> DataFrame:
    """Store a series and its receipt (rows, first and last date, totals) beside it; returns the receipt."""
    from larkspur.operators.series import receipt

    series.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/data")
    stored = series.sparkSession.read.parquet(f"{path}/data")
    said = receipt(stored, keys).withColumn("note", F.lit(note))
    said.write.mode("overwrite").json(f"{path}/receipt")
    return said


def write_json(document: DataFrame, path: str) -> None:
    """Rows as compact JSON, one document a line; NULL fields are kept."""
    document.select(F.to_json(F.struct(*document.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def export_review(labels: DataFrame, path: str) -> None:
    """Labels as CSV for review: tags joined by ``;``, the map as JSON, least sure first.

    The files are parts of one order: those of the first part come before those of the next. Small tables give one part.
    """
    sure = F.when(F.col("confidence") == "low", 0).when(F.col("confidence") == "medium", 1).otherwise(2)
    flat = labels.select("doc_id", F.array_join("tags", ";").alias("tags"), "overall_sentiment", "no_sentiment", F.to_json("tag_sentiment").alias("tag_sentiment"), "confidence", "rationale", sure.alias("_sure"))
    flat.orderBy("_sure", "doc_id").drop("_sure").write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def import_review(spark: SparkSession, path: str) -> DataFrame:
    """Reviewed CSV back to typed label rows; an unreadable edit fails the job when it is read."""
    rows = spark.read.schema(schemas.REVIEW).option("mode", "FAILFAST").option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    flag = F.lower(F.trim("no_sentiment"))
    truth = F.when(flag.isin("true", "1", "yes"), True).when(flag.isin("false", "0", "no", ""), False).otherwise(F.raise_error(F.concat("doc_id", F.lit(": unreadable no_sentiment"))).cast("boolean"))
    tags = F.filter(F.transform(F.split(F.coalesce("tags", F.lit("")), ";"), lambda t: F.trim(t)), lambda t: t != "")
    return rows.select(
        "doc_id", tags.alias("tags"), F.trim("overall_sentiment").cast("int").alias("overall_sentiment"), truth.alias("no_sentiment"),
        F.from_json("tag_sentiment", "map<string,int>", {"mode": "FAILFAST"}).alias("tag_sentiment"), F.lower(F.trim("confidence")).alias("confidence"), F.trim("rationale").alias("rationale"),
    )


def write_labels(labels: DataFrame, path: str, force: bool = False) -> None:
    """Labels with the map as JSON text; an existing table is kept unless ``force`` is set."""
    labels.withColumn("tag_sentiment", F.to_json("tag_sentiment")).write.mode("overwrite" if force else "errorifexists").parquet(path)


class Manifest:
    """Partition label to fingerprint: a table under ``path`` to which every finished wave is appended; later waves win.

    A broken run goes on after the last wave that was appended. ``path`` may lie in any file system that Spark writes to.
    """

    SCHEMA = "label string, fingerprint string, wave long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def commit(self, built: DataFrame) -> None:
        """Add the labels and fingerprints of a wave."""
        built.select("label", "fingerprint", F.lit(time.time_ns()).alias("wave")).write.mode("append").parquet(self.path)

    def table(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.SCHEMA).drop("wave")
        return self.spark.read.schema(self.SCHEMA).parquet(self.path).groupBy("label").agg(F.max_by("fingerprint", "wave").alias("fingerprint"))
