"""The raw layer: gz NDJSON parts, one JSON object per line, kept word for word."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import clean
from larkspur.operators.collection import parsed_keys


def read_lines(spark: SparkSession, *paths: str, root: str = "") -> DataFrame:
    """``file_key, line_no, record_json`` of all parts, blank lines left out; ``line_no`` grows along a file.

    Parts must be compressed as a whole (gz): such a part is read by one task from front to back, so the running number of
    its rows keeps their order and nothing is shuffled or held. ``root`` is cut from the front of the file's path to give
    the key.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(list(paths))
    file = F.regexp_replace(F.col("_metadata.file_path"), r"^file:/*(?=/)", "")
    numbered = lines.select(file.alias("file_key"), F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("record_json"))
    key = F.when(F.startswith("file_key", F.lit(root)), F.expr(f"substring(file_key, {len(root) + 1})")).otherwise(F.col("file_key"))
    return numbered.filter(F.trim("record_json") != "").withColumn("file_key", F.ltrim(key, F.lit("/")))


def derive(lines: DataFrame, exempt_before: int = clean.EXEMPT_BEFORE, strict: bool = True) -> DataFrame:
    """Raw lines to the fixed derived table with ``subreddit, month_label``: parse, keep one copy per id, project.

    A stamped copy beats an unstamped one, else the first seen by (file, line) stays; rows without an id go. A line that is
    no JSON fails the job, or is skipped if ``strict`` is off.
    """
    from larkspur.operators.series import first_settled

    parse = F.parse_json if strict else F.try_parse_json
    rows = parsed_keys(lines, "file_key").withColumn("doc", parse(F.col("record_json"))).filter(F.col("doc").isNotNull())
    kind = F.when(F.col("kind") == "posts", "post").otherwise("comment")
    fields = clean.project(F.col("doc"), kind)
    projected = rows.select("subreddit", "month_label", "file_key", "line_no", clean.is_stamped(F.col("doc")).alias("_stamped"), *[c.alias(n) for n, c in fields.items()])
    return first_settled(projected.filter(F.nullif("id", F.lit("")).isNotNull()), ["subreddit", "month_label", "kind", "id"], F.col("_stamped"), ["file_key", "line_no"], [*fields, "subreddit", "month_label"])


def write_parts(lines: DataFrame, path: str) -> None:
    """``file_key, line_no, record_json`` as gz parts in a folder per ``file_key``, lines in their order."""
    placed = lines.filter(F.trim("record_json") != "").repartition("file_key").sortWithinPartitions("file_key", "line_no")
    placed.select("file_key", F.col("record_json").alias("value")).write.partitionBy("file_key").option("compression", "gzip").text(path)


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_parts`` wrote, ``line_no`` counted anew."""
    folder = F.regexp_extract("file_key", "file_key=([^/]*)/", 1)
    return read_lines(spark, path, root=path).withColumn("file_key", F.url_decode(F.url_decode(folder)))
