"""Intermediate tables in the folder that all executors share.

Lineage is cut by writing Parquet there, so a lost executor costs a re-read and not a recomputation.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a local temporary folder only where that is unset."""
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="larkspur-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return f"file://{_local_root}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/larkspur/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by ``materialize`` that nothing reads any more."""
    spark = df.sparkSession
    root = f"{shared_dir(spark)}/larkspur/"
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.split(":", 1)[-1].lstrip("/").startswith(root.split(":", 1)[-1].lstrip("/")):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
