"""References to records that are missing, deleted or late.

References and parent keys are shuffled by the same key, sorted, and merged in one linear pass (a sort-merge join; both
streams advance together). Each parent key carries its validity interval ``[valid_from, valid_to)``: first arrival, and
first arrival of a delivery that marks it removed. A hot target is split over tasks by adaptive skew handling on the
reference side; the parent side holds one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_SPACES = {"t1_": "comment", "t3_": "post"}


def prefixed_references(df: DataFrame, table: str, kind: str, fields: list[str], arrived: str | None, period: str) -> DataFrame:
    """One row per stored reference: ``table_name, kind, id, field_name, space, target, arrived, period``.

    Rows without id are no references; NULL fields neither. A value without a known prefix has a NULL ``space``.
    """
    refs = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in fields]))
    prefix = F.substring("_r.value", 1, 3)
    space = F.coalesce(*[F.when(prefix == p, F.lit(s)) for p, s in PREFIX_SPACES.items()])
    return (
        df.filter(F.col("id").isNotNull())
        .select("id", (F.col(arrived) if arrived else F.lit(None).cast("timestamp")).alias("arrived"), F.col(period).alias("period"), refs.alias("_r"))
        .filter(F.col("_r.value").isNotNull())
        .select(
            F.lit(table).alias("table_name"), F.lit(kind).alias("kind"), "id", "_r.field_name",
            space.alias("space"), F.substring("_r.value", 4, 1 << 30).alias("target"), "arrived", "period",
        )
    )


def parent_intervals(df: DataFrame, space: str, arrived: str, removed: Column) -> DataFrame:
    """One row per id: ``space, target, valid_from, valid_to`` (NULL while never removed)."""
    return (
        df.filter(F.col("id").isNotNull())
        .groupBy(F.col("id").alias("target"))
        .agg(F.min(arrived).alias("valid_from"), F.min(F.when(removed, F.col(arrived))).alias("valid_to"))
        .select(F.lit(space).alias("space"), "target", "valid_from", "valid_to")
    )


def resolve(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """``refs`` with ``status``: ``ok``, ``missing``, ``late`` (arrived before its parent), ``deleted``, ``malformed``.

    ``parents`` has one row per (space, target). NULL equals nothing: a NULL target or space is ``malformed``, never
    ``missing``. Without an arrival time a reference is neither late nor deleted. Repeated references stay repeated.
    """
    r, p = refs.alias("r"), parents.withColumn("_found", F.lit(True)).alias("p")
    joined = r.join(p.hint("merge"), (F.col("r.space") == F.col("p.space")) & (F.col("r.target") == F.col("p.target")), "left")
    status = (
        F.when(F.col("r.space").isNull() | F.col("r.target").isNull(), "malformed")
        .when(F.col("_found").isNull(), "missing")
        .when(F.col("r.arrived") < F.col("valid_from"), "late")
        .when(F.col("r.arrived") >= F.col("valid_to"), "deleted")
        .otherwise("ok")
    )
    return joined.select("r.*", status.alias("status"))


def dangling_report(resolved: DataFrame) -> DataFrame:
    """Distinct references per table, period, field and status; a repeated one counts by its first delivery."""
    rank = F.when(F.col("status") == "ok", 1).otherwise(0)
    first = resolved.groupBy("table_name", "kind", "id", "field_name").agg(
        F.min(F.struct(F.coalesce("arrived", F.lit("1970-01-01").cast("timestamp")).alias("a"), rank.alias("k"), "period", "status")).alias("f")
    )
    return (
        first.groupBy("table_name", F.col("f.period").alias("month_label"), "field_name", F.col("f.status").alias("status"))
        .agg(F.count(F.lit(1)).alias("n_refs"))
    )
