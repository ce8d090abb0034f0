"""Per-key results where a few keys hold most rows.

Every measure is algebraic, so each task folds its rows into a hash table of key states (Spark's partial hash
aggregate, which sorts and spills states once the table is full) and only one state per key and task is shuffled.
A key with a third of all rows costs its final task no more than one state per map task. Distinct counts are folded
twice: first per (key, value), then per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def melt_keys(df: DataFrame, keys: list[str], carry: list[str]) -> DataFrame:
    """One row per row and key column: ``field_name``, ``key_value`` and the carried columns."""
    pairs = F.array(*[F.struct(F.lit(k).alias("field_name"), F.col(k).cast("string").alias("key_value")) for k in keys])
    inside = [c for c in carry if c not in ("field_name", "key_value")]
    return df.select(F.explode(pairs).alias("_k"), *inside).select("_k.field_name", "_k.key_value", *inside)


def combine_by_key(df: DataFrame, keys: list[str], measures: dict[str, Column], carry: list[str] | None = None) -> DataFrame:
    """``measures`` per value of each column in ``keys``, in one scan.

    NULL is a key value of its own here (callers drop it where NULL is no key). An empty table gives no rows; columns of
    ``df`` other than ``keys`` and ``carry`` are never read, so clashing names do no harm. Repeated rows count each time.
    """
    melted = melt_keys(df, keys, carry or [])
    return melted.groupBy("field_name", "key_value").agg(*[c.alias(n) for n, c in measures.items()])


def heavy_keys(df: DataFrame, keys: list[str], percent: int = 2) -> DataFrame:
    """``field_name``, ``key_value``, ``n_rows`` of values held by at least ``percent`` % of all rows.

    At most ``100 / percent`` rows per key column. Rows with NULL count in the total but are no key; ties with the bound
    are kept; an empty table has no heavy keys.
    """
    counts = combine_by_key(df, keys, {"n_rows": F.count(F.lit(1))})
    total = df.agg(F.count(F.lit(1)).alias("_total"))  # no column is read for it
    return (
        counts.join(F.broadcast(total))  # one row
        .filter(F.col("key_value").isNotNull() & (F.col("n_rows") * 100 >= F.col("_total") * percent))
        .drop("_total")
    )
