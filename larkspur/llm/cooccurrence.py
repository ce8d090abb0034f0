"""How often two items stand in the same basket, and how much more often than chance.

Large baskets are cut into chunks before anything of theirs is gathered: each item goes to a chunk by hash, so no task
ever holds a whole basket, and every pair of chunks becomes a product of its own. Small baskets are folded to distinct
item sets with a weight. Products are spread over tasks; counts are combined on the map side, and only one count per pair
and task is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.scratch import materialize


def basket_rows(df: DataFrame, keys: list[str], items: str) -> DataFrame:
    """``keys, _items``: the distinct items that each row adds to its basket.

    Rows of one basket are united. Rows with a NULL key are no basket; NULL items, NULL and empty arrays add nothing.
    """
    known = df.filter(F.col(items).isNotNull())
    for key in keys:
        known = known.filter(F.col(key).isNotNull())
    return known.select(*keys, F.array_distinct(F.array_compact(items)).alias("_items")).filter(F.size("_items") > 0)


def large_baskets(rows: DataFrame, keys: list[str], chunk: int) -> DataFrame:
    """``keys, _c``: baskets of more than ``chunk`` items, repeats between rows counted, and into how many chunks they go (stored)."""
    sizes = rows.groupBy(*keys).agg(F.sum(F.size("_items")).alias("_n")).filter(F.col("_n") > chunk)
    return materialize(sizes.select(*keys, F.ceil(F.col("_n") / chunk).cast("int").alias("_c")), "large-baskets")


def chunk_products(rows: DataFrame, keys: list[str], large: DataFrame) -> DataFrame:
    """``left, right, weight, same, whole``: item arrays whose products make up the pairs of all baskets.

    Small baskets (``whole``) and chunks with themselves are ``same``. A chunk of a large basket is sent to all pairs of
    chunks that it is part of, a row per item, and gathered there; the chunks of one basket share no item.
    """
    small = rows.join(large.select(*keys), keys, "left_anti").select(*keys, F.explode("_items").alias("_item")).groupBy(*keys).agg(F.array_sort(F.collect_set("_item")).alias("left"))
    whole = small.groupBy("left").agg(F.count(F.lit(1)).alias("weight")).select("left", F.col("left").alias("right"), "weight", F.lit(True).alias("same"), F.lit(True).alias("whole"))
    dealt = rows.join(large, keys).select(*keys, "_c", F.explode("_items").alias("_item")).distinct().withColumn("_k", F.pmod(F.xxhash64("_item"), F.col("_c")).cast("int"))
    sent = dealt.select(*keys, "_item", "_k", F.explode(F.sequence(F.lit(0), F.col("_c") - 1)).alias("_o"))
    side = lambda belongs: F.array_sort(F.collect_set(F.when(belongs, F.col("_item"))))
    met = sent.groupBy(*keys, F.least("_k", "_o").alias("_i"), F.greatest("_k", "_o").alias("_j")).agg(side(F.col("_k") <= F.col("_o")).alias("left"), side(F.col("_k") >= F.col("_o")).alias("right"))
    return whole.unionByName(met.select("left", "right", F.lit(1).cast("long").alias("weight"), (F.col("_i") == F.col("_j")).alias("same"), F.lit(False).alias("whole")))


def pair_counts(products: DataFrame) -> DataFrame:
    """``item_a < item_b`` (byte by byte) and ``n_ab``, the number of baskets with both."""
    pairs = products.select("left", "weight", "same", F.explode("right").alias("_r")).select("_r", "weight", "same", F.explode("left").alias("_l"))
    once = pairs.filter(F.when(F.col("same"), F.col("_l") < F.col("_r")).otherwise(True))
    return once.groupBy(F.least("_l", "_r").alias("item_a"), F.greatest("_l", "_r").alias("item_b")).agg(F.sum("weight").alias("n_ab"))


def associations(df: DataFrame, keys: list[str], items: str, chunk: int = 16) -> DataFrame:
    """``item_a, item_b, n_ab, n_a, n_b, n_all``: every pair that occurs, its count, both item counts, all baskets.

    An empty table gives no rows; a basket of one item gives no pair but counts in ``n_a`` and ``n_all``.
    """
    rows = basket_rows(df, keys, items)
    large = large_baskets(rows, keys, chunk)
    products = materialize(chunk_products(rows, keys, large), "products")
    # Every item of a basket stands in just one product that is a basket or a chunk with itself.
    single = materialize(products.filter("same").select(F.explode("left").alias("item"), "weight").groupBy("item").agg(F.sum("weight").alias("n")), "items")
    total = products.filter("whole").select("weight").unionByName(large.select(F.lit(1).cast("long").alias("weight"))).agg(F.sum("weight").alias("n_all"))
    a = single.select(F.col("item").alias("item_a"), F.col("n").alias("n_a"))
    b = single.select(F.col("item").alias("item_b"), F.col("n").alias("n_b"))
    scored = pair_counts(products).join(a, "item_a").join(b, "item_b").join(F.broadcast(total))  # total is one row
    return scored.select("item_a", "item_b", "n_ab", "n_a", "n_b", "n_all")


def product(x: str, y: str, times: int = 1) -> Column:
    """Exact product of two counts; 64 bits would overflow beyond some billions of baskets."""
    return F.col(x).cast("decimal(18,0)") * F.col(y).cast("decimal(18,0)") * times


def lift(digits: int = 6) -> Column:
    """Observed over expected count."""
    return F.round(F.col("n_ab").cast("double") * F.col("n_all") / (F.col("n_a").cast("double") * F.col("n_b")), digits)
