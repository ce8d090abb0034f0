from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from larkspur.llm import cooccurrence as co


def brute(baskets):
    pairs, single, n = Counter(), Counter(), 0
    for items in baskets:
        items = sorted(set(items))
        n += bool(items)
        single.update(items)
        pairs.update(combinations(items, 2))
    return {(a, b, k, single[a], single[b], n) for (a, b), k in pairs.items()}


def test_associations_with_large_baskets(spark):
    rng = np.random.default_rng(1)
    baskets = [[f"t{int(x)}" for x in rng.integers(0, 40, size)] for size in (1, 2, 3, 5, 30, 200, 0, 7)]
    df = spark.createDataFrame([("k", str(i), b) for i, b in enumerate(baskets)], "kind string, id string, tags array<string>")
    for chunk in (3, 64):
        assert {tuple(r) for r in co.associations(df, ["kind", "id"], "tags", chunk).collect()} == brute(baskets)


def test_nulls_repeats_clashing_names_and_empty_tables(spark):
    data = [("k", "1", ["a", "b", None, "a"], "x"), ("k", "1", ["b", "a"], "x"), ("k", "1", ["c"], "x"), ("k", None, ["a", "b"], "x"), ("k", "2", None, "x"), ("k", "3", [], "x"), ("j", "1", ["a"], "x")]
    df = spark.createDataFrame(data, "kind string, id string, tags array<string>, items string")
    assert {tuple(r) for r in co.associations(df, ["kind", "id"], "tags").collect()} == {("a", "b", 1, 2, 1, 2), ("a", "c", 1, 2, 1, 2), ("b", "c", 1, 1, 1, 2)}
    assert co.associations(df.limit(0), ["kind", "id"], "tags").count() == 0


def test_a_huge_basket_is_never_gathered(spark):
    each = spark.range(1000).select(F.lit("b").alias("k"), F.array(F.lpad(F.col("id").cast("string"), 4, "0")).alias("_items"))
    products = co.chunk_products(each, ["k"], co.large_baskets(each, ["k"], 100))
    sizes = products.agg(F.count(F.lit(1)), F.max(F.greatest(F.size("left"), F.size("right")))).collect()[0]
    assert sizes[0] == 55 and sizes[1] < 150  # ten chunks, dealt by hash
    assert co.pair_counts(products).agg(F.count(F.lit(1)), F.max("n_ab")).collect()[0][:] == (1000 * 999 // 2, 1)


def test_repeated_rows_make_a_basket_large_but_count_once(spark):
    df = spark.createDataFrame([("k", "1", ["a", "b"])] * 20 + [("k", "2", ["b"])] * 3, "kind string, id string, tags array<string>")
    assert [tuple(r) for r in co.associations(df, ["kind", "id"], "tags", 4).collect()] == [("a", "b", 1, 1, 2, 2)]
