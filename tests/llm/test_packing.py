from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larkspur.llm import packing
from larkspur.llm.tokens import token_counts


def holds(bins, sizes, capacity):
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= capacity for b in bins)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=40), st.integers(0, 5))
def test_breeding_keeps_every_item_once_and_is_repeatable(sizes, seed):
    p = packing.Breeding(generations=8)
    best = packing.evolve(sizes, 50, [], p, np.random.default_rng(seed))[0]
    for bins in best:
        holds(bins, sizes, 50)
    assert best == packing.evolve(sizes, 50, [], p, np.random.default_rng(seed))[0]
    first = packing.best_fit(sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)), sizes, 50, [])
    assert len(best[0]) <= len(first)


def test_breeding_finds_a_packing_that_best_fit_misses():
    sizes = [44, 24, 24, 22, 21, 17, 8, 8, 6, 6, 2, 2, 37, 31, 29, 9, 7, 3]
    assert sum(sizes) == 300
    best, born = packing.evolve(sizes, 100, [], packing.Breeding(generations=400, population=12), np.random.default_rng(0))
    assert len(best[0]) == 3


def planted(bins: int, seed: int) -> list[int]:
    """Sizes of which three at a time just fill a bin of 1000, and two of the largest no bin well."""
    rng, sizes = np.random.default_rng(seed), []
    for _ in range(bins):
        a = int(rng.integers(380, 490))
        b = int(rng.integers(250, (1000 - a) // 2 + 1))
        sizes += [a, b, 1000 - a - b]
    return sizes


def test_default_breeding_beats_best_fit_on_planted_triplets():
    for seed in range(3):
        sizes = planted(40, seed)
        first = packing.best_fit(sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)), sizes, 1000, [])
        best, born = packing.evolve(sizes, 1000, [], packing.Breeding(), np.random.default_rng(seed))
        holds(best[0], sizes, 1000)
        assert born > 0 and len(best[0]) < len(first) and len(best[0]) <= 42


def test_report_of_breeding_on_a_planted_table(spark):
    items = spark.createDataFrame([(i, n) for i, n in enumerate(planted(60, 8))], "doc_id long, n_tokens long")
    kinds = spark.createDataFrame([("k", 1000)], "container_name string, capacity_tokens int")
    r = packing.breeding_report(items, kinds).collect()[0]
    assert r["bred_cells"] == r["n_cells"] == 1 and r["children"] > 0 and r["bound_bins"] == 60 <= r["bins"] < r["best_fit_bins"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=30), st.integers(0, 9))
def test_exchange_loses_nothing_and_overfills_nothing(sizes, seed):
    rng = np.random.default_rng(seed)
    bins = packing.best_fit(list(range(len(sizes))), sizes, 60, [])
    loose = bins.pop(int(rng.integers(len(bins))))
    before = [sum(sizes[i] for i in b) for b in bins]
    left = packing.exchange(bins, loose, sizes, 60)
    assert sorted([i for b in bins for i in b] + left) == list(range(len(sizes)))
    assert all(x <= sum(sizes[i] for i in b) <= 60 for x, b in zip(before, bins))


def _pack(spark, data, containers=(("s", 10), ("l", 100)), **p):
    items = spark.createDataFrame(data, "doc_id long, n_tokens long")
    kinds = spark.createDataFrame(list(containers), "container_name string, capacity_tokens int")
    return packing.pack(items, kinds, packing.Breeding(**p)), kinds


def test_packing_is_whole_and_within_capacity(spark):
    rng = np.random.default_rng(5)
    data = [(i, int(rng.integers(0, 35))) for i in range(500)] + [(1000, None), (1001, 0), (1002, 10), (1003, 250)]
    packed, kinds = _pack(spark, data, bins_per_cell=20)
    bins = packed.groupBy("container_name", "bin_id").agg(F.sum("n_tokens").alias("t")).join(kinds, "container_name")
    assert bins.filter("t > capacity_tokens").count() == 0
    sizes = {i: n or 0 for i, n in data}
    for r in packed.groupBy("container_name", "doc_id").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("n"), F.countDistinct("piece").alias("k")).collect():
        capacity = {"s": 10, "l": 100}[r["container_name"]]
        assert r["t"] == sizes[r["doc_id"]] and r["n"] == r["k"] == max(1, -(-sizes[r["doc_id"]] // capacity))
    report = {r["container_name"]: r for r in packing.fill_report(packed, kinds).collect()}
    assert report["l"]["fill"] > 0.95 and report["s"]["fill"] > 0.9
    assert sorted(map(tuple, packed.collect())) == sorted(map(tuple, _pack(spark, data, bins_per_cell=20)[0].collect()))


def test_packing_of_nothing(spark):
    assert _pack(spark, [])[0].count() == 0
    assert _pack(spark, [(1, 5)], containers=[("x", 0), ("y", None)])[0].count() == 0
    assert _pack(spark, [(1, 5)], containers=[("x", 9), ("x", 9)])[0].count() == 1
    assert _pack(spark, [(1, 5)], containers=[(f"c{i}", i + 5) for i in range(100)])[0].count() == 100


def test_token_counts_of_empty_long_and_special_texts(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, ""), (3, None), (4, "<|endoftext|>"), (5, "a" * 200_000), (6, "🚀 é\n\n")], "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts(df).collect()}
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] > 1 and got[5] > 1000 and got[6] > 2
