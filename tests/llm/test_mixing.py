from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm import mixing


def _data(spark, sizes, targets):
    s = spark.createDataFrame(sizes, "doc_id long, source string, n_tokens long").cache()
    return s, spark.createDataFrame(targets, "source string, target_share double, max_repeats int")


def _sizes():
    rng = np.random.default_rng(2)
    out = [(i, "big", int(rng.integers(1, 400))) for i in range(3000)]
    out += [(10_000 + i, "mid", int(rng.integers(1, 200))) for i in range(600)] + [(20_000 + i, "small", int(rng.integers(1, 300))) for i in range(120)]
    return out + [(30_000, None, 50), (30_001, "other", 50), (30_002, "mid", 0)]


TARGETS = [("big", 0.5, 1), ("mid", 0.3, 3), ("small", 0.2, 4), ("absent", 0.1, 2), (None, 0.1, 1)]


def test_shares_are_met_within_the_repeats(spark):
    sizes, targets = _data(spark, _sizes(), TARGETS)
    mixed = mixing.mix(sizes, targets)
    got = {r["source"]: r for r in mixing.shares(mixed, targets).collect()}
    whole = 0.5 + 0.3 + 0.2
    for name, share, cap in TARGETS[:3]:
        assert abs(got[name]["actual_share"] - share / whole) < 0.0005 and got[name]["most_copies"] <= cap
    assert got["absent"]["n_copies"] == 0 and got["absent"]["actual_share"] == 0 and len(got) == 4
    assert mixed.filter("source IS NULL OR source = 'other' OR copies < 1").count() == 0


def test_rates_are_tilted_exponentially_and_solve_the_dual(spark):
    sizes, targets = _data(spark, _sizes(), TARGETS)
    live = mixing.plan(sizes, targets, budget=40_000)
    rows = [r for r in _sizes()]
    for name, s in live.items():
        t = np.array([n for _, src, n in rows if src == name], float)
        rate = np.minimum(np.exp(s.tilt * t / s.mean), s.cap)
        assert math.isclose((rate * t).sum(), s.need, rel_tol=1e-6)
    assert math.isclose(sum(s.need for s in live.values()), 40_000)


def test_budget_is_kept(spark):
    sizes, targets = _data(spark, _sizes(), TARGETS)
    total = mixing.mix(sizes, targets, budget=40_000).agg(F.sum(F.col("copies") * F.col("n_tokens"))).collect()[0][0]
    assert abs(total - 40_000) < 60


def test_result_is_repeatable(spark):
    sizes, targets = _data(spark, _sizes(), TARGETS)
    assert sorted(map(tuple, mixing.mix(sizes, targets).collect())) == sorted(map(tuple, mixing.mix(sizes.repartition(7), targets).collect()))


@pytest.mark.parametrize("sizes, targets", [([], TARGETS), ([(1, "a", 5)], []), ([(1, "zz", 5)], TARGETS), ([(1, "big", 0)], TARGETS)])
def test_nothing_to_mix(spark, sizes, targets):
    s, t = _data(spark, sizes, targets)
    mixed = mixing.mix(s, t)
    assert mixed.count() == 0 and mixed.columns == ["doc_id", "source", "n_tokens", "rate", "copies"]
    assert mixing.shares(mixed, t).count() == len({x[0] for x in targets if x[0]})
