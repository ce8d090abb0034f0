"""Mixing sources to target shares of the tokens by entropy balancing.

Document rates are the closest ones to one copy each, in relative entropy, that meet every source's token total and stay
within its repeats: ``min(cap, exp(lambda * tokens / mean))`` with one multiplier per source, the root of the convex
dual. Newton steps for all sources are taken together; a step is one aggregate over the documents that returns two
numbers per source. Rates are rounded to copies by a hashed draw whose threshold is then set, per source, so that the
copies' tokens come just under the total, and the largest documents that fit fill up the rest.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_SOURCES = 10_000
GRID = 1024


@dataclass
class Source:
    """A source's target and state of the search."""

    share: float
    cap: int
    tokens: int = 0
    mean: float = 1.0
    need: float = 0.0
    tilt: float = 0.0
    low: float = -math.inf
    high: float = math.inf
    capped: bool = False
    miss: float = 1.0
    rest: float = 0.0
    start: float = -1.0
    over: float = math.inf
    shift: float = 0.0


def _lookup(sources: dict[str, Source], value, default: float = 0.0) -> Column:
    """A per-source number as a column; at most ``MOST_SOURCES`` entries."""
    flat = [F.lit(x) for name, s in sources.items() for x in (name, float(value(s)))]
    return F.coalesce(F.try_element_at(F.create_map(*flat), F.col("source")), F.lit(default))


def plan(sizes: DataFrame, targets: DataFrame, budget: float | None = None, tolerance: float = 1e-10, most_steps: int = 100) -> dict[str, Source]:
    """Multipliers per source. ``budget`` is the mix's size in tokens, by default the largest that the caps allow."""
    rows = targets.filter(F.col("source").isNotNull() & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)).groupBy("source").agg(F.max("target_share"), F.max("max_repeats")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    stated = {r[0]: Source(float(r[1]), int(r[2])) for r in rows}
    if not stated:
        return {}
    for r in sizes.filter(F.col("source").isin(list(stated))).groupBy("source").agg(F.sum("n_tokens").alias("t"), F.avg("n_tokens").alias("m")).collect():
        stated[r["source"]].tokens, stated[r["source"]].mean = r["t"] or 0, r["m"] or 1.0
    live = {n: s for n, s in stated.items() if s.tokens > 0}
    if not live:
        return {}
    whole = sum(s.share for s in live.values())
    most = min(s.cap * s.tokens * whole / s.share for s in live.values())
    size = most if budget is None else min(budget, most)
    for s in live.values():
        s.need = size * s.share / whole
        s.capped = s.need >= s.cap * s.tokens * (1 - 1e-12)
    for _ in range(most_steps):
        open_ = {n: s for n, s in live.items() if not s.capped and s.low < s.high and abs(s.miss) > tolerance}
        if not open_:
            break
        x = F.col("n_tokens") / _lookup(open_, lambda s: s.mean, 1.0)
        raw = F.exp(F.least(_lookup(open_, lambda s: s.tilt) * x, F.lit(700.0)))
        cap = _lookup(open_, lambda s: s.cap, 1.0)
        got = F.sum(F.col("n_tokens") * F.least(raw, cap)).alias("got")
        slope = F.sum(F.when(raw < cap, F.col("n_tokens") * x * raw).otherwise(0.0)).alias("slope")
        for r in sizes.filter(F.col("source").isin(list(open_))).groupBy("source").agg(got, slope).collect():
            s = open_[r["source"]]
            miss = r["got"] - s.need
            s.miss = miss / s.need
            if miss < 0:
                s.low = s.tilt
            else:
                s.high = s.tilt
            step = s.tilt - miss / r["slope"] if r["slope"] > 0 else math.nan
            if not s.low < step < s.high:  # outside the bracket or flat: halve it, or double away while it is open
                if math.isinf(s.low):
                    step = min(-1.0, 2 * s.high)
                elif math.isinf(s.high):
                    step = max(1.0, 2 * s.low)
                else:
                    step = (s.low + s.high) / 2
            if abs(s.miss) > tolerance:
                s.tilt = step
                if step in (s.low, s.high):
                    s.low = s.high  # no number lies between
    return live


def _rated(sizes: DataFrame, live: dict[str, Source]) -> DataFrame:
    """``doc_id, source, n_tokens, rate, base, edge``: a document gets one copy more if the source's shift exceeds edge."""
    x = F.col("n_tokens") / _lookup(live, lambda s: s.mean, 1.0)
    cap = _lookup(live, lambda s: s.cap)
    tilted = F.least(F.exp(F.least(_lookup(live, lambda s: s.tilt) * x, F.lit(700.0))), cap)
    rate = F.when(_lookup(live, lambda s: s.capped) > 0, cap).otherwise(tilted)
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(20), "doc_id"), 11).cast("double") / float(1 << 53)
    rated = sizes.filter(F.col("source").isin(list(live))).withColumn("rate", rate).withColumn("base", F.floor("rate"))
    edge = F.when(F.col("base") < cap, draw - (F.col("rate") - F.col("base"))).otherwise(F.lit(2.0))
    return rated.select("doc_id", "source", "n_tokens", "rate", "base", edge.alias("edge"))


def _settle(rated: DataFrame, live: dict[str, Source]) -> None:
    """Set each source's shift to the last edge at which the copies' tokens stay within its need, by histograms of the edges."""
    for r in rated.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("base")).alias("t")).collect():
        live[r["source"]].rest = live[r["source"]].need - r["t"]
    width = 2.0 / GRID
    for _ in range(3):
        low = _lookup(live, lambda s: s.start)
        at = F.floor((F.col("edge") - low) / width)
        sums: dict[str, dict[int, int]] = {n: {} for n in live}
        for r in rated.filter((at >= 0) & (at < GRID)).groupBy("source", at.cast("int").alias("at")).agg(F.sum("n_tokens").alias("t")).collect():  # at most sources times GRID rows
            sums[r["source"]][r["at"]] = r["t"]
        for n, s in live.items():
            for k in range(GRID):
                gain = sums[n].get(k, 0)
                if gain > s.rest:
                    s.start += k * width
                    s.over = gain
                    break
                s.rest -= gain
            else:
                s.start += GRID * width
                s.over = math.inf
        width /= GRID
    for s in live.values():
        s.shift = s.start


def _top_up(rated: DataFrame, live: dict[str, Source], passes: int = 3) -> DataFrame:
    """``doc_id`` of at most ``passes`` documents per source that fill what the shift left short: each time the largest
    one that still fits and may be repeated once more."""
    spark, doc_type = rated.sparkSession, rated.schema["doc_id"].dataType.simpleString()
    picked: list = []
    for _ in range(passes):
        copies = F.col("base") + (F.col("edge") < _lookup(live, lambda s: s.shift)).cast("long")
        free = rated.filter((copies < _lookup(live, lambda s: s.cap)) & (F.col("n_tokens") > 0) & (F.col("n_tokens") <= _lookup(live, lambda s: s.rest)))
        if picked:
            free = free.join(F.broadcast(spark.createDataFrame([(x,) for x in picked], f"doc_id {doc_type}")), "doc_id", "left_anti")
        for r in free.groupBy("source").agg(F.max(F.struct("n_tokens", -F.col("edge"), "doc_id")).alias("b")).collect():
            live[r["source"]].rest -= r["b"]["n_tokens"]
            picked.append(r["b"]["doc_id"])
    return spark.createDataFrame([(x, True) for x in picked], f"doc_id {doc_type}, _more boolean")


def mix(sizes: DataFrame, targets: DataFrame, budget: float | None = None) -> DataFrame:
    """``doc_id, source, n_tokens, rate, copies`` of the documents in the mix (``copies`` from 1 to ``max_repeats``).

    ``sizes`` (``doc_id, source, n_tokens``) is read several times: pass a stored table. Documents without a source or
    with one that has no target are left out; the shares of targets without documents are shared out over the rest in
    proportion; repeated targets of a source count once. No documents or no targets give no rows.
    """
    live = plan(sizes, targets, budget)
    if not live:
        return sizes.select("doc_id", "source", "n_tokens").filter(F.lit(False)).withColumns({"rate": F.lit(0.0), "copies": F.lit(0).cast("long")})
    rated = _rated(sizes, live)
    _settle(rated, live)
    more = _top_up(rated, live)
    extra = (F.col("edge") < _lookup(live, lambda s: s.shift)).cast("long") + F.col("_more").isNotNull().cast("long")
    out = rated.join(F.broadcast(more), "doc_id", "left").withColumn("copies", F.col("base") + extra).filter(F.col("copies") > 0)
    return out.select("doc_id", "source", "n_tokens", F.round("rate", 6).alias("rate"), "copies")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, target_share, actual_share, n_docs, n_copies, most_copies, n_tokens`` for every target, empty ones too."""
    per = mixed.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("copies").alias("n_copies"), F.max("copies").alias("most_copies"), F.sum(F.col("copies") * F.col("n_tokens")).alias("n_tokens"))
    stated = targets.filter(F.col("source").isNotNull()).groupBy("source").agg(F.max("target_share").alias("target_share"))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_docs", "n_copies", "most_copies", "n_tokens")}
    joined = stated.join(per, "source", "left").withColumns(zero)
    whole = joined.agg(F.sum("n_tokens").alias("_all"))
    return joined.join(F.broadcast(whole)).select("source", "target_share", F.round(F.coalesce(F.try_divide("n_tokens", "_all"), F.lit(0.0)), 6).alias("actual_share"), "n_docs", "n_copies", "most_copies", "n_tokens")
