"""Filling containers of fixed capacity by a grouping genetic algorithm on islands.

Items are dealt by hash into cells of about ``bins_per_cell`` containers, which bounds what a task holds. Each cell is
bred on several islands: a crossover injects whole well-filled bins of one parent into another, drops the bins that now
hold an item twice, exchanges the displaced items for ones that fill a bin better, and best-fits the rest. After each epoch
an island's best packings migrate to the next island of the cell. The best packing of any island is the result.

A cell is perfect once all its bins but one are full. Best fit alone seldom gets there: it reaches the least number of bins
of a cell but leaves a little room in many of them. Breeding moves that room into one bin; these last bins of all cells are
then dealt and bred once more, so that the room of all cells together, not of each, is rounded up to whole bins.

Runs are seeded by cell, island and epoch, so a task that is run again gives the same packing.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from larkspur.scratch import materialize


@dataclass(frozen=True)
class Breeding:
    """Parameters of the search."""

    bins_per_cell: int = 128
    items_per_cell: int = 8000
    islands: int = 2
    epochs: int = 2
    population: int = 6
    generations: int = 12  # children per island and epoch
    elites: int = 2
    poor: float = 0.95  # bins filled less are packed once more
    seed: int = 7


def best_fit(order: list[int], sizes: list[int], capacity: int, bins: list[list[int]]) -> list[list[int]]:
    """Put each item into the bin that it leaves fullest; opens bins as needed. ``bins`` is extended in place."""
    room = sorted((capacity - sum(sizes[i] for i in b), at) for at, b in enumerate(bins))
    for item in order:
        size = sizes[item]
        at = bisect_left(room, (size, -1))
        if at < len(room):
            free, chosen = room.pop(at)
            bins[chosen].append(item)
        else:
            free, chosen = capacity, len(bins)
            bins.append([item])
        insort(room, (free - size, chosen))
    return bins


def fitness(bins: list[list[int]], sizes: list[int], capacity: int) -> float:
    """Mean squared fill: fewer bins, and of as many bins the more uneven ones, score higher."""
    return sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins) / max(1, len(bins))


def exchange(bins: list[list[int]], loose: list[int], sizes: list[int], capacity: int) -> list[int]:
    """Swap items of bins that have room for larger loose ones that still fit, while that fills them; returns what is loose then.

    Tried in turn for one item against one, two against one and one against two; the best gain of a bin is taken first.
    """
    pool = sorted((sizes[i], i) for i in loose)
    for b in bins:
        room = capacity - sum(sizes[i] for i in b)
        while room > 0 and pool:
            best = None  # (gain, items out, pool entries in)
            singles = [(sizes[i], (i,)) for i in b]
            pairs = [(sizes[b[x]] + sizes[b[y]], (b[x], b[y])) for x in range(min(len(b), 12)) for y in range(x)]
            for held, out in [(0, ()), *singles, *pairs]:
                at = bisect_right(pool, (held + room, 1 << 60)) - 1
                if at >= 0 and pool[at][0] > held and (best is None or pool[at][0] - held > best[0]):
                    best = (pool[at][0] - held, out, (pool[at],))
                    if best[0] == room:
                        break
            if best is None or best[0] < room:
                for held, out in singles:
                    for first in pool[:12]:
                        most = held + room - first[0]
                        at = bisect_right(pool, (most, 1 << 60)) - 1
                        if at >= 0 and pool[at] == first:
                            at -= 1
                        gain = first[0] + pool[at][0] - held if at >= 0 else 0
                        if gain > 0 and (best is None or gain > best[0]):
                            best = (gain, out, (first, pool[at]))
                    if best and best[0] == room:
                        break
            if best is None:
                break
            gain, out, into = best
            for entry in into:
                pool.pop(bisect_left(pool, entry))
                b.append(entry[1])
            for i in out:
                b.remove(i)
                insort(pool, (sizes[i], i))
            room -= gain
    return [i for _, i in pool]


def repaired(bins: list[list[int]], loose: list[int], sizes: list[int], capacity: int) -> list[list[int]]:
    """The bins with the loose items put back: exchanged where that fills a bin better, then best-fitted."""
    left = exchange(bins, loose, sizes, capacity) if loose else []
    return best_fit(sorted(left, key=lambda i: (-sizes[i], i)), sizes, capacity, bins)


def cross(giver: list[list[int]], taker: list[list[int]], sizes: list[int], capacity: int, rng: np.random.Generator) -> list[list[int]]:
    """Inject a random half of the giver's fuller bins into the taker and repair."""
    fill = np.array([sum(sizes[i] for i in b) for b in giver])
    fuller = np.argsort(-fill, kind="stable")[: max(1, (2 * len(giver)) // 3)]
    taken = [giver[k] for k in fuller[rng.random(len(fuller)) < 0.5]]
    present = {i for b in taken for i in b}
    child, displaced = [list(b) for b in taken], []
    for b in taker:
        left = [i for i in b if i not in present]
        if len(left) == len(b):
            child.append(list(b))
        else:
            displaced.extend(left)
    return repaired(child, displaced, sizes, capacity)


def dissolve(bins: list[list[int]], sizes: list[int], capacity: int, rng: np.random.Generator) -> list[list[int]]:
    """Mutation: empty the least filled bin and a few others and put back what they held."""
    fill = [sum(sizes[i] for i in b) for b in bins]
    drop = {int(np.argmin(fill)), *(int(k) for k in rng.integers(0, len(bins), 3))}
    loose = [i for k in drop for i in bins[k]]
    return repaired([list(b) for k, b in enumerate(bins) if k not in drop], loose, sizes, capacity)


def perfect(bins: list[list[int]], sizes: list[int], capacity: int, least: int) -> bool:
    """As few bins as can be, and all but one of them full."""
    return len(bins) <= least and sum(sum(sizes[i] for i in b) < capacity for b in bins) <= 1


def evolve(sizes: list[int], capacity: int, given: list[list[list[int]]], p: Breeding, rng: np.random.Generator) -> tuple[list[list[list[int]]], int]:
    """The best packings after ``p.generations`` from the given ones and random starts, best first, and the children bred."""
    if not sizes:
        return [[]], 0
    least = -(-sum(sizes) // capacity)
    people = list(given)
    if not people:
        people.append(best_fit(sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)), sizes, capacity, []))
    if perfect(people[0], sizes, capacity, least):
        return people[: p.elites], 0
    while len(people) < p.population:
        noise = rng.random(len(sizes)) * 0.3 + 0.85
        people.append(best_fit(sorted(range(len(sizes)), key=lambda i: -sizes[i] * noise[i]), sizes, capacity, []))
    scored = sorted(((fitness(b, sizes, capacity), b) for b in people), key=lambda s: (len(s[1]), -s[0]))
    born = 0
    while born < p.generations and not perfect(scored[0][1], sizes, capacity, least):
        a, b = sorted(rng.integers(0, len(scored), 2))
        child = cross(scored[a][1], scored[b][1], sizes, capacity, rng)
        if rng.random() < 0.5:
            child = dissolve(child, sizes, capacity, rng)
        scored = sorted([*scored, (fitness(child, sizes, capacity), child)], key=lambda s: (len(s[1]), -s[0]))[: p.population]
        born += 1
    return [b for _, b in scored[: p.elites]], born


def _labels(bins: list[list[int]], n: int) -> list[int]:
    out = [0] * n
    for at, b in enumerate(bins):
        for i in b:
            out[i] = at
    return out


def _bins(labels) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in range(int(max(labels)) + 1)]
    for i, at in enumerate(labels):
        out[at].append(i)
    return [b for b in out if b]


def _breed(epoch: int, p: Breeding):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                sizes = [int(s) for s in r.sizes]
                capacity = int(r.capacity)
                rng = np.random.default_rng([p.seed, r.place, r.cell, r.island, epoch])
                given = [_bins(x) for x in (r.packings if r.packings is not None else [])]
                best, born = evolve(sizes, capacity, given, p, rng)
                rows.append((r.place, r.capacity, r.cell, r.island, sizes, [_labels(b, len(sizes)) for b in best], len(best[0]), fitness(best[0], sizes, capacity), int(r.born or 0) + born))
            yield pd.DataFrame(rows, columns=["place", "capacity", "cell", "island", "sizes", "packings", "n_bins", "fitness", "born"])

    return run


def pieces_of(items: DataFrame, containers: DataFrame) -> DataFrame:
    """``container_name, place, capacity, doc_id, piece, size``: each item for each container, cut only if longer."""
    usable = containers.filter(F.col("capacity_tokens") > 0).select(F.coalesce("container_name", F.lit("")).alias("container_name"), F.col("capacity_tokens").cast("long").alias("capacity"))
    kinds = usable.distinct().agg(F.array_sort(F.collect_list(F.struct("container_name", "capacity"))).alias("kinds"))  # one row; the table of containers is a stated one
    each = items.join(F.broadcast(kinds)).select("doc_id", "n_tokens", F.posexplode("kinds").alias("place", "c")).select("doc_id", "n_tokens", "place", "c.*")
    last = F.greatest(F.expr("(n_tokens - 1) div capacity"), F.lit(0))
    cut = each.select("container_name", "place", "capacity", "doc_id", "n_tokens", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    return cut.withColumn("size", F.least("capacity", F.col("n_tokens") - F.col("piece") * F.col("capacity"))).drop("n_tokens")


def _cut(items: DataFrame, containers: DataFrame) -> DataFrame:
    size = F.greatest(F.coalesce("n_tokens", F.lit(0)), F.lit(0)).cast("long")
    return pieces_of(items.select("doc_id", size.alias("n_tokens")), containers)


def pack(items: DataFrame, containers: DataFrame, p: Breeding = Breeding()) -> DataFrame:
    """``container_name, bin_id, doc_id, piece, n_tokens``: every item in one bin of each container kind.

    ``items`` has unique ``doc_id`` and ``n_tokens`` (NULL counts as 0, and an item of 0 still gets a bin); it is read
    several times, so pass a stored table. An item over the capacity is cut into full pieces, each a bin of its own, and a
    rest. Container kinds with a NULL or non-positive capacity are skipped; repeated ones count once. No items, no rows.
    """
    cut = _cut(items, containers)
    first, again = _levels(cut.filter("size < capacity"), p)
    bred = first.select("container_name", "bin_id", "doc_id", "piece", F.col("size").alias("n_tokens"), "poor").filter(~F.col("poor")).drop("poor")
    bred = bred.unionByName(again.select("container_name", "bin_id", "doc_id", "piece", F.col("size").alias("n_tokens")))
    alone = cut.filter("size = capacity").select("container_name", F.concat_ws("-", F.lit("f"), F.col("doc_id"), F.col("piece")).alias("bin_id"), "doc_id", "piece", F.col("size").alias("n_tokens"))
    return bred.unionByName(alone)


def _levels(loose: DataFrame, p: Breeding) -> tuple[DataFrame, DataFrame]:
    """The packing of the cells, with the bins marked that are ``poor``, and that of what the poor bins hold."""
    first = materialize(_bred(loose, p, "c"), "packed")
    again = _bred(first.filter("poor").select("container_name", "place", "capacity", "doc_id", "piece", "size"), p, "d")
    return first, again


def _bred(loose: DataFrame, p: Breeding, label: str) -> DataFrame:
    """``container_name, place, capacity, cell, bin_id, doc_id, piece, size, poor, born`` of the best packing of every cell.

    Only sizes and bin numbers go through the search; what the items are stays with the cell and is joined on at the end.
    """
    totals = loose.groupBy("place").agg(F.sum("size").alias("_size"), F.count(F.lit(1)).alias("_n"))
    n_cells = F.greatest(F.lit(1), F.ceil(F.col("_size") / (F.col("capacity") * p.bins_per_cell)), F.ceil(F.col("_n") / p.items_per_cell)).cast("long")
    dealt = loose.join(totals, "place").withColumn("cell", F.pmod(F.xxhash64("doc_id", "piece"), n_cells))
    held = dealt.groupBy("container_name", "place", "capacity", "cell").agg(F.array_sort(F.collect_list(F.struct("size", "doc_id", "piece"))).alias("items"))
    held = materialize(held, "cells")
    start = held.select(
        "place", "capacity", "cell", F.explode(F.sequence(F.lit(0), F.lit(p.islands - 1))).alias("island"), F.col("items.size").alias("sizes"),
        F.lit(None).cast("array<array<int>>").alias("packings"), F.lit(0).alias("born"),
    )
    fields = T.StructType([f for f in start.schema.fields if f.name != "born"] + [T.StructField("n_bins", T.IntegerType()), T.StructField("fitness", T.DoubleType()), T.StructField("born", T.IntegerType())])
    # A number of tasks is given since cells are few bytes and long to breed: adaptive coalescing would put them all in one.
    tasks = max(int(loose.sparkSession.conf.get("spark.sql.shuffle.partitions")), loose.sparkSession.sparkContext.defaultParallelism)
    people = start.repartition(tasks, "place", "cell", "island").mapInPandas(_breed(0, p), fields)
    for epoch in range(1, p.epochs):
        # An island's elites stay, and go on to the next island of the cell.
        homes = F.explode(F.array_distinct(F.array(F.col("island"), F.pmod(F.col("island") + 1, F.lit(p.islands))))).alias("_home")
        sent = people.select("place", "capacity", "cell", "sizes", "packings", "born", "island", homes).withColumn("_rank", F.when(F.col("island") == F.col("_home"), 0).otherwise(1))
        met = sent.repartition(tasks, "place", "cell", "_home").groupBy("place", "cell", "_home").agg(
            F.first("capacity").alias("capacity"), F.first("sizes").alias("sizes"), F.max(F.when(F.col("_rank") == 0, F.col("born"))).alias("born"),
            F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_rank", "island", "packings"))), lambda x: x["packings"])).alias("packings"),
        )
        people = met.withColumnRenamed("_home", "island").select(*start.columns).mapInPandas(_breed(epoch, p), fields)
    best = people.groupBy("place", "cell").agg(F.max_by(F.col("packings")[0], F.struct(-F.col("n_bins"), "fitness", -F.col("island"))).alias("bins"), F.sum("born").alias("born"))
    zipped = F.explode(F.arrays_zip(F.col("items").alias("i"), F.col("bins").alias("n"))).alias("z")
    packed = held.join(best, ["place", "cell"]).select("container_name", "place", "capacity", "cell", "born", zipped)
    fill = F.sum("z.i.size").over(Window.partitionBy("place", "cell", "z.n"))
    out = packed.withColumn("poor", fill < p.poor * F.col("capacity"))
    return out.select("container_name", "place", "capacity", "cell", F.concat_ws("-", F.lit(label), F.col("cell"), F.col("z.n")).alias("bin_id"), F.col("z.i.doc_id").alias("doc_id"), F.col("z.i.piece").alias("piece"), F.col("z.i.size").alias("size"), "poor", "born")


def fill_report(packed: DataFrame, containers: DataFrame) -> DataFrame:
    """``container_name, capacity_tokens, n_bins, n_pieces, n_tokens, fill`` (share of the opened capacity in use)."""
    bins = packed.groupBy("container_name", "bin_id").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    totals = bins.groupBy("container_name").agg(F.count(F.lit(1)).alias("n_bins"), F.sum("n").alias("n_pieces"), F.sum("t").alias("n_tokens"))
    sizes = containers.select("container_name", F.col("capacity_tokens").cast("long").alias("capacity_tokens")).distinct()
    return totals.join(sizes, "container_name").withColumn("fill", F.round(F.col("n_tokens") / (F.col("n_bins") * F.col("capacity_tokens")), 6))


def breeding_report(items: DataFrame, containers: DataFrame, p: Breeding = Breeding()) -> DataFrame:
    """``container_name, n_cells, bred_cells, children, bound_bins, bins, best_fit_bins``, pieces that fill a bin left out.

    ``bound_bins`` is what the tokens need at least; ``best_fit_bins`` what the same cells and the same second round take
    with no generation bred.
    """
    loose = _cut(items, containers).filter("size < capacity")

    def bins(level: tuple[DataFrame, DataFrame]) -> DataFrame:
        both = level[0].filter(~F.col("poor")).select("container_name", "bin_id").unionByName(level[1].select("container_name", "bin_id"))
        return both.distinct().groupBy("container_name").agg(F.count(F.lit(1)).alias("bins"))

    bred = _levels(loose, p)
    cells = bred[0].select("container_name", "cell", "born").distinct().groupBy("container_name").agg(F.count(F.lit(1)).alias("n_cells"), F.count_if(F.col("born") > 0).alias("bred_cells"), F.sum("born").alias("children"))
    bound = loose.groupBy("container_name", "capacity").agg(F.sum("size").alias("_s")).select("container_name", F.ceil(F.col("_s") / F.col("capacity")).alias("bound_bins"))
    plain = bins(_levels(loose, replace(p, generations=0))).withColumnRenamed("bins", "best_fit_bins")
    return cells.join(bound, "container_name").join(bins(bred), "container_name").join(plain, "container_name")
