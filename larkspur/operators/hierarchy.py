"""Parent-child links to full hierarchies.

Rows are grouped by thread (threads joined by a stray link are merged), whole groups are streamed through bounded
chunks, and each chunk is solved with array operations: leaves are peeled until only loops are left, loops are cut,
an Euler tour (an enter and an exit event per node) is linked over the forest, and pointer doubling ranks that list.
Ranks give entry and exit intervals; those give depth, root, number of descendants and, where asked for, paths.

A group too large for a chunk (``max_group_rows``) is peeled by joins first, layer by layer, each node handing the number
of its descendants on to its parent. What is left when the leaves are gone, usually a small part, is solved in a chunk,
its tour weighted by what was peeled off; then the layers are put back from the top down. A group that hardly shrinks
(long chains) has its whole tour linked and ranked by joins, the list contracted to a bounded length and spread out again.
All ways give the same rows, and no task holds more than its share.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larkspur.scratch import discard, materialize

FIELDS = "id string, parent string, root string, depth int, n_descendants long, entry long, exit long, path string, cycle_id string"
PATH_CHARS = 1 << 23  # characters of paths in one Arrow batch
LEAST_PEELED = 0.1  # a round of peeling that takes off less of what is left is the last one


def peel(parent: np.ndarray) -> np.ndarray:
    """Mask of the nodes on loops: what is left once nodes without children are removed, layer by layer.

    ``parent`` holds positions, -1 for none. Work is linear in the nodes, whatever the number of layers.
    """
    has = parent >= 0
    waiting = np.bincount(parent[has], minlength=len(parent))
    alive = np.ones(len(parent), bool)
    layer = np.flatnonzero(waiting == 0)
    while len(layer):
        alive[layer] = False
        up, lost = np.unique(parent[layer][parent[layer] >= 0], return_counts=True)
        waiting[up] -= lost
        layer = up[waiting[up] == 0]
    return alive


def loop_minimum(parent: np.ndarray, on_loop: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each loop node the position of the node of least ``rank`` on its loop, by pointer doubling; -1 elsewhere."""
    out = np.full(len(parent), -1)
    nodes = np.flatnonzero(on_loop)
    if len(nodes):
        place = np.full(len(parent), -1)
        place[nodes] = np.arange(len(nodes))
        jump, best = place[parent[nodes]], rank[nodes]
        for _ in range(int(len(nodes)).bit_length()):
            best, jump = np.minimum(best, best[jump]), jump[jump]
        by_rank = nodes[np.argsort(rank[nodes])]
        out[nodes] = by_rank[np.searchsorted(rank[by_rank], best)]
    return out


def tour_links(parent: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The event that follows each one in the Euler tour of its tree, -1 at the end; ``parent`` must have no loops.

    Events 2v (enter) and 2v+1 (exit) form one linked list per tree: enter goes to the first child or the own exit, exit
    to the next sibling (by ``place``) or the parent's exit.
    """
    n = len(parent)
    step = np.empty(2 * n, np.int64)
    step[0::2] = np.arange(1, 2 * n, 2)
    child = np.flatnonzero(parent >= 0)
    child = child[np.lexsort((place[child], parent[child]))]
    up = parent[child]
    first = np.ones(len(child), bool)
    first[1:] = up[1:] != up[:-1]
    step[2 * up[first]] = 2 * child[first]
    step[1::2] = -1
    last = np.ones(len(child), bool)
    last[:-1] = first[1:]
    step[2 * child[last] + 1] = 2 * up[last] + 1
    inner = np.flatnonzero(~last)
    step[2 * child[inner] + 1] = 2 * child[inner + 1]
    return step


def rank(step: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the weights of the links from each enter and each exit event to the end of its list, by pointer doubling."""
    step, follow = step.copy(), np.where(step >= 0, weight, 0)
    active = np.flatnonzero(step >= 0)
    while len(active):
        target = step[active]
        gain, onward = follow[target].copy(), step[target].copy()
        follow[active] += gain
        step[active] = onward
        active = active[onward >= 0]
    return follow[0::2], follow[1::2]


def roots(above: np.ndarray) -> np.ndarray:
    root = np.where(above < 0, np.arange(len(above)), above)
    while True:
        further = root[root]
        if (further == root).all():
            return root
        root = further


def depths(root: np.ndarray, enter: np.ndarray, leave: np.ndarray) -> np.ndarray:
    """The number of intervals of a tree that are open at an entry: a running sum of +1 and -1 along each tour."""
    n = len(root)
    side = np.repeat([1, -1], n)
    order = np.lexsort((np.concatenate([enter, leave]), np.concatenate([root, root])))
    open_ = np.empty(2 * n, np.int64)
    open_[order] = np.cumsum(side[order])
    return open_[:n] - 1


def _positions(ids: np.ndarray, parents: np.ndarray) -> np.ndarray:
    return np.where(pd.isna(parents), -1, pd.Index(ids).get_indexer(pd.Index(parents))).astype(np.int64)


def _cut(ids: np.ndarray, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Parents with the links of loops cut, the order of the ids, the root of each node and the least id of its loop."""
    on_loop = peel(parent)
    order = np.empty(len(ids), np.int64)
    order[np.argsort(ids, kind="stable")] = np.arange(len(ids))
    least = loop_minimum(parent, on_loop, order)
    above = np.where(on_loop, -1, parent)
    root = roots(above)
    cycle = np.full(len(ids), None, object)
    looped = np.flatnonzero(least[root] >= 0)
    cycle[looped] = ids[least[root[looped]]]
    return above, order, root, cycle


def _named(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.full(len(ids), None, object)
    out[at >= 0] = ids[at[at >= 0]]
    return out


def solve(ids: np.ndarray, parents: np.ndarray) -> dict[str, np.ndarray]:
    """All hierarchy columns but the path of one chunk of whole trees; ``parents`` holds ids, None where there is no parent row."""
    parent = _positions(ids, parents)
    above, order, root, cycle = _cut(ids, parent)
    after_enter, after_exit = rank(tour_links(above, order), np.ones(2 * len(ids), np.int64))
    enter, leave = after_enter[root] - after_enter, after_enter[root] - after_exit
    return {"id": ids, "parent": _named(ids, parent), "root": ids[root], "depth": depths(root, enter, leave), "n_descendants": (leave - enter - 1) // 2, "entry": enter, "exit": leave, "cycle_id": cycle}


def measure(ids: np.ndarray, parents: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """``above`` (the parent, loops cut), ``size`` (nodes at and below, each counting ``weight``) and ``cycle_id`` of a peeled core."""
    parent = _positions(ids, parents)
    above, order, _, cycle = _cut(ids, parent)
    links = np.zeros(2 * len(ids), np.int64)
    links[0::2] = weight
    after_enter, after_exit = rank(tour_links(above, order), links)
    size = np.where(above >= 0, after_enter - after_exit, after_enter)
    return {"id": ids, "parent": _named(ids, parent), "above": _named(ids, above), "size": size, "cycle_id": cycle}


def placed(ids: np.ndarray, aboves: np.ndarray, offset: np.ndarray, size: np.ndarray) -> dict[str, np.ndarray]:
    """``root, depth, entry`` of a peeled core in the tours of the whole trees.

    ``offset`` is how many events lie between a parent's entry and the node's, peeled siblings included; a link of the
    core's tour weighs as many events as it skips.
    """
    above = _positions(ids, aboves)
    root = roots(above)
    place = np.empty(len(ids), np.int64)
    place[np.argsort(offset, kind="stable")] = np.arange(len(ids))
    step = tour_links(above, place)
    own, shift = 2 * size - 1, np.where(above >= 0, offset, 0)
    weight = np.zeros(2 * len(ids), np.int64)
    into = step[0::2]  # from an entry to the first child's or to the own exit
    weight[0::2] = np.where(into % 2 == 0, shift[into // 2], own)
    onward = step[1::2]  # from an exit to the next sibling's entry or to the parent's exit
    done = shift + own
    weight[1::2] = np.where(onward % 2 == 0, shift[onward // 2], own[onward // 2]) - done
    after_enter, _ = rank(step, weight)
    enter = after_enter[root] - after_enter
    return {"id": ids, "root": ids[root], "depth": depths(root, enter, enter + own), "entry": enter}


def _batches(columns: dict[str, np.ndarray], with_path: bool) -> Iterator[pa.RecordBatch]:
    """The solved columns as Arrow batches; paths are written out along the tours, a bounded number of characters at a time."""
    kinds = {"depth": pa.int32(), "n_descendants": pa.int64(), "entry": pa.int64(), "exit": pa.int64(), "size": pa.int64()}
    n = len(columns["id"])
    cuts, paths = [0], None
    if with_path:
        order = np.lexsort((columns["entry"], columns["root"].astype(str)))
        columns = {k: v[order] for k, v in columns.items()}
        trail, paths, chars = [], [], 0
    for at in range(n):
        if with_path:
            del trail[int(columns["depth"][at]) :]
            trail.append(columns["id"][at])
            paths.append("/".join(trail))
            chars += len(paths[-1])
        if at + 1 == n or at + 1 - cuts[-1] >= 50_000 or (with_path and chars >= PATH_CHARS):
            part = {k: pa.array(v[cuts[-1] : at + 1], type=kinds.get(k, pa.string())) for k, v in columns.items()}
            if with_path or "depth" in columns:
                part["path"] = pa.array(paths if with_path else [None] * (at + 1 - cuts[-1]), type=pa.string())
            yield pa.RecordBatch.from_pydict(part)
            cuts, paths, chars = [at + 1], [], 0


def _chunks(chunk_rows: int, names: tuple[str, ...], work: Callable[[pa.Table], Iterator[pa.RecordBatch]]):
    """Stream a partition sorted by group: whole groups are gathered up to ``chunk_rows`` rows and solved together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0
        for batch in batches:
            table = pa.table({c: batch.column(c) for c in names})
            if not table.num_rows:
                continue
            groups = table["grp"].to_numpy(zero_copy_only=False)
            if rows + table.num_rows >= chunk_rows:
                # Cut where the last group of this batch begins; with one group throughout, at the batch's start at most.
                cut = int(np.flatnonzero(groups == groups[-1])[0])
                if cut == 0 and held and held[-1]["grp"][held[-1].num_rows - 1].as_py() == groups[-1]:
                    held.append(table)
                    rows += table.num_rows
                    continue
                if rows + cut:
                    yield from work(pa.concat_tables([*held, table.slice(0, cut)]))
                held, rows = [table.slice(cut)], table.num_rows - cut
            else:
                held.append(table)
                rows += table.num_rows
        if held:
            yield from work(pa.concat_tables(held))

    return run


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy(zero_copy_only=False)


def _whole(with_path: bool, only_loops: bool):
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        columns = solve(_column(table, "id"), _column(table, "parent"))
        if only_loops:
            kept = np.flatnonzero(columns["cycle_id"] != None)  # noqa: E711
            columns = {k: v[kept] for k, v in columns.items()}
        yield from _batches(columns, with_path)

    return work


def _measured(table: pa.Table) -> Iterator[pa.RecordBatch]:
    yield from _batches(measure(_column(table, "id"), _column(table, "parent"), _column(table, "w")) | {"grp": _column(table, "grp")}, False)


def _placed(with_path: bool):
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from _batches(placed(_column(table, "id"), _column(table, "above"), _column(table, "offset"), _column(table, "size")), with_path)

    return work


def _by_group(rows: DataFrame, chunk_rows: int, names: tuple[str, ...], work, fields: str) -> DataFrame:
    return rows.repartition("grp").sortWithinPartitions("grp").mapInArrow(_chunks(chunk_rows, names, work), fields)


def _merge_groups(links: DataFrame, name: str) -> DataFrame:
    """``grp, label`` for the groups tied by ``links`` (``a``, ``b``): the least group reached, by rounds of minima."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = materialize(both, f"{name}-links")
    labels = materialize(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("grp"), F.least("a", "m").alias("label")), f"{name}-labels")
    while True:
        near = edges.join(labels, edges["b"] == labels["grp"]).groupBy("a").agg(F.min("label").alias("m"))
        step = labels.join(near, labels["grp"] == near["a"]).select("grp", "label", F.least("label", "m").alias("m"))
        jump = labels.select(F.col("grp").alias("m"), F.col("label").alias("far"))
        after = materialize(step.join(jump, "m", "left").select("grp", F.coalesce("far", "m").alias("next"), "label"), f"{name}-labels")
        moved = after.filter(F.col("next") != F.col("label")).limit(1).count()
        discard(labels)
        labels = after.select("grp", F.col("next").alias("label"))
        if not moved:
            return labels


def _peeled(nodes: DataFrame, most: int, name: str) -> tuple[DataFrame, list[DataFrame], int]:
    """What is left of ``id, parent, grp`` after leaves are peeled, with ``w`` (itself and what was peeled off below it),
    the layers taken off, and the rows of the largest group left."""
    rest = materialize(nodes.withColumn("w", F.lit(1).cast("long")), f"{name}-rest")
    layers: list[DataFrame] = []
    while True:
        sizes = rest.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("largest"), F.sum("n").alias("n")).collect()[0]
        if (sizes["largest"] or 0) <= most or (layers and sizes["n"] > before * (1 - LEAST_PEELED)):
            return rest, layers, sizes["largest"] or 0
        before = sizes["n"]
        kids = rest.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("id")).agg(F.lit(True).alias("has"))
        marked = materialize(rest.join(kids, "id", "left").withColumn("leaf", F.col("has").isNull() & F.col("parent").isNotNull()).drop("has"), f"{name}-layer")
        layers.append(marked.filter("leaf").drop("leaf"))
        lost = layers[-1].groupBy(F.col("parent").alias("id")).agg(F.sum("w").alias("lost"))
        after = materialize(marked.filter("NOT leaf").drop("leaf").join(lost, "id", "left").withColumn("w", F.col("w") + F.coalesce("lost", F.lit(0))).drop("lost"), f"{name}-rest")
        discard(rest)
        rest = after


def _before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within a partition sorted by (parent, id): the preceding sibling and twice the sizes of all that precede."""
    parent, last, total = None, None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        up, ids, size = (batch.column(c) for c in ("parent", "id", "size"))
        ups, names, sizes = up.to_numpy(zero_copy_only=False), ids.to_numpy(zero_copy_only=False), 2 * size.to_numpy()
        first = np.ones(len(ups), bool)
        first[1:] = ups[1:] != ups[:-1]
        first[0] = ups[0] != parent
        run = np.cumsum(sizes) - sizes
        start = np.maximum.accumulate(np.where(first, np.arange(len(ups)), 0))
        ahead = run - run[start]
        if not first[0]:
            ahead[: int(np.flatnonzero(first)[0]) if first.any() else len(ups)] += total
        previous = np.where(first, None, np.concatenate([[last], names[:-1]]))
        parent, last, total = ups[-1], names[-1], int(ahead[-1] + sizes[-1])
        yield pa.RecordBatch.from_arrays([ids, up, size, batch.column("pid"), pa.array(ahead), pa.array(previous, pa.string())], names=["id", "parent", "size", "pid", "ahead", "previous"])


def _siblings(children: DataFrame, name: str) -> DataFrame:
    """``id, parent, offset, previous`` of ``id, parent, size``, siblings in the order of their ids.

    Children are sorted by ranges of (parent, id), so those of one parent may fill any number of tasks; the parents that do
    are one at most per task, and what their earlier tasks hold is added on by a join with so few rows.
    """
    spread = children.select("id", "parent", "size").repartitionByRange("parent", "id").sortWithinPartitions("parent", "id").withColumn("pid", F.spark_partition_id())
    run = materialize(spread.mapInArrow(_before, "id string, parent string, size long, pid int, ahead long, previous string"), f"{name}-siblings")
    parts = run.groupBy("parent", "pid").agg(F.sum(2 * F.col("size")).alias("held"), F.max("id").alias("last"))
    w = Window.partitionBy("parent").orderBy("pid")
    carried = parts.select("parent", "pid", F.sum("held").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("carry"), F.lag("last").over(w).alias("before")).filter(F.col("carry").isNotNull())
    previous = F.coalesce("previous", F.col("before"))
    return run.join(carried, ["parent", "pid"], "left").select("id", "parent", (F.col("ahead") + F.coalesce("carry", F.lit(0)) + 1).alias("offset"), previous.alias("previous"))


def _by_layers(rest: DataFrame, layers: list[DataFrame], with_path: bool, only_loops: bool, most: int, name: str) -> DataFrame:
    """The hierarchy columns from the peeled core and its layers."""
    core = materialize(_by_group(rest, most, ("grp", "id", "parent", "w"), _measured, "id string, parent string, above string, size long, cycle_id string, grp string"), f"{name}-core")
    if only_loops:  # trees without a loop are left here, before anything is placed
        core, members, kept = core.filter(F.col("cycle_id").isNotNull()), None, []
        members = core.select(F.col("id").alias("parent"))
        for layer in reversed(layers):
            kept.append(materialize(layer.join(members, "parent", "left_semi"), f"{name}-looped"))
            members = members.unionByName(kept[-1].select(F.col("id").alias("parent")))
        layers = kept[::-1]
    children = core.filter(F.col("above").isNotNull()).select("id", F.col("above").alias("parent"), "size")
    for layer in layers:
        children = children.unionByName(layer.select("id", "parent", F.col("w").alias("size")))
    offsets = materialize(_siblings(children, name).select("id", "offset"), f"{name}-offsets")
    ready = core.join(offsets, "id", "left").withColumn("offset", F.coalesce("offset", F.lit(0)))
    spots = _by_group(ready, most, ("grp", "id", "above", "offset", "size"), _placed(with_path), "id string, root string, depth int, entry long, path string")
    columns = ["id", "parent", "root", "depth", "size", "entry", "path", "cycle_id"]
    done = materialize(spots.join(core, "id").select(*columns), f"{name}-done")
    for layer in reversed(layers):
        above = done.select(F.col("id").alias("parent"), "root", "depth", "entry", "path", "cycle_id")
        under = layer.select("id", "parent", F.col("w").alias("size")).join(offsets, "id").join(above, "parent")
        path = F.concat_ws("/", "path", "id") if with_path else F.col("path")
        below = under.select("id", "parent", "root", (F.col("depth") + 1).alias("depth"), "size", (F.col("entry") + F.col("offset")).alias("entry"), path.alias("path"), "cycle_id")
        done = done.unionByName(materialize(below, f"{name}-done"))
    return done.select("id", "parent", "root", "depth", (F.col("size") - 1).alias("n_descendants"), "entry", (F.col("entry") + 2 * F.col("size") - 1).alias("exit"), "path", "cycle_id")


def _cut_loops(nodes: DataFrame, name: str) -> DataFrame:
    """``id, parent, cycle_id`` with loop edges cut; ``cycle_id`` is set on loop nodes only.

    For groups that peeling would not shrink: each round doubles how far every unfinished node looks upward, and nodes
    that reach a root drop out. What has an ancestor left after as many steps as there are nodes never ends, and the
    ancestors so reached are the loops.
    """
    active, past = nodes.filter(F.col("parent").isNotNull()).select("id", F.col("parent").alias("anc"), F.least("id", "parent").alias("low")), []
    for _ in range(max(1, nodes.count().bit_length())):
        far = active.select(F.col("id").alias("anc"), F.col("anc").alias("next"), F.col("low").alias("low2"))
        onward = materialize(active.join(far, "anc").select("id", F.col("next").alias("anc"), F.least("low", "low2").alias("low")), f"{name}-loops")
        if past:
            discard(past[-1])
        past.append(onward)
        active = onward
        if active.isEmpty():
            break
    on_loop = active.select(F.col("anc").alias("id")).distinct()
    looped = active.join(on_loop, "id").select("id", F.col("low").alias("cycle_id"))
    return materialize(nodes.join(looped, "id", "left").select("id", F.when(F.col("cycle_id").isNull(), F.col("parent")).alias("parent"), "cycle_id"), f"{name}-cut")


def _rank_rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranks a contracted list, held whole: sums of ``n`` and ``level`` to the end, and the event at the end."""
    table = pa.Table.from_batches(list(batches))
    if not table.num_rows:
        return
    event, onward = _column(table, "event"), _column(table, "onward")
    step = _positions(event, onward)
    end, follow = np.where(step < 0, np.arange(len(event)), step), {c: _column(table, c).copy() for c in ("n", "level")}
    active = np.flatnonzero(step >= 0)
    while len(active):
        target = step[active]
        for values in follow.values():
            values[active] += values[target].copy()
        end[active] = end[target]
        step[active] = step[target]
        active = active[step[active] >= 0]
    yield from pa.table({"event": event, "n": follow["n"], "level": follow["level"], "last": _column(table, "last")[end]}).to_batches(max_chunksize=50_000)


def _ranked_by_joins(events: DataFrame, most: int, name: str) -> DataFrame:
    """``event, n, level, last`` of a linked list ``event, onward, n, level``: sums of both from each event to the end.

    In each round an event whose coin falls 1 and whose predecessor's falls 0 is taken out, a quarter of them on average;
    what is left after some rounds fits one task. Then the rounds are undone, each looking up where its events led. The
    work is in proportion to the list, not to the list times its rounds. An end that is taken out leaves its name (``last``)
    with the one before it.
    """
    coin = lambda c, r: F.pmod(F.xxhash64(F.lit(r), c), F.lit(2))
    active, taken, columns = materialize(events.withColumn("last", F.col("event")), f"{name}-list"), [], ["event", "onward", "n", "level", "last"]
    while active.filter(F.col("onward").isNotNull()).count() > most:  # ends are ranked as they are, however many lists there are
        r = len(taken)
        tails = active.filter(coin("event", r) == 1)
        heads = active.filter((coin("event", r) == 0) & F.col("onward").isNotNull() & (coin("onward", r) == 1))
        others = active.filter((coin("event", r) == 0) & (F.col("onward").isNull() | (coin("onward", r) == 0)))
        front = heads.select(F.col("event").alias("head"), F.col("onward").alias("event"), F.col("n").alias("n0"), F.col("level").alias("level0"))
        met = materialize(tails.join(front, "event", "left"), f"{name}-met")
        taken.append(met.filter(F.col("head").isNotNull()).select(*columns))
        merged = met.filter(F.col("head").isNotNull()).select(F.col("head").alias("event"), "onward", (F.col("n") + F.col("n0")).alias("n"), (F.col("level") + F.col("level0")).alias("level"), "last")
        after = materialize(others.unionByName(merged).unionByName(met.filter(F.col("head").isNull()).select(*columns)), f"{name}-list")
        discard(active)
        active = after
    linked = active.filter(F.col("onward").isNotNull())
    reached = linked.select(F.col("onward").alias("event"), F.lit(True).alias("reached")).distinct()
    ends = active.filter(F.col("onward").isNull()).join(reached, "event", "left")
    held = linked.unionByName(ends.filter("reached").drop("reached")).coalesce(1)  # at most twice ``most``
    known = held.mapInArrow(_rank_rest, "event string, n long, level long, last string").unionByName(ends.filter("reached IS NULL").select("event", "n", "level", "last"))
    known = materialize(known, f"{name}-ranks")
    for removed in reversed(taken):
        far = known.select(F.col("event").alias("onward"), F.col("n").alias("n2"), F.col("level").alias("level2"), F.col("last").alias("last2"))
        back = removed.join(far, "onward", "left").select("event", (F.col("n") + F.coalesce("n2", F.lit(0))).alias("n"), (F.col("level") + F.coalesce("level2", F.lit(0))).alias("level"), F.coalesce("last2", "last").alias("last"))
        known = known.unionByName(materialize(back, f"{name}-ranks"))
    return known


def _tours_by_joins(base: DataFrame, most: int, name: str) -> DataFrame:
    """``id, root, depth, n_descendants, entry, exit`` by Euler tours whose list is ranked by joins."""
    near = materialize(_siblings(base.filter(F.col("parent").isNotNull()).withColumn("size", F.lit(0).cast("long")), name).select("id", "parent", "previous"), f"{name}-next")
    following = near.filter(F.col("previous").isNotNull()).select(F.col("previous").alias("id"), F.col("id").alias("sibling"))
    firsts = near.filter(F.col("previous").isNull()).select(F.col("parent").alias("id"), F.col("id").alias("child"))
    linked = base.join(following, "id", "left").join(firsts, "id", "left")
    enter, leave = (lambda c: F.concat(F.lit("+"), c)), (lambda c: F.concat(F.lit("-"), c))
    after_leave = F.when(F.col("sibling").isNotNull(), enter(F.col("sibling"))).when(F.col("parent").isNotNull(), leave(F.col("parent")))
    after_enter = F.when(F.col("child").isNotNull(), enter(F.col("child"))).otherwise(leave(F.col("id")))
    event = lambda at, to, level: F.struct(at.alias("event"), to.alias("onward"), F.lit(level).cast("long").alias("level"))
    events = linked.select(F.explode(F.array(event(enter(F.col("id")), after_enter, 1), event(leave(F.col("id")), after_leave, -1))).alias("e")).select("e.*").withColumn("n", F.lit(1).cast("long"))
    ranked = _ranked_by_joins(events, most, name)
    side = lambda s, c: F.max(F.when(F.col("event").startswith(s), F.col(c)))
    ranks = ranked.groupBy(F.expr("substring(event, 2)").alias("id"), F.expr("substring(last, 2)").alias("root")).agg(
        (side("+", "n") - 1).alias("after_enter"), (side("-", "n") - 1).alias("after_exit"), (-side("+", "level")).cast("int").alias("depth")
    )
    ranks = materialize(ranks, f"{name}-ranks")
    lengths = ranks.filter("id = root").select("root", F.col("after_enter").alias("_last"))
    return ranks.join(lengths, "root").select(
        "id", "root", "depth", F.expr("(after_enter - after_exit - 1) div 2").alias("n_descendants"), (F.col("_last") - F.col("after_enter")).alias("entry"), (F.col("_last") - F.col("after_exit")).alias("exit")
    )


def _paths_by_doubling(base: DataFrame, name: str) -> DataFrame:
    """``id, path``: each round joins to the path of a node that of the ancestor where it stops."""
    done = base.filter(F.col("parent").isNull()).select("id", F.col("id").alias("path"))
    active = base.filter(F.col("parent").isNotNull()).select("id", F.col("parent").alias("anc"), F.col("id").alias("path"))
    while True:
        above = done.unionByName(active, allowMissingColumns=True).select(F.col("id").alias("anc"), F.col("anc").alias("next"), F.col("path").alias("front"))
        step = materialize(active.join(above, "anc").select("id", F.col("next").alias("anc"), F.concat_ws("/", "front", "path").alias("path")), f"{name}-paths")
        done = done.unionByName(step.filter(F.col("anc").isNull()).select("id", "path"))
        active = step.filter(F.col("anc").isNotNull())
        if active.isEmpty():
            return done


def _solve_large(nodes: DataFrame, with_path: bool, only_loops: bool, most: int, name: str) -> DataFrame:
    """The hierarchy columns of groups that no task should hold; ``nodes`` has ``id, parent, grp`` with known parents only."""
    rest, layers, largest = _peeled(nodes, most, name)
    if largest <= most:
        return _by_layers(rest, layers, with_path, only_loops, most, name)
    base = _cut_loops(nodes.select("id", "parent"), name)
    out = _tours_by_joins(base, most, name).join(nodes.select("id", "parent"), "id")
    out = out.join(base.filter(F.col("cycle_id").isNotNull()).select(F.col("id").alias("root"), "cycle_id"), "root", "left")
    out = out.join(_paths_by_doubling(base, name), "id") if with_path else out.withColumn("path", F.lit(None).cast("string"))
    out = out.select("id", "parent", "root", "depth", "n_descendants", "entry", "exit", "path", "cycle_id")
    return out.filter(F.col("cycle_id").isNotNull()) if only_loops else out


def hierarchy(
    df: DataFrame, node: str = "id", parent: str = "parent_id", group: str = "link_id", prefix: str = "t1_",
    with_path: bool = True, only_loops: bool = False, max_group_rows: int = 250_000,
) -> DataFrame:
    """``id, parent, root, depth, n_descendants, entry, exit, path, cycle_id`` for every distinct node.

    A parent that starts with ``prefix`` is a node; any other, a NULL one and one that is no row make the node a root of
    depth 0. ``cycle_id`` is the least id on the loop a node hangs on or below, NULL elsewhere; loop nodes count as roots
    of what hangs below them. ``entry < x.entry < exit`` within one root tells x to be a descendant. Repeated rows of a
    node count once (least parent where they differ), rows without id are dropped, ids are compared byte by byte, an
    empty table gives no rows, and other columns are never read. ``only_loops`` keeps just the rows with a ``cycle_id``.

    Siblings are toured in the order of their ids. ``max_group_rows`` bounds what a task holds; larger groups take more
    rounds, with the same result.
    """
    inner = F.when(F.col(parent).startswith(prefix), F.expr(f"substring(`{parent}`, {len(prefix) + 1})"))
    nodes = df.filter(F.col(node).isNotNull()).groupBy(F.col(node).cast("string").alias("id")).agg(F.min(inner).alias("parent"), F.min(F.col(group).cast("string")).alias("grp"))
    nodes = materialize(nodes.select("id", "parent", F.coalesce("grp", F.concat(F.lit("~"), "id")).alias("grp")), "tree-nodes")

    # Pairs are folded before the join, so a parent with any number of children sends one row per group.
    wanted = nodes.filter(F.col("parent").isNotNull()).groupBy("parent", F.col("grp").alias("a")).agg(F.lit(1).alias("one"))
    stray = wanted.join(nodes.select(F.col("id").alias("parent"), F.col("grp").alias("b")), "parent").filter(F.col("a") != F.col("b")).select("a", "b")
    labels = _merge_groups(stray, "tree")
    dealt = nodes.join(labels, "grp", "left").select("id", "parent", F.coalesce("label", "grp").alias("grp"))
    sizes = dealt.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_group_rows)
    large = materialize(sizes.select("grp"), "tree-large-groups")
    any_large = not large.isEmpty()
    normal = dealt.join(large, "grp", "left_anti") if any_large else dealt
    out = _by_group(normal, max_group_rows, ("grp", "id", "parent"), _whole(with_path, only_loops), FIELDS.replace("path string, cycle_id string", "cycle_id string, path string"))
    if any_large:
        hot = dealt.join(large, "grp", "left_semi")
        known = hot.select(F.col("id").alias("parent"), F.lit(True).alias("_known"))
        hot = materialize(hot.join(known, "parent", "left").select("id", F.when(F.col("_known"), F.col("parent")).alias("parent"), "grp"), "tree-large")
        out = out.unionByName(_solve_large(hot, with_path, only_loops, max_group_rows, "tree-large"))
    return out.select("id", "parent", "root", "depth", "n_descendants", "entry", "exit", "path", "cycle_id")
