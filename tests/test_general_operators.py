"""The general data-processing operators: results, and the cases of nulls, empty tables, repeats, ties and clashing names."""

from __future__ import annotations

from datetime import date, datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from small import rows

from larkspur.operators import drift, exactly_once, hotkeys, references, rolling
from larkspur.operators.hierarchy import _batches, hierarchy, measure, peel, placed, solve
from larkspur.scratch import fresh_path


# Hot keys


def test_heavy_keys_count_nulls_in_the_total_and_keep_ties(spark):
    df = spark.createDataFrame([("a", "x")] * 2 + [("b", None)] * 2 + [(None, None)] * 96, "link_id string, author string")
    assert rows(hotkeys.heavy_keys(df, ["link_id", "author"], 2)) == [("author", "x", 2), ("link_id", "a", 2), ("link_id", "b", 2)]


def test_combine_by_key_ignores_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 1, "zz", "q"), ("a", None, "zz", "q"), (None, 5, "zz", "q")], "link_id string, n int, field_name string, key_value string")
    got = hotkeys.combine_by_key(df, ["link_id"], {"s": F.sum("n"), "c": F.count(F.lit(1))}, ["n"])
    assert rows(got) == [("link_id", None, 5, 1), ("link_id", "a", 1, 2)]
    assert hotkeys.heavy_keys(df.limit(0), ["link_id"]).count() == 0


# References


def _refs(spark, data):
    return references.prefixed_references(spark.createDataFrame(data, "id string, link_id string, parent_id string, at timestamp, m string"), "comments", "comment", ["link_id", "parent_id"], "at", "m")


def test_references_are_missing_late_deleted_malformed_or_ok(spark):
    t = lambda d: datetime(2024, 1, d)
    refs = _refs(spark, [("c1", "t3_p1", "t1_c9", t(5), "2024-01"), ("c2", "t3_p2", "odd", t(1), "2024-01"), (None, "t3_zz", None, t(1), "x"), ("c3", "t3_p3", None, t(9), "2024-01")])
    parents = spark.createDataFrame([("post", "p1", t(2), None), ("post", "p2", t(3), None), ("post", "p3", t(1), t(8)), ("comment", "p1", t(1), None)], "space string, target string, valid_from timestamp, valid_to timestamp")
    got = references.resolve(refs, parents)
    assert rows(got, "id", "field_name", "status") == [("c1", "link_id", "ok"), ("c1", "parent_id", "missing"), ("c2", "link_id", "late"), ("c2", "parent_id", "malformed"), ("c3", "link_id", "deleted")]


def test_references_of_empty_tables_and_hot_targets(spark):
    refs = _refs(spark, [(f"c{i}", "t3_hot", None, None, "m") for i in range(300)])
    none = spark.createDataFrame([], "space string, target string, valid_from timestamp, valid_to timestamp")
    assert references.resolve(refs, none).filter("status = 'missing'").count() == 300
    assert references.resolve(refs.limit(0), none).count() == 0
    report = references.dangling_report(references.resolve(refs.union(refs), none))
    assert rows(report) == [("comments", "m", "link_id", "missing", 300)]


# Exactly once


ORDER = lambda: [F.col("stamp").isNotNull(), F.col("stamp"), -F.col("seen")]


def _store(spark):
    return exactly_once.MessageStore(spark, fresh_path(spark, "t"), ["id"], ORDER(), "month")


MESSAGES = "id string, stamp long, seen long, month string, body string"


def test_store_keeps_one_winner_and_rewrites_only_affected_partitions(spark):
    s = _store(spark)
    s.apply(spark.createDataFrame([("a", None, 1, "01", "x"), ("a", 5, 2, "02", "y"), ("b", None, 1, "02", None), (None, 1, 1, "01", "no id"), ("c", None, 1, None, "")], MESSAGES), "1")
    assert rows(s.read(), "id", "body", "n_copies") == [("a", "y", 2), ("b", None, 1), ("c", "", 1)]
    changed = s.apply(spark.createDataFrame([("b", 9, 7, "03", "new"), ("d", None, 8, "03", "d")], MESSAGES), "2")
    assert changed == ["02", "03"]  # b stays in the partition of its first copy
    assert rows(s.read(), "id", "body", "n_copies") == [("a", "y", 2), ("b", "new", 2), ("c", "", 1), ("d", "d", 1)]


def test_store_is_idempotent_and_survives_reopening(spark):
    s = _store(spark)
    batch = spark.createDataFrame([("a", None, 1, "01", "x")] * 3, MESSAGES)
    s.apply(batch, "1")
    assert s.apply(batch, "1") == []
    again = exactly_once.MessageStore(spark, s.path, ["id"], ORDER(), "month")
    assert again.apply(batch.limit(0), "2") == []
    assert rows(again.read(), "id", "n_copies") == [("a", 3)]
    with pytest.raises(ValueError):
        _store(spark).read()


def test_store_result_does_not_depend_on_batches(spark):
    rng = np.random.default_rng(3)
    data = [(f"k{rng.integers(20)}", int(rng.integers(5)) if rng.random() < 0.5 else None, i, f"{rng.integers(4)}", f"b{i}") for i in range(200)]
    one, many = _store(spark), _store(spark)
    one.apply(spark.createDataFrame(data, MESSAGES), "all")
    for i in range(3):
        many.apply(spark.createDataFrame(data[i::3], MESSAGES), str(i))
    assert rows(one.read(), "id", "body", "n_copies") == rows(many.read(), "id", "body", "n_copies")


def test_first_load_moves_whole_rows_once(spark):
    rng = np.random.default_rng(5)
    data = [(f"k{i}", None, i, f"{i % 5}", rng.bytes(400).hex()) for i in range(3000)]
    batch = spark.createDataFrame([*data, *[(k, 1, i, "7", body) for k, _, i, _, body in data[:30]]], MESSAGES)
    s = _store(spark)
    spark.sparkContext.setJobGroup("first load", "")
    s.apply(batch, "1")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker, store = spark.sparkContext.statusTracker(), spark.sparkContext._jsc.sc().statusStore()
    stages = {k for job in tracker.getJobIdsForGroup("first load") for k in tracker.getJobInfo(job).stageIds}
    moved = sum(store.lastStageAttempt(k).shuffleWriteBytes() for k in stages)
    assert sum(len(r[4]) for r in data) < moved < 1.5 * sum(len(r[4]) for r in data)
    assert s.read().count() == 3000 and s.read().filter("n_copies = 2 and month = '7'").count() == 30


@pytest.mark.parametrize("rows_per_file", [1_000_000, 5])
def test_first_load_of_keys_in_several_partitions_hot_keys_and_ties(spark, rows_per_file):
    rng = np.random.default_rng(rows_per_file)
    keys = [f"k{rng.integers(40)}" if i % 3 else "hot" for i in range(300)]  # with 5 rows a file, many are combined ahead
    data = [(k, int(rng.integers(3)) if rng.random() < 0.5 else None, int(rng.integers(3)), [None, "", "a", "b", "c"][rng.integers(5)], f"b{i}", {"k": i}) for i, k in enumerate(keys)]
    data += [(None, 1, 1, "a", "no id", None), ("bare", None, None, None, None, None)]
    batch = spark.createDataFrame(data, MESSAGES + ", m map<string,int>")
    s, t = (exactly_once.MessageStore(spark, fresh_path(spark, "t"), ["id"], ORDER(), "month", rows_per_file=rows_per_file) for _ in range(2))
    for store, own in ((s, batch), (t, batch.drop("m"))):
        written = store.apply(own, "1")
        want = exactly_once.fold(own, ["id"], ORDER(), F.lit(1))
        got = store.read()
        assert rows(got, *want.columns) == rows(want)
        home = F.coalesce(F.nullif("month", F.lit("")), F.lit(exactly_once.NO_PARTITION))
        homes = {r[0]: r[1] for r in want.select("id", home).collect()}
        assert written == sorted(set(homes.values()))
        for part in written:  # each key lies in its winner's partition, in the data and in the index
            assert {r["id"] for r in store._read_parts([part]).collect()} == {k for k, p in homes.items() if p == part}
        assert {r["id"]: r["_old"] for r in store._index(list(range(64)), "id string, _part string").collect()} == homes


def test_rows_are_dealt_evenly_to_tasks(spark, monkeypatch):
    monkeypatch.setattr(exactly_once, "TASK_ROWS", (1, 100))
    s = _store(spark)
    parts = ["a"] * 450 + ["b"] * 60 + ["c"] * 30 + ["d"] * 100 + ["e"]
    dealt = s._spread(spark.createDataFrame([(f"k{i}", p) for i, p in enumerate(parts)], "id string, _part string"), {p: parts.count(p) for p in "abcde"})
    got = dealt.groupBy(F.spark_partition_id().alias("t"), "_task", "_part").count().collect()
    assert all(r["t"] == r["_task"] for r in got) and sum(r["count"] for r in got) == len(parts)
    assert [sorted({r["_task"] for r in got if r["_part"] == p}) for p in "abcde"] == [[0, 1, 2, 3, 4], [5], [5], [6], [7]]
    assert max(sum(r["count"] for r in got if r["t"] == t) for t in range(8)) < 130


def test_an_empty_first_batch_leaves_the_store_empty(spark):
    s = _store(spark)
    assert s.apply(spark.createDataFrame([(None, 1, 1, "01", "no id")], MESSAGES), "1") == []
    s.apply(spark.createDataFrame([("a", None, 1, "01", "x")], MESSAGES), "2")
    assert rows(s.read(), "id", "n_copies") == [("a", 1)]


def test_fold_breaks_full_ties_by_the_other_columns_whatever_the_order(spark):
    data = [("a", 1, b) for b in "pqrs"]
    fold = lambda part: rows(exactly_once.fold(spark.createDataFrame(part, "id string, o int, body string").coalesce(1), ["id"], [F.col("o")], F.lit(1)), "body", "n_copies")
    assert fold(data) == fold(data[::-1]) == fold(data[2:] + data[:2]) and fold(data)[0][1] == 4


def test_fold_carries_columns_without_an_order_and_named_order_columns(spark):
    df = spark.createDataFrame([("a", 1, {"k": 1}), ("a", 2, {"k": 2}), ("a", None, {"k": 3})], "id string, o int, m map<string,int>")
    assert [tuple(r) for r in exactly_once.fold(df, ["id"], ["o"], F.lit(1)).collect()] == [("a", 2, {"k": 2}, 3)]
    assert [tuple(r) for r in exactly_once.fold(df.drop("m"), ["id"], [-F.col("o"), "o"], F.lit(1), total_order=True).collect()] == [("a", 1, 3)]


def test_of_two_writers_of_one_version_the_later_fails(spark):
    s = _store(spark)
    s.apply(spark.createDataFrame([("a", None, 1, "01", "x")], MESSAGES), "1")
    late = exactly_once.MessageStore(spark, s.path, ["id"], ORDER(), "month")
    s.apply(spark.createDataFrame([("b", None, 1, "01", "x")], MESSAGES), "2")
    batch = spark.createDataFrame([("c", None, 1, "01", "x")], MESSAGES)
    with pytest.raises(exactly_once.ConcurrentWrite):
        late.apply(batch, "3")
    again = exactly_once.MessageStore(spark, s.path, ["id"], ORDER(), "month")
    again.apply(batch, "3")
    assert rows(again.read(), "id") == [("a",), ("b",), ("c",)]


def test_only_touched_buckets_of_the_index_are_read_and_crowded_ones_rewritten(spark, monkeypatch):
    monkeypatch.setattr(exactly_once, "MOST_INDEX_PARTS", 2)
    s = exactly_once.MessageStore(spark, fresh_path(spark, "t"), ["id"], ORDER(), "month", buckets=4, rows_per_file=3)
    s.apply(spark.createDataFrame([(f"k{i}", None, 1, f"{i % 2}", "x") for i in range(20)], MESSAGES), "0")
    before = {b: list(v) for b, v in s._manifest["index"].items()}
    bucket = spark.createDataFrame([("k3", None, 2, "9", "y")], MESSAGES).select(s._bucket()).collect()[0][0]
    read = []
    index = s._index
    s._index = lambda buckets, schema: (read.append(buckets), index(buckets, schema))[1]
    for i in range(3):
        assert s.apply(spark.createDataFrame([("k3", i, 2, "9", "y"), (f"n{i}", None, 1, "8", "z")], MESSAGES), f"x{i}") == ["1", "8"]
    assert all(bucket in b and len(b) <= 2 for b in read[::2]) and set(before) == {"0", "1", "2", "3"}
    assert all(len(v) <= 3 for v in s._manifest["index"].values())
    got = {r["id"]: (r["n_copies"], r["body"]) for r in s.read().collect()}
    assert len(got) == 23 and got["k3"] == (4, "y") and got["k4"] == (1, "x")
    again = exactly_once.MessageStore(spark, s.path, ["id"], ORDER(), "month")
    assert again.buckets == 4 and again.read().count() == 23


# Hierarchies


def brute(edges):
    parent = {k: v if v in edges else None for k, v in edges.items()}
    out = {}
    for node in parent:
        chain, at = [node], parent[node]
        while at is not None and at not in chain:
            chain.append(at)
            at = parent[at]
        cycle = min(chain[chain.index(at) :]) if at is not None else None
        root = chain[-1]
        if cycle is not None:
            loop = set(chain[chain.index(at) :])
            root = next(x for x in chain if x in loop)
            chain = chain[: chain.index(root) + 1]
        out[node] = (root, len(chain) - 1, "/".join(reversed(chain)), cycle)
    below = {n: sum(1 for m, o in out.items() if m != n and n in o[2].split("/")) for n in out}
    return {n: (*o, below[n]) for n, o in out.items()}


forests = st.integers(1, 25).flatmap(lambda n: st.lists(st.one_of(st.none(), st.integers(0, n + 2)), min_size=n, max_size=n))


@settings(max_examples=150, deadline=None)
@given(forests)
def test_solver_against_brute_force(parents):
    ids = np.array([f"n{i:02d}" for i in range(len(parents))], object)
    above = np.array([None if p is None else f"n{p:02d}" for p in parents], object)
    got = solve(ids, above)
    want = brute(dict(zip(ids, above)))
    paths = {i: p for b in _batches(got, True) for i, p in zip(b.column("id").to_pylist(), b.column("path").to_pylist())}
    for i, node in enumerate(ids):
        assert (got["root"][i], got["depth"][i], paths[node], got["cycle_id"][i], got["n_descendants"][i]) == want[node]
        inside = [m for j, m in enumerate(ids) if got["root"][j] == got["root"][i] and got["entry"][i] < got["entry"][j] < got["exit"][i]]
        assert len(inside) == want[node][4]


@settings(max_examples=150, deadline=None)
@given(forests)
def test_peeled_core_has_the_places_of_the_whole(parents):
    """Leaves are taken off once; the core's measures and places must be those that the whole tree gives."""
    ids = np.array([f"n{i:02d}" for i in range(len(parents))], object)
    above = np.array([None if p is None or p >= len(parents) else f"n{p:02d}" for p in parents], object)
    want = solve(ids, above)
    known = set(ids)
    leaf = np.array([i not in set(above) and a in known for i, a in zip(ids, above)])
    core = ~leaf
    weight = np.array([1 + sum(a == i for a in above[leaf]) for i in ids[core]], np.int64)
    got = measure(ids[core], above[core], weight)
    assert list(got["size"] - 1) == list(want["n_descendants"][core]) and list(got["cycle_id"]) == list(want["cycle_id"][core])
    at = {i: k for k, i in enumerate(ids)}
    offset = np.array([0 if a is None else want["entry"][at[i]] - want["entry"][at[a]] for i, a in zip(got["id"], got["above"])], np.int64)
    spots = placed(got["id"], got["above"], offset, got["size"])
    for c in ("root", "depth", "entry"):
        assert list(spots[c]) == list(want[c][core])


def test_peeling_leaves_only_loops():
    assert list(peel(np.array([-1, 0, 3, 2, 2, 5]))) == [False, False, True, True, False, True]


def _comments(spark, data):
    return spark.createDataFrame(data, "id string, parent_id string, link_id string, depth string, root string")


CASES = [
    ("a", "t3_p", "t3_p", "x", "y"), ("b", "t1_a", "t3_p", "x", "y"), ("b", "t1_a", "t3_p", "again", None), ("c", "t1_b", "t3_q", None, None), ("d", "t1_gone", "t3_p", None, None),
    ("e", "t1_e", "t3_r", None, None), ("f", "t1_e", None, None, None), ("g", "t1_h", "t3_r", None, None), ("h", "t1_g", "t3_s", None, None), (None, "t1_a", "t3_p", None, None), ("i", None, None, None, None), ("", "t1_", "t3_z", None, None),
]


@pytest.mark.parametrize("most", [250_000, 1])
def test_hierarchy_in_chunks_and_by_joins(spark, most):
    got = {r["id"]: r for r in hierarchy(_comments(spark, CASES), max_group_rows=most).collect()}
    want = brute({i: p[3:] if p and p.startswith("t1_") else None for i, p, *_ in CASES if i is not None})
    assert {i: (r["root"], r["depth"], r["path"], r["cycle_id"], r["n_descendants"]) for i, r in got.items()} == want
    assert all(r["exit"] - r["entry"] == 2 * r["n_descendants"] + 1 for r in got.values())


@pytest.mark.parametrize("most", [250_000, 50])
def test_deep_chain_and_wide_parent(spark, most):
    chain = [(f"k{i:04d}", f"t1_k{i - 1:04d}" if i else "t3_p", "t3_p", None, None) for i in range(300)]
    wide = [(f"w{i:04d}", "t1_k0000", "t3_p", None, None) for i in range(300)]
    got = {r["id"]: r for r in hierarchy(_comments(spark, chain + wide), max_group_rows=most).collect()}
    assert got["k0299"]["depth"] == 299 and got["k0000"]["n_descendants"] == 599 and got["k0299"]["path"].count("/") == 299
    assert len({r["entry"] for r in got.values()}) == 600


@pytest.mark.parametrize("most", [40])
def test_bushy_forest_peeled_by_joins_is_that_of_chunks(spark, most):
    """Trees that shrink when peeled, with loops, a parent of many children, and one long chain that does not shrink."""
    rng = np.random.default_rng(11)
    data = [(f"r{i:03d}", f"t1_r{int(rng.integers(0, i)) if i else 0:03d}" if i else "t3_p", "t3_p", None, None) for i in range(150)]
    data += [(f"q{i:03d}", f"t1_q{int(rng.integers(0, max(1, i // 6))):03d}", "t3_q", None, None) for i in range(150)]  # q000 is its own parent
    data += [(f"s{i:03d}", f"t1_s{i - 1:03d}" if i else "t1_s149", "t3_s", None, None) for i in range(150)]  # one loop throughout
    df = _comments(spark, data)
    columns = ["id", "parent", "root", "depth", "n_descendants", "entry", "exit", "path", "cycle_id"]
    whole = rows(hierarchy(df), *columns)
    assert len(whole) == 450 and rows(hierarchy(df, max_group_rows=most), *columns) == whole
    assert rows(hierarchy(df, with_path=False, only_loops=True, max_group_rows=most), "id", "cycle_id") == sorted((r[0], r[8]) for r in whole if r[8])


def test_only_loops_and_empty_table(spark):
    df = _comments(spark, CASES)
    assert rows(hierarchy(df, with_path=False, only_loops=True), "id", "cycle_id") == [("", ""), ("e", "e"), ("f", "e"), ("g", "g"), ("h", "g")]
    assert hierarchy(df.limit(0)).count() == 0


# Schema drift


def _raw(spark, files):
    return spark.createDataFrame([(f"raw/s/{k}-part-0000.jsonl.gz", i, line) for k, lines in files.items() for i, line in enumerate(lines)], "file_key string, line_no long, record_json string")


def test_field_changes_between_files_of_a_chain(spark):
    raw = _raw(spark, {
        "2024-01/posts": ['{"id":"a","score":1,"retrieved_utc":5}', '{"id":"b","score":null}'],
        "2024-02/posts": ['{"id":"c","score":"1","retrieved_on":5,"x":null}', '{"score":2.5}'],
        "2024-03/posts": ['{"id":"d","score":2,"retrieved_on":5,"x":[]}', "not json", "[1]"],
        "2024-01/comments": ['{"id":"z"}'],
    })
    got = rows(drift.migration_steps(raw).withColumn("file", F.substring("file_key", 7, 7)), "file", "field_name", "step", "before", "after")
    assert got == [
        ("2024-02", "retrieved_on", "renamed", "absent", "number"), ("2024-02", "retrieved_utc", "renamed", "number", "absent"), ("2024-02", "score", "retyped", "number", "number+string"),
        ("2024-02", "x", "added", "absent", ""), ("2024-03", "score", "retyped", "number+string", "number"), ("2024-03", "x", "retyped", "", "array"),
    ]
    assert drift.field_changes(raw.limit(0)).count() == 0


def test_consistent_table_renames_casts_and_fills(spark):
    raw = _raw(spark, {"2024-01/posts": [
        '{"id":"a","score":"21","retrieved_utc":"7","edited":1700000000,"upvote_ratio":1,"removal_reason":"spam","_meta":{"retrieved_2nd_on":9}}',
        '{"id":5,"score":3.9,"retrieved_on":8,"title":["x"],"edited":false,"over_18":true,"_meta":"none"}', "broken", None]})
    got = [tuple(r) for r in drift.consistent_table(raw).orderBy("line_no").select("id", "score", "retrieved_on", "edited", "upvote_ratio", "removed_by_category", "over_18", "title", "retrieved_2nd_on").collect()]
    assert got == [("a", 21, 7, True, 1.0, "spam", False, None, 9), ("5", 3, 8, False, None, None, True, None, None), (None, None, None, False, None, None, False, None, None), (None, None, None, False, None, None, False, None, None)]


def test_versions_step_up_with_the_fingerprint(spark):
    raw = _raw(spark, {"2024-01/posts": ['{"a":1}'], "2024-02/posts": ['{"a":2}'], "2024-03/posts": ['{"a":"x"}'], "2024-04/posts": ['{"a":3}']})
    assert [r["version"] for r in drift.schema_versions(raw).orderBy("file_key").collect()] == [1, 1, 2, 3]


# Rolling totals


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 9)), min_size=1, max_size=40), st.integers(1, 40))
def test_trailing_totals_against_brute_force(spark, pairs, window):
    values = dict(pairs)
    df = spark.createDataFrame([("e", date.fromordinal(738000 + k), v) for k, v in values.items()], "e string, day date, n long")
    got = rolling.trailing_totals(rolling.densify(df, ["e"], "day", ["n"]), ["e"], "day", ["n"], [window]).collect()
    assert len(got) == max(values) - min(values) + 1
    for r in got:
        k = r["day"].toordinal() - 738000
        assert r[f"n_{window}d"] == sum(v for j, v in values.items() if k - window < j <= k)


def test_editions_nulls_and_empty_series(spark):
    t = lambda h: datetime(2024, 1, 9, h)
    df = spark.createDataFrame([("s", date(2024, 1, 1), t(1), 5), ("s", date(2024, 1, 1), t(2), None), ("s", date(2024, 1, 3), t(1), 4), ("s", date(2024, 1, 3), t(1), 6), (None, date(2024, 1, 1), t(1), 1), ("s", None, t(1), 1)], "s string, day date, gen timestamp, n long")
    dense = rolling.densify(rolling.latest_edition(df, ["s"], "day", "gen", ["n"]), ["s"], "day", ["n"])
    assert [r["n"] for r in dense.orderBy("day").collect()] == [0, 0, 6]
    assert rolling.densify(df.limit(0), ["s"], "day", ["n"]).count() == 0
