"""Sources and sinks: the paged archive, raw lines, derived tables, review files, prices, scoring, reports."""

from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from small import rows

from larkspur.functions import times
from larkspur.operators import collection
from larkspur.sources import archive, collect, derived, prices, raw, reports, schemas, scoring, taxonomy


class StubArchive:
    """Rows by (second, count); pages of ``size`` rows, whole from the first second after the cursor."""

    def __init__(self, seconds, size=100, script=()):
        self.data = [{"id": f"{s}-{i}", "created_utc": s} for s, n in seconds for i in range(n)]
        self.size, self.script, self.asked = size, list(script), 0

    def __call__(self, query):
        self.asked += 1
        if self.script:
            return self.script.pop(0)
        hit = [r for r in self.data if query["after"] < r["created_utc"] < query["before"]]
        return archive.Reply(200, {"data": hit[: self.size]})


def _read(stub, full=100):
    pages = list(archive.read_window(stub, "s", "posts", 0, 10_000, full, lambda _: None))
    return [r["id"] for page, _ in pages for r in page], [d for _, doubts in pages for d in doubts]


@pytest.mark.parametrize("seconds", [[], [(5, 1)], [(s, 1) for s in range(1, 251)], [(7, 100)], [(3, 60), (4, 60), (5, 60)], [(3, 99), (9, 1)]])
def test_paging_misses_no_row(seconds):
    stub = StubArchive(seconds)
    got, doubts = _read(stub)
    assert set(got) == {r["id"] for r in stub.data} and "floor" not in dict(doubts)


def test_a_second_that_fills_a_page_is_unproven():
    got, doubts = _read(StubArchive([(3, 1), (5, 350), (9, 2)]))
    assert doubts == [("unproven", 5)] and "9-1" in got


def test_a_row_after_a_short_page_breaks_the_floor():
    first = archive.Reply(200, {"data": [{"id": "a", "created_utc": 3}]})
    stub = StubArchive([(3, 1), (8, 1)], script=[first])
    assert _read(stub)[1] == [("floor", 3)]


@pytest.mark.parametrize("at, times, full, onward, doubts", [
    ((0, None), [], 3, None, []), ((0, None), [4, 7, 7], 3, (6, None), []), ((0, None), [4, 7], 3, (6, 7), []), ((6, 7), [7, 7], 3, (7, 7), []), ((6, None), [7, 7, 7], 3, (7, None), [("unproven", 7)]),
    ((7, 7), [], 3, None, []), ((6, 7), [7, 9], 3, (8, 9), [("floor", 7)]), ((6, 7), [7, 7, 7], 3, (7, None), [("unproven", 7)]),
])
def test_turns_of_the_reading(at, times, full, onward, doubts):
    got = archive.turn(archive.Position(*at), times, full)
    assert got == (None if onward is None else archive.Position(*onward), doubts)


def test_fetching_retries_and_fails_as_it_should():
    waits = []
    ok = archive.Reply(200, {"data": []})
    stub = StubArchive([], script=[archive.Reply(429, {}, {"x-ratelimit-reset": "7"}), archive.Reply(422, {"error": "Timeout"}), archive.Reply(503), ok])
    assert archive.fetch_page(stub, {}, waits.append) == [] and waits == [7.0, 2.0, 4.0]
    for reply in (archive.Reply(404, {"error": "no"}), archive.Reply(422, {"error": "bad"}), archive.Reply(200, {"rows": []}), archive.Reply(200, None)):
        with pytest.raises(archive.ArchiveError):
            archive.fetch_page(StubArchive([], script=[reply]), {}, waits.append)
    with pytest.raises(archive.ArchiveError):
        archive.fetch_page(StubArchive([], script=[archive.Reply(500)] * 5), {}, waits.append)
    with pytest.raises(archive.ArchiveError):
        list(archive.read_window(StubArchive([], script=[archive.Reply(200, {"data": [{"id": "x"}]})]), "s", "posts", 0, 9))


MONTH = times.settled_month("2024-01", 2_000_000_000)


def january(after=MONTH.after):
    """A transport that travels by value: the test modules are not on the workers' path."""

    def send(query):
        data = [{"id": f"{query['kind']}{i}", "created_utc": after + 1 + i * 7200, "score": 1 + i % 3, "num_comments": 0} for i in range(372)] if query["subreddit"] == "full" else []
        return archive.Reply(200, {"data": [r for r in data if query["after"] < r["created_utc"] < query["before"]][:100]})

    return send


def test_source_batch_and_stream_read_the_same(spark, tmp_path):
    spark.dataSource.register(archive.archive_source(january()))
    options = {"after": str(MONTH.after), "before": str(MONTH.before), "subreddits": "full,none", "slice_seconds": "400000", "overlap_seconds": "7200"}
    batch = spark.read.format("paged_archive").options(**options).load().filter("record_json IS NOT NULL").select("record_json").distinct()
    assert batch.count() == 744
    stream = spark.readStream.format("paged_archive").options(**options).load()
    seen: list = []
    query = stream.writeStream.foreachBatch(lambda df, _: seen.extend(r[0] for r in df.filter("record_json IS NOT NULL").select("record_json").collect())).option("checkpointLocation", str(tmp_path / "c")).start()
    query.processAllAvailable()
    query.stop()
    assert set(seen) == {r[0] for r in batch.collect()}


def test_collect_month_guard_receipt_and_tail(spark, tmp_path):
    spark.dataSource.register(archive.archive_source(january()))
    root, receipts = str(tmp_path / "raw"), str(tmp_path / "receipts")
    made = collect.collect_month(spark, root, receipts, MONTH, "FULL".lower(), "posts", MONTH.before + 9)
    lines = collect.read_origins(spark, root)
    assert lines.select("record_json").distinct().count() == 372 and made["rows"] >= 372 and made["rows_unsettled"] > 0
    collect.collect_month(spark, root, receipts, MONTH, "full", "posts", MONTH.before + 9)
    assert collect.read_origins(spark, root).select("record_json").distinct().count() == 372
    spark.dataSource.register(archive.archive_source(lambda q: archive.Reply(200, {"data": []}), "empty_archive"))
    with pytest.raises(collect.EmptyMonth):
        collect.collect_month(spark, root, receipts, MONTH, "full", "posts", MONTH.before, "empty_archive")
    assert collect.collect_month(spark, root, receipts, MONTH, "none", "posts", MONTH.before)["rows"] == 0
    origin = collect.collect_tail(spark, root, MONTH.before + 3600, 5, ["full"])
    assert origin == "recent-20240201T01" and collect.read_origins(spark, root).filter(F.col("origin") == origin).distinct().count() == 4


def test_raw_lines_keep_order_and_derive_prefers_stamped(spark, tmp_path):
    part = tmp_path / "raw/s/2024-01"
    part.mkdir(parents=True)
    lines = ['{"id":"a","author":"[deleted]","score":1,"title":" [removed] ","_meta":{"x":1}}', "", '{"id":"a","author":"w","score":"3","title":"t","_meta":{"retrieved_2nd_on":null}}', '{"id":"a","author":"late","_meta":{"retrieved_2nd_on":4}}', '{"score":2}', '{"id":"b","author":"","score":5.9,"edited":1700000000,"removed_by_category":"","removal_reason":"spam","body":"x"}']
    with gzip.open(part / "posts-part-0000.jsonl.gz", "wt") as f:
        f.write("\n".join(lines) + "\n")
    read = raw.read_lines(spark, str(tmp_path / "raw"), root=str(tmp_path))
    assert rows(read, "file_key", "line_no") == [("raw/s/2024-01/posts-part-0000.jsonl.gz", k) for k in (0, 2, 3, 4, 5)]  # one task: numbers are the lines'
    got = {r["id"]: r for r in raw.derive(read).collect()}
    assert set(got) == {"a", "b"} and got["a"]["author"] == "w" and got["a"]["score"] is None and got["a"]["retrieved_2nd_on"] is None
    assert (got["b"]["author"], got["b"]["score"], got["b"]["edited"], got["b"]["removal_category"], got["b"]["body"], got["b"]["kind"]) == (None, 5, True, "spam", None, "post")
    broken = read.withColumn("record_json", F.lit("{"))
    with pytest.raises(Exception):
        raw.derive(broken).collect()
    assert raw.derive(broken, strict=False).count() == 0


def test_derived_partitions_are_replaced_singly_and_sorted(spark, tmp_path):
    path = str(tmp_path / "d")
    df = spark.createDataFrame([("post", "s", "2024-01", "b", 5), ("post", "s", "2024-01", "a", None), ("post", "s", "2024-02", "c", 1)], "kind string, subreddit string, month_label string, id string, created_utc long")
    derived.write_partitions(df, path)
    derived.write_partitions(df.filter("id = 'c'").withColumn("created_utc", F.lit(9).cast("long")), path)
    assert [r["id"] for r in derived.read(spark, path).filter("month_label = '2024-01'").collect()] == ["a", "b"]
    assert rows(derived.read(spark, path), "id", "created_utc", "month_label") == [("a", None, "2024-01"), ("b", 5, "2024-01"), ("c", 9, "2024-02")]


LABELS = [("d1", "post", ["A", "B"], 1, False, {"A": 2}, "high", "fine, \"quoted\"\nline", True, None), ("d0", "comment", [], -2, False, {}, "low", "x", False, None)]


def test_review_round_trip(spark, tmp_path):
    labels = spark.createDataFrame(LABELS, schemas.LABEL)
    path = str(tmp_path / "review")
    derived.export_review(labels, path)
    text = next((tmp_path / "review").glob("part-*.csv")).read_text().splitlines()
    assert text[0].startswith("doc_id,tags") and text[1].startswith("d0")
    back = derived.import_review(spark, path)
    assert rows(back, "doc_id", "tags", "overall_sentiment", "tag_sentiment", "rationale") == rows(labels, "doc_id", "tags", "overall_sentiment", "tag_sentiment", "rationale")
    bad = next((tmp_path / "review").glob("part-*.csv"))
    bad.write_text(bad.read_text().replace("false", "maybe"))
    with pytest.raises(Exception):
        derived.import_review(spark, path).collect()
    derived.write_labels(labels, str(tmp_path / "labels"))
    with pytest.raises(Exception):
        derived.write_labels(labels, str(tmp_path / "labels"))


def test_manifest_goes_on_where_it_stopped(spark, tmp_path):
    m = derived.Manifest(spark, str(tmp_path / "m"))
    assert rows(m.table()) == []
    for wave in ([("a", "1"), ("b", "1")], [("a", "2")]):
        m.commit(spark.createDataFrame(wave, "label string, fingerprint string"))
    assert rows(derived.Manifest(spark, str(tmp_path / "m")).table()) == [("a", "2"), ("b", "1")]


def test_steps_are_retried_but_not_for_an_empty_month():
    waits, tries = [], iter([OSError("x"), ValueError("y"), {"rows": 1}])

    def step():
        r = next(tries)
        if isinstance(r, Exception):
            raise r
        return r

    assert collect.retried(step, sleep=waits.append) == {"rows": 1} and waits == [30.0, 60.0]

    def empty():
        waits.append("again")
        raise collect.EmptyMonth("m")

    with pytest.raises(collect.EmptyMonth):
        collect.retried(empty, sleep=waits.append)
    assert waits[2:] == ["again"]


def test_allowed_venues():
    assert collect.allowed(["B", "a", "b"], None) == ["b", "a"] and collect.allowed(["B", "a"], ["A", "c"], ["c"]) == ["a"] and collect.allowed(["x"], ["x"], ["X"]) == []


def test_lexicon_files(tmp_path):
    from larkspur.functions import sentiment

    own = sentiment.Lexicon("v1", {"good": 1.9}, {"moon": 2.0}, ("bad",), 0.1, -0.1, 0.9)
    sentiment.publish_lexicon(own, tmp_path / "l.json")
    assert sentiment.load_lexicon(tmp_path / "l.json") == own
    with pytest.raises(FileExistsError):
        sentiment.publish_lexicon(own, tmp_path / "l.json")
    (tmp_path / "w.txt").write_text("Good\t1.9\t0.9\t[2]\nnone\n\nbad\t-2.5\n")
    assert sentiment.word_list(tmp_path / "w.txt") == {"good": 1.9, "bad": -2.5}


def _payload(stamps, closes):
    return json.dumps({"chart": {"result": [{"meta": {"currency": "USD"}, "timestamp": stamps, "indicators": {"quote": [{"close": closes}]}}]}})


def test_price_payloads(spark, tmp_path):
    frame = lambda p: spark.createDataFrame([("X", p)], "symbol string, payload string")
    got = prices.parse_chart(frame(_payload([1704204000, 1704290400, 1704376800], [1.005, None, 2.0])))
    assert [(str(r["date"]), r["close"]) for r in got.orderBy("date").collect()] == [("2024-01-02", 1.01), ("2024-01-04", 2.0)]
    for bad in ("{}", _payload([], []), _payload([1], [1.0, 2.0])):
        with pytest.raises(Exception):
            prices.parse_chart(frame(bad)).collect()
    replies = {"X": (200, _payload([1704204000, 1704290400], [1.0, 2.0]))}
    assert prices.refresh(lambda s: replies[s], {"X": "x"}, tmp_path, 5, spark) == ["X: 2 rows to 2024-01-03"]
    for reply, said in (((200, _payload([1704204000], [1.0])), "series shrank 2 to 1"), ((200, _payload([1704204000] * 2, [1.0, 99_999.0])), "out of range"), ((500, ""), "HTTP 500")):
        replies["X"] = reply
        assert said in prices.refresh(lambda s: replies[s], {"X": "x"}, tmp_path, 6, spark)[0]
    assert json.loads((tmp_path / "x.json").read_text())["updated_at"] == 5


def scorer():
    def call(fixed, items):
        if len(items) > 1:
            labels = [json.dumps({"doc_id": i["doc_id"], "overall_sentiment": 1, "tags": ["A"], "confidence": "high"}) for i in items if i["doc_id"] != "d3"]
            return 200, "Here: [" + ", ".join(labels) + "] done"
        return (200, json.dumps({"overall_sentiment": -1, "tags": []})) if items[0]["doc_id"] in ("d3", "d0") else (200, "sorry")

    return call


def test_scoring_falls_back_to_single_items_and_resumes(spark, tmp_path):
    items = spark.createDataFrame([(f"d{i}", None, "t" * 9000) for i in range(5)], "doc_id string, context_text string, text string").coalesce(1)
    assert rows(scoring.score(items, scorer(), "f", ["A"]), "doc_id", "overall_sentiment") == [("d0", 1), ("d1", 1), ("d2", 1), ("d3", -1), ("d4", 1)]
    path = str(tmp_path / "scores")
    assert scoring.score_missing(items.filter("doc_id < 'd2'"), path, scorer(), "f", ["A"]) == 2
    assert scoring.score_missing(items, path, scorer(), "f", ["A"]) == 3
    assert len(scoring.item_view({"doc_id": "d", "text": "t" * 9000})["text"]) == 8012
    assert "* A: thing (cue)" in scoring.prompt("r", [taxonomy.Tag("A", "thing", cues="cue")], [{"text": "t", "label": {}}])
    with pytest.raises(RuntimeError):
        scoring.ask(lambda *_: (400, "no"), "f", [])


def test_taxonomy_parsing(tmp_path):
    md = "| Tag | Entity | Search terms | Cues |\n|---|---|---|---|\n| `A` | a thing | one, \"two, too\", U3 ⚠ (odd, very), $/lb | hint |\n| `B` | none | | |\ntext\n| Other | x |\n"
    a, b = taxonomy.parse(md)
    term = taxonomy.Term
    assert a == taxonomy.Tag("A", "a thing", (term("one"), term("two, too"), term("U3", True), term("$/lb")), "hint") and b.terms == ()
    assert list(taxonomy.terms_in('a "b, c" d (e, "f"), , ⚠ g, "open')) == [term("a b, c d"), term("g", True), term('"open')]
    assert taxonomy.parse("| Tag |\n|---|\n| |\n| x |\n") == [taxonomy.Tag("x")] and taxonomy.parse("") == []
    taxonomy.publish([a, b], "v1", tmp_path / "t.json")
    assert taxonomy.load(tmp_path / "t.json") == ("v1", [a, b])
    with pytest.raises(FileExistsError):
        taxonomy.publish([a], "v2", tmp_path / "t.json")


def test_serving_routes(tmp_path):
    assert reports.serve(tmp_path, "/api/series", [], 0)[0] == 503 and reports.serve(tmp_path, "/x", [], 0)[0] == 404
    (tmp_path / "series.json").write_text(json.dumps({"generated_at": 100, "partial_after": "d"}))
    assert json.loads(reports.serve(tmp_path, "/api/status", ["a"], 100 + 3 * 3600)[1])["stale"] is False
    assert json.loads(reports.serve(tmp_path, "/api/status", ["a"], 101 + 3 * 3600)[1])["stale"] is True
    assert json.loads(reports.serve(tmp_path, "/api/prices", ["a"], 0)[1]) == {"a": None}


def test_object_keys(spark):
    keys = ["raw/s/2024-01/posts-part-0003.jsonl.gz", "raw/s/2024-01/comments-recent-20240101T05-part-0000.jsonl.gz", "raw/s/2024-13/posts-part-0000.jsonl.gz", "raw/s/2024-01/posts-part-0000.jsonl", "receipts/s/2024-01-posts.json", "derived/x"]
    df = spark.createDataFrame([(k,) for k in keys], "object_key string")
    assert rows(collection.parsed_keys(df), "kind", "hour_stamp", "part") == [("comments", "20240101T05", 0), ("posts", None, 3)]
    assert rows(collection.receipt_keys(df)) == [("s", "2024-01", "posts")]
    made = df.limit(1).select(collection.backfill_key(F.lit("S"), F.lit("2024-01"), F.lit("posts"), F.lit(3)).alias("a"), collection.recent_key(F.lit("S"), F.lit("2024-01"), F.lit("comments"), F.lit("20240101T05"), F.lit(0)).alias("b"))
    assert list(made.first()) == keys[:2]
