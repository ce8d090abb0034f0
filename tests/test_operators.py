"""The archive's operators: cleaning, text, polarity, series, gauge, as-of, sampling, evaluation, fitting, collection, streaming."""

from __future__ import annotations

import math
import random
from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from small import rows

from larkspur.functions import clean, sentiment, text, times
from larkspur.operators import asof, collection, evaluate, fit, gauge, sampling, series, threads
from larkspur.sources.derived import Manifest
from larkspur.sources.taxonomy import Tag, Term
from larkspur.streaming import incremental, merge


def values(spark, expr, data, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(d,) for d in data], schema).select(expr.alias("v")).collect()]


def test_cleaning(spark):
    x = F.col("x")
    assert values(spark, clean.clean_text(x), [None, "", "  \n", "[removed]", " [deleted] ", "[deleted by user]", " kept "]) == [None] * 6 + [" kept "]
    assert values(spark, clean.clean_author(x), [None, "", "[deleted]", " [deleted]", "a"]) == [None, None, None, " [deleted]", "a"]
    assert values(spark, clean.removal_category(x, F.lit("r")), [None, "", "m"]) == ["r", "r", "m"]


def test_lenient_typing(spark):
    doc = F.try_parse_json("x")
    data = ['{"v":5}', '{"v":5.9}', '{"v":-5.9}', '{"v":"5"}', '{"v":true}', '{"v":null}', "{}", '{"v":1e300}', None]
    assert values(spark, clean.int_at(doc, "$.v"), data) == [5, 5, -5, None, None, None, None, None, None]
    assert values(spark, clean.bool_at(doc, "$.v"), data) == [None] * 4 + [True] + [None] * 4
    assert values(spark, clean.was_edited(doc, "$.v"), data) == [True, True, False, False, True, False, False, True, False]


def test_settlement_rules(spark):
    doc = F.try_parse_json("x")
    late = '"created_utc":1688169600'
    data = ['{"created_utc":1688169599}', f"{{{late}}}", f'{{{late},"score":2}}', f'{{{late},"score":1,"num_comments":0,"upvote_ratio":1}}', f'{{{late},"upvote_ratio":0.9}}', f'{{{late},"_meta":{{"retrieved_2nd_on":null}}}}', f'{{{late},"_meta":{{"retrieved_2nd_on":7}}}}', f'{{{late},"_meta":"x"}}']
    assert values(spark, clean.has_settled_engagement(doc), data) == [True, False, True, False, True, False, True, False]
    assert values(spark, clean.has_settled_engagement(doc, by_key=True), data) == [True, False, True, False, True, True, True, False]
    state = clean.engagement_state(F.lit(False), F.col("x"), F.lit(720 * 3600 + 10))
    assert values(spark, state, [9, 10, 11], "x long") == ["abandoned", "pending", "pending"]


def test_text_views(spark):
    x = F.col("x")
    assert values(spark, text.word_count(x), ["a b", " a\n b  c ", "a"]) == [2, 3, 1]
    assert values(spark, text.length_bucket(F.col("x")), [24, 25, 150, 151], "x int") == ["short", "medium", "medium", "long"]
    assert values(spark, text.slug(x), ["GPT/4.1 Mini!", "--a--"]) == ["gpt-4.1-mini", "a"]
    assert values(spark, text.truncated(x, 3), ["abc", "abcd", None]) == ["abc", "abc\n[truncated]", None]
    assert values(spark, text.enrich_text(x, F.lit("s")), ["t", "", None]) == ["t\n\ns", "s", "s"]
    assert values(spark, F.to_json(text.json_object_in(x)), ['so {"a": [1]} ok', "{no}", "x"]) == ['{"a":[1]}', None, None]
    assert values(spark, text.band(F.col("x")), [-1.5, -0.5, 0.49, 0.5, 1.5, None], "x double") == ["peak despair", "despondent", "neutral", "excited", "peak exuberance", None]
    assert values(spark, text.polarity_label(F.col("x"), F.lit(0.5), 0.1, -0.1, 0.4), [0.9, None], "x double") == ["neu", None]


def test_tags(spark):
    tags = [Tag("A", "a", (Term("spot price"), Term("u3"))), Tag("B", "b", (Term("EU", True),)), Tag("C", "c")]
    got = values(spark, text.tags_for(F.col("x"), tags), ["the Spot Price", "u3x eu", "EU and $eu", "éEU", None, "SPOT price EU"])
    assert got == [["A"], [], ["B"], [], [], ["A", "B"]]


def test_polarity_rules():
    lex = sentiment.SEED
    score = lambda t: sentiment.polarity(t, lex)[0]
    assert score("the cask is here") == 0 and score("good") > 0 > score("bad scam")
    assert score("very good") > score("good") > score("slightly good") > 0 > score("not good")
    assert score("it is GOOD here") > score("it is good here") and score("good!!!") > score("good!") > score("good")
    assert score("good but terrible") < 0 < score("terrible but good")
    assert abs(score("great " * 500)) <= 1
    overlay = sentiment.Lexicon(overrides={"cask": 2.0}, neutralize=("good",)).merged()
    assert sentiment.polarity("good", overlay)[0] == 0 < sentiment.polarity("Cask", overlay)[0]


def test_polarity_column(spark):
    s = sentiment.polarity_scores(F.col("x"))
    assert values(spark, s["compound"], [None, "  ", "good"]) == [None, None, sentiment.polarity("good", sentiment.SEED)[0]]


def test_month_windows():
    assert [w.label for w in times.settled_months(2024, 1709251200 + 5)] == ["2024-01", "2024-02", "2024-03"]
    assert times.settled_months(2024, 1709251200 + 5)[-1].before == 1709251205
    assert times.settled_month("2024-13", 9**10) is None and times.settled_month("2024-02", 0) is None
    assert times.recent_months(1704067200, 3) == ["2024-01", "2023-12", "2023-11"]
    assert times.hour_stamp(1704067200 + 5 * 3600) == "20240101T05" and times.trailing_window(7200, 2) == times.Window(-1, 7201)


# Series and gauge


def _series(spark, n, seed=1, spike=()):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        mean = None if rng.random() < 0.1 else round(rng.uniform(-0.5, 0.5), 4)
        data.append(("s", date(2023, 1, 1) + timedelta(i), rng.randint(0, 5), rng.randint(0, 60) * (9 if i in spike else 1), mean))
    return spark.createDataFrame(data, "subreddit string, date date, num_posts long, num_comments long, mean_compound double"), data


def brute_means(xs):
    out = []
    for i in range(len(xs)):
        seen = [x for x in xs[max(0, i - 6) : i + 1] if x is not None]
        out.append(sum(seen) / len(seen) if i >= 6 and seen else None)
    return out


def brute_z(xs):
    means, out = brute_means(xs), []
    for i, m in enumerate(means):
        base = [b for b in means[max(0, i - 364) : i + 1] if b is not None]
        if m is None or len(base) < 60:
            out.append(None)
            continue
        mu = sum(base) / len(base)
        sd = math.sqrt(sum((b - mu) ** 2 for b in base) / len(base))
        out.append(0.0 if sd < 1e-12 else (m - mu) / sd)
    return out


@pytest.mark.parametrize("n", [30, 100, 700])
def test_zscores_against_brute_force(spark, n):
    df, data = _series(spark, n)
    got = [r for r in gauge.standing(df, ["subreddit"]).orderBy("date").collect()]
    kept = data[: n - 2]
    for name, xs in (("volume_z", [math.log1p(r[2] + r[3]) for r in kept]), ("sentiment_z", [r[4] for r in kept])):
        for r, z in zip(got, brute_z(xs)):
            assert (r[name] is None) == (z is None) and (z is None or abs(r[name] - z) < 1e-8)


def test_gauge_sees_a_spike_and_flat_series_are_zero(spark):
    df, _ = _series(spark, 400, spike=range(390, 400))
    assert gauge.gauge(df, ["subreddit"]).first()["volume_z"] > 2
    flat = df.withColumns({"num_posts": F.lit(1), "num_comments": F.lit(2), "mean_compound": F.lit(0.1)})
    g = gauge.gauge(flat, ["subreddit"]).first()
    assert (g["value"], g["band"], g["vol_7d"], g["vol_pctile_alltime"], g["sent_7d"]) == (0.0, "neutral", 3.0, 1.0, 0.1)
    assert gauge.gauge(_series(spark, 50)[0], ["subreddit"]).count() == 0


def test_volume_changes_and_analog(spark):
    df, data = _series(spark, 405)
    items = [r[2] + r[3] for r in data[:403]]
    got = {r["period"]: r for r in gauge.volume_changes(df, ["subreddit"]).collect()}
    assert set(got) == {"week", "month", "quarter"}
    assert got["week"]["current"] == pytest.approx(sum(items[-7:]) / 7, abs=0.051) and got["week"]["delta"] == pytest.approx(sum(items[-7:]) / sum(items[-14:-7]) - 1, abs=6e-4)
    a = gauge.analog(df, ["subreddit"]).first()
    assert a["end"] <= data[402][1] - timedelta(60) and (a["end"] - a["start"]).days == 29 and 0 < a["similarity"] <= 1
    assert gauge.analog(_series(spark, 100)[0], ["subreddit"]).count() == 0


def test_tag_summary_of_sparse_days(spark):
    days = [(date(2024, 1, 1) + timedelta(i), "T", 2 + i % 3, 0.5 if i % 2 else None) for i in range(0, 120, 2)]
    daily = spark.createDataFrame([("s", *d) for d in days] + [("s", date(2024, 4, 29), "U", 1, None)], "subreddit string, date date, tag string, num_items long, mean_compound double")
    got = {r["tag"]: r for r in gauge.tag_summary(daily, ["subreddit"]).collect()}
    asof_day = date(2024, 4, 27)
    dense = [math.log1p(dict((d, n) for d, _, n, _ in days).get(date(2024, 1, 1) + timedelta(i), 0)) for i in range((asof_day - date(2024, 1, 1)).days + 1)]
    assert got["T"]["asof"] == asof_day and got["T"]["volume_z"] == pytest.approx(brute_z(dense)[-1], abs=0.0051)
    assert got["T"]["items_7d"] == sum(n for d, _, n, _ in days if asof_day - timedelta(7) < d <= asof_day)
    assert (got["U"]["items_7d"], got["U"]["volume_z"], got["U"]["delta_vs_90d"]) == (0, None, None)


def test_daily_series_fills_gaps_and_counts_authors_once(spark):
    day = 1704067200
    items = spark.createDataFrame([("post", "1", "s", "a", day), ("comment", "2", "s", "a", day + 5), ("comment", "3", "s", None, day + 2 * 86400)], "kind string, id string, subreddit string, author string, created_utc long")
    got = [tuple(r)[1:] for r in series.daily_volume(items).orderBy("date").collect()]
    assert got == [(date(2024, 1, 1), 1, 1, 1), (date(2024, 1, 2), 0, 0, 0), (date(2024, 1, 3), 0, 1, 0)]
    assert series.daily_volume(items.limit(0)).count() == 0


def test_first_settled_in_any_order(spark):
    data = [("k", 1, False), ("k", 2, True), ("k", 3, True), (None, 1, True)]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "id string, seen int, stamped boolean")
        assert rows(series.first_settled(df, ["id"], F.col("stamped"), ["seen"], ["id", "seen"])) == [("k", 2)]


# As-of


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 60), max_size=12), st.lists(st.tuples(st.integers(0, 60), st.integers(0, 3)), max_size=12))
def test_nearest_against_brute_force(spark, asks, points):
    left = spark.createDataFrame([("k", i, t) for i, t in enumerate(asks)] + [("k", -1, None), ("other", -2, 5)], "k string, i long, t long")
    right = spark.createDataFrame([("k", t, f"v{v}") for t, v in points] + [("k", 3, None)], "k string, t long, v string")
    best = {}
    for t, v in points:
        best[t] = min(best.get(t, "w"), f"v{v}")
    for r in asof.nearest(left, right, ["k"], "t", "v", bucket=7).collect():
        want = min(best, key=lambda x: (abs(x - r["t"]), x), default=None) if r["k"] == "k" and r["t"] is not None else None
        assert (r["nearest_at"], r["nearest_value"]) == (want, best.get(want))


def test_overlay_clips_to_the_common_span(spark):
    s = lambda *days: spark.createDataFrame([(date(2024, 1, d), float(d)) for d in days], "date date, value double")
    assert rows(asof.overlay({"a": s(1, 2, 4, 6), "b": s(2, 3, 6, 9)})) == [(date(2024, 1, 2), 2.0, 2.0), (date(2024, 1, 3), None, 3.0), (date(2024, 1, 4), 4.0, None), (date(2024, 1, 6), 6.0, 6.0)]
    assert rows(asof.by_key(spark.createDataFrame([("A", 1)], "symbol string, n int"), ["A", "B"])) == [("A", (1,)), ("B", None)]


def test_rebase_and_change(spark):
    df = spark.createDataFrame([("s", date(2024, 1, d), v) for d, v in ((1, 0.0), (2, 4.0), (3, 6.0))], "k string, date date, v double")
    assert [r["indexed"] for r in gauge.rebased(df, ["k"], "v").orderBy("date").collect()] == [None] * 3
    assert [r["indexed"] for r in gauge.rebased(df, ["k"], "v", first="2024-01-02").orderBy("date").collect()] == [100.0, 150.0]
    assert [r["change_pct"] for r in gauge.last_change(df, ["k"], "v").orderBy("date").collect()] == [None, None, 0.5]


# Threads, sampling, evaluation, fitting


def test_update_join_refuses_unknown_keys(spark):
    base = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "id string, n int, s string")
    assert rows(threads.updated(base, spark.createDataFrame([("b", 9)], "id string, n int"), "id")) == [("a", 1, "x"), ("b", 9, "y")]
    with pytest.raises(ValueError):
        threads.updated(base, spark.createDataFrame([("z", 9)], "id string, n int"), "id")


def test_quota_split_leaves_scarce_classes_a_holdout(spark):
    data = [(f"d{i:03d}", "post" if i % 3 else "comment", i % 5 if i > 6 else 9, i % 4) for i in range(450)]
    df = spark.createDataFrame(data, "id string, kind string, level int, sure int")
    got = sampling.quota_split(df, ["kind", "level"], "id", F.col("sure"), 60).cache()
    counts = {(r["kind"], r["level"]): (r["e"], r["n"]) for r in got.groupBy("kind", "level").agg(F.count_if(F.col("split") == "exemplar").alias("e"), F.count(F.lit(1)).alias("n")).collect()}
    assert all(1 <= e <= max(1, n // 2) for e, n in counts.values()) and got.count() == 450
    assert rows(got) == rows(sampling.quota_split(df.repartition(5), ["kind", "level"], "id", F.col("sure"), 60))


def _candidates():
    rng = random.Random(3)
    out = []
    for era in ("2021", "2022", "2023", "2024", "2025", "2026"):
        for kind, n in (("post", 120), ("comment", 600)):
            for i in range(n):
                tags = [] if rng.random() < 0.3 else rng.sample(["A", "B", "C"], rng.randint(1, 2))
                out.append({"id": f"{kind[0]}{era}{i}", "kind": kind, "era": era, "length": rng.choice(["short", "medium", "long"]), "removed": kind == "post" and rng.random() < 0.05, "tags_hit": tags})
    return out + [{"id": f"rare{i}", "kind": "comment", "era": "2022", "length": "short", "removed": False, "tags_hit": ["RARE"]} for i in range(3)]


def test_allocation_meets_its_quotas_whatever_the_order():
    pool, q = _candidates(), sampling.Quotas()
    got = sampling.allocate(pool, q)
    assert len(got) == 450 and len({r["id"] for r in got}) == 450
    assert sum("RARE" in r["tags_hit"] for r in got) == 3
    assert sum(r["pick_reason"] == "no_hit" for r in got) == 50 and sum(r["removed"] for r in got) >= 15
    for kind, total in q.totals.items():
        per = [sum(r["kind"] == kind and r["era"] == era for r in got) for era in ("2021", "2026")]
        assert all(abs(p - total / 6) <= 1 for p in per)
    random.Random(1).shuffle(pool)
    assert {r["id"] for r in sampling.allocate(pool, q)} == {r["id"] for r in got}
    assert sampling.allocate([], q) == []


def test_hash_part_is_the_digest_modulo_five(spark):
    import hashlib

    ids = [f"x{i}" for i in range(50)]
    assert values(spark, sampling.hash_part(F.col("x")), ids) == [int(hashlib.md5(i.encode()).hexdigest(), 16) % 5 for i in ids]


def _kappa(spark, pairs):
    return evaluate.kappa(spark.createDataFrame(pairs, "gold int, scored int")).first()["kappa"]


def test_kappa(spark):
    assert _kappa(spark, [(1, 1), (-1, -1)]) == 1.0 and _kappa(spark, [(1, -1), (-1, 1)]) == -1.0 and _kappa(spark, [(1, 1), (1, 1)]) == 1.0
    assert _kappa(spark, [(0, 1), (2, 2), (-2, -2)]) > _kappa(spark, [(0, 2), (2, 0), (-2, -2)])
    both = evaluate.agreement(spark.createDataFrame([(0, 0), (1, 2), (2, -2), (None, 1)], "gold int, scored int")).first()
    assert tuple(both) == (3, 0.333333, 0.666667)


def test_tag_scores(spark):
    df = spark.createDataFrame([(["A", "B"], ["A"]), (["A"], ["A", "C"]), (None, ["A"]), (["D"], None)], "gold_tags array<string>, scored_tags array<string>")
    assert rows(evaluate.tag_scores(df)) == [("A", 2, 1, 0, 0.666667, 1.0, 0.8), ("B", 0, 0, 1, 0.0, 0.0, 0.0), ("D", 0, 0, 1, 0.0, 0.0, 0.0)]


def test_label_problems(spark):
    schema = "tags array<string>, overall_sentiment int, no_sentiment boolean, tag_sentiment map<string,int>, confidence string, rationale string"
    data = [(["A"], 1, False, {"A": 2}, "high", "x"), (["Z"], 5, True, {"A": 3}, "sure", " "), ([], 0, True, {}, "low", "x"), (None, 1, False, {}, "low", "x")]
    got = [r[0] for r in spark.createDataFrame(data, schema).select(evaluate.label_problems(["A"])).collect()]
    assert got[0] == [] and len(got[1]) == 7 and got[2] == ["no tags"] and got[3] == ["missing: tags"]


def test_best_thresholds_against_brute_force(spark):
    rng = random.Random(2)
    data = [(round(rng.uniform(-1, 1), 2), round(rng.random(), 2), rng.randint(-2, 2)) for _ in range(400)]
    combos = fit.grid([0.0, 0.3, 0.5], [-0.5, -0.2, 0.1], [0.4, 0.8, 2.0])
    y = lambda g: (g > 0) - (g < 0)
    said = lambda c, u, p, n, m: 0 if u >= m else 1 if c >= p else -1 if c <= n else 0
    accuracy = [sum(said(c, u, p, n, m) == y(g) for c, u, g in data) / 400 for _, p, n, m in combos]
    best = combos[max(range(len(combos)), key=lambda i: (accuracy[i], -i))]
    got = fit.best_thresholds(spark.createDataFrame(data, "compound double, neu double, gold int"), combos).first()
    assert tuple(got)[:3] == best[1:] and got["accuracy"] == pytest.approx(max(accuracy))
    assert fit.best_thresholds(spark.createDataFrame([], "compound double, neu double, gold int"), combos).count() == 0


def test_learned_terms_and_merge(spark):
    docs = spark.createDataFrame([("love love this", 1)] * 60 + [("hate this", -1)] * 60 + [("this sput", 0)] * 60, "text string, y int")
    found = {r["token"]: r for r in fit.associations(docs, banned=["sput"]).collect()}
    assert set(found) == {"love", "this", "hate"} and found["love"]["association"] > 0.5 > -0.5 > found["hate"]["association"]
    assert {r["token"] for r in fit.learned_lexicon(fit.associations(docs), 4.0).collect()} >= {"love", "hate"}
    assert fit.merged_lexicon({"a": 1.0, "b": 1.0}, {"b": 2.0}) == {"a": 1.0, "b": 2.0}


# Collection and streaming


OBJECTS = "object_key string, etag string, size_bytes long, uploaded_at timestamp"


def _objects(spark, etag="e1"):
    from datetime import datetime

    at = datetime(2024, 2, 1)
    return spark.createDataFrame([("raw/s/2024-01/posts-part-0000.jsonl.gz", "e0", 1, at), ("raw/s/2024-01/posts-part-0001.jsonl.gz", etag, 1, at), ("raw/s/2024-02/posts-part-0000.jsonl.gz", "e2", 1, at), ("junk", "e", 1, at)], OBJECTS)


def test_fingerprints_ignore_order_and_see_changes(spark):
    base = rows(collection.fingerprints(_objects(spark)))
    assert rows(collection.fingerprints(_objects(spark).orderBy(F.desc("object_key")))) == base and len(base) == 2
    assert rows(collection.fingerprints(_objects(spark, "new")))[0] != base[0]


def test_incremental_rebuild_touches_what_changed(spark, tmp_path):
    manifest, built = Manifest(spark, str(tmp_path / "m")), []
    build = lambda part: built.append(sorted(r["month_label"] for r in part.collect()))
    done = lambda *a, **k: rows(incremental.rebuild(*a, build, **k), "label")
    assert len(done(_objects(spark), manifest)) == 2
    assert done(_objects(spark), Manifest(spark, str(tmp_path / "m"))) == []
    assert done(_objects(spark, "new"), manifest) == [("s/2024-01/posts",)] and built[-1] == ["2024-01"]
    assert len(done(_objects(spark, "new"), manifest, version="v2")) == 2
    assert len(done(_objects(spark, "new"), manifest, version="v2", full=True, wave=1)) == 2
    parts = incremental.labelled(collection.fingerprints(_objects(spark, "new")))
    assert not collection.healthy(parts, manifest.table(), ["label"])


def test_open_partitions_and_final_receipts(spark):
    at = 1704067200 + 86400  # 2024-01-02
    data = [("s", "2023-05", "posts", 0, "2023-06-02T00:00:00Z"), ("s", "2023-06", "posts", 3, "2023-08-02T00:00:00Z"), ("s", "2023-07", "posts", None, "2023-08-05T00:00:00Z"), ("s", "2023-08", "posts", None, "2023-12-05T00:00:00Z"), ("s", "2023-09", "posts", None, None), ("t", "2020-01", "posts", 0, None)]
    receipts = spark.createDataFrame(data, "subreddit string, month_label string, kind string, rows_unsettled long, collected_at string")
    got = {(r[0], r[1]) for r in collection.open_partitions(receipts, at).filter("kind = 'posts'").collect()}
    tail = {("s", m) for m in ("2024-01", "2023-12", "2023-11", "2023-10", "2023-09")}
    assert {g for g in got if g[0] == "s"} == tail | {("s", "2023-06"), ("s", "2023-07")}
    assert len([g for g in got if g[0] == "t"]) == 24
    collected = incremental.reconcile(receipts.filter("subreddit = 's'"), at, lambda *k: {"k": k})
    assert len(collected) == 12


def test_stream_gives_what_a_batch_gives(spark, tmp_path):
    rng = random.Random(5)
    schema = "id string, stamp long, seen long, month string, body string"
    data = [(f"k{rng.randint(0, 30)}", rng.choice([None, 1, 2]), i, f"0{rng.randint(1, 3)}", f"b{i}") for i in range(120)]
    for i in range(4):
        spark.createDataFrame(data[i::4], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    order = lambda: [F.col("stamp").isNotNull(), F.col("stamp"), -F.col("seen")]
    start = lambda: merge.merge_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), str(tmp_path / "store"), ["id"], order, "month", str(tmp_path / "ck")).awaitTermination()
    start()
    from larkspur.operators.exactly_once import fold

    want = fold(spark.createDataFrame(data, schema), ["id"], order(), F.lit(1))
    got = lambda: rows(merge.merged(spark, str(tmp_path / "store"), ["id"], order(), "month"), "id", "body", "n_copies")
    assert got() == rows(want, "id", "body", "n_copies")
    spark.createDataFrame([("k0", 9, 999, "09", "late")], schema).write.mode("append").parquet(str(tmp_path / "in"))
    start()
    assert ("k0", "late") in {r[:2] for r in got()}
