"""Queries against brute force of their own over whole tables, where a cut in both the query and its SQL would go unseen."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from larkspur.operators import drift
from larkspur.session import table

SF = "/root/testdata/sf0.001"
stored = pytest.mark.skipif(not Path(SF).exists(), reason="the test tables are not here")


def _lines(spark, files):
    return spark.createDataFrame([(f"raw/s/{k}-part-0000.jsonl.gz", i, line) for k, lines in files.items() for i, line in enumerate(lines)], "file_key string, line_no long, record_json string")


def test_nested_field_that_comes_as_text(spark):
    raw = _lines(spark, {
        "2024-01/posts": ['{"_meta":{"retrieved_2nd_on":7}}', '{"_meta":{"is_edited":true}}'],
        "2024-02/posts": ['{"_meta":"{\\"retrieved_2nd_on\\": 8}"}', '{"_meta":"{\\"is_edited\\": false}"}', '{"_meta":"none"}', '{"_meta":"3"}', '{"_meta":[8]}', "{}", "broken"],
    })
    got = [tuple(r) for r in drift.consistent_table(raw).orderBy("file_key", "line_no").select("retrieved_2nd_on", "is_edited").collect()]
    assert got == [(7, None), (None, True), (8, None), (None, False)] + [(None, None)] * 5
    steps = {r["file_key"][6:13]: r["steps"].split(";") for r in drift.schema_versions(raw).collect()}
    assert "cast:_meta" not in steps["2024-01"] and "cast:_meta" in steps["2024-02"]


@stored
def test_no_stamp_of_a_stored_record_is_lost(spark):
    want = []
    for r in table(spark, SF, "raw_records").filter("file_key IS NOT NULL").collect():
        try:
            meta = json.loads(r["record_json"]).get("_meta")
            meta = json.loads(meta) if isinstance(meta, str) else meta
        except (TypeError, ValueError, AttributeError):
            meta = None
        meta = meta if isinstance(meta, dict) else {}
        want.append((r["file_key"], r["line_no"], meta.get("retrieved_2nd_on"), meta.get("is_edited")))
    got = [tuple(r) for r in entry.queries()["p5_table"](spark, SF).select("file_key", "line_no", "retrieved_2nd_on", "is_edited").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@stored
def test_documents_of_every_language_are_tagged(spark):
    import re

    from larkspur.sources import taxonomy

    def found(tag, text):
        words = re.escape
        return any(re.search(rf"\b{words(x.text)}\b|\$(?i:{words(x.text)})\b" if x.strict else rf"(?i:\b{words(x.text)}\b)", text) for x in tag.terms)

    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    want = {r["doc_id"]: ";".join(t.key for t in taxonomy.default() if found(t, r["text"] or "")) for r in docs}
    assert {r["doc_id"]: r["tags"] for r in entry.queries()["regex_tags"](spark, SF).collect()} == want


@stored
def test_words_of_the_whole_text_are_counted(spark):
    import re

    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    want = {r["doc_id"]: len(re.split(r"[ \t\n\f\r]+", r["text"].strip(" "))) for r in docs if (r["text"] or "").strip(" ")}
    assert {r["doc_id"]: r["words"] for r in entry.queries()["word_length_era"](spark, SF).collect()} == want


def test_threshold_grids_are_the_references():
    from larkspur.operators import fit

    band = [round(x * 0.02, 2) for x in range(1, 21)]
    assert (fit.GRID_POS, [-x for x in fit.GRID_NEG]) == (band, band)
    assert fit.GRID_NEU == [2.0, *(round(0.80 + x * 0.02, 2) for x in range(11))]
    assert fit.DISTILL_BAND == [round(x * 0.03, 2) for x in range(1, 11)] and fit.SCALES == [3.0, 4.5, 6.0, 8.0]


def test_full_grid_against_brute_force(spark):
    import random

    import numpy as np

    from larkspur.operators import fit

    rng = random.Random(5)
    data = [(round(rng.uniform(-0.5, 0.5), 3), round(rng.uniform(0.7, 1.0), 3), rng.randint(-2, 2)) for _ in range(300)]
    c, u, y = np.array([r[0] for r in data]), np.array([r[1] for r in data]), np.sign([r[2] for r in data])
    combos = fit.grid(fit.GRID_POS, fit.GRID_NEG, fit.GRID_NEU)
    hits = [int((np.where(u >= m, 0, np.where(c >= p, 1, np.where(c <= n, -1, 0))) == y).sum()) for _, p, n, m in combos]
    assert len(combos) == 4800
    got = fit.best_thresholds(spark.createDataFrame(data, "compound double, neu double, gold int"), combos).first()
    assert tuple(got)[:3] == combos[hits.index(max(hits))][1:] and got["accuracy"] == round(max(hits) / 300, 6)


def test_allocation_from_the_shortlist_is_that_from_all(spark):
    import random

    from larkspur.operators import sampling

    rng, q = random.Random(7), sampling.Quotas(totals={"post": 12, "comment": 24}, no_hit={"post": 2, "comment": 4}, removed=3, per_tag=3)
    rows = []
    for era in ("2021", "2022"):
        for kind, n in (("post", 300), ("comment", 600)):
            # A is commoner than B over all, but both fill their strata; ids of posts and comments coincide.
            for i in range(n):
                tags = [] if rng.random() < 0.2 else rng.sample(["B", "A", "A", "A", "C"], 2)
                rows.append({"id": f"{era}{i}", "kind": kind, "era": era, "length": rng.choice(["short", "medium", "long"]), "removed": kind == "post" and rng.random() < 0.1, "tags_hit": sorted(set(tags))})
    df = spark.createDataFrame(rows, "id string, kind string, era string, length string, removed boolean, tags_hit array<string>")
    counts = sampling.tag_counts(df)
    held = [r.asDict() for r in sampling.shortlist(df, q, len(counts)).collect()]
    picks = lambda found: [(r["kind"], r["id"], r["pick_reason"]) for r in found]
    want = picks(sampling.allocate(rows, q))
    assert len(held) < len(rows) and len(want) == len(set(want)) == 36
    assert picks(sampling.allocate(held, q, counts)) == want
    assert counts["B"] < counts["A"]


@stored
def test_views_are_cut_at_the_operators_bound(spark):
    from hashlib import md5

    docs = [r for r in table(spark, SF, "documents").select("doc_id", "text").collect() if r["text"] is not None]
    want = {r["doc_id"]: md5((r["text"] if len(r["text"]) <= 8000 else r["text"][:8000] + "\n[truncated]").encode()).hexdigest() for r in docs}
    assert {r["doc_id"]: r["cut_md5"] for r in entry.queries()["text_views"](spark, SF).collect()} == want
