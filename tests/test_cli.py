"""The command line, from raw parts to published documents."""

from __future__ import annotations

import gzip
import json

from larkspur.__main__ import main
from larkspur.operators import collection
from larkspur.sources.derived import Manifest
from larkspur.streaming.incremental import labelled


def _write_parts(root):
    for month, day in (("2024-01", 1704067200), ("2024-02", 1706745600)):
        folder = root / f"raw/s/{month}"
        folder.mkdir(parents=True)
        posts = [{"id": f"p{day}{i}", "created_utc": day + i * 3600, "title": "a good restart", "selftext": "", "author": f"a{i}"} for i in range(5)]
        comments = [{"id": f"c{day}{i}", "created_utc": day + i * 3600, "body": "terrible spot price" if i % 2 else "[removed]", "link_id": f"t3_p{day}0", "parent_id": f"t3_p{day}0"} for i in range(5)]
        for kind, rows in (("posts", posts), ("comments", comments)):
            with gzip.open(folder / f"{kind}-part-0000.jsonl.gz", "wt") as f:
                f.write("".join(json.dumps(r) + "\n" for r in rows + rows[:1]))


def test_pipeline_from_the_command_line(spark, tmp_path, capsys):
    _write_parts(tmp_path)
    d, e, s = (str(tmp_path / x) for x in ("derived", "enrich", "series"))
    assert main(["derive", str(tmp_path), d]) == main(["enrich", d, e]) == main(["series", d, e, s]) == main(["report", d]) == 0
    assert spark.read.parquet(d).count() == 20 and spark.read.parquet(e).count() == 20
    labels = {(r["vader_label"], len(r["tags"])) for r in spark.read.parquet(e).collect()}
    assert labels == {("pos", 1), ("neg", 1), (None, 0)}
    document = json.loads(next((tmp_path / "series/series.json").glob("part-*")).read_text())
    assert len(document["daily"]) == 32 and document["gauge"] is None and document["versions"]["lexicon"] == "seed-1"
    tags = json.loads(next((tmp_path / "series/tags.json").glob("part-*")).read_text())
    assert {t["key"] for t in tags["tags"]} == {"RESTART", "ORE_SPOT"}
    assert main([]) == 0 and main(["nonsense"]) == 2
    assert main(["list"]) == 0 and "p1_found" in capsys.readouterr().out


def test_check_command(spark, tmp_path):
    listing = spark.createDataFrame([("raw/s/2024-01/posts-part-0000.jsonl.gz", "e", 1)], "object_key string, etag string, size_bytes long")
    listing.write.parquet(str(tmp_path / "listing"))
    manifest = tmp_path / "m.json"
    assert main(["check", str(tmp_path / "listing"), str(manifest)]) == 1
    Manifest(spark, str(manifest)).commit(labelled(collection.fingerprints(listing)))
    assert main(["check", str(tmp_path / "listing"), str(manifest)]) == 0


def test_build_command_derives_only_what_changed(spark, tmp_path):
    _write_parts(tmp_path)
    out, manifest = str(tmp_path / "derived"), str(tmp_path / "manifest")
    assert main(["build", str(tmp_path), out, manifest]) == 0
    assert spark.read.parquet(out).count() == 20
    with gzip.open(tmp_path / "raw/s/2024-02/posts-part-0001.jsonl.gz", "wt") as f:
        f.write(json.dumps({"id": "new", "created_utc": 1706745999, "title": "t"}) + "\n")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "derived").glob("kind=*/**/*.parquet")}
    assert main(["build", str(tmp_path), out, manifest]) == 0
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "derived").glob("kind=*/**/*.parquet")}
    assert spark.read.parquet(out).count() == 21 and len(before.items() & after.items()) == 3


def test_label_commands(spark, tmp_path, capsys):
    labels = [(f"d{i}", ["A"] if i % 2 else [], i % 3 - 1, i % 3 == 1, {"A": 1} if i % 2 else {}, ("high", "low")[i % 2], "r", "none") for i in range(12)]
    schema = "doc_id string, tags array<string>, overall_sentiment int, no_sentiment boolean, tag_sentiment map<string,int>, confidence string, rationale string, split string"
    own, scores, review, merged = (str(tmp_path / x) for x in ("labels", "scores", "review", "merged"))
    spark.createDataFrame(labels, schema).write.parquet(own)
    spark.createDataFrame([(r[0], ["A"], r[2]) for r in labels], "doc_id string, tags array<string>, overall_sentiment int").write.parquet(scores)
    assert main(["review", "export", own, review]) == main(["review", "merge", own, review, merged]) == main(["split", own, str(tmp_path / "split"), "6"]) == main(["bench", own, scores]) == 0
    said = capsys.readouterr().out
    assert "exact=1.0" in said and "kappa=1.0" in said and "tag=A" in said and "precision=0.5" in said
    assert spark.read.parquet(merged).count() == 12 and spark.read.parquet(str(tmp_path / "split")).filter("split = 'exemplar'").count() == 6
    (tmp_path / "w.txt").write_text("good\t1.9\n")
    assert main(["lexicon", str(tmp_path / "w.txt"), str(tmp_path / "l.json"), "v"]) == 0
    spark.createDataFrame([(0.5, 0.1, 1), (-0.5, 0.1, -1), (0.0, 0.9, 0)], "compound double, neu double, gold int").write.parquet(str(tmp_path / "rated"))
    assert main(["fit", str(tmp_path / "rated"), str(tmp_path / "fit.json"), "v2", str(tmp_path / "l.json")]) == 0
    from larkspur.functions import sentiment

    made = sentiment.load_lexicon(tmp_path / "fit.json")
    assert made.version == "v2" and made.valences == {"good": 1.9} and 0 < made.pos <= 0.4


def test_taxonomy_command(tmp_path):
    (tmp_path / "t.md").write_text("| Tag | Entity | Search terms |\n|---|---|---|\n| `A` | a | x |\n")
    assert main(["tags", str(tmp_path / "t.md"), str(tmp_path / "t.json"), "v1"]) == 0
    assert json.loads((tmp_path / "t.json").read_text())["version"] == "v1"
