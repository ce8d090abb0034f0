from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from larkspur.llm import spans


def brute_pairs(texts, length):
    grams = {i: {t[p : p + length] for p in range(len(t) - length + 1)} for i, t in texts.items() if t is not None}
    return {(a, b) for a in grams for b in grams if a < b and grams[a] & grams[b]}


def brute_spans(texts, length):
    grams = {i: [t[p : p + length] for p in range(len(t) - length + 1)] if t else [] for i, t in texts.items()}
    out = set()
    for i, own in grams.items():
        others = {g for j, gs in grams.items() if j != i for g in gs}
        hits = [p for p, g in enumerate(own) if g in others]
        while hits:
            start = last = hits.pop(0)
            while hits and hits[0] <= last + length:
                last = hits.pop(0)
            out.add((i, start, last + length))
    return out


def make(rng, n=30):
    alphabet = list("abcdé🚀 \n")
    text = lambda k: "".join(rng.choice(alphabet, k))
    shared = [text(int(k)) for k in rng.integers(10, 80, 6)]
    out = {}
    for i in range(n):
        parts = [text(int(rng.integers(0, 60)))]
        for _ in range(int(rng.integers(0, 3))):
            s = shared[int(rng.integers(len(shared)))]
            cut = int(rng.integers(0, 12))
            parts += [s[cut:], text(int(rng.integers(0, 30)))]
        out[i] = "".join(parts)
    out[n], out[n + 1], out[n + 2], out[n + 3] = "", None, "a" * 300, "b" + "a" * 100
    out[n + 4] = out[n + 5] = out[0] + shared[0]
    return out


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in texts.items()], "doc_id long, text string, anchor string, pos string")


def test_pairs_and_spans_against_brute_force(spark):
    for seed in range(3):
        texts = make(np.random.default_rng(seed))
        df = frame(spark, texts)
        assert {tuple(r) for r in spans.sharing_pairs(df, 30, 10).collect()} == brute_pairs(texts, 30)
        assert {tuple(r) for r in spans.shared_spans(df, 30, 10).collect()} == brute_spans(texts, 30)


def test_blocks_and_cut_segments_do_not_matter(spark, monkeypatch):
    texts = make(np.random.default_rng(9))
    df = frame(spark, texts)
    monkeypatch.setattr(spans.segments, "__defaults__", (spans.LENGTH, spans.ANCHOR, 70))  # segments of at most 70 characters
    assert {tuple(r) for r in spans.sharing_pairs(df, 30, 10, 400).collect()} == brute_pairs(texts, 30)
    assert {tuple(r) for r in spans.shared_spans(df, 30, 10, 400).collect()} == brute_spans(texts, 30)


def test_a_source_that_begins_inside_a_longer_factor_is_found():
    a, b = "".join(chr(2000 + i) for i in range(60)), "".join(chr(3000 + i) for i in range(60))
    block = spans.Block([(1, 0, a + b[:30]), (2, 0, a[40:] + b)], 30)
    found = {tuple(int(x) for x in r) for part in block.parse([(9, 5, "-" + a + b)]) for r in zip(*part)}
    assert found == {(0, 6, 96, 1, 0), (0, 46, 126, 2, 0)}


def test_greedy_parse_takes_the_longest_at_each_uncovered_gram(spark):
    rng = np.random.default_rng(2)
    a = "".join(chr(int(x)) for x in rng.integers(1000, 60_000 - 5000, 100))
    texts = {1: a, 2: a[:40], 3: a[:60], 4: a[20:80] + "!", 5: a[70:]}
    got = sorted(tuple(r) for r in spans.factors(frame(spark, texts), 20, 8).collect() if r["doc_id"] == 1)
    assert got == [(1, 0, 60, 3, 0), (1, 20, 80, 4, 0), (1, 70, 100, 5, 0)]


def test_factors_stand_at_their_sources_and_cover_the_spans(spark):
    for seed in range(2):
        texts = make(np.random.default_rng(seed))
        covered = set()
        for r in spans.factors(frame(spark, texts), 30, 10).collect():
            size = r["factor_end"] - r["factor_start"]
            assert r["source_doc"] != r["doc_id"] and size >= 30
            assert texts[r["doc_id"]][r["factor_start"] : r["factor_end"]] == texts[r["source_doc"]][r["source_start"] : r["source_start"] + size]
            covered |= {(r["doc_id"], p) for p in range(r["factor_start"], r["factor_end"])}
        assert covered == {(i, p) for i, a, b in brute_spans(texts, 30) for p in range(a, b)}


def test_spans_of_just_the_length(spark):
    a, b = "x" * 20 + "".join(chr(1000 + i) for i in range(150)) + "y" * 9, "".join(chr(1000 + i) for i in range(150)) + "z"
    assert [tuple(r) for r in spans.sharing_pairs(frame(spark, {1: a, 2: b})).collect()] == [(1, 2)]
    assert spans.sharing_pairs(frame(spark, {1: a, 2: b[1:]})).count() == 0
    assert {tuple(r) for r in spans.shared_spans(frame(spark, {1: a, 2: b})).collect()} == {(1, 20, 170), (2, 0, 150)}


def test_portion_lists_every_document(spark):
    texts = {1: "q" * 150, 2: "q" * 150 + "r" * 50, 3: None, 4: "", 5: "s"}
    got = {r["doc_id"]: (r["n_chars"], r["n_spans"], r["shared_chars"], r["shared_share"]) for r in spans.shared_portion(frame(spark, texts)).collect()}
    assert got == {1: (150, 1, 150, 1.0), 2: (200, 1, 150, 0.75), 3: (0, 0, 0, 0.0), 4: (0, 0, 0, 0.0), 5: (1, 0, 0, 0.0)}


def test_empty_table_and_a_large_group_of_copies(spark):
    assert spans.sharing_pairs(frame(spark, {1: "a"}).limit(0)).count() == 0
    assert spans.sharing_pairs(frame(spark, {i: "copy of a text " * 20 for i in range(60)})).count() == 60 * 59 // 2


def test_segments_do_not_matter(monkeypatch):
    rng = np.random.default_rng(4)
    text = "".join(rng.choice(list("abc"), 5000))
    whole = spans.text_anchors(text, 60, 20)
    monkeypatch.setattr(spans, "SEGMENT", 700)
    parts = spans.text_anchors(text, 60, 20)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab", min_size=0, max_size=200), st.integers(1, 20))
def test_equal_grams_have_equal_hashes_and_windows_an_anchor(text, k):
    codes = spans.code_points(text)
    h = spans.gram_hashes(codes, k, spans.BASES[0])
    grams = [text[i : i + k] for i in range(max(0, len(text) - k + 1))]
    assert len(h) == len(grams) and len(set(h.tolist())) == len(set(grams))
    at = spans.winnow(h, 5)
    assert all(any(p <= a < p + 5 for a in at) for p in range(len(h) - 4))
