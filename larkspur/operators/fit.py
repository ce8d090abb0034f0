"""Term statistics by class, learned lexicons, and threshold grids."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions import text
from larkspur.functions.sentiment import Lexicon, polarity_scores
from larkspur.operators.sampling import hash_part

# Limits and weights of the term association.
LEAST_DOCS, SHRINKAGE, LEAST_ASSOCIATION, MOST_TERMS, MOST_VALENCE = 50, 30, 0.2, 400, 3.5

# The grids searched: thresholds with the neutral share's bound (2.0: never), and for distillation by the compound alone over four scales.
GRID_POS = [round(0.02 * i, 2) for i in range(1, 21)]
GRID_NEG = [-x for x in GRID_POS]
GRID_NEU = [2.0, *(round(0.80 + 0.02 * i, 2) for i in range(11))]
DISTILL_BAND, SCALES = [round(0.03 * i, 2) for i in range(1, 11)], [3.0, 4.5, 6.0, 8.0]


def doc_frequency(docs: DataFrame, banned: list[str] | None = None) -> DataFrame:
    """``token, n, n_pos, n_neg``: documents that hold a token, by the sign of their ``y``. A token counts once per document."""
    words = text.tokens(F.col("text"))
    if banned:
        words = F.array_except(words, F.array(*map(F.lit, banned)))
    each = docs.select(F.explode(words).alias("token"), "y")
    return each.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") > 0).alias("n_pos"), F.count_if(F.col("y") < 0).alias("n_neg"))


def associations(docs: DataFrame, banned: list[str] | None = None, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``token, n, association``: share of positive less that of negative documents, shrunk to and centred on the corpus.

    ``docs`` is read twice: pass a stored table.
    """
    rates = docs.agg(F.avg((F.col("y") > 0).cast("int")).alias("p_pos"), F.avg((F.col("y") < 0).cast("int")).alias("p_neg"))
    counted = doc_frequency(docs, banned).filter(F.col("n") >= least_docs).join(F.broadcast(rates))  # one row
    shrunk = lambda n, p: (F.col(n) + SHRINKAGE * F.col(p)) / (F.col("n") + SHRINKAGE)
    value = shrunk("n_pos", "p_pos") - shrunk("n_neg", "p_neg") - (F.col("p_pos") - F.col("p_neg"))
    return counted.select("token", "n", value.alias("association"))


def learned_lexicon(found: DataFrame, scale: float, least: float = LEAST_ASSOCIATION, most: int = MOST_TERMS) -> DataFrame:
    """``token, valence`` of the terms with the strongest association times log support; at most ``most``."""
    a = F.col("association")
    valence = F.round(F.greatest(F.lit(-MOST_VALENCE), F.least(F.lit(MOST_VALENCE), a * scale)), 2)
    kept = found.filter(F.abs(a) >= least).select("token", valence.alias("valence"), (F.abs(a) * F.log("n")).alias("weight"))
    return kept.orderBy(F.desc("weight"), "token").limit(most)


def merged_lexicon(hand: dict[str, float], learned: dict[str, float]) -> dict[str, float]:
    """Both word lists; the learned value wins."""
    return hand | learned


def grid(pos: list[float], neg: list[float], neu_min: list[float]) -> list[tuple[int, float, float, float]]:
    """Numbered threshold combinations in search order."""
    return [(i, p, n, u) for i, (p, n, u) in enumerate((p, n, u) for p in pos for n in neg for u in neu_min)]


def best_thresholds(scored: DataFrame, combos: list[tuple[int, float, float, float]]) -> DataFrame:
    """``pos, neg, neu_min, accuracy`` of the first combination of highest accuracy on (``compound, neu, gold``) rows.

    A row's verdict depends only on where its two scores lie among the thresholds, so one pass counts rows per cell of
    that lattice (map-side, at most as many cells as the grid has corners) and running sums over the lattice give every
    combination's hits. Rows are not multiplied by the grid. No usable rows give no result.
    """
    y, c, u = F.signum("gold").cast("int"), F.col("compound"), F.col("neu")
    ps, ns, us = (sorted({x[k] for x in combos}) for k in (1, 2, 3))
    reached = lambda test, cuts: F.size(F.filter(F.array(*[F.lit(float(x)) for x in cuts]), test))
    usable = scored.filter(c.isNotNull() & u.isNotNull() & y.isNotNull())
    cells = usable.groupBy(reached(lambda x: c >= x, ps).alias("p"), reached(lambda x: c <= x, ns).alias("n"), reached(lambda x: u >= x, us).alias("u"), y.alias("y")).agg(F.count(F.lit(1)).alias("rows")).collect()
    total = sum(r["rows"] for r in cells)
    found = None
    if total:
        counts = np.zeros((len(ps) + 1, len(ns) + 1, len(us) + 1, 3), np.int64)
        for r in cells:
            counts[r["p"], r["n"], r["u"], r["y"] + 1] += r["rows"]
        below = counts.cumsum(axis=2)  # rows whose neutral share is under the u-th threshold
        for at, p, n, m in combos:
            i, j, k = ps.index(p), len(ns) - ns.index(n), us.index(m)
            open_ = below[:, :, k]
            hits = counts[:, :, k + 1 :, 1].sum() + open_[i + 1 :, :, 2].sum() + open_[: i + 1, j:, 0].sum() + open_[: i + 1, :j, 1].sum()
            if found is None or hits > found[0]:
                found = (hits, float(p), float(n), float(m))
    rows = [] if found is None else [(*found[1:], round(int(found[0]) / total, 6))]
    return scored.sparkSession.createDataFrame(rows, "pos double, neg double, neu_min double, accuracy double")


def distill(docs: DataFrame, hand: dict[str, float], banned: list[str], scales: list[float], combos: list[tuple[int, float, float, float]], least_docs: int = LEAST_DOCS, least: float = LEAST_ASSOCIATION) -> dict | None:
    """Learn a lexicon from (``id, text, y``) documents: four fifths (by md5) give the terms, the rest picks scale and thresholds.

    ``hand`` words stay unless a learned value replaces them; ``banned`` ones (entities, degree and negation words) learn
    nothing. Returns ``scale, pos, neg, neu_min, accuracy, lexicon`` of the best scale, the first of equals; None for no
    documents. Only learned terms (at most 400) and one row per scale come to the driver.
    """
    part = hash_part(F.col("id"))
    kept = docs.filter(F.col("text").isNotNull() & F.col("y").isNotNull())
    found = associations(kept.filter(part != 0), banned, least_docs)
    trial = kept.filter(part == 0)
    best = None
    for scale in scales:
        learned = {r["token"]: r["valence"] for r in learned_lexicon(found, scale, least).collect()}
        lexicon = merged_lexicon(hand, learned)
        scored = trial.select(polarity_scores(F.col("text"), Lexicon(valences=lexicon)).alias("s"), F.col("y").alias("gold")).select("s.compound", "s.neu", "gold")
        for r in best_thresholds(scored, combos).collect():
            if best is None or r["accuracy"] > best["accuracy"]:
                best = {"scale": scale, **r.asDict(), "lexicon": lexicon}
    return best


def entity_tokens(terms: list[str]) -> list[str]:
    """Tokens of a taxonomy's terms: names carry no valence."""
    return sorted({t for term in terms for t in re.findall(text.TOKEN, term.lower())})
