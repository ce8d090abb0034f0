"""Rule-based polarity of short texts, after the published rules of Hutto and Gilbert (ICWSM 2014).

The lexicon is a parameter. The small one shipped here is original, so scores cannot be compared with those made from
another word list. Scoring runs in Arrow batches.
"""

from __future__ import annotations

import json
import math
import re
from dataclasses import asdict, dataclass, field
from pathlib import Path

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Valences of the seed lexicon on a scale from -4 to 4.
SEED = {
    "amazing": 2.8, "bankrupt": -2.8, "beat": 1.2, "beats": 1.2, "best": 2.9, "better": 1.8, "bold": 1.2, "boom": 1.8, "boring": -1.3, "breakout": 1.6,
    "bullish": 2.3, "bearish": -2.2, "bust": -2.0, "calm": 1.1, "cheap": 0.8, "cheaper": 0.9, "clean": 1.3, "collapse": -2.6, "crash": -2.6, "crisis": -2.4,
    "danger": -2.2, "dead": -2.4, "delay": -1.2, "delays": -1.2, "deny": -0.9, "dilution": -1.8, "disaster": -2.9, "doubt": -1.3, "downgrade": -1.8, "dull": -1.1,
    "excellent": 2.9, "excited": 2.1, "fail": -2.2, "fails": -2.1, "failure": -2.4, "fantastic": 2.8, "fear": -1.9, "fears": -1.8, "fine": 0.9, "fraud": -3.0,
    "gain": 1.7, "gains": 1.7, "glad": 1.9, "good": 1.9, "great": 2.7, "greed": -1.4, "growth": 1.5, "happy": 2.6, "hate": -2.7, "hates": -2.6,
    "healthy": 1.7, "honest": 1.6, "hope": 1.6, "huge": 1.1, "hurt": -1.9, "ignore": -1.1, "ignores": -1.1, "inert": -0.6, "insane": -1.4, "joke": -0.9,
    "like": 1.3, "likes": 1.4, "loss": -1.7, "losses": -1.8, "love": 3.0, "loves": 2.8, "lucky": 1.7, "massive": 0.9, "moon": 1.8, "murky": -1.2,
    "nice": 1.8, "noisy": -0.9, "overvalued": -1.6, "panic": -2.3, "patient": 0.9, "poor": -1.9, "profit": 1.8, "profits": 1.8, "promising": 1.8, "punish": -1.9,
    "punishes": -1.9, "rally": 1.7, "reject": -1.5, "rejects": -1.5, "reliable": 1.7, "reward": 1.9, "rewards": 1.9, "risk": -1.1, "risky": -1.4, "ruin": -2.5,
    "safe": 1.6, "scam": -2.9, "scare": -1.8, "scares": -1.8, "scary": -1.9, "selloff": -1.7, "shame": -1.9, "shortage": -1.0, "solid": 1.5, "stale": -1.0,
    "strong": 1.9, "stuck": -1.2, "success": 2.4, "support": 1.3, "surplus": 0.6, "terrible": -2.8, "thanks": 1.8, "thin": -0.5, "toxic": -2.4, "trash": -2.1,
    "trust": 1.7, "ugly": -1.9, "undervalued": 1.6, "upgrade": 1.6, "useful": 1.6, "useless": -1.9, "victory": 2.4, "volatile": -1.0, "weak": -1.6, "win": 2.4,
    "wins": 2.3, "wonderful": 2.8, "worry": -1.7, "worse": -2.0, "worst": -3.0, "wrong": -1.8, "yikes": -1.6, "🚀": 1.9, "💎": 1.3, "🔥": 1.1, "😂": 1.2, "😭": -1.3,
}
# Words that strengthen (1) or weaken (-1) the next one, and words that negate.
DEGREES = {
    "absolutely": 1, "amazingly": 1, "completely": 1, "considerably": 1, "deeply": 1, "enormously": 1, "entirely": 1, "especially": 1, "exceptionally": 1, "extremely": 1,
    "highly": 1, "hugely": 1, "incredibly": 1, "intensely": 1, "more": 1, "most": 1, "particularly": 1, "really": 1, "remarkably": 1, "so": 1, "totally": 1, "truly": 1, "very": 1,
    "almost": -1, "barely": -1, "hardly": -1, "less": -1, "little": -1, "marginally": -1, "occasionally": -1, "partly": -1, "scarcely": -1, "slightly": -1, "somewhat": -1,
}
NEGATIONS = frozenset("aint arent cannot cant couldnt didnt doesnt dont hadnt hasnt havent isnt mustnt neither never none nope nor not nothing nowhere shouldnt wasnt werent without wont wouldnt".split())
# The published constants of the rules.
STEP, CAPS, NEGATED, NORM = 0.293, 0.733, -0.74, 15.0
FADE = (1.0, 0.95, 0.9)


@dataclass(frozen=True)
class Lexicon:
    """Word valences with an overlay: ``neutralize`` removes words, ``overrides`` set them, thresholds give labels."""

    version: str = "seed-1"
    valences: dict[str, float] = field(default_factory=lambda: SEED)
    overrides: dict[str, float] = field(default_factory=dict)
    neutralize: tuple[str, ...] = ()
    pos: float = 0.05
    neg: float = -0.05
    neu_min: float = 2.0

    def merged(self) -> dict[str, float]:
        dropped = {w.lower() for w in self.neutralize}
        return {w: v for w, v in self.valences.items() if w not in dropped} | {w.lower(): v for w, v in self.overrides.items()}


def publish_lexicon(lexicon: Lexicon, path: str | Path, force: bool = False) -> None:
    """Write a lexicon with its overlay and thresholds as a configuration file; an existing one is kept unless ``force``."""
    if Path(path).exists() and not force:
        raise FileExistsError(path)
    Path(path).write_text(json.dumps(asdict(lexicon), ensure_ascii=False), encoding="utf-8")


def load_lexicon(path: str | Path) -> Lexicon:
    held = json.loads(Path(path).read_text(encoding="utf-8"))
    return Lexicon(**(held | {"neutralize": tuple(held.get("neutralize", ()))}))


def word_list(path: str | Path) -> dict[str, float]:
    """Valences of a tab-separated word list (word, mean valence, whatever follows), as polarity lexicons are published."""
    rows = (line.split("\t") for line in Path(path).read_text(encoding="utf-8").splitlines() if line.strip())
    return {r[0].lower(): float(r[1]) for r in rows if len(r) > 1}


def _negates(word: str) -> bool:
    return word.replace("'", "").replace("’", "") in NEGATIONS or word.endswith(("n't", "n’t"))


def _words(text: str) -> list[str]:
    parts = re.findall(r"[\w'’$-]+|[^\w\s]", text)
    return [p for p in parts if p.isalnum() or len(p) > 1 or ord(p) > 0x2000]


def polarity(text: str, valences: dict[str, float]) -> tuple[float, float]:
    """``(compound, neutral share)``; compound lies in -1..1 and is rounded to four places."""
    words = _words(text)
    lower = [w.lower() for w in words]
    loud = [len(w) > 1 and w.isupper() for w in words]
    mixed = any(loud) and not all(loud)
    scores = []
    for i, word in enumerate(lower):
        value = valences.get(word, 0.0)
        if not value or word in DEGREES:
            scores.append(0.0)
            continue
        sign = math.copysign(1.0, value)
        if mixed and loud[i]:
            value += sign * CAPS
        for back, fade in enumerate(FADE, 1):
            if i < back:
                break
            before = lower[i - back]
            if before in valences and before not in DEGREES:
                continue
            push = DEGREES.get(before, 0) * STEP
            if push and mixed and loud[i - back]:
                push += math.copysign(CAPS, push)
            value += sign * push * fade
        near = lower[max(0, i - 3) : i]
        if any(map(_negates, near)) or (near[-1:] == ["least"] and near[-2:-1] not in (["at"], ["very"])):
            value *= NEGATED
        scores.append(value)
    if "but" in lower:
        turn = lower.index("but")
        scores = [s * (0.5 if k < turn else 1.5 if k > turn else 1.0) for k, s in enumerate(scores)]
    total = sum(scores)
    marks, asks = min(text.count("!"), 4), text.count("?")
    force = marks * 0.292 + (0 if asks < 2 else asks * 0.18 if asks <= 3 else 0.96)
    total += math.copysign(force, total) if total else 0.0
    compound = round(max(-1.0, min(1.0, total / math.sqrt(total * total + NORM))), 4) if total else 0.0
    up, down, flat = sum(s + 1 for s in scores if s > 0), sum(1 - s for s in scores if s < 0), sum(1 for s in scores if not s)
    if up > down:
        up += force
    elif down > up:
        down += force
    whole = up + down + flat
    return compound, round(flat / whole, 3) if whole else 0.0


def polarity_scores(text: Column, lexicon: Lexicon = Lexicon()) -> Column:
    """``struct<compound double, neu double>``; NULL for NULL and blank text."""
    valences = lexicon.merged()

    @F.pandas_udf("compound double, neu double")
    def score(texts: pd.Series) -> pd.DataFrame:
        rows = [polarity(t, valences) if t is not None and t.strip() else (None, None) for t in texts]
        return pd.DataFrame(rows, columns=["compound", "neu"], dtype="float64")

    return score(text)
