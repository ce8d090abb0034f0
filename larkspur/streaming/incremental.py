"""Rebuild only what changed: partitions whose fingerprint differs from the manifest, one commit each."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators.collection import enrich_fingerprint, fingerprints, stale
from larkspur.scratch import materialize
from larkspur.sources.derived import Manifest

KEYS = ["subreddit", "month_label", "kind"]


def labelled(partitions: DataFrame) -> DataFrame:
    return partitions.withColumn("label", F.concat_ws("/", *KEYS))


def rebuild(objects: DataFrame, manifest: Manifest, build: Callable[[DataFrame], None], version: str | None = None, full: bool = False, wave: int = 500) -> DataFrame:
    """Call ``build`` with the stale partitions (``subreddit, month_label, kind``), about ``wave`` at a time, and commit each wave.

    ``version`` is mixed into the fingerprints, so another configuration makes everything stale. Waves are dealt by hash and
    stay tables; only their number comes to the driver. Returns the labels and fingerprints rebuilt.
    """
    parts = labelled(fingerprints(objects))
    if version is not None:
        parts = parts.withColumn("fingerprint", enrich_fingerprint(F.col("fingerprint"), F.lit(version)))
    waiting = materialize(stale(parts, manifest.table(), ["label"], full).select("label", "fingerprint", *KEYS), "stale")
    waves = -(-waiting.count() // wave)
    dealt = waiting.withColumn("_wave", F.pmod(F.xxhash64("label"), F.lit(max(1, waves))))
    for k in range(waves):
        part = dealt.filter(F.col("_wave") == k)
        build(part.select(*KEYS))
        manifest.commit(part)
    return waiting.select("label", "fingerprint")


def reconcile(receipts: DataFrame, at: int, collect: Callable[[str, str, str], dict], tail_months: int = 2, at_once: int = 4) -> list[dict]:
    """Collect every open partition again and return the new receipts; settled months stay closed.

    ``at_once`` jobs run side by side; their tasks share the cluster.
    """
    from larkspur.functions.times import settled_month
    from larkspur.operators.collection import open_partitions

    due = [tuple(r[k] for k in KEYS) for r in open_partitions(receipts, at, tail_months).orderBy(*KEYS).toLocalIterator() if settled_month(r["month_label"], at + 1)]
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(lambda k: collect(*k), due))
