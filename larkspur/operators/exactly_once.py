"""Keep exactly one copy of every message under at-least-once delivery.

``MessageStore`` holds one winner per key, partitioned. A batch is folded to one candidate per key, the identifier index
tells which historical partitions hold those keys, only those partitions are read, merged and rewritten into a new
version folder, and one manifest of the next number publishes data and index together. A run that dies before that leaves
the published version untouched, a batch that is applied again under its ``batch_id`` changes nothing, and of two writers
that start from one version the later to publish fails and can start again from what the other left.

The first batch, with no index to go by, moves its whole rows once: keys and ordering columns alone settle in which
partition each key lives and how many copies it has, whole rows go to the partitions that they name, and of a key with
copies in several only the winner stays.

The index (key and partition) is dealt into buckets by a hash of the key; a batch reads the buckets its keys fall into.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NO_PARTITION = "__none__"
MOST_INDEX_PARTS = 16  # a bucket of the index in more pieces is rewritten as one
TASK_ROWS = 25_000, 200_000  # rows that a task folds: fewer are not worth a task, more do not fit its memory for sure


class ConcurrentWrite(RuntimeError):
    """Another writer has published the version that this one was about to."""


def _marks(df: DataFrame, order: list[Column | str], rest: list[str], total_order: bool) -> list[Column]:
    """What rows are ordered by: ``order``, then a hash of the columns ``rest`` unless there are no ties."""
    marks = [F.col(o) if isinstance(o, str) else o.alias(f"_o{i}") for i, o in enumerate(order)]
    hashed = [c for c in rest if c not in _loose(df, rest)]
    return marks if total_order or not hashed else [*marks, F.xxhash64(*hashed).alias("_tie")]


def _loose(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns whose values have no order."""
    return [c for c in columns if df.schema[c].dataType.typeName() in ("map", "variant")]


def _keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def fold(df: DataFrame, keys: list[str], order: list[Column | str], copies: Column, extra: list[str] | None = None, total_order: bool = False, known: str | None = None) -> DataFrame:
    """One row per key: the row greatest by ``order`` (NULL lowest) and ``n_copies``.

    An algebraic maximum, combined before the shuffle: a key with a third of all rows sends one row per map task. Rows in
    which a key is NULL cannot be told apart from others and are dropped. Columns named in ``order`` stand in the ordering
    only and every other column behind it, so that each travels once. Full ties are broken by a hash of all columns, or left
    out of account where ``total_order`` says that there are none. A row whose column ``known`` is not NULL is no copy: it says
    how many copies its key has, and with 0 that the key is not to come out.
    """
    extra = extra or []
    rest = [c for c in df.columns if c not in (*keys, *extra, "n_copies", known)]
    named = [o for o in order if isinstance(o, str)]
    marks = _marks(df, order, rest, total_order)
    n_copies = F.sum(copies)
    if known:
        marks.insert(0, F.col(known).isNull().alias("_copy"))
        n_copies = F.coalesce(F.max(known), n_copies)
    if _loose(df, rest):
        best = F.max_by(F.struct(*rest), F.struct(*[m.alias(f"_m{i}") for i, m in enumerate(marks)]))
    else:
        best = F.max(F.struct(*marks, *[c for c in rest if c not in named]))
    out = _keyed(df, keys).groupBy(*extra, *keys).agg(best.alias("_best"), n_copies.cast("long").alias("n_copies"))
    if known:
        out = out.filter(F.col("n_copies") > 0)
    return out.select(*keys, *extra, *[F.col("_best")[c].alias(c) for c in rest], "n_copies")


@dataclass
class MessageStore:
    """One winner per key under ``path``; ``partition`` names the column whose first seen value places a key for good.

    ``order`` and ``total_order`` are those of ``fold``. ``buckets`` is the number of parts of the index, fixed when the
    store is made; ``rows_per_file`` at most about what a task writes of one partition.
    """

    spark: SparkSession
    path: str
    keys: list[str]
    order: list[Column | str]
    partition: str
    total_order: bool = False
    buckets: int = 64
    rows_per_file: int = 1_000_000
    _manifest: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        self._conf = self.spark._jsc.hadoopConfiguration()
        self._manifest = {"version": 0, "buckets": self.buckets, "parts": {}, "index": {}, "batches": [], "retired": []}
        folder = self._path("_manifest")
        fs = folder.getFileSystem(self._conf)
        if fs.exists(folder):
            names = sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json"))
            if names:
                stream = fs.open(self._path(f"_manifest/{names[-1]}"))
                self._manifest = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
                stream.close()
        self.buckets = self._manifest["buckets"]

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _publish(self, **changes) -> None:
        """Write the next manifest under its number, which only one writer can do, and drop what the last but one retired."""
        manifest = self._manifest | {"version": self._manifest["version"] + 1} | changes
        jvm, name = self.spark._jvm, f"_manifest/{manifest['version']:010d}.json"
        target, temporary = self._path(name), self._path(f"_manifest/.{manifest['version']}-{jvm.java.util.UUID.randomUUID()}")
        fs = target.getFileSystem(self._conf)
        stream = fs.create(temporary, True)
        stream.write(json.dumps(manifest).encode())
        stream.close()
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf).rename(temporary, target, none)
        except Exception as e:
            if not fs.exists(target):
                raise
            fs.delete(temporary, False)
            raise ConcurrentWrite(f"version {manifest['version']} of {self.path} is already there") from e
        for old in self._manifest["retired"]:  # readers of the version before this one are done with those
            fs.delete(self._path(old), True)
        self._manifest = manifest

    def _read_parts(self, parts: list[str], schema=None) -> DataFrame | None:
        folders = [f"{self.path}/data/{self._manifest['parts'][p]}/_part={p}" for p in parts if p in self._manifest["parts"]]
        if not folders:
            return None
        reader = self.spark.read.option("basePath", f"{self.path}/data")
        return (reader if schema is None else reader.schema(schema)).parquet(*folders)

    def read(self) -> DataFrame:
        """The published winners with ``n_copies``, the number of stored deliveries of each."""
        if not self._manifest["parts"]:
            raise ValueError("the store is empty: apply a batch first")
        return self._read_parts(sorted(self._manifest["parts"])).drop("_part", "_version")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _index(self, buckets: list[int], schema: str) -> DataFrame:
        """The index of some buckets: keys and ``_old``, the partition that holds each."""
        folders = [f"{self.path}/index/{label}/_bucket={b}" for b in buckets for label in self._manifest["index"].get(str(b), [])]
        return self.spark.read.schema(schema).parquet(*folders).withColumnRenamed("_part", "_old") if folders else self.spark.createDataFrame([], schema.replace("_part", "_old"))

    def apply(self, batch: DataFrame, batch_id: str) -> list[str]:
        """Merge a batch; returns the partitions rewritten. An empty batch publishes nothing new but its id."""
        if batch_id in self._manifest["batches"]:
            return []
        known, label = self._manifest["parts"], f"_version={self._manifest['version'] + 1}-{uuid.uuid4().hex[:8]}"  # no two writers share a folder
        batches = [*self._manifest["batches"], batch_id]
        own = F.coalesce(F.nullif(F.col(self.partition).cast("string"), F.lit("")), F.lit(NO_PARTITION))
        keyed, stage = _keyed(batch, self.keys), f"{self.path}/stage/{label}"
        schema = ", ".join(f"`{k}` {batch.schema[k].dataType.simpleString()}" for k in self.keys) + ", _part string"
        out, retired, indexed = f"{self.path}/data/{label}", [f"stage/{label}"], dict(self._manifest["index"])
        touched = sorted(r[0] for r in keyed.select(self._bucket().alias("b")).distinct().collect())  # one number per bucket at most
        if not touched:
            self._publish(batches=batches, retired=[])
            return []
        if not known:
            self._first(keyed, own, stage).write.mode("overwrite").partitionBy("_part").parquet(out)
            new_keys = self.spark.read.schema(schema).parquet(out)
        else:
            incoming = fold(batch, self.keys, self.order, F.lit(1), total_order=self.total_order)
            # The fold leaves candidates spread by key, so only the narrow index is shuffled to meet them.
            incoming.join(self._index(touched, schema), self.keys, "left").withColumn("_part", F.coalesce("_old", own)).write.mode("overwrite").parquet(stage)
            staged = self.spark.read.parquet(stage)
            new_keys = staged.filter(F.col("_old").isNull()).select(*self.keys, "_part")
            crowded = [b for b in touched if len(indexed.get(str(b), [])) >= MOST_INDEX_PARTS]
            if crowded:
                new_keys = new_keys.unionByName(self._index(crowded, schema).withColumnRenamed("_old", "_part"))
                for b in crowded:
                    retired += [f"index/{old}/_bucket={b}" for old in indexed.pop(str(b))]
            merged = self._merged(staged.drop("_old"))
            merged.write.mode("overwrite").partitionBy("_part").parquet(out)
        new_keys.withColumn("_bucket", self._bucket()).hint("rebalance", F.col("_bucket")).write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/index/{label}")
        for b in self._written(f"index/{label}"):
            indexed[b] = [*indexed.get(b, []), label]
        written = self._written(f"data/{label}")
        retired += [f"data/{known[p]}/_part={p}" for p in written if p in known]
        self._publish(parts=known | {p: label for p in written}, index=indexed, batches=batches, retired=retired)
        return written

    def _merged(self, staged: DataFrame) -> DataFrame:
        """The affected partitions as they will be, spread by partition and, within large ones, by key: one shuffle both folds
        and writes."""
        counts = {r["_part"]: r["count"] for r in staged.groupBy("_part").count().collect()}  # one number per partition of the store
        old = self._read_parts(list(counts), staged.schema)
        if old is not None:
            for r in old.groupBy("_part").count().collect():
                counts[r["_part"]] += r["count"]
        both = staged if old is None else old.select(*staged.columns).unionByName(staged)
        return fold(self._spread(both, counts), self.keys, self.order, F.col("n_copies"), ["_part", "_task"], self.total_order).drop("_task")

    def _spread(self, rows: DataFrame, counts: dict[str, int]) -> DataFrame:
        """Rows dealt to tasks (``_task``) of about as many rows: large partitions are split by key, small ones share a task."""
        low, high = TASK_ROWS
        most = min(self.rows_per_file, high, max(low, -(-sum(counts.values()) // self.spark.sparkContext.defaultParallelism)))
        dealt, task, taken = [], 0, 0
        for part, n in sorted(counts.items()):
            if taken and taken + n > most:
                task, taken = task + 1, 0
            files = -(-n // most)
            dealt.append((part, files, task))
            task, taken = (task + files, 0) if files > 1 else (task, taken + n)
        spread = self.spark.createDataFrame(dealt, "_part string, _files long, _first long")
        numbered = rows.join(F.broadcast(spread), "_part").withColumn("_task", (F.col("_first") + F.pmod(F.xxhash64(*self.keys), "_files")).cast("int"))
        return numbered.drop("_files", "_first").repartitionById(task + bool(taken), F.col("_task"))

    def _first(self, batch: DataFrame, own: Column, stage: str) -> DataFrame:
        """The partitions of a store that was empty; whole rows are shuffled once, to the partition that each names.

        A narrow fold finds each key's home, the partition of its winner. Of keys with copies in several partitions a note
        goes to each: the number of all copies to the home, 0 to the others, which then drop theirs. Keys with more copies
        than a task should get (there are at most rows over that number of such keys) are combined before the shuffle.
        """
        marks = _marks(batch, self.order, [c for c in batch.columns if c not in (*self.keys, "n_copies")], self.total_order)
        homes = batch.groupBy(*self.keys).agg(F.max(F.struct(*marks, own.alias("_home")))["_home"].alias("_home"), F.count(F.lit(1)).alias("_known"), F.collect_set(own).alias("_parts"))
        crowd = F.col("_known") > min(self.rows_per_file, TASK_ROWS[1])
        homes.filter((F.size("_parts") > 1) | crowd).write.mode("overwrite").parquet(stage)
        noted = self.spark.read.schema(homes.schema).parquet(stage)
        rows, hot = batch.withColumn("n_copies", F.lit(1).cast("long")), noted.filter(crowd)
        hot_homes = {r["_home"]: r["count"] for r in hot.groupBy("_home").count().collect()}
        combined = None
        if hot_homes:
            these = F.broadcast(hot.select(*self.keys))
            combined = fold(rows.join(these, self.keys, "left_semi"), self.keys, self.order, F.col("n_copies"), total_order=self.total_order)
            rows = rows.join(these, self.keys, "left_anti")
        counts = Counter(hot_homes) + Counter({r["_part"]: r["count"] for r in rows.groupBy(own.alias("_part")).count().collect()})  # one number per partition of the store
        rows = (rows if combined is None else rows.unionByName(combined)).withColumn("_part", own)
        notes = noted.filter(~crowd).withColumn("_part", F.explode("_parts"))
        notes = notes.select(*self.keys, F.coalesce("_part", F.lit(NO_PARTITION)).alias("_part"), F.when(F.col("_part") == F.col("_home"), F.col("_known")).otherwise(F.lit(0)).alias("_known"))
        both = self._spread(rows.unionByName(notes, allowMissingColumns=True), counts)
        return fold(both, self.keys, self.order, F.col("n_copies"), ["_part", "_task"], self.total_order, "_known").drop("_task")

    def _written(self, folder: str) -> list[str]:
        """Values of the partition folders of a table just written."""
        path = self._path(folder)
        return sorted(s.getPath().getName().split("=", 1)[1] for s in path.getFileSystem(self._conf).listStatus(path) if s.isDirectory())
