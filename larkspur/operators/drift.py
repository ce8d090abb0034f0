"""JSON records whose fields come, go, change name and change type between files.

Each file's schema is a fingerprint over its (field, type set) states. Files of one chain (venue and record kind, in key
order) get version numbers that step up whenever the fingerprint changes. The fields of every version are registered once,
and the difference between a version and the one before it is the migration that its first file goes through; files with
the fingerprint of their predecessor need no comparison. Every file runs through the same chain of rename, cast and default
rules; which of them fired is recorded per file. Type sets are bit masks, so the per-file state is an algebraic aggregate
and records never gather.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larkspur.scratch import materialize

TYPE_BITS = {"string": 1, "number": 2, "boolean": 4, "object": 8, "array": 16}
KEY_PATTERN = r"^raw/([^/]+)/([0-9]{4}-[0-9]{2})/(posts|comments)-"


@dataclass(frozen=True)
class FieldRule:
    """A canonical field: its SQL type, the older names it is renamed from (in order), and a default for absent values."""

    name: str
    kind: str  # string, bigint, double or boolean
    renamed_from: tuple[str, ...] = ()
    default: object = None


RULES = (
    FieldRule("id", "string"),
    FieldRule("author", "string"),
    FieldRule("created_utc", "bigint"),
    FieldRule("score", "bigint"),
    FieldRule("upvote_ratio", "double"),
    FieldRule("num_comments", "bigint"),
    FieldRule("title", "string"),
    FieldRule("selftext", "string"),
    FieldRule("body", "string"),
    FieldRule("parent_id", "string"),
    FieldRule("link_id", "string"),
    FieldRule("is_self", "boolean"),
    FieldRule("over_18", "boolean", (), False),
    FieldRule("stickied", "boolean", (), False),
    FieldRule("edited", "boolean", (), False),
    FieldRule("distinguished", "string"),
    FieldRule("author_flair_text", "string"),
    FieldRule("link_flair_text", "string"),
    FieldRule("removed_by_category", "string", ("removal_reason",)),
    FieldRule("retrieved_on", "bigint", ("retrieved_utc",)),
)
NATURAL = {"string": "string", "bigint": "number", "double": "number", "boolean": "boolean"}
# Fields read through a document of their own; one that comes as text is parsed, which is a cast like any other.
NESTED = {"_meta": "object"}


def variant_type(value: Column) -> Column:
    """JSON type name of a variant: string, number, boolean, object, array; NULL for null and for no value."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "VOID", None).when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean")
        .when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").when(kind.isNotNull(), "number")
    )


def parsed(raw: DataFrame) -> DataFrame:
    """``file_key, line_no, doc``; ``doc`` is NULL for a line that is no JSON. Rows without file_key are dropped."""
    return raw.filter(F.col("file_key").isNotNull()).select("file_key", "line_no", F.try_parse_json("record_json").alias("doc"))


def field_states(raw: DataFrame) -> DataFrame:
    """``file_key, field_name, bits``: which types a top-level field has in a file (0: present as null only)."""
    docs = parsed(raw).filter(F.schema_of_variant("doc").startswith("OBJECT")).select("file_key", "doc")
    fields = raw.sparkSession.sql("SELECT file_key, f.key AS field_name, f.value AS value FROM {docs}, LATERAL variant_explode(doc) AS f", docs=docs)
    kind = variant_type(F.col("value"))
    bit = F.coalesce(*[F.when(kind == t, F.lit(b)) for t, b in TYPE_BITS.items()], F.lit(0))
    return fields.groupBy("file_key", "field_name").agg(F.bit_or(bit).alias("bits"))


def file_chain(raw: DataFrame) -> DataFrame:
    """``file_key, venue, kind, prev_file, next_file`` in key order per venue and kind; other keys are in no chain."""
    files = raw.select("file_key").distinct().filter(F.col("file_key").rlike(KEY_PATTERN))
    files = files.select("file_key", F.regexp_extract("file_key", KEY_PATTERN, 1).alias("venue"), F.regexp_extract("file_key", KEY_PATTERN, 3).alias("kind"))
    w = Window.partitionBy("venue", "kind").orderBy("file_key")
    return files.withColumns({"prev_file": F.lag("file_key").over(w), "next_file": F.lead("file_key").over(w)})


def state_text(bits: Column) -> Column:
    """A state as text: ``absent``, or the sorted type names joined by ``+`` (empty for a field present as null only)."""
    names = F.concat_ws("+", *[F.when(bits.bitwiseAND(b) != 0, F.lit(t)) for t, b in sorted(TYPE_BITS.items())])
    return F.when(bits.isNull(), "absent").otherwise(names)


def fingerprints(states: DataFrame, chain: DataFrame) -> DataFrame:
    """``file_key, venue, kind, prev_file, fingerprint, version, starts`` of every file of a chain.

    ``starts`` marks the first file of a version. Per-file field lists are bounded by the fields of a file, not by its
    records; a file without a readable record has the fingerprint of no fields.
    """
    text = F.concat_ws(":", "field_name", state_text(F.col("bits")))
    marked = states.groupBy("file_key").agg(F.array_join(F.array_sort(F.collect_list(text)), "\n").alias("_states"))
    files = chain.join(marked, "file_key", "left").withColumn("fingerprint", F.sha2(F.coalesce("_states", F.lit("")), 256))
    w = Window.partitionBy("venue", "kind").orderBy("file_key")
    starts = ~F.lag("fingerprint").over(w).eqNullSafe(F.col("fingerprint"))
    return files.withColumn("starts", starts).select("file_key", "venue", "kind", "prev_file", "fingerprint", F.sum(F.col("starts").cast("int")).over(w).alias("version"), "starts")


def registry(states: DataFrame, files: DataFrame) -> DataFrame:
    """``venue, kind, version, field_name, bits``: the fields of each version, as its first file shows them."""
    return states.join(files.filter("starts").select("file_key", "venue", "kind", "version"), "file_key").drop("file_key")


def migrations(registered: DataFrame) -> DataFrame:
    """``venue, kind, version, field_name, before, after``: what turns the version before into each version (NULL: absent)."""
    none = F.lit(None).cast("int")
    own = registered.select("venue", "kind", "version", "field_name", none.alias("before"), F.col("bits").alias("after"))
    handed = registered.select("venue", "kind", (F.col("version") + 1).alias("version"), "field_name", F.col("bits").alias("before"), none.alias("after"))
    both = own.unionByName(handed).groupBy("venue", "kind", "version", "field_name").agg(F.max("before").alias("before"), F.max("after").alias("after"))
    return both.filter(~F.col("before").eqNullSafe(F.col("after")))


def field_changes(raw: DataFrame) -> DataFrame:
    """``file_key, field_name, before, after``: fields whose state differs from the preceding file of the chain.

    These are the migrations, each at the first file of its version. The first file of a chain has no changes. A file
    without records has no row in ``raw`` and is no file. An empty table gives no rows.
    """
    states = materialize(field_states(raw), "field-states")
    files = materialize(fingerprints(states, file_chain(raw)), "schema-versions")
    starting = files.filter(F.col("starts") & F.col("prev_file").isNotNull()).select("file_key", "venue", "kind", "version")
    return migrations(registry(states, files)).join(starting, ["venue", "kind", "version"]).select("file_key", "field_name", "before", "after")


def migration_steps(raw: DataFrame, rules: tuple[FieldRule, ...] = RULES) -> DataFrame:
    """Every change with its kind: ``file_key, field_name, step, before, after``.

    ``renamed`` where an older name of a rule gives way to a newer one (both rows carry it), else ``added``, ``removed``
    or ``retyped``.
    """
    older = {old: rule.name for rule in rules for old in rule.renamed_from}
    canonical = F.coalesce(*[F.when(F.col("field_name") == old, F.lit(new)) for old, new in older.items()], F.col("field_name"))
    moved = field_changes(raw).withColumn("canonical", canonical)
    gone, came = F.col("after").isNull(), F.col("before").isNull()
    pair = Window.partitionBy("file_key", "canonical")
    swap = F.max(gone.cast("int")).over(pair) + F.max(came.cast("int")).over(pair) == 2
    step = F.when(swap & (gone | came), "renamed").when(gone, "removed").when(came, "added").otherwise("retyped")
    return moved.select("file_key", "field_name", step.alias("step"), state_text(F.col("before")).alias("before"), state_text(F.col("after")).alias("after"))


def schema_versions(raw: DataFrame) -> DataFrame:
    """``file_key, venue, kind, fingerprint, version, steps``: steps are the rules that fire on the file.

    A file without a readable record takes no part. Per-file field lists are bounded by the fields of a file.
    """
    natural = {r.name: NATURAL[r.kind] for r in RULES}
    older = {old: r for r in RULES for old in r.renamed_from}
    rename = F.coalesce(*[F.when(F.col("field_name") == o, F.lit(f"rename:{o}>{r.name}")) for o, r in older.items()])
    kind_of = natural | {o: NATURAL[r.kind] for o, r in older.items()} | NESTED
    cast = F.coalesce(*[F.when((F.col("field_name") == n) & (F.col("bits").bitwiseAND(31 - TYPE_BITS[t]) != 0), F.lit(f"cast:{n}")) for n, t in kind_of.items()])
    states = materialize(field_states(raw), "field-states")
    fired = states.groupBy("file_key").agg(F.array_sort(F.concat(F.collect_list(rename), F.collect_list(cast))).alias("_steps"), F.collect_list("field_name").alias("_names"))
    default = F.concat(*[F.when(F.array_contains("_names", r.name), F.array().cast("array<string>")).otherwise(F.array(F.lit(f"default:{r.name}"))) for r in RULES if r.default is not None])
    files = fingerprints(states, file_chain(raw).join(states.select("file_key").distinct(), "file_key", "left_semi"))
    return files.join(fired, "file_key").select("file_key", "venue", "kind", "fingerprint", "version", F.array_join(F.concat("_steps", default), ";").alias("steps"))


def _value(rule: FieldRule) -> Column:
    """The first non-null value along the rename chain, cast to the canonical type; what cannot be cast is NULL."""
    picks = []
    for name in (rule.name, *rule.renamed_from):
        path = f"$['{name}']"
        text = F.try_variant_get("doc", path, "string")
        kind = variant_type(F.try_variant_get("doc", path, "variant"))
        if rule.kind == "string":
            picks.append(F.when(kind.isin("string", "number"), text))
        elif rule.kind == "boolean":
            number = F.try_variant_get("doc", path, "double") > 0
            picks.append(F.when(kind == "boolean", F.try_variant_get("doc", path, "boolean")).when(kind == "number", number))
        else:
            number = F.when(kind.isin("string", "number"), text)
            whole = [number.try_cast("bigint")] if rule.kind == "bigint" else []  # keeps digits that a double would lose
            picks.append(F.coalesce(*whole, number.try_cast("double").try_cast(rule.kind)))
    value = F.coalesce(*picks)
    return value if rule.default is None else F.coalesce(value, F.lit(rule.default))


def unruled_fields(raw: DataFrame, rules: tuple[FieldRule, ...] = RULES) -> DataFrame:
    """``file_key, line_no, field_name, value``: what no rule of the consistent table names, as VARIANT, so that with
    ``consistent_table`` nothing of a record is lost. ``_meta`` is listed whole."""
    docs = parsed(raw).filter(F.schema_of_variant("doc").startswith("OBJECT"))
    fields = raw.sparkSession.sql("SELECT file_key, line_no, f.key AS field_name, f.value AS value FROM {docs}, LATERAL variant_explode(doc) AS f", docs=docs)
    return fields.filter(~F.col("field_name").isin([n for r in rules for n in (r.name, *r.renamed_from)]))


def consistent_table(raw: DataFrame, rules: tuple[FieldRule, ...] = RULES) -> DataFrame:
    """All records in one schema, one row per line, whatever fields its file had: a single narrow pass, no shuffle.

    Numeric text is cast, numbers cut toward zero for ``bigint``, ``edited`` times become true, and ``_meta``, an object or
    the text of one, gives ``retrieved_2nd_on`` and ``is_edited``. Unreadable lines keep their key with every field NULL or
    default. Other fields come out of ``unruled_fields`` (``migration_steps`` reports them).
    """
    meta = F.try_parse_json(F.try_variant_get("doc", "$._meta", "string"))  # an object's string is its text
    stamp = F.try_variant_get(meta, "$.retrieved_2nd_on", "string").try_cast("double").try_cast("bigint")
    is_boolean = F.schema_of_variant(F.try_variant_get(meta, "$.is_edited", "variant")) == "BOOLEAN"
    edited = F.when(is_boolean, F.try_variant_get(meta, "$.is_edited", "boolean")).otherwise(F.try_variant_get(meta, "$.is_edited", "double") > 0)
    return parsed(raw).select("file_key", "line_no", *[_value(r).alias(r.name) for r in rules], stamp.alias("retrieved_2nd_on"), edited.alias("is_edited"))
