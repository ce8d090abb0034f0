"""Long spans that stand verbatim in more than one document, by relative parsing against indexed reference blocks.

1. Routing: of every ``length - anchor + 1`` successive ``anchor``-grams the one of least hash is an anchor (winnowing), so
   any span of ``length`` characters holds one, and equal spans hold the same one. Text further than a span from every
   anchor of two documents can share nothing; what is left are the segments.
2. Reference blocks: segments are dealt by hash into blocks of about ``block_chars`` characters. A block's index is the
   sorted list of its ``length``-grams. A segment is parsed against every block that holds one of its anchors; no other
   block can give it a factor of ``length``.
3. Relative parse: a factor begins where the gram at hand stands in the block and some source there did not also hold the
   character before; each such source is extended to its longest match, and compared with the text character by character.
   Looking back over the character before is the check at the boundary: a greedy factor that ends inside a longer
   passage of another source does not hide that source.
4. ``factors`` keeps of these, from left to right, the longest at the first character not yet covered; ``shared_spans`` and
   ``shared_portion`` join them up; ``sharing_pairs`` names the documents at both ends of each.

Within a block a factor is kept only if no other one of the same segment contains it, so what leaves a task for spans and
portions grows with the text and not with the number of sources.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larkspur.scratch import materialize

LENGTH, ANCHOR = 150, 75
SEGMENT = 1 << 20  # characters hashed at once
MOST_SEGMENT = 1 << 16  # longer segments are cut, with an overlap of one span
BLOCK_CHARS = 1 << 21
VISITS = 8  # a block is visited by at most about so many times its own size per task
SEPARATORS = (0x110000, 0x110001)  # no code points: nothing matches across them
# Odd multipliers of the two rolling hashes and the constants of a 64-bit finalizer.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` modulo 2^64 and their inverses, at least ``n`` of each."""
    held = _powers.get(base)
    if held is None or len(held[0]) < n:
        size = max(1 << 16, 1 << int(n).bit_length())
        inverse = pow(base, -1, 1 << 64)
        rows = []
        for b in (base, inverse):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            rows.append(np.cumprod(x, dtype=np.uint64))
        held = _powers[base] = (rows[0], rows[1])
    return held


def gram_hashes(codes: np.ndarray, k: int, base: int) -> np.ndarray:
    """Hash of every ``k``-gram of a text's code points, the same wherever the gram stands."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, inverse = _power(base, len(codes))
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(scramble(codes.astype(np.uint64) + np.uint64(base & 0xFFFF)) * power[: len(codes)], out=total[1:])
    return scramble((total[k:] - total[:-k]) * inverse[:n])


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of the least hash of every ``window`` successive ones (of equal ones the first); distinct, ascending."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    place = np.uint64((1 << 24) - 1)
    least = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while span * 2 <= window:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:n], least[window - span : window - span + n])
    return np.unique(least & place).astype(np.int64)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def text_anchors(text: str, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of a text's anchors, in overlapping segments if it is very long."""
    codes, window = code_points(text), length - anchor + 1
    hashes, places = [], []
    for start in range(0, max(1, len(codes) - length + 1), SEGMENT):
        own = gram_hashes(codes[start : start + SEGMENT + length - 1], anchor, BASES[0])
        at = winnow(own, window)
        hashes.append(own[at])
        places.append(at + start)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return np.concatenate(hashes)[first], place


def _anchor_rows(length: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes, places = [], [], []
            for doc, text in zip(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()):
                h, p = text_anchors(text, length, anchor)
                ids.append(np.full(len(p), doc))
                hashes.append(h.view(np.int64))
                places.append(p)
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids), pa.int64()), pa.array(np.concatenate(hashes)), pa.array(np.concatenate(places))], names=["doc_id", "anchor", "pos"])

    return run


def cut_segments(n: int, at: np.ndarray, length: int, anchor: int, most: int) -> list[tuple[int, int]]:
    """``(start, end)`` of the stretches of a text of ``n`` characters within a span of the anchors at the ascending places ``at``."""
    low, high = np.maximum(at + anchor - length, 0), np.minimum(at + length, n)
    first = np.flatnonzero(np.concatenate([[True], low[1:] > high[:-1]]))
    out = []
    for a, b in zip(low[first], high[np.append(first[1:] - 1, len(at) - 1)]):
        for start in range(int(a), max(int(a) + 1, int(b) - length + 1), most - length + 1):
            out.append((start, min(start + most, int(b))))
    return out


def _segment_rows(length: int, anchor: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, marks in zip(*(batch.column(k).to_pylist() for k in range(3))):
                marks = sorted((m["pos"], m["anchor"]) for m in marks)
                at = np.array([m[0] for m in marks], np.int64)
                for start, end in cut_segments(len(text), at, length, anchor, most):
                    inside = range(int(np.searchsorted(at, start)), int(np.searchsorted(at, end - anchor, "right")))
                    rows.append({"doc_id": doc, "start": start, "text": text[start:end], "anchors": [marks[k][1] for k in inside]})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("text", pa.string()), ("anchors", pa.list_(pa.int64()))]))

    return run


def segments(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, most: int = MOST_SEGMENT) -> DataFrame:
    """``doc_id, start, text, anchors``: the stretches of each text around anchors that another document has too (stored)."""
    texts = docs.filter(F.length("text") >= length).select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.col("doc_id").isNotNull())
    anchors = materialize(texts.mapInArrow(_anchor_rows(length, anchor), "doc_id long, anchor long, pos long"), "anchors")
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("anchor")
    marks = anchors.join(shared, "anchor", "left_semi").groupBy("doc_id").agg(F.collect_list(F.struct("pos", "anchor")).alias("at"))  # at most one per character
    cut = texts.join(marks, "doc_id").select("doc_id", "text", "at").mapInArrow(_segment_rows(length, anchor, most), "doc_id long, start long, text string, anchors array<long>")
    return materialize(cut, "segments")


class Joined:
    """Segments (``doc, start, text`` and whatever follows) laid end to end between separators, with running hashes."""

    def __init__(self, rows: list[tuple], separator: int):
        wall = np.array([separator], np.uint32)
        parts = [wall]
        for row in rows:
            parts += [code_points(row[2]), wall]
        self.codes = np.concatenate(parts)
        sizes = np.array([len(p) for p in parts[1::2]], np.int64)
        self.begin = 1 + np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        self.end = self.begin + sizes
        self.doc, self.start = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
        power, self.inverse = _power(BASES[0], len(self.codes) + 1)
        self.total = np.zeros(len(self.codes) + 1, np.uint64)
        np.cumsum(scramble(self.codes.astype(np.uint64) + np.uint64(BASES[0] & 0xFFFF)) * power[: len(self.codes)], out=self.total[1:])

    def hashes(self, at: np.ndarray, size) -> np.ndarray:
        return scramble((self.total[at + size] - self.total[at]) * self.inverse[at])

    def places(self, size: int) -> np.ndarray:
        """Every position at which ``size`` characters lie within one segment."""
        count = np.maximum(self.end - self.begin - size + 1, 0)
        return np.repeat(self.begin - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())

    def segment(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, at, "right") - 1


class Block(Joined):
    """A reference block and its index: the hashes of all ``length``-grams in order, and of those one longer."""

    def __init__(self, rows: list[tuple], length: int):
        super().__init__(rows, SEPARATORS[0])
        self.length = length
        at = self.places(length)
        grams = self.hashes(at, length)
        order = np.argsort(grams, kind="stable")
        self.grams, self.at = grams[order], at[order]
        self.longer = np.sort(self.hashes(self.places(length + 1), length + 1))

    def parse(self, rows: list[tuple], most: int = 1 << 21) -> Iterator[tuple[np.ndarray, ...]]:
        """``row, start, end, source_doc, source_start`` of the longest matches with other documents, in pieces.

        A match begins where the character before differs and runs on as far as the texts agree; it has at least
        ``length`` characters. ``row`` is the place in ``rows``; ``start`` and ``source_start`` count from the texts' beginnings.
        """
        own = Joined(rows, SEPARATORS[1])
        at = own.places(self.length)
        grams = own.hashes(at, self.length)
        low, high = np.searchsorted(self.grams, grams, "left"), np.searchsorted(self.grams, grams, "right")
        hit = high > low
        at, low, high = at[hit], low[hit], high[hit]
        # Sources that also hold the character before have begun earlier; where there are no others, nothing begins.
        inner = at > own.begin[own.segment(at)]
        before = np.zeros(len(at), np.int64)
        wider = own.hashes(at[inner] - 1, self.length + 1)
        before[inner] = np.searchsorted(self.longer, wider, "right") - np.searchsorted(self.longer, wider, "left")
        begins = high - low > before
        at, low, size = at[begins], low[begins], (high - low)[begins]
        stop = np.cumsum(size)
        first = 0
        while first < len(at):
            last = max(first + 1, int(np.searchsorted(stop, (stop[first - 1] if first else 0) + most, "right")))
            n = size[first:last]
            p = np.repeat(at[first:last], n)
            q = self.at[np.repeat(low[first:last] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())]
            yield self._extended(own, p, q)
            first = last

    def _extended(self, own: Joined, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, ...]:
        mine, theirs = own.segment(p), self.segment(q)
        fresh = (own.codes[p - 1] != self.codes[q - 1]) & (own.doc[mine] != self.doc[theirs])
        p, q, mine, theirs = p[fresh], q[fresh], mine[fresh], theirs[fresh]
        good = np.full(len(p), self.length)
        over = np.minimum(own.end[mine] - p, self.end[theirs] - q) + 1  # the texts agree over good, not over this many
        while (far := over - good > 1).any():
            k = np.flatnonzero(far)
            middle = (good[k] + over[k]) // 2
            same = own.hashes(p[k], middle) == self.hashes(q[k], middle)
            good[k[same]] = middle[same]
            over[k[~same]] = middle[~same]
        real = self._agree(own, p, q, good)
        p, q, mine, theirs, good = p[real], q[real], mine[real], theirs[real], good[real]
        start = own.start[mine] + p - own.begin[mine]
        return mine, start, start + good, self.doc[theirs], self.start[theirs] + q - self.begin[theirs]

    def _agree(self, own: Joined, p: np.ndarray, q: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Compares the characters; a match of hashes only is shortened to what agrees and dropped below ``length``."""
        real, first, stop = np.ones(len(p), bool), 0, np.cumsum(size)
        while first < len(p):
            last = max(first + 1, int(np.searchsorted(stop, (stop[first - 1] if first else 0) + (1 << 22), "right")))
            n = size[first:last]
            along = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            same = own.codes[np.repeat(p[first:last], n) + along] == self.codes[np.repeat(q[first:last], n) + along]
            if not same.all():
                for k in np.unique(np.repeat(np.arange(first, last), n)[~same]):
                    size[k] = int(np.flatnonzero(own.codes[p[k] : p[k] + size[k]] != self.codes[q[k] : q[k] + size[k]])[0])
                    real[k] = size[k] >= self.length
            first = last
        return real


def uncontained(row: np.ndarray, start: np.ndarray, end: np.ndarray, doc: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Positions of the matches that no other one of the same row contains; of equal ones the least (doc, source)."""
    order = np.lexsort((source, doc, -end, start, row))
    reach = row[order] * (1 << 40) + end[order]
    top = np.maximum.accumulate(reach)
    return order[np.concatenate([[True], reach[1:] > top[:-1]])] if len(order) else order


def _parse_rows(length: int, pairs: bool):
    """Streams partitions sorted by (block, salt, visits): first a block's segments, then those that are parsed against it."""

    def flush(block: Block, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        home = np.array([h[3] for h in held])
        for row, start, end, doc, source in block.parse(held):
            me = np.array([h[0] for h in held], np.int64)[row]
            if pairs:
                once = ~home[row] | (me < doc)  # in its own block a pair is met from both sides
                both = np.unique(np.stack([np.minimum(me, doc)[once], np.maximum(me, doc)[once]]), axis=1)
                out = {"doc_a": both[0], "doc_b": both[1]}
            else:
                k = uncontained(row, start, end, doc, source)
                out = {"doc_id": me[k], "factor_start": start[k], "factor_end": end[k], "source_doc": doc[k], "source_start": source[k]}
            yield from pa.table(out).to_batches(max_chunksize=1 << 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block, rows, held, chars = None, None, [], [], 0
        for batch in batches:
            for b, salt, visits, home, doc, start, text in zip(*(batch.column(c).to_pylist() for c in ("block", "salt", "visits", "home", "doc_id", "start", "text"))):
                if (b, salt) != key:
                    if held:
                        yield from flush(block, held)
                    key, block, rows, held, chars = (b, salt), None, [], [], 0
                if not visits:
                    rows.append((doc, start, text))
                    continue
                if block is None:
                    block, rows = Block(rows, length), []
                held.append((doc, start, text, home))
                chars += len(text)
                if chars >= 1 << 20:
                    yield from flush(block, held)
                    held, chars = [], 0
        if held:
            yield from flush(block, held)

    return run


def parsed(docs: DataFrame, pairs: bool, length: int, anchor: int, block_chars: int) -> DataFrame:
    """Every segment parsed against the blocks that hold one of its anchors; rows as in ``_parse_rows``.

    For pairs a segment visits its own block and those after it, since both ends of a match are named; else all of them.
    """
    found = segments(docs, length, anchor)
    chars = found.agg(F.sum(F.length("text"))).collect()[0][0] or 0
    held = found.withColumn("own", F.pmod(F.xxhash64("doc_id", "start"), F.lit(max(1, -(-chars // block_chars)))))
    each = held.select("doc_id", "start", "own", F.explode("anchors").alias("anchor"))
    homes = each.select("anchor", F.col("own").alias("block")).distinct()
    calls = each.join(homes, "anchor")
    calls = (calls.filter("block >= own") if pairs else calls).select("doc_id", "start", "block").distinct()
    visitors = materialize(held.join(calls, ["doc_id", "start"]).select("block", (F.col("block") == F.col("own")).alias("home"), "doc_id", "start", "text"), "visitors")
    loads = visitors.groupBy("block").agg(F.ceil(F.sum(F.length("text")) / F.lit(VISITS * block_chars)).cast("long").alias("salts"))
    salted = visitors.join(loads, "block").select("block", F.pmod(F.xxhash64(F.lit(3), "doc_id", "start"), "salts").alias("salt"), F.lit(1).alias("visits"), "home", "doc_id", "start", "text")
    copies = held.select(F.col("own").alias("block"), "doc_id", "start", "text").join(loads, "block").select(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("visits"), F.lit(True).alias("home"), "doc_id", "start", "text"
    )
    ordered = copies.unionByName(salted).repartition("block", "salt").sortWithinPartitions("block", "salt", "visits")
    fields = "doc_a long, doc_b long" if pairs else "doc_id long, factor_start long, factor_end long, source_doc long, source_start long"
    return ordered.mapInArrow(_parse_rows(length, pairs), fields)


def sharing_pairs(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_a < doc_b``: distinct pairs of documents with a common substring of at least ``length`` code points.

    ``doc_id`` must be unique and integral. NULL and shorter texts share nothing; case, white space and punctuation
    count; a span repeated inside one document only is no case; an empty table gives no rows; other columns are never
    read. ``anchor`` must be below ``length``.
    """
    return parsed(docs, True, length, anchor, block_chars).distinct()


def _greedy(length: int):
    """Streams matches sorted by (doc_id, start, end descending, source): of those over the first uncovered gram the longest."""
    names = ("doc_id", "factor_start", "factor_end", "source_doc", "source_start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, gram, covered, doc = None, 0, -1, None
        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                if row[0] != doc:
                    out += [best] if best else []
                    best, covered, doc = None, -1, row[0]
                if best and row[1] > gram:
                    out.append(best)
                    best, covered = None, best[2] - length
                if row[2] - length <= covered:
                    continue
                if best is None:
                    best, gram = row, max(row[1], covered + 1)
                elif row[2] > best[2]:
                    best = row
            yield from _rows_of(out, names)
        yield from _rows_of([best] if best else [], names)

    return run


def _rows_of(rows: list[tuple], names: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=list(names))


def factors(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, factor_start, factor_end, source_doc, source_start``: the greedy parse of each document against all others.

    From left to right, the first ``length``-gram that stands elsewhere and is not yet covered is covered by the match over
    it that reaches furthest (of equal ones the one that begins first, then the least source), back to where it begins. So
    ``text[factor_start:factor_end]`` stands at ``source_start`` of ``source_doc``. Matches are cut where segments are
    (``MOST_SEGMENT``). Cases as in ``sharing_pairs``.
    """
    matches = parsed(docs, False, length, anchor, block_chars)
    ordered = matches.repartition("doc_id").sortWithinPartitions("doc_id", "factor_start", F.desc("factor_end"), "source_doc", "source_start")
    return ordered.mapInArrow(_greedy(length), "doc_id long, factor_start long, factor_end long, source_doc long, source_start long")


def shared_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, span_start, span_end``: maximal stretches, in code points, covered by factors; neighbours that touch are one.

    Every ``length``-gram of a factor stands in some other document (not always the same one for the whole span). Cases as
    in ``sharing_pairs``.
    """
    w = Window.partitionBy("doc_id").orderBy("factor_start", "factor_end")
    reach = F.max("factor_end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    begins = factors(docs, length, anchor, block_chars).withColumn("_new", F.coalesce(F.col("factor_start") > reach, F.lit(True)).cast("int"))
    runs = begins.withColumn("_run", F.sum("_new").over(w)).groupBy("doc_id", "_run").agg(F.min("factor_start").alias("span_start"), F.max("factor_end").alias("span_end"))
    return runs.drop("_run")


def shared_portion(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, n_chars, n_spans, shared_chars, shared_share`` for every document (0 for NULL and empty texts)."""
    per = shared_spans(docs, length, anchor, block_chars).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_spans"), F.sum(F.col("span_end") - F.col("span_start")).alias("shared_chars"))
    size = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("n_chars")).join(per, "doc_id", "left")
    share = F.coalesce(F.try_divide("shared_chars", "n_chars"), F.lit(0.0))
    return out.select("doc_id", "n_chars", F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("shared_chars", F.lit(0)).alias("shared_chars"), F.round(share, 6).alias("shared_share"))
