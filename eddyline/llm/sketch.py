"""Operator 2, document fingerprints as threshold-scaled sketches.

A document's shingles (``WORDS`` lower-cased words) are hashed to 64 bits and
every distinct hash below a fixed fraction of the range is retained.  The
fraction is the same for all documents, so the sketch of a long text is longer,
the sketch of a union is the union of sketches, and the share of one sketch's
hashes that another holds estimates containment between texts of very unequal
length.  A text with fewer than ``FLOOR`` hashes below the threshold keeps its
``FLOOR`` smallest ones; its own threshold is then the largest hash it keeps (the
whole range if it keeps all), and two sketches are compared, or merged, below
the smaller of their thresholds.  So short texts are compared with each other by
all their shingles, and with a long text by those below the long one's threshold:
about 1/8 of them, so a containment rests on few hashes there, and is null
(unknown) if there is none.

The sketch is a string of hashes, 16 hex digits each, ascending; a leading
``*`` marks one that holds every shingle of its text, ``+`` one cut at its
largest hash.  Equal texts have equal sketches.

Nulls: a null text counts as empty; a text without words has the sketch ``*``,
which has likeness 1 to its equal and 0 to any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline.llm.common import in_slices, once_per_worker, word_blocks

WORDS = 5               # words of a shingle
FRACTION = 1 / 8        # of the hash range that is retained
FLOOR = 64              # hashes that a short text keeps at least
FULL = (1 << 64) - 1
TABLE_WORDS = 500_000   # word hashes a worker keeps; then it starts anew
ODD = np.uint64(0x9E3779B97F4A7C15)    # multiplier of the shingle polynomial


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a polynomial hash (xor-shift and multiply, twice)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hash_blocks(raw: bytes, words: int) -> Iterator[np.ndarray]:
    """Hashes of all word shingles of the lower-cased text, block by block."""
    table = once_per_worker("sketch words", _WordHashes)
    if len(table) > TABLE_WORDS:
        table.clear()
    for block in word_blocks(raw.decode("utf-8", "replace").lower().encode(), words):
        w = np.fromiter(map(table.__getitem__, block), dtype=np.uint64, count=len(block))
        k = min(words, len(w))
        h = np.zeros(len(w) - k + 1, dtype=np.uint64)
        for i in range(k):
            h = h * ODD + w[i:len(w) - k + 1 + i]
        yield _mix(h + np.uint64(k))


class Sketch:
    """Retained hashes, ascending, and the threshold they are complete below (inclusive)."""

    __slots__ = ("hashes", "limit")

    def __init__(self, hashes: np.ndarray, limit: int) -> None:
        self.hashes, self.limit = hashes, limit

    @classmethod
    def of(cls, raw: bytes, words: int = WORDS, fraction: float = FRACTION, floor: int = FLOOR) -> Sketch:
        cut = int(fraction * 2.0 ** 64) - 1 if fraction < 1 else FULL
        low, small, more = [], np.zeros(0, dtype=np.uint64), False
        for h in hash_blocks(raw, words):
            low.append(h[h <= np.uint64(cut)])
            small = np.unique(np.concatenate((small, h)))
            more |= len(small) > floor
            small = small[:floor]
        kept = np.unique(np.concatenate(low)) if low else small
        if len(kept) >= floor:
            return cls(kept, cut)
        if not more:
            return cls(small, FULL)
        return cls(small, int(small[-1]))

    def below(self, limit: int) -> np.ndarray:
        return self.hashes[:np.searchsorted(self.hashes, np.uint64(limit), side="right")]

    def merge(self, other: Sketch) -> Sketch:
        """The sketch of the union of both texts' shingles."""
        limit = min(self.limit, other.limit)
        return Sketch(np.union1d(self.below(limit), other.below(limit)), limit)

    def containment(self, other: Sketch) -> float | None:
        """Estimated share of this text's shingles that the other text has; None
        if this sketch holds no hash below the common threshold."""
        if self.limit == FULL and not len(self.hashes) or other.limit == FULL and not len(other.hashes):
            return float(len(self.hashes) == len(other.hashes))
        limit = min(self.limit, other.limit)
        a = self.below(limit)
        if not len(a):
            return None
        return len(np.intersect1d(a, other.below(limit), assume_unique=True)) / len(a)

    def likeness(self, other: Sketch) -> float:
        """Estimated Jaccard similarity of the two texts' shingles."""
        limit = min(self.limit, other.limit)
        a, b = self.below(limit), other.below(limit)
        both = len(np.intersect1d(a, b, assume_unique=True))
        union = len(a) + len(b) - both
        return both / union if union else float(len(self.hashes) == len(other.hashes))

    def text(self, fraction: float = FRACTION) -> str:
        mark = "*" if self.limit == FULL else "" if self.limit == int(fraction * 2.0 ** 64) - 1 else "+"
        return mark + self.hashes.astype(">u8").tobytes().hex()

    @classmethod
    def parse(cls, s: str, fraction: float = FRACTION) -> Sketch:
        mark = s[:1] if s[:1] in ("*", "+") else ""
        h = np.frombuffer(bytes.fromhex(s[len(mark):]), dtype=">u8").astype(np.uint64)
        cut = int(fraction * 2.0 ** 64) - 1 if fraction < 1 else FULL
        return cls(h, FULL if mark == "*" else int(h[-1]) if mark else cut)


def sketch_column(text: str | Column, words: int = WORDS, fraction: float = FRACTION,
                  floor: int = FLOOR) -> Column:
    """The sketch string of a text column."""
    @F.arrow_udf(T.StringType())
    def f(col: pa.Array) -> pa.Array:
        return in_slices(col.cast(pa.binary()), lambda x: Sketch.of(x or b"", words, fraction, floor).text(fraction),
                         pa.string())
    return f(F.col(text) if isinstance(text, str) else text)


def containment_column(a: str, b: str, fraction: float = FRACTION) -> Column:
    """Containment of sketch ``a`` in sketch ``b``."""
    @F.arrow_udf(T.DoubleType())
    def f(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([Sketch.parse(p, fraction).containment(Sketch.parse(q, fraction))
                         for p, q in zip(x.to_pylist(), y.to_pylist())], pa.float64())
    return f(F.col(a), F.col(b))


def likeness_column(a: str, b: str, fraction: float = FRACTION) -> Column:
    """Jaccard similarity estimated from two sketches."""
    @F.arrow_udf(T.DoubleType())
    def f(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([Sketch.parse(p, fraction).likeness(Sketch.parse(q, fraction))
                         for p, q in zip(x.to_pylist(), y.to_pylist())], pa.float64())
    return f(F.col(a), F.col(b))


def fingerprint_documents(docs: DataFrame, text_col: str = "text", out_col: str = "fingerprint",
                          words: int = WORDS, fraction: float = FRACTION) -> DataFrame:
    """``docs`` with the sketch of each text."""
    return docs.withColumn(out_col, sketch_column(F.col(f"`{text_col}`"), words, fraction))


# ---- the probe of the registered query: every text beside an edited text ----

PART_ROWS = 4096        # rows of a range of ids, about
MAX_PARTS = 50_000      # ranges of ids; beyond, ranges grow (they are sorted on disk)
EDIT_OUT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
            "edited_fingerprint string, near_edited double, near_next double, "
            "contained_edited double, contained_next double")


def in_id_ranges(docs: DataFrame, id_col: str, text_col: str, part_rows: int = PART_ROWS) -> DataFrame:
    """``part, guest, doc_id, raw`` for a pass in descending id order.

    Ids are cut into ranges at approximate quantiles; part 0 holds the largest
    ids.  Every range also gets, as ``guest``, the rows of the next lower
    range's largest id (the last range those of the largest id of all), so each
    range holds the successor of all its rows.  The texts are shuffled once; the
    driver only sees two ids per range.  A null id sorts after all others.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                    F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("raw"))
    n = docs.count()
    slots = spark.sparkContext.defaultParallelism
    parts = min(MAX_PARTS, max(1, -(-n // part_rows), min(slots, -(-n // 64))))
    cuts: list[int] = []
    if parts > 1:
        share = [(i + 1) / parts for i in range(parts - 1)]
        got = d.agg(F.percentile_approx("doc_id", F.lit(share), F.lit(20 * parts))).first()[0]
        cuts = sorted(set(got or []))
    place = _places(cuts)
    ids = d.select(F.col("doc_id"), place("doc_id").alias("part"))
    top = {r["part"]: r["top"] for r in
           ids.groupBy("part").agg(F.max("doc_id").alias("top")).collect()}
    both = _places(cuts, top)
    at = F.col("at")
    return (d.withColumn("at", F.explode(both("doc_id")))
            .select((F.abs(at) - 1).alias("part"), (at < 0).alias("guest"), "doc_id", "raw")
            .repartitionById(max(len(top), 1), F.col("part")))


def _places(cuts: list[int], top: dict[int, int | None] | None = None):
    """Without ``top``: the range of each id.  With it: ``[range + 1]``, and for
    a range's largest id also ``-(range + 1)`` of the range it follows."""
    order = sorted(top or {})
    before = {p: order[i - 1] for i, p in enumerate(order)}
    kind = T.IntegerType() if top is None else T.ArrayType(T.IntegerType())

    @F.arrow_udf(kind)
    def f(col: pa.Array) -> pa.Array:
        ids = col.to_pylist()
        edge = np.array(cuts, dtype=np.int64)
        # Range 0 holds the ids above the last cut; null ids are in the last range.
        known = np.array([0 if i is None else i for i in ids], dtype=np.int64)
        part = len(edge) - np.searchsorted(edge, known, side="left")
        part = [len(edge) if i is None else int(p) for i, p in zip(ids, part)]
        if top is None:
            return pa.array(part, pa.int32())
        return pa.array([[p + 1, -before[p] - 1] if i == top[p] else [p + 1]
                         for i, p in zip(ids, part)], pa.list_(pa.int32()))
    return f


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by the first as
    many (or all) of ``following``."""
    k = len(text) // 2
    return text[:len(text) - k] + following[:k]


def small_slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[tuple]:
    """The rows of all batches; only a few are Python objects at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield from zip(*(c.to_pylist() for c in b.slice(at, rows).columns))


def compare_with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        words: int = WORDS, fraction: float = FRACTION,
                        part_rows: int = PART_ROWS) -> DataFrame:
    """Per document: its sketch, that of its edited text, the likeness
    (estimated Jaccard similarity) to the edited and the following text, and
    the containment in them.  The following document is the next in descending
    id order, after the last the first; rows of one id follow each other in the
    byte order of their texts."""
    rows = in_id_ranges(docs, id_col, text_col, part_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        last = None       # (part, id, text, sketch) waiting for its successor

        def result(prev, nxt, sk):
            _, i, raw, s = prev
            text = raw.decode()
            new = edited(text, nxt.decode()).encode()
            e = Sketch.of(new, words, fraction)
            out.append((i, len(text), hashlib.sha256(new).hexdigest(), s.text(fraction), e.text(fraction),
                        s.likeness(e), s.likeness(sk), s.containment(e), s.containment(sk)))

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        waiting = False
        for part, guest, i, raw in small_slices(batches):
            if last is not None and part != last[0]:
                last, waiting = None, False
            if guest and not waiting:
                continue            # a further row of the guest id
            s = Sketch.of(raw, words, fraction)
            if waiting:
                result(last, raw, s)
            last, waiting = (part, i, raw, s), not guest
            if len(out) >= 256:
                yield flush()
        if out:
            yield flush()

    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 4]
    names = [c.split()[0] for c in EDIT_OUT.split(", ")]
    return (rows.sortWithinPartitions("part", "guest", F.desc_nulls_last("doc_id"), "raw")
            .mapInArrow(run, EDIT_OUT))
