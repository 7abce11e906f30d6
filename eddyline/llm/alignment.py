"""Operator 13, alignment of two tokenizers by galloping intersection of ends.

A text is encoded by tokenizer A (byte-level BPE, with a space set before the text)
and by B (pieces with byte fallback, which sets that space itself).  The byte
offsets at which a token of both ends cut the tokens into groups; every A token and
B token of a group are linked.

* The shorter list of ends drives the search: from where the last end was found,
  exponential steps bracket the next one in the longer list and a binary search
  ends it; all ends of a list step at once.  The indices found in both
  lists slice the groups, and differences of those ranks are the overlap ranges.
* A single space between two characters that are no white space always ends a
  token of both, so a text is cut there and each cut piece, which repeats often, is aligned
  once per worker and kept in a bounded table; a document's groups are those of
  its pieces, in order.
* A pair of ids counts once in each document that holds it linked.  A task adds
  its documents' distinct pairs up and ships one row per pair (map-side), and each
  document keeps its distinct pairs and their numbers, written once.
* Counts are looked up from the documents' side.  Up to ``BROADCAST_PAIRS`` distinct
  pairs are broadcast after a check of their number; beyond it, documents' pairs
  are dealt to ranges of A ids, and the rows of a range to salted tasks, each with
  the counts of that range alone, and the partial sums of a document are added.

Nulls: a null or empty text, and one whose tokens of either side do not spell
the space and the text, has no tokens: zeros and an empty digest.  Rows of a null id
and repeated rows each keep their row and count as documents.  An empty table
gives no row.  Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.llm.bpe import MAX_TOKENIZER_BYTES, byte_symbols, share_tokenizer
from eddyline.llm.common import materialize, once_per_worker

TABLE_ENTRIES = 300_000        # pieces of each of a worker's two generations
TABLE_PIECE = 64               # longer ones are not kept
BROADCAST_PAIRS = 4_000_000    # distinct id pairs (8 bytes each) small enough to broadcast
HELD_PAIRS = 4_000_000         # pairs a task adds up before it hands them on
RANGES = 64                    # ranges of A ids beyond that
SALTS = 32                     # tasks of a range
CUT = re.compile(r"(?<=\S) (?=\S)")     # a cut that both tokenizers make
INNER = re.compile(r"[^\s\u2581](?:[^\u2581]*[^\s\u2581])?\Z").match  # a piece that can stand beside others

# Fixed value: the split rule of byte-level BPE vocabularies.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

UNCUT = (0, 0, 0, None, "")         # no piece by itself
NOTHING = ((), (), (), (), ())


def gallop(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The indices in ``a`` and in ``b`` (ascending, distinct) of their common
    values.  The shorter list drives: it is taken in blocks, and every value of a block
    searches from where the block before it ended, by steps of 1, 2, 4, ... until it
    is passed and then by halving between the last two steps."""
    if len(a) > len(b):
        ib, ia = gallop(b, a)
        return ia, ib
    if not len(a):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    n, start, found = len(b), 0, []
    for k in range(0, len(a), 2048):
        x = a[k:k + 2048]
        lo = np.full(len(x), start, dtype=np.int64)
        step = np.ones(len(x), dtype=np.int64)
        while True:                       # exponential: everyone not yet passed doubles
            go = (lo + step < n) & (b[np.minimum(lo + step, n - 1)] <= x)
            if not go.any():
                break
            lo = np.where(go, lo + step, lo)
            step = np.where(go, step << 1, step)
        hi = np.minimum(lo + step, n)
        while (wide := hi - lo > 1).any():  # binary, between the last two steps
            mid = (lo + hi) >> 1
            low = wide & (b[np.minimum(mid, n - 1)] <= x)
            lo = np.where(low, mid, lo)
            hi = np.where(wide & ~low, mid, hi)
        found.append(lo)
        start = int(lo[-1])
    at = np.concatenate(found)
    same = b[at] == a
    return np.nonzero(same)[0], at[same]


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the pieces met so far."""

    def __init__(self, a_text: str, b_model: bytes) -> None:
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(a_text)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        back = {c: i for i, c in enumerate(byte_symbols())}
        names = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for t, i in names.items():
            if all(c in back for c in t):
                self.a_bytes[i] = bytes(back[c] for c in t)
        self.encode_a = self._encoder(json.loads(a_text))
        self.b_bytes = [self._b_bytes(i) for i in range(self.b.get_piece_size())]
        self.a_text = list(map(str, range(len(self.a_bytes))))
        self.b_text = list(map(str, range(len(self.b_bytes))))
        self.a_size = np.array(list(map(len, self.a_bytes)), dtype=np.int64)
        self.b_size = np.array(list(map(len, self.b_bytes)), dtype=np.int64)
        self.radix = len(self.b_bytes)
        self.table: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}

    def _encoder(self, spec: dict):
        """The encoder of A without special tokens.  A byte-level vocabulary numbered in the order
        of its merges has the same result, several times faster, by ranks."""
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        vocab = model["vocab"]
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model.get("merges", [])]
        plain = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                 and not spec.get("normalizer") and not model.get("ignore_merges")
                 and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix"))
        special = {t["id"] for t in spec.get("added_tokens") or []}
        base = {i for i, x in enumerate(self.a_bytes) if len(x) == 1}
        if (plain and len(base) == 256 and merged == sorted(set(merged)) and min(merged) > max(base)
                and set(vocab.values()) == base | set(merged) | (special & set(vocab.values()))):
            import tiktoken
            ranks = {self.a_bytes[i]: i for i in [*sorted(base), *merged]}
            return tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        return lambda text: self.a.encode(text, add_special_tokens=False).ids

    def _b_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(self, text: str) -> tuple[list[int], np.ndarray, list[int], np.ndarray] | None:
        """Ids and end offsets of both sides; None if either does not spell the
        space and the text."""
        whole = (" " + text).encode()
        ids_a = self.encode_a(" " + text)
        ids_b = self.b.encode(text)
        if b"".join([self.a_bytes[i] for i in ids_a]) != whole or b"".join([self.b_bytes[i] for i in ids_b]) != whole:
            return None
        return ids_a, np.cumsum(self.a_size[ids_a]), ids_b, np.cumsum(self.b_size[ids_b])

    def pieces(self, texts: list[str]) -> Iterator[tuple | None]:
        """``n_a, n_b, n_groups, pair codes, groups as text`` of each piece, none if it
        cannot be spelt.  The pieces are encoded as one text, set apart by the spaces at which such
        pieces are cut."""
        made = self.tokens(" ".join(texts)) if all(map(INNER, texts)) else None
        if made is None:
            if len(texts) == 1:
                made = self.tokens(texts[0])
                if made is None:
                    yield None
                    return
            else:                          # some piece cannot stand beside others
                for t in texts:
                    yield from self.pieces([t])
                return
        ids_a, ends_a, ids_b, ends_b = made
        ia, ib = gallop(ends_a, ends_b)
        start_a, start_b = np.concatenate(([0], ia + 1)), np.concatenate(([0], ib + 1))
        n_a, n_b = np.diff(start_a), np.diff(start_b)          # ranks' differences: the groups' sizes
        links = n_a * n_b
        first = np.concatenate(([0], np.cumsum(links)))
        # Link t of a group of n_b B tokens joins A token t div n_b and B token t mod n_b.
        group = np.repeat(np.arange(len(links)), links)
        t = np.arange(first[-1]) - first[group]
        a = np.asarray(ids_a, dtype=np.uint64)[start_a[group] + t // n_b[group]]
        b = np.asarray(ids_b, dtype=np.uint64)[start_b[group] + t % n_b[group]]
        codes = (a * np.uint64(self.radix) + b).tobytes()
        text_a = list(map(self.a_text.__getitem__, ids_a))
        text_b = list(map(self.b_text.__getitem__, ids_b))
        spans = [f"{text_a[p]}|{text_b[q]}" if m == 1 == n else
                 ",".join(text_a[p:p + m]) + "|" + ",".join(text_b[q:q + n])
                 for p, q, m, n in zip(start_a.tolist(), start_b.tolist(), n_a.tolist(), n_b.tolist())]
        ends = np.cumsum(np.fromiter((len(t.encode()) + 1 for t in texts), np.int64, len(texts)))
        cut = np.concatenate(([0], np.searchsorted(ends_a[ia], ends) + 1))
        for lo, hi, k, m, x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), (8 * first[cut[:-1]]).tolist(),
                                      (8 * first[cut[1:]]).tolist(), np.diff(start_a[cut]).tolist(),
                                      np.diff(start_b[cut]).tolist()):
            yield x, y, hi - lo, codes[k:m], ";".join(spans[lo:hi])

    def _learn(self, new: set[str]) -> dict[str, tuple]:
        """Align new pieces; those worth it are kept, the others returned."""
        passing: dict[str, tuple] = {}
        older, plain = self.older, []
        for t in new:
            if t in older:
                self.table[t] = older[t]
            elif INNER(t):
                plain.append(t)
            else:
                (self.table if len(t) <= TABLE_PIECE else passing)[t] = UNCUT
        for some in batched(plain, 4096):
            for text, made in zip(some, self.pieces(list(some))):
                (self.table if len(text) <= TABLE_PIECE else passing)[text] = made or UNCUT
        return passing

    def _look_up(self, cuts: list[list[str]]) -> list[list[tuple]]:
        """The alignment of every piece of every text."""
        get = self.table.get
        found = [list(map(get, parts)) for parts in cuts]
        lacking = [i for i, made in enumerate(found) if None in made]
        passing = self._learn({p for i in lacking for p, m in zip(cuts[i], found[i]) if m is None})
        for i in lacking:
            found[i] = [passing[p] if p in passing else get(p) for p in cuts[i]]
        return found

    def _odd(self, text: str) -> list[tuple] | None:
        """The pieces of a text some of whose spaces stand beside other white space;
        None if it cannot be spelt."""
        parts = CUT.split(text)
        inner = [p for p in parts if INNER(p)]
        known = dict(zip(inner, self._look_up([inner])[0]))
        made = [known[p] if p in known else next(self.pieces([p])) for p in parts]
        return None if any(m is None or m[3] is None for m in made) else made

    def documents(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, np.ndarray, str]]:
        """``n_a, n_b, n_groups``, the pair code of every link, and the groups' digest of
        each text."""
        if len(self.table) > TABLE_ENTRIES:         # two generations: what is used again stays
            self.older, self.table = self.table, {}
        for text, made in zip(texts, self._look_up([t.split(" ") if t else [] for t in texts])):
            n_a, n_b, groups, codes, spans = zip(*made) if made else NOTHING
            if None in codes:
                made = self._odd(text)
                n_a, n_b, groups, codes, spans = zip(*made) if made else NOTHING
            if not codes:
                yield 0, 0, 0, np.empty(0, dtype=np.uint64), ""
                continue
            yield (sum(n_a), sum(n_b), sum(groups), np.frombuffer(b"".join(codes), dtype=np.uint64),
                   hashlib.sha256(";".join(spans).encode()).hexdigest())


def pack(codes: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending codes and their numbers, as compressed byte planes of the
    differences (most planes are zeros)."""
    step = np.diff(codes, prepend=np.uint64(0)).astype("<u8")
    plane = lambda x, size: np.ascontiguousarray(x.view(np.uint8).reshape(-1, size).T).tobytes()
    return zstandard.compress(plane(step, 8) + plane(times.astype("<u4"), 4), 1)


def unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(raw)
    n = len(raw) // 12
    plane = lambda part, size, kind: np.ascontiguousarray(
        np.frombuffer(part, np.uint8).reshape(size, n).T).view(kind).reshape(-1)
    return np.cumsum(plane(raw[:8 * n], 8, "<u8"), dtype=np.uint64), plane(raw[8 * n:], 4, "<u4").astype(np.int64)


def _add_up(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, at = np.unique(np.concatenate(codes), return_inverse=True)
    return every, np.bincount(at, weights=np.concatenate(counts), minlength=len(every)).astype(np.int64)


ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, code long, c long"


def _aligned(aligner):
    """Rows of documents (their distinct pairs packed) and, when a task is at its
    end or holds too many, rows of pairs and the number of documents that held them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner()
        codes: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        size = 0

        def rows(ids: pa.Array, out: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*out)) if out else [[]] * 6
            none = pa.nulls(len(out), pa.int64())
            return pa.RecordBatch.from_arrays(
                [ids, *[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.string()),
                 pa.array(cols[5], pa.binary()), none, none], names)

        def totals() -> Iterator[pa.RecordBatch]:
            every, c = _add_up(codes, counts)
            for i in range(0, len(every), 20_000):
                part = every[i:i + 20_000].astype(np.int64)
                none = [pa.nulls(len(part), t) for t in (id_type, *[pa.int64()] * 4, pa.string(), pa.binary())]
                yield pa.RecordBatch.from_arrays([*none, pa.array(part), pa.array(c[i:i + 20_000])], names)

        # Pieces kept by the hundred thousand hold no cycles; looking for some takes a third of the time.
        gc.disable()
        id_type = None
        names = ["doc_id", *[x.split()[0] for x in ALIGNED.split(", ")]]
        for b in batches:
            id_type = b.column(0).type
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                out = []
                for n_a, n_b, groups, links, digest in both.documents(part.column(1).to_pylist()):
                    pairs, times = np.unique(links, return_counts=True)
                    out.append((n_a, n_b, groups, len(links), digest, pack(pairs, times)))
                    if len(pairs):
                        codes.append(pairs)
                        counts.append(np.ones(len(pairs), dtype=np.int64))
                        size += len(pairs)
                yield rows(part.column(0), out)
                if size > HELD_PAIRS // 4:
                    every, c = _add_up(codes, counts)
                    codes, counts, size = [every], [c], 0
                    if len(every) > HELD_PAIRS:
                        yield from totals()
                        codes, counts = [], []
        if codes:
            yield from totals()
        gc.enable()
    return run


def _sums(codes: np.ndarray, times: np.ndarray, table: np.ndarray, counts: np.ndarray,
          best: np.ndarray) -> tuple[int, int]:
    at = np.searchsorted(table, codes)
    return int(times[best[at]].sum()), int((times * counts[at]).sum())


def _best(codes: np.ndarray, counts: np.ndarray, radix: int) -> np.ndarray:
    """Whether a pair's count is the highest of its A id; codes ascend."""
    if not len(codes):
        return np.empty(0, dtype=bool)
    a = codes // np.uint64(radix)
    start = np.nonzero(np.concatenate(([True], a[1:] != a[:-1])))[0]
    top = np.maximum.reduceat(counts, start)
    return counts == np.repeat(top, np.diff(np.append(start, len(codes))))


def _shared_counts(spark: SparkSession, pairs: DataFrame, radix: int):
    got = pairs.toArrow()
    code = got.column("code").to_numpy().astype(np.uint64)
    order = np.argsort(code)
    code, c = code[order], got.column("c").to_numpy()[order]
    return spark.sparkContext.broadcast((code, c, _best(code, c, radix)))


def _by_broadcast(docs: DataFrame, pairs: DataFrame, radix: int) -> DataFrame:
    shared = _shared_counts(docs.sparkSession, pairs, radix)

    @F.arrow_udf("n_best long, count_sum long")
    def sums(col: pa.Array) -> pa.Array:
        table, counts, best = shared.value
        got = [_sums(*unpack(x.as_py()), table, counts, best) for x in col]
        return pa.StructArray.from_arrays([pa.array([g[i] for g in got], pa.int64()) for i in (0, 1)],
                                          ["n_best", "count_sum"])
    return docs.withColumn("s", sums("pairs")).select(*docs.columns, "s.n_best", "s.count_sum")


def _by_ranges(docs: DataFrame, pairs: DataFrame, radix: int) -> DataFrame:
    """The same sums with the counts of one range of A ids in a task at a time."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, part, held = [], [], []
            for rid, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                codes, times = unpack(raw)
                home = (codes // np.uint64(radix) % np.uint64(RANGES)).astype(np.int64)
                for r in np.unique(home).tolist():
                    row.append(rid)
                    part.append(r)
                    held.append(pack(codes[home == r], times[home == r]))
            yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(part, pa.int64()),
                                              pa.array(held, pa.binary())], ["rid", "part", "pairs"])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (part, salt, kind, code): a range's counts, then its documents."""
        key, code, c, ready = None, [], [], None
        for b in batches:
            row, best, total = [], [], []
            for part, salt, rid, raw, one, count in zip(*[b.column(i).to_pylist() for i in range(6)]):
                if (part, salt) != key:
                    key, code, c, ready = (part, salt), [], [], None
                if raw is None:
                    code.append(one)
                    c.append(count)
                    continue
                if ready is None:
                    table, counts = np.array(code, dtype=np.uint64), np.array(c, dtype=np.int64)
                    ready, code, c = (table, counts, _best(table, counts, radix)), [], []
                n_best, count_sum = _sums(*unpack(raw), *ready)
                row.append(rid)
                best.append(n_best)
                total.append(count_sum)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (row, best, total)],
                                             ["rid", "n_best", "count_sum"])

    numbered = materialize(docs.withColumn("rid", F.monotonically_increasing_id()))
    pieces = (numbered.select("rid", "pairs").mapInArrow(cut, "rid long, part long, pairs binary")
              .withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)))
              .select("part", "salt", "rid", "pairs", F.lit(None).cast("long").alias("code"),
                      F.lit(None).cast("long").alias("c")))
    counts = (pairs.withColumn("part", F.expr(f"(code div {radix}) % {RANGES}"))
              .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
              .select("part", "salt", F.lit(None).cast("long").alias("rid"),
                      F.lit(None).cast("binary").alias("pairs"), "code", "c"))
    found = (pieces.unionByName(counts).repartition("part", "salt")
             .sortWithinPartitions("part", "salt", F.col("pairs").isNotNull(), "code")
             .mapInArrow(look, "rid long, n_best long, count_sum long")
             .groupBy("rid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    return numbered.join(found, "rid", "left").select(
        *docs.columns, F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"))


def align(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, id_col: str = "doc_id",
          text_col: str = "text", broadcast_pairs: int = BROADCAST_PAIRS) -> tuple[DataFrame, DataFrame]:
    """The documents (``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``) and the table of linked id pairs (``a, b, c``)."""
    spark = docs.sparkSession
    a_shared = share_tokenizer(spark, tokenizer_a)
    with open(tokenizer_b, "rb") as f:
        model = f.read(MAX_TOKENIZER_BYTES + 1)
    if len(model) > MAX_TOKENIZER_BYTES:
        raise ValueError("the tokenizer file is too large to broadcast")
    b_shared = spark.sparkContext.broadcast(model)

    def aligner() -> Aligner:
        # Each side's library would start threads of its own in every worker.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        key = ("align", len(a_shared.value), len(b_shared.value), hash(a_shared.value), hash(b_shared.value))
        return once_per_worker(key, lambda: Aligner(a_shared.value, b_shared.value))

    import sentencepiece
    radix = sentencepiece.SentencePieceProcessor(model_proto=model).get_piece_size()
    raw = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = raw.schema["doc_id"].dataType.simpleString()
    made = materialize(raw.mapInArrow(_aligned(aligner), f"doc_id {kind}, {ALIGNED}"))
    pairs = materialize(made.where("code is not null").groupBy("code").agg(F.sum("c").alias("c")))
    rows = made.where("pairs is not null").drop("code", "c")
    look = _by_broadcast if pairs.count() <= broadcast_pairs else _by_ranges
    out = look(rows, pairs, radix).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best",
                                          "count_sum", "groups_sha256")
    return out, pairs.select(F.expr(f"code div {radix}").alias("a"), F.expr(f"code % {radix}").alias("b"), "c")
