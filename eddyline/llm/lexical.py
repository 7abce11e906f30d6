"""Operator 11, ranked lexical search by presence-mask grouping.

Every item is a bag of terms; the ``k`` documents of highest score are found for
each over all documents.  Scores are whole numbers (see ``contribution``).

* One pass over the texts keeps, for every document, its length in terms and the
  numbers and frequencies of those terms that some item has.  Document counts and
  lengths are partial aggregates over all documents.
* The documents of a task are worked through in blocks.  A block has one bitmap of
  documents per term.  An item's bitmaps, laid side by side, give each document's mask
  of matched terms, and the documents of one mask are a group.  The highest score that
  a mask can reach is the sum, over its terms, of the best contribution in the
  block.  Masks are taken by that bound, highest first, and their documents scored,
  until ``k`` documents are held and the next bound lies below the ``k``-th score.  What is
  left then cannot enter the result, ties included.
* The ``k`` best of an item so far are carried from block to block, and a task ships at
  most ``k`` rows per item; those are ranked per (item, salt) and then per item.
* The terms of the items are broadcast.  Items are worked through in chunks of at
  most ``CHUNK_TERMS`` different terms of bounded length (``CHUNK_BYTES``), found by a
  running sum, so that what is broadcast has a bound; a single item of more is a
  chunk of its own.  Each chunk is one search of all documents.

Nulls and ties: a null text has no terms.  Rows of one item id (a null id too) are one
item with the terms of all of them.  Repeated rows and ids of documents are documents of
their own, null ids take part and rank last among equal scores.  Items or documents
without terms, and empty tables, give no row.  A very long text is read in
blocks.  Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eddyline.llm.common import materialize

TOP = 50                    # documents of an item, from the contract
CHUNK_TERMS = 1 << 18       # different terms of the items of one search
CHUNK_BYTES = 1 << 24       # and their bytes
BLOCK_ROWS = 4096           # documents of a block
TEXT_BLOCK = 1 << 22        # bytes of a text read at once
SALTS = 16

# A term is a run of bytes that are letters, digits or not ASCII;
# of the letters only A-Z are lower-cased.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def terms(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, block by block."""
    at = 0
    while at < len(raw):
        end = at + TEXT_BLOCK
        while end < len(raw) and TERM_BYTES[raw[end]] != 0x20:
            end += 1
        yield raw[at:end].translate(TERM_BYTES).split()
        at = end


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def contribution(w: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """``w * (10**9 tf div (1000 tf + 20 m))`` with ``m = 50 + 50 n N div L``."""
    m = 50 + (50 * n * n_docs) // total
    return w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item, term``: an item's different terms."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                raw = b.column(1)[i].as_py() or b""
                found = sorted({t for part in terms(raw) for t in part})
                for k in range(0, len(found), 10_000):
                    part = found[k:k + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(i, 1).take(pa.array(np.zeros(len(part), dtype=np.int64))),
                         pa.array(part, pa.binary())], ["item", "term"])
    raw = items.select(F.col(f"`{id_col}`").alias("item"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    kind = raw.schema["item"].dataType.simpleString()
    return raw.mapInArrow(cut, f"item {kind}, term binary").distinct()


def _chunks(found: DataFrame, chunk_terms: int, chunk_bytes: int) -> DataFrame:
    """``item, chunk``: consecutive items whose terms stay below the bounds.  The
    running sums go by ranges of items: sums of a range, then within it."""
    size = found.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("term")).alias("b"))
    size = size.withColumn("home", F.pmod(F.xxhash64("item"), F.lit(1024)))
    before = Window.orderBy("home").rowsBetween(Window.unboundedPreceding, -1)      # at most 1024 rows
    homes = size.groupBy("home").agg(F.sum("n").alias("hn"), F.sum("b").alias("hb")).select(
        "home", F.coalesce(F.sum("hn").over(before), F.lit(0)).alias("n0"),
        F.coalesce(F.sum("hb").over(before), F.lit(0)).alias("b0"))
    within = Window.partitionBy("home").orderBy("item")
    run = lambda c, start: F.expr(start) + F.sum(c).over(within)
    return (size.join(homes, "home")
            .select("item", (F.floor((run("n", "n0") - 1) / chunk_terms)
                             + F.floor((run("b", "b0") - 1) / chunk_bytes)).alias("chunk")))


def _postings(shared):
    """``id, text`` to ``id, n, terms, tfs``: the numbers of the wanted terms
    that a document holds, ascending, and how often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                n, held, often = [], [], []
                for raw in part.column(1).to_pylist():
                    count: Counter = Counter()
                    for found in terms(raw or b""):
                        count.update(found)
                    n.append(count.total())
                    hits = sorted((number[t], c) for t, c in count.items() if t in number)
                    held.append([t for t, _ in hits])
                    often.append([c for _, c in hits])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(held, pa.list_(pa.int32())),
                     pa.array(often, pa.list_(pa.int32()))], ["id", "n", "terms", "tfs"])
    return run


def mask_groups(bitmaps: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct masks (bits of terms) of the ``rows`` documents whose bitmaps, one
    per term, are given; the documents ordered by mask; and where each mask starts.
    Documents that hold no term are left out."""
    bits = np.unpackbits(bitmaps, axis=1, count=rows)
    lanes = np.packbits(bits, axis=0)                               # term bytes x documents
    some = np.nonzero(lanes.any(axis=0))[0]
    lanes = lanes[:, some]
    order = np.lexsort(lanes)
    lanes = lanes[:, order]
    new = np.nonzero(np.concatenate(([len(order) > 0], (lanes[:, 1:] != lanes[:, :-1]).any(axis=0))))[0]
    return lanes[:, new], some[order], new


def best_documents(ids: list, indptr: np.ndarray, term: np.ndarray, value: np.ndarray,
                   items: list[np.ndarray], n_terms: int, held: list[list[tuple]], k: int) -> None:
    """Take a block's documents into ``held``, the ``k`` best ``(score, id is null, id)``
    of each item; entries (``term``, ``value``) are document-major."""
    rows = len(indptr) - 1
    order = np.argsort(term, kind="stable")
    doc = np.repeat(np.arange(rows), np.diff(indptr))[order]
    start = np.searchsorted(term[order], np.arange(n_terms + 1))
    top = np.zeros(n_terms, dtype=np.int64)
    np.maximum.at(top, term, value)
    bitmap: dict[int, np.ndarray] = {}

    def bits(t: int) -> np.ndarray:
        found = bitmap.get(t)
        if found is None:
            on = np.zeros(rows, dtype=np.uint8)
            on[doc[start[t]:start[t + 1]]] = 1
            found = bitmap[t] = np.packbits(on)
        return found

    wanted = np.zeros(n_terms, dtype=bool)
    for i, want in enumerate(items):
        present = want[start[want + 1] > start[want]]
        if not len(present):
            continue
        kth = held[i][-1][0] if len(held[i]) == k else 0
        if int(top[present].sum()) < max(kth, 1):
            continue
        masks, docs, first = mask_groups(np.stack([bits(t) for t in present.tolist()]), rows)
        on = np.unpackbits(masks, axis=0, count=len(present))       # terms x masks
        bound = top[present] @ on.astype(np.int64)
        last = np.append(first[1:], len(docs))
        by_bound = np.argsort(-bound, kind="stable")
        wanted[want] = True
        at, step = 0, 32
        while at < len(by_bound):
            kth = held[i][-1][0] if len(held[i]) == k else 0
            now = by_bound[at:at + step]
            now = now[bound[now] >= max(kth, 1)]
            if not len(now):
                break
            chosen = np.concatenate([docs[a:b] for a, b in zip(first[now].tolist(), last[now].tolist())])
            lo, size = indptr[chosen], indptr[chosen + 1] - indptr[chosen]
            entry = np.repeat(lo - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            score = np.add.reduceat(np.where(wanted[term[entry]], value[entry], 0),
                                    np.concatenate(([0], np.cumsum(size)[:-1])))
            good = np.nonzero(score >= max(kth, 1))[0]
            new = [(s, ids[d] is None, ids[d]) for s, d in zip(score[good].tolist(), chosen[good].tolist())]
            held[i] = sorted(held[i] + new, key=lambda x: (-x[0], x[1], 0 if x[1] else x[2]))[:k]
            at, step = at + step, step * 2
        wanted[want] = False


def _search(shared, k: int):
    """``id, n, terms, tfs`` to the task's ``item_no, id, score``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, items, n_docs, total = shared.value
        held: list[list[tuple]] = [[] for _ in items]
        id_type = None
        for b in batches:
            id_type = b.column(0).type
            for i in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(i, BLOCK_ROWS)
                lists, tfs = part.column(2), part.column(3)
                indptr = lists.offsets.to_numpy().astype(np.int64)
                indptr -= indptr[0]
                term = lists.flatten().to_numpy()
                value = contribution(weights[term], tfs.flatten().to_numpy().astype(np.int64),
                                     np.repeat(part.column(1).to_numpy(), np.diff(indptr)), n_docs, total)
                best_documents(part.column(0).to_pylist(), indptr, term, value, items, len(weights), held, k)
        rows = [(i, d, s) for i, found in enumerate(held) for s, _, d in found]
        for i in range(0, len(rows), 50_000):
            no, ids, score = zip(*rows[i:i + 50_000])
            yield pa.RecordBatch.from_arrays([pa.array(no, pa.int32()), pa.array(ids, id_type),
                                              pa.array(score, pa.int64())], ["item_no", "id", "score"])
    return run


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id",
                   doc_text: str = "text", item_id: str = "item_id", item_text: str = "text",
                   chunk_terms: int = CHUNK_TERMS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents."""
    found = materialize(_item_terms(items, item_id, item_text))
    chunked = materialize(_chunks(found, chunk_terms, chunk_bytes))
    raw = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{doc_text}`").cast("binary").alias("text"))
    n_chunks = (chunked.agg(F.max("chunk")).first()[0] or 0) + 1
    out = None
    for chunk in range(n_chunks):
        part = found.join(chunked.where(F.col("chunk") == chunk).select(F.col("item").alias("i")),
                          F.col("item").eqNullSafe(F.col("i"))).select("item", "term")
        ranked = _rank_chunk(raw, part, k)
        out = ranked if out is None else out.unionByName(ranked)
    return out


def _rank_chunk(raw: DataFrame, part: DataFrame, k: int) -> DataFrame:
    """The ranking for one chunk of items: its terms have a bound, so they go to
    the driver and from there to all tasks."""
    spark = raw.sparkSession
    got = part.toArrow()
    ids, words = got.column("item").to_pylist(), got.column("term").to_pylist()
    number = {t: i for i, t in enumerate(sorted(set(words)))}
    item_no = {x: i for i, x in enumerate(dict.fromkeys(ids))}
    wants: list[list[int]] = [[] for _ in item_no]
    for x, t in zip(ids, words):
        wants[item_no[x]].append(number[t])
    kind = raw.schema["id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(number)
    postings = materialize(raw.mapInArrow(
        _postings(shared), f"id {kind}, n long, terms array<int>, tfs array<int>"))
    n_docs, total = postings.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    counts = dict(postings.select(F.explode("terms").alias("t")).groupBy("t").count().toPandas()
                  .itertuples(index=False, name=None))
    weights = np.array([weight(counts[t], n_docs) if t in counts else 0 for t in range(len(number))],
                       dtype=np.int64)
    plan = spark.sparkContext.broadcast(
        (weights, [np.array(sorted(w), dtype=np.int64) for w in wants], n_docs or 0, max(total or 0, 1)))
    best = postings.where(F.size("terms") > 0).mapInArrow(_search(plan, k), f"item_no int, id {kind}, score long")
    by_score = [F.desc("score"), F.asc_nulls_last("id")]
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS))
    best = (best.withColumn("r", F.row_number().over(Window.partitionBy("item_no", salt).orderBy(*by_score)))
            .where(F.col("r") <= k)
            .withColumn("rank", F.row_number().over(Window.partitionBy("item_no").orderBy(*by_score)))
            .where(F.col("rank") <= k))
    item_kind = part.schema["item"].dataType.simpleString()
    names = spark.createDataFrame([(i, x) for x, i in item_no.items()], f"item_no int, item_id {item_kind}")
    return best.join(names, "item_no").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
