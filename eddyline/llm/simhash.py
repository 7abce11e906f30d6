"""Operator 1, SimHash near-duplicates found with BK-trees.

A fingerprint is the 64-bit majority of the XXH64 hashes of all word shingles.
Two fingerprints link at ``max_bits`` or fewer differing bits; a group is a
connected component of links.

* Equal fingerprints collapse first (partial aggregate), so thousands of exact
  copies are one member.
* Members are dealt to shards by the pigeonhole rule: the 64 bits are cut into
  ``max_bits + 1`` blocks, and two fingerprints within ``max_bits`` agree on at
  least one whole block, so they meet in the shard of that block value.
* Each shard holds a BK-tree: a node's children are keyed by their integer
  Hamming distance to it, and a search at distance ``d`` follows only the edges
  ``d - max_bits .. d + max_bits``.
* The bits outside the block of a shard of more than ``shard_limit`` members are cut into
  blocks again by the same rule, so a hot shard becomes many small ones at a cost in
  proportion to its size.
* A part that is still larger is cut into cells of about ``shard_limit`` members: a cell's tree
  is sent to one task per slice (the members of one later cell that search it), so no task holds more
  than a tree and a slice.  Nothing is sent to all executors, and no fingerprint list goes to
  the driver.
* A task joins the links it finds with a local union-find and returns a
  spanning star per group (at most one row per member), not all pairs; the
  stars of all tasks become components by distributed star contraction.

Nulls and ties: a null text counts as empty; an empty text has fingerprint 0
and links like any other.  Rows of a null id take part: the component id is the
smallest non-null id reachable, null if there is none.  Repeated rows and ids
each keep their own result row.  An empty table gives no row; a very long text is read whole,
in blocks.  Other columns, whatever their names, are not looked at (``keep_one`` returns them).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline.llm.common import components, fresh, materialize, word_blocks

WORDS = 3          # words of a shingle, from the contract
MAX_BITS = 2       # differing bits of a link, from the contract
SEED = 42          # XXH64 seed, from the contract
SHARD_LIMIT = 4096     # members of one BK-tree
STEP = 1 << 15     # shingles whose bits are unpacked at once


def shingle_hashes(raw: bytes, words: int = WORDS, seed: int = SEED) -> Iterator[np.ndarray]:
    """XXH64 of every word shingle of the lower-cased text, block by block."""
    for block in word_blocks(raw.lower(), words):
        n = len(block)
        line = b" ".join(block)
        if n <= words:
            yield np.array([xxhash.xxh64_intdigest(line, seed)], dtype=np.uint64)
            continue
        size = np.fromiter(map(len, block), dtype=np.int64, count=n)
        end = np.cumsum(size + 1) - 1
        cut = map(slice, (end - size)[:n - words + 1].tolist(), end[words - 1:].tolist())
        yield np.array(list(map(xxhash.xxh64_intdigest, map(line.__getitem__, cut), repeat(seed))),
                       dtype=np.uint64)


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def simhash_many(texts: list[bytes | None], words: int = WORDS) -> np.ndarray:
    """Fingerprints of whole texts; a bit is set where over half the hashes set it."""
    total = np.zeros((len(texts), 64), dtype=np.int64)
    count = np.zeros(len(texts), dtype=np.int64)
    held: list[np.ndarray] = []
    owner: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal held, owner, size
        if held:
            at = np.concatenate(([0], np.cumsum([len(h) for h in held])[:-1]))
            sums = np.add.reduceat(_bits(np.concatenate(held)), at, axis=0, dtype=np.int32)
            np.add.at(total, owner, sums)
        held, owner, size = [], [], 0

    for i, raw in enumerate(texts):
        for hashes in shingle_hashes(raw or b"", words):
            count[i] += len(hashes)
            for k in range(0, len(hashes), STEP):
                part = hashes[k:k + STEP]
                held.append(part)
                owner.append(i)
                size += len(part)
                if size >= STEP:
                    flush()
    flush()
    on = (2 * total > count[:, None]).astype(np.uint8)
    return np.packbits(on, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def fingerprint(text: str | Column, words: int = WORDS) -> Column:
    """The fingerprint of a text column as a BIGINT holding its 64 bits."""
    @F.arrow_udf(T.LongType())
    def f(col: pa.Array) -> pa.Array:
        return pa.array(simhash_many(col.cast(pa.binary()).to_pylist(), words).view(np.int64))
    return f(F.col(text) if isinstance(text, str) else text)


def fingerprint_hex(bits: str | Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


class BKTree:
    """Children keyed by their integer Hamming distance to the parent."""

    def __init__(self) -> None:
        self.value: list[int] = []
        self.child: list[dict[int, int]] = []

    def add(self, v: int) -> None:
        at = 0
        if not self.value:
            self.value.append(v)
            self.child.append({})
            return
        while True:
            d = (self.value[at] ^ v).bit_count()
            if d == 0:
                return
            nxt = self.child[at].get(d)
            if nxt is None:
                self.child[at][d] = len(self.value)
                self.value.append(v)
                self.child.append({})
                return
            at = nxt

    def within(self, v: int, radius: int) -> list[int]:
        """The values at most ``radius`` away; only edges that can lead to one are followed."""
        found, todo = [], [0] if self.value else []
        while todo:
            at = todo.pop()
            d = (self.value[at] ^ v).bit_count()
            if d <= radius:
                found.append(self.value[at])
            child = self.child[at]
            if child:
                if len(child) <= 2 * radius + 1:
                    todo += [n for k, n in child.items() if d - radius <= k <= d + radius]
                else:
                    todo += [n for k in range(d - radius, d + radius + 1)
                             if (n := child.get(k)) is not None]
        return found


def _cell_links(own: list[int], asking: list[int], radius: int) -> list[tuple[int, int]]:
    """Spanning stars of the links inside ``own`` and from ``asking`` to ``own``."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := up.setdefault(x, x)) != x:
            up[x] = up[p]
            x = up[x]
        return x

    tree = BKTree()
    for searching, values in ((False, own), (True, asking)):
        for v in values:
            for w in tree.within(v, radius):
                a, b = root(v), root(w)
                if a != b:
                    up[max(a, b)] = min(a, b)
            if not searching:
                tree.add(v)
    return [(x, r) for x in list(up) if (r := root(x)) != x]


def _links(radius: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (home, cell, slice, asking): one run of rows per slice of a cell."""
        key, own, asking = None, [], []
        out: list[tuple[int, int]] = []

        def batch() -> pa.RecordBatch:
            a = np.array(out, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], schema=schema)

        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(3)]
            values = b.column(4).to_numpy(zero_copy_only=False).view(np.uint64).tolist()
            for k0, k1, k2, ask, v in zip(*cols, b.column(3).to_pylist(), values):
                if (k0, k1, k2) != key:
                    if len(own) + len(asking) > 1:
                        out += _cell_links(own, asking, radius)
                    key, own, asking = (k0, k1, k2), [], []
                    if len(out) > 50_000:
                        yield batch()
                        out = []
                (asking if ask else own).append(v)
        if len(own) + len(asking) > 1:
            out += _cell_links(own, asking, radius)
        if out:
            yield batch()
    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS,
                      shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """Links ``a, b`` spanning every group of the distinct fingerprints ``fp``."""
    bits = lambda lo, hi: F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
    blocks = max_bits + 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    shards = F.array(*[F.struct(F.lit(i).alias("block"), bits(lo, hi).alias("shard"))
                       for i, (lo, hi) in enumerate(zip(edges, edges[1:]))])
    keyed = fps.select("fp", F.explode(shards).alias("k")).select("fp", "k.*")
    # The bits outside a large shard's block are cut into blocks again.
    size = F.count(F.lit(1)).alias("n")
    large = keyed.groupBy("block", "shard").agg(size).where(F.col("n") > shard_limit).select("block", "shard", F.lit(True).alias("large"))
    inner = None
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        rest = F.shiftleft(F.shiftrightunsigned("fp", hi) if hi < 64 else F.lit(0).cast("bigint"), lo).bitwiseOR(bits(0, lo))
        width = 64 - (hi - lo)
        cuts = [width * k // blocks for k in range(blocks + 1)]
        parts = F.array(*[F.struct(F.lit(k).alias("sub"), F.shiftrightunsigned(rest, a).bitwiseAND(
            F.lit((1 << (b - a)) - 1)).alias("part")) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))])
        inner = F.when(F.col("block") == i, parts) if inner is None else inner.when(F.col("block") == i, parts)
    whole = F.array(F.struct(F.lit(-1).alias("sub"), F.lit(0).cast("bigint").alias("part")))
    keyed = (keyed.join(large, ["block", "shard"], "left")
             .select("fp", "block", "shard", F.explode(F.when(F.col("large"), inner).otherwise(whole)).alias("k"))
             .select("fp", F.xxhash64("block", "shard", "k.sub", "k.part").alias("home")))
    # What is still large is cut into cells, and the members that search a cell into slices.
    still = (keyed.groupBy("home").agg(size).where(F.col("n") > shard_limit)
             .select("home", F.ceil(F.col("n") / shard_limit).alias("cells")))
    cells = F.coalesce("cells", F.lit(1).cast("bigint"))
    upto = lambda n: F.sequence(F.lit(0).cast("bigint"), n)
    celled = (keyed.join(still, "home", "left").withColumn("cells", cells)
              .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("cells")))
              .select("home", "fp", "own", "cells", F.explode(upto(F.col("own"))).alias("cell")))
    # A cell's own members go to all its slices, of which there is one per later cell.
    asking = F.col("cell") != F.col("own")
    slices = F.when(asking, F.array("own")).otherwise(F.sequence(F.col("own"), F.col("cells") - 1))
    sliced = celled.select("home", "cell", F.explode(slices).alias("slice"), asking.alias("asking"), "fp")
    return (sliced.repartition("home", "cell", "slice")
            .sortWithinPartitions("home", "cell", "slice", "asking", "fp")
            .mapInArrow(_links(max_bits), "a long, b long"))


def fingerprint_groups(rows: DataFrame, max_bits: int = MAX_BITS,
                       shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """``fp, component_id`` for every distinct fingerprint of ``rows(id, fp)``."""
    members = materialize(rows.groupBy("fp").agg(F.min("id").alias("id")))
    label = components(fingerprint_links(members.select("fp"), max_bits, shard_limit))
    linked = members.join(label, members.fp == label.node, "left").select(
        "fp", "id", F.coalesce("label", "fp").alias("label"))
    low = linked.groupBy("label").agg(F.min("id").alias("component_id"))
    return linked.join(low, "label").select("fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = WORDS, max_bits: int = MAX_BITS,
                    shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """``doc_id, fingerprint, component_id``: one row per row of ``docs``."""
    rows = materialize(docs.select(F.col(id_col).alias("id"),
                                   fingerprint(text_col, words).alias("fp")))
    groups = fingerprint_groups(rows, max_bits, shard_limit)
    return rows.join(groups, "fp").select(
        F.col("id").alias("doc_id"), fingerprint_hex("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             words: int = WORDS, max_bits: int = MAX_BITS,
             shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """``docs`` with one row of each group, columns unchanged: the smallest id,
    a null id last; among rows of that id the one whose content hashes lowest.
    Fully equal rows of that id are one row."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    # 128 bits of the row's content: joins and drops repeats by one key, with one shuffle.
    h1 = fresh(docs, "_row_hash")
    h2 = h1 + "2"
    # A hash skips nulls and refuses maps: nulls are marked, nested values hashed as JSON.
    parts = [x for f, c in zip(docs.schema, cols) for x in (
        F.to_json(F.struct(c)) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else c, c.isNull())]
    tagged = docs.withColumns({h1: F.xxhash64(*parts), h2: F.xxhash64(F.lit(h2), *parts)})
    pick = F.struct(F.col(f"`{id_col}`").isNull().alias("last"), F.col(f"`{id_col}`").alias("id"),
                    F.col(h1).alias("h1"), F.col(h2).alias("h2"))
    rows = materialize(tagged.select(pick.alias("id"), fingerprint(text_col, words).alias("fp")))
    chosen = (fingerprint_groups(rows, max_bits, shard_limit)
              .select(F.col("component_id.h1").alias(h1), F.col("component_id.h2").alias(h2)))
    return (tagged.join(chosen, [h1, h2], "left_semi").dropDuplicates([h1, h2]).select(*cols))
