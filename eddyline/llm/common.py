"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.session import checkpoint_root, materialize

__all__ = ["read", "materialize", "checkpoint_root", "components", "word_blocks", "fresh"]

# A text is cut into word blocks of about this many bytes, so a very long
# document is processed whole in bounded memory.
BLOCK_BYTES = 1 << 20

# The white space bytes of every word rule here.
WHITE = re.compile(rb"[\x20\x09-\x0d]")


def once_per_worker(key: Any, make: Callable[[], Any]) -> Any:
    """``make()``, once in each Python worker process for a ``key``.  Functions
    shipped by value get new globals with every task, so what should outlive
    a task is kept in a module of the process; the last two keys are kept."""
    held = sys.modules.setdefault("_eddyline_llm_worker", types.ModuleType("_eddyline_llm_worker")).__dict__
    made = held.setdefault("made", {})
    if key not in made:
        while len(made) > 1:
            made.pop(next(iter(made)))
        made[key] = make()
    return made[key]


def in_slices(values: Any, each: Callable[[Any], Any], kind: Any, rows: int = 256) -> Any:
    """An Arrow array of ``each`` value, made in slices: Python objects of only
    ``rows`` rows exist at a time."""
    import pyarrow as pa
    parts = [pa.array(map(each, values.slice(i, rows).to_pylist()), kind, size=min(rows, len(values) - i))
             for i in range(0, len(values), rows)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores, whichever is no column yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def word_blocks(raw: bytes, words: int) -> Iterator[list[bytes]]:
    """The words of ``raw`` in blocks; successive blocks share ``words - 1``
    words, so the shingles of all blocks are those of the whole text.  A text
    of fewer words gives one block of all its words; no words, no block."""
    at, carry, made = 0, [], False
    while at < len(raw):
        end = at + BLOCK_BYTES
        if end < len(raw):
            m = WHITE.search(raw, end)
            end = m.start() if m else len(raw)
        block = carry + raw[at:end].split()
        at = end
        if len(block) >= words:
            made = True
            yield block
            carry = block[len(block) - words + 1:] if words > 1 else []
        else:
            carry = block
    if carry and not made:
        yield carry


def _signature(edges: DataFrame) -> tuple:
    """The count and 128 bits of a set of distinct edges; XOR cannot overflow."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                           F.bit_xor(F.xxhash64(F.lit("second"), "a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: ``node``, ``label`` (the
    smallest node of its component), one row per node that has an edge to
    another node.

    Alternating large-star and small-star steps: every step relinks
    neighbours to the smallest one, the table never holds more rows than the
    input had edges (plus one per node), and it ends as one star per
    component after a number of rounds that grows with the logarithm of the
    size.  Neighbour minima are partial aggregates; no neighbour list is
    gathered.  Each round is checkpointed, which cuts the lineage.
    """
    e = (edges.where("a <> b")
         .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    e = materialize(e)
    seen = _signature(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        e = (both.where("b > a").join(low, "a").where("b <> m")
             .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        e = materialize(e)
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        e = (e.join(low, "a").where("b <> m")
             .select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
             .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        e = materialize(e)
        now = _signature(e)
        if now == seen:
            break
        seen = now
    return (e.select(F.col("a").alias("node"), F.col("b").alias("label"))
            .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()))


def row_order(*cols: str | Column) -> Column:
    """One number per row content, for ties between rows of equal id."""
    return F.xxhash64(*cols)
