"""Order-dependent keyed operators on static frames.

``count_average``: per key, every ``n`` consecutive values give one average
(the sum divided by ``n``, truncated); a last incomplete group stays pending.
``chunk_rows``: per bucket (a sink instance), rows are released in groups of
exactly ``n``; the remainder is what the sink would keep in its state.

Both need each row's position within its key.  It comes from the bucketed
running count in :mod:`eddyline.operators.scan`, so a key with a third of all
rows is still split over many tasks.  Streaming twins with state that
survives restarts are in :mod:`eddyline.streaming.stateful`.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.operators.scan import (
    DEFAULT_SEQ_BUCKET, floor_div, hot_key_bucket, ordinal, seq_bucket,
)


def _bucket(df: DataFrame, keys: list[str], seq: str, width: int, split: str):
    """Bucket every key's seq range (``split="all"``), or only those of the
    frequent keys (``split="hot"``, one extra frequent-items pass)."""
    b = seq_bucket(seq, width)
    if split == "all":
        return b
    if split == "hot":
        return hot_key_bucket(df, keys, b)
    raise ValueError("split must be 'all' or 'hot'")


def arrival(df: DataFrame, seq: str) -> list[str]:
    """The order columns: ``seq``, then ``partition`` where the rows have one (the
    positions of different source partitions repeat)."""
    return [seq] + [c for c in ("partition",) if c in df.columns]


def average_pending(pairs: DataFrame, n: int = 2, key: str = "key", value: str = "value", seq: str = "seq",
                    bucket_width: int = DEFAULT_SEQ_BUCKET, split: str = "all") -> DataFrame:
    """``key, count, total, known`` of every key's last, incomplete group: the rows in it, their
    sum and the number of values that are not null."""
    d = ordinal(pairs, [key], arrival(pairs, seq), "_rn", _bucket(pairs, [key], seq, bucket_width, split),
                key_total="_total")
    rest = d.where(F.col("_rn") > F.col("_total") - F.pmod("_total", F.lit(n)))
    return rest.groupBy(F.col(key).alias("key")).agg(
        F.count(F.lit(1)).alias("count"), F.coalesce(F.sum(value).cast("bigint"), F.lit(0)).alias("total"),
        F.count(value).alias("known"))


class Chunks(NamedTuple):
    full: DataFrame
    pending: DataFrame


def count_average(pairs: DataFrame, n: int = 2, key: str = "key", value: str = "value",
                  seq: str = "seq", bucket_width: int = DEFAULT_SEQ_BUCKET,
                  split: str = "all") -> DataFrame:
    """``(key, average, seq)`` for every complete group of ``n`` values of a
    key in ``seq`` order; ``seq`` is that of the row that completes it."""
    d = ordinal(pairs, [key], arrival(pairs, seq), "_rn", _bucket(pairs, [key], seq, bucket_width, split))
    d = d.withColumn("_group", floor_div(F.col("_rn") - 1, n))
    g = d.groupBy(key, "_group").agg(
        F.count("*").alias("_n"), F.sum(value).cast("bigint").alias("_sum"),
        F.max(seq).alias(seq))
    return (g.where(F.col("_n") == n)
            .select(key, F.expr(f"_sum div {int(n)}").alias("average"), seq))


def chunk_rows(rows: DataFrame, n: int, bucket: str = "bucket", seq: str = "seq",
               bucket_width: int = DEFAULT_SEQ_BUCKET, split: str = "all") -> Chunks:
    """Split rows into released chunks of exactly ``n`` per ``bucket`` (in
    ``seq`` order) and the pending remainder.  Adds ``chunk`` (0-based) and
    ``position`` (0-based within the chunk)."""
    d = ordinal(rows, [bucket], arrival(rows, seq), "_rn", _bucket(rows, [bucket], seq, bucket_width, split),
                key_total="_n")
    d = (d.withColumn("chunk", floor_div(F.col("_rn") - 1, n))
         .withColumn("position", ((F.col("_rn") - 1) % n).cast("int"))
         .withColumn("_full", floor_div("_n", n)))
    cols = [c for c in rows.columns] + ["chunk", "position"]
    full = d.where(F.col("chunk") < F.col("_full")).select(*cols)
    pending = d.where(F.col("chunk") >= F.col("_full")).select(*cols)
    return Chunks(full, pending)


def chunk_state(chunks: Chunks, bucket: str = "bucket") -> DataFrame:
    """What the sink instances hold after :func:`chunk_rows`: the pending rows (``held``), and one
    row per bucket with the number of chunks released in ``chunk``."""
    cols = ["name", "value", "seq", bucket]
    last = chunks.full.groupBy(bucket).agg((F.max("chunk") + 1).alias("chunk"))
    none = last.select(F.lit(None).cast("string").alias("name"), F.lit(None).cast("int").alias("value"),
                       F.lit(None).cast("bigint").alias("seq"), bucket, "chunk", F.lit(0).alias("position"),
                       F.lit(False).alias("held"))
    return chunks.pending.select(*cols, "chunk", "position", F.lit(True).alias("held")).unionByName(none)
