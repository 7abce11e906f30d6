"""Late rows under a per-record watermark.

A source partition's watermark after each row is the latest event time seen
so far in that partition (zero delay).  A row is late when its tumbling
window has already fired, i.e. ``window_end - 1 ms <= watermark`` before the
row.  Spark's own watermark advances per micro-batch, so it keeps rows that
are late only within a batch; this operator gives the per-record answer on a
static frame, with the running maximum split over seq buckets.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.functions.timefmt import epoch_ms
from eddyline.operators.scan import DEFAULT_SEQ_BUCKET, hot_key_bucket, running, seq_bucket


class LateSplit(NamedTuple):
    on_time: DataFrame
    late: DataFrame


def mark_late(df: DataFrame, window: str, ts: str = "ts", seq: str = "seq",
              partition: str = "partition", tie: str | None = "event_id",
              bucket_width: int = DEFAULT_SEQ_BUCKET, split: str = "all") -> DataFrame:
    """Add ``window_start``, ``window_end``, ``watermark_ms`` (before the row)
    and ``late``.  A row without a time has no window and is not late; rows of a
    null partition are a partition of their own.  ``split="hot"`` buckets only the busy partitions."""
    order = [seq] + ([tie] if tie else [])
    d = df.withColumn("_ms", epoch_ms(ts))
    bucket = seq_bucket(seq, bucket_width)
    if split == "hot":
        bucket = hot_key_bucket(d, [partition], bucket)
    elif split != "all":
        raise ValueError("split must be 'all' or 'hot'")
    d = running(d, [partition], order, F.col("_ms"), "max", "watermark_ms", bucket,
                inclusive=False)
    # ``window`` would drop rows without a time: they get a stand-in, and no window.
    known = F.col(ts).isNotNull()
    w = F.window(F.coalesce(F.col(ts).cast("timestamp"), F.timestamp_millis(F.lit(0))), window)
    d = d.withColumn("_w", w).withColumn("_w", F.when(known, F.col("_w")))
    end_ms = F.unix_millis(F.col("_w.end"))
    late = F.coalesce(end_ms - 1 <= F.col("watermark_ms"), F.lit(False))
    return (d.withColumn("window_start", F.col("_w.start"))
            .withColumn("window_end", F.col("_w.end"))
            .withColumn("late", late).drop("_w", "_ms"))


def split_late(df: DataFrame, window: str, **kw) -> LateSplit:
    d = mark_late(df, window, **kw)
    return LateSplit(d.where(~F.col("late")), d.where(F.col("late")))
