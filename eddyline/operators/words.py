"""Word counts: global, per tumbling window, per session."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eddyline.functions.text import tokens
from eddyline.operators.scan import floor_div

DEFAULT_WINDOW = "30 seconds"
DEFAULT_GAP_SECONDS = 600


def word_pairs(lines: DataFrame, time_col: str | None = "timestamp") -> DataFrame:
    """``(word, one)`` per token of each line, plus the line's time."""
    cols = [F.explode(tokens("value")).alias("word"), F.lit(1).alias("one")]
    if time_col:
        cols.append(F.col(time_col).alias("ts"))
    return lines.select(*cols)


def word_count(lines: DataFrame) -> DataFrame:
    """Total count per word (the bounded twin of the windowed counts).
    Partial sums are combined map-side, so a frequent word is not a hot key."""
    return (word_pairs(lines, None).groupBy("word")
            .agg(F.sum("one").cast("bigint").alias("count_sum")))


def word_count_window(lines: DataFrame, window: str = DEFAULT_WINDOW,
                      time: str = "event", time_col: str = "timestamp",
                      watermark: str | None = None) -> DataFrame:
    """Count per word per tumbling window.

    ``time="event"`` windows on ``time_col``; ``time="processing"`` stamps
    each row with the micro-batch time, like a job with no time
    characteristic.  ``watermark`` bounds the state of a stream: a window is
    emitted (append mode) and dropped from state once the watermark passes
    its end; on processing time that is when a later batch starts after it.
    """
    if time == "processing":
        d = lines.withColumn("_t", F.current_timestamp())
    elif time == "event":
        d = lines.withColumn("_t", F.col(time_col).cast("timestamp"))
    else:
        raise ValueError("time must be 'event' or 'processing'")
    if watermark is not None:
        d = d.withWatermark("_t", watermark)
    pairs = d.select(F.explode(tokens("value")).alias("word"), F.lit(1).alias("one"), "_t")
    return (pairs.groupBy(F.window("_t", window).alias("window"), "word")
            .agg(F.sum("one").cast("bigint").alias("count_sum"))
            .select("word", F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), "count_sum"))


def word_sessions(lines: DataFrame, gap_seconds: int = DEFAULT_GAP_SECONDS,
                  time_col: str = "timestamp") -> DataFrame:
    """Count per word per event-time session (static frames).

    A word's session ends when its next occurrence is more than
    ``gap_seconds`` later; rows exactly ``gap`` apart share a session.  The
    session's end is its last row plus the gap.

    Rows are first counted per word and time slot of ``gap`` width (a partial
    aggregate, combined map-side): rows of one slot are less than ``gap``
    apart, so a slot lies inside one session.  Sessions are then gaps and
    islands over the slots: a slot opens a session when its first row is
    more than ``gap`` after the last row of the word's previous slot.  A word
    on every line (a hot key) costs one row per slot, bounded by its time
    span rather than its row count, so two windows over a word's slots are
    enough: no join and no checkpoint.
    """
    gap_us = gap_seconds * 1_000_000
    pairs = word_pairs(lines, time_col).where(F.col("ts").isNotNull())
    us = F.unix_micros("ts")
    slots = (pairs.groupBy("word", floor_div(us, gap_us).alias("_slot"))
             .agg(F.min(us).alias("_first"), F.max(us).alias("_last"),
                  F.count("*").alias("_n")))
    in_order = Window.partitionBy("word").orderBy("_slot")
    prev = F.lag("_last").over(in_order)
    d = slots.withColumn("_start_here", F.when(
        prev.isNull() | (F.col("_first") - prev > gap_us), F.col("_first")))
    d = d.withColumn("_session", F.max("_start_here").over(
        in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return (d.groupBy("word", "_session")
            .agg(F.sum("_n").cast("bigint").alias("count_sum"), F.max("_last").alias("_end"))
            .select("word",
                    F.timestamp_micros("_session").alias("session_start"),
                    F.timestamp_micros(F.col("_end") + gap_us).alias("session_end"),
                    "count_sum"))


def word_sessions_stream(lines: DataFrame, gap_seconds: int = DEFAULT_GAP_SECONDS,
                         time_col: str = "timestamp",
                         watermark: str = "0 seconds") -> DataFrame:
    """Streaming sessions: Spark's ``session_window`` behind a watermark.
    A session is emitted (append mode) once the watermark passes its end.
    Rows are merged into sessions inside each map partition before the
    shuffle, so a frequent word ships sessions, not rows."""
    lines.sparkSession.conf.set(
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    d = lines.withColumn("_t", F.col(time_col).cast("timestamp")).withWatermark("_t", watermark)
    pairs = d.select(F.explode(tokens("value")).alias("word"), F.lit(1).alias("one"), "_t")
    return (pairs.groupBy(F.session_window("_t", f"{gap_seconds} seconds").alias("s"), "word")
            .agg(F.sum("one").cast("bigint").alias("count_sum"))
            .select("word", F.col("s.start").alias("session_start"),
                    F.col("s.end").alias("session_end"), "count_sum"))
