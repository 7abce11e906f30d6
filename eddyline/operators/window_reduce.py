"""Keyed event-time window reduces.

``count_window_reduce``: per key and tumbling window, the sum of counts and
the list of event times.  ``access_window_reduce``: per ``(url, response)``
and window, the sum of counts, the first row's method and code, the halving
average and the mean of the latency, and the event times with latency notes.

The reduce of the reference depends on arrival order; Spark has none after a
shuffle, so rows are ordered by ``(seq, partition)`` explicitly.  The sums,
the mean and the first row are partial aggregates combined map-side; only the
``times`` list (which is itself output) needs a group's rows together.

``times_mode="clean"`` formats every time.  ``times_mode="compat"``
reproduces the reference's text exactly: a window with one row keeps its raw
epoch text and no note; in a longer window the first time is formatted only
if its raw text contains ``000``.  ``times_mode="none"`` leaves the list out:
no window's rows are then brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.functions.fold import fold_runs, halving_average, signed_run
from eddyline.operators.scan import ordinal, seq_bucket
from eddyline.functions.text import strict_long
from eddyline.functions.timefmt import fmt_epoch_ms, took_note, valid_epoch_ms

DEFAULT_WINDOW = "30 seconds"
# Arrival positions per first-level group.  seq is a per-partition offset, so
# a group holds at most this many rows per source partition.
STATS_BUCKET = 1 << 12
# Fixed value: the reference formats a first time only if its text has "000".
COMPAT_MARK = "000"


def _fmt_text(text: Column) -> Column:
    """Formatted time of epoch-ms text; text that is not a number stays."""
    return F.coalesce(fmt_epoch_ms(valid_epoch_ms(strict_long(text))), text)


def _times(rows: Column, mode: str, note: bool) -> Column:
    n = F.size(rows)

    def entry(r, i):
        text = r["time_text"]
        clean = _fmt_text(text)
        if mode == "clean":
            out = clean
        elif mode == "compat":
            first = F.when(text.contains(COMPAT_MARK), clean).otherwise(text)
            out = F.when(i == 0, first).otherwise(clean)
        else:
            raise ValueError("times_mode must be 'clean' or 'compat'")
        if note:
            out = took_note(out, r["took_ms"])
        if mode == "compat":
            out = F.when(n == 1, text).otherwise(out)
        return out

    return F.transform(rows, entry)


def _windowed(rows: DataFrame, window: str, watermark: str | None) -> tuple[DataFrame, Column]:
    d = rows
    if watermark is not None:
        d = d.withWatermark("event_time", watermark)
    return d, F.window("event_time", window).alias("w")


def count_window_reduce(rows: DataFrame, window: str = DEFAULT_WINDOW,
                        times_mode: str = "clean",
                        watermark: str | None = None) -> DataFrame:
    """Per key and window: ``count`` (sum) and ``times`` (array, arrival order).
    ``rows`` are parsed count lines (``parse_count_lines(...).rows``)."""
    d, w = _windowed(rows, window, watermark)
    if times_mode == "none":
        return (d.groupBy(w, "key").agg(F.sum("count").cast("bigint").alias("count"))
                .select("key", F.col("w.start").alias("window_start"),
                        F.col("w.end").alias("window_end"), "count"))
    g = d.groupBy(w, "key").agg(
        F.sum("count").cast("bigint").alias("count"),
        F.sort_array(F.collect_list(F.struct("seq", "partition", "time_text"))).alias("_rows"))
    return g.select(
        "key", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "count", _times(F.col("_rows"), times_mode, note=False).alias("times"))


def access_window_reduce(rows: DataFrame, window: str = DEFAULT_WINDOW,
                         times_mode: str = "clean",
                         watermark: str | None = None) -> DataFrame:
    """Per ``(url, response)`` and window: ``count``, first ``method`` and
    ``code``, ``response_time_avg`` (halving average, later rows weigh more),
    ``response_time_mean`` and ``times`` with latency notes.
    ``rows`` are parsed access lines (``parse_access_lines(...).rows``)."""
    if times_mode == "none":
        return access_window_stats(rows, window, watermark=watermark)
    d, w = _windowed(rows, window, watermark)
    order = F.struct("seq", "partition")
    g = d.groupBy(w, "url", "response").agg(
        F.sum("count").cast("bigint").alias("count"),
        F.min_by(F.struct("method", "code"), order).alias("_first"),
        F.avg("took_ms").alias("response_time_mean"),
        F.sort_array(F.collect_list(
            F.struct("seq", "partition", "time_text", "took_ms"))).alias("_rows"))
    return g.select(
        "url", "response", F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        F.col("_first.method").alias("method"), F.col("_first.code").alias("code"),
        "count",
        halving_average(F.transform("_rows", lambda r: r["took_ms"])).alias("response_time_avg"),
        "response_time_mean",
        _times(F.col("_rows"), times_mode, note=True).alias("times"))


def access_window_stats(rows: DataFrame, window: str = DEFAULT_WINDOW,
                        bucket_width: int = STATS_BUCKET,
                        watermark: str | None = None) -> DataFrame:
    """``access_window_reduce`` without the ``times`` list: every output is
    computed without bringing a window's rows together, on static frames and
    on streams (give ``watermark``).

    Level one groups ``(window, url, response, seq bucket)``: partial sums,
    the first row, and the halving fold of the bucket's latencies as a few
    values and a composable map (``signed_run``; bounded by the bucket
    width).  Level two combines the
    buckets of a window in order; it groups by the window of the level-one
    window's time, which on a stream chains the two stateful aggregations
    through the watermark.  A window holding a third of all rows is spread
    over its buckets.  Latencies may have any sign: of a bucket, the values up
    to 32 past its last negative one reach level two, all others as one map.
    A stream needs
    ``spark.sql.streaming.statefulOperator.allowMultiple=true`` (the default).
    """
    d = rows if watermark is None else rows.withWatermark("event_time", watermark)
    order = F.struct("seq", "partition")
    keys = ["url", "response"]
    lvl1 = (d.groupBy(F.window("event_time", window).alias("w"), *keys,
                      seq_bucket("seq", bucket_width).alias("_b"))
            .agg(F.sum("count").cast("bigint").alias("count"),
                 F.count("*").alias("_n"), F.sum("took_ms").cast("bigint").alias("_took"),
                 F.min_by(F.struct("method", "code", "took_ms"), order).alias("_first"),
                 F.min(order).alias("_first_at"),
                 F.sort_array(F.collect_list(F.struct("seq", "partition", "took_ms")))
                 .alias("_rows"))
            .select("w", *keys, "_b", "count", "_n", "_took", "_first", "_first_at",
                    signed_run(F.transform("_rows", lambda r: r["took_ms"])).alias("_run")))
    g = lvl1.groupBy(F.window(F.window_time("w"), window).alias("w"), *keys).agg(
        F.sum("count").cast("bigint").alias("count"), F.sum("_n").alias("_n"),
        F.sum("_took").alias("_took"), F.min_by("_first", "_first_at").alias("_first"),
        F.sort_array(F.collect_list(F.struct("_b", "_run"))).alias("_runs"))
    avg = fold_runs(F.transform("_runs", lambda r: r["_run"]), F.col("_first.took_ms"))
    return g.select(
        *keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        F.col("_first.method").alias("method"), F.col("_first.code").alias("code"), "count",
        avg.alias("response_time_avg"),
        (F.col("_took") / F.col("_n")).alias("response_time_mean"))


def _positions(rows: DataFrame, keys: list[str], window: str, bucket_width: int) -> DataFrame:
    d = rows.withColumn("_w", F.window("event_time", window))
    d = d.withColumn("window_start", F.col("_w.start")).withColumn("window_end", F.col("_w.end")).drop("_w")
    d = ordinal(d, [*keys, "window_start"], ["seq", "partition"], "_n", seq_bucket("seq", bucket_width))
    return d.withColumn("position", F.col("_n") - 1)


def count_window_times(rows: DataFrame, window: str = DEFAULT_WINDOW,
                       bucket_width: int = STATS_BUCKET) -> DataFrame:
    """The ``times`` of :func:`count_window_reduce` as rows: ``key, window_start, window_end,
    position`` (from 0, arrival order) and ``time``.  No window's rows meet in one task: positions
    come from the bucketed running count."""
    d = _positions(rows, ["key"], window, bucket_width)
    return d.select("key", "window_start", "window_end", "position", _fmt_text(F.col("time_text")).alias("time"))


def access_window_times(rows: DataFrame, window: str = DEFAULT_WINDOW,
                        bucket_width: int = STATS_BUCKET) -> DataFrame:
    """The ``times`` of :func:`access_window_reduce` as rows, with their latency notes, beside
    the scalar rows of :func:`access_window_stats`."""
    d = _positions(rows, ["url", "response"], window, bucket_width)
    return d.select("url", "response", "window_start", "window_end", "position", noted_time().alias("time"))


def noted_time(text: str = "time_text", took: str = "took_ms") -> Column:
    """An event time's display text with its latency note."""
    return took_note(_fmt_text(F.col(text)), F.col(took))
