"""Named queries: each reads the given tables (or a stream over them),
derives the reference's messages and runs the reference's job on them.

Every callable takes ``(spark, sf_dir)`` and returns a static DataFrame.
Streaming queries run to completion (available-now trigger) into a folder
under the shared checkpoint folder and return the written result.
Output columns are flat: window bounds as epoch milliseconds, lists as
``|``-joined text (the reference's own reduce state), means rounded to 6
places, so the same names and values come out of the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.operators import (
    access_window_reduce, access_window_stats, access_window_times, as_table, average_pending, char_counts,
    chunk_rows, chunk_state, count_average, count_window_reduce, count_window_times, mark_late,
    parse_access_lines, parse_count_lines, parse_first_three, parse_orders, prefix_chars, prefix_lines,
    sql_filter, union_all_filtered, word_count, word_pairs, word_sessions,
)
from eddyline.operators.window_reduce import noted_time
from eddyline.operators.words import word_count_window, word_sessions_stream
from eddyline.session import prepare_session, settings_for_start
from eddyline.streaming import (
    access_window_timers, chunk_rows_stream, count_average_stream, mark_late_stream, pending_averages,
    pending_chunks, run_available_now, run_until_idle, stream_dir, word_clock_windows,
)
from eddyline.sinks import write_lines
from eddyline.sinks import access_documents, count_documents, object_documents, word_documents
from eddyline import sources
from eddyline.sources import (
    access_lines, arrival_lines, arrival_order, count_lines, event_lines, keyed_pairs, named_pairs,
    order_lines, read_log, text_lines,
)



def read_table(spark, sf_dir, name, **kw):
    """The given tables are single small files here: their rows are dealt over
    the task slots before the per-row work."""
    return sources.read_table(spark, sf_dir, name, spread_small=True, **kw)


# Fixed value: the separator of the reference's time list text.
TIMES_SEPARATOR = "|"
REFERENCE_WINDOW = "30 seconds"   # the reference's tumbling window
LONG_WINDOW = "6 hours"           # same job with fuller windows
SESSION_GAP_SECONDS = 600         # the reference's session gap
COUNT_AVERAGE_N = 2               # the reference's count threshold
CHUNK_N = 8                       # rows per released chunk


def _ms(c: str) -> F.Column:
    return F.unix_millis(F.col(c)).alias(f"{c}_ms")


def _flat_access(df: DataFrame) -> DataFrame:
    return df.select(
        "url", "response", _ms("window_start"), _ms("window_end"), "method", "code",
        "count", "response_time_avg",
        F.round("response_time_mean", 6).alias("response_time_mean"),
        F.array_join("times", TIMES_SEPARATOR).alias("times"))


def _flat_count(df: DataFrame) -> DataFrame:
    return df.select("key", _ms("window_start"), _ms("window_end"), "count",
                     F.array_join("times", TIMES_SEPARATOR).alias("times"))


def _access(spark: SparkSession, sf_dir: str, window: str, mode: str) -> DataFrame:
    prepare_session(spark)
    rows = parse_access_lines(access_lines(read_table(spark, sf_dir, "events"))).rows
    return _flat_access(access_window_reduce(rows, window, mode))


def _count(spark: SparkSession, sf_dir: str, window: str, mode: str) -> DataFrame:
    prepare_session(spark)
    rows = parse_count_lines(count_lines(read_table(spark, sf_dir, "events"))).rows
    return _flat_count(count_window_reduce(rows, window, mode))


def access_window_reduce_q(spark, sf_dir):
    return _access(spark, sf_dir, REFERENCE_WINDOW, "clean")


def access_window_reduce_6h(spark, sf_dir):
    return _access(spark, sf_dir, LONG_WINDOW, "clean")


def access_window_reduce_compat(spark, sf_dir):
    return _access(spark, sf_dir, LONG_WINDOW, "compat")


def _flat_stats(df: DataFrame) -> DataFrame:
    return df.select(
        "url", "response", _ms("window_start"), _ms("window_end"), "method", "code",
        "count", "response_time_avg",
        F.round("response_time_mean", 6).alias("response_time_mean"))


def _stats(spark, sf_dir, window):
    prepare_session(spark)
    rows = parse_access_lines(access_lines(read_table(spark, sf_dir, "events"))).rows
    return _flat_stats(access_window_stats(rows, window))


def access_window_stats_q(spark, sf_dir):
    """The flagship's scalar outputs, with no group's rows brought together."""
    return _stats(spark, sf_dir, REFERENCE_WINDOW)


def access_window_stats_6h(spark, sf_dir):
    return _stats(spark, sf_dir, LONG_WINDOW)


def count_window_totals(spark, sf_dir):
    """Counts per key and 30 s window without the time list: a pure partial
    aggregate, no window's rows brought together."""
    prepare_session(spark)
    rows = parse_count_lines(count_lines(read_table(spark, sf_dir, "events"))).rows
    out = count_window_reduce(rows, REFERENCE_WINDOW, "none")
    return out.select("key", _ms("window_start"), _ms("window_end"), "count")


def count_window_reduce_q(spark, sf_dir):
    return _count(spark, sf_dir, REFERENCE_WINDOW, "clean")


def count_window_reduce_6h(spark, sf_dir):
    return _count(spark, sf_dir, LONG_WINDOW, "clean")


def count_window_reduce_compat(spark, sf_dir):
    return _count(spark, sf_dir, LONG_WINDOW, "compat")


def _us(c: str) -> F.Column:
    return F.unix_micros(F.col(c)).alias(f"{c}_us")


def word_count_q(spark, sf_dir):
    """Words of every document, counted."""
    return word_count(text_lines(read_table(spark, sf_dir, "documents")))


def word_sessions_q(spark, sf_dir):
    """Words of event lines per 10 minute event-time session."""
    prepare_session(spark)
    lines = event_lines(read_table(spark, sf_dir, "events"))
    s = word_sessions(lines, SESSION_GAP_SECONDS)
    return s.select("word", _us("session_start"), _us("session_end"), "count_sum")


def _count_parsed(spark, sf_dir):
    prepare_session(spark)
    return parse_count_lines(count_lines(read_table(spark, sf_dir, "events")))


def parse_rejects(spark, sf_dir):
    """Count lines that cannot be used, with the reason."""
    return _count_parsed(spark, sf_dir).rejects


def first_three_fields(spark, sf_dir):
    prepare_session(spark)
    return parse_first_three(count_lines(read_table(spark, sf_dir, "events")))


def _orders(spark, sf_dir, streaming=False):
    src = read_table(spark, sf_dir, "orders", streaming=streaming)
    return as_table(parse_orders(order_lines(src)).rows)


def orders_big(spark, sf_dir):
    return sql_filter(_orders(spark, sf_dir), "amount > 300")


def orders_small(spark, sf_dir):
    return sql_filter(_orders(spark, sf_dir), "amount < 2")


def orders_union(spark, sf_dir):
    """The same topic read twice: big-ish orders from one reading, small
    ones from the other, UNION ALL (planned as one scan)."""
    return union_all_filtered(_orders(spark, sf_dir), _orders(spark, sf_dir))


def prefix_lines_q(spark, sf_dir):
    prepare_session(spark)
    return prefix_lines(count_lines(read_table(spark, sf_dir, "events")))


def prefix_chars_q(spark, sf_dir):
    """Characters of every prefixed line, counted."""
    prepare_session(spark)
    return char_counts(count_lines(read_table(spark, sf_dir, "events")))


def count_average_q(spark, sf_dir):
    return count_average(keyed_pairs(read_table(spark, sf_dir, "events")), COUNT_AVERAGE_N)


def chunk_rows_q(spark, sf_dir):
    return chunk_rows(named_pairs(read_table(spark, sf_dir, "events")), CHUNK_N).full


def chunk_pending(spark, sf_dir):
    """The rows that the buffered sink still holds."""
    return chunk_rows(named_pairs(read_table(spark, sf_dir, "events")), CHUNK_N).pending


def _damaged_access(spark, sf_dir):
    prepare_session(spark)
    return parse_access_lines(access_lines(read_table(spark, sf_dir, "events"), damaged=True))


def access_rejects(spark, sf_dir):
    """Access lines that cannot be used, with the reason."""
    return _damaged_access(spark, sf_dir).rejects


def access_window_stats_mixed(spark, sf_dir):
    """Latencies of both signs among damaged lines, 6 hour windows, list-free."""
    return _flat_stats(access_window_stats(_damaged_access(spark, sf_dir).rows, LONG_WINDOW))


def _damaged_orders(spark, sf_dir):
    return parse_orders(order_lines(read_table(spark, sf_dir, "orders"), damaged=True))


def order_rejects(spark, sf_dir):
    """Order messages that cannot be used, with the reason."""
    return _damaged_orders(spark, sf_dir).rejects


def order_docs_damaged(spark, sf_dir):
    """Documents of all usable orders among damaged messages, null fields kept."""
    return object_documents(as_table(_damaged_orders(spark, sf_dir).rows))


def _flat_windows(df: DataFrame) -> DataFrame:
    return df.select("word", _ms("window_start"), _ms("window_end"), "count_sum")


def word_windows(spark, sf_dir):
    """Words of event lines per 30 s event-time window."""
    prepare_session(spark)
    lines = event_lines(read_table(spark, sf_dir, "events"))
    return _flat_windows(word_count_window(lines, REFERENCE_WINDOW))


def late_split(spark, sf_dir):
    """Per-record lateness of jittered arrivals, 6 hour windows."""
    prepare_session(spark)
    d = mark_late(arrival_order(read_table(spark, sf_dir, "events")), LONG_WINDOW)
    return d.select("event_id", "seq", "partition", _ms("window_start"), "watermark_ms", "late")


def word_docs(spark, sf_dir):
    return word_documents(word_count_q(spark, sf_dir))


def _count_reduced(spark, sf_dir):
    rows = _count_parsed(spark, sf_dir).rows
    return count_window_reduce(rows, LONG_WINDOW, "clean")


def count_docs(spark, sf_dir):
    return count_documents(_count_reduced(spark, sf_dir))


def access_docs(spark, sf_dir):
    prepare_session(spark)
    rows = parse_access_lines(access_lines(read_table(spark, sf_dir, "events"))).rows
    return access_documents(access_window_reduce(rows, LONG_WINDOW, "clean"))


def order_docs(spark, sf_dir):
    return object_documents(orders_big(spark, sf_dir))


# ---- streaming twins: run to completion, return what the sink committed ----

ZERO_DELAY = "0 seconds"          # punctuated watermark: each row's own time
# Chained stateful aggregations need this (Spark's default).
CHAINED = {"spark.sql.streaming.statefulOperator.allowMultiple": "true"}


def _events_stream(spark, sf_dir):
    prepare_session(spark)
    return read_table(spark, sf_dir, "events", streaming=True)


def access_window_reduce_stream(spark, sf_dir):
    """Flagship as a stream: windows are emitted once the watermark passes
    their end; the last open window of a finite stream stays in state."""
    rows = parse_access_lines(access_lines(_events_stream(spark, sf_dir))).rows
    res = access_window_reduce(rows, REFERENCE_WINDOW, "clean", watermark=ZERO_DELAY)
    return _flat_access(run_available_now(res, "access_window_reduce_stream"))


def access_window_stats_stream(spark, sf_dir):
    """The list-free flagship as a stream: two chained stateful aggregations."""
    rows = parse_access_lines(access_lines(_events_stream(spark, sf_dir))).rows
    res = access_window_stats(rows, REFERENCE_WINDOW, watermark=ZERO_DELAY)
    return _flat_stats(run_available_now(res, "access_window_stats_stream", settings=CHAINED))


def access_window_stats_mixed_stream(spark, sf_dir):
    """Latencies of both signs among damaged lines, as a stream."""
    rows = parse_access_lines(access_lines(_events_stream(spark, sf_dir), damaged=True)).rows
    res = access_window_stats(rows, LONG_WINDOW, watermark=ZERO_DELAY)
    return _flat_stats(run_available_now(res, "access_window_stats_mixed_stream", settings=CHAINED))


def word_windows_stream(spark, sf_dir):
    """Event-time word windows as a stream: those that the watermark has closed."""
    res = word_count_window(event_lines(_events_stream(spark, sf_dir)), REFERENCE_WINDOW,
                            watermark=ZERO_DELAY)
    return _flat_windows(run_available_now(res, "word_windows_stream"))


def count_window_reduce_stream(spark, sf_dir):
    rows = parse_count_lines(count_lines(_events_stream(spark, sf_dir))).rows
    res = count_window_reduce(rows, REFERENCE_WINDOW, "clean", watermark=ZERO_DELAY)
    return _flat_count(run_available_now(res, "count_window_reduce_stream"))


def word_sessions_stream_q(spark, sf_dir):
    lines = event_lines(_events_stream(spark, sf_dir))
    res = word_sessions_stream(lines, SESSION_GAP_SECONDS, watermark=ZERO_DELAY)
    out = run_available_now(res, "word_sessions_stream")
    return out.select("word", _us("session_start"), _us("session_end"), "count_sum")


def word_count_stream(spark, sf_dir):
    """Processing-time 30 s windows over a document stream (complete mode).  The
    windows themselves hang on the clock, so a word's sum over them is returned
    and whether all of them start on a multiple of 30 s and last 30 s."""
    prepare_session(spark)
    docs = read_table(spark, sf_dir, "documents", streaming=True)
    res = word_count_window(text_lines(docs), REFERENCE_WINDOW, time="processing")
    out = run_available_now(res, "word_count_stream", output_mode="complete")
    start, end = F.unix_millis("window_start"), F.unix_millis("window_end")
    return out.groupBy("word").agg(
        F.sum("count_sum").cast("bigint").alias("count_sum"),
        F.bool_and((F.pmod(start, F.lit(30_000)) == 0) & (end - start == 30_000)).alias("windows_aligned"))


def orders_union_stream(spark, sf_dir):
    """UNION ALL of two streams over one topic."""
    res = union_all_filtered(_orders(spark, sf_dir, True), _orders(spark, sf_dir, True))
    return run_available_now(res, "orders_union_stream")


def count_average_stream_q(spark, sf_dir):
    pairs = keyed_pairs(_events_stream(spark, sf_dir))
    return run_available_now(count_average_stream(pairs, COUNT_AVERAGE_N), "count_average_stream")


def chunk_rows_stream_q(spark, sf_dir):
    rows = named_pairs(_events_stream(spark, sf_dir))
    return run_available_now(chunk_rows_stream(rows, CHUNK_N), "chunk_rows_stream")


LATE_RANGES = 10   # files, and so micro-batches, of the jittered arrivals


def late_rows_stream(spark, sf_dir):
    """Events in their jittered arrival order, streamed from ten consecutive files, a
    micro-batch each, and counted per 6 hour window behind a zero-delay watermark.
    A row is dropped when its window was already closed by the watermark of
    the earlier batches (the reference's rule, per micro-batch)."""
    prepare_session(spark)
    rows = arrival_order(read_table(spark, sf_dir, "events"))
    folder = f"{stream_dir(spark, 'late_rows_stream')}/in"
    lo, hi = rows.agg(F.min("seq"), F.max("seq")).first()
    step = (hi - lo) // LATE_RANGES + 1
    for i in range(LATE_RANGES):        # one after the other: files are taken by their time
        rows.where(F.col("seq").between(lo + i * step, lo + (i + 1) * step - 1)).coalesce(1).write.mode(
            "append").parquet(folder)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    counts = (stream.withWatermark("ts", ZERO_DELAY)
              .groupBy(F.window("ts", LONG_WINDOW).alias("w")).agg(F.count("*").alias("n")))
    # late rows filtered with the current batch's watermark
    out = run_available_now(counts, "late_rows_stream",
                            settings={"spark.sql.streaming.statefulOperator.allowMultiple": "false"})
    return out.select(F.unix_millis("w.start").alias("window_start_ms"),
                      F.unix_millis("w.end").alias("window_end_ms"), "n")


# ---- a log of lines with offsets: per-record watermarks, partitions, restarts ----

LOG_BATCHES = 4     # a log is streamed in about so many micro-batches


def _write_log(lines, folder, *tie):
    """A log folder: one append-only file per source partition, lines in order of ``seq``.
    Returns the bytes written."""
    (lines.repartition("partition").sortWithinPartitions("partition", "seq", *tie)
     .select("value", "partition").write.partitionBy("partition").text(folder))
    return lines.agg(F.sum(F.octet_length("value") + 1)).first()[0] or 1


def log_restart_stream(spark, sf_dir):
    """Count lines read from a log in bounded micro-batches by a query that is stopped after
    its first one and started again: every line once, with its partition and offset."""
    base = stream_dir(spark, "log_restart_stream")
    size = _write_log(count_lines(read_table(spark, sf_dir, "events")), f"{base}/in")
    lines = lambda: read_log(spark, f"{base}/in", checkpoint=f"{base}/checkpoint",
                             max_bytes=size // LOG_BATCHES + 1).select("partition", "seq", "value")
    where = {"out": f"{base}/out", "checkpoint": f"{base}/checkpoint"}
    run_available_now(lines(), "log_restart_stream", **where)      # one bounded micro-batch
    return run_until_idle(lines(), "log_restart_stream", **where)


def log_from_offsets_stream(spark, sf_dir):
    """The same log, read by a new query from the middle byte of every partition on."""
    import json
    base = stream_dir(spark, "log_from_offsets_stream")
    _write_log(count_lines(read_table(spark, sf_dir, "events")), f"{base}/in")
    files = (spark.read.option("recursiveFileLookup", "true").format("binaryFile").load(f"{base}/in")
             .select("path", "length").collect())                  # one file per partition
    start = {"/".join(f["path"].split("/")[-2:]): f["length"] // 2 for f in files}
    lines = read_log(spark, f"{base}/in", startingOffsets=json.dumps(start))
    return run_available_now(lines.select("partition", "seq", "value"), "log_from_offsets_stream")


def _arrivals(lines):
    """Parsed :func:`arrival_lines`."""
    f = F.split("value", ",")
    return lines.select(f[0].cast("bigint").alias("event_id"), F.timestamp_micros(f[2].cast("bigint")).alias("ts"),
                        f[1].cast("bigint").alias("seq"), "partition")


def late_split_stream(spark, sf_dir):
    """:func:`late_split` on a stream: jittered arrivals from a log, several micro-batches, a
    per-record watermark per source partition kept in state."""
    prepare_session(spark)
    base = stream_dir(spark, "late_split_stream")
    size = _write_log(arrival_lines(read_table(spark, sf_dir, "events")), f"{base}/in", "event_id")
    rows = _arrivals(read_log(spark, f"{base}/in", checkpoint=f"{base}/checkpoint",
                              max_bytes=size // LOG_BATCHES + 1))
    out = run_until_idle(mark_late_stream(rows, LONG_WINDOW), "late_split_stream", out=f"{base}/out",
                         checkpoint=f"{base}/checkpoint")
    return out.select("event_id", "seq", "partition", "window_start_ms", "watermark_ms", "late")


def slow_partition_windows_stream(spark, sf_dir):
    """Events per 6 hour window from a log whose partitions are read at different speeds,
    partition 0 in one micro-batch and the last in many.  Each partition is a stream with a watermark
    of its own; the union's watermark is their minimum, so the fast ones make no row of a slow one late."""
    prepare_session(spark)
    base = stream_dir(spark, "slow_partition_windows_stream")
    events = read_table(spark, sf_dir, "events")
    lines = events.select(F.unix_micros(F.col("ts").cast("timestamp")).cast("string").alias("value"), F.col("event_id").alias("seq"),
                          (F.col("user_id") % sources.derive.SOURCE_PARTITIONS).cast("int").alias("partition"))
    size = _write_log(lines, f"{base}/in")
    union = None
    for p in range(sources.derive.SOURCE_PARTITIONS):
        one = read_log(spark, f"{base}/in/partition={p}", checkpoint=f"{base}/checkpoint",
                       max_bytes=size // (1 + 2 * p) + 1)
        one = one.select(F.timestamp_micros(F.col("value").cast("bigint")).alias("ts")).withWatermark("ts", ZERO_DELAY)
        union = one if union is None else union.unionByName(one)
    counts = union.groupBy(F.window("ts", LONG_WINDOW).alias("w")).agg(F.count("*").alias("n"))
    out = run_until_idle(counts, "slow_partition_windows_stream", out=f"{base}/out", checkpoint=f"{base}/checkpoint",
                         settings={"spark.sql.streaming.multipleWatermarkPolicy": "min"})
    return out.select(F.unix_millis("w.start").alias("window_start_ms"),
                      F.unix_millis("w.end").alias("window_end_ms"), "n")


# ---- windows by timers, times as rows ----

def access_window_times_q(spark, sf_dir):
    """The flagship's time list as rows, no group's rows brought together."""
    prepare_session(spark)
    rows = parse_access_lines(access_lines(read_table(spark, sf_dir, "events"))).rows
    return access_window_times(rows, REFERENCE_WINDOW).select(
        "url", "response", _ms("window_start"), _ms("window_end"), "position", "time")


def count_window_times_6h(spark, sf_dir):
    prepare_session(spark)
    rows = parse_count_lines(count_lines(read_table(spark, sf_dir, "events"))).rows
    return count_window_times(rows, LONG_WINDOW).select(
        "key", _ms("window_start"), _ms("window_end"), "position", "time")


def _timers(spark, sf_dir, name, times):
    rows = parse_access_lines(access_lines(_events_stream(spark, sf_dir))).rows
    return run_available_now(access_window_timers(rows, REFERENCE_WINDOW, ZERO_DELAY, times), name)


def access_window_timers_stream(spark, sf_dir):
    """The flagship's scalars as a stream with one state tuple per window, closed by timers."""
    out = _timers(spark, sf_dir, "access_window_timers_stream", False).where("kind = 'window'")
    return out.select("url", "response", "window_start_ms", "window_end_ms", "method", "code", "count",
                      "response_time_avg", F.round("response_time_mean", 6).alias("response_time_mean"))


def access_window_times_stream(spark, sf_dir):
    """The times of the same stream, each written once with its position in its window."""
    out = _timers(spark, sf_dir, "access_window_times_stream", True).where("kind = 'time'")
    return out.select("url", "response", "window_start_ms", "window_end_ms", "position",
                      noted_time().alias("time"))


CLOCK_WINDOW = "5 seconds"


def word_clock_windows_stream(spark, sf_dir):
    """Words of a document stream per processing-time window, in append mode: windows leave when the
    clock passes their end, and the query ends when no state is left.  The windows hang
    on the clock, so a word's sum is returned and whether all windows are aligned."""
    prepare_session(spark)
    words = word_pairs(text_lines(read_table(spark, sf_dir, "documents", streaming=True)))
    out = run_until_idle(word_clock_windows(words, CLOCK_WINDOW), "word_clock_windows_stream", trigger="1 second",
                         until_state_empty=True)
    width = F.col("window_end_ms") - F.col("window_start_ms")
    return out.groupBy("word").agg(
        F.sum("count_sum").cast("bigint").alias("count_sum"),
        F.bool_and((F.pmod("window_start_ms", F.lit(5000)) == 0) & (width == 5000)).alias("windows_aligned"))


# ---- keyed state: nulls, reading it back, starting from a batch ----

def count_average_nulls(spark, sf_dir):
    """Averages where some keys and values are null."""
    return count_average(keyed_pairs(read_table(spark, sf_dir, "events"), damaged=True), COUNT_AVERAGE_N)


def count_average_nulls_stream(spark, sf_dir):
    pairs = keyed_pairs(_events_stream(spark, sf_dir), damaged=True)
    return run_available_now(count_average_stream(pairs, COUNT_AVERAGE_N), "count_average_nulls_stream")


def chunk_rows_nulls(spark, sf_dir):
    """Chunks where some buckets and values are null."""
    return chunk_rows(named_pairs(read_table(spark, sf_dir, "events"), damaged=True), CHUNK_N).full


def chunk_rows_nulls_stream(spark, sf_dir):
    rows = named_pairs(_events_stream(spark, sf_dir), damaged=True)
    return run_available_now(chunk_rows_stream(rows, CHUNK_N), "chunk_rows_nulls_stream")


STATE_N = 3     # with three to a group, a key can hold one value or two


def count_average_pending(spark, sf_dir):
    """What every key's last, incomplete group holds."""
    return average_pending(keyed_pairs(read_table(spark, sf_dir, "events"), damaged=True), STATE_N)


def count_average_pending_state(spark, sf_dir):
    """The same, read from the state of the stream's checkpoint."""
    ck = f"{stream_dir(spark, 'count_average_pending_state')}/checkpoint"
    pairs = keyed_pairs(_events_stream(spark, sf_dir), damaged=True)
    run_available_now(count_average_stream(pairs, STATE_N), "count_average_pending_state", checkpoint=ck)
    return pending_averages(spark, ck)


def chunk_pending_state(spark, sf_dir):
    """The rows that the streamed sink still buffers, read from its checkpoint."""
    ck = f"{stream_dir(spark, 'chunk_pending_state')}/checkpoint"
    rows = named_pairs(_events_stream(spark, sf_dir), damaged=True)
    run_available_now(chunk_rows_stream(rows, CHUNK_N), "chunk_pending_state", checkpoint=ck)
    return pending_chunks(spark, ck)


def _halves(spark, sf_dir):
    """The earlier events as a static frame and the later ones as a stream."""
    rows = read_table(spark, sf_dir, "events")
    middle = (rows.agg(F.max("event_id")).first()[0] or 0) // 2
    return (rows.where(F.col("event_id") <= middle),
            _events_stream(spark, sf_dir).where(F.col("event_id") > middle))


def count_average_resumed_stream(spark, sf_dir):
    """Averages of a static first half and of a stream that starts from what it left pending."""
    first, later = _halves(spark, sf_dir)
    first = keyed_pairs(first, damaged=True)
    done = count_average(first, STATE_N)
    out = run_available_now(count_average_stream(keyed_pairs(later, damaged=True), STATE_N,
                                                 initial=average_pending(first, STATE_N)),
                            "count_average_resumed_stream")
    return done.unionByName(out)


def chunk_rows_resumed_stream(spark, sf_dir):
    """Chunks of a static first half and of a stream that starts from its buffered rows."""
    first, later = _halves(spark, sf_dir)
    done = chunk_rows(named_pairs(first, damaged=True), CHUNK_N)
    out = run_available_now(chunk_rows_stream(named_pairs(later, damaged=True), CHUNK_N, initial=chunk_state(done)),
                            "chunk_rows_resumed_stream")
    return done.full.select(*out.columns).unionByName(out)


def prefix_char_rows(spark, sf_dir):
    """The characters of every prefixed line as rows, with their positions."""
    prepare_session(spark)
    return prefix_chars(count_lines(read_table(spark, sf_dir, "events")))


# ---- the reference's jobs end to end: lines -> job -> document index ----

LINES_OF_A_FILE = 250_000   # a job's task reads one such file (jobs.READ_SETTINGS)


def _parquet_lines(lines, folder):
    with settings_for_start(lines.sparkSession, {"spark.sql.files.maxRecordsPerFile": LINES_OF_A_FILE}):
        write_lines(lines, folder)
    return "parquet"


def _text_lines_by_url(lines, folder):
    """Text files in arrival order, all lines of a URL in one of them."""
    url = F.substring_index("value", ",", 1)
    lines.repartition(url).sortWithinPartitions("seq", "partition").select("value").write.text(folder)
    return "text"


def _job_docs(spark, sf_dir, name, table, derive, job, index, lay=_parquet_lines):
    """Documents that the job wrote to ``index``; the job writes both its sinks."""
    from eddyline.plans import jobs
    prepare_session(spark)
    base = stream_dir(spark, name)
    fmt = lay(derive(read_table(spark, sf_dir, table)), f"{base}/lines")
    slots = spark.sparkContext.defaultParallelism      # state partitions: one per slot
    with settings_for_start(spark, jobs.READ_SETTINGS):
        with settings_for_start(spark, {"spark.sql.shuffle.partitions": slots}):
            q = getattr(jobs, job)(spark, f"{base}/lines", f"{base}/index", f"{base}/checkpoint",
                                   fmt=fmt, available_now=True)
        q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema("value STRING").text(f"{base}/index/{index}").select(
        F.col("value").alias("doc"))


def access_job_docs(spark, sf_dir):
    """Access lines written as message files, the access job reading them as a
    stream, and the documents it indexed."""
    return _job_docs(spark, sf_dir, "access_job", "events", access_lines,
                     "access_reduce_job", "access-result")


def access_text_job_docs(spark, sf_dir):
    """The access job over streamed text files: lines in file order."""
    return _job_docs(spark, sf_dir, "access_text_job", "events", access_lines,
                     "access_reduce_job", "access-result", _text_lines_by_url)


def order_job_print(spark, sf_dir):
    """The printout of the order job: every document, beside the index."""
    return _job_docs(spark, sf_dir, "order_job", "orders", order_lines,
                     "orders_filter_job", "order-result-print")


def order_job_docs(spark, sf_dir):
    """Order messages through the SQL filter job into the order index."""
    return _job_docs(spark, sf_dir, "order_job", "orders", order_lines,
                     "orders_filter_job", "order-result")


def count_job_docs(spark, sf_dir):
    """Count lines (with damaged ones) through the count job."""
    return _job_docs(spark, sf_dir, "count_job", "events", count_lines,
                     "count_reduce_job", "count-result")


def word_session_job_docs(spark, sf_dir):
    """Event lines through the word-session job."""
    return _job_docs(spark, sf_dir, "session_job", "events", event_lines,
                     "word_session_job", "word-result-session")


STREAM_QUERIES = {
    "access_window_reduce_stream": access_window_reduce_stream,
    "count_window_reduce_stream": count_window_reduce_stream,
    "access_window_stats_stream": access_window_stats_stream,
    "word_sessions_stream": word_sessions_stream_q,
    "word_count_stream": word_count_stream,
    "orders_union_stream": orders_union_stream,
    "count_average_stream": count_average_stream_q,
    "chunk_rows_stream": chunk_rows_stream_q,
    "access_window_stats_mixed_stream": access_window_stats_mixed_stream,
    "word_windows_stream": word_windows_stream,
    "access_job_docs": access_job_docs,
    "access_text_job_docs": access_text_job_docs,
    "order_job_print": order_job_print,
    "order_job_docs": order_job_docs,
    "count_job_docs": count_job_docs,
    "late_rows_stream": late_rows_stream,
    "word_session_job_docs": word_session_job_docs,
    "log_restart_stream": log_restart_stream,
    "log_from_offsets_stream": log_from_offsets_stream,
    "late_split_stream": late_split_stream,
    "slow_partition_windows_stream": slow_partition_windows_stream,
    "access_window_timers_stream": access_window_timers_stream,
    "access_window_times_stream": access_window_times_stream,
    "word_clock_windows_stream": word_clock_windows_stream,
    "count_average_nulls_stream": count_average_nulls_stream,
    "chunk_rows_nulls_stream": chunk_rows_nulls_stream,
    "count_average_pending_state": count_average_pending_state,
    "chunk_pending_state": chunk_pending_state,
    "count_average_resumed_stream": count_average_resumed_stream,
    "chunk_rows_resumed_stream": chunk_rows_resumed_stream,
}

QUERIES = {
    "word_count": word_count_q,
    "word_sessions": word_sessions_q,
    "parse_rejects": parse_rejects,
    "first_three_fields": first_three_fields,
    "orders_big": orders_big,
    "orders_small": orders_small,
    "orders_union": orders_union,
    "prefix_lines": prefix_lines_q,
    "prefix_chars": prefix_chars_q,
    "count_average": count_average_q,
    "chunk_rows": chunk_rows_q,
    "chunk_pending": chunk_pending,
    "access_rejects": access_rejects,
    "access_window_stats_mixed": access_window_stats_mixed,
    "order_rejects": order_rejects,
    "order_docs_damaged": order_docs_damaged,
    "word_windows": word_windows,
    "late_split": late_split,
    "word_docs": word_docs,
    "count_docs": count_docs,
    "access_docs": access_docs,
    "order_docs": order_docs,
    "access_window_reduce": access_window_reduce_q,
    "access_window_reduce_6h": access_window_reduce_6h,
    "access_window_reduce_compat": access_window_reduce_compat,
    "access_window_stats": access_window_stats_q,
    "access_window_stats_6h": access_window_stats_6h,
    "count_window_reduce": count_window_reduce_q,
    "count_window_reduce_6h": count_window_reduce_6h,
    "count_window_reduce_compat": count_window_reduce_compat,
    "count_window_totals": count_window_totals,
    "access_window_times": access_window_times_q,
    "count_window_times_6h": count_window_times_6h,
    "count_average_nulls": count_average_nulls,
    "chunk_rows_nulls": chunk_rows_nulls,
    "count_average_pending": count_average_pending,
    "prefix_char_rows": prefix_char_rows,
}
QUERIES.update(STREAM_QUERIES)
