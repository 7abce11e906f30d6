"""The reference's streaming jobs, end to end: source, transformation, sinks.

Each job reads messages with :func:`eddyline.sources.read_lines` (a dict of
topic options, or a folder of text or parquet line files), runs the same
operators as the named queries, and starts a streaming query.  Documents go
to ``target/<index>`` (one folder of JSON lines per index) and, where the
reference also printed them, to the printout ``target/<index>-print`` in the same
micro-batch (:func:`eddyline.sinks.fan_out`).  The micro-batch trigger interval is the
checkpoint interval; checkpoints go under ``checkpoint``.  Late rows are
filtered with the current micro-batch's watermark
(``spark.sql.streaming.statefulOperator.allowMultiple=false``).

    python -m eddyline.plans.jobs access --source /data/lines --fmt parquet \
        --target /shared/index --checkpoint /shared/ckpt/access --available-now
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from eddyline.operators import (
    access_window_reduce, count_window_reduce, parse_access_lines, parse_count_lines,
    parse_first_three, parse_orders, prefix_chars, prefix_lines, sql_filter,
    union_all_filtered, word_count_window, word_sessions_stream, as_table,
)
from eddyline.operators.prefix import DEFAULT_PREFIX
import functools

from eddyline.session import prepare_session, settings_for_start
from eddyline.sinks import (
    access_documents, batch_writer, count_documents, fan_out, object_documents,
    topic_sink_options, word_documents, write_lines,
)
from eddyline.sources import read_lines
from eddyline.streaming import chunk_rows_stream, count_average_stream, start_stream

# Index names of the jobs, our own.
INDEX = {"word": "word-result", "session": "word-result-session",
         "count": "count-result", "access": "access-result", "order": "order-result"}
# The reference's checkpoint intervals.
EVERY = {"word": "1 second", "session": "1 second", "count": "35 seconds",
         "access": "35 seconds", "first_three": "5 seconds", "union": "30 milliseconds",
         "order": "1 second", "order_state": "30 seconds", "prefix": "5 seconds",
         "passthrough": "1 second", "average": "1 second", "buffer": "1 second"}


def _trigger(name: str, available_now: bool) -> dict:
    return {"availableNow": True} if available_now else {"processingTime": EVERY[name]}


def _to_index_and_console(docs: DataFrame, target: str, index: str, checkpoint: str,
                          trigger: dict, output_mode: str = "append",
                          console: bool = True) -> StreamingQuery:
    """The documents into the index and, with ``console``, all of them into
    the printout ``<index>-print`` too, written by the executors."""
    writers = [batch_writer(target, index)]
    if console:
        writers.append(batch_writer(target, f"{index}-print"))
    return fan_out(docs, writers, checkpoint, trigger, output_mode)


# Each job has one stateful operator: filter late rows with the current
# micro-batch's watermark, the closest Spark gets to a per-record one.
JOB_SETTINGS = {"spark.sql.streaming.statefulOperator.allowMultiple": "false"}

# A task that reads lines also aggregates and sorts what it made of them (a row per word), so
# a larger micro-batch of files has more tasks, not larger ones.  A file source plans each
# micro-batch with the session's value, so this is to be set for as long as the job runs.
READ_SETTINGS = {"spark.sql.files.maxPartitionBytes": "8m"}


def _job(fn):
    """Start the job's query with ``JOB_SETTINGS`` (restored afterwards)."""
    @functools.wraps(fn)
    def run(spark, *args, **kwargs):
        with settings_for_start(spark, JOB_SETTINGS):
            return fn(spark, *args, **kwargs)
    return run


def _prepare(spark) -> None:
    prepare_session(spark)


def _lines(spark, source, fmt, max_per_trigger=None):
    """``max_per_trigger`` bounds a micro-batch (offsets or files)."""
    _prepare(spark)
    return read_lines(spark, source, streaming=True, fmt=fmt,
                      max_per_trigger=max_per_trigger)


@_job
def word_count_job(spark, source, target, checkpoint, fmt="text", available_now=False,
                   max_per_trigger=None, console=True):
    """Words per 30 s processing-time window -> word documents + console."""
    lines = _lines(spark, source, fmt, max_per_trigger)
    counts = word_count_window(lines, "30 seconds", time="processing", watermark="0 seconds")
    return _to_index_and_console(word_documents(counts), target, INDEX["word"], checkpoint,
                                 _trigger("word", available_now), console=console)


@_job
def word_session_job(spark, source, target, checkpoint, fmt="text", available_now=False,
                     max_per_trigger=None, console=True):
    """Words per 10 minute session on the message time -> word documents."""
    lines = _lines(spark, source, fmt, max_per_trigger)
    sessions = word_sessions_stream(lines, 600, time_col="timestamp")
    return _to_index_and_console(word_documents(sessions), target, INDEX["session"],
                                 checkpoint, _trigger("session", available_now),
                                 console=console)


@_job
def count_reduce_job(spark, source, target, checkpoint, fmt="text", available_now=False,
                     max_per_trigger=None, times_mode="clean", console=True):
    """``key,count,ms`` lines per key and 30 s event-time window -> count documents."""
    rows = parse_count_lines(_lines(spark, source, fmt, max_per_trigger)).rows
    reduced = count_window_reduce(rows, "30 seconds", times_mode, watermark="0 seconds")
    return _to_index_and_console(count_documents(reduced), target, INDEX["count"], checkpoint,
                                 _trigger("count", available_now), console=console)


@_job
def access_reduce_job(spark, source, target, checkpoint, fmt="text", available_now=False,
                      max_per_trigger=None, times_mode="clean", console=True):
    """Access lines per (url, response) and 30 s window -> access documents."""
    rows = parse_access_lines(_lines(spark, source, fmt, max_per_trigger)).rows
    reduced = access_window_reduce(rows, "30 seconds", times_mode, watermark="0 seconds")
    return _to_index_and_console(access_documents(reduced), target, INDEX["access"],
                                 checkpoint, _trigger("access", available_now),
                                 console=console)


@_job
def first_three_job(spark, source, target, checkpoint, fmt="text", available_now=False,
                    max_per_trigger=None):
    """First three lower-cased CSV fields of each line -> rows."""
    out = parse_first_three(_lines(spark, source, fmt, max_per_trigger))
    return start_stream(out, f"{target.rstrip('/')}/first-three", checkpoint,
                        trigger=_trigger("first_three", available_now))


def _orders(spark, source, fmt, max_per_trigger=None):
    return as_table(parse_orders(_lines(spark, source, fmt, max_per_trigger)).rows)


@_job
def orders_union_job(spark, source, target, checkpoint, fmt="text", available_now=False,
                     max_per_trigger=None):
    """One topic read twice: amount > 2 UNION ALL amount < 2 -> order rows."""
    out = union_all_filtered(_orders(spark, source, fmt, max_per_trigger),
                             _orders(spark, source, fmt, max_per_trigger))
    return start_stream(out, f"{target.rstrip('/')}/orders-union", checkpoint,
                        trigger=_trigger("union", available_now))


@_job
def orders_filter_job(spark, source, target, checkpoint, fmt="text", available_now=False,
                      max_per_trigger=None, console=True):
    """amount > 300 -> order documents."""
    out = sql_filter(_orders(spark, source, fmt, max_per_trigger), "amount > 300")
    return _to_index_and_console(object_documents(out), target, INDEX["order"], checkpoint,
                                 _trigger("order", available_now), console=console)


@_job
def orders_state_job(spark, source, target, checkpoint, fmt="text", available_now=False,
                     max_per_trigger=None):
    """amount > 300 with the query state on the shared file system -> rows."""
    out = sql_filter(_orders(spark, source, fmt, max_per_trigger), "amount > 300")
    return start_stream(out, f"{target.rstrip('/')}/orders-state", checkpoint,
                        trigger=_trigger("order_state", available_now))


@_job
def prefix_job(spark, source, target, checkpoint, fmt="text", available_now=False,
               max_per_trigger=None, prefix=DEFAULT_PREFIX, chars=False):
    """Each line with a prefix (or, ``chars=True``, each of its characters).
    With topic-sink options as ``target`` they go to that topic as messages."""
    lines = _lines(spark, source, fmt, max_per_trigger)
    out = prefix_chars(lines, prefix) if chars else prefix_lines(lines, prefix)
    if isinstance(target, dict):
        return write_lines(out.withColumnRenamed("ch", "value"), target, checkpoint,
                           _trigger("prefix", available_now))
    return start_stream(out, f"{target.rstrip('/')}/prefix", checkpoint,
                        trigger=_trigger("prefix", available_now))


@_job
def passthrough_job(spark, source, target, checkpoint, fmt="text", available_now=False,
                    max_per_trigger=None):
    """Every message unchanged, exactly once."""
    lines = _lines(spark, source, fmt, max_per_trigger)
    return start_stream(lines, f"{target.rstrip('/')}/passthrough", checkpoint,
                        trigger=_trigger("passthrough", available_now))


@_job
def count_average_job(spark, pairs: DataFrame, target, checkpoint, n=2,
                      available_now=False):
    """Average of every ``n`` values per key (``pairs``: key, value, seq stream)."""
    _prepare(spark)
    return start_stream(count_average_stream(pairs, n), f"{target.rstrip('/')}/averages",
                        checkpoint, trigger=_trigger("average", available_now))


@_job
def buffered_sink_job(spark, rows: DataFrame, target, checkpoint, n,
                      available_now=False):
    """Rows released in chunks of exactly ``n`` per bucket (``rows``: name,
    value, seq, bucket stream); the remainder waits in state."""
    _prepare(spark)
    return start_stream(chunk_rows_stream(rows, n), f"{target.rstrip('/')}/chunks",
                        checkpoint, trigger=_trigger("buffer", available_now))


def _pair_fields(lines: DataFrame, first: str, first_type: str):
    """``<first>,<value>`` lines as typed columns; other lines are dropped."""
    from pyspark.sql import functions as F
    from eddyline.functions import java_split, strict_int, strict_long
    f = java_split("value", ",")
    head = strict_long(F.get(f, 0)) if first_type == "long" else F.get(f, 0)
    val = strict_long(F.get(f, 1)) if first_type == "long" else strict_int(F.get(f, 1))
    ok = (F.size(f) == 2) & head.isNotNull() & val.isNotNull()
    return lines.where(ok).select(head.alias(first), val.alias("value"), "seq", "partition")


@_job
def count_average_lines_job(spark, source, target, checkpoint, fmt="text",
                            available_now=False, max_per_trigger=None, n=2):
    """``key,value`` lines -> the average of every ``n`` values per key."""
    pairs = _pair_fields(_lines(spark, source, fmt, max_per_trigger), "key", "long")
    return start_stream(count_average_stream(pairs, n),
                        f"{target.rstrip('/')}/averages", checkpoint,
                        trigger=_trigger("average", available_now))


@_job
def buffered_sink_lines_job(spark, source, target, checkpoint, fmt="text",
                            available_now=False, max_per_trigger=None, n=2):
    """``name,value`` lines -> released in chunks of ``n`` per source partition."""
    rows = _pair_fields(_lines(spark, source, fmt, max_per_trigger), "name", "string")
    rows = rows.select("name", "value", "seq", "partition", rows["partition"].alias("bucket"))
    return start_stream(chunk_rows_stream(rows, n), f"{target.rstrip('/')}/chunks",
                        checkpoint, trigger=_trigger("buffer", available_now))


JOBS: dict[str, Callable[..., StreamingQuery]] = {
    "word_count": word_count_job, "word_sessions": word_session_job,
    "count": count_reduce_job, "access": access_reduce_job,
    "first_three": first_three_job, "orders_union": orders_union_job,
    "orders_filter": orders_filter_job, "orders_state": orders_state_job,
    "prefix": prefix_job, "passthrough": passthrough_job,
    "count_average": count_average_lines_job, "buffered_sink": buffered_sink_lines_job,
}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="python -m eddyline.plans.jobs")
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("--source", required=True,
                    help="folder of line files, or bootstrap servers with --topic")
    ap.add_argument("--topic")
    ap.add_argument("--fmt", default="text", choices=["text", "parquet"])
    ap.add_argument("--target", required=True)
    ap.add_argument("--checkpoint", required=True)
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--max-per-trigger", type=int,
                    help="offsets (topic) or files (folder) per micro-batch")
    ap.add_argument("--times-mode", choices=["clean", "compat"],
                    help="time list text of the count and access jobs")
    ap.add_argument("--chars", action="store_true",
                    help="prefix job: one row per character")
    ap.add_argument("--prefix", help=f"prefix job: the prefix (default {DEFAULT_PREFIX})")
    ap.add_argument("--sink-topic", help="prefix job: write messages to this topic of the "
                    "bootstrap servers named by --target")
    ap.add_argument("--starting", default="latest",
                    help="where a topic is read from at a first start: latest, earliest or offsets as JSON")
    ap.add_argument("--option", action="append", default=[], metavar="NAME=VALUE",
                    help="further option of the topic source (repeatable)")
    a = ap.parse_args(argv)
    extra: dict = {}
    for o in a.option:
        if "=" not in o:
            ap.error(f"--option {o}: not NAME=VALUE")
    if not a.topic and (a.option or a.starting != "latest"):
        ap.error("--option and --starting apply to a topic source")
    if a.prefix is not None:
        if a.job != "prefix":
            ap.error("--prefix applies to the prefix job")
        extra["prefix"] = a.prefix
    if a.sink_topic and a.job != "prefix":
        ap.error("--sink-topic applies to the prefix job")
    if a.times_mode:
        if a.job not in ("count", "access"):
            ap.error("--times-mode applies to the count and access jobs")
        extra["times_mode"] = a.times_mode
    if a.chars:
        if a.job != "prefix":
            ap.error("--chars applies to the prefix job")
        extra["chars"] = True
    from eddyline.session import build_session
    from eddyline.sources import kafka_options
    spark: SparkSession = build_session(conf=READ_SETTINGS)
    source = (kafka_options(a.source, a.topic, a.starting, **dict(o.split("=", 1) for o in a.option))
              if a.topic else a.source)
    target = topic_sink_options(a.target, a.sink_topic) if a.sink_topic else a.target
    q = JOBS[a.job](spark, source, target, a.checkpoint, fmt=a.fmt,
                    available_now=a.available_now, max_per_trigger=a.max_per_trigger,
                    **extra)
    q.awaitTermination()


if __name__ == "__main__":
    main()
