"""Message lines derived from the given tables.

The reference reads text messages from a topic; these functions produce such
messages from the driver's tables with column expressions only, so they work
on static and streaming frames and their size grows with the tables.
``seq`` is the arrival order, ``partition`` the source partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.functions.timefmt import epoch_ms

# Fixed values of the line derivations (see FIXTURES.md, section 3).
SOURCE_PARTITIONS = 4
BAD_ARITY_EVERY = 97      # line loses its time: only two parts
BAD_COUNT_EVERY = 101     # count field becomes "x"
TRAILING_COMMA_EVERY = 89  # good line plus a trailing comma
CUT_EVERY, NAN_EVERY, LINE_END_EVERY, NULL_EVERY, FAR_EVERY, MINUS_EVERY = 97, 101, 103, 107, 109, 7
TAIL_EVERY, TWICE_EVERY, NO_PRODUCT_EVERY, NO_AMOUNT_EVERY, BAD_AMOUNT_EVERY, CLOSER_EVERY = (
    97, 101, 103, 107, 109, 113)
FAR_MS = "999999999999999999"     # a whole number of ms past the year 9999
NO_KEY_EVERY, NO_VALUE_EVERY = 13, 3
JITTER_PRIME = 7919
JITTER_SPAN = 50


def _ts(c: str = "ts"):
    return F.col(c).cast("timestamp")


def text_lines(documents: DataFrame) -> DataFrame:
    """One message per document: the whole text."""
    return documents.select(
        F.col("text").alias("value"),
        F.col("doc_id").cast("bigint").alias("seq"),
        (F.col("doc_id") % SOURCE_PARTITIONS).cast("int").alias("partition"),
        F.lit(None).cast("timestamp").alias("timestamp"))


def event_lines(events: DataFrame) -> DataFrame:
    """``<event_type> <props>`` with the event time as message time."""
    return events.select(
        F.concat_ws(" ", "event_type", "props").alias("value"),
        F.col("event_id").alias("seq"),
        (F.col("user_id") % SOURCE_PARTITIONS).cast("int").alias("partition"),
        _ts().alias("timestamp"))


def count_lines(events: DataFrame, damaged: bool = True) -> DataFrame:
    """``<key>,<count>,<epoch ms>`` lines; with ``damaged`` some lines lose a
    field, get a bad count, or carry a trailing comma."""
    ms = epoch_ms("ts").cast("string")
    cnt = ((F.col("user_id") % 3) + 1).cast("string")
    good = F.concat_ws(",", F.col("event_type"), cnt, ms)
    value = good
    if damaged:
        eid = F.col("event_id")
        value = (F.when(eid % BAD_ARITY_EVERY == 0, F.concat(F.col("event_type"), F.lit(",1,")))
                 .when(eid % BAD_COUNT_EVERY == 0,
                       F.concat_ws(",", F.col("event_type"), F.lit("x"), ms))
                 .when(eid % TRAILING_COMMA_EVERY == 0, F.concat(good, F.lit(",")))
                 .otherwise(good))
    return events.select(
        value.alias("value"),
        F.col("event_id").alias("seq"),
        (F.col("user_id") % SOURCE_PARTITIONS).cast("int").alias("partition"),
        _ts().alias("timestamp"))


def access_lines(events: DataFrame, damaged: bool = False) -> DataFrame:
    """``url,method,response,count,epoch ms,code,took ms`` lines.  With
    ``damaged`` some latencies are negative and some lines are cut, null, end in
    a line feed, or hold a word as latency or a time out of range."""
    eid = F.col("event_id")
    ms = epoch_ms("ts").cast("string")
    took = F.floor("value").cast("int")
    if damaged:
        ms = F.when(eid % FAR_EVERY == 0, F.lit(FAR_MS)).otherwise(ms)
        took = F.when(eid % MINUS_EVERY == 0, -took).otherwise(took)
    head = F.concat_ws(
        ",",
        F.concat(F.lit("/u/"), (F.col("user_id") % 20).cast("string")),
        F.when(F.col("event_type") == "view", F.lit("GET")).otherwise(F.lit("POST")),
        F.col("event_type"),
        F.lit("1"),
        ms,
        F.when(F.col("event_type") == "error", F.lit("500")).otherwise(F.lit("200")))
    value = F.concat_ws(",", head, took.cast("string"))
    if damaged:
        value = (F.when(eid % CUT_EVERY == 0, head)
                 .when(eid % NAN_EVERY == 0, F.concat(head, F.lit(",x")))
                 .when(eid % LINE_END_EVERY == 0, F.concat(value, F.lit("\n")))
                 .when(eid % NULL_EVERY == 0, F.lit(None).cast("string"))
                 .otherwise(value))
    return events.select(
        value.alias("value"),
        F.col("event_id").alias("seq"),
        (F.col("user_id") % SOURCE_PARTITIONS).cast("int").alias("partition"),
        _ts().alias("timestamp"))


def order_lines(orders: DataFrame, damaged: bool = False) -> DataFrame:
    """JSON order messages ``{"user":..,"product":..,"amount":..}``.  With
    ``damaged`` some have text, a second object or a stray closer behind them,
    some a null product, a missing amount or a word as amount."""
    key = F.col("o_orderkey")
    user, product = F.col("o_custkey").alias("user"), F.col("o_orderpriority").alias("product")
    amount = F.floor(F.col("o_totalprice") / 1000).cast("int").alias("amount")
    value = good = F.to_json(F.struct(user, product, amount))
    if damaged:
        nothing = F.lit(None).cast("string").alias("product")
        value = (F.when(key % TAIL_EVERY == 0, F.concat(good, F.lit(" trailing")))
                 .when(key % TWICE_EVERY == 0, F.concat(good, good))
                 .when(key % NO_PRODUCT_EVERY == 0,
                       F.to_json(F.struct(user, nothing, amount), {"ignoreNullFields": "false"}))
                 .when(key % NO_AMOUNT_EVERY == 0, F.to_json(F.struct(user, product)))
                 .when(key % BAD_AMOUNT_EVERY == 0,
                       F.to_json(F.struct(user, product, F.lit("x").alias("amount"))))
                 .when(key % CLOSER_EVERY == 0, F.concat(good, F.lit("}")))
                 .otherwise(good))
    return orders.select(
        value.alias("value"),
        F.col("o_orderkey").alias("seq"),
        (F.col("o_custkey") % SOURCE_PARTITIONS).cast("int").alias("partition"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"))


def _gone(c, every: int, damaged: bool):
    """``c``, with ``damaged`` null in every ``every``-th event."""
    return F.when(F.col("event_id") % every != 0, c) if damaged else c


def keyed_pairs(events: DataFrame, damaged: bool = False) -> DataFrame:
    """``(key, value)`` pairs in arrival order ``seq``; with ``damaged`` some keys
    and values are null."""
    return events.select(
        _gone(F.col("user_id"), NO_KEY_EVERY, damaged).alias("key"),
        _gone(F.floor("value").cast("bigint"), NO_VALUE_EVERY, damaged).alias("value"),
        F.col("event_id").alias("seq"))


def named_pairs(events: DataFrame, damaged: bool = False) -> DataFrame:
    """``(name, value)`` rows for the buffered sink, with a bucket that stands
    for the parallel sink instance; with ``damaged`` some buckets and values are null."""
    return events.select(
        F.col("event_type").alias("name"),
        _gone(F.floor("value").cast("int"), NO_VALUE_EVERY, damaged).alias("value"),
        F.col("event_id").alias("seq"),
        _gone((F.col("user_id") % SOURCE_PARTITIONS).cast("int"), NO_KEY_EVERY, damaged).alias("bucket"))


def arrival_lines(events: DataFrame) -> DataFrame:
    """``<event_id>,<arrival>,<epoch microseconds>`` lines of :func:`arrival_order`, ``seq``
    the arrival; ``event_id`` orders equal ones."""
    a = arrival_order(events)
    return a.select(F.concat_ws(",", "event_id", "seq", F.unix_micros("ts")).alias("value"), "seq", "partition",
                    F.col("ts").alias("timestamp"), "event_id")


def arrival_order(events: DataFrame) -> DataFrame:
    """Events with a jittered arrival order: rows arrive up to
    ``JITTER_SPAN`` positions after their id, so some are late."""
    eid = F.col("event_id")
    return events.select(
        eid,
        _ts().alias("ts"),
        (eid + (eid * JITTER_PRIME) % JITTER_SPAN).alias("seq"),
        (F.col("user_id") % SOURCE_PARTITIONS).cast("int").alias("partition"))
