"""Nulls, large values, damaged lines and replays: nothing lost, nothing doubled."""

import json

from pyspark.sql import functions as F

from conftest import lines_df
from eddyline.operators import (
    chunk_rows, mark_late, parse_access_lines, parse_count_lines, parse_orders,
)
from eddyline.sinks import batch_writer, count_documents, object_documents, word_documents


def test_chunk_rows_keep_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "bucket STRING, seq BIGINT")
    got = chunk_rows(df, 2)
    assert got.full.count() + got.pending.count() == 3
    assert sorted(r.seq for r in got.full.collect()) == [1, 2]


def test_late_rows_keep_null_partitions_and_times(spark):
    df = spark.createDataFrame(
        [(1, "2020-01-01 00:00:00", None, 1), (2, None, 0, 2), (3, "2020-01-02 00:00:00", 0, 3)],
        "event_id BIGINT, ts STRING, partition INT, seq BIGINT").withColumn("ts", F.col("ts").cast("timestamp"))
    rows = {r.event_id: r for r in mark_late(df, "6 hours").collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[2].window_start is None and rows[2].late is False


def test_counts_beyond_int_stay_whole(spark):
    big = 3_000_000_000
    w = spark.createDataFrame([("a", big)], "word STRING, count_sum BIGINT")
    assert json.loads(json.loads(word_documents(w).first().doc)["data"])["countSum"] == big
    c = spark.createDataFrame([("a", big, ["t"])], "key STRING, count BIGINT, times ARRAY<STRING>")
    assert json.loads(count_documents(c).first().doc)["count"] == big


def test_null_fields_stay_in_object_documents(spark):
    df = spark.createDataFrame([(1, None)], "user BIGINT, product STRING")
    assert json.loads(object_documents(df).first().doc) == {"user": 1, "product": None}


def test_line_ends_are_no_part_of_a_number(spark):
    p = parse_count_lines(lines_df(spark, ["a,5\n,1540000000000", "a,5,1540000000000\n", "a,5,1540000000000"]))
    assert [r.reason for r in p.rejects.collect()] == ["bad count"]
    assert sorted(r.ms for r in p.rows.collect()) == [0, 1540000000000]


def test_times_out_of_range_are_rejected(spark):
    p = parse_access_lines(lines_df(spark, ["/a,GET,ok,1,999999999999999999,200,5", "/a,GET,ok,1,1540000000000,200,5"]))
    assert [r.reason for r in p.rejects.collect()] == ["time out of range"]
    assert p.rows.count() == 1


def test_text_after_a_json_object_is_rejected(spark):
    lines = ['{"user":1,"amount":7}', '{"user":3,"amount":7} trailing', '{"user":4,"amount":7}{"user":5,"amount":7}',
             '{"user":6}]', '{"user":7,"product":null}', ' {"user":8} ']
    p = parse_orders(lines_df(spark, lines))
    assert sorted(r.user for r in p.rows.collect()) == [1, 7, 8]
    assert [r.reason for r in p.rejects.collect()] == ["malformed json"] * 3


def test_replayed_batch_is_not_doubled(spark, tmp_path):
    docs = spark.createDataFrame([(str(i),) for i in range(50)], "doc STRING")
    write = batch_writer(str(tmp_path), "index")
    write(docs, 0)
    write(docs, 0)          # the batch again, as after a failure before its commit
    write(docs, 1)
    assert spark.read.text(f"{tmp_path}/index").count() == 100
