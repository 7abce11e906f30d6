"""The line log (offsets, start positions, restarts), per-record watermarks on a stream, windows by
timers, times as rows, keyed state with nulls, read back, and started from a batch."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from eddyline.operators import (
    access_window_reduce, access_window_stats, access_window_times, average_pending, chunk_rows, chunk_state,
    count_average, count_window_reduce, count_window_times, mark_late, parse_access_lines, parse_count_lines,
)
from eddyline.sources import access_lines, count_lines, read_log, read_table
from eddyline.streaming import (
    access_window_timers, chunk_rows_stream, count_average_stream, mark_late_stream, pending_averages,
    pending_chunks, run_available_now, run_until_idle, start_stream, word_clock_windows,
)

PAIRS = "key BIGINT, value BIGINT, seq BIGINT"
NAMED = "name STRING, value INT, seq BIGINT, bucket INT"


def _folder(tmp_path, **files):
    d = tmp_path / "in"
    d.mkdir(exist_ok=True)
    for name, text in files.items():
        (d / f"{name}.txt").write_bytes(text.encode() if isinstance(text, str) else text)
    return str(d)


def _rows(df):
    return [(r.partition, r.seq, r.value) for r in df.orderBy("partition", "seq").collect()]


# ---- the log ----

def test_log_offsets_are_bytes_at_any_chunk_size(spark, tmp_path):
    lines = [f"line {i} é" * (i % 3) for i in range(300)] + ["x" * 5000, "", "end"]
    d = _folder(tmp_path, a="\n".join(lines) + "\n", b="one\r\ntwo\n\nlast", empty="", _hidden="no\n")
    want, at = [], 0
    for v in lines:
        want.append((0, at, v))
        at += len(v.encode()) + 1
    want += [(1, 0, "one"), (1, 5, "two"), (1, 9, ""), (1, 10, "last")]
    for chunk in (331, 4000, 1 << 20):
        assert _rows(read_log(spark, d, streaming=False, chunkBytes=chunk)) == want
    assert _rows(read_log(spark, d, streaming=False, tail="wait")) == want[:-1]
    bad = _folder(tmp_path / "..", c=b"\xff\xfe\nok\n")
    assert "ok" in {r.value for r in read_log(spark, bad, streaming=False).collect()}


def test_empty_log(spark, tmp_path):
    d = _folder(tmp_path)
    assert read_log(spark, d, streaming=False).count() == 0


def _stream(spark, d, tmp_path, name="s", **options):
    ck, out = str(tmp_path / f"{name}-ck"), str(tmp_path / f"{name}-out")
    lines = read_log(spark, d, checkpoint=ck, **options)
    run_until_idle(lines, name, out=out, checkpoint=ck)
    return _rows(spark.read.schema(lines.schema).parquet(out))


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    d = _folder(tmp_path, a="1\n2\n")
    assert [v for *_, v in _stream(spark, d, tmp_path)] == ["1", "2"]
    with open(f"{d}/a.txt", "a") as f:
        f.write("3\n")
    _folder(tmp_path, b="new\n")
    assert _stream(spark, d, tmp_path) == [(0, 0, "1"), (0, 2, "2"), (0, 4, "3"), (1, 0, "new")]
    with open(f"{d}/a.txt", "w") as f:
        f.write("1\n")                                    # shorter than what was read
    _folder(tmp_path, b="new\nmore\n")
    assert _stream(spark, d, tmp_path)[-1] == (1, 4, "more")   # what was read of the other file stays read


def test_bounded_batches_take_every_line_once(spark, tmp_path):
    d = _folder(tmp_path, a="".join(f"{i}\n" for i in range(500)), b="".join(f"{i}\n" for i in range(50)))
    ck, out = str(tmp_path / "ck"), str(tmp_path / "out")
    q = start_stream(read_log(spark, d, checkpoint=ck, max_bytes=400), out, ck, trigger={"processingTime": "0 seconds"})
    q.processAllAvailable()
    batches = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    q.stop()
    assert len(batches) > 3
    got = spark.read.parquet(out)
    assert got.count() == 550 and got.distinct().count() == 550


def test_start_positions(spark, tmp_path):
    d = _folder(tmp_path, a="aa\nbb\ncc\n", b="dd\nee\n")
    some = _stream(spark, d, tmp_path, "some", startingOffsets='{"a.txt": 4}')
    assert some == [(0, 6, "cc"), (1, 0, "dd"), (1, 3, "ee")]
    assert _stream(spark, d, tmp_path, "exact", startingOffsets='{"a.txt": 3, "b.txt": 6}') == [
        (0, 3, "bb"), (0, 6, "cc")]
    os.utime(f"{d}/a.txt", (1000, 1000))
    os.utime(f"{d}/b.txt", (2000, 2000))
    assert _stream(spark, d, tmp_path, "time", startingTimestamp=2_000_000) == [(1, 0, "dd"), (1, 3, "ee")]
    with pytest.raises(Exception, match="not there"):
        _stream(spark, d, tmp_path, "none", startingOffsets='{"z.txt": 4}')


# ---- late rows ----

def test_late_rows_on_a_stream_equal_the_static_rule(spark, tmp_path):
    rows = [(i, None if i % 11 == 5 else 60_000 * ((i * 7) % 40), None if i % 13 == 0 else i % 3, i // 2)
            for i in range(400)]
    static = spark.createDataFrame(rows, "event_id LONG, ms LONG, partition INT, seq LONG").select(
        "event_id", F.timestamp_millis("ms").alias("ts"), "partition", "seq")
    src = str(tmp_path / "src")
    for k in range(4):                                   # four micro-batches, in arrival order
        static.where(F.col("event_id").between(100 * k, 100 * k + 99)).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(static.schema).option("maxFilesPerTrigger", 1).parquet(src)
    got = run_available_now(mark_late_stream(stream, "5 minutes"), "late")
    want = mark_late(static, "5 minutes")
    pick = lambda d, w: {r.event_id: (r.w, r.watermark_ms, r.late) for r in d.select(
        "event_id", w.alias("w"), "watermark_ms", "late").collect()}
    assert pick(got, F.col("window_start_ms")) == pick(want, F.unix_millis("window_start"))
    assert got.where("late").count() > 20


# ---- windows by timers, times as rows ----

def _access(spark):
    return parse_access_lines(access_lines(read_table(spark, SF_SMALL, "events"), damaged=True)).rows


def test_times_as_rows_joined_back_equal_the_list(spark):
    rows = _access(spark)
    at = ["url", "response", "window_start"]
    times = access_window_times(rows, "6 hours", bucket_width=50)
    lists = times.groupBy(*at).agg(F.sort_array(F.collect_list(F.struct("position", "time"))).alias("t"))
    back = access_window_stats(rows, "6 hours").join(lists, at).withColumn("times", F.col("t.time")).drop("t")
    want = access_window_reduce(rows, "6 hours")
    assert back.select(*want.columns).exceptAll(want).count() == 0 and back.count() == want.count()
    counts = parse_count_lines(count_lines(read_table(spark, SF_SMALL, "events"))).rows
    lists = (count_window_times(counts, "6 hours").groupBy("key", "window_start")
             .agg(F.sort_array(F.collect_list(F.struct("position", "time"))).alias("t"))
             .select("key", "window_start", F.col("t.time").alias("times")))
    want = count_window_reduce(counts, "6 hours").select("key", "window_start", "times")
    assert lists.exceptAll(want).count() == 0 and lists.count() == want.count()


def test_timer_windows_over_many_batches(spark, tmp_path):
    rows = _access(spark).orderBy("event_time")
    src = str(tmp_path / "src")
    cut = rows.approxQuantile("seq", [0.3, 0.6], 0)
    for lo, hi in zip([-1, *cut], [*cut, 1 << 60]):
        rows.where((F.col("seq") > lo) & (F.col("seq") <= hi)).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(src)
    got = run_available_now(access_window_timers(stream, "6 hours", "30 days", times=True), "timers").where(
        "kind = 'time'").select("url", "response", "window_start_ms", "position", "took_ms")
    want = access_window_times(rows, "6 hours").select(
        "url", "response", F.unix_millis("window_start").alias("window_start_ms"), "position")
    assert got.drop("took_ms").exceptAll(want).count() == 0 and got.count() == want.count()
    in_order = run_available_now(access_window_timers(stream, "6 hours", "0 seconds"), "closed")
    stats = access_window_stats(rows.where(F.col("event_time") < F.lit("9999-01-01")), "6 hours")
    closed = {(r.url, r.response, r.window_start_ms): (r["count"], r.method, r.code, r.response_time_avg,
                                                       round(r.response_time_mean, 6)) for r in in_order.collect()}
    every = {(r.url, r.response, int(r.s)): (r["count"], r.method, r.code, r.response_time_avg,
                                             round(r.response_time_mean, 6))
             for r in stats.withColumn("s", F.unix_millis("window_start")).collect()}
    assert len(closed) > 100 and all(every[k] == v for k, v in closed.items())


def test_clock_windows_leave_no_state(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.createDataFrame([("a",)] * 30 + [("b",)] * 5 + [(None,)], "word STRING").write.parquet(src)
    words = spark.readStream.schema("word STRING").parquet(src)
    out = run_until_idle(word_clock_windows(words, "2 seconds"), "clock", trigger="500 milliseconds",
                         until_state_empty=True, limit_seconds=120)
    got = {r.word: r.n for r in out.groupBy("word").agg(F.sum("count_sum").alias("n")).collect()}
    assert got == {"a": 30, "b": 5, None: 1}


# ---- keyed state ----

KEYED = [(1, 3, 0), (1, None, 1), (1, 5, 2), (1, 7, 3), (None, None, 4), (None, None, 5), (None, 9, 6), (None, 4, 7),
         (2, -3, 8), (2, 0, 9), (3, 1 << 62, 10), (3, (1 << 62) - 1, 11), (4, 1, 12)]


def _as_stream(spark, df, tmp_path, name):
    df.coalesce(1).write.parquet(str(tmp_path / name))
    return spark.readStream.schema(df.schema).parquet(str(tmp_path / name))


def test_averages_with_nulls_are_alike(spark, tmp_path):
    pairs = spark.createDataFrame(KEYED, PAIRS)
    ck = str(tmp_path / "ck")
    got = run_available_now(count_average_stream(_as_stream(spark, pairs, tmp_path, "p")), "nulls", checkpoint=ck)
    want = count_average(pairs)
    key = lambda d: sorted(map(str, d.select("key", "average", "seq").collect()))
    assert key(got) == key(want) and "average=None" in str(key(got)) and "9223372036854775807" not in str(key(got))
    assert sorted(map(str, pending_averages(spark, ck).collect())) == sorted(map(str, average_pending(pairs).collect()))


def test_a_sum_beyond_64_bits_stops_both(spark, tmp_path):
    pairs = spark.createDataFrame([(1, 1 << 62, 0), (1, 1 << 62, 1)], PAIRS)
    with pytest.raises(Exception):
        count_average(pairs).collect()
    with pytest.raises(Exception, match="64 bits"):
        run_available_now(count_average_stream(_as_stream(spark, pairs, tmp_path, "p")), "overflow")


def test_chunks_with_nulls_and_a_start_from_a_batch(spark, tmp_path):
    rows = [(None if i % 5 == 0 else f"n{i}", None if i % 3 == 0 else i, i, None if i % 4 == 3 else i % 4)
            for i in range(60)]
    df = spark.createDataFrame(rows, NAMED)
    whole = chunk_rows(df, 4)
    ck = str(tmp_path / "ck")
    got = run_available_now(chunk_rows_stream(_as_stream(spark, df, tmp_path, "all"), 4), "chunks", checkpoint=ck)
    key = lambda d: sorted(map(str, d.select("name", "value", "seq", "bucket", "chunk", "position").collect()))
    assert key(got) == key(whole.full)
    held = lambda d: sorted(map(str, d.select("name", "value", "seq", "bucket").collect()))
    assert held(pending_chunks(spark, ck)) == held(whole.pending)
    first, later = df.where("seq < 25"), df.where("seq >= 25")
    done = chunk_rows(first, 4)
    rest = run_available_now(chunk_rows_stream(_as_stream(spark, later, tmp_path, "later"), 4,
                                               initial=chunk_state(done)), "resumed")
    assert sorted(key(done.full) + key(rest)) == key(whole.full)


def test_averages_start_from_a_batch(spark, tmp_path):
    pairs = spark.createDataFrame([(k, v, s) for s, (k, v) in enumerate(
        [(1, 1), (1, 2), (2, 5), (None, 3), (1, 3), (2, None), (None, 4), (2, 6), (None, 5), (1, 9)])], PAIRS)
    first, later = pairs.where("seq < 5"), pairs.where("seq >= 5")
    rest = run_available_now(count_average_stream(_as_stream(spark, later, tmp_path, "later"), 3,
                                                  initial=average_pending(first, 3)), "resumed")
    both = count_average(first, 3).unionByName(rest)
    assert sorted(map(str, both.collect())) == sorted(map(str, count_average(pairs, 3).collect()))
