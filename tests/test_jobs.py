"""The reference's jobs run end to end on line files derived from the tables."""

import json

from pyspark.sql import functions as F

from conftest import SF_ORACLE
from eddyline.operators import (
    access_window_reduce, count_window_reduce, parse_access_lines, parse_count_lines,
)
from eddyline.plans.jobs import JOBS, count_average_job
from eddyline.sinks import write_lines
from eddyline.sources import (
    access_lines, count_lines, event_lines, keyed_pairs, order_lines, read_table,
)


def _closed(df, rows):
    wm = rows.agg(F.max("event_time")).first()[0]
    return df.where(F.col("window_end") <= F.lit(wm)).count()


def test_access_and_count_jobs(spark, tmp_path):
    ev = read_table(spark, SF_ORACLE, "events")
    for name, derive, parse, reduce in [
            ("access", access_lines, parse_access_lines, access_window_reduce),
            ("count", count_lines, parse_count_lines, count_window_reduce)]:
        src = str(tmp_path / f"{name}-lines")
        write_lines(derive(ev), src)
        q = JOBS[name](spark, src, str(tmp_path / "index"), str(tmp_path / f"ck-{name}"),
                       fmt="parquet", available_now=True)
        q.awaitTermination()
        assert q.exception() is None
        docs = spark.read.text(str(tmp_path / "index" / f"{name}-result"))
        rows = parse(derive(ev)).rows
        assert docs.count() == _closed(reduce(rows), rows) > 0
        first = json.loads(docs.first().value)
        assert {"count", "times"} <= set(first)


def test_order_and_session_jobs(spark, tmp_path):
    orders = read_table(spark, SF_ORACLE, "orders")
    src = str(tmp_path / "orders")
    write_lines(order_lines(orders), src)
    q = JOBS["orders_filter"](spark, src, str(tmp_path / "index"), str(tmp_path / "ck1"),
                              fmt="parquet", available_now=True)
    q.awaitTermination()
    docs = spark.read.text(str(tmp_path / "index" / "order-result"))
    assert docs.count() == 5998
    q = JOBS["orders_union"](spark, src, str(tmp_path / "out"), str(tmp_path / "ck2"),
                             fmt="parquet", available_now=True)
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out" / "orders-union")).count() == 14966
    ev_src = str(tmp_path / "events")
    write_lines(event_lines(read_table(spark, SF_ORACLE, "events")), ev_src)
    q = JOBS["word_sessions"](spark, ev_src, str(tmp_path / "index"), str(tmp_path / "ck3"),
                              fmt="parquet", available_now=True)
    q.awaitTermination()
    assert spark.read.text(str(tmp_path / "index" / "word-result-session")).count() == 17076


def test_keyed_state_job(spark, tmp_path):
    pairs_dir = str(tmp_path / "pairs")
    keyed_pairs(read_table(spark, SF_ORACLE, "events")).write.parquet(pairs_dir)
    stream = spark.readStream.schema("key BIGINT, value BIGINT, seq BIGINT").parquet(pairs_dir)
    q = count_average_job(spark, stream, str(tmp_path / "out"), str(tmp_path / "ck"),
                          available_now=True)
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out" / "averages")).count() == 4960


def test_command_line(spark, tmp_path):
    from eddyline.plans.jobs import main
    src = tmp_path / "txt"
    src.mkdir()
    (src / "a.txt").write_text("A,B,C,D\nA,B\nx,y,z\n")
    main(["first_three", "--source", str(src), "--target", str(tmp_path / "out"),
          "--checkpoint", str(tmp_path / "ck"), "--available-now"])
    out = spark.read.parquet(str(tmp_path / "out" / "first-three"))
    got = sorted((r.f0, r.f1, r.f2) for r in out.collect())
    assert got == [("a", "b", "c"), ("x", "y", "z")]


def test_micro_batch_bound(spark, tmp_path):
    from eddyline.plans.jobs import main
    src = tmp_path / "txt"
    src.mkdir()
    for i in range(3):
        (src / f"{i}.txt").write_text(f"a{i},b,c\n")
    main(["first_three", "--source", str(src), "--target", str(tmp_path / "out"),
          "--checkpoint", str(tmp_path / "ck"), "--available-now", "--max-per-trigger", "1"])
    assert spark.read.parquet(str(tmp_path / "out" / "first-three")).count() == 3
    commits = [p for p in (tmp_path / "ck" / "commits").iterdir() if p.name.isdigit()]
    assert len(commits) == 3                      # one file per micro-batch


def test_remaining_jobs(spark, tmp_path):
    from eddyline.plans.jobs import buffered_sink_job
    src = tmp_path / "txt"
    src.mkdir()
    (src / "a.txt").write_text("ab\n{\"user\":5,\"product\":\"tv\",\"amount\":301}\n")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    for name, kwargs in [("prefix", {}), ("passthrough", {}), ("orders_state", {})]:
        q = JOBS[name](spark, str(src), out, f"{ck}-{name}", available_now=True, **kwargs)
        q.awaitTermination()
        assert q.exception() is None
    q = JOBS["prefix"](spark, str(src), str(tmp_path / "chars"), f"{ck}-chars",
                       available_now=True, chars=True)
    q.awaitTermination()
    chars = spark.read.parquet(str(tmp_path / "chars" / "prefix")).count()
    assert chars == len("PREFIX:ab") + len('PREFIX:{"user":5,"product":"tv","amount":301}')
    assert sorted(r.value for r in spark.read.parquet(f"{out}/prefix").collect())[0] == "PREFIX:ab"
    assert spark.read.parquet(f"{out}/passthrough").count() == 2
    assert [r.user for r in spark.read.parquet(f"{out}/orders-state").collect()] == [5]
    rows_dir = str(tmp_path / "rows")
    spark.createDataFrame([("x", i, i, 0) for i in range(7)],
                          "name STRING, value INT, seq BIGINT, bucket INT").write.parquet(rows_dir)
    stream = spark.readStream.schema("name STRING, value INT, seq BIGINT, bucket INT").parquet(rows_dir)
    q = buffered_sink_job(spark, stream, out, f"{ck}-buf", n=3, available_now=True)
    q.awaitTermination()
    assert spark.read.parquet(f"{out}/chunks").count() == 6


def test_keyed_state_jobs_from_lines(spark, tmp_path):
    from eddyline.plans.jobs import main
    from eddyline.sinks import write_lines
    lines = spark.createDataFrame(
        [(v, i, 0) for i, v in enumerate(["1,3", "1,5", "1,7", "bad", "1,4", "1,2"])],
        "value STRING, seq BIGINT, partition INT")
    src = str(tmp_path / "lines")
    write_lines(lines, src)
    main(["count_average", "--source", src, "--fmt", "parquet",
          "--target", str(tmp_path / "o1"), "--checkpoint", str(tmp_path / "c1"), "--available-now"])
    out = spark.read.parquet(str(tmp_path / "o1" / "averages"))
    got = sorted((r.key, r.average) for r in out.collect())
    assert got == [(1, 4), (1, 5)]
    main(["buffered_sink", "--source", src, "--fmt", "parquet",
          "--target", str(tmp_path / "o2"), "--checkpoint", str(tmp_path / "c2"), "--available-now"])
    assert spark.read.parquet(str(tmp_path / "o2" / "chunks")).count() == 4   # 5 rows, chunks of 2


def test_word_count_job(spark, tmp_path, monkeypatch):
    import time
    from eddyline.plans import jobs
    src = tmp_path / "txt"
    src.mkdir()
    (src / "a.txt").write_text("to be or not to be\n")
    # 1 s windows instead of 30 s, so the test is short; same job otherwise
    real = jobs.word_count_window
    monkeypatch.setattr(jobs, "word_count_window",
                        lambda lines, window, **kw: real(lines, "1 second", **kw))
    args = (spark, str(src), str(tmp_path / "index"), str(tmp_path / "ck"))
    jobs.word_count_job(*args, available_now=True, console=False).awaitTermination()
    time.sleep(1.2)                       # the next batch starts after the window
    (src / "b.txt").write_text("x\n")
    jobs.word_count_job(*args, available_now=True, console=False).awaitTermination()
    docs = [json.loads(json.loads(r.value)["data"])
            for r in spark.read.text(str(tmp_path / "index" / "word-result")).collect()]
    assert {d["word"]: d["countSum"] for d in docs} == {"to": 2, "be": 2, "or": 1, "not": 1}


def test_compat_times_from_command_line(spark, tmp_path):
    from eddyline.plans.jobs import main
    src = tmp_path / "txt"
    src.mkdir()
    (src / "a.txt").write_text("s,5,1540000000000\nt,1,1540000100000\n")
    main(["count", "--source", str(src), "--target", str(tmp_path / "index"),
          "--checkpoint", str(tmp_path / "ck"), "--available-now", "--times-mode", "compat"])
    # the first window is closed by the second row; the second stays open
    docs = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "index" / "count-result")).collect()]
    assert docs == [{"key": "s", "count": 5, "times": ["1540000000000"]}]


def test_prefix_chars_from_command_line(spark, tmp_path):
    import pytest
    from eddyline.plans.jobs import main
    src = tmp_path / "txt"
    src.mkdir()
    (src / "a.txt").write_text("ab\n")
    main(["prefix", "--source", str(src), "--target", str(tmp_path / "out"),
          "--checkpoint", str(tmp_path / "ck"), "--available-now", "--chars"])
    chars = sorted(r.ch for r in spark.read.parquet(str(tmp_path / "out" / "prefix")).collect())
    assert chars == sorted("PREFIX:ab")
    with pytest.raises(SystemExit):
        main(["count", "--source", str(src), "--target", "x", "--checkpoint", "y", "--chars"])
