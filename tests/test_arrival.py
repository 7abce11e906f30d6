"""Arrival order of streamed text files, restarts of the document jobs, job options."""

import glob
import json
import os

import pytest

from conftest import lines_df
from eddyline.operators import chunk_rows, count_average
from eddyline.plans import jobs
from eddyline.plans.jobs import JOBS
from eddyline.sinks import write_lines
from eddyline.sources import read_lines


def _run(job, spark, src, tmp_path, **kw):
    q = JOBS[job](spark, str(src), str(tmp_path / "out"), str(tmp_path / "ck"), available_now=True, **kw)
    q.awaitTermination()
    assert q.exception() is None


def test_text_file_lines_keep_their_order(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    rows = [f"/u,M{i},ok,1,{1_540_000_025_000 - i},200,{100 + i}" for i in range(6)]
    closing = "/u,M9,ok,1,1540000080000,200,1"
    (src / "a.txt").write_text("\n".join([*rows, closing]) + "\n")
    _run("access", spark, src, tmp_path)
    docs = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out" / "access-result")).collect()]
    assert [(d["method"], d["responseTimeAvg"]) for d in docs] == [("M0", 104)]
    assert [t.rsplit(" took", 1)[1] for t in docs[0]["times"]] == [f"{100 + i}ms" for i in range(6)]


def test_blocks_of_one_file_are_numbered_in_file_order(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("".join(f"{i}\n" for i in range(4000)))
    old = os.path.getmtime(src / "a.txt")
    (src / "b.txt").write_text("later\n")
    os.utime(src / "b.txt", (old + 5, old + 5))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")      # many tasks for one file
    try:
        q = (read_lines(spark, str(src)).writeStream.format("parquet")
             .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True)
             .start(str(tmp_path / "out")))
        q.awaitTermination()
        got = spark.read.parquet(str(tmp_path / "out")).orderBy("seq").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.value for r in got] == [str(i) for i in range(4000)] + ["later"]
    assert len({r.seq for r in got}) == 4001 and len({r.partition for r in got}) == 2


@pytest.mark.parametrize("job,index,lines", [
    ("orders_filter", "order-result",
     [f'{{"user":{i},"product":"p","amount":{301 + i}}}' for i in range(10)]),
    ("count", "count-result", [f"k{i},1,1540000000000" for i in range(10)] + ["z,1,1540000090000"]),
    ("access", "access-result",
     [f"/u{i},GET,ok,1,1540000000000,200,5" for i in range(10)] + ["/z,GET,ok,1,1540000090000,200,5"]),
])
def test_restart_after_a_lost_commit_doubles_nothing(spark, tmp_path, job, index, lines):
    src = str(tmp_path / "in")
    write_lines(lines_df(spark, lines), src)
    _run(job, spark, src, tmp_path, fmt="parquet")
    commits = [p for p in glob.glob(str(tmp_path / "ck" / "commits" / "*")) if os.path.basename(p).isdigit()]
    last = max(commits, key=lambda p: int(os.path.basename(p)))
    for p in (last, os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")):
        if os.path.exists(p):
            os.remove(p)
    _run(job, spark, src, tmp_path, fmt="parquet")
    for folder in (index, f"{index}-print"):
        assert spark.read.text(str(tmp_path / "out" / folder)).count() == 10


def test_equal_positions_go_by_partition(spark):
    rows = [(1, 10 * p + s, s, p) for s in range(3) for p in range(2)]
    pairs = spark.createDataFrame(rows[::-1], "key LONG, value LONG, seq LONG, partition INT")
    assert sorted(r.average for r in count_average(pairs, 2).collect()) == [5, 6, 7]
    named = pairs.selectExpr("'n' AS name", "CAST(value AS INT) AS value", "seq", "0 AS bucket", "partition")
    full = chunk_rows(named, 6).full.orderBy("position").collect()
    assert [r.value for r in full] == [0, 10, 1, 11, 2, 12]


def test_prefix_from_command_line(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("one\ntwo\n")
    jobs.main(["prefix", "--source", str(src), "--target", str(tmp_path / "out"), "--checkpoint",
               str(tmp_path / "ck"), "--available-now", "--prefix", ">> "])
    assert sorted(r.value for r in spark.read.parquet(str(tmp_path / "out" / "prefix")).collect()) == [
        ">> one", ">> two"]


@pytest.mark.parametrize("args", [["count", "--prefix", "x"], ["count", "--sink-topic", "t"],
                                  ["count", "--starting", "earliest"],
                                  ["count", "--topic", "t", "--option", "novalue"]])
def test_options_that_do_not_apply(args, capsys):
    with pytest.raises(SystemExit):
        jobs.main([*args, "--source", "s", "--target", "t", "--checkpoint", "c"])
