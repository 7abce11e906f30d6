import json

import pandas as pd
from pyspark.sql import functions as F

from conftest import lines_df
from eddyline.operators import word_count
from eddyline.sinks import (
    access_documents, fan_out, object_documents, print_stream, word_documents,
    write_documents, write_documents_stream, write_lines,
)
from eddyline.sources import read_lines


def test_text_source_static_and_stream(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.txt").write_text("To be\nor not\n")
    static = read_lines(spark, str(d), streaming=False)
    assert static.columns == ["value", "seq", "partition", "timestamp"]
    assert sorted(r.value for r in static.collect()) == ["To be", "or not"]
    stream = read_lines(spark, str(d), streaming=True)
    assert stream.isStreaming
    q = (stream.select("value").writeStream.format("memory")
         .queryName("text_src_test").trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("text_src_test").count() == 2


def test_line_sink_round_trip(spark, tmp_path):
    target = str(tmp_path / "lines")
    write_lines(lines_df(spark, ["a,1,2", "b,3,4"]), target)
    back = read_lines(spark, target, streaming=False, fmt="parquet")
    assert sorted((r.seq, r.value) for r in back.collect()) == [(0, "a,1,2"), (1, "b,3,4")]


def test_word_document_wraps_json_text(spark, tmp_path):
    docs = word_documents(word_count(lines_df(spark, ["hi hi"])))
    (doc,) = [json.loads(r.doc) for r in docs.collect()]
    assert json.loads(doc["data"]) == {"word": "hi", "countSum": 2}
    write_documents(docs, str(tmp_path / "idx"), "word-result")
    assert spark.read.text(str(tmp_path / "idx" / "word-result")).count() == 1


def test_access_document_fields(spark):
    df = spark.createDataFrame(
        [("/a", "GET", "ok", 3, 200, 275, ["t1", "t2"])],
        "url STRING, method STRING, response STRING, count BIGINT, code INT, "
        "response_time_avg INT, times ARRAY<STRING>")
    doc = json.loads(access_documents(df).first().doc)
    assert doc == {"url": "/a", "method": "GET", "response": "ok", "count": 3, "code": 200,
                   "responseTimeAvg": 275, "times": ["t1", "t2"]}
    obj = json.loads(object_documents(df.select("url", "code")).first().doc)
    assert obj == {"url": "/a", "code": 200}


def test_fan_out_and_console(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    pd.DataFrame({"value": ["a b", "c"]}).to_parquet(src / "x.parquet")
    stream = spark.readStream.schema("value STRING").parquet(str(src))
    docs = object_documents(stream)
    outs = [str(tmp_path / "one"), str(tmp_path / "two")]
    writers = [lambda b, e, o=o: b.write.mode("append").text(o) for o in outs]
    q = fan_out(docs, writers, str(tmp_path / "ck"))
    q.awaitTermination()
    for o in outs:
        assert spark.read.text(o).count() == 2
    p = print_stream(stream)
    p.awaitTermination()
    assert p.exception() is None
    s = write_documents_stream(docs, str(tmp_path / "idx"), "obj", str(tmp_path / "ck2"))
    s.awaitTermination()
    assert spark.read.text(str(tmp_path / "idx" / "obj")).count() == 2


def test_topic_source_needs_the_connector(spark):
    import pytest
    from eddyline.sources import kafka_options
    opts = kafka_options("broker:9092", "access", maxOffsetsPerTrigger=1000)
    assert opts["subscribe"] == "access" and opts["maxOffsetsPerTrigger"] == "1000"
    assert opts["startingOffsets"] == "latest"
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        has_connector = True
    except Exception:
        has_connector = False
    if has_connector:
        assert read_lines(spark, opts).isStreaming
    else:
        with pytest.raises(Exception, match="(?i)kafka"):
            read_lines(spark, opts).schema


def test_document_file_size_cap(spark, tmp_path):
    docs = object_documents(spark.range(10).withColumnRenamed("id", "n").coalesce(1))
    write_documents(docs, str(tmp_path), "capped", max_records_per_file=3)
    files = [p for p in (tmp_path / "capped").iterdir() if p.name.startswith("part-")]
    assert len(files) == 4 and spark.read.text(str(tmp_path / "capped")).count() == 10


def test_table_as_directory(spark, tmp_path):
    from conftest import SF_SMALL
    from eddyline.sources import read_table
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(3).write.parquet(
        str(tmp_path / "events.parquet"))
    static = read_table(spark, str(tmp_path), "events")
    assert static.count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    stream = read_table(spark, str(tmp_path), "events", streaming=True)
    q = stream.writeStream.format("memory").queryName("dir_tbl").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("dir_tbl").count() == static.count()


def test_topic_sink_options_and_split_late(spark):
    from pyspark.sql import functions as F
    from eddyline.operators import split_late
    from eddyline.sinks import topic_sink_options
    assert topic_sink_options("b:9092", "out", acks="all") == {
        "kafka.bootstrap.servers": "b:9092", "topic": "out", "acks": "all"}
    df = spark.createDataFrame([(0, 1000, 0, 0), (1, 100000, 1, 0), (2, 5000, 2, 0)],
                               "event_id BIGINT, ms BIGINT, seq BIGINT, partition INT")
    s = split_late(df.withColumn("ts", F.timestamp_millis("ms")), "30 seconds")
    assert sorted(r.ms for r in s.on_time.collect()) == [1000, 100000]
    assert [r.ms for r in s.late.collect()] == [5000]


def test_spread_only_small_inputs(spark, tmp_path):
    from eddyline.sources.lines import spread
    slots = spark.sparkContext.defaultParallelism
    one = spark.range(100).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == slots
    many = spark.range(1000).repartition(slots * 2)
    assert spread(many).rdd.getNumPartitions() == slots * 2      # left alone


def test_materialize_cuts_lineage(spark):
    from eddyline.session import materialize
    df = spark.range(50).withColumn("y", F.col("id") * 2)
    m = materialize(df)
    assert sorted(r.y for r in m.collect()) == [2 * i for i in range(50)]
    assert "Range" not in m._jdf.queryExecution().optimizedPlan().toString()
