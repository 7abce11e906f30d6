from pyspark.sql import functions as F

from conftest import SF_ORACLE
from eddyline.operators import sql_filter, union_all_filtered, word_sessions
from eddyline.sources import event_lines, read_table


def _lines(spark, rows):
    df = spark.createDataFrame(rows, "value STRING, s BIGINT")
    return df.select("value", F.col("s").alias("seq"), F.lit(0).alias("partition"),
                     F.timestamp_seconds("s").alias("timestamp"))


def test_gap_equal_merges(spark):
    df = _lines(spark, [("a", 0), ("a", 600), ("a", 1199), ("b", 0), ("b", 601)])
    got = sorted((r.word, int(r.session_start.timestamp()), int(r.session_end.timestamp()),
                  r.count_sum) for r in word_sessions(df).collect())
    assert got == [("a", 0, 1799, 3), ("b", 0, 600, 1), ("b", 601, 1201, 1)]


def test_equal_times_share_a_session(spark):
    df = _lines(spark, [("a", 0), ("a", 700), ("a", 700), ("a", 700)])
    got = sorted((int(r.session_start.timestamp()), r.count_sum)
                 for r in word_sessions(df).collect())
    assert got == [(0, 1), (700, 3)]


def test_session_partitioning_does_not_change_result(spark):
    lines = event_lines(read_table(spark, SF_ORACLE, "events"))
    a = word_sessions(lines)
    b = word_sessions(lines.repartition(5))
    assert a.count() == 17079
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_union_all_keeps_duplicates_drops_equal(spark):
    df = spark.createDataFrame([(1, "x", 3), (2, "y", 1), (3, "z", 2), (1, "x", 3)],
                               "user BIGINT, product STRING, amount INT")
    got = sorted(r.user for r in union_all_filtered(df, df).collect())
    assert got == [1, 1, 2]
    assert sql_filter(df, "amount > 2").count() == 2


def test_union_of_one_source_is_one_scan(spark):
    df = spark.createDataFrame([(1, 3), (2, 1), (3, 2), (4, 5)], "user BIGINT, amount INT")
    u = union_all_filtered(df, df, "amount > 2", "amount > 4")   # user 4 matches both
    assert sorted(r.user for r in u.collect()) == [1, 4, 4]
    plan = u._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
    two = union_all_filtered(df, df.where("user > 1"), "amount > 2", "amount > 4")
    assert sorted(r.user for r in two.collect()) == [1, 4, 4]
