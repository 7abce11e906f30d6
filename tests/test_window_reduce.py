from pyspark.sql import functions as F

from conftest import lines_df
from eddyline.operators import (
    access_window_reduce, count_window_reduce, parse_access_lines, parse_count_lines,
)


def _count(spark, msgs, mode, window="30 seconds"):
    rows = parse_count_lines(lines_df(spark, msgs)).rows
    return count_window_reduce(rows, window, mode).orderBy("window_start", "key").collect()


def test_one_key_reduce(spark):
    msgs = ["k,1,1540000000000", "k,2,1540000001234", "k,3,1540000002000"]
    times = ["2018/20/10 01:46:40", "2018/20/10 01:46:41", "2018/20/10 01:46:42"]
    for mode in ("clean", "compat"):
        (r,) = _count(spark, msgs, mode)
        assert r["count"] == 6 and r.times == times
        assert r.window_start.timestamp() == 1539999990
        assert r.window_end.timestamp() == 1540000020


def test_compat_first_time_without_marker(spark):
    msgs = ["m,1,1541234567890", "m,1,1541234568890"]
    (c,) = _count(spark, msgs, "compat")
    assert c["count"] == 2 and c.times == ["1541234567890", "2018/03/11 08:42:48"]
    (k,) = _count(spark, msgs, "clean")
    assert k.times == ["2018/03/11 08:42:47", "2018/03/11 08:42:48"]


def test_compat_single_row(spark):
    (c,) = _count(spark, ["s,5,1540000000000"], "compat")
    assert c["count"] == 5 and c.times == ["1540000000000"]
    (k,) = _count(spark, ["s,5,1540000000000"], "clean")
    assert k.times == ["2018/20/10 01:46:40"]


def test_order_comes_from_seq_not_input_order(spark):
    msgs = ["k,1,1540000000000", "k,2,1540000001234", "k,3,1540000002000"]
    df = lines_df(spark, msgs).orderBy(F.col("seq").desc()).repartition(3)
    (r,) = count_window_reduce(parse_count_lines(df).rows).collect()
    assert r.times[0] == "2018/20/10 01:46:40"


def test_two_key_reduce(spark):
    msgs = ["/a,GET,ok,1,1540000000000,200,100", "/a,POST,ok,1,1540000001000,500,200",
            "/a,PUT,ok,1,1540000002000,404,400"]
    rows = parse_access_lines(lines_df(spark, msgs)).rows
    (r,) = access_window_reduce(rows).collect()
    assert (r.url, r.response, r.method, r.code, r["count"]) == ("/a", "ok", "GET", 200, 3)
    assert r.response_time_avg == 275
    assert abs(r.response_time_mean - 233.333333) < 1e-5
    assert r.times == ["2018/20/10 01:46:40 took100ms", "2018/20/10 01:46:41 took200ms",
                       "2018/20/10 01:46:42 took400ms"]
    (c,) = access_window_reduce(rows, times_mode="compat").collect()
    assert c.times == r.times   # first raw time contains 000: formatted


def test_two_key_compat_single_row(spark):
    rows = parse_access_lines(lines_df(spark, ["/b,GET,ok,1,1540000000000,200,70"])).rows
    (c,) = access_window_reduce(rows, times_mode="compat").collect()
    assert c.times == ["1540000000000"] and c.response_time_avg == 70


def test_window_stats_equal_list_reduce(spark):
    from conftest import SF_ORACLE
    from eddyline.operators import access_window_stats
    from eddyline.sources import access_lines, read_table
    rows = parse_access_lines(access_lines(read_table(spark, SF_ORACLE, "events"))).rows
    cols = ["url", "response", "window_start", "method", "code", "count", "response_time_avg"]
    full = access_window_reduce(rows, "6 hours").select(*cols)
    for width in (1 << 40, 5):      # one bucket per window / about 6 rows per bucket
        stats = access_window_stats(rows, "6 hours", bucket_width=width).select(*cols)
        assert stats.exceptAll(full).count() == 0 and full.exceptAll(stats).count() == 0


def test_window_stats_one_hot_window(spark):
    from eddyline.operators import access_window_stats
    import random
    random.seed(7)
    took = [random.randint(0, 5000) for _ in range(3000)]
    msgs = [f"/hot,GET,ok,1,{1540000000000 + i},200,{t}" for i, t in enumerate(took)]
    rows = parse_access_lines(lines_df(spark, msgs)).rows
    (r,) = access_window_stats(rows, "1 hour", bucket_width=17).collect()
    acc = took[0]
    for t in took[1:]:
        acc = (acc + t) // 2
    assert r.response_time_avg == acc and r["count"] == 3000


def test_times_mode_none(spark):
    msgs = ["/a,GET,ok,1,1540000000000,200,100", "/a,POST,ok,1,1540000001000,500,200",
            "/a,PUT,ok,1,1540000002000,404,400"]
    (r,) = access_window_reduce(parse_access_lines(lines_df(spark, msgs)).rows,
                                times_mode="none").collect()
    assert "times" not in r.asDict() and r.response_time_avg == 275 and r.method == "GET"
    (c,) = _count_none(spark)
    assert c["count"] == 6 and "times" not in c.asDict()


def _count_none(spark):
    msgs = ["k,1,1540000000000", "k,2,1540000001234", "k,3,1540000002000"]
    rows = parse_count_lines(lines_df(spark, msgs)).rows
    return count_window_reduce(rows, times_mode="none").collect()


def test_two_key_compat_first_time_without_marker(spark):
    msgs = ["/a,GET,ok,1,1541234567890,200,10", "/a,POST,ok,1,1541234568890,500,20"]
    rows = parse_access_lines(lines_df(spark, msgs)).rows
    (c,) = access_window_reduce(rows, "1 hour", times_mode="compat").collect()
    assert c.times == ["1541234567890 took10ms", "2018/03/11 08:42:48 took20ms"]
    assert (c.method, c.code, c.response_time_avg) == ("GET", 200, 15)


def test_window_stats_latencies_of_any_sign(spark):
    from eddyline.operators import access_window_stats
    import random
    random.seed(11)
    extremes = [-2**31, 2**31 - 1, -1, 0, 1]
    runs = {"/mixed": [random.randint(-5000, 5000) for _ in range(700)],
            "/rare": [t if random.random() < 0.02 else abs(t)
                      for t in (random.randint(-3, 3) for _ in range(700))],
            "/below": [-random.randint(0, 9) for _ in range(200)],
            "/ends": random.choices(extremes, k=400),
            "/first": [-2**31] + [0] * 90, "/one": [-5], "/last": [0] * 60 + [-7]}
    msgs = [f"{url},GET,ok,1,{1540000000000 + i},200,{t}" for url, took in runs.items()
            for i, t in enumerate(took)]
    rows = parse_access_lines(lines_df(spark, msgs)).rows
    expect = {}
    for url, took in runs.items():
        acc = took[0]
        for t in took[1:]:
            acc = int((acc + t) / 2)     # toward zero
        expect[url] = acc
    for width in (1 << 40, 100, 7):
        got = {r.url: r.response_time_avg
               for r in access_window_stats(rows, "1 hour", bucket_width=width).collect()}
        assert got == expect
