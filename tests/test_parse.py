import pytest

from conftest import lines_df
from eddyline.operators import parse_access_lines, parse_count_lines, parse_orders


def test_count_line_arity_and_numbers(spark):
    df = lines_df(spark, ["a,1,123,", "a,1,", "a,,3", ",,,", "a, 5,9", "a,+2,77"])
    p = parse_count_lines(df)
    rows = [(r.key, r["count"], r.time_text) for r in p.rows.orderBy("seq").collect()]
    assert rows == [("a", 1, "123"), ("a", 2, "77")]
    rej = {r.seq: r.reason for r in p.rejects.collect()}
    assert rej == {1: "arity", 2: "bad count", 3: "arity", 4: "bad count"}


def test_bad_time_becomes_epoch_zero(spark):
    df = lines_df(spark, ["k,1,notatime"])
    r = parse_count_lines(df).rows.first()
    assert r.ms == 0 and r.time_text == "notatime"


def test_fail_mode_raises_on_bad_number(spark):
    df = lines_df(spark, ["a,x,1"])
    with pytest.raises(Exception):
        parse_count_lines(df, on_error="fail").rows.collect()
    # wrong arity is dropped, not fatal
    assert parse_count_lines(lines_df(spark, ["a,1"]), on_error="fail").rows.count() == 0


def test_access_line_seven_fields(spark):
    df = lines_df(spark, ["/a,GET,ok,1,1540000000000,200,100", "/a,GET,ok,1,1540000000000,200",
                          "/a,GET,ok,1,1540000000000,2x0,100"])
    p = parse_access_lines(df)
    assert [r.took_ms for r in p.rows.collect()] == [100]
    assert sorted(r.reason for r in p.rejects.collect()) == ["arity", "bad number"]


def test_orders_json(spark):
    msgs = ['{"user":1,"product":"beer","amount":3}', '{"user":2,"product":"pen","amount":1}',
            '{"user":3,"product":"ink","amount":2}', '{"user":4,"product":"gum"}',
            '{"user":5,"product":"tv","amount":301}', '{bad', "", "null"]
    p = parse_orders(lines_df(spark, msgs))
    rows = {r.user: r.amount for r in p.rows.collect()}
    assert rows == {1: 3, 2: 1, 3: 2, 4: 0, 5: 301}
    assert [(r.value, r.reason) for r in p.rejects.collect()] == [("{bad", "malformed json")]


def test_orders_quoted_amount_and_bad_user(spark):
    p = parse_orders(lines_df(spark, ['{"user":"7","amount":"5"}', '{"user":"x"}']))
    assert [(r.user, r.amount) for r in p.rows.collect()] == [(7, 5)]
    assert [r.reason for r in p.rejects.collect()] == ["bad user"]


def test_extreme_numbers_do_not_stop_the_query(spark):
    from eddyline.operators import access_window_reduce, count_window_reduce
    msgs = ["k,1,9223372036854775807", "k,1,-9223372036854775808",
            "k,2147483647,1540000000000", "k,2147483647,1540000000001"]
    rows = parse_count_lines(lines_df(spark, msgs)).rows
    got = {(r.window_start.timestamp(), r["count"]) for r in count_window_reduce(rows).collect()}
    assert got == {(1539999990.0, 4294967294)}     # times out of range are set aside
    assert [r.reason for r in parse_count_lines(lines_df(spark, msgs)).rejects.collect()] == [
        "time out of range"] * 2
    out = count_window_reduce(rows, times_mode="compat").first()
    assert out.times == ["2018/20/10 01:46:40"] * 2
    acc = parse_access_lines(lines_df(spark, ["/a,GET,ok,1,1,200,2147483647",
                                              "/a,GET,ok,1,2,200,2147483647"])).rows
    (r,) = access_window_reduce(acc).collect()
    assert r.response_time_avg == 2147483647


def test_fail_mode_orders_and_access(spark):
    with pytest.raises(Exception):
        parse_orders(lines_df(spark, ['{"user":1,"amount":2}', "{bad"]), on_error="fail").rows.collect()
    ok = parse_orders(lines_df(spark, ['{"user":1,"amount":2}']), on_error="fail").rows.collect()
    assert [(r.user, r.amount) for r in ok] == [(1, 2)]
    with pytest.raises(Exception):
        parse_access_lines(lines_df(spark, ["/a,GET,ok,1,1,200,x"]), on_error="fail").rows.collect()
    with pytest.raises(ValueError):
        parse_access_lines(lines_df(spark, ["x"]), on_error="ignore")
