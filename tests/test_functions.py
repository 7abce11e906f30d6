from pyspark.sql import functions as F

from conftest import lines_df
from eddyline.functions import fmt_epoch_ms, halving_average, java_split, tokens
from eddyline.operators import char_counts, parse_first_three, prefix_chars, word_count


def test_tokenise_ascii_word_characters(spark):
    df = lines_df(spark, ["To be, or not to be: déjà-vu"])
    got = {r.word: r.count_sum for r in word_count(df).collect()}
    assert got == {"to": 2, "be": 2, "or": 1, "not": 1, "d": 1, "j": 1, "vu": 1}


def test_tokens_drop_empty(spark):
    r = spark.range(1).select(tokens(F.lit("  ,Hello__x9 !")).alias("t")).first()
    assert r.t == ["hello__x9"]


def test_java_split_drops_trailing_empties(spark):
    r = spark.range(1).select(
        F.size(java_split(F.lit("a,1,123,"))).alias("a"),
        F.size(java_split(F.lit("a,1,"))).alias("b"),
        java_split(F.lit("a,,3")).alias("c"),
        F.size(java_split(F.lit(",,,"))).alias("d")).first()
    assert (r.a, r.b, r.c, r.d) == (3, 2, ["a", "", "3"], 1)


def test_first_three_fields(spark):
    df = lines_df(spark, ["A,B,C,D", "A,B", "A,B,,"])
    got = [tuple(r) for r in parse_first_three(df).orderBy("seq").collect()]
    assert got == [(0, "a", "b", "c")]


def test_prefix_characters(spark):
    df = lines_df(spark, ["ab"])
    got = [r.ch for r in prefix_chars(df).orderBy("pos").collect()]
    assert got == list("PREFIX:ab")
    counts = {r.ch: r.n for r in char_counts(df).collect()}
    assert counts["a"] == 1 and counts["P"] == 1 and sum(counts.values()) == 9


def test_format_day_before_month(spark):
    r = spark.range(1).select(fmt_epoch_ms(F.lit(1540000000000)).alias("t")).first()
    assert r.t == "2018/20/10 01:46:40"


def test_halving_average(spark):
    r = spark.range(1).select(
        halving_average(F.array(F.lit(100), F.lit(200), F.lit(400))).alias("a"),
        halving_average(F.array(F.lit(7))).alias("b"),
        halving_average(F.array(F.lit(-3), F.lit(0))).alias("c")).first()
    assert (r.a, r.b, r.c) == (275, 7, -1)   # -3/2 truncates toward zero
