"""Randomised checks of the column functions against plain-Python models.
All cases of a test go through Spark in one DataFrame."""

import random
import re

from pyspark.sql import functions as F

from eddyline.functions import (
    apply_map, fold_maps, halving_average, halving_map, java_split, strict_int, tokens,
)

random.seed(20261202)


def _java_split(s: str, sep: str = ",") -> list[str]:
    parts = s.split(sep)
    while len(parts) > 1 and parts[-1] == "":
        parts.pop()
    return parts            # Java keeps [""] for "" and gives [] for ",,,"


def test_java_split_model(spark):
    alphabet = ["a", "b", ",", ",", " ", "1"]
    cases = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 8))) for _ in range(400)]
    df = spark.createDataFrame([(c,) for c in cases], "s STRING")
    got = [r.f for r in df.select(java_split("s").alias("f")).collect()]
    for c, g in zip(cases, got):
        want = _java_split(c)
        if want == []:       # only separators: Spark leaves one empty part
            assert g == [""], c
        else:
            assert g == want, c


def test_strict_int_model(spark):
    pool = ["0", "7", "-3", "+12", " 5", "5 ", "1e3", "2147483647", "2147483648",
            "-2147483648", "-2147483649", "", "x", "0x1f", "007", "+-1", "3.0"]
    cases = pool + [str(random.randint(-10**12, 10**12)) for _ in range(100)]
    df = spark.createDataFrame([(c,) for c in cases], "s STRING")
    got = [r.v for r in df.select(strict_int("s").alias("v")).collect()]
    for c, g in zip(cases, got):
        ok = re.fullmatch(r"[+-]?[0-9]+", c) and -2**31 <= int(c) < 2**31
        assert g == (int(c) if ok else None), c


def test_tokens_model(spark):
    alphabet = list("abZ_9 ,.-é\t") + ["ß", "É"]
    cases = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 30))) for _ in range(300)]
    df = spark.createDataFrame([(c,) for c in cases], "s STRING")
    got = [r.t for r in df.select(tokens("s").alias("t")).collect()]
    for c, g in zip(cases, got):
        want = [t for t in re.split(r"[^a-z0-9_]+", c.lower()) if t]
        assert g == want, c


def test_halving_maps_equal_list_fold(spark):
    rows = []
    for _ in range(300):
        n = random.randint(1, 120)
        hi = random.choice([1, 3, 1000, 2**31 - 1])
        xs = [random.randint(0, hi) for _ in range(n)]
        cut = sorted(random.sample(range(1, n), min(n - 1, random.randint(0, 4)))) if n > 1 else []
        parts = [xs[i:j] for i, j in zip([0] + cut, cut + [n])]
        acc = xs[0]
        for x in xs[1:]:
            acc = (acc + x) // 2
        rows.append((xs, parts, acc))
    df = spark.createDataFrame(rows, "xs ARRAY<INT>, parts ARRAY<ARRAY<INT>>, want INT")
    per_part = F.transform("parts", lambda p: fold_maps(F.transform(p, halving_map)))
    out = df.select(
        "want", halving_average("xs").alias("list_fold"),
        apply_map(fold_maps(per_part), F.col("xs")[0]).alias("by_maps"))
    for r in out.collect():
        assert r.list_fold == r.want and r.by_maps == r.want


def test_running_equals_one_window(spark):
    from pyspark.sql import Window
    from eddyline.operators import running
    from eddyline.operators.scan import seq_bucket
    rows = []
    for i in range(3000):
        key = random.choice([1, 1, 1, 2, 3])              # key 1 is hot
        v = random.choice([None, random.randint(-50, 50)])
        rows.append((key, random.randint(0, 400), i, v))  # ord has ties; seq is unique
    df = spark.createDataFrame(rows, "k INT, ord BIGINT, seq BIGINT, v BIGINT")
    for op, agg in (("sum", F.sum), ("max", F.max)):
        for inclusive in (True, False):
            end = Window.currentRow if inclusive else -1
            w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, end)
            want = df.withColumn("r", agg("v").over(w))
            if op == "sum":
                want = want.withColumn("r", F.coalesce("r", F.lit(0)))
            for width in (7, 97, 10**6):
                got = running(df, ["k"], ["seq"], F.col("v"), op, "r", seq_bucket("seq", width),
                              inclusive=inclusive)
                if op == "sum":
                    got = got.withColumn("r", F.coalesce("r", F.lit(0)))
                assert got.exceptAll(want).count() == 0, (op, inclusive, width)
        # peers: equal order values are taken together
        wp = Window.partitionBy("k").orderBy("ord").rangeBetween(Window.unboundedPreceding, 0)
        want = df.withColumn("r", agg("v").over(wp))
        got = running(df, ["k"], ["ord"], F.col("v"), op, "r", seq_bucket("ord", 13), peers=True)
        if op == "sum":
            want = want.withColumn("r", F.coalesce("r", F.lit(0)))
            got = got.withColumn("r", F.coalesce("r", F.lit(0)))
        assert got.exceptAll(want).count() == 0, (op, "peers")
