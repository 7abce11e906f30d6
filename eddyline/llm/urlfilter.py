"""Operator 9, URL filter by a character language-model ratio.

URLs that a rule accepts and URLs that a rule rejects train two variable-order
Markov models over the characters of the whole URL, scheme, query and fragment included.  A character's probability after its context is
interpolated from the longest context (``ORDER`` characters) down to none:
``p_k = (count + STRENGTH * p_(k-1)) / (context count + STRENGTH)``, from a
uniform ``p_(-1)``.  A URL's score is the mean over its characters of the log
ratio of both models; a threshold calibrated on rule-judged URLs that the models were
not trained on (about 3 in 16, by a hash of the URL) turns it into a verdict for the URLs that
no rule judges.

All work is DataFrame expressions:

* equal URLs are one row with a weight before anything is split into characters; a URL is
  split once, in linear time;
* the counts of the longest grams are one partial aggregate; every shorter
  context follows from them by summing;
* a URL's characters meet the gram scores in a hash join.  Grams that make up
  more than 1 / ``HOT_SHARE`` of all characters are at most ``HOT_SHARE``
  by arithmetic, and only those are broadcast; so no gram that occurs in every
  URL gathers in one task.

Scores are whole micro-units, so sums do not depend on the order of rows.  The
threshold lies between the class means, each at the same number of standard
deviations; where the rows held back lack a class it is set on all rule-judged ones.  If either
class is missing altogether, every unjudged URL is allowed.

Nulls: a null URL is the empty text; it, and one without ``://``, has an empty host and path
and no rule, and the models judge the text it has.  Repeated rows each keep their row, an empty
table gives no row, a URL of any length is judged whole.  Of the input's columns only those of the
five result names are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.llm.common import fresh, materialize

ORDER = 4            # characters of the longest context
STRENGTH = 4.0       # weight of the shorter context
SYMBOLS = 256.0      # the uniform model's characters
HOT_SHARE = 1000
START, END = "\u0002", "\u0003"

# The rules of the registered query (verdict, host and path).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null if none fits."""
    rule = verdict = None
    for says, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        h, slash, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def _characters(text: Column, order: int) -> Column:
    """The characters of the text between ``order`` starts and an end."""
    return F.concat(F.array_repeat(F.lit(START), order), F.filter(F.split(text, ""), lambda c: c != ""),
                    F.array(F.lit(END)))


def _grams(chars: Column, order: int) -> Column:
    """The gram (context and character) that ends at each character of the text."""
    size = F.size(chars) - order
    grams = F.slice(chars, 1, size)
    for i in range(order):
        grams = F.zip_with(grams, F.slice(chars, i + 2, size), lambda a, b: F.concat(a, b))
    return grams


def spelt(urls: DataFrame, *cols: str | Column, order: int = ORDER) -> DataFrame:
    """One row per character of ``text``: ``gram`` and ``cols``."""
    chars = fresh(urls, "_chars")
    return urls.withColumn(chars, _characters(F.col("text"), order)).select(
        F.explode(_grams(F.col(chars), order)).alias("gram"), *cols)


def held_back(text: Column) -> Column:
    """About 3 in 16 of the texts, by content."""
    return F.substring(F.md5(text), 1, 1).isin("0", "1", "2")


def gram_counts(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, n, good, bad`` of ``urls(text, weight, verdict)``: occurrences in
    all URLs and in those, not held back, that a rule allows or blocks."""
    taught = F.when(~held_back(F.col("text")), F.col("verdict")).alias("verdict")
    g = spelt(urls, "weight", taught, order=order)
    part = lambda v: F.sum(F.when(F.col("verdict") == v, F.col("weight")).otherwise(0))
    return g.groupBy("gram").agg(F.sum("weight").alias("n"), part("allow").alias("good"), part("block").alias("bad"))


def gram_scores(counts: DataFrame, order: int = ORDER, strength: float = STRENGTH) -> DataFrame:
    """``gram, n, score``: log ratio of both models in micro-units."""
    s = counts.select("gram", "n").withColumns({"pg": F.lit(1 / SYMBOLS), "pb": F.lit(1 / SYMBOLS)})
    for k in range(order + 1):
        # Counts of the gram's last k + 1 characters, and of their first k.
        end = F.substring("gram", order + 1 - k, k + 1)
        grams = counts.groupBy(end.alias("g")).agg(F.sum("good").alias("cg"), F.sum("bad").alias("cb"))
        context = grams.groupBy(F.substring("g", 1, k).alias("c")).agg(
            F.sum("cg").alias("tg"), F.sum("cb").alias("tb"))
        table = grams.join(context, F.substring("g", 1, k) == F.col("c")).drop("c")
        s = s.withColumn("e", end).join(table, F.col("e") == F.col("g"))
        blend = lambda p, n, t: (F.col(n) + strength * F.col(p)) / (F.col(t) + strength)
        s = s.select("gram", "n", blend("pg", "cg", "tg").alias("pg"), blend("pb", "cb", "tb").alias("pb"))
    return s.select("gram", "n", F.round((F.ln("pg") - F.ln("pb")) * 1e6).cast("bigint").alias("score"))


def score_texts(urls: DataFrame, scores: DataFrame, total: int, order: int = ORDER) -> DataFrame:
    """``uid, score``: the mean log ratio per character of every ``text``; the text
    itself does not travel with its characters."""
    limit = total // HOT_SHARE
    hot = scores.where(F.col("n") > limit).select("gram", F.col("score").alias("hot"))
    cold = scores.where(F.col("n") <= limit).select("gram", "score")
    g = spelt(urls.select("uid", "text"), "uid", order=order)
    g = g.join(F.broadcast(hot), "gram", "left")
    seen = g.groupBy("uid").agg(F.sum("hot").alias("s"), F.count(F.lit(1)).alias("n"))
    rest = (g.where("hot is null").groupBy("uid", "gram").agg(F.count(F.lit(1)).alias("m"))
            .join(cold, "gram").groupBy("uid").agg(F.sum(F.col("score") * F.col("m")).alias("r")))
    zero = F.lit(0).cast("bigint")
    return seen.join(rest, "uid", "left").select(
        "uid", ((F.coalesce("s", zero) + F.coalesce("r", zero)) / F.col("n")).alias("score"))


def threshold(scored: DataFrame) -> float | None:
    """The score as many standard deviations below the accepted mean as above
    the rejected one, from ``scored(text, score, weight, verdict)``."""
    unit = F.round("score").cast("decimal(20,0)")
    w = F.col("weight")
    rows = scored.where("verdict is not null").groupBy(held_back(F.col("text")).alias("held"), "verdict").agg(
        F.sum(w).cast("double").alias("n"), F.sum(unit * w).cast("double").alias("s"),
        F.sum(unit * unit * w).cast("double").alias("q")).collect()      # at most four rows
    held = {r["verdict"]: (r["n"], r["s"], r["q"]) for r in rows if r["held"]}
    every: dict[str, tuple] = {}
    for r in rows:
        a = every.get(r["verdict"], (0.0, 0.0, 0.0))
        every[r["verdict"]] = (a[0] + r["n"], a[1] + r["s"], a[2] + r["q"])
    got = held if len(held) == 2 else every
    if len(got) < 2:
        return None
    stat = {}
    for k, (n, total, squares) in got.items():
        mean = total / n
        stat[k] = mean, max(squares / n - mean * mean, 0.0) ** 0.5 + 1.0
    (ma, sa), (mb, sb) = stat["allow"], stat["block"]
    return (ma * sb + mb * sa) / (sa + sb)


def accuracy(scored: DataFrame, cut: float) -> dict[str, tuple[int, int]]:
    """Of each verdict's URLs held back from the models: how many lie on its side of ``cut``,
    and how many there are."""
    right = (F.col("score") >= cut) == (F.col("verdict") == "allow")
    rows = (scored.where(held_back(F.col("text")) & F.col("verdict").isNotNull()).groupBy("verdict")
            .agg(F.sum(F.when(right, F.col("weight")).otherwise(0)).alias("right"), F.sum("weight").alias("n")).collect())
    return {r["verdict"]: (r["right"], r["n"]) for r in rows}


def score_urls(pages: DataFrame, url_col: str = "url", rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``text, score, weight, verdict`` of every different URL; the verdict is its rule's or null."""
    text = F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit("")).alias("text")
    host, path = url_host(F.col("text")), url_path(F.col("text"))
    d = pages.select(text).groupBy("text").agg(F.count(F.lit(1)).alias("weight"))
    d = d.withColumn("verdict", matching_rule(host, path, rules)[1])
    # Dealt out anew: a small table would stay in one task, and a URL is many characters.
    conf = pages.sparkSession
    parts = max(conf.sparkContext.defaultParallelism, int(conf.conf.get("spark.sql.shuffle.partitions")))
    urls = materialize(d.repartition(parts, "text").withColumn("uid", F.monotonically_increasing_id()))
    scores = materialize(gram_scores(materialize(gram_counts(urls))))
    total = scores.agg(F.sum("n")).first()[0] or 0
    return materialize(score_texts(urls, scores, total).join(urls, "uid").select(
        "text", "score", "weight", "verdict"))


def judge_urls(pages: DataFrame, url_col: str = "url", rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict, score`` (columns of these
    names are replaced).  ``score``: mean log ratio per character in
    micro-units; the verdict is the rule's, else allow at or above the threshold."""
    new = ("host", "path", "rule", "verdict", "score")
    rest = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in new]
    text = fresh(pages.select(*rest, *map(F.lit, new)), "_url")
    scored = score_urls(pages, url_col, rules)
    cut = threshold(scored)
    host, path = url_host(F.col("text")), url_path(F.col("text"))
    rule, says = matching_rule(host, path, rules)
    lm = F.when(F.lit(cut is None) | (F.col("score") >= F.lit(cut or 0.0)), "allow").otherwise("block")
    judged = scored.select(F.col("text").alias(text), F.struct(
        host.alias("host"), path.alias("path"), rule.alias("rule"), F.coalesce(says, lm).alias("verdict"),
        F.round("score").cast("bigint").alias("score")).alias(text + "s"))
    d = pages.withColumn(text, F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit("")))
    return d.join(judged, text).select(*rest, *[F.col(f"{text}s.{c}").alias(c) for c in new])
