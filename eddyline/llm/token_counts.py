"""Operator 6, token counts from an exact histogram of encoded lengths.

Documents are counted per encoded length (a partial aggregate, one row per
length leaves a task); suffix sums over the lengths then answer, for every
context limit, how many documents and tokens there are, what a limit keeps and
how many documents it cuts.  Between two listed lengths every answer is linear
in the limit, so the listed rows hold all limits exactly (:func:`at_limit`).

The suffix sums run inside ranges of ``RANGE`` lengths plus a carry over the
ranges, so no single task has to hold all lengths.

Nulls: a null text has length 0, as an empty one.  Repeated rows count as often
as they occur.  An empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eddyline.llm.bpe import count_column, share_tokenizer
from eddyline.llm.common import materialize

RANGE = 1 << 10      # lengths of one range


def encoded_lengths(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """``n_tokens`` of every document."""
    shared = share_tokenizer(docs.sparkSession, tokenizer)
    return docs.select(count_column(shared, F.col(f"`{text_col}`")).alias("n_tokens"))


def length_histogram(lengths: DataFrame, col: str = "n_tokens") -> DataFrame:
    """``n_tokens, n_docs``: exact, one row per length that occurs."""
    return lengths.groupBy(F.col(col).cast("bigint").alias("n_tokens")).agg(
        F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Per length ``L`` that occurs, taken as a context limit:

    ``docs_from`` / ``tokens_from``: documents of ``L`` tokens or more, and
    their tokens; ``docs_below`` / ``tokens_below``: the shorter ones;
    ``docs_cut``: documents longer than ``L``; ``tokens_kept``: the corpus'
    tokens when every document is cut at ``L``; ``total_docs``,
    ``total_tokens``; ``quantile``: share of documents of at most ``L`` tokens.
    """
    h = histogram.withColumn("r", F.expr(f"n_tokens div {RANGE}")).withColumn(
        "tokens", F.col("n_tokens") * F.col("n_docs"))
    ranges = h.groupBy("r").agg(F.sum("n_docs").alias("rd"), F.sum("tokens").alias("rt"))
    after = Window.orderBy(F.col("r").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.col("r").desc()).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    ranges = ranges.select(
        "r", F.coalesce(F.sum("rd").over(after), F.lit(0)).alias("cd"),
        F.coalesce(F.sum("rt").over(after), F.lit(0)).alias("ct"),
        F.sum("rd").over(whole).alias("total_docs"), F.sum("rt").over(whole).alias("total_tokens"))
    inside = (Window.partitionBy("r").orderBy(F.col("n_tokens").desc())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = (h.withColumn("sd", F.sum("n_docs").over(inside))
           .withColumn("st", F.sum("tokens").over(inside)).join(ranges, "r")
           .withColumn("docs_from", F.col("sd") + F.col("cd"))
           .withColumn("tokens_from", F.col("st") + F.col("ct")))
    cut = F.col("docs_from") - F.col("n_docs")
    return out.select(
        "n_tokens", "n_docs", "docs_from", "tokens_from",
        (F.col("total_docs") - F.col("docs_from")).alias("docs_below"),
        (F.col("total_tokens") - F.col("tokens_from")).alias("tokens_below"),
        cut.alias("docs_cut"),
        (F.col("total_tokens") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")).alias("tokens_kept"),
        "total_docs", "total_tokens",
        ((F.col("total_docs") - cut) / F.col("total_docs")).alias("quantile"))


def token_counts(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """The sums of the documents' lengths.  The histogram is written once, as
    two branches of the sums read it: the texts are encoded only once."""
    return suffix_sums(materialize(length_histogram(encoded_lengths(docs, tokenizer, text_col))))


def at_limit(counts: DataFrame, limit: int) -> DataFrame:
    """Totals for any context limit: one row ``docs_cut, tokens_kept``."""
    above = F.col("n_tokens") > limit
    return counts.agg(
        F.coalesce(F.sum(F.when(above, F.col("n_docs"))), F.lit(0)).alias("docs_cut"),
        F.coalesce(F.sum(F.col("n_docs") * F.least("n_tokens", F.lit(limit))), F.lit(0)).alias("tokens_kept"))


def length_quantile(counts: DataFrame, share: float) -> DataFrame:
    """The smallest length that at least ``share`` of the documents do not exceed."""
    return counts.where(F.col("quantile") >= share).agg(F.min("n_tokens").alias("n_tokens"))
