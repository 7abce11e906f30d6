"""Prefix maps over lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.functions.text import prefix_chars_array

# Fixed value: the default prefix.
DEFAULT_PREFIX = "PREFIX:"


def prefix_lines(lines: DataFrame, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """Each line with ``prefix`` in front."""
    return lines.select("seq", F.concat(F.lit(prefix), F.col("value")).alias("value"))


def prefix_chars(lines: DataFrame, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """One row per character of ``prefix + line``, with its position."""
    return lines.select("seq", F.posexplode(prefix_chars_array("value", prefix))
                        .alias("pos", "ch"))


def char_counts(lines: DataFrame, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """How often each character occurs over all prefixed lines."""
    return (lines.select(F.explode(prefix_chars_array("value", prefix)).alias("ch"))
            .groupBy("ch").agg(F.count("*").alias("n")))
