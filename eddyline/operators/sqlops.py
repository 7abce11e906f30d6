"""SQL over (streaming) frames: filters and UNION ALL.

Frames are passed to ``spark.sql`` as named arguments, the way a table object
is spliced into query text; this works for static and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER_COLUMNS = ["user", "product", "amount"]


def as_table(df: DataFrame, columns: list[str] = ORDER_COLUMNS) -> DataFrame:
    """Name a stream's fields (the positional field list of the reference)."""
    return df.select(*columns)


def sql_filter(df: DataFrame, predicate: str) -> DataFrame:
    """``SELECT * FROM df WHERE <predicate>``."""
    return df.sparkSession.sql(f"SELECT * FROM {{t}} WHERE {predicate}", t=df)


def union_all_filtered(a: DataFrame, b: DataFrame, pred_a: str = "amount > 2",
                       pred_b: str = "amount < 2") -> DataFrame:
    """``SELECT * FROM a WHERE pred_a UNION ALL SELECT * FROM b WHERE pred_b``;
    duplicates are kept and rows matching neither side are dropped.

    When ``a`` and ``b`` are the same source (the same frame, or static frames
    with the same plan: one topic read twice), the union is one scan that
    emits each row once per branch it matches, instead of reading and parsing
    the input twice.
    """
    same = a is b or (not a.isStreaming and not b.isStreaming and a.sameSemantics(b))
    if same:
        hits = F.filter(F.array(F.expr(f"({pred_a})"), F.expr(f"({pred_b})")), lambda h: h)
        return a.select("*", F.explode(hits).alias("_hit")).drop("_hit")
    return a.sparkSession.sql(
        f"SELECT * FROM {{a}} WHERE {pred_a} UNION ALL SELECT * FROM {{b}} WHERE {pred_b}",
        a=a, b=b)
