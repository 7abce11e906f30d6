"""Running aggregates that do not put a hot key into one task.

A running ``max``/``sum`` over the rows of a key in order is normally a window
``partitionBy(key).orderBy(o)``: every row of the key goes to one task, so a
key holding a third of all rows becomes a third of the job in one task.

Here the order range is cut into buckets.  Level one aggregates each
``(key, bucket)`` (a partial aggregation, no row leaves its map side),
then carries the running total over the buckets of a key: that window
sees one row per bucket, not one per record.  Level two runs the window
inside ``(key, bucket)`` and adds the carry.  The rows are shuffled once, by
``(key, bucket)``; the bucket totals are combined map-side, so only one row
per bucket and map task moves for them.  The result equals the one-window
version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_AGG = {"max": F.max, "min": F.min, "sum": F.sum}

DEFAULT_SEQ_BUCKET = 1 << 20        # arrival positions per bucket


def floor_div(col: str | Column, n: int) -> Column:
    """Exact integer ``floor(col / n)`` for a whole-number column."""
    c = (F.col(col) if isinstance(col, str) else col).cast("bigint")
    k = F.lit(n).cast("bigint")
    return F.call_function("div", c - F.pmod(c, k), k)


def seq_bucket(col: str | Column, width: int = DEFAULT_SEQ_BUCKET) -> Column:
    return floor_div(col, width)



def _combine(op: str, carry: Column, local: Column) -> Column:
    if op == "sum":
        return F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0))
    if op == "max":
        return F.greatest(carry, local)      # greatest/least skip nulls
    return F.least(carry, local)


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
            value: Column, op: str, out: str, bucket: Column | str,
            inclusive: bool = True, peers: bool = False,
            key_total: str | None = None) -> DataFrame:
    """Add ``out`` = running ``op`` of ``value`` over the rows of ``keys`` in
    ``order``; ``bucket`` (a column, or the name of one to reuse) must be
    non-decreasing in ``order``.  With
    ``inclusive=False`` the current row is left out (null for the first).
    With ``peers=True`` (one integral order column) rows with equal order
    values are treated alike: inclusive takes all of them, exclusive none.
    ``key_total`` names an optional column with ``op`` over all rows of the
    key, delivered through the same carry join.  Null keys are a key of
    their own; a ``sum`` over only nulls is 0 (a window would give null)."""
    agg = _AGG[op]
    keys = list(keys)
    v, local, total, carry, cell = "_scan_v", "_scan_local", "_scan_total", "_scan_carry", "_scan_cell"
    if isinstance(bucket, str):      # an existing column: chained scans share it
        b, d, made = bucket, df, False
    else:
        b, d, made = "_scan_b", df.withColumn("_scan_b", bucket), True
    # Structs compare null fields as equal, so rows of a null key or bucket form
    # a group of their own and meet their carry in a plain equi-join.
    d = d.withColumn(cell, F.struct(*keys, b)).withColumn(v, value)
    # Level one: one row per (key, bucket), combined map-side before the
    # shuffle; the carry window then sees one row per bucket.
    totals = d.groupBy(*keys, b, cell).agg(agg(v).alias(total))
    over_buckets = (Window.partitionBy(*keys).orderBy(b)
                    .rowsBetween(Window.unboundedPreceding, -1))
    extra = [agg(total).over(Window.partitionBy(*keys)).alias(key_total)] if key_total else []
    carries = totals.select(cell, agg(total).over(over_buckets).alias(carry), *extra)
    # Level two: the rows' only shuffle, by (key, bucket), for this window.
    end = Window.currentRow if inclusive else -1
    inside = Window.partitionBy(cell).orderBy(*order)
    if peers:
        inside = inside.rangeBetween(Window.unboundedPreceding, end)
    else:
        inside = inside.rowsBetween(Window.unboundedPreceding, end)
    d = d.withColumn(local, agg(v).over(inside))
    d = d.join(carries, on=cell, how="inner")
    d = d.withColumn(out, _combine(op, F.col(carry), F.col(local))).drop(v, local, carry, cell)
    return d.drop(b) if made else d


def ordinal(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
            out: str, bucket: Column | str, key_total: str | None = None) -> DataFrame:
    """1-based position of each row within its key (a ``row_number`` split
    over buckets).  ``order`` must be a total order within a key.
    ``key_total`` adds the key's row count."""
    return running(df, keys, order, F.lit(1).cast("bigint"), "sum", out, bucket,
                   key_total=key_total)


def hot_key_bucket(df: DataFrame, keys: Sequence[str], bucket: Column,
                   support: float = 1e-3) -> Column:
    """``bucket`` for keys holding more than about ``support`` of the rows, one
    bucket (-1) for every other key, so cold keys add no carry rows.

    The hot keys come from one frequent-items pass over the key columns (a
    static frame): at most ``1 / support`` values reach the driver, a bound
    that does not grow with the data, and they become a literal set (no
    join).  A false positive only means one more split key.
    """
    keys = list(keys)
    k = F.col(keys[0]) if len(keys) == 1 else F.struct(*[F.col(c) for c in keys])
    found = df.select(k.alias("_hk")).stat.freqItems(["_hk"], support).first()[0]
    if not found:
        return F.lit(-1).cast("bigint")
    if len(keys) == 1:
        values = [F.lit(v) for v in found]
    else:
        values = [F.struct(*[F.lit(x).alias(c) for x, c in zip(v, keys)]) for v in found]
    return F.when(k.isin(*values), bucket).otherwise(F.lit(-1).cast("bigint"))
