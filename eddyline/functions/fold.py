"""Ordered folds over arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trunc_half(c: Column) -> Column:
    """Integer ``c / 2`` truncated toward zero (Java int division)."""
    v = c.cast("bigint")
    return ((v - v % 2) / 2).cast("bigint")


def halving_average(arr) -> Column:
    """``avg <- (avg + x) div 2`` over an ordered integer array, starting from
    its first element.  Later values weigh more than earlier ones, so this is
    not the mean: [100, 200, 400] -> 275, [7] -> 7, [] -> null."""
    a = F.col(arr) if isinstance(arr, str) else arr
    rest = F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(1)))
    rest = F.when(F.size(a) > 1, rest).otherwise(F.array().cast("array<int>"))
    return F.aggregate(rest, a.getItem(0).cast("bigint"),
                       lambda acc, x: trunc_half(acc + x)).cast("int")


# ---- the halving fold as composable maps --------------------------------
#
# Folding values y1..yk into an accumulator a with a <- floor((a + y) / 2)
# gives a |-> q + floor((a + r) / 2^m), 0 <= r < 2^m.  Two such maps compose
# into a third (below), so the fold of a long ordered run can be computed
# per bucket and the buckets combined in order.  All inputs are ints >= 0 and
# a never exceeds the largest input (< 2^31): once 2^m > 2^31 the map only
# tells whether a reaches a threshold t, which is kept as m = 31,
# r = 2^31 - t (or r = 0 when no a reaches it).  Every number fits in 64 bits.
# For non-negative inputs floor equals Java's truncating division.

INT_LIMIT = (1 << 31) - 1
_M_CAP = 31


def _l(v: int) -> Column:
    return F.lit(v).cast("bigint")


def _shl(x: Column, n: Column) -> Column:
    return F.call_function("shiftleft", x, n)


def _shr(x: Column, n: Column) -> Column:
    return F.call_function("shiftright", x, n)


def _canon(q: Column, r: Column, m: Column) -> Column:
    t = _shl(_l(1), m) - r
    r_cap = F.when(t > _l(INT_LIMIT), _l(0)).otherwise(_l(1 << _M_CAP) - t)
    big = m > _M_CAP
    return F.struct(q.alias("q"), F.when(big, r_cap).otherwise(r).alias("r"),
                    F.when(big, F.lit(_M_CAP)).otherwise(m).alias("m"))


def halving_map(x: Column) -> Column:
    """The map of one value: a |-> floor((a + x) / 2)."""
    x = x.cast("bigint")
    return F.struct(_shr(x, F.lit(1)).alias("q"), (x % 2).alias("r"), F.lit(1).alias("m"))


def identity_map() -> Column:
    return F.struct(_l(0).alias("q"), _l(0).alias("r"), F.lit(0).alias("m"))


def compose_maps(f: Column, g: Column) -> Column:
    """``g`` after ``f``."""
    a = f["q"] + g["r"]
    q = g["q"] + _shr(a, g["m"])
    low = a - _shl(_shr(a, g["m"]), g["m"])     # a mod 2^g.m
    r = f["r"] + _shl(low, f["m"])
    return _canon(q, r, f["m"] + g["m"])


def fold_maps(maps: Column) -> Column:
    """Compose an ordered array of maps (first applied first)."""
    return F.aggregate(maps, identity_map(), compose_maps)


def apply_map(f: Column, a: Column) -> Column:
    return (f["q"] + _shr(a.cast("bigint") + f["r"], f["m"])).cast("int")


# ---- the same for values of any sign -------------------------------------
#
# The maps hold only while the accumulator is not negative.  From any int, 32
# steps with values >= 0 bring it to 0 or above (each halves its distance),
# and it stays there until the next negative value.  So an ordered run is kept
# as its values up to 32 past its last negative one, and the map of the rest.

SETTLED = 32


def signed_run(values: Column) -> Column:
    """An ordered int array as ``struct(head, map)``."""
    n = F.size(values)
    from_end = F.array_position(F.reverse(F.transform(values, lambda x: x < 0)), True).cast("int")
    last = F.when(from_end == 0, F.lit(0)).otherwise(n - from_end + 1)
    head = F.least(n, last + SETTLED)
    rest = F.slice(values, head + 1, n - head)
    return F.struct(F.slice(values, F.lit(1), head).alias("head"),
                    fold_maps(F.transform(rest, halving_map)).alias("map"))


def fold_runs(runs: Column, first: Column) -> Column:
    """The halving fold of ordered runs from their first value."""
    def step(acc: Column, run: Column) -> Column:
        settled = F.aggregate(run["head"], acc, lambda a, x: trunc_half(a + x))
        f = run["map"]
        return f["q"] + _shr(settled + f["r"], f["m"])
    return F.aggregate(runs, first.cast("bigint"), step).cast("int")
