"""Parsers for text messages, with bad lines set aside.

Each parser returns ``Parsed(rows, rejects)``: the typed rows, and the lines
that could not be used with a ``reason``.  ``on_error="fail"`` makes a bad
number stop the query instead (the reference's behaviour); lines with the
wrong number of fields are dropped in both modes, as in the reference, and
are still listed in ``rejects``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.functions.text import first_three, java_split, strict_int, strict_long
from eddyline.functions.timefmt import valid_epoch_ms

REJECT_COLUMNS = ["seq", "partition", "value", "reason"]
ORDER_SCHEMA = "user STRING, product STRING, amount STRING, _corrupt STRING"


class Parsed(NamedTuple):
    rows: DataFrame
    rejects: DataFrame


def _split(df: DataFrame, reason: Column, keep: list, on_error: str,
           fatal: Column | None = None) -> Parsed:
    """Route each line to ``rows`` or ``rejects``.

    The split fields are computed once in a projection; each output is an
    ``inline`` of a 0-or-1 element array over it, cut with ``slice`` (code
    generated, unlike a lambda filter).  A plain filter would be pushed below
    that projection with the split expression copied into every field test,
    running the split several times per line.
    """
    if on_error == "fail" and fatal is not None:
        reason = F.when(fatal, F.raise_error(F.concat(F.lit("bad line: "), F.col("value")))
                        .cast("string")).otherwise(reason)
    elif on_error not in ("quarantine", "fail"):
        raise ValueError(f"on_error must be 'quarantine' or 'fail', not {on_error!r}")
    d = df.withColumn("reason", reason)
    ok = F.col("reason").isNull()
    row = F.struct(*[F.col(c) if isinstance(c, str) else c for c in keep])
    rej = F.struct(*[F.col(c) for c in REJECT_COLUMNS])
    keep_row = F.when(ok, F.lit(1)).otherwise(F.lit(0))
    rows = d.select(F.inline(F.slice(F.array(row), 1, keep_row)))
    rejects = d.select(F.inline(F.slice(F.array(rej), 1, 1 - keep_row)))
    return Parsed(rows, rejects)


def _at(f: Column, i: int) -> Column:
    """Field ``i`` (0-based), null when the line has fewer parts."""
    return F.get(f, i)


def _out_of_range(ms_text: Column) -> Column:
    """A whole number that is no time in years 1 to 9999."""
    ms = strict_long(ms_text)
    return ms.isNotNull() & valid_epoch_ms(ms).isNull()


def _event_time(ms_text: Column) -> tuple[Column, Column]:
    """Epoch ms from text; unparsable gives 0, as the reference's extractor
    does.  (Numbers out of range are rejected before.)"""
    ms = F.coalesce(valid_epoch_ms(strict_long(ms_text)), F.lit(0).cast("bigint"))
    return ms, F.timestamp_millis(ms)


def parse_count_lines(lines: DataFrame, on_error: str = "quarantine") -> Parsed:
    """``key,count,epoch_ms`` lines: needs a comma and exactly three parts
    (trailing empty parts do not count); the count must be an integer."""
    d = lines.withColumn("_f", java_split("value", ","))
    f = F.col("_f")
    cnt = strict_int(_at(f, 1))
    arity = F.col("value").contains(",") & (F.size(f) == 3)
    reason = (F.when(F.col("value").isNull(), F.lit("null line"))
              .when(~arity, F.lit("arity"))
              .when(cnt.isNull(), F.lit("bad count"))
              .when(_out_of_range(_at(f, 2)), F.lit("time out of range")))
    ms, ts = _event_time(_at(f, 2))
    keep = [_at(f, 0).alias("key"), cnt.alias("count"),
            _at(f, 2).alias("time_text"), ms.alias("ms"), ts.alias("event_time"),
            "seq", "partition"]
    return _split(d, reason, keep, on_error, fatal=arity & cnt.isNull())


def parse_access_lines(lines: DataFrame, on_error: str = "quarantine") -> Parsed:
    """``url,method,response,count,epoch_ms,code,took_ms`` lines: exactly seven
    parts; count, code and took_ms must be integers."""
    d = lines.withColumn("_f", java_split("value", ","))
    f = F.col("_f")
    cnt, code, took = (strict_int(_at(f, i)) for i in (3, 5, 6))
    arity = F.col("value").contains(",") & (F.size(f) == 7)
    bad_int = cnt.isNull() | code.isNull() | took.isNull()
    reason = (F.when(F.col("value").isNull(), F.lit("null line"))
              .when(~arity, F.lit("arity"))
              .when(bad_int, F.lit("bad number"))
              .when(_out_of_range(_at(f, 4)), F.lit("time out of range")))
    ms, ts = _event_time(_at(f, 4))
    keep = [_at(f, 0).alias("url"), _at(f, 1).alias("method"),
            _at(f, 2).alias("response"), cnt.alias("count"),
            _at(f, 4).alias("time_text"), ms.alias("ms"), ts.alias("event_time"),
            code.alias("code"), took.alias("took_ms"), "seq", "partition"]
    return _split(d, reason, keep, on_error, fatal=arity & bad_int)


def parse_first_three(lines: DataFrame) -> DataFrame:
    """First three lower-cased comma fields of lines with more than two parts;
    shorter lines map to null and are filtered out."""
    return (lines.select("seq", first_three("value").alias("_t"))
            .where(F.col("_t").isNotNull())
            .select("seq", "_t.f0", "_t.f1", "_t.f2"))


def parse_orders(lines: DataFrame, on_error: str = "quarantine") -> Parsed:
    """JSON orders ``{"user": long, "product": string, "amount": int}``.

    Empty lines and the JSON literal ``null`` give no row.  A missing amount
    is 0, missing user/product are null.  Malformed JSON (text after the object
    included), a non-object, or a
    non-integer user/amount is rejected.
    """
    v = F.col("value")
    blank = v.isNull() | (F.trim(v) == "") | (F.trim(v) == "null")
    j = F.from_json(v, ORDER_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt",
                                      "mode": "PERMISSIVE"})
    d = lines.where(~blank).withColumn("_j", j)
    user_t, amount_t = F.col("_j.user"), F.col("_j.amount")
    user, amount = strict_long(user_t), strict_int(amount_t)
    bad_user = user_t.isNotNull() & user.isNull()
    bad_amount = amount_t.isNotNull() & amount.isNull()
    # The parser stops after the first object: the line must also be one element
    # of an array and one value of an object, or text follows it.
    alone = F.coalesce((F.json_array_length(F.concat(F.lit("["), v, F.lit("]"))) == 1)
                       & (F.size(F.json_object_keys(F.concat(F.lit('{"v":'), v, F.lit("}")))) == 1),
                       F.lit(False))
    reason = (F.when(F.col("_j._corrupt").isNotNull() | ~alone, F.lit("malformed json"))
              .when(bad_user, F.lit("bad user"))
              .when(bad_amount, F.lit("bad amount")))
    keep = [user.alias("user"), F.col("_j.product").alias("product"),
            F.coalesce(amount, F.lit(0)).alias("amount"), "seq", "partition"]
    return _split(d, reason, keep, on_error, fatal=reason.isNotNull())
