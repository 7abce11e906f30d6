"""Event-time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display format of event times (day before month), and the
# text around a latency note ("<time> took<ms>ms").
TIME_FORMAT = "yyyy/dd/MM HH:mm:ss"
NOTE_BEFORE = " took"
NOTE_AFTER = "ms"
# Epoch milliseconds of 0001-01-01 00:00:00 and 9999-12-31 23:59:59.999 UTC.
MIN_EPOCH_MS = -62135596800000
MAX_EPOCH_MS = 253402300799999


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fmt_epoch_ms(ms) -> Column:
    """Epoch milliseconds (number or digit text) as ``yyyy/dd/MM HH:mm:ss``
    in the session zone (UTC)."""
    return F.date_format(F.timestamp_millis(_c(ms).cast("bigint")), TIME_FORMAT)


def valid_epoch_ms(ms) -> Column:
    """``ms`` when it is a time in years 1 to 9999, else null (a larger number
    would overflow the timestamp type)."""
    c = _c(ms)
    return F.when(c.between(MIN_EPOCH_MS, MAX_EPOCH_MS), c)


def took_note(text, took_ms) -> Column:
    """``<text> took<ms>ms``."""
    return F.concat(_c(text), F.lit(NOTE_BEFORE), _c(took_ms).cast("string"), F.lit(NOTE_AFTER))


def epoch_ms(ts) -> Column:
    """Epoch milliseconds of a timestamp (NTZ is read as UTC), truncated."""
    c = _c(ts)
    return F.unix_millis(c.cast("timestamp"))
