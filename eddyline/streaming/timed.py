"""Keyed state with watermarks and timers (``transformWithStateInPandas``).

``LateMarker``: per source partition, the latest event time seen, record by record;
every row leaves with the watermark before it and whether its window had fired.
``WindowFold``: per key, one small tuple per open window (count, rows, sum, first
row, halving average); a window leaves when the watermark passes its end, by an
event-time timer.  No list is kept.  The rows' times can leave at once, each
with its position in its window.  A call to the state or a timer costs far more than a row, so
``SPAN`` consecutive windows of a key are one state value with one timer, at the end of the first.
``ClockWindows``: per word, sums of processing-time windows, which leave when the clock
passes their end, by a processing-time timer; no state is left after that.  All words are in
``CLOCK_PARTS`` parts, each with one state value and one timer per window.

Rows of a key are put in order of ``seq`` within a micro-batch; the source delivers
batches in order.  A micro-batch's rows of one key are in one task, so bound
the micro-batch at the source.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eddyline.functions.timefmt import epoch_ms
from eddyline.operators.scan import floor_div

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LOWEST = -(1 << 63)
SPAN = 4096        # consecutive windows of a key that are one state value
CLOCK_PARTS = 512  # parts of all words, a state value each per window
COUNT_ROWS = 1 << 20  # words counted together before the shuffle


def window_ms(window: str) -> int:
    """Milliseconds of ``"30 seconds"``, ``"6 hours"`` and the like."""
    n, unit = window.split()
    unit_ms = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}
    return int(n) * unit_ms[unit.rstrip("s")]


def _joined(rows: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    frames = [f for f in rows if len(f)]
    if not frames:
        return pd.DataFrame()
    return pd.concat(frames, ignore_index=True).sort_values(order, kind="stable", ignore_index=True)


# ---- late rows ----

LATE_OUT = ("partition INT, no_partition BOOLEAN, row BINARY, window_start_ms LONG, watermark_ms LONG, late BOOLEAN")


class LateMarker(StatefulProcessor):
    def __init__(self, width_ms: int) -> None:
        self.width = width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("watermark", "ms LONG")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _joined(rows, ["seq", "tie"])
        if pdf.empty:
            return
        before = self.seen.get()[0] if self.seen.exists() else LOWEST
        known = ~pdf["no_time"].to_numpy()
        ms = pdf["ms"].to_numpy(dtype=np.int64)
        run = np.maximum.accumulate(np.concatenate(([before], np.where(known, ms, LOWEST))))
        mark = run[:-1]
        start = ms // self.width * self.width
        late = known & (mark > LOWEST) & (start + self.width - 1 <= mark)
        if run[-1] > LOWEST:
            self.seen.update((int(run[-1]),))
        yield pd.DataFrame({
            "partition": np.full(len(pdf), key[0], dtype=np.int32), "no_partition": np.full(len(pdf), bool(key[1])),
            "row": pdf["row"], "window_start_ms": pd.array(start, "Int64").copy(),
            "watermark_ms": pd.array(np.where(mark > LOWEST, mark, 0), "Int64"), "late": late,
        }).assign(window_start_ms=lambda d: d["window_start_ms"].where(known),
                  watermark_ms=lambda d: d["watermark_ms"].where(mark > LOWEST))

    def close(self) -> None:
        pass


def mark_late_stream(rows: DataFrame, window: str, ts: str = "ts", seq: str = "seq",
                     partition: str = "partition", tie: str = "event_id") -> DataFrame:
    """Streaming twin of :func:`eddyline.operators.late.mark_late` on rows in
    arrival order: every row with ``window_start_ms``, ``watermark_ms`` and ``late``.
    The watermark is per record and source partition; a row without a time has no window
    and is not late; rows of a null partition are a partition of their own."""
    ms = epoch_ms(ts)
    packed = rows.select(
        F.coalesce(F.col(partition), F.lit(0)).cast("int").alias("p"), F.col(partition).isNull().alias("no_partition"),
        F.coalesce(F.col(seq), F.lit(LOWEST)).cast("bigint").alias("seq"),
        F.coalesce(F.col(tie), F.lit(LOWEST)).cast("bigint").alias("tie"),
        F.coalesce(ms, F.lit(0)).cast("bigint").alias("ms"), ms.isNull().alias("no_time"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c not in (partition,)]),
                  {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).cast("binary").alias("row"))
    out = (packed.groupBy("p", "no_partition")
           .transformWithStateInPandas(LateMarker(window_ms(window)), LATE_OUT, "Append", "None"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != partition)
    body = F.from_json(F.col("row").cast("string"), kept,
                       {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    return (out.withColumn("_r", body).withColumn("_p", F.when(~F.col("no_partition"), F.col("partition")))
            .select("_r.*", F.col("_p").alias(partition), "window_start_ms", "watermark_ms", "late"))


# ---- event-time windows that fold ----

FOLD_OUT = ("kind STRING, url STRING, response STRING, window_start_ms LONG, window_end_ms LONG, method STRING, "
            "code INT, count LONG, response_time_avg INT, response_time_mean DOUBLE, position LONG, "
            "time_text STRING, took_ms INT")


def _half(x: int) -> int:
    """Half, toward zero."""
    return x // 2 if x >= 0 else -(-x // 2)


class WindowFold(StatefulProcessor):
    """The open windows of a key and span, one small tuple each, in one state value; ``times``
    also lets every row's time leave, with its position."""

    def __init__(self, width_ms: int, times: bool = False) -> None:
        self.width, self.times = width_ms, times

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState(
            "windows", "timer LONG, start ARRAY<LONG>, count ARRAY<LONG>, rows ARRAY<LONG>, took ARRAY<LONG>, "
            "method ARRAY<STRING>, code ARRAY<INT>, average ARRAY<LONG>")

    def _held(self) -> tuple[int | None, dict[int, tuple]]:
        """The time of the timer and the windows by their start."""
        if not self.open.exists():
            return None, {}
        timer, start, *columns = self.open.get()
        return timer, dict(zip(start, zip(*columns)))

    def _hold(self, windows: dict[int, tuple], timer: int | None) -> None:
        """Keep the windows and one timer, at the end of the first; ``timer`` is the one there is."""
        first = min(windows) + self.width
        if first != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(first)
        self.open.update((first, list(windows), *map(list, zip(*windows.values()))))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _joined(rows, ["seq", "partition"])
        if pdf.empty:
            return
        start = pdf["ms"].to_numpy(dtype=np.int64) // self.width * self.width
        by_window = np.argsort(start, kind="stable")
        firsts = np.flatnonzero(np.diff(start[by_window], prepend=start[by_window[0]] - 1))
        ends = np.append(firsts[1:], len(pdf)).tolist()
        took = pdf["took_ms"].to_numpy()[by_window].tolist()
        counts = pdf["count"].to_numpy()[by_window].tolist()
        place = np.empty(len(pdf), dtype=np.int64)
        timer, windows = self._held()
        for lo, hi in zip(firsts.tolist(), ends):
            w = int(start[by_window[lo]])
            if w in windows:
                count, n, total, method, code, average = windows[w]
                rest = took[lo:hi]
            else:
                first = by_window[lo]
                count, n, total = 0, 0, 0
                method, code, average = pdf["method"].iat[first], int(pdf["code"].iat[first]), int(took[lo])
                rest = took[lo + 1:hi]
            for x in rest:
                average = _half(average + int(x))
            place[by_window[lo:hi]] = n + np.arange(hi - lo)
            windows[w] = (int(count + sum(counts[lo:hi])), int(n + hi - lo), int(total + sum(took[lo:hi])),
                          method, code, int(average))
        self._hold(windows, timer)
        if self.times:
            yield self._out("time", key, start, position=place, time_text=pdf["time_text"], took_ms=pdf["took_ms"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        _, windows = self._held()
        # All windows that the watermark has passed leave together.
        passed = timerValues.getCurrentWatermarkInMs() - self.width
        closed = sorted(w for w in windows if w <= passed)
        if not closed:
            return
        count, n, total, method, code, average = zip(*map(windows.pop, closed))
        if windows:
            self._hold(windows, None)
        else:
            self.open.clear()
        yield self._out("window", key, np.array(closed), method=method, code=code, count=count,
                        response_time_avg=average, response_time_mean=[t / x for t, x in zip(total, n)])

    def _out(self, kind: str, key: tuple, start: np.ndarray, **cols) -> pd.DataFrame:
        n = len(start)
        kinds = {"code": "Int32", "count": "Int64", "response_time_avg": "Int32", "position": "Int64",
                 "took_ms": "Int32", "response_time_mean": "Float64"}
        full = {"kind": [kind] * n, "url": [key[0]] * n, "response": [key[1]] * n,
                "window_start_ms": start, "window_end_ms": start + self.width}
        for c in ("method", "code", "count", "response_time_avg", "response_time_mean", "position", "time_text",
                  "took_ms"):
            values = list(cols[c]) if c in cols else [None] * n
            full[c] = pd.array(values, kinds[c]) if c in kinds else values
        return pd.DataFrame(full)

    def close(self) -> None:
        pass


def access_window_timers(rows: DataFrame, window: str, watermark: str, times: bool = False) -> DataFrame:
    """Streaming window reduce of parsed access lines with constant state per window.
    ``kind = 'window'`` rows are closed windows; with ``times``, ``kind = 'time'`` rows
    are the times of all rows with their position in their window (from 0).
    A row whose own time is behind the watermark is dropped by the engine."""
    width = window_ms(window)
    ms = F.unix_millis("event_time")
    d = rows.select("url", "response", "method", "code", "count", "took_ms", "time_text", "event_time",
                    F.coalesce("seq", F.lit(LOWEST)).cast("bigint").alias("seq"),
                    F.coalesce("partition", F.lit(-1)).cast("int").alias("partition"),
                    ms.alias("ms"), floor_div(ms, width * SPAN).alias("span")).withWatermark("event_time", watermark)
    return d.groupBy("url", "response", "span").transformWithStateInPandas(
        WindowFold(width, times), FOLD_OUT, "Append", "EventTime")


# ---- processing-time windows that end ----

CLOCK_OUT = "word STRING, window_start_ms LONG, window_end_ms LONG, count_sum LONG"


class ClockWindows(StatefulProcessor):
    """The sums of one part of the words, per open window in one state value."""

    def __init__(self, width_ms: int) -> None:
        self.width = width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("windows", "start LONG", "words ARRAY<STRING>, sums ARRAY<LONG>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        start = timerValues.getCurrentProcessingTimeInMs() // self.width * self.width
        sums: dict[str | None, int] = {}
        if self.open.containsKey((start,)):
            sums = dict(zip(*self.open.getValue((start,))))
        else:
            self.handle.registerTimer(start + self.width)
        for f in rows:
            for word, n in zip(f["word"].tolist(), f["n"].tolist()):
                word = word if isinstance(word, str) else None
                sums[word] = sums.get(word, 0) + n
        self.open.updateValue((start,), (list(sums), list(sums.values())))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start = expiredTimerInfo.getExpiryTimeInMs() - self.width
        words, sums = self.open.getValue((start,))
        self.open.removeKey((start,))
        yield pd.DataFrame({"word": words, "window_start_ms": start, "window_end_ms": start + self.width,
                            "count_sum": sums})

    def close(self) -> None:
        pass


def _count_words(words: pa.ChunkedArray | pa.Array, n: pa.ChunkedArray | None = None) -> pa.Table:
    if n is None:
        n = pa.array(np.ones(len(words), dtype=np.int64))
    t = pa.table({"word": words, "n": n}).group_by("word").aggregate([("n", "sum")])
    return pa.table({"word": t.column("word"), "n": t.column("n_sum").cast(pa.int64())})


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words counted over many batches: a word is one row per ``COUNT_ROWS`` rows or so."""
    held: list[pa.Table] = []
    for b in batches:
        held.append(_count_words(b.column(0)))
        if sum(map(len, held)) >= COUNT_ROWS:
            t = pa.concat_tables(held)
            yield from _count_words(t.column("word"), t.column("n")).to_batches()
            held = []
    if held:
        t = pa.concat_tables(held)
        yield from _count_words(t.column("word"), t.column("n")).to_batches()


def word_clock_windows(words: DataFrame, window: str) -> DataFrame:
    """Sums of ``word`` rows per processing-time window, in append mode.  Start it
    with a processing-time trigger (:func:`eddyline.streaming.runner.run_until_idle`)."""
    counted = words.select("word").mapInArrow(_counted, "word STRING, n LONG")
    part = F.pmod(F.xxhash64("word"), F.lit(CLOCK_PARTS)).alias("part")
    return counted.select(part, "word", "n").groupBy("part").transformWithStateInPandas(
        ClockWindows(window_ms(window)), CLOCK_OUT, "Append", "ProcessingTime")
