"""Processors of keyed state run without Spark, on a state that counts its calls: the calls grow
with keys, not with their windows or words, and no frame holds a whole bucket."""

import numpy as np
import pandas as pd

from eddyline.streaming import stateful, timed


class Counted:
    """A value, map or list state that lives in memory."""

    def __init__(self, handle):
        self.handle, self.value, self.map = handle, None, {}

    def __getattribute__(self, name):
        if name not in ("handle", "value", "map", "__class__"):
            object.__getattribute__(self, "handle").calls += 1
        return object.__getattribute__(self, name)

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    put = update

    def clear(self):
        self.value = None

    def containsKey(self, key):
        return key in self.map

    def getValue(self, key):
        return self.map[key]

    def updateValue(self, key, value):
        self.map[key] = value

    def removeKey(self, key):
        del self.map[key]


class Handle:
    def __init__(self):
        self.calls, self.timers = 0, set()

    def getValueState(self, *_):
        return Counted(self)

    getMapState = getListState = getValueState

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.discard(at)


class Now:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getCurrentProcessingTimeInMs = getExpiryTimeInMs = getCurrentWatermarkInMs


def _fire(processor, handle, key, watermark):
    out = []
    while handle.timers and min(handle.timers) <= watermark:
        at = min(handle.timers)
        out += list(processor.handleExpiredTimer(key, Now(watermark), Now(at)))
        handle.timers.discard(at)
    return out


def _access(ms, seq0=0):
    n = len(ms)
    return pd.DataFrame({"ms": ms, "seq": np.arange(seq0, seq0 + n), "partition": 0, "took_ms": np.arange(n) % 7,
                         "count": 1, "method": "GET", "code": 200, "time_text": "t"})


def test_windows_of_a_key_cost_no_call_each():
    handle = Handle()
    fold = timed.WindowFold(30_000, times=True)
    fold.init(handle)
    ms = np.repeat(np.arange(3000, dtype=np.int64) * 30_000, 2)
    times = pd.concat(fold.handleInputRows(("/a", "x", 0), iter([_access(ms)]), Now(0)))
    assert times["position"].tolist() == [0, 1] * 3000
    out = pd.concat(_fire(fold, handle, ("/a", "x", 0), 1000 * 30_000))
    assert out["window_end_ms"].tolist() == [30_000 * i for i in range(1, 1001)]     # the last one ends at the watermark
    assert out["count"].tolist() == [2] * 1000 and handle.timers == {1001 * 30_000}
    late = pd.concat(fold.handleInputRows(("/a", "x", 0), iter([_access(np.array([1000 * 30_000 + 5]), 9000)]), Now(0)))
    assert late["position"].tolist() == [2]
    rest = pd.concat(_fire(fold, handle, ("/a", "x", 0), 1 << 50))
    assert len(rest) == 2000 and rest["count"].tolist()[:2] == [3, 2] and not handle.timers
    assert handle.calls < 40


def test_words_of_a_clock_window_cost_no_call_each():
    handle = Handle()
    clock = timed.ClockWindows(5000)
    clock.init(handle)
    words = [f"w{i}" for i in range(2000)] + [None]
    frame = pd.DataFrame({"word": words, "n": 2})
    for now in (12_000, 14_000, 16_000):
        list(clock.handleInputRows((7,), iter([frame, frame]), Now(now)))
    out = pd.concat(_fire(clock, handle, (7,), 20_000))
    got = {(w, s): n for w, s, n in out[["word", "window_start_ms", "count_sum"]].itertuples(index=False)}
    assert got == {(w, s): n for w in words for s, n in ((10_000, 8), (15_000, 4))} and not handle.timers
    assert handle.calls < 30


def test_words_are_counted_over_batches(monkeypatch):
    import pyarrow as pa
    batches = [pa.RecordBatch.from_pydict({"word": ["a", "b", None, f"x{i}"]}) for i in range(50)]
    rows = [r for b in timed._counted(iter(batches)) for r in b.to_pylist()]
    assert {r["word"]: r["n"] for r in rows} == {"a": 50, "b": 50, None: 50, **{f"x{i}": 1 for i in range(50)}}
    assert len(rows) == 53
    monkeypatch.setattr(timed, "COUNT_ROWS", 8)
    parts = [r for b in timed._counted(iter(batches)) for r in b.to_pylist()]
    assert 53 < len(parts) <= 200 and sum(r["n"] for r in parts) == 200


def test_chunks_are_released_in_frames_and_rows_held_packed(monkeypatch):
    monkeypatch.setattr(stateful, "RELEASED_ROWS", 100)
    handle = Handle()
    sink = stateful.ChunkBuffer(8)
    sink.init(handle)
    order = np.random.default_rng(3).permutation(1003)
    frame = pd.DataFrame({"name": [None if i % 9 == 0 else f"n{i}" for i in order], "value": order.astype(np.int32),
                          "value_known": order % 4 > 0, "seq": order, "seq_known": order % 50 > 0})
    got = list(sink.handleInputRows((2, True), iter([frame[:400], frame[400:]]), Now(0)))
    assert max(map(len, got)) == 100
    out = pd.concat(got, ignore_index=True)
    want = [*range(0, 1003, 50), *(i for i in range(1003) if i % 50)]      # null seq first, then by seq
    assert out["seq"].tolist()[21:] == want[21:1000] and out["seq"][:21].isna().all()
    assert [v for v in out["value"].tolist()[21:25]] == [1, 2, 3, pd.NA]
    assert out["name"].tolist() == [None if i % 9 == 0 else f"n{i}" for i in want[:1000]]
    assert out["chunk"].tolist() == [i // 8 for i in range(1000)] and out["position"].tolist() == [i % 8 for i in range(1000)]
    rest = pd.concat(sink.handleInputRows((2, True), iter([frame[:5]]), Now(0)))
    assert rest["seq"].tolist()[:3] == want[1000:] and rest["chunk"].tolist() == [125] * 8


def test_job_lines_are_files_of_bounded_length(spark, tmp_path, monkeypatch):
    from eddyline.plans import catalog
    monkeypatch.setattr(catalog, "LINES_OF_A_FILE", 50)
    lines = spark.range(1000).selectExpr("cast(id as string) as value", "id as seq").coalesce(2)
    assert catalog._parquet_lines(lines, str(tmp_path / "lines")) == "parquet"
    assert len(list((tmp_path / "lines").glob("*.parquet"))) == 20
    assert spark.conf.get("spark.sql.files.maxRecordsPerFile") == "0"


def test_a_streamed_file_has_more_tasks_when_it_has_more_rows(spark, tmp_path, monkeypatch):
    from eddyline.sources import lines
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "dir"))
    next((tmp_path / "dir").glob("*.parquet")).rename(tmp_path / "t.parquet")
    monkeypatch.setattr(lines, "ROWS_OF_A_TASK", 100)
    plan = lines.read_table(spark, str(tmp_path), "t", streaming=True)._jdf.queryExecution().logical().toString()
    assert "Repartition 10, true" in plan
