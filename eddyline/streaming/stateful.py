"""Keyed state with ``transformWithStateInPandas``.

``CountAverage``: per key, a value state ``(count, sum, known)``; every ``n``-th
value emits ``sum div n`` and clears it; a lone last value stays pending.
``ChunkBuffer``: per bucket (a sink instance), a list state of buffered rows;
whenever ``n`` are present they are released as one chunk.  The pending rows
are checkpointed with the query and restored on restart.

Both can start from what a static run left pending (``initial``), and what they hold can
be read back from a checkpoint (:func:`pending_averages`, :func:`pending_chunks`).

Rows of one key within one micro-batch are ordered by ``seq`` (null first) and source
partition (the arrival order) before use; the micro-batch size (``maxFilesPerTrigger`` /
``maxOffsetsPerTrigger``) bounds what one key holds in memory at once.  A bucket's rows are held
as packed columns and released in frames of ``RELEASED_ROWS``.

Nulls are as in the static operators: a null key or bucket is one of its own, a null
value takes a place in its group and adds nothing, a group of nulls alone averages
null.  A group whose sum leaves 64 bits stops the query, as there.  Whole numbers
travel as value and null mark, since a pandas column with nulls would turn them into
floating point.
"""

from __future__ import annotations

from collections.abc import Iterator

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# The processors are shipped to the Python workers by value, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

AVERAGE_OUT = "key LONG, average LONG, seq LONG"
CHUNK_ROW = "name STRING, value INT, seq LONG"
CHUNK_OUT = "name STRING, value INT, seq LONG, bucket INT, chunk LONG, position INT"


LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _trunc_div(x: int, n: int) -> int:
    """Integer division toward zero (Java long division)."""
    return x // n if x >= 0 else -(-x // n)


def _group_sums(v: np.ndarray, starts: np.ndarray) -> list[int]:
    """Exact sums of consecutive runs; a sum beyond 64 bits is an error."""
    if not len(starts):
        return []
    sums = np.add.reduceat(v, starts).tolist()
    near = np.flatnonzero(np.abs(np.add.reduceat(v.astype(np.float64), starts)) > 2.0 ** 62)
    ends = np.append(starts[1:], len(v))
    for i in near.tolist():
        sums[i] = sum(v[starts[i]:ends[i]].tolist())
    return sums


def _checked(x: int) -> int:
    if not LEAST <= x <= MOST:
        raise OverflowError("the sum of a group does not fit in 64 bits")
    return x


def _sorted(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    frames = [f for f in rows if len(f)]
    if not frames:
        return pd.DataFrame()
    pdf = pd.concat(frames, ignore_index=True)
    return pdf.sort_values(["seq_known", *[c for c in ("seq", "partition") if c in pdf.columns]], kind="stable")


def _marked(df: DataFrame, *cols: str, also: tuple = ()) -> DataFrame:
    """Each of the whole-number ``cols`` with its null mark; and, where the rows have
    one, the source partition (it orders rows of equal ``seq``)."""
    marked = [x for c in cols for x in (F.coalesce(F.col(c), F.lit(0)).alias(c), F.col(c).isNotNull().alias(f"{c}_known"))]
    order = [F.coalesce("partition", F.lit(-1)).alias("partition")] if "partition" in df.columns else []
    return df.select(*marked, *order, *[c for c in ("name",) if c in df.columns], *also)


def _nullable(values: list | np.ndarray, known: list | np.ndarray, kind: str) -> pd.array:
    return pd.arrays.IntegerArray(np.array(values, dtype=kind.lower()), ~np.array(known, dtype=bool))


class CountAverage(StatefulProcessor):
    def __init__(self, n: int = 2):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("average", "count LONG, total LONG, known LONG")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        count, total, known = initialState[["count", "total", "known"]].iloc[0].tolist()
        self.acc.update((int(count), int(total), int(known)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows)
        if pdf.empty:
            return
        c, s, k = self.acc.get() if self.acc.exists() else (0, 0, 0)
        v, known = pdf["value"].to_numpy(dtype=np.int64), pdf["value_known"].to_numpy()
        starts = np.flatnonzero((c + np.arange(len(v))) % self.n == 0)
        if c:
            starts = np.concatenate(([0], starts))
        sums = _group_sums(v, starts)
        some = np.add.reduceat(known.astype(np.int64), starts).tolist()
        sums[0], some[0] = sums[0] + s, some[0] + k
        sums = list(map(_checked, sums))
        left = (c + len(v)) % self.n
        full = len(sums) - (1 if left else 0)
        if full:
            ends = np.append(starts[1:], len(v))[:full] - 1
            yield pd.DataFrame({
                "key": _nullable([key[0]] * full, [key[1]] * full, "Int64"),
                "average": _nullable([_trunc_div(x, self.n) for x in sums[:full]], some[:full], "Int64"),
                "seq": _nullable(pdf["seq"].to_numpy()[ends].tolist(), pdf["seq_known"].to_numpy()[ends], "Int64")})
        if left:
            self.acc.update((int(left), int(sums[-1]), int(some[-1])))
        else:
            self.acc.clear()

    def close(self) -> None:
        pass


HELD = ["name", "value", "value_known", "seq", "seq_known"]
RELEASED_ROWS = 1 << 16   # rows of one frame of released chunks
HELD_STATE = "name STRING, value INT, value_known BOOLEAN, seq LONG, seq_known BOOLEAN"


def _columns(old: pd.DataFrame, rows: Iterator[pd.DataFrame]) -> tuple[dict, np.ndarray]:
    """The ``HELD`` columns of the rows ``old`` and then the new ones, packed, and their order: the
    new ones by ``seq`` (null first) and source partition.  A key's rows of a micro-batch are all
    here at once, so none is kept as an object."""
    kinds = {"value": np.int32, "value_known": bool, "seq": np.int64, "seq_known": bool, "partition": np.int32}
    parts: dict[str, list] = {c: [] for c in ["name", *kinds]}
    for f in ([old] if len(old) else []):
        _pack(parts, f, kinds)
    for f in rows:
        _pack(parts, f, kinds)
    held = {"name": pa.concat_arrays(parts.pop("name") or [pa.array([], pa.large_string())])}
    for c, kind in kinds.items():
        held[c] = np.concatenate(parts.pop(c) or [np.empty(0, kind)])
    k = len(old)
    by = np.lexsort((held.pop("partition")[k:], held["seq"][k:], held["seq_known"][k:]))
    by += k
    return held, np.concatenate((np.arange(k), by)) if k else by


def _pack(parts: dict[str, list], f: pd.DataFrame, kinds: dict) -> None:
    parts["name"].append(pa.array(f["name"].tolist(), pa.large_string(), from_pandas=True))
    for c, kind in kinds.items():
        parts[c].append(f[c].to_numpy().astype(kind) if c in f.columns else np.full(len(f), -1, kind))


def _rows_at(held: dict, at: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series(held[c].take(pa.array(at)).to_pylist(), dtype=object) if c == "name"
                         else held[c][at] for c in HELD})


class ChunkBuffer(StatefulProcessor):
    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buffer = handle.getListState("buffered", HELD_STATE)
        self.released = handle.getValueState("released", "chunks LONG")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        held = initialState[initialState["held"]].sort_values("position")
        self.released.update((int(initialState["chunk"].max()),))
        if len(held):
            self._hold(held[HELD])

    def _hold(self, rows: pd.DataFrame) -> None:
        self.buffer.put([(name, int(v), bool(vk), int(s), bool(sk))
                         for name, v, vk, s, sk in rows.itertuples(index=False, name=None)])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        old = list(self.buffer.get()) if self.buffer.exists() else []
        held, order = _columns(pd.DataFrame(old, columns=HELD), rows)
        if len(order) == len(old):
            return
        full = (len(order) // self.n) * self.n
        done = self.released.get()[0] if self.released.exists() else 0
        if full:
            self.released.update((int(done + full // self.n),))
        for lo in range(0, full, RELEASED_ROWS):
            idx = np.arange(lo, min(lo + RELEASED_ROWS, full))
            out = _rows_at(held, order[idx])
            yield pd.DataFrame({
                "name": out["name"], "value": _nullable(out["value"], out["value_known"], "Int32"),
                "seq": _nullable(out["seq"], out["seq_known"], "Int64"),
                "bucket": _nullable([key[0]] * len(idx), [key[1]] * len(idx), "Int32"),
                "chunk": (done + idx // self.n).astype(np.int64), "position": (idx % self.n).astype(np.int32)})
        self.buffer.clear()
        if full < len(order):
            self._hold(_rows_at(held, order[full:]))

    def close(self) -> None:
        pass


def count_average_stream(pairs: DataFrame, n: int = 2, initial: DataFrame | None = None) -> DataFrame:
    """Streaming twin of :func:`eddyline.operators.keyed.count_average`.  ``initial``
    (``key, count, total, known``, see :func:`eddyline.operators.keyed.average_pending`) is
    what a static run over the earlier rows left pending."""
    start = None
    if initial is not None:
        start = _marked(initial, "key", "count", "total", "known").groupBy("key", "key_known")
    return (_marked(pairs, "key", "value", "seq").groupBy("key", "key_known")
            .transformWithStateInPandas(CountAverage(n), AVERAGE_OUT, "Append", "None", initialState=start))


def chunk_rows_stream(rows: DataFrame, n: int, initial: DataFrame | None = None) -> DataFrame:
    """Streaming twin of :func:`eddyline.operators.keyed.chunk_rows` (the
    released chunks; the remainder stays in state).  ``initial`` (see
    :func:`eddyline.operators.keyed.chunk_state`) is what a static run over the earlier rows holds."""
    start = None
    if initial is not None:
        start = _marked(initial, "value", "seq", "bucket", also=("chunk", "position", "held")).groupBy(
            "bucket", "bucket_known")
    return (_marked(rows, "value", "seq", "bucket").groupBy("bucket", "bucket_known")
            .transformWithStateInPandas(ChunkBuffer(n), CHUNK_OUT, "Append", "None", initialState=start))


def _state(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    return spark.read.format("statestore").option("stateVarName", name).load(checkpoint)


def _unmark(field: str, kind: str) -> Column:
    return F.when(F.col(f"{field}_known"), F.col(field)).cast(kind)


def pending_averages(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``key, count, total, known`` that a count average stream holds, from its checkpoint."""
    s = _state(spark, checkpoint, "average").where("value IS NOT NULL").select("key.*", "value.*")
    return s.select(_unmark("key", "bigint").alias("key"), "count", "total", "known")


def pending_chunks(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``name, value, seq, bucket`` rows that a chunk stream holds, from its checkpoint."""
    s = (spark.read.format("statestore").option("stateVarName", "buffered")
         .option("flattenCollectionTypes", "true").load(checkpoint).select("key.*", "list_element.*"))
    return s.select("name", _unmark("value", "int").alias("value"), _unmark("seq", "bigint").alias("seq"),
                    _unmark("bucket", "int").alias("bucket"))
