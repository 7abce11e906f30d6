"""A log of text lines with real offsets, as a Spark data source.

A folder of append-only text files stands for a topic: a file is a partition, a
line is a record, and a record's offset is the position of its first byte in the
file.  Offsets are therefore unique, ordered, known without counting lines, and
the same after a restart.

* A stream's progress is a map of file to the byte up to which it was read,
  checkpointed by Spark; a restarted query goes on from there.
* A new query starts at ``startingOffsets``: ``earliest``, ``latest`` or a JSON map
  of file name (relative to the folder) to byte.  With ``startingTimestamp``
  (epoch ms) it starts at the files changed at or after that time, and at the
  end of older ones.  A byte within a line stands for the next line.
* ``maxBytesPerTrigger`` bounds a micro-batch, dealt evenly over the files that
  have more (a line is never cut).  Spark asks a reader for the end of the first batch
  before it tells it where the query stands, so that batch is bounded only with
  ``fresh=true``, set by :func:`read_log` for a checkpoint without progress.  Use it with
  a processing-time trigger: an available-now run of such a source is one batch.
* A file's new bytes are read by several tasks, one per ``chunkBytes``: a task
  takes the lines that begin in its chunk.  Line ends are found with array
  operations and the lines handed over as Arrow buffers, so no loop runs over lines.

The last line of a file counts although no line feed ends it (``tail=take``), or, for
files still being written, only once one does (``tail=wait``).  Bytes that are not
UTF-8 are replaced.  A file that got shorter, or is gone before it was read, stops
the query.  Files are reached with ``pyarrow.fs`` from the driver and the tasks, so the
folder must be a path or URI that all of them see.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

# Shipped by value: executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "value STRING, seq BIGINT, partition INT, timestamp TIMESTAMP"
CHUNK = 8 << 20            # bytes of a file that one task reads
BATCH_LINES = 65_536       # lines of one Arrow batch
STEP = 1 << 16             # bytes read at a time to find the end of a line


def _fs(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Chunk(InputPartition):
    """Lines of a file whose first byte lies in ``start .. end - 1``."""

    name: str
    number: int
    start: int
    end: int
    limit: int          # no byte at or behind it is read
    changed: int        # time of the file in microseconds


class _Log:
    """The files of a folder, on the driver and in tasks."""

    def __init__(self, options: dict) -> None:
        self.path = options["path"].rstrip("/")
        self.chunk = int(options.get("chunkbytes", CHUNK))
        self.wait = options.get("tail", "take") == "wait"

    def files(self) -> dict[str, tuple[int, int]]:
        """Name to size and time, by name; hidden files and those of a job's
        bookkeeping (names that begin with ``_`` or ``.``) are none."""
        from pyarrow import fs
        store, root = _fs(self.path)
        found = store.get_file_info(fs.FileSelector(root, recursive=True))
        base = root.rstrip("/") + "/"
        names = {f.path[len(base):] if f.path.startswith(base) else f.path: f for f in found
                 if f.type == fs.FileType.File}
        return {n: (f.size, int(f.mtime.timestamp() * 1_000_000)) for n, f in sorted(names.items())
                if not any(p[0] in "_." for p in n.split("/"))}

    def open(self, name: str):
        store, root = _fs(self.path)
        return store.open_input_file(f"{root.rstrip('/')}/{name}")

    def whole_lines(self, name: str, size: int) -> int:
        """The end of the last line that a line feed ends, at or before ``size``."""
        if not self.wait:
            return size
        with self.open(name) as f:
            hi = size
            while hi > 0:
                lo = max(0, hi - STEP)
                at = f.read_at(hi - lo, lo).rfind(b"\n")
                if at >= 0:
                    return lo + at + 1
                hi = lo
        return 0

    def ends(self) -> dict[str, int]:
        return {n: self.whole_lines(n, size) for n, (size, _) in self.files().items()}

    def chunks(self, start: dict[str, int], end: dict[str, int], numbers: dict[str, int]) -> list[Chunk]:
        now = self.files()
        out = []
        for name, stop in end.items():
            at = start.get(name, 0)
            if name not in now or now[name][0] < stop:
                raise ValueError(f"{name} is gone or shorter than what was read of it")
            while at < stop:
                to = min(stop, at + self.chunk)
                out.append(Chunk(name, numbers[name], at, to, stop, now[name][1]))
                at = to
        return out

    def read(self, c: Chunk) -> Iterator[pa.RecordBatch]:
        """The lines that begin in the chunk: the one that a byte before it
        began belongs to the chunk before."""
        import numpy as np
        import pyarrow as pa
        with self.open(c.name) as f:
            raw = bytearray(f.read_at(c.end - c.start, c.start))
            skip = 0
            if c.start and f.read_at(1, c.start - 1) != b"\n":
                at = raw.find(b"\n")
                if at < 0:
                    return                  # one long line that began earlier
                skip = at + 1
            to = c.end
            if skip < len(raw) and raw[-1:] != b"\n":  # the last line ends behind the chunk
                while to < c.limit:
                    more = f.read_at(min(STEP, c.limit - to), to)
                    at = more.find(b"\n")
                    if at >= 0:
                        raw += more[:at + 1]
                        break
                    raw += more
                    to += len(more)
        if skip >= len(raw):
            return
        if raw[-1:] != b"\n":
            raw += b"\n"
        body = np.frombuffer(raw, dtype=np.uint8)[skip:]
        ends = np.flatnonzero(body == 10)
        starts = np.concatenate(([0], ends[:-1] + 1))
        data = body.tobytes()
        cut = ends - ((ends > starts) & (body[ends - 1] == 13))     # a carriage return before the line feed
        for i in range(0, len(ends), BATCH_LINES):
            a, z = starts[i:i + BATCH_LINES], cut[i:i + BATCH_LINES]
            # Offsets of lines and gaps in turn; the lines are every other value.
            edges = np.empty(2 * len(a) + 1, dtype=np.int64)
            edges[0:-1:2], edges[1::2] = a, z
            edges[-1] = z[-1]
            values = pa.Array.from_buffers(pa.large_binary(), 2 * len(a),
                                           [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(data)])
            values = values.take(pa.array(np.arange(0, 2 * len(a), 2)))
            try:
                text = values.cast(pa.large_string()).cast(pa.string())
            except pa.ArrowInvalid:
                text = pa.array([v.as_py().decode("utf-8", "replace") for v in values], pa.string())
            n = len(a)
            yield pa.RecordBatch.from_arrays(
                [text, pa.array(c.start + skip + a, pa.int64()), pa.array(np.full(n, c.number), pa.int32()),
                 pa.array(np.full(n, c.changed), pa.timestamp("us", tz="UTC"))],
                ["value", "seq", "partition", "timestamp"])


def _numbers(files: dict) -> dict[str, int]:
    return {n: i for i, n in enumerate(files)}


class LineLogReader(DataSourceReader):
    """All lines between the start and the end of now."""

    def __init__(self, options: dict) -> None:
        self.log = _Log(options)

    def partitions(self) -> list[Chunk]:
        ends = self.log.ends()
        return self.log.chunks({}, ends, _numbers(ends)) or [Chunk("", 0, 0, 0, 0, 0)]

    def read(self, partition: Chunk) -> Iterator[pa.RecordBatch]:
        if partition.end > partition.start:
            yield from self.log.read(partition)


class LineLogStreamReader(DataSourceStreamReader):
    """Offsets are ``{"files": {name: [number, byte]}}``: a file keeps the number it
    was given when it was first seen."""

    def __init__(self, options: dict) -> None:
        self.log = _Log(options)
        self.starting = options.get("startingoffsets", "earliest")
        self.since = options.get("startingtimestamp")
        self.max_bytes = int(options.get("maxbytespertrigger", 0))
        self.fresh = options.get("fresh", "false") == "true"
        self.at: dict[str, list[int]] | None = None

    def initialOffset(self) -> dict:
        files = self.log.files()
        ends = self.log.ends()
        if self.since is not None:
            at = {n: 0 if changed >= int(self.since) * 1000 else ends[n] for n, (_, changed) in files.items()}
        elif self.starting == "earliest":
            at = dict.fromkeys(files, 0)
        elif self.starting == "latest":
            at = ends
        else:
            given = json.loads(self.starting)
            unknown = sorted(set(given) - set(files))
            if unknown:
                raise ValueError(f"startingOffsets names files that are not there: {unknown}")
            at = {n: self._line_from(n, int(given.get(n, 0)), ends[n]) for n in files}
        self.at = {n: [i, at[n]] for i, n in enumerate(files)}
        return {"files": self.at}

    def _line_from(self, name: str, byte: int, end: int) -> int:
        """The first line that begins at or behind ``byte``."""
        if byte < 0 or byte > end:
            raise ValueError(f"startingOffsets: {name} has bytes 0 to {end}")
        with self.log.open(name) as f:
            if byte == 0 or f.read_at(1, byte - 1) == b"\n":
                return byte
            while byte < end:
                more = f.read_at(min(STEP, end - byte), byte)
                at = more.find(b"\n")
                if at >= 0:
                    return byte + at + 1
                byte += len(more)
        return end

    def latestOffset(self) -> dict:
        if self.at is None and self.fresh:
            self.initialOffset()
        ends = self.log.ends()
        at = dict(self.at or {})
        free = max([i for i, _ in at.values()], default=-1) + 1
        for n in ends:
            if n not in at:
                at[n] = [free, 0]
                free += 1
        if self.at is None or not self.max_bytes:
            to = {n: [i, max(b, ends.get(n, b))] for n, (i, b) in at.items()}
        else:
            more = [n for n in ends if ends[n] > at[n][1]]
            share = max(1, self.max_bytes // max(1, len(more)))
            to = {n: list(v) for n, v in at.items()}
            for n in more:
                to[n][1] = self._line_from(n, min(ends[n], at[n][1] + share), ends[n])
        return {"files": to}

    def partitions(self, start: dict, end: dict) -> list[Chunk]:
        if any(end["files"].get(n, [0, -1])[1] < b for n, (_, b) in start["files"].items()):
            raise ValueError("fresh=true, but the checkpoint has progress")
        self.at = {n: list(v) for n, v in end["files"].items()}
        lo = {n: b for n, (_, b) in start["files"].items()}
        hi = {n: b for n, (_, b) in end["files"].items()}
        return self.log.chunks(lo, {n: b for n, b in hi.items() if b > lo.get(n, 0)},
                               {n: i for n, (i, _) in end["files"].items()})

    def read(self, partition: Chunk) -> Iterator[pa.RecordBatch]:
        return self.log.read(partition)

    def commit(self, end: dict) -> None:
        pass


class LineLog(DataSource):
    """``spark.read.format("line_log")`` and ``spark.readStream.format("line_log")``."""

    @classmethod
    def name(cls) -> str:
        return "line_log"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LineLogReader:
        return LineLogReader({k.lower(): v for k, v in self.options.items()})

    def streamReader(self, schema) -> LineLogStreamReader:
        return LineLogStreamReader({k.lower(): v for k, v in self.options.items()})


def _started(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a stream has already planned a batch with this checkpoint."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/offsets/0")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_log(spark: SparkSession, path: str, streaming: bool = True, checkpoint: str | None = None,
             max_bytes: int | None = None, **options) -> DataFrame:
    """The lines of a log folder.  ``checkpoint`` is the one the stream will be
    started with; ``max_bytes`` bounds its micro-batches."""
    spark.dataSource.register(LineLog)
    if streaming and max_bytes:
        if checkpoint is None:
            raise ValueError("max_bytes needs the checkpoint that the stream is started with")
        options |= {"maxBytesPerTrigger": max_bytes, "fresh": str(not _started(spark, checkpoint)).lower()}
    r = spark.readStream if streaming else spark.read
    return r.format("line_log").options(**{k: str(v) for k, v in options.items()}).load(path)
