"""Message sources.

Every source yields the same columns: ``value STRING`` (the message text),
``seq BIGINT`` (arrival order within a partition), ``partition INT`` and
``timestamp TIMESTAMP`` (the transport's record time, may be null).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_OF_A_TASK = 250_000       # of a streamed table that is one file
POSITION_BITS = 34             # a streamed text file's positions
ZERO_SECOND = 1_577_836_800    # file times count from 2020 (2003 to 2037 fit)

LINE_COLUMNS = ["value", "seq", "partition", "timestamp"]


def kafka_options(bootstrap: str, topic: str, starting: str = "latest",
                  **extra) -> dict:
    """Options for a log-topic subscription.

    A new run starts from ``starting`` (``latest`` like a fresh consumer
    group); a restarted query resumes from its checkpoint, not from a group.
    """
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting}
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a static scan that yields fewer splits than the cluster has
    task slots (a small table stored as one row group), so the per-row work
    (parsing, tokenising) runs on every core.  A large input already has
    more splits than slots and is returned unchanged: no shuffle."""
    try:
        slots = df.sparkSession.sparkContext.defaultParallelism
        parts = df.rdd.getNumPartitions()
    except Exception:  # no RDD access (e.g. a remote session): leave as is
        return df
    return df.repartition(slots) if parts < slots else df


def _is_dir(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a directory, on any Hadoop file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(p).isDirectory()


def read_table(spark: SparkSession, sf_dir: str, name: str,
               streaming: bool = False, max_files: int | None = None,
               spread_small: bool = False) -> DataFrame:
    """One of the given parquet tables (``<name>.parquet``, a file or a
    directory of files), as a static or a streaming frame.

    A stream over a single file uses its folder with a glob filter, since the
    file source needs a directory; a single file is one task per micro-batch
    whatever its size, so its rows are round-robined over the task slots, or over
    more tasks of ``ROWS_OF_A_TASK`` rows.  A directory of files is streamed as it
    is.  ``spread_small`` deals a static table of fewer splits than task slots over
    the slots, for small tables.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if not streaming:
        df = spark.read.parquet(path)
        return spread(df) if spread_small else df
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if _is_dir(spark, path):
        return r.parquet(path)
    tasks = max(spark.sparkContext.defaultParallelism, -(-spark.read.parquet(path).count() // ROWS_OF_A_TASK))
    return r.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir).repartition(tasks)


def read_lines(spark: SparkSession, source, streaming: bool = True,
               fmt: str = "text", max_per_trigger: int | None = None) -> DataFrame:
    """Read messages from a log topic (``source`` a dict of Kafka options) or
    from a folder of files (``source`` a path).

    ``fmt="text"``: one message per line.  Text files carry no offsets: a
    static read numbers lines in file order; a stream orders them by the file's
    modification time (whole seconds) and the position in the file, and a file is
    a partition (see :func:`_numbered`).
    ``fmt="parquet"``: files that already hold the line columns (for example
    written by the line sink), read unchanged.

    ``max_per_trigger`` bounds a micro-batch (offsets for a topic, files for
    a folder), and with it what one key's state holds in memory per batch.
    """
    if isinstance(source, dict):
        r = spark.readStream if streaming else spark.read
        if streaming and max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        if not streaming and source.get("startingOffsets") == "latest":
            source = {**source, "startingOffsets": "earliest"}   # all there is: a static read has no later
        raw = r.format("kafka").options(**source).load()
        return raw.select(
            F.col("value").cast("string").alias("value"),
            F.col("offset").cast("bigint").alias("seq"),
            F.col("partition").cast("int").alias("partition"),
            F.col("timestamp").cast("timestamp").alias("timestamp"))
    if fmt == "parquet":
        schema = "value STRING, seq BIGINT, partition INT, timestamp TIMESTAMP"
        r = spark.readStream.schema(schema) if streaming else spark.read.schema(schema)
        if streaming and max_per_trigger:
            r = r.option("maxFilesPerTrigger", max_per_trigger)
        return r.parquet(source).select(*LINE_COLUMNS)
    r = spark.readStream if streaming else spark.read
    if streaming and max_per_trigger:
        r = r.option("maxFilesPerTrigger", max_per_trigger)
    raw = r.text(source)
    if streaming:
        return _numbered(raw)
    return raw.select(
        F.col("value"), F.monotonically_increasing_id().alias("seq"),
        F.spark_partition_id().alias("partition"), F.current_timestamp().alias("timestamp"))


def _numbered(raw: DataFrame) -> DataFrame:
    """Streamed text lines with ``seq`` = file time in seconds, then the line's
    position in its file.

    A line of a file block is counted from the block's first byte; a line takes a
    byte at least, so the numbers of later blocks are larger, and a file may be
    read by many tasks.  Spark has no line number for streamed text, so an Arrow
    map counts the lines of each block as they come.  A file of 2 ** ``POSITION_BITS``
    bytes (16 GiB) or more stops the query with a message instead of taking a
    wrong order.  Files of one second are partitions side by side.
    """
    def count(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        path, start, done = None, None, 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            starts = b.column(2).to_numpy()
            paths = b.column(1)
            new = np.ones(n, dtype=bool)
            new[0] = (paths[0].as_py(), starts[0]) != (path, start)
            new[1:] = (starts[1:] != starts[:-1]) | pc.not_equal(paths[1:], paths[:-1]).to_numpy(zero_copy_only=False)
            row = np.arange(n)
            first = np.maximum.accumulate(np.where(new, row, 0 if new[0] else -done))
            at = row - first
            path, start, done = paths[n - 1].as_py(), starts[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(starts + at)], [*b.schema.names, "at"])

    meta = raw.select("value", F.col("_metadata.file_path").alias("path"),
                      F.col("_metadata.file_block_start").cast("bigint").alias("start"),
                      F.unix_seconds(F.col("_metadata.file_modification_time")).alias("sec"))
    lines = meta.mapInArrow(count, "value STRING, path STRING, start BIGINT, sec BIGINT, at BIGINT")
    at = F.when(F.col("at") < 1 << POSITION_BITS, F.col("at")).otherwise(
        F.raise_error(F.concat(F.lit("text file too long to be ordered: "), "path")).cast("bigint"))
    seq = (F.col("sec") - ZERO_SECOND) * F.lit(1 << POSITION_BITS).cast("bigint") + at
    return lines.select(
        "value", seq.alias("seq"), F.hash("path").bitwiseAND(0x7FFFFFFF).alias("partition"),
        F.current_timestamp().alias("timestamp"))
