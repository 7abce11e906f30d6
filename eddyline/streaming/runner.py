"""Run streaming frames with checkpoints on the shared folder.

Progress and state live in the checkpoint; the parquet file sink commits
each micro-batch through its metadata log, so a query stopped at any point
(or an executor lost mid-batch) restarts from its checkpoint with no loss and
no duplicates.  ``complete`` mode goes through ``foreachBatch`` and rewrites
the whole result per batch, which is idempotent for a replayed batch.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from eddyline.session import checkpoint_root, settings_for_start


def stream_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run of a named stream, under the shared folder."""
    return f"{checkpoint_root(spark)}/streams/{name}-{uuid.uuid4().hex[:12]}"


def start_stream(df: DataFrame, out: str, checkpoint: str, output_mode: str = "append",
                 trigger: dict | None = None, partition_by: list[str] | None = None
                 ) -> StreamingQuery:
    """Start ``df`` into parquet at ``out``.  ``trigger`` as for
    ``DataStreamWriter.trigger`` (default: available now)."""
    w = (df.writeStream.option("checkpointLocation", checkpoint)
         .outputMode(output_mode).trigger(**(trigger or {"availableNow": True})))
    if output_mode == "append":
        if partition_by:
            w = w.partitionBy(*partition_by)
        return w.format("parquet").start(out)
    if output_mode != "complete":
        raise ValueError("output_mode must be 'append' or 'complete'")

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    return w.foreachBatch(write_batch).start()


def run_available_now(df: DataFrame, name: str, output_mode: str = "append",
                      out: str | None = None, checkpoint: str | None = None,
                      state_partitions: int | None = None,
                      settings: dict | None = None) -> DataFrame:
    """Process everything available, stop, and return what was written.

    A stream fixes its number of state partitions when it first starts (no
    adaptive coalescing); a new checkpoint starts with ``state_partitions``
    (default: one per task slot of the cluster, one wave of tasks).
    ``settings`` are further SQL settings for this query only.
    """
    spark = df.sparkSession
    base = stream_dir(spark, name)
    out = out or f"{base}/out"
    checkpoint = checkpoint or f"{base}/checkpoint"
    parts = state_partitions or spark.sparkContext.defaultParallelism
    with settings_for_start(spark, {"spark.sql.shuffle.partitions": parts, **(settings or {})}):
        q = start_stream(df, out, checkpoint, output_mode)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema(df.schema).parquet(out)


def run_until_idle(df: DataFrame, name: str, out: str | None = None, checkpoint: str | None = None,
                   state_partitions: int | None = None, settings: dict | None = None,
                   trigger: str = "0 seconds", until_state_empty: bool = False,
                   limit_seconds: float = 3600) -> DataFrame:
    """Process micro-batches until the source has nothing more, stop, and return what
    was written.  Unlike an available-now run this takes bounded micro-batches from any
    source and lets processing-time timers fire; with ``until_state_empty`` it
    ends only when no keyed state is left."""
    spark = df.sparkSession
    base = stream_dir(spark, name)
    out = out or f"{base}/out"
    parts = state_partitions or spark.sparkContext.defaultParallelism
    with settings_for_start(spark, {"spark.sql.shuffle.partitions": parts, **(settings or {})}):
        q = start_stream(df, out, checkpoint or f"{base}/checkpoint", trigger={"processingTime": trigger})
    try:
        if until_state_empty:
            _wait_for_empty_state(q, limit_seconds)
        else:
            q.processAllAvailable()
    finally:
        q.stop()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema(df.schema).parquet(out)


def _wait_for_empty_state(q: StreamingQuery, limit_seconds: float) -> None:
    end = time.monotonic() + limit_seconds
    taken = False
    while time.monotonic() < end:
        if not q.isActive:
            return
        p = q.lastProgress
        if p is not None:
            taken = taken or any(x["numInputRows"] for x in q.recentProgress)
            if taken and not p["numInputRows"] and not sum(o["numRowsTotal"] for o in p["stateOperators"]):
                return
        time.sleep(0.2)
    raise TimeoutError("the stream still holds state")
