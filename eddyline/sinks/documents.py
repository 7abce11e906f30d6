"""JSON documents for a search index, and the writers that send them.

Each shape function returns one ``doc`` column of JSON text.  The writers
take an ``index`` (one folder per index under a target folder, or a
connector's resource name) and write a micro-batch (or a static frame) at a
time: the batch is the flush unit, written in parallel per partition.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def word_documents(counts: DataFrame) -> DataFrame:
    """``{"data": "<JSON text of {word, countSum}>"}``: the word count JSON
    is a string inside the document."""
    inner = F.to_json(F.struct(F.col("word"), F.col("count_sum").alias("countSum")))
    return counts.select(F.to_json(F.struct(inner.alias("data"))).alias("doc"))


def count_documents(reduced: DataFrame) -> DataFrame:
    """``{"key", "count", "times": [..]}`` from a count window reduce."""
    return reduced.select(F.to_json(F.struct(
        "key", "count", "times")).alias("doc"))


def access_documents(reduced: DataFrame) -> DataFrame:
    """``{"url", "method", "response", "count", "code", "responseTimeAvg",
    "times": [..]}`` from an access window reduce."""
    return reduced.select(F.to_json(F.struct(
        "url", "method", "response", "count", "code",
        F.col("response_time_avg").alias("responseTimeAvg"), "times")).alias("doc"))


def object_documents(df: DataFrame) -> DataFrame:
    """Every field of the row as a JSON object, null fields included."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]),
                               {"ignoreNullFields": "false"}).alias("doc"))


def write_documents(docs: DataFrame, target: str, index: str, mode: str = "append",
                    max_records_per_file: int | None = None) -> None:
    """Write a static frame of documents into ``target/index`` as JSON lines;
    ``max_records_per_file`` caps a file (the bulk-request size)."""
    w = docs.select("doc").write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.text(f"{target.rstrip('/')}/{index}")


def write_documents_stream(docs: DataFrame, target: str, index: str, checkpoint: str,
                           trigger: dict | None = None,
                           max_records_per_file: int | None = None) -> StreamingQuery:
    """Stream documents into ``target/index``; exactly once through the
    file sink's commit log and the checkpoint."""
    w = docs.select("doc").writeStream.format("text")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    return (w.option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start(f"{target.rstrip('/')}/{index}"))


def batch_writer(target: str, name: str) -> Callable[[DataFrame, int], None]:
    """A writer for :func:`fan_out`: the batch's documents as JSON lines in
    ``target/name/batch=<epoch>``.  A batch that is replayed after a failure
    overwrites its own folder, so no document is lost or doubled."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        (batch.select("doc").write.mode("overwrite")
         .text(f"{target.rstrip('/')}/{name}/batch={epoch_id}"))
    return write


def fan_out(df: DataFrame, writers: Sequence[Callable[[DataFrame, int], None]],
            checkpoint: str, trigger: dict | None = None,
            output_mode: str = "append") -> StreamingQuery:
    """Send each micro-batch to several targets (an index and a printout,
    say).  The batch is computed once and cached while the writers run."""
    def each(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            for w in writers:
                w(batch, epoch_id)
        finally:
            batch.unpersist()

    return (df.writeStream.option("checkpointLocation", checkpoint)
            .outputMode(output_mode).trigger(**(trigger or {"availableNow": True}))
            .foreachBatch(each).start())


def print_stream(df: DataFrame, output_mode: str = "append", rows: int = 20,
                 trigger: dict | None = None) -> StreamingQuery:
    """A preview of each micro-batch on the driver's console, ``rows`` rows at
    most.  The whole printout of a job is written by :func:`batch_writer`."""
    return (df.writeStream.format("console").outputMode(output_mode)
            .option("numRows", rows).option("truncate", False)
            .trigger(**(trigger or {"availableNow": True})).start())


def topic_sink_options(bootstrap: str, topic: str, **extra) -> dict:
    """Options of a log-topic sink (needs the Kafka connector jar)."""
    opts = {"kafka.bootstrap.servers": bootstrap, "topic": topic}
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def write_lines(lines: DataFrame, target, checkpoint: str | None = None,
                trigger: dict | None = None):
    """Write the ``value`` column as messages: to a log topic when ``target``
    is a dict of topic-sink options, else as parquet line files (readable
    with ``read_lines(..., fmt="parquet")``).  Streams need ``checkpoint``."""
    if isinstance(target, dict):
        data = lines.select(F.col("value").cast("string"))
        if lines.isStreaming:
            return (data.writeStream.format("kafka").options(**target)
                    .option("checkpointLocation", checkpoint)
                    .trigger(**(trigger or {"availableNow": True})).start())
        data.write.format("kafka").options(**target).save()
        return None
    cols = [c for c in ("value", "seq", "partition", "timestamp") if c in lines.columns]
    data = lines.select(*cols)
    if lines.isStreaming:
        return (data.writeStream.format("parquet").option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).start(target))
    data.write.mode("append").parquet(target)
    return None
