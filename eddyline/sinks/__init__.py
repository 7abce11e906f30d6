"""Sinks: JSON document shapes and writers."""

from eddyline.sinks.documents import (
    access_documents, count_documents, object_documents, word_documents,
    write_documents, write_documents_stream, batch_writer, fan_out, print_stream, write_lines,
    topic_sink_options,
)

__all__ = ["access_documents", "count_documents", "object_documents", "word_documents",
           "write_documents", "write_documents_stream", "batch_writer", "fan_out", "print_stream",
           "write_lines", "topic_sink_options"]
