"""Structured Streaming: runner and stateful processors."""

from eddyline.streaming.runner import run_available_now, run_until_idle, start_stream, stream_dir
from eddyline.streaming.stateful import (
    ChunkBuffer, CountAverage, chunk_rows_stream, count_average_stream, pending_averages, pending_chunks,
)
from eddyline.streaming.timed import access_window_timers, mark_late_stream, word_clock_windows

__all__ = ["run_available_now", "run_until_idle", "start_stream", "stream_dir", "ChunkBuffer",
           "CountAverage", "chunk_rows_stream", "count_average_stream", "pending_averages",
           "pending_chunks", "access_window_timers", "mark_late_stream", "word_clock_windows"]
