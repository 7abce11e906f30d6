"""Operators: DataFrame -> DataFrame functions over parsed messages."""

from eddyline.operators.parse import (
    Parsed, parse_access_lines, parse_count_lines, parse_first_three, parse_orders,
)
from eddyline.operators.words import (
    word_count, word_count_window, word_pairs, word_sessions, word_sessions_stream,
)
from eddyline.operators.window_reduce import (
    access_window_reduce, access_window_stats, access_window_times, count_window_reduce,
    count_window_times,
)
from eddyline.operators.keyed import average_pending, chunk_rows, chunk_state, count_average
from eddyline.operators.late import mark_late, split_late
from eddyline.operators.sqlops import as_table, sql_filter, union_all_filtered
from eddyline.operators.prefix import char_counts, prefix_chars, prefix_lines
from eddyline.operators.scan import hot_key_bucket, ordinal, running

__all__ = [
    "Parsed", "parse_access_lines", "parse_count_lines", "parse_first_three",
    "parse_orders", "word_count", "word_count_window", "word_pairs", "word_sessions",
    "word_sessions_stream", "access_window_reduce", "access_window_stats", "count_window_reduce",
    "access_window_times", "count_window_times", "chunk_rows", "chunk_state", "count_average", "average_pending", "mark_late", "split_late", "as_table",
    "sql_filter", "union_all_filtered", "char_counts", "prefix_chars",
    "prefix_lines", "ordinal", "running", "hot_key_bucket",
]
