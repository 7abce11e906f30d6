"""Sources: message readers and message lines derived from the given tables."""

from eddyline.sources.lines import LINE_COLUMNS, read_lines, read_table, kafka_options
from eddyline.sources.log import read_log
from eddyline.sources.derive import (
    arrival_lines, text_lines, event_lines, count_lines, access_lines, order_lines, keyed_pairs,
    named_pairs, arrival_order,
)

__all__ = [
    "LINE_COLUMNS", "read_lines", "read_table", "kafka_options", "text_lines",
    "event_lines", "count_lines", "access_lines", "order_lines", "keyed_pairs",
    "named_pairs", "arrival_order", "arrival_lines", "read_log",
]
