"""Named queries over the given tables and their DuckDB oracles."""

from eddyline.plans.catalog import QUERIES, STREAM_QUERIES
from eddyline.plans.oracle import ORACLE_SQL

__all__ = ["QUERIES", "STREAM_QUERIES", "ORACLE_SQL"]
