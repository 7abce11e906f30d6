"""eddyline: stream analytics on PySpark.

Reads text messages (log topic or files), parses them as words, delimited
records or JSON with bad lines set aside, keys and windows them on event or
processing time, and writes JSON documents.  Every operator is a function from
DataFrame to DataFrame built on ``pyspark.sql.functions`` and works on static
and streaming frames alike.
"""

from eddyline.session import build_session, checkpoint_root, prepare_session

__all__ = ["build_session", "checkpoint_root", "prepare_session"]
