"""DuckDB SQL equal to each named query, over the same parquet tables.

The message lines are derived in SQL with the same formulas as
:mod:`eddyline.sources.derive`, then parsed and aggregated in plain SQL.
Epoch milliseconds are ``epoch_us(ts) // 1000`` (DuckDB's ``epoch_ms``
rounds, Spark truncates).
"""

from __future__ import annotations

# Fixed value: strftime form of the reference's time format (day before month).
FMT = "'%Y/%d/%m %H:%M:%S'"
INT_RE = "'[+-]?[0-9]+'"


def _strict(x: str, typ: str) -> str:
    return f"(CASE WHEN regexp_full_match({x}, {INT_RE}) THEN TRY_CAST({x} AS {typ}) END)"


def _fmt_text(x: str) -> str:
    return f"COALESCE(strftime(make_timestamp({_strict(x, 'BIGINT')} * 1000), {FMT}), {x})"


def _jsplit(x: str) -> str:
    """Java split on ',' (trailing empty parts dropped)."""
    return f"string_split(regexp_replace({x}, ',+$', ''), ',')"


MS = "(epoch_us(ts) // 1000)"

ACCESS_SRC = f"""
access_src AS (
  SELECT event_id AS seq, CAST(user_id % 4 AS INTEGER) AS partition,
         concat_ws(',', '/u/' || CAST(user_id % 20 AS VARCHAR),
                   CASE WHEN event_type = 'view' THEN 'GET' ELSE 'POST' END,
                   event_type, '1', CAST({MS} AS VARCHAR),
                   CASE WHEN event_type = 'error' THEN '500' ELSE '200' END,
                   CAST(CAST(floor(value) AS INTEGER) AS VARCHAR)) AS value
  FROM events),
access_parts AS (SELECT seq, partition, value, {_jsplit('value')} AS f FROM access_src),
access_rows AS (
  SELECT seq, partition, f[1] AS url, f[2] AS method, f[3] AS response,
         {_strict('f[4]', 'INTEGER')} AS cnt, f[5] AS time_text,
         COALESCE({_strict('f[5]', 'BIGINT')}, 0) AS ms,
         {_strict('f[6]', 'INTEGER')} AS code, {_strict('f[7]', 'INTEGER')} AS took
  FROM access_parts
  WHERE contains(value, ',') AND len(f) = 7
    AND {_strict('f[4]', 'INTEGER')} IS NOT NULL AND {_strict('f[6]', 'INTEGER')} IS NOT NULL
    AND {_strict('f[7]', 'INTEGER')} IS NOT NULL)"""

# Damaged access lines: see eddyline.sources.derive.
_HEAD = f"""concat_ws(',', '/u/' || CAST(user_id % 20 AS VARCHAR),
          CASE WHEN event_type = 'view' THEN 'GET' ELSE 'POST' END, event_type, '1',
          CASE WHEN event_id % 109 = 0 THEN '999999999999999999' ELSE CAST({MS} AS VARCHAR) END,
          CASE WHEN event_type = 'error' THEN '500' ELSE '200' END)"""
_TOOK = "(CASE WHEN event_id % 7 = 0 THEN -1 ELSE 1 END * CAST(floor(value) AS INTEGER))"

DAMAGED_PARTS = f"""
damaged AS (
  SELECT event_id AS seq, CAST(user_id % 4 AS INTEGER) AS partition,
         CASE WHEN event_id % 97 = 0 THEN {_HEAD}
              WHEN event_id % 101 = 0 THEN {_HEAD} || ',x'
              WHEN event_id % 103 = 0 THEN {_HEAD} || ',' || CAST({_TOOK} AS VARCHAR) || chr(10)
              WHEN event_id % 107 = 0 THEN NULL
              ELSE {_HEAD} || ',' || CAST({_TOOK} AS VARCHAR) END AS value
  FROM events),
damaged_parts AS (SELECT seq, partition, value, {_jsplit('value')} AS f FROM damaged),
judged AS (
  SELECT *, CASE WHEN value IS NULL THEN 'null line'
                 WHEN NOT (contains(value, ',') AND len(f) = 7) THEN 'arity'
                 WHEN {_strict('f[7]', 'INTEGER')} IS NULL THEN 'bad number'
                 WHEN f[5] = '999999999999999999' THEN 'time out of range' END AS reason
  FROM damaged_parts)"""

DAMAGED_ROWS = f"""{DAMAGED_PARTS},
access_rows AS (
  SELECT seq, partition, f[1] AS url, f[2] AS method, f[3] AS response, CAST(f[4] AS INTEGER) AS cnt,
         f[5] AS time_text, CAST(f[5] AS BIGINT) AS ms, CAST(f[6] AS INTEGER) AS code,
         CAST(f[7] AS INTEGER) AS took
  FROM judged WHERE reason IS NULL)"""

COUNT_SRC = f"""
count_src AS (
  SELECT event_id AS seq, CAST(user_id % 4 AS INTEGER) AS partition,
         CASE WHEN event_id % 97 = 0 THEN event_type || ',1,'
              WHEN event_id % 101 = 0 THEN concat_ws(',', event_type, 'x', CAST({MS} AS VARCHAR))
              WHEN event_id % 89 = 0 THEN concat_ws(',', event_type, CAST(user_id % 3 + 1 AS VARCHAR), CAST({MS} AS VARCHAR)) || ','
              ELSE concat_ws(',', event_type, CAST(user_id % 3 + 1 AS VARCHAR), CAST({MS} AS VARCHAR))
         END AS value
  FROM events),
count_parts AS (SELECT seq, partition, value, {_jsplit('value')} AS f FROM count_src),
count_rows AS (
  SELECT seq, partition, f[1] AS key, {_strict('f[2]', 'INTEGER')} AS cnt, f[3] AS time_text,
         COALESCE({_strict('f[3]', 'BIGINT')}, 0) AS ms
  FROM count_parts
  WHERE contains(value, ',') AND len(f) = 3 AND {_strict('f[2]', 'INTEGER')} IS NOT NULL)"""


def _access_stats(window_ms: int, source: str = ACCESS_SRC) -> str:
    return f"""
WITH {source.strip()}
SELECT url, response, (ms // {window_ms}) * {window_ms} AS window_start_ms,
       (ms // {window_ms}) * {window_ms} + {window_ms} AS window_end_ms,
       arg_min(method, seq) AS method, arg_min(code, seq) AS code,
       CAST(sum(cnt) AS BIGINT) AS count,
       CAST(list_reduce(list(took ORDER BY seq, partition), lambda a, x: (a + x) // 2) AS INTEGER)
         AS response_time_avg,
       round(avg(took), 6) AS response_time_mean
FROM access_rows
GROUP BY url, response, ms // {window_ms}
"""


def _access_reduce(window_ms: int, compat: bool) -> str:
    clean = f"{_fmt_text('time_text')} || ' took' || CAST(took AS VARCHAR) || 'ms'"
    if compat:
        first = (f"(CASE WHEN contains(time_text, '000') THEN {_fmt_text('time_text')} "
                 f"ELSE time_text END) || ' took' || CAST(took AS VARCHAR) || 'ms'")
        entry = f"CASE WHEN rn = 1 THEN {first} ELSE {clean} END"
        times = (f"CASE WHEN count(*) = 1 THEN min(time_text) "
                 f"ELSE string_agg({entry}, '|' ORDER BY seq, partition) END")
    else:
        times = f"string_agg({clean}, '|' ORDER BY seq, partition)"
    return f"""
WITH {ACCESS_SRC.strip()},
w AS (
  SELECT *, (ms // {window_ms}) * {window_ms} AS window_start_ms,
         row_number() OVER (PARTITION BY url, response, ms // {window_ms}
                            ORDER BY seq, partition) AS rn
  FROM access_rows)
SELECT url, response, window_start_ms, window_start_ms + {window_ms} AS window_end_ms,
       arg_min(method, rn) AS method, arg_min(code, rn) AS code,
       CAST(sum(cnt) AS BIGINT) AS count,
       CAST(list_reduce(list(took ORDER BY seq, partition), lambda a, x: (a + x) // 2) AS INTEGER)
         AS response_time_avg,
       round(avg(took), 6) AS response_time_mean,
       {times} AS times
FROM w
GROUP BY url, response, window_start_ms
"""


def _count_reduce(window_ms: int, compat: bool) -> str:
    clean = _fmt_text("time_text")
    if compat:
        first = f"CASE WHEN contains(time_text, '000') THEN {clean} ELSE time_text END"
        entry = f"CASE WHEN rn = 1 THEN {first} ELSE {clean} END"
        times = (f"CASE WHEN count(*) = 1 THEN min(time_text) "
                 f"ELSE string_agg({entry}, '|' ORDER BY seq, partition) END")
    else:
        times = f"string_agg({clean}, '|' ORDER BY seq, partition)"
    return f"""
WITH {COUNT_SRC.strip()},
w AS (
  SELECT *, (ms // {window_ms}) * {window_ms} AS window_start_ms,
         row_number() OVER (PARTITION BY key, ms // {window_ms} ORDER BY seq, partition) AS rn
  FROM count_rows)
SELECT key, window_start_ms, window_start_ms + {window_ms} AS window_end_ms,
       CAST(sum(cnt) AS BIGINT) AS count, {times} AS times
FROM w
GROUP BY key, window_start_ms
"""


W30S = 30_000
W6H = 6 * 3600 * 1000

ORACLE_SQL = {
    "access_window_reduce": _access_reduce(W30S, False),
    "access_window_reduce_6h": _access_reduce(W6H, False),
    "access_window_reduce_compat": _access_reduce(W6H, True),
    "access_window_stats": _access_stats(W30S),
    "access_window_stats_6h": _access_stats(W6H),
    "count_window_reduce": _count_reduce(W30S, False),
    "count_window_reduce_6h": _count_reduce(W6H, False),
    "count_window_reduce_compat": _count_reduce(W6H, True),
}


WORD_SPLIT = r"'\W+'"
GAP_US = 600 * 1_000_000

WORD_COUNT = f"""
SELECT word, CAST(count(*) AS BIGINT) AS count_sum
FROM (SELECT unnest(regexp_split_to_array(lower(text), {WORD_SPLIT})) AS word FROM documents)
WHERE length(word) > 0
GROUP BY word
"""

SESSIONS = f"""
WITH toks AS (
  SELECT unnest(regexp_split_to_array(lower(concat_ws(' ', event_type, props)), {WORD_SPLIT})) AS word,
         epoch_us(ts) AS us
  FROM events WHERE ts IS NOT NULL),
t AS (SELECT word, us FROM toks WHERE length(word) > 0),
f AS (SELECT word, us,
             max(us) OVER (PARTITION BY word ORDER BY us
                           RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
      FROM t),
s AS (SELECT word, us,
             sum(CASE WHEN prev IS NULL OR us - prev > {GAP_US} THEN 1 ELSE 0 END)
               OVER (PARTITION BY word ORDER BY us
                     RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
      FROM f)
SELECT word, min(us) AS session_start_us, max(us) + {GAP_US} AS session_end_us,
       CAST(count(*) AS BIGINT) AS count_sum
FROM s GROUP BY word, sid
"""

PARSE_REJECTS = f"""
WITH {COUNT_SRC.strip()},
r AS (
  SELECT seq, partition, value,
         CASE WHEN value IS NULL THEN 'null line'
              WHEN NOT (contains(value, ',') AND len(f) = 3) THEN 'arity'
              WHEN {_strict('f[2]', 'INTEGER')} IS NULL THEN 'bad count' END AS reason
  FROM count_parts)
SELECT seq, partition, value, reason FROM r WHERE reason IS NOT NULL
"""

FIRST_THREE = f"""
WITH {COUNT_SRC.strip()},
p AS (SELECT seq, {_jsplit('lower(value)')} AS f FROM count_src)
SELECT seq, f[1] AS f0, f[2] AS f1, f[3] AS f2 FROM p WHERE len(f) > 2
"""

ORDERS_SRC = """
src AS (
  SELECT CAST(to_json({'user': o_custkey, 'product': o_orderpriority,
                       'amount': CAST(floor(o_totalprice / 1000) AS INTEGER)}) AS VARCHAR) AS value
  FROM orders),
o AS (
  SELECT CAST(json_extract_string(value, '$.user') AS BIGINT) AS "user",
         json_extract_string(value, '$.product') AS product,
         COALESCE(CAST(json_extract_string(value, '$.amount') AS INTEGER), 0) AS amount
  FROM src)"""

ORDERS_BIG = f'WITH {ORDERS_SRC.strip()}\nSELECT "user", product, amount FROM o WHERE amount > 300'
ORDERS_SMALL = f'WITH {ORDERS_SRC.strip()}\nSELECT "user", product, amount FROM o WHERE amount < 2'
ORDERS_UNION = (f'WITH {ORDERS_SRC.strip()}\nSELECT * FROM o WHERE amount > 2 '
                f'UNION ALL SELECT * FROM o WHERE amount < 2')

PREFIX_LINES = f"WITH {COUNT_SRC.strip()}\nSELECT seq, 'PREFIX:' || value AS value FROM count_src"
PREFIX_CHARS = f"""
WITH {COUNT_SRC.strip()}
SELECT ch, count(*) AS n
FROM (SELECT unnest(string_split('PREFIX:' || value, '')) AS ch FROM count_src)
WHERE length(ch) > 0
GROUP BY ch
"""

COUNT_AVERAGE = """
WITH p AS (
  SELECT user_id AS key, CAST(floor(value) AS BIGINT) AS value, event_id AS seq,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
  FROM events),
g AS (SELECT key, (rn - 1) // 2 AS grp, count(*) AS n, sum(value) AS s, max(seq) AS seq
      FROM p GROUP BY key, grp)
SELECT key, CAST(s // 2 AS BIGINT) AS average, seq FROM g WHERE n = 2
"""

CHUNK_ROWS = """
WITH p AS (
  SELECT event_type AS name, CAST(floor(value) AS INTEGER) AS value, event_id AS seq,
         CAST(user_id % 4 AS INTEGER) AS bucket
  FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY seq) AS rn,
             count(*) OVER (PARTITION BY bucket) AS total
      FROM p)
SELECT name, value, seq, bucket, CAST((rn - 1) // 8 AS BIGINT) AS chunk,
       CAST((rn - 1) % 8 AS INTEGER) AS position
FROM r WHERE (rn - 1) // 8 < total // 8
"""

LATE_SPLIT = f"""
WITH a AS (
  SELECT event_id, {MS} AS ms, event_id + (event_id * 7919) % 50 AS seq,
         CAST(user_id % 4 AS INTEGER) AS partition
  FROM events),
m AS (SELECT *, max(ms) OVER (PARTITION BY partition ORDER BY seq, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark_ms
      FROM a)
SELECT event_id, seq, partition, (ms // {W6H}) * {W6H} AS window_start_ms, watermark_ms,
       COALESCE((ms // {W6H}) * {W6H} + {W6H} - 1 <= watermark_ms, false) AS late
FROM m
"""

WORD_DOCS = f"""
WITH c AS ({WORD_COUNT})
SELECT CAST(to_json({{'data': CAST(to_json({{'word': word, 'countSum': CAST(count_sum AS BIGINT)}})
                                   AS VARCHAR)}}) AS VARCHAR) AS doc
FROM c
"""

def _count_docs(window_ms: int) -> str:
    return f"""
WITH {COUNT_SRC.strip()}
SELECT CAST(to_json({{'key': key, 'count': CAST(sum(cnt) AS BIGINT),
                      'times': list({_fmt_text('time_text')} ORDER BY seq, partition)}}) AS VARCHAR) AS doc,
       (ms // {window_ms}) * {window_ms} + {window_ms} AS window_end_ms
FROM count_rows
GROUP BY key, ms // {window_ms}
"""


def _access_docs(window_ms: int) -> str:
    return f"""
WITH {ACCESS_SRC.strip()}
SELECT CAST(to_json({{'url': url, 'method': arg_min(method, seq), 'response': response,
                      'count': CAST(sum(cnt) AS BIGINT), 'code': arg_min(code, seq),
                      'responseTimeAvg': CAST(list_reduce(list(took ORDER BY seq, partition),
                                                          lambda a, x: (a + x) // 2) AS INTEGER),
                      'times': list({_fmt_text('time_text')} || ' took' || CAST(took AS VARCHAR) || 'ms'
                                    ORDER BY seq, partition)}}) AS VARCHAR) AS doc,
       (ms // {window_ms}) * {window_ms} + {window_ms} AS window_end_ms
FROM access_rows
GROUP BY url, response, ms // {window_ms}
"""


ORDER_DOCS = f"""
WITH {ORDERS_SRC.strip()}
SELECT CAST(to_json({{'user': "user", 'product': product, 'amount': amount}}) AS VARCHAR) AS doc
FROM o WHERE amount > 300
"""

ORACLE_SQL.update({
    "word_count": WORD_COUNT,
    "word_sessions": SESSIONS,
    "parse_rejects": PARSE_REJECTS,
    "first_three_fields": FIRST_THREE,
    "orders_big": ORDERS_BIG,
    "orders_small": ORDERS_SMALL,
    "orders_union": ORDERS_UNION,
    "prefix_lines": PREFIX_LINES,
    "prefix_chars": PREFIX_CHARS,
    "count_average": COUNT_AVERAGE,
    "chunk_rows": CHUNK_ROWS,
    "late_split": LATE_SPLIT,
    "word_docs": WORD_DOCS,
    "count_docs": f"SELECT doc FROM ({_count_docs(W6H)}) q",
    "access_docs": f"SELECT doc FROM ({_access_docs(W6H)}) q",
    "order_docs": ORDER_DOCS,
})


# Streams: a window is emitted once the watermark (the latest event time,
# in whole milliseconds) reaches its end; the rest is still open.
ACCESS_MAX_MS = f"(WITH {ACCESS_SRC.strip()} SELECT max(ms) FROM access_rows)"
COUNT_MAX_MS = f"(WITH {COUNT_SRC.strip()} SELECT max(ms) FROM count_rows)"
EVENT_MAX_US = f"(SELECT max({MS}) * 1000 FROM events)"

ORACLE_SQL.update({
    "access_window_reduce_stream":
        f"SELECT * FROM ({_access_reduce(W30S, False)}) q WHERE window_end_ms <= {ACCESS_MAX_MS}",
    "count_window_reduce_stream":
        f"SELECT * FROM ({_count_reduce(W30S, False)}) q WHERE window_end_ms <= {COUNT_MAX_MS}",
    "word_sessions_stream":
        f"SELECT * FROM ({SESSIONS}) q WHERE session_end_us <= {EVENT_MAX_US}",
    "word_count_stream": WORD_COUNT,
    "orders_union_stream": ORDERS_UNION,
    "count_average_stream": COUNT_AVERAGE,
    "chunk_rows_stream": CHUNK_ROWS,
})


ORACLE_SQL.update({
    "access_job_docs":
        f"SELECT doc FROM ({_access_docs(W30S)}) q WHERE window_end_ms <= {ACCESS_MAX_MS}",
    "order_job_docs": ORDER_DOCS,
})


SESSION_DOCS = f"""
SELECT CAST(to_json({{'data': CAST(to_json({{'word': word, 'countSum': CAST(count_sum AS BIGINT)}})
                                   AS VARCHAR)}}) AS VARCHAR) AS doc
FROM ({SESSIONS}) q WHERE session_end_us <= {EVENT_MAX_US}
"""

ORACLE_SQL.update({
    "count_job_docs":
        f"SELECT doc FROM ({_count_docs(W30S)}) q WHERE window_end_ms <= {COUNT_MAX_MS}",
    "word_session_job_docs": SESSION_DOCS,
})


# Streamed late rows: batch b holds seq range b; a row is kept unless its
# window ended at or before the watermark of the earlier batches (their
# latest event time, in whole milliseconds).
LATE_ROWS_STREAM = f"""
WITH a AS (SELECT epoch_us(ts) AS us, event_id + (event_id * 7919) % 50 AS seq FROM events),
p AS (SELECT min(seq) AS lo, (max(seq) - min(seq)) // 10 + 1 AS step FROM a),
b AS (SELECT a.*, (seq - p.lo) // p.step AS batch, (us // 1000 // {W6H}) * {W6H} AS ws FROM a, p),
m AS (SELECT batch, max(us) AS mx FROM b GROUP BY batch),
w AS (SELECT m1.batch, (SELECT max(m2.mx) FROM m m2 WHERE m2.batch < m1.batch) AS prev_max
      FROM m m1),
kept AS (SELECT b.* FROM b JOIN w USING (batch)
         WHERE w.prev_max IS NULL OR (ws + {W6H}) * 1000 > (w.prev_max // 1000) * 1000)
SELECT ws AS window_start_ms, ws + {W6H} AS window_end_ms, count(*) AS n
FROM kept
GROUP BY ws
HAVING ws + {W6H} <= (SELECT max(us) // 1000 FROM a)
"""

ORACLE_SQL["late_rows_stream"] = LATE_ROWS_STREAM


ORACLE_SQL["count_window_totals"] = f"""
WITH {COUNT_SRC.strip()}
SELECT key, (ms // {W30S}) * {W30S} AS window_start_ms,
       (ms // {W30S}) * {W30S} + {W30S} AS window_end_ms, CAST(sum(cnt) AS BIGINT) AS count
FROM count_rows
GROUP BY key, ms // {W30S}
"""

ORACLE_SQL["access_window_stats_stream"] = (
    f"SELECT * FROM ({_access_stats(W30S)}) q WHERE window_end_ms <= {ACCESS_MAX_MS}")


# Damaged lines, rows still held, word windows, the printout and text files.
_GOOD = """CAST(to_json({'user': o_custkey, 'product': o_orderpriority,
          'amount': CAST(floor(o_totalprice / 1000) AS INTEGER)}) AS VARCHAR)"""
DAMAGED_ORDERS = f"""
o AS (
  SELECT *, CASE WHEN o_orderkey % 97 = 0 THEN 'malformed json'
                 WHEN o_orderkey % 101 = 0 THEN 'malformed json'
                 WHEN o_orderkey % 103 = 0 OR o_orderkey % 107 = 0 THEN NULL
                 WHEN o_orderkey % 109 = 0 THEN 'bad amount'
                 WHEN o_orderkey % 113 = 0 THEN 'malformed json' END AS reason
  FROM orders)"""

ORACLE_SQL.update({
    "access_rejects": f"""
WITH {DAMAGED_PARTS.strip()}
SELECT seq, partition, value, reason FROM judged WHERE reason IS NOT NULL
""",
    "access_window_stats_mixed": _access_stats(W6H, DAMAGED_ROWS),
    "access_window_stats_mixed_stream": (
        f"SELECT * FROM ({_access_stats(W6H, DAMAGED_ROWS)}) q WHERE window_end_ms <= "
        f"(WITH {DAMAGED_ROWS.strip()} SELECT max(ms) FROM access_rows)"),
    "order_rejects": f"""
WITH {DAMAGED_ORDERS.strip()}
SELECT o_orderkey AS seq, CAST(o_custkey % 4 AS INTEGER) AS partition,
       CASE WHEN o_orderkey % 97 = 0 THEN {_GOOD} || ' trailing'
            WHEN o_orderkey % 101 = 0 THEN {_GOOD} || {_GOOD}
            WHEN o_orderkey % 109 = 0 THEN CAST(to_json({{'user': o_custkey, 'product': o_orderpriority,
                                                          'amount': 'x'}}) AS VARCHAR)
            ELSE {_GOOD} || '}}' END AS value,
       reason
FROM o WHERE reason IS NOT NULL
""",
    "order_docs_damaged": f"""
WITH {DAMAGED_ORDERS.strip()}
SELECT CAST(to_json({{
         'user': o_custkey,
         'product': CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE o_orderpriority END,
         'amount': CASE WHEN o_orderkey % 103 <> 0 AND o_orderkey % 107 = 0 THEN 0
                        ELSE CAST(floor(o_totalprice / 1000) AS INTEGER) END}}) AS VARCHAR) AS doc
FROM o WHERE reason IS NULL
""",
    "chunk_pending": CHUNK_ROWS.replace("WHERE (rn - 1) // 8 < total // 8",
                                        "WHERE (rn - 1) // 8 >= total // 8"),
    "word_count_stream": f"SELECT word, count_sum, true AS windows_aligned FROM ({WORD_COUNT}) q",
    "order_job_print": ORDER_DOCS,
    "access_text_job_docs": ORACLE_SQL["access_job_docs"],
})

WORD_WINDOWS = f"""
SELECT word, ({MS} // {W30S}) * {W30S} AS window_start_ms,
       ({MS} // {W30S}) * {W30S} + {W30S} AS window_end_ms, CAST(count(*) AS BIGINT) AS count_sum
FROM (SELECT ts, unnest(regexp_split_to_array(lower(concat_ws(' ', event_type, props)), {WORD_SPLIT})) AS word
      FROM events WHERE ts IS NOT NULL)
WHERE length(word) > 0
GROUP BY ALL
"""
ORACLE_SQL["word_windows"] = WORD_WINDOWS
ORACLE_SQL["word_windows_stream"] = (
    f"SELECT * FROM ({WORD_WINDOWS}) q WHERE window_end_ms <= (SELECT max({MS}) FROM events)")


# A log of lines: a record's offset is the number of bytes before it in its partition.
LOG_LINES = f"""
WITH {COUNT_SRC.strip()}
SELECT partition, CAST(coalesce(sum(strlen(value) + 1) OVER (
         PARTITION BY partition ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS seq,
       value
FROM count_src
"""

# Null keys and values: see eddyline.sources.derive.
_KEYED_NULLS = """
  SELECT CASE WHEN event_id % 13 <> 0 THEN user_id END AS key,
         CASE WHEN event_id % 3 <> 0 THEN CAST(floor(value) AS BIGINT) END AS value, event_id AS seq
  FROM events"""


def _averages(n: int) -> str:
    return f"""
WITH p AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq) AS rn FROM ({_KEYED_NULLS}) q),
g AS (SELECT key, (rn - 1) // {n} AS grp, count(*) AS n, sum(value) AS s, max(seq) AS seq
      FROM p GROUP BY key, grp)
SELECT key, CAST(s // {n} AS BIGINT) AS average, seq FROM g WHERE n = {n}
"""


AVERAGE_PENDING = f"""
WITH p AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq) AS rn,
                  count(*) OVER (PARTITION BY key) AS total
           FROM ({_KEYED_NULLS}) q)
SELECT key, count(*) AS count, CAST(coalesce(sum(value), 0) AS BIGINT) AS total, count(value) AS known
FROM p WHERE rn > total - total % 3 GROUP BY key
"""

_CHUNK_NULLS = """
WITH p AS (
  SELECT event_type AS name, CASE WHEN event_id % 3 <> 0 THEN CAST(floor(value) AS INTEGER) END AS value,
         event_id AS seq, CASE WHEN event_id % 13 <> 0 THEN CAST(user_id % 4 AS INTEGER) END AS bucket
  FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY seq) AS rn,
             count(*) OVER (PARTITION BY bucket) AS total
      FROM p)
"""
CHUNK_NULLS = _CHUNK_NULLS + """SELECT name, value, seq, bucket, CAST((rn - 1) // 8 AS BIGINT) AS chunk,
       CAST((rn - 1) % 8 AS INTEGER) AS position
FROM r WHERE (rn - 1) // 8 < total // 8
"""
CHUNK_STATE = _CHUNK_NULLS + "SELECT name, value, seq, bucket FROM r WHERE (rn - 1) // 8 >= total // 8"


def _time_rows(src: str, rows: str, keys: str, entry: str, window_ms: int) -> str:
    return f"""
WITH {src.strip()}
SELECT {keys}, (ms // {window_ms}) * {window_ms} AS window_start_ms,
       (ms // {window_ms}) * {window_ms} + {window_ms} AS window_end_ms,
       row_number() OVER (PARTITION BY {keys}, ms // {window_ms} ORDER BY seq, partition) - 1 AS position,
       {entry} AS time
FROM {rows}
"""


_NOTED = f"{_fmt_text('time_text')} || ' took' || CAST(took AS VARCHAR) || 'ms'"
ACCESS_TIMES = _time_rows(ACCESS_SRC, "access_rows", "url, response", _NOTED, W30S)

PREFIX_CHAR_ROWS = f"""
WITH {COUNT_SRC.strip()},
c AS (SELECT seq, 'PREFIX:' || value AS t FROM count_src),
p AS (SELECT seq, t, unnest(range(length(t))) AS i FROM c)
SELECT seq, CAST(i AS INTEGER) AS pos, substring(t, i + 1, 1) AS ch FROM p
"""

# The watermark of a union is that of its slowest partition.
SLOW_PARTITION = f"""
WITH e AS (SELECT {MS} AS ms, user_id % 4 AS p FROM events),
m AS (SELECT min(mx) AS mark FROM (SELECT max(ms) AS mx FROM e GROUP BY p))
SELECT (ms // {W6H}) * {W6H} AS window_start_ms, (ms // {W6H}) * {W6H} + {W6H} AS window_end_ms, count(*) AS n
FROM e, m WHERE (ms // {W6H}) * {W6H} + {W6H} <= mark GROUP BY ms // {W6H}
"""

ORACLE_SQL.update({
    "log_restart_stream": LOG_LINES,
    "log_from_offsets_stream": f"""
SELECT partition, seq, value FROM (
  SELECT *, sum(strlen(value) + 1) OVER (PARTITION BY partition) AS size FROM ({LOG_LINES}) q)
WHERE seq >= size // 2""",
    "late_split_stream": LATE_SPLIT,
    "slow_partition_windows_stream": SLOW_PARTITION,
    "access_window_times": ACCESS_TIMES,
    "access_window_times_stream": ACCESS_TIMES,
    "count_window_times_6h": _time_rows(COUNT_SRC, "count_rows", "key", _fmt_text("time_text"), W6H),
    "access_window_timers_stream": ORACLE_SQL["access_window_stats_stream"],
    "word_clock_windows_stream": f"SELECT word, count_sum, true AS windows_aligned FROM ({WORD_COUNT}) q",
    "count_average_nulls": _averages(2),
    "count_average_nulls_stream": _averages(2),
    "chunk_rows_nulls": CHUNK_NULLS,
    "chunk_rows_nulls_stream": CHUNK_NULLS,
    "count_average_pending": AVERAGE_PENDING,
    "count_average_pending_state": AVERAGE_PENDING,
    "chunk_pending_state": CHUNK_STATE,
    "count_average_resumed_stream": _averages(3),
    "chunk_rows_resumed_stream": CHUNK_NULLS,
    "prefix_char_rows": PREFIX_CHAR_ROWS,
})
