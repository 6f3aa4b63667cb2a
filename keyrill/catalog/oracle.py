"""The queries as SQL for DuckDB, over views named like the tables."""

from __future__ import annotations

SIX_HOURS = 6 * 3_600_000
DAY = 24 * 3_600_000
HOUR = 3_600_000

LINES = """
    SELECT {ids}, CAST(n - 1 AS INTEGER) AS line_no, parts[n] AS line
    FROM (
        SELECT {ids}, string_split_regex(regexp_replace(text, '\\n$', ''), '\\r?\\n') AS parts FROM {table}
    ), unnest(range(1, len(parts) + 1)) AS u(n)
"""

# Single spaces separate tokens; empty tokens at the end of a line are dropped.
TOKENS = """
    CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN CAST([] AS VARCHAR[])
         ELSE string_split(rtrim(line, ' '), ' ') END
"""

DOCUMENT_WORDS = f"""
    doc_lines AS ({LINES.format(ids="doc_id", table="documents")}),
    doc_tokens AS (SELECT doc_id, line_no, {TOKENS} AS parts FROM doc_lines),
    words AS (
        SELECT doc_id, line_no, CAST(n - 1 AS INTEGER) AS pos, parts[n] AS word
        FROM doc_tokens, unnest(range(1, len(parts) + 1)) AS u(n)
    )
"""

TURN_WORDS = f"""
    turn_lines AS ({LINES.format(ids="conv_id, turn", table="conversations")}),
    turn_tokens AS (SELECT conv_id, turn, line_no, {TOKENS} AS parts FROM turn_lines),
    words AS (
        SELECT conv_id, turn, line_no, CAST(n - 1 AS INTEGER) AS pos, parts[n] AS word
        FROM turn_tokens, unnest(range(1, len(parts) + 1)) AS u(n)
    )
"""

EVENTS = """
    e AS (
        SELECT event_id, user_id, event_type, value, props, epoch_us(ts) // 1000 AS time,
               CAST(round(value * 100) AS BIGINT) AS cents
        FROM events
    )
"""

SESSIONS = f"""
    {EVENTS},
    two AS (SELECT * FROM e WHERE event_type IN ('click', 'purchase')),
    gaps AS (
        SELECT *, time - lag(time) OVER w AS gap FROM two WINDOW w AS (PARTITION BY user_id ORDER BY time, event_id)
    ),
    opened AS (
        SELECT *, last_value(CASE WHEN gap IS NULL OR gap > {DAY} THEN time END IGNORE NULLS) OVER w AS session_start,
               row_number() OVER w AS arrival
        FROM gaps WINDOW w AS (PARTITION BY user_id ORDER BY time, event_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    ),
    pairs AS (
        SELECT l.user_id, l.session_start, l.event_id AS left_id, r.event_id AS right_id,
               l.user_id || ' == ' || r.user_id AS text, greatest(l.arrival, r.arrival) AS complete
        FROM opened l JOIN opened r ON l.user_id = r.user_id AND l.session_start = r.session_start
        WHERE l.event_type = 'click' AND r.event_type = 'purchase'
    )
"""

GROUP_TEXT = """
    'Data in stream1: ' || chr(10) || repeat(user_id || '<->1' || chr(10), CAST(n_left AS BIGINT))
    || 'Data in stream2: ' || chr(10) || repeat(user_id || '<->1' || chr(10), CAST(n_right AS BIGINT)) AS text
"""

COGROUP = """
    SELECT user_id, session_start, count(*) FILTER (event_type = 'click') AS n_left,
           count(*) FILTER (event_type = 'purchase') AS n_right
    FROM opened GROUP BY user_id, session_start
"""

LATEST_PRIORITY = """
    config AS (
        SELECT o_custkey AS user_id, arg_max(o_orderpriority, o_orderkey) AS name FROM orders GROUP BY o_custkey
    )
"""

AS_OF = """
    WITH both_sides AS (
        SELECT event_id, user_id, event_type, CASE WHEN event_type = 'signup' THEN props END AS told
        FROM events WHERE event_type IN ('signup', 'purchase')
    ),
    known AS (
        SELECT event_id, user_id, event_type,
               last_value(told IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS name
        FROM both_sides
    )
    SELECT event_id, user_id, name FROM known WHERE event_type = 'purchase' AND name IS NOT NULL
"""


def _interval(below: str) -> str:
    return f"""
        WITH {EVENTS}, m AS (SELECT *, time // 60000 * 60000 AS minute FROM e)
        SELECT l.user_id, l.event_id AS left_id, r.event_id AS right_id
        FROM m l JOIN m r ON l.user_id = r.user_id
        WHERE l.event_type = 'click' AND r.event_type = 'purchase'
          AND l.minute - {SIX_HOURS} {below} r.minute AND r.minute {below} l.minute + {SIX_HOURS}
    """


def _windows(size: int, keys: str = "user_id") -> str:
    by = f"PARTITION BY {keys} " if keys else ""
    return f"""
        {EVENTS},
        w AS (SELECT *, (row_number() OVER ({by}ORDER BY event_id) - 1) // {size} AS window_no FROM e)
    """


COUNT_WINDOW_AVG = f"""
    WITH {_windows(5)}
    SELECT user_id, window_no, count(*) AS n, CAST(sum(cents) // count(*) AS BIGINT) AS average
    FROM w GROUP BY user_id, window_no HAVING count(*) = 5
"""

RUNNING_SUM = f"""
    WITH {EVENTS}
    SELECT event_id, user_id, CAST(sum(cents) OVER (PARTITION BY user_id ORDER BY event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_sum
    FROM e
"""

RUNNING_MAX_BY = f"""
    WITH {EVENTS}, s AS (SELECT event_id, user_id, cents // 1000 AS score FROM e),
    tops AS (
        SELECT *, max(score) OVER w AS max_score FROM s
        WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    ),
    firsts AS (SELECT user_id, score, min(event_id) AS first_id FROM s GROUP BY user_id, score)
    SELECT t.event_id, t.user_id, f.first_id AS max_event_id, t.max_score
    FROM tops t JOIN firsts f ON f.user_id = t.user_id AND f.score = t.max_score
"""

IDLE = f"""
    WITH {EVENTS}, n AS (
        SELECT user_id, time, row_number() OVER w AS count, lead(time) OVER w AS next_time
        FROM e WINDOW w AS (PARTITION BY user_id ORDER BY time, event_id)
    )
    SELECT user_id, time, count FROM n WHERE next_time IS NULL OR next_time - time > {SIX_HOURS}
"""

# Thirds of the events, the last one first; a row is late if it is not after the latest time of the thirds before less six hours.
PARTED = f"""
    {EVENTS},
    ends AS (SELECT min(event_id) AS low, max(event_id) AS high FROM e),
    thirds AS (
        SELECT e.*, CASE WHEN event_id >= low + 2 * (high - low) // 3 THEN 0
                         WHEN event_id < low + (high - low) // 3 THEN 1 ELSE 2 END AS third
        FROM e, ends
    ),
    latest AS (SELECT third, max(time) AS latest FROM thirds GROUP BY third),
    marks AS (
        SELECT third, max(latest) OVER (ORDER BY third ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {SIX_HOURS} AS mark
        FROM latest
    ),
    parted AS (SELECT t.*, CASE WHEN time <= mark THEN 1 ELSE 0 END AS is_late FROM thirds t JOIN marks USING (third))
"""

ECHO = f"WITH {EVENTS} SELECT DISTINCT user_id, time + {SIX_HOURS} AS fire_time FROM e"


PART_ITEMS = 10


def _segments(key: str) -> str:
    by = f"PARTITION BY {key} " if key else ""
    shown = f"{key}, " if key else ""
    return f"""
        WITH m AS (
            SELECT event_id, user_id, event_type,
                   count(*) FILTER (event_type = 'error') OVER ({by}ORDER BY event_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                   - CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS segment
            FROM events
        ), placed AS (
            SELECT *, bool_or(event_type = 'error') OVER (PARTITION BY {shown}segment) AS closed,
                   (row_number() OVER (PARTITION BY {shown}segment ORDER BY event_id) - 1) // {PART_ITEMS} AS part
            FROM m
        )
        SELECT {shown}CAST(segment AS BIGINT) AS segment, part, count(*) AS size,
               string_agg(' ' || event_type, '' ORDER BY event_id) AS text
        FROM placed WHERE closed AND event_type <> 'error' GROUP BY {shown}segment, part
    """


LAST_VALUE = """
    SELECT event_id, user_id, event_type,
           lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS previous
    FROM events
"""

LAST_VALUE_TTL = f"""
    WITH {EVENTS}, held AS (
        SELECT event_id, user_id, event_type, time, lag(event_type) OVER w AS held_type, lag(time) OVER w AS held_at
        FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id)
    )
    SELECT event_id, user_id, event_type, CASE WHEN time - held_at <= 100000 THEN held_type END AS previous FROM held
"""

WORD_COUNT = f"WITH {DOCUMENT_WORDS} SELECT word, count(*) AS n FROM words GROUP BY word"

CO_PROCESS = f"""
    WITH {EVENTS} SELECT 'CoUserTime(' || user_id || ',' || time || ')' AS value
    FROM e WHERE event_type IN ('click', 'purchase')
"""

WINDOW_PAIRS = f"""
    WITH {_windows(2)}
    SELECT user_id, window_no, min(event_id) AS first_id, string_agg(event_type, '' ORDER BY event_id) AS names,
           CAST(sum(cents) AS BIGINT) AS total
    FROM w GROUP BY user_id, window_no HAVING count(*) = 2
"""

ORACLE: dict[str, str] = {
    "sequence_source": """
        WITH b AS (SELECT min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders),
        s AS (SELECT unnest(range(low, high + 1)) AS v FROM b)
        SELECT s.v, o.o_orderpriority FROM s LEFT JOIN orders o ON o.o_orderkey = s.v
    """,
    "literal_rows": """
        SELECT e.event_type, score, count(*) AS n, CAST(sum(score) AS BIGINT) AS total_score
        FROM events e JOIN (VALUES ('view', 1), ('click', 2), ('signup', 3), ('purchase', 5), ('error', 0))
            AS s(event_type, score) ON s.event_type = e.event_type
        GROUP BY e.event_type, score
    """,
    "parallel_source_counts": """
        SELECT 'word' || (c_custkey + 1000) AS word, CAST(4 AS BIGINT) AS n, c_mktsegment FROM customer
    """,
    "kafka_decode": "SELECT text AS message, conv_id * 1000 + turn AS event_time FROM conversations",
    "map_pairs": "SELECT event_id, event_type AS word, 1 AS num FROM events",
    "tokenize": f"WITH {DOCUMENT_WORDS} SELECT doc_id, line_no, pos, word FROM words",
    "rich_flat_map": f"WITH {TURN_WORDS} SELECT word, 1 AS num FROM words",
    "map_vs_flatmap": """
        SELECT conv_id, turn, 'map' AS form, replace(text, ',', '|') AS value FROM conversations
        UNION ALL
        SELECT conv_id, turn, 'flat_map' AS form, unnest(string_split(text, ',')) AS value FROM conversations
    """,
    "filter_rows": "SELECT event_id, value FROM events WHERE value > 50",
    "project_positions": "SELECT user_id, event_type FROM events",
    "variant_rows": f"""
        WITH {TURN_WORDS}
        SELECT conv_id, turn, line_no, pos, CASE WHEN starts_with(word, 'th') THEN 'match' ELSE 'no_match' END AS kind,
               CAST(NULL AS VARCHAR) AS word, CAST(NULL AS INTEGER) AS num FROM words
        UNION ALL
        SELECT conv_id, turn, line_no, pos, 'count' AS kind, word, 1 AS num FROM words
    """,
    "variant_counts": f"""
        WITH {DOCUMENT_WORDS}
        SELECT CASE WHEN starts_with(word, 'th') THEN 'match' ELSE 'no_match' END AS kind, count(*) AS n
        FROM words GROUP BY 1
        UNION ALL
        SELECT 'count' AS kind, count(*) AS n FROM words
    """,
    "variant_running_totals": f"""
        WITH {DOCUMENT_WORDS},
        t AS (
            SELECT doc_id, line_no, pos, count(*) FILTER (starts_with(word, 'th')) OVER w AS m, count(*) OVER w AS n
            FROM words
            WINDOW w AS (ORDER BY doc_id, line_no, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        )
        SELECT doc_id, line_no, pos, 'match:' || m || ',noMatch:' || (n - m) AS totals FROM t
    """,
    "split_select": """
        SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS selection FROM events
        UNION ALL
        SELECT event_id, 'both' AS selection FROM events
    """,
    "iterate_countdown": """
        WITH RECURSIVE loop(p_partkey, v) AS (
            SELECT p_partkey, CAST(p_size AS BIGINT) FROM part
            UNION ALL
            SELECT p_partkey, v - 1 FROM loop WHERE v > 1
        )
        SELECT p_partkey, v FROM loop WHERE v > 0
    """,
    "keyed_running_sum": RUNNING_SUM,
    "sorted_partitions": """
        SELECT event_id, event_type, CAST(user_id % 4 AS INTEGER) AS partition,
               row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_type DESC, event_id) - 1 AS position
        FROM events
    """,
    "keyed_parallelism": "SELECT user_id, count(*) AS n, 1 AS partitions, 0 AS outside FROM events GROUP BY user_id",
    "mergeable_aggregate": f"""
        WITH {EVENTS}
        SELECT event_type, count(cents) AS n, CAST(sum(cents) AS BIGINT) AS total,
               CAST(abs(sum(cents)) // count(cents) * sign(sum(cents)) AS BIGINT) AS average, max(cents) - min(cents) AS width
        FROM e GROUP BY event_type
    """,
    "custom_partition": "SELECT event_id, CAST(user_id % 4 AS INTEGER) AS partition FROM events",
    "union_streams": """
        SELECT event_id, event_type FROM events WHERE event_type = 'click'
        UNION ALL SELECT event_id, event_type FROM events WHERE event_type = 'purchase'
        UNION ALL SELECT event_id, event_type FROM events WHERE event_type = 'click'
    """,
    "co_map": """
        SELECT CAST(event_id AS VARCHAR) AS value FROM events UNION ALL SELECT text AS value FROM conversations
    """,
    "co_flat_map": f"""
        WITH {TURN_WORDS}
        SELECT CAST(event_id AS VARCHAR) AS value FROM events UNION ALL SELECT word AS value FROM words
    """,
    "co_process": CO_PROCESS,
    "broadcast_enrich": f"""
        WITH {LATEST_PRIORITY} SELECT event_id, user_id, name FROM events JOIN config USING (user_id)
    """,
    "keyed_broadcast_enrich": f"""
        WITH {LATEST_PRIORITY}
        SELECT event_id, event_type, name || ',key:' || user_id AS described FROM events JOIN config USING (user_id)
    """,
    "broadcast_enrich_asof": AS_OF,
    "interval_join": _interval("<"),
    "interval_join_inclusive": _interval("<="),
    "session_join": f"WITH {SESSIONS} SELECT user_id, session_start, left_id, right_id, text FROM pairs",
    "session_join_per_element": f"""
        WITH {SESSIONS}
        SELECT user_id, session_start, left_id, right_id, text, complete AS arrival FROM pairs
    """,
    "session_cogroup": f"""
        WITH {SESSIONS}, g AS ({COGROUP}) SELECT user_id, session_start, n_left, n_right, {GROUP_TEXT} FROM g
    """,
    "session_cogroup_per_element": f"""
        WITH {SESSIONS}, g AS (
            SELECT event_id, user_id, session_start, count(*) FILTER (event_type = 'click') OVER s AS n_left,
                   count(*) FILTER (event_type = 'purchase') OVER s AS n_right
            FROM opened WINDOW s AS (PARTITION BY user_id, session_start ORDER BY time, event_id
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        )
        SELECT event_id, user_id, session_start, n_left, n_right FROM g
    """,
    "word_count": WORD_COUNT,
    "keyed_running_max_by": RUNNING_MAX_BY,
    "accumulator_count": f"WITH {TURN_WORDS} SELECT count(*) AS words FROM words",
    "count_window_reduce": WINDOW_PAIRS,
    "count_window_aggregate": f"""
        WITH {_windows(5)}
        SELECT user_id, window_no, string_agg(event_type || chr(9), '' ORDER BY event_id DESC) AS names,
               CAST(sum(cents) AS BIGINT) AS total
        FROM w GROUP BY user_id, window_no HAVING count(*) = 5
    """,
    "count_window_avg": COUNT_WINDOW_AVG,
    "count_window_process": COUNT_WINDOW_AVG,
    "count_window_all_reduce": f"""
        WITH {_windows(4, "")}
        SELECT window_no, min(event_id) AS first_id, string_agg(event_type, '' ORDER BY event_id) AS names,
               CAST(sum(cents) AS BIGINT) AS total
        FROM w GROUP BY window_no HAVING count(*) = 4
    """,
    "group_sorted_concat": f"""
        WITH placed AS (
            SELECT o_custkey, o_orderkey, min(o_orderkey) OVER (PARTITION BY o_custkey) AS least,
                   (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // {PART_ITEMS} AS part
            FROM orders
        )
        SELECT CAST(o_custkey AS VARCHAR) AS key, part, CAST(least AS VARCHAR) AS first,
               o_custkey || chr(9) || string_agg(CAST(o_orderkey AS VARCHAR), chr(9) ORDER BY o_orderkey) AS line
        FROM placed GROUP BY o_custkey, least, part
    """,
    "text_roundtrip": LINES.format(ids="doc_id", table="documents"),
    "custom_writer_roundtrip": "SELECT event_id, user_id, event_type FROM events",
    "labelled_output": "SELECT 'events> (' || event_type || ',' || event_id || ')' AS line FROM events",
    "idle_timeout_count": IDLE,
    "timer_echo": ECHO,
    "marker_segments": _segments("user_id"),
    "marker_segments_global": _segments(""),
    "last_value_state": LAST_VALUE,
    "poison_quarantine": """
        SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS quarantined FROM events
    """,
    "s_counter_source": "SELECT 'word' || c_custkey AS word, c_mktsegment FROM customer",
    "s_parallel_source": """
        SELECT 'word' || c_custkey AS word, CAST(subtask AS INTEGER) AS subtask, c_mktsegment
        FROM customer, unnest([0, 1, 2]) AS u(subtask)
    """,
    "s_lines_word_count": WORD_COUNT,
    "s_foreach_batch_sink": f"WITH {EVENTS} SELECT event_id, event_type, cents FROM e",
    "s_foreach_sink": "SELECT event_id, event_type FROM events",
    "s_co_process": CO_PROCESS,
    "s_broadcast_enrich": AS_OF,
    "s_interval_join": _interval("<"),
    "s_session_cogroup": f"WITH {SESSIONS} {COGROUP}",
    "s_bounded_lateness": f"""
        WITH {EVENTS},
        gaps AS (SELECT *, time - lag(time) OVER (PARTITION BY event_type ORDER BY time, event_id) AS gap FROM e),
        opened AS (
            SELECT event_type, last_value(CASE WHEN gap IS NULL OR gap > {HOUR} THEN time END IGNORE NULLS) OVER (
                PARTITION BY event_type ORDER BY time, event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_start
            FROM gaps
        )
        SELECT event_type AS message, session_start, count(*) AS n FROM opened GROUP BY event_type, session_start
    """,
    "s_idle_timeout_count": IDLE,
    "s_timer_echo": ECHO,
    "s_running_sum": RUNNING_SUM,
    "s_running_max_by": RUNNING_MAX_BY,
    "s_count_window": f"SELECT user_id, window_no, names, total FROM ({WINDOW_PAIRS})",
    "s_marker_segments": _segments("user_id"),
    "s_last_value_state": LAST_VALUE,
    "s_last_value_ttl": LAST_VALUE_TTL,
    "s_restart_recovery": _segments("user_id"),
    "s_late_rows": f"WITH {PARTED} SELECT event_id, user_id, is_late FROM parted",
    "s_on_time_idle_count": IDLE.replace("FROM e WINDOW", "FROM parted WHERE is_late = 0 WINDOW").replace(EVENTS, PARTED),
}
ORACLE |= {f"s_{name}": ORACLE[name] for name in ("session_join", "marker_segments_global")}
ORACLE["s_count_window_all"] = ORACLE["count_window_all_reduce"]
