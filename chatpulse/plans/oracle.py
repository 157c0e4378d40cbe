"""The catalog's queries as DuckDB SQL over the same tables."""

from __future__ import annotations

# Stated anew, not imported: a wrong entry in the engine must not be wrong here too.
_TOXIC_WORDS = ("idiot", "noob", "trash", "stupid", "hate")
# Unicode's White_Space characters and U+001C to U+001F, by code point.
_SPACES = (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
_WHITESPACE = "".join(map(chr, _SPACES))

_CHAT = """chat AS (
  SELECT CAST(user_id AS VARCHAR) AS "user", text AS message, ts AS "timestamp"
  FROM events LEFT JOIN documents ON event_id = doc_id)"""

# Letter classes instead of (?i): RE2 would also fold non-ASCII letters.
_ANY_CASE = "|".join(
    "".join(f"[{c.lower()}{c.upper()}]" for c in word) for word in _TOXIC_WORDS
)
_TOXIC = rf"regexp_matches(message, '\b({_ANY_CASE})\b')"
_TOKENS = (
    "string_split(regexp_replace(lower(message), '[^a-zA-Z0-9 ]', '', 'g'), ' ')"
)

_SPOKEN = "spoken AS (SELECT doc_id, text AS message FROM documents)"
_USERS = """u AS (
  SELECT CAST(user_id AS VARCHAR) AS "user", count(*) AS nb_messages
  FROM events WHERE user_id IS NOT NULL GROUP BY 1)"""
_WORDS = f"""w AS (
  SELECT word, count(*) AS count FROM (SELECT unnest({_TOKENS}) AS word FROM spoken)
  WHERE word <> '' GROUP BY word)"""


def _with(body: str, *tables: str) -> str:
    return "WITH " + ",\n".join((_CHAT, _SPOKEN, *tables)) + "\n" + body


_WINDOW = """time_bucket(INTERVAL '10 seconds', "timestamp")"""

_GLOBAL_ACTIVITY = _with(
    f"SELECT {_WINDOW} AS window_start, count(*) AS total_messages FROM chat GROUP BY 1"
)
_PER_MINUTE = _with(
    """SELECT date_trunc('minute', "timestamp") AS window_start, count(*) AS n FROM chat GROUP BY 1"""
)
_TOXIC_ACTIVITY = _with(
    f"SELECT {_WINDOW} AS window_start, count(*) AS total_toxic_messages "
    f"FROM chat WHERE {_TOXIC} GROUP BY 1"
)
_WINDOW_COUNTS = _with(
    f"SELECT {_WINDOW} AS window_start, count(*) AS total_messages, "
    f"count(*) FILTER (WHERE {_TOXIC}) AS total_toxic_messages FROM chat GROUP BY 1"
)
_USER_ACTIVITY = _with('SELECT "user", nb_messages FROM u', _USERS)
_TOXIC_USERS = _with(
    'SELECT "user", count(*) AS nb_toxic_messages FROM chat '
    f'WHERE "user" IS NOT NULL AND {_TOXIC} GROUP BY 1'
)
_STATS_ROWS = """SELECT 'total_messages' AS metric_name, CAST(coalesce(sum(nb_messages), 0) AS DOUBLE) AS value FROM u
UNION ALL
SELECT 'average_messages_per_user', coalesce(avg(nb_messages), 0.0) FROM u"""
_LONG_ROWS = """SELECT "user" AS key, nb_messages AS value, 'messages_per_user' AS metric FROM u
UNION ALL
SELECT word, count, 'top_words' FROM w"""
_TOP_WORDS = "SELECT word, count FROM w ORDER BY count DESC, word LIMIT 100"

# The chunks the ingest queries build, and the parse of their lines.
_CHUNK = """chunk AS (
  SELECT unnest(['PING :chat.host PRIVMSG #room :not a message',
    ':chat.host 001 :welcome' || chr(13) || chr(10) || ':' || "user" || '!' || "user"
    || '@chat.host PRIVMSG #room : ' || message || ' ' || chr(13) || chr(10)]) AS chunk
  FROM chat)"""
_PARSED = f"""{_CHUNK},
line AS (
  SELECT unnest(string_split(chunk, chr(13) || chr(10))) AS line
  FROM chunk WHERE NOT starts_with(chunk, 'PING')),
part AS (
  SELECT string_split(line, 'PRIVMSG')[1] AS prefix,
    substr(line, strpos(line, 'PRIVMSG') + 7) AS rest
  FROM line WHERE contains(line, 'PRIVMSG')),
parsed AS (
  SELECT substr(string_split(prefix, '!')[1], 2) AS "user",
    trim(substr(rest, strpos(rest, ':') + 1), '{_WHITESPACE}') AS message
  FROM part WHERE strpos(rest, ':') > 0)"""

_USER_COUNTS = _with(
    'SELECT "user", count(*) AS nb_messages, '
    f"count(*) FILTER (WHERE {_TOXIC}) AS nb_toxic_messages "
    'FROM chat WHERE "user" IS NOT NULL GROUP BY 1'
)


def _judged(watermark: str) -> tuple[str, ...]:
    """The messages of a topic in six parts, one a trigger, and whether they come too late."""
    return (
        f"""parts AS (SELECT CAST(floor(epoch("timestamp")) AS BIGINT) % 6 AS part, "user", "timestamp",
    coalesce({_TOXIC}, false) AS toxic
  FROM chat WHERE "timestamp" IS NOT NULL)""",
        # A trigger drops what ended before the watermark of the trigger before it,
        # which knows the files before that one.
        f"""marks AS (SELECT part, max(max("timestamp")) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING)
  - INTERVAL '{watermark}' AS mark FROM parts GROUP BY part)""",
        f"""judged AS (SELECT parts.*, coalesce({_WINDOW} + INTERVAL '10 seconds' <= mark, false) AS late
  FROM parts JOIN marks USING (part))""",
    )


ORACLE: dict[str, str] = {
    "total_messages": _with("SELECT count(*) AS total_messages FROM chat"),
    "global_activity": _GLOBAL_ACTIVITY,
    "messages_per_minute": _PER_MINUTE,
    "user_activity": _USER_ACTIVITY,
    "top_users": _with(
        'SELECT "user", nb_messages FROM u ORDER BY nb_messages DESC, "user" LIMIT 10', _USERS
    ),
    "toxic_flag": _with(f'SELECT "user", "timestamp", {_TOXIC} AS is_toxic FROM chat'),
    "toxic_messages": _with(f'SELECT "user", message, "timestamp" FROM chat WHERE {_TOXIC}'),
    "toxic_activity": _TOXIC_ACTIVITY,
    "toxic_users": _TOXIC_USERS,
    "window_counts": _WINDOW_COUNTS,
    "user_counts": _USER_COUNTS,
    "tokens": _with(
        f'SELECT * FROM (SELECT doc_id, unnest({_TOKENS}) AS word FROM spoken) '
        "WHERE word <> ''"
    ),
    "word_counts": _with("SELECT word, count FROM w", _WORDS),
    "top_words": _with(_TOP_WORDS, _WORDS),
    "avg_messages_per_user": _with(
        "SELECT coalesce(avg(nb_messages), 0.0) AS average_messages_per_user FROM u", _USERS
    ),
    "global_stats": _with(_STATS_ROWS, _USERS),
    "stats_long": _with(_LONG_ROWS, _USERS, _WORDS),
    "parse_chat_lines": _with('SELECT "user", message FROM parsed', _PARSED),
    "ingest_mixed_chunks": _with(
        """SELECT "user", n AS message, 'accepted' AS state FROM mixed WHERE last IN ('5', '8') OR last < '5'
UNION ALL SELECT NULL, 'PING :chat.host PRIVMSG #room :not a message', 'keep-alive' FROM mixed
UNION ALL SELECT NULL, 'PING :chat.host PRIVMSG #room :not a message', 'keep-alive' FROM mixed WHERE last = '5'
UNION ALL SELECT NULL, unnest([head, ':' || n]), 'cut' FROM mixed WHERE last = '5'
UNION ALL SELECT NULL, unnest([head || ':', 'PING ' || n]), 'cut' FROM mixed WHERE last = '6'
UNION ALL SELECT NULL, unnest([head || ':', n]), 'cut' FROM mixed WHERE last = '7'
UNION ALL SELECT NULL, unnest([head || ':' || n || chr(13), chr(10) || 'PING :chat.host PRIVMSG #room :not a message']), 'cut'
FROM mixed WHERE last = '8'
UNION ALL SELECT NULL, head || n, 'no text' FROM mixed WHERE last = '9'""",
        """mixed AS (SELECT "user", right("user", 1) AS last, CAST(length(message) AS VARCHAR) AS n,
  ':' || "user" || '!' || "user" || '@chat.host PRIVMSG #room ' AS head
  FROM chat WHERE "user" IS NOT NULL AND message IS NOT NULL)""",
    ),
    "stream_raw_lines": _with(
        """SELECT line, CASE WHEN starts_with(line, 'PING') THEN 'keep-alive' WHEN NOT contains(line, 'PRIVMSG') THEN 'other'
  WHEN strpos(substr(line, strpos(line, 'PRIVMSG') + 7), ':') = 0 THEN 'no text' ELSE 'message' END AS kind
FROM lines WHERE line <> ''""",
        _CHUNK,
        "lines AS (SELECT unnest(string_split(chunk, chr(13) || chr(10))) AS line FROM chunk)",
    ),
    "ingest_rejects": _with(
        """SELECT outcome, n AS n_observed, n AS n_stored, CAST(sum(n) OVER () AS BIGINT) AS n_lines FROM (
  SELECT 'accepted' AS outcome, count(*) FILTER (WHERE message IS NOT NULL AND "user" NOT LIKE '%7') AS n FROM chat
  UNION ALL SELECT 'rejected', count(*) FILTER (WHERE message IS NOT NULL AND "user" LIKE '%7') FROM chat
  UNION ALL SELECT 'other', count(*) FROM chat)"""
    ),
    "ingest_to_topic": _with(
        'SELECT "user", message, CAST(NULL AS VARCHAR) AS "timestamp" FROM parsed', _PARSED
    ),
    "payload_encode": _with('SELECT "user", message FROM chat'),
    "payload_decode": _with(
        'SELECT "user", message, CAST(NULL AS VARCHAR) AS "timestamp" FROM chat'
    ),
    "payload_foreign": '''
        SELECT CAST(user_id AS VARCHAR) AS "user",
          CASE WHEN user_id % 2 = 0 THEN '{"id":' || user_id || ',"tags":["a",1.5,null]}'
            ELSE 'tab' || chr(9) || 'quote"slash/ ' || chr(233) || chr(128512) || ' ' || user_id END AS message,
          CASE WHEN user_id % 2 = 0 THEN '2024-01-01T00:00:00' END AS "timestamp"
        FROM events WHERE user_id IS NOT NULL''',
    "payload_quarantine": _with(
        """SELECT "user" LIKE '%7' AS is_malformed, count(*) AS n FROM chat GROUP BY 1"""
    ),
    "archive_roundtrip": _with('SELECT "user", message, "timestamp" FROM chat'),
    "upsert_latest": _with(
        'SELECT "user", CASE WHEN nb_messages > 66 THEN nb_messages * 10 '
        "ELSE nb_messages END AS nb_messages FROM u",
        _USERS,
    ),
    "batch_job": _with(
        """SELECT 'top_users' AS table_name, "user" AS key, CAST(nb_messages AS DOUBLE) AS value FROM u
UNION ALL SELECT 'top_words', word, CAST(count AS DOUBLE) FROM t
UNION ALL SELECT 'global_stats', metric_name, value FROM s""",
        _USERS, _WORDS, f"t AS ({_TOP_WORDS})", f"s AS ({_STATS_ROWS})",
    ),
    "metric_log": _with(
        """SELECT "user" AS key, count(*) AS value, 'messages_per_user' AS metric, run, run_time AS "timestamp"
FROM logged WHERE "user" IS NOT NULL GROUP BY ALL
UNION ALL SELECT word, count(*), 'top_words', run, run_time FROM said WHERE word <> '' GROUP BY ALL""",
        """logged AS (SELECT chat.*, run, run_time FROM chat JOIN (VALUES
  (1, TIMESTAMP '2024-02-01 00:00:00'), (2, TIMESTAMP '2024-02-02 00:00:00')) AS runs(run, run_time)
  ON run = 2 OR regexp_matches("user", '[0-4]$'))""",
        f"said AS (SELECT unnest({_TOKENS}) AS word, run, run_time FROM logged)",
    ),
    "user_counts_int": _with(
        'SELECT "user", CAST(count(*) AS INTEGER) AS nb_messages, '
        f"CAST(count(*) FILTER (WHERE {_TOXIC}) AS INTEGER) AS nb_toxic_messages "
        'FROM chat WHERE "user" IS NOT NULL GROUP BY 1'
    ),
    "batch_rerun_empty": _with(
        """SELECT metric_name, value, 0 AS run FROM s
UNION ALL SELECT 'users', CAST(count(*) AS DOUBLE), 0 FROM u
UNION ALL SELECT unnest(['total_messages', 'average_messages_per_user', 'users']), 0.0, 1""",
        _USERS, f"s AS ({_STATS_ROWS})",
    ),
    "stream_windows_in_triggers": _WINDOW_COUNTS,
    "stream_late_rows": _with(
        """SELECT count(*) FILTER (WHERE NOT late) AS n_counted, count(*) FILTER (WHERE late) AS n_late FROM judged""",
        *_judged("10 seconds"),
    ),
    "stream_late_messages": _with(
        f"""SELECT 'late' AS state, "user", "timestamp", CAST(1 AS BIGINT) AS n, CAST(toxic AS BIGINT) AS n_toxic FROM judged WHERE late
UNION ALL SELECT 'counted', NULL, {_WINDOW}, count(*), count(*) FILTER (WHERE toxic) FROM judged WHERE NOT late GROUP BY 3""",
        *_judged("10 seconds"),
    ),
    "stream_restart": _USER_COUNTS,
    # After the last trigger the windows that ended before its watermark are gone.
    "stream_state_rows": _with(
        f"""SELECT window_start, total_messages, total_toxic_messages FROM (
  SELECT {_WINDOW} AS window_start, count(*) AS total_messages, count(*) FILTER (WHERE toxic) AS total_toxic_messages
  FROM judged WHERE NOT late GROUP BY 1)
WHERE window_start + INTERVAL '10 seconds' > (SELECT max("timestamp") - INTERVAL '10 days' FROM judged)""",
        *_judged("10 days"),
    ),
    "stream_complete_ranking": _with(
        """SELECT "user", count(*) AS nb_messages FROM chat WHERE "user" IS NOT NULL AND "timestamp" IS NOT NULL GROUP BY 1"""
    ),
    "archive_incremental": _with(
        """SELECT 0 AS run, early AS n_read, early AS n_history FROM n UNION ALL SELECT 1, n - early, n FROM n
UNION ALL SELECT 2, 0, n FROM n""",
        """n AS (SELECT count(*) AS n, count(*) FILTER (WHERE regexp_matches("user", '[0-4]$')) AS early FROM chat)""",
    ),
    "archive_if_absent": _with(
        """SELECT run, count(*) AS n_history, count("user") AS n_users, count("timestamp") AS n_timed
FROM chat JOIN (VALUES (0), (1), (2)) AS runs(run) ON run = 2 OR regexp_matches("user", '[0-4]$') GROUP BY run"""
    ),
    "stream_processing_time": _with(
        f"""SELECT count(*) AS total_messages, count(*) FILTER (WHERE {_TOXIC}) AS total_toxic_messages,
  true AS is_one_time_a_trigger, true AS is_aligned, CAST(0 AS BIGINT) AS n_late FROM chat WHERE "timestamp" IS NOT NULL"""
    ),
    "stream_supervised": _with(
        f"""SELECT 'windows' AS table_name, strftime({_WINDOW}, '%Y-%m-%d %H:%M:%S') AS key, count(*) AS n,
  count(*) FILTER (WHERE {_TOXIC}) AS n_toxic FROM chat WHERE "timestamp" IS NOT NULL GROUP BY 2
UNION ALL SELECT 'users', "user", count(*), count(*) FILTER (WHERE {_TOXIC}) FROM chat WHERE "user" IS NOT NULL GROUP BY 2
UNION ALL SELECT 'untimed', NULL, count(*), NULL FROM chat WHERE "timestamp" IS NULL"""
    ),
    "batch_preview": _with(
        f"""SELECT * FROM (SELECT 'top_users' AS shown, "user" AS key, CAST(nb_messages AS DOUBLE) AS value FROM u
  ORDER BY nb_messages DESC, "user" LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'top_words', word, CAST(count AS DOUBLE) FROM w ORDER BY count DESC, word LIMIT 10)
UNION ALL SELECT 'global_stats', metric_name, value FROM s""",
        _USERS, _WORDS, f"s AS ({_STATS_ROWS})",
    ),
    "declared_tables": _with(
        f"""SELECT 'user_activity' AS table_name, "user" AS key, nb_messages AS n FROM u
UNION ALL SELECT 'window_activity', strftime({_WINDOW}, '%Y-%m-%d %H:%M:%S'), count(*) FROM chat WHERE "timestamp" IS NOT NULL
GROUP BY 2""",
        _USERS,
    ),
    "archive_quarantine": _with(
        """SELECT coalesce("user" LIKE '%7', false) AS is_rejected, count(*) AS n FROM chat GROUP BY 1"""
    ),
    "stream_global_activity": _GLOBAL_ACTIVITY,
    "stream_messages_per_minute": _PER_MINUTE,
    "stream_toxic_activity": _TOXIC_ACTIVITY,
    "stream_user_activity": _USER_ACTIVITY,
    "stream_toxic_users": _TOXIC_USERS,
    "stream_user_ranking": _USER_ACTIVITY,
    "stream_toxic_user_ranking": _TOXIC_USERS,
    "stream_archive": _with('SELECT "user", message FROM chat'),
}
