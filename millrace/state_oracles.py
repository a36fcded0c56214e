"""SQL checks of `millrace.state_catalogue`, computed from `events` alone."""

from __future__ import annotations

from millrace.oracles import _E, _FULL, _FULL_ROWS, _PASS, ORACLES as _BASE
from millrace.state_catalogue import IDLE_MINUTES, LATE_EVERY, LATENESS_DAYS, TITLES_ENDING

_SESSIONS = f"""
gaps AS (
  SELECT "partition", ts, coalesce(ts - lag(ts) OVER part > INTERVAL {IDLE_MINUTES} MINUTE, true) AS begins
  FROM e WINDOW part AS (PARTITION BY "partition" ORDER BY ts)
), numbered AS (SELECT *, count(*) FILTER (begins) OVER (PARTITION BY "partition" ORDER BY ts) AS nth FROM gaps)
, sessions AS (
  SELECT 'input' AS topic, "partition", min(ts) AS first_timestamp, max(ts) AS last_timestamp, count(*) AS n_records
  FROM numbered GROUP BY "partition", nth
)"""
_VERSIONS = """
v AS (
  SELECT DISTINCT domain, day + INTERVAL 6 HOUR AS valid_from, CASE WHEN dayofmonth(day) % 2 = 0 THEN day + INTERVAL 24 HOUR END AS valid_to
  FROM e WHERE dayofyear(day) % 3 <> length(domain) % 3
), on_list AS (
  SELECT e.* FROM e ASOF JOIN v ON e.domain = v.domain AND e.ts >= v.valid_from
  WHERE NOT cut AND (v.valid_to IS NULL OR e.ts < v.valid_to)
)"""
# the watermark is held in milliseconds
_MARK = "date_trunc('milliseconds', (max(ts){})) - INTERVAL {}"

_FIELDS = {
    "meta": "OBJECT",
    "meta.id": "STRING",
    "meta.dt": "STRING",
    "meta.domain": "STRING",
    "performer": "OBJECT",
    "performer.user_text": "STRING",
    "performer.user_is_bot": "BOOLEAN",
    "page_title": "STRING",
}
_DRIFT = " UNION ALL ".join(
    f"""SELECT domain, day, '{field}' AS field, '{kind}' AS type, count(*) AS n FROM e
WHERE NOT cut{" AND is_bot IS NOT NULL" if kind == "BOOLEAN" else ""} GROUP BY domain, day"""
    for field, kind in _FIELDS.items()
)

ORACLES: dict[str, str] = _BASE | {
    "stream_throughput_late": f"""WITH {_E}
, w AS (SELECT {_MARK.format(f" FILTER (event_id % {LATE_EVERY} <> 0)", f"{LATENESS_DAYS} DAY")} AS mark FROM e)
, told AS (
  SELECT date_trunc('hour', ts)::TIMESTAMP AS window_start,
         event_id % {LATE_EVERY} = 0 AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark AS late
  FROM e, w
)
SELECT 'input' AS topic, window_start, count(*) FILTER (NOT late) AS n_records, count(*) FILTER (late) AS n_late
FROM told GROUP BY window_start""",
    "stream_throughput_closed": f"""WITH {_E}, w AS (SELECT {_MARK.format("", "1 HOUR")} AS mark FROM e)
SELECT 'input' AS topic, date_trunc('hour', ts)::TIMESTAMP AS window_start, count(*) AS n_records FROM e, w
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark GROUP BY ALL""",
    "topic_idle": f"""WITH {_E}, {_SESSIONS}
SELECT *, (epoch_us(first_timestamp) - epoch_us(lag(last_timestamp) OVER (PARTITION BY "partition" ORDER BY first_timestamp)))
  / 1000000::DOUBLE AS idle_seconds
FROM sessions""",
    "stream_sessions": f"""WITH {_E}, {_SESSIONS}, w AS (SELECT {_MARK.format("", "1 HOUR")} AS mark FROM e)
SELECT sessions.* FROM sessions, w WHERE last_timestamp + INTERVAL {IDLE_MINUTES} MINUTE <= mark""",
    "topic_unique": f"""WITH {_E}, {_PASS}
SELECT DISTINCT "partition", "offset", ts AS "timestamp", user_text AS user_id, domain, dt AS created_at, title AS page_title
FROM passed""",
    "edits_changes": _FULL_ROWS,
    "filter_domain_as_of": f"""WITH {_E}, {_VERSIONS} SELECT "partition", "offset", domain FROM on_list""",
    "stream_filter_as_of": f"""WITH {_E}, {_VERSIONS}
SELECT "partition", "offset", user_text AS user_id, domain, dt AS created_at, title AS page_title
FROM on_list WHERE is_bot = false""",
    "lookup_titles": _FULL + f"SELECT * FROM cur WHERE page_title IN (SELECT title FROM e WHERE ends_with(title, '{TITLES_ENDING}'))",
    "lookup_keys": _FULL
    + """SELECT * FROM cur WHERE (domain, created_at, user_id) IN (
  SELECT (domain, day, user_text) FROM e WHERE floor(amount)::BIGINT % 7 = 0 AND dayofmonth(day) <= 9)""",
    "field_drift": f"WITH {_E} {_DRIFT}",
    "schema_drift": f"""WITH {_E}
SELECT domain, day, count(*) AS n_events,
       'OBJECT<meta: OBJECT<domain: STRING, dt: STRING, id: STRING>, page_title: STRING, performer: OBJECT<'
         || CASE WHEN count(is_bot) > 0 THEN 'user_is_bot: BOOLEAN, ' ELSE '' END || 'user_text: STRING>>' AS "schema"
FROM e WHERE NOT cut GROUP BY domain, day""",
    "feed_source": _BASE["feed_decode"],
    "stream_feed_source": _BASE["feed_decode"],
    "variant_events": _BASE["decode_raw_events"],
    "lookup_user_zordered": _BASE["lookup_user"],
}
