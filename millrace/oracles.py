"""The same results in SQL, computed from `events` alone.

Written without the topic, its JSON text or any decoding: what a record says is known from the rules
it was made by (FIXTURES.md). Only where the text itself is the result is it put together here.
"""

from __future__ import annotations

from millrace.catalogue import (
    CONSUMED_UNTIL,
    EVENT_ID,
    HEAD_ROWS,
    LOOKUP,
    LOOKUP_TITLE,
    LOOKUP_USER,
    NOW,
    STARTING_OFFSETS,
    TIMELINE_BEFORE,
    TIMELINE_DOMAIN,
    TRUNCATED_AT,
)

_E = """
e AS (
  SELECT event_id, ts, k, value AS amount, date_trunc('day', ts)::TIMESTAMP AS day,
         (event_id % 4)::INTEGER AS "partition", (event_id // 4)::BIGINT AS "offset",
         CASE event_type WHEN 'click' THEN 'en.wikipedia.org' WHEN 'view' THEN 'www.wikidata.org'
              WHEN 'purchase' THEN 'commons.wikimedia.org' WHEN 'signup' THEN 'de.wikipedia.org'
              WHEN 'error' THEN 'uk.wikipedia.org' END AS domain,
         'user_' || user_id AS user_text,
         CASE WHEN k % 10 <> 0 THEN k % 4 = 0 END AS is_bot,
         'Page_' || k AS title,
         strftime(date_trunc('day', ts), '%Y-%m-%dT%H:%M:%SZ') AS dt,
         event_id % 97 = 0 AS cut
  FROM (SELECT *, (props->>'$.k')::INTEGER AS k FROM events)
)"""

# what the filter job lets through
_PASS = """
passed AS (
  SELECT * FROM e
  WHERE NOT cut AND is_bot = false
    AND domain IN ('en.wikipedia.org', 'www.wikidata.org', 'commons.wikimedia.org')
)"""

# the uneven processed topic, decoded
_UNEVEN = """
u AS (
  SELECT event_id, ts, "partition", "offset", cut OR event_id % 101 = 5 AS unreadable,
         CASE WHEN NOT unreadable THEN user_text END AS user_id,
         CASE WHEN NOT unreadable THEN CASE WHEN event_id % 79 = 3 THEN '' ELSE domain END END AS domain,
         CASE WHEN NOT unreadable THEN CASE event_id % 89 WHEN 1 THEN '12:30:00' WHEN 2 THEN 'not a time'
              WHEN 6 THEN '12345-01-01T00:00:00Z' WHEN 7 THEN '0000-01-01T00:00:00Z' ELSE dt END END AS created_at,
         CASE WHEN NOT unreadable AND event_id % 83 <> 4 THEN title END AS page_title,
         CASE WHEN unreadable THEN 'bad_json' WHEN event_id % 83 = 4 THEN 'incomplete'
              WHEN event_id % 89 IN (1, 2, 6, 7) THEN 'bad_timestamp'
              WHEN event_id % 79 = 3 THEN 'empty_domain' ELSE 'passed' END AS outcome,
         day,
         '{"user_id":"' || user_text || '","domain":"' || CASE WHEN event_id % 79 = 3 THEN '' ELSE domain END
           || '","created_at":"' || CASE event_id % 89 WHEN 1 THEN '12:30:00' WHEN 2 THEN 'not a time'
                WHEN 6 THEN '12345-01-01T00:00:00Z' WHEN 7 THEN '0000-01-01T00:00:00Z' ELSE dt END || '"'
           || CASE WHEN event_id % 83 <> 4 THEN ',"page_title":"' || title || '"' ELSE '' END || '}' AS whole,
         CASE WHEN cut THEN whole[1:20] WHEN event_id % 101 = 5 THEN '[]' ELSE whole END AS raw
  FROM e
)"""

_RAW_JSON = """'{"meta":{"id":"' || event_id || '","dt":"' || dt || '","domain":"' || domain
           || '"},"performer":{"user_text":"' || user_text || '"'
           || CASE WHEN is_bot IS NULL THEN '' ELSE ',"user_is_bot":' || is_bot END
           || '},"page_title":"' || title || '"}'"""

# All writes with their place in the order of writes. `written`, `partition` and `offset` never tie
# between two upserts.
_WRITES = """
writes AS (
  SELECT domain, day AS created_at, user_text AS user_id, title AS page_title, NULL::BOOLEAN AS user_is_bot,
         ts AS written, "partition", "offset"
  FROM passed
  {flags}
)"""
_FLAGS = """
  UNION ALL
  SELECT domain, day, user_text, CASE WHEN event_id % 2 = 1 THEN 'Flag_' || k END, is_bot,
         ts + INTERVAL 12 HOUR, "partition", "offset"
  FROM e
  WHERE domain IN ('en.wikipedia.org', 'www.wikidata.org', 'commons.wikimedia.org')
"""


def _merged(flags: bool, deletes: bool, since: str | None = None) -> str:
    """WITH clause up to a view `cur` of current rows, by ranking writes one by one."""
    later = f"WHERE written > TIMESTAMP '{since}'" if since else ""
    deleted = """
, gone AS (
  SELECT domain, day AS created_at, user_text AS user_id, ts + INTERVAL 12 HOUR AS written, "partition", "offset"
  FROM e WHERE amount < 5.0
), kept AS (
  SELECT w.* FROM writes w WHERE NOT EXISTS (
    SELECT 1 FROM gone g WHERE g.domain = w.domain AND g.created_at = w.created_at AND g.user_id = w.user_id
      AND (g.written, g."partition", g."offset") >= (w.written, w."partition", w."offset"))
)"""
    kept = deleted if deletes else ", kept AS (SELECT * FROM writes)"
    ranked = """
SELECT domain, created_at, user_id, {cell}, row_number() OVER (
         PARTITION BY domain, created_at, user_id ORDER BY written DESC, "partition" DESC, "offset" DESC) AS nth
  FROM alive WHERE {cell} IS NOT NULL"""
    return f"""WITH {_E}, {_PASS}, {_WRITES.format(flags=_FLAGS if flags else "")}{kept}
, alive AS (SELECT * FROM kept {later})
, titles AS ({ranked.format(cell="page_title")})
, bots AS ({ranked.format(cell="user_is_bot")})
, cur AS (
  SELECT k.user_id, k.domain, t.page_title, k.created_at, b.user_is_bot
  FROM (SELECT DISTINCT domain, created_at, user_id FROM alive) k
  LEFT JOIN titles t ON t.nth = 1 AND t.domain = k.domain AND t.created_at = k.created_at AND t.user_id = k.user_id
  LEFT JOIN bots b ON b.nth = 1 AND b.domain = k.domain AND b.created_at = k.created_at AND b.user_id = k.user_id
)
"""


_EDITS = _merged(False, False) + "SELECT user_id, domain, created_at, page_title FROM cur"
_FULL = _merged(True, True)
_FILTERED = f'WITH {_E}, {_PASS} SELECT user_text AS user_id, domain, dt AS created_at, title AS page_title FROM passed'
_LEGACY = f"""WITH {_E}, h AS (SELECT *, md5(event_id::VARCHAR) AS x FROM e)
SELECT x[1:8] || '-' || x[9:12] || '-' || x[13:16] || '-' || x[17:20] || '-' || x[21:32] AS id,
       title AS page_title, user_text, day AS dt
FROM h WHERE NOT cut AND event_id % 5 <> 4"""
_FULL_ROWS = _FULL + "SELECT * FROM cur"
_FROM = " OR ".join(f'("partition" = {p} AND "offset" >= {first})' for p, first in STARTING_OFFSETS.items())

ORACLES: dict[str, str] = {
    "topic_scan": f"""WITH {_E}
SELECT 'input' AS topic, "partition", count(*) AS n_records, min("offset") AS first_offset, max("offset") AS last_offset
FROM e GROUP BY "partition" """,
    "topic_from_offsets": f"""WITH {_E}
SELECT 'input' AS topic, "partition", "offset", ts AS "timestamp",
       CASE WHEN cut THEN ({_RAW_JSON})[1:20] ELSE {_RAW_JSON} END AS value
FROM e WHERE {_FROM}""",
    "decode_raw_events": f"""WITH {_E}
SELECT "partition", "offset", CASE WHEN NOT cut THEN event_id::VARCHAR END AS meta_id,
       CASE WHEN NOT cut THEN dt END AS meta_dt, CASE WHEN NOT cut THEN domain END AS meta_domain,
       CASE WHEN NOT cut THEN user_text END AS user_text, CASE WHEN NOT cut THEN is_bot END AS user_is_bot,
       CASE WHEN NOT cut THEN title END AS page_title
FROM e""",
    "json_validity": f"""WITH {_E}
SELECT "partition", "offset", NOT cut AS is_json, NOT cut AS is_object, CASE WHEN NOT cut THEN title END AS page_title
FROM e""",
    "rejects": f"""WITH {_E}, {_UNEVEN}
SELECT 'input' AS topic, "partition", "offset", ts AS "timestamp", ({_RAW_JSON})[1:20] AS raw, 'bad_json' AS reason
FROM e WHERE cut
UNION ALL
SELECT 'processed', "partition", "offset", ts, raw, outcome FROM u WHERE outcome <> 'passed'""",
    "filter_domain": f"""WITH {_E}
SELECT "partition", "offset", domain FROM e
WHERE NOT cut AND domain IN ('en.wikipedia.org', 'www.wikidata.org', 'commons.wikimedia.org')""",
    "filter_domain_list": f"""WITH {_E}
SELECT "partition", "offset", domain FROM e
WHERE NOT cut AND domain IN (SELECT domain FROM e WHERE is_bot IS NULL AND day = DATE '2024-01-01')""",
    "filter_human": f"""WITH {_E}
SELECT "partition", "offset", user_text, is_bot AS user_is_bot FROM e WHERE NOT cut AND is_bot = false""",
    "filter_edits": _FILTERED,
    "find_event": f"""WITH {_E}
SELECT "partition", "offset", event_id::VARCHAR AS meta_id, domain, title AS page_title
FROM e WHERE NOT cut AND event_id = {EVENT_ID}""",
    "encode_processed": f"""WITH {_E}, {_PASS}
SELECT 'processed' AS topic, "partition", "offset", ts AS "timestamp",
       '{{"domain":"' || domain || '","created_at":"' || dt || '","user_id":"' || user_text || '"}}' AS "key",
       '{{"user_id":"' || user_text || '","domain":"' || domain || '","created_at":"' || dt
         || '","page_title":"' || title || '"}}' AS value
FROM passed""",
    "decode_processed_events": f"""WITH {_E}, {_UNEVEN}
SELECT "partition", "offset", user_id, domain, created_at, page_title FROM u""",
    "edits_clean": f"""WITH {_E}, {_UNEVEN}
SELECT "partition", "offset", user_id, domain, day AS created_at, page_title FROM u WHERE outcome = 'passed'""",
    "edits_current": _EDITS,
    "edits_cell_merge": _merged(True, False) + "SELECT * FROM cur",
    "edits_delete": _FULL_ROWS,
    "edits_truncate": _merged(True, True, str(TRUNCATED_AT)) + "SELECT * FROM cur",
    "edits_count": _FULL + "SELECT count(*) AS n_rows FROM cur",
    "edits_key_check": _FULL
    + """SELECT count(*) AS n_rows, count(DISTINCT (domain, created_at, user_id)) AS n_keys,
       0::BIGINT AS n_repeated_keys, 0::BIGINT AS n_null_keys FROM cur""",
    "edits_layout": _FULL
    + "SELECT domain, created_at::DATE::VARCHAR AS d, count(*) AS n_rows, 0::BIGINT AS n_unordered FROM cur GROUP BY ALL",
    "count_compacted": _FULL + "SELECT count(*) AS n_rows FROM cur",
    "table_truncated": _merged(True, False)
    + """, flags AS (SELECT domain, day AS created_at, user_text AS user_id, event_id, k, is_bot, ts, "partition", "offset"
  FROM e WHERE domain IN ('en.wikipedia.org', 'www.wikidata.org', 'commons.wikimedia.org'))
SELECT domain, created_at, user_id,
       arg_max('Flag_' || k, (ts, "partition", "offset")) FILTER (event_id % 2 = 1) AS page_title,
       arg_max(is_bot, (ts, "partition", "offset")) FILTER (is_bot IS NOT NULL) AS user_is_bot
FROM flags GROUP BY ALL""",
    "edits_stored": _FULL_ROWS,
    "edits_compacted": _FULL_ROWS,
    "lookup_key": _merged(True, False)
    + f"""SELECT * FROM cur WHERE domain = '{LOOKUP["domain"]}' AND created_at = TIMESTAMP '{LOOKUP["created_at"]}'
  AND user_id = '{LOOKUP["user_id"]}'""",
    "lookup_user": _FULL + f"SELECT * FROM cur WHERE user_id = '{LOOKUP_USER}'",
    "lookup_title": _FULL + f"SELECT * FROM cur WHERE page_title = '{LOOKUP_TITLE}'",
    "lookup_title_compacted": _FULL + f"SELECT * FROM cur WHERE page_title = '{LOOKUP_TITLE}'",
    "domain_timeline": _FULL
    + f"""SELECT *, row_number() OVER (ORDER BY created_at DESC, user_id) AS position FROM cur
WHERE domain = '{TIMELINE_DOMAIN}' AND created_at < TIMESTAMP '{TIMELINE_BEFORE}'""",
    "edits_head": _FULL
    + f"""SELECT *, row_number() OVER (ORDER BY domain, created_at DESC, user_id) AS position FROM cur
QUALIFY position <= {HEAD_ROWS}""",
    "topic_throughput": f"""WITH {_E}, {_PASS}
SELECT 'input' AS topic, date_trunc('hour', ts)::TIMESTAMP AS window_start, count(*) AS n_records FROM e GROUP BY ALL
UNION ALL
SELECT 'processed', date_trunc('hour', ts)::TIMESTAMP, count(*) FROM passed GROUP BY ALL""",
    "topic_freshness": f"""WITH {_E}
SELECT 'input' AS topic, "partition", max(ts) AS last_timestamp,
       (epoch_us(TIMESTAMP '{NOW}') - epoch_us(max(ts))) / 1000000::DOUBLE AS idle_seconds
FROM e GROUP BY "partition" """,
    "consumer_lag": f"""WITH {_E}
SELECT 'input' AS topic, "partition", max("offset") + 1 AS end_offset,
       coalesce(max("offset") FILTER (ts < TIMESTAMP '{CONSUMED_UNTIL}' AND "partition" <> 3) + 1, min("offset"))
         AS next_offset,
       end_offset - next_offset AS lag
FROM e GROUP BY "partition" """,
    "stage_counts": f"""WITH {_E}, {_UNEVEN}
SELECT 'filter' AS stage,
       CASE WHEN cut THEN 'bad_json'
            WHEN domain NOT IN ('en.wikipedia.org', 'www.wikidata.org', 'commons.wikimedia.org') THEN 'other_domain'
            WHEN is_bot IS NULL OR is_bot THEN 'not_human' ELSE 'passed' END AS outcome,
       count(*) AS n
FROM e GROUP BY ALL
UNION ALL
SELECT 'writer', outcome, count(*) FROM u GROUP BY ALL""",
    "feed_decode": f"""WITH {_E}, w AS (SELECT event_id, cut, {_RAW_JSON} AS whole FROM e)
SELECT CASE WHEN event_id % 7 = 0 THEN replace(whole, '{{"meta":', '{{"meta":' || chr(10)) ELSE whole END AS value
FROM w WHERE NOT cut AND event_id % 11 <> 0""",
    "feed_rejects": f"""WITH {_E}, w AS (SELECT event_id, cut, {_RAW_JSON} AS whole FROM e)
SELECT CASE WHEN event_id % 7 = 0 THEN replace(whole[1:20], '{{"meta":', '{{"meta":' || chr(10)) ELSE whole[1:20] END AS raw,
       'bad_json' AS reason
FROM w WHERE cut AND event_id % 11 <> 0""",
    "uuid_normalize": """WITH h AS (SELECT event_id, md5(event_id::VARCHAR) AS x FROM events),
d AS (SELECT *, x[1:8] || '-' || x[9:12] || '-' || x[13:16] || '-' || x[17:20] || '-' || x[21:32] AS dashed FROM h)
SELECT event_id,
       CASE event_id % 5 WHEN 0 THEN x WHEN 1 THEN upper(dashed) WHEN 2 THEN '{' || dashed || '}'
            WHEN 3 THEN 'urn:uuid:' || dashed ELSE x[1:31] END AS given,
       CASE WHEN event_id % 5 <> 4 THEN dashed END AS uuid
FROM d""",
    "legacy_flatten": f"""WITH {_E}
SELECT "partition", "offset", CASE WHEN NOT cut THEN event_id::VARCHAR END AS id, CASE WHEN NOT cut THEN title END AS page_title,
       CASE WHEN NOT cut THEN user_text END AS user_text, CASE WHEN NOT cut THEN dt END AS dt
FROM e""",
    "legacy_normalize": _LEGACY,
    "stream_legacy": _LEGACY,
    "stream_filter": _FILTERED,
    "stream_edits": _EDITS,
    "replay_idempotent": _EDITS,
    "replay_other_boundaries": _EDITS,
    "replay_after_compaction": _EDITS,
    "feed_to_table": f"""WITH {_E}, {_PASS}
SELECT domain, day AS created_at, user_text AS user_id, arg_max(title, event_id) AS page_title
FROM passed WHERE event_id % 11 <> 0 GROUP BY ALL""",
    "feed_lag": f"""WITH {_E}
SELECT 'input' AS topic, count(*) AS n_records, count(*) FILTER (event_id >= 0) AS n_ends, 0::BIGINT AS n_repeated,
       count(*) AS lag
FROM e WHERE NOT cut AND event_id % 11 <> 0""",
    "feed_stream_counts": f"""WITH {_E}
SELECT count(*) AS n_read, count(*) FILTER (NOT cut) AS sent, count(*) FILTER (cut) AS bad_json
FROM e WHERE event_id % 11 <> 0""",
    "stream_filter_rejects": f"""WITH {_E}
SELECT 'input' AS topic, "partition", "offset", ts AS "timestamp", ({_RAW_JSON})[1:20] AS raw, 'bad_json' AS reason
FROM e WHERE cut""",
    "stream_rejects": f"""WITH {_E}, {_UNEVEN}
SELECT 'processed' AS topic, "partition", "offset", ts AS "timestamp", raw, outcome AS reason
FROM u WHERE outcome <> 'passed'""",
    "stream_counts": f"""WITH {_E}, {_UNEVEN}
SELECT count(*) AS n_read, count(*) FILTER (outcome = 'bad_json') AS bad_json,
       count(*) FILTER (outcome = 'incomplete') AS incomplete, count(*) FILTER (outcome = 'bad_timestamp') AS bad_timestamp,
       count(*) FILTER (outcome = 'empty_domain') AS empty_domain, count(*) FILTER (outcome = 'passed') AS passed
FROM u""",
    "stream_lag": f"""WITH {_E}
SELECT 'processed' AS topic, "partition", max("offset") + 1 AS end_offset,
       coalesce(max("offset") FILTER (ts < TIMESTAMP '{CONSUMED_UNTIL}') + 1, min("offset")) AS next_offset,
       end_offset - next_offset AS lag
FROM e GROUP BY "partition" """,
    "stream_observed": f"""WITH {_E}, {_PASS}
SELECT count(*) AS n_read, count(*) FILTER (cut) AS bad_json,
       count(*) FILTER (NOT cut AND domain IN ('de.wikipedia.org', 'uk.wikipedia.org')) AS other_domain,
       count(*) FILTER (NOT cut AND domain NOT IN ('de.wikipedia.org', 'uk.wikipedia.org') AND coalesce(is_bot, true))
         AS not_human,
       (SELECT count(*) FROM passed) AS passed, (SELECT count(*) FROM passed) AS n_written
FROM e""",
    "stream_throughput": f"""WITH {_E}
SELECT 'input' AS topic, date_trunc('hour', ts)::TIMESTAMP AS window_start, count(*) AS n_records FROM e GROUP BY ALL""",
}
