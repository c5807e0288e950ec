"""The registered queries as DuckDB SQL over the same tables.

Written from the definitions of the operators, not from their Spark plans: windows are expanded
per edit, the rate flag is one lag, networks are matched by range.
"""

from __future__ import annotations

from ..functions.text import REVERT_PATTERN, SITE
from .catalog import AS_OF

OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IS_IP = f"""regexp_full_match("user", '({OCTET}\\.){{3}}{OCTET}')"""

EDITS = """
edits AS (
  SELECT event_id, ts, user_id, event_type,
    CASE WHEN user_id % 5 = 1
         THEN '10.0.' || (user_id // 256) || '.' || (user_id % 256)
         ELSE 'user_' || user_id END AS "user",
    user_id % 10 = 0 AS is_bot,
    CASE k % 20 WHEN 0 THEN 'Category:' WHEN 1 THEN 'Talk:' ELSE '' END
      || 'Topic' || (k % 10) || CASE WHEN k % 2 = 0 THEN ' ' ELSE '_' END || 'item ' || k AS title,
    CASE k % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'de' WHEN 2 THEN 'pl' ELSE 'commons' END AS wiki_lang,
    ((event_id * 37) % 2001 - 1000)::INT AS length_diff,
    CASE event_type WHEN 'error' THEN 'Reverted edit ' || event_id
                    WHEN 'signup' THEN NULL ELSE event_type || ' edit' END AS comment,
    2147480000 + event_id AS revision_id,
    event_id % 5 = 0 AS is_minor
  FROM (SELECT *, json_extract_string(props, '$.k')::INT AS k FROM events)
)"""

CONTENT = """
content AS (
  SELECT * FROM edits WHERE NOT starts_with(title, 'Category:') AND NOT starts_with(title, 'Talk:')
)"""

FLAGGED = """
flagged AS (
  SELECT *, coalesce(NOT is_bot AND lag(ts, 2) OVER (
      PARTITION BY "user", is_bot ORDER BY ts, event_id) > ts - INTERVAL 6 HOUR, false) AS is_suspicious
  FROM edits
)"""

FLAGGED_CONTENT = """
flagged_content AS (
  SELECT * FROM flagged
  WHERE NOT starts_with(title, 'Category:') AND NOT starts_with(title, 'Talk:')
)"""

ANSWERS = """
answers AS (
  SELECT DISTINCT "user" AS ip, CASE WHEN user_id % 3 = 0 THEN 'fail' ELSE 'success' END AS status,
    ((user_id * 7) % 180 - 90)::DOUBLE AS lat, ((user_id * 13) % 360 - 180)::DOUBLE AS lon
  FROM edits WHERE """ + IS_IP + """
), geo AS (SELECT ip, lat, lon FROM answers WHERE status = 'success')"""

POINTS = """
points AS (
  SELECT c.*, g.lat, g.lon FROM content c JOIN geo g ON c."user" = g.ip
)"""

NETWORKS = """
nets AS (
  SELECT DISTINCT user_id // 256 * 256 AS first, user_id // 256 * 256 + 127 AS last, 25 AS prefix_len,
    (user_id // 256)::DOUBLE AS lat, (user_id // 256 * 2)::DOUBLE AS lon FROM events
  UNION
  SELECT DISTINCT user_id // 16 * 16, user_id // 16 * 16 + 15, 28,
    (user_id // 256 + 1)::DOUBLE, (user_id % 256 // 16 * 16)::DOUBLE
  FROM events WHERE (user_id % 256 // 16) % 3 <> 0
), located AS (
  SELECT ip, max(prefix_len)::INT AS prefix_len,
    arg_max(lat, prefix_len) AS lat, arg_max(lon, prefix_len) AS lon
  FROM (SELECT DISTINCT "user" AS ip, user_id FROM edits WHERE """ + IS_IP + """) a
  JOIN nets ON user_id BETWEEN first AND last
  GROUP BY ip
)"""


RANGES = """
blocks AS (
  SELECT DISTINCT user_id // 256 AS b FROM events
), ranges AS (
  SELECT b * 256 + 5 AS first, b * 256 + 200 AS last, '10.0.' || b || '.5' AS net_start, '10.0.' || b || '.200' AS net_end,
    b::DOUBLE AS lat, (b * 2)::DOUBLE AS lon FROM blocks
  UNION ALL
  SELECT b * 256 + 17, b * 256 + 99, '10.0.' || b || '.17', '10.0.' || b || '.99', (b + 1)::DOUBLE, b::DOUBLE FROM blocks WHERE b % 2 = 0
  UNION ALL
  SELECT b * 256 + 250, b * 256 + 286, '10.0.' || b || '.250', '10.0.' || (b + 1) || '.30', b::DOUBLE, (b + 2)::DOUBLE FROM blocks
)"""


def windowed(table: str, size: str, slide: str, n: int) -> str:
    """Every edit in each of its ``n`` windows."""
    return f"""
windowed AS (
  SELECT e.*, time_bucket(INTERVAL '{slide}', ts) - i * INTERVAL '{slide}' AS start_time,
    time_bucket(INTERVAL '{slide}', ts) - i * INTERVAL '{slide}' + INTERVAL '{size}' AS end_time
  FROM {table} e, range({n}) r(i)
)"""


def leaders(key: str, tracked: int) -> str:
    """Keys of a window that a list by counters cannot miss, and the faults that it may not have."""
    places = 1 << (tracked * 4 // 3 - 1).bit_length()
    return f"""
SELECT start_time, end_time, max(n)::BIGINT AS total_edits, count(*) FILTER (edits > 2 * (n * 7 // {2 * places})) AS certain,
  0::BIGINT AS missed, 0::BIGINT AS wrong
FROM (
  SELECT start_time, end_time, count(*) AS edits, sum(count(*)) OVER (PARTITION BY start_time, end_time)::BIGINT AS n
  FROM windowed GROUP BY start_time, end_time, {key}
) GROUP BY start_time, end_time"""


def replayed(table: str, size: str, slide: str, n: int) -> str:
    """Every edit in each (window, batch) that has seen it; a batch brings one slide."""
    return f"""
windowed AS (
  SELECT e.*, pane, pane - i * INTERVAL '{slide}' AS start_time,
    pane - i * INTERVAL '{slide}' + INTERVAL '{size}' AS end_time,
    pane + j * INTERVAL '{slide}' AS seen_at
  FROM (SELECT *, time_bucket(INTERVAL '{slide}', ts) AS pane FROM {table}) e,
    range({n}) r(i), range({n}) s(j)
  WHERE i + j < {n}
)"""


WAR_AGGREGATES = f"""
    title, count("user") AS total_edits, count(DISTINCT "user") AS unique_users,
    string_agg(DISTINCT "user", ', ' ORDER BY "user") AS combatants,
    arg_max_null(comment, (ts, revision_id)) AS latest_comment,
    arg_max_null(revision_id, (ts, revision_id)) AS latest_revision,
    sum(CASE WHEN regexp_matches(lower(comment), '{REVERT_PATTERN}') THEN 1 ELSE 0 END)::BIGINT AS reverts_count"""

EDITOR_AGGREGATES = """
    "user", count(*) AS edit_count,
    arg_max_null(is_bot, (ts, revision_id)) AS is_bot_flag,
    arg_max_null(is_suspicious, (ts, revision_id)) AS is_suspicious_flag,
    sum(length_diff)::DOUBLE / count(*)::DOUBLE AS avg_length_diff,
    string_agg(DISTINCT wiki_lang, ', ' ORDER BY wiki_lang) AS langs_edited"""

TOPIC_AGGREGATES = """
    regexp_split_to_array(title, '[ _]')[1] AS topic, count(DISTINCT title) AS article_count,
    count(*) AS total_edits, string_agg(DISTINCT title, ' | ' ORDER BY title) AS sample_titles"""

WAR_HAVING = "total_edits >= 2 AND reverts_count >= 1"


def totals(name: str, aggregates: str, key: str, having: str) -> str:
    return f"""
{name} AS (
  SELECT start_time, end_time, {aggregates}
  FROM windowed GROUP BY start_time, end_time, {key} HAVING {having}
)"""


def versions(name: str, aggregates: str, key: str, having: str, slide_us: int) -> str:
    return f"""
{name} AS (
  SELECT start_time, end_time, {aggregates}, epoch_us(seen_at) // {slide_us} AS batch_id
  FROM windowed GROUP BY start_time, end_time, seen_at, {key}
  HAVING max(pane) = seen_at AND {having}
)"""


def with_(*tables: str) -> str:
    return "WITH " + ",".join(tables)


SENT = """
sent AS (
  SELECT * REPLACE (date_trunc('second', ts) AS ts, coalesce(comment, '') AS comment)
  FROM edits WHERE event_type <> 'view'
), content AS (
  SELECT *, coalesce(NOT is_bot AND lag(ts, 2) OVER (
      PARTITION BY "user", is_bot ORDER BY ts, revision_id) > ts - INTERVAL 6 HOUR, false) AS is_suspicious
  FROM sent
  QUALIFY NOT starts_with(title, 'Category:') AND NOT starts_with(title, 'Talk:')
)"""

QUARTER, HOUR = 15 * 60 * 1_000_000, 3600 * 1_000_000
WAR_WINDOWS = windowed("content", "1 hour", "15 minutes", 4)
WARS = with_(EDITS, CONTENT, WAR_WINDOWS, totals("wars", WAR_AGGREGATES, "title", WAR_HAVING))
EDITORS = with_(
    EDITS, FLAGGED, FLAGGED_CONTENT, windowed("flagged_content", "6 hours", "1 hour", 6),
    totals("editors", EDITOR_AGGREGATES, '"user"', "edit_count >= 3"),
)
TOPICS = with_(
    EDITS, CONTENT, WAR_WINDOWS, totals("topics", TOPIC_AGGREGATES, "topic", "article_count >= 2")
)
WAR_HISTORY = with_(
    EDITS, CONTENT, replayed("content", "1 hour", "15 minutes", 4),
    versions("hist", WAR_AGGREGATES, "title", WAR_HAVING, QUARTER),
)
EDITOR_HISTORY = with_(
    EDITS, FLAGGED, FLAGGED_CONTENT, replayed("flagged_content", "6 hours", "1 hour", 6),
    versions("hist", EDITOR_AGGREGATES, '"user"', "edit_count >= 3", HOUR),
)
TOPIC_HISTORY = with_(
    EDITS, CONTENT, replayed("content", "1 hour", "15 minutes", 4),
    versions("hist", TOPIC_AGGREGATES, "topic", "article_count >= 2", QUARTER),
)
GEO = with_(EDITS, CONTENT, ANSWERS, POINTS)


def peaks(key: str, order: str) -> str:
    return f""", peak AS (
  SELECT * FROM hist QUALIFY row_number() OVER (PARTITION BY {key}
    ORDER BY {order} DESC, end_time DESC, start_time DESC, batch_id DESC) = 1
)"""


WAR_PEAKS = WAR_HISTORY + peaks("title", "total_edits")
EDITOR_PEAKS = EDITOR_HISTORY + peaks('"user"', "edit_count")
TOPIC_PEAKS = TOPIC_HISTORY + peaks("topic", "total_edits")
TYP = """CASE WHEN is_suspicious_flag THEN 'SUSPECTED_BOT' WHEN is_bot_flag THEN 'BOT' ELSE 'HUMAN' END"""


def kpis(in_range: str) -> str:
    return WAR_HISTORY + f""", in_range AS (SELECT * FROM hist WHERE {in_range}),
peak AS (
  SELECT * FROM in_range QUALIFY row_number() OVER (PARTITION BY title
    ORDER BY total_edits DESC, end_time DESC, start_time DESC, batch_id DESC) = 1
)
SELECT (SELECT count(DISTINCT batch_id) FROM hist) AS batches, count(*) AS conflicts,
  coalesce(max(total_edits), 0) AS max_edits, coalesce(sum(reverts_count), 0)::BIGINT AS reverts,
  (SELECT count(*) FROM in_range) AS rows_in_range
FROM peak"""


ORACLE: dict[str, str] = {
    "edit_wars": WARS + " SELECT * FROM wars",
    "edit_wars_by_edits": WARS + " SELECT * FROM wars",
    "edit_wars_min_users": with_(
        EDITS, CONTENT, windowed("content", "6 hours", "1 hour", 6),
        totals("wars", WAR_AGGREGATES, "title", WAR_HAVING + " AND unique_users >= 2"),
    ) + " SELECT * FROM wars",
    "edit_wars_members": WARS + f"""
SELECT w.start_time, w.end_time, w.title, e."user", count(*) AS user_edits,
  sum(CASE WHEN regexp_matches(lower(comment), '{REVERT_PATTERN}') THEN 1 ELSE 0 END)::BIGINT AS user_reverts,
  any_value(total_edits) AS total_edits, any_value(unique_users) AS unique_users,
  any_value(reverts_count) AS reverts_count
FROM wars w JOIN windowed e ON w.start_time = e.start_time AND w.title = e.title
GROUP BY w.start_time, w.end_time, w.title, e."user" """,
    "edit_wars_approx": WARS + " SELECT start_time, end_time, title, unique_users, true AS is_close FROM wars",
    "topic_trends_approx": TOPICS + " SELECT start_time, end_time, topic, article_count, true AS is_close FROM topics",
    "topic_trends_members": TOPICS + """
SELECT w.start_time, w.end_time, w.topic, e.title, count(*) AS title_edits,
  any_value(article_count) AS article_count, any_value(total_edits) AS total_edits
FROM topics w JOIN windowed e
  ON w.start_time = e.start_time AND w.topic = regexp_split_to_array(e.title, '[ _]')[1]
GROUP BY w.start_time, w.end_time, w.topic, e.title""",
    "editor_leaders": with_(EDITS, CONTENT, windowed("content", "6 hours", "1 hour", 6)) + leaders('"user"', 48),
    "topic_leaders": with_(EDITS, CONTENT, WAR_WINDOWS) + leaders("regexp_split_to_array(title, '[ _]')[1]", 48),
    "feed_to_wars": with_(
        EDITS, SENT, WAR_WINDOWS, totals("wars", WAR_AGGREGATES, "title", WAR_HAVING)
    ) + " SELECT * FROM wars",
    "feed_to_editors": with_(
        EDITS, SENT, windowed("content", "6 hours", "1 hour", 6),
        totals("editors", EDITOR_AGGREGATES, '"user"', "edit_count >= 3"),
    ) + " SELECT * FROM editors",
    "feed_to_topics": with_(
        EDITS, SENT, WAR_WINDOWS, totals("topics", TOPIC_AGGREGATES, "topic", "article_count >= 2")
    ) + " SELECT * FROM topics",
    "feed_parse_odd": with_(EDITS) + """
SELECT revision_id, CASE WHEN event_id % 4 >= 2 THEN (event_id % 7)::INT END AS length_diff,
  CASE WHEN event_id % 4 <> 2 THEN epoch_us(ts) // 1000000 END AS event_second
FROM edits""",
    "suspicious_flag_hot": with_(EDITS) + """
SELECT event_id, "user", coalesce(NOT is_bot AND lag(ts, 2) OVER (
    PARTITION BY "user", is_bot ORDER BY ts, event_id) > ts - INTERVAL 15 DAY, false) AS is_suspicious
FROM edits""",
    "suspicious_flag_fast": with_(EDITS) + """
SELECT event_id, "user", coalesce(NOT is_bot AND lag(us, 9) OVER (
    PARTITION BY "user", is_bot ORDER BY us, event_id) > us - 60000000, false) AS is_suspicious
FROM (SELECT *, epoch_us(ts) // 50000 AS us FROM edits)""",
    "geo_range_v6": """
SELECT '2001:db8::' || printf('%x', user_id // 65536) || ':' || printf('%x', user_id % 65536) AS ip,
  CASE WHEN block % 2 = 0 THEN 120 ELSE 3 END::INT AS prefix_len,
  CASE WHEN block % 2 = 0 THEN block ELSE 1 END::DOUBLE AS lat,
  CASE WHEN block % 2 = 0 THEN block * 2 ELSE 1 END::DOUBLE AS lon
FROM (SELECT DISTINCT user_id, user_id // 256 AS block FROM events)""",
    "hist_read_editors": EDITOR_HISTORY
    + " SELECT * REPLACE (replace(langs_edited, ', ', chr(13) || chr(10)) AS langs_edited) FROM hist",
    "hist_read_topics": TOPIC_HISTORY
    + " SELECT * REPLACE (replace(sample_titles, ' | ', chr(10)) AS sample_titles) FROM hist",
    "super_editors": EDITORS + " SELECT * FROM editors",
    "super_editors_top50": EDITORS
    + ' SELECT * FROM editors ORDER BY edit_count DESC, start_time, "user" LIMIT 50',
    "super_editors_top_per_window": EDITORS + """
SELECT *, row_number() OVER (PARTITION BY start_time ORDER BY edit_count DESC, "user")::INT AS place
FROM editors QUALIFY place <= 5""",
    "topic_trends": TOPICS + " SELECT * FROM topics",
    "topic_trends_top20": TOPICS
    + " SELECT * FROM topics ORDER BY total_edits DESC, start_time, topic LIMIT 20",
    "edit_wars_5m": with_(
        EDITS, CONTENT, windowed("content", "5 minutes", "1 minute", 5),
        totals("wars", WAR_AGGREGATES, "title", WAR_HAVING),
    ) + " SELECT * FROM wars",
    "super_editors_5m": with_(
        EDITS, FLAGGED, FLAGGED_CONTENT, windowed("flagged_content", "5 minutes", "1 minute", 5),
        totals("editors", EDITOR_AGGREGATES, '"user"', "edit_count >= 3"),
    ) + " SELECT * FROM editors",
    "topic_trends_5m": with_(
        EDITS, CONTENT, windowed("content", "5 minutes", "1 minute", 5),
        totals("topics", TOPIC_AGGREGATES, "topic", "article_count >= 2"),
    ) + " SELECT * FROM topics",
    "suspicious_flag_60s": with_(EDITS) + """
SELECT event_id, "user", coalesce(NOT is_bot AND lag(ts, 9) OVER (
    PARTITION BY "user", is_bot ORDER BY ts, event_id) > ts - INTERVAL 60 SECOND, false) AS is_suspicious
FROM edits""",
    "feed_to_edits": with_(EDITS, ANSWERS) + """, sent AS (
  SELECT *, date_trunc('second', ts) AS second FROM edits WHERE event_type <> 'view'
), flagged AS (
  SELECT *, coalesce(NOT is_bot AND lag(second, 2) OVER (
      PARTITION BY "user", is_bot ORDER BY second, revision_id) > second - INTERVAL 6 HOUR, false) AS is_suspicious
  FROM sent
)
SELECT epoch_us(second) // 1000000 AS event_second, "user", is_bot, is_suspicious, title, wiki_lang,
  length_diff, coalesce(comment, '') AS comment, revision_id, is_minor, lat, lon,
  CASE WHEN is_suspicious THEN 'SUSPECTED_BOT' WHEN is_bot THEN 'BOT' ELSE 'HUMAN' END AS editor_type
FROM flagged LEFT JOIN geo ON "user" = ip
WHERE NOT starts_with(title, 'Category:') AND NOT starts_with(title, 'Talk:')""",
    "feed_parse": with_(EDITS) + """
SELECT epoch_us(ts) // 1000000 AS event_second, "user", is_bot, title, wiki_lang, length_diff,
  coalesce(comment, '') AS comment, revision_id, is_minor
FROM edits WHERE event_type <> 'view'""",
    "edit_to_json": with_(EDITS, FLAGGED, ANSWERS) + """
SELECT event_id, json_object('time', strftime(ts, '%Y-%m-%d %H:%M:%S'), 'user', "user",
  'is_bot', is_bot, 'is_suspicious', is_suspicious, 'title', title, 'wiki_lang', wiki_lang,
  'length_diff', length_diff, 'comment', comment, 'revision_id', revision_id,
  'is_minor', is_minor, 'lat', lat, 'lon', lon)::VARCHAR AS value
FROM flagged f LEFT JOIN geo g ON f."user" = g.ip""",
    "json_decode": with_(EDITS, FLAGGED, FLAGGED_CONTENT) + """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, "user", is_bot, is_suspicious, title,
  wiki_lang, length_diff, comment, revision_id, is_minor, NULL::DOUBLE AS lat, NULL::DOUBLE AS lon,
  date_trunc('second', ts) AS ts,
  CASE WHEN is_suspicious THEN 'SUSPECTED_BOT' WHEN is_bot THEN 'BOT' ELSE 'HUMAN' END AS editor_type
FROM flagged_content""",
    "message_log": with_(EDITS, FLAGGED, FLAGGED_CONTENT) + """
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, "user", is_bot, is_suspicious, title,
  wiki_lang, length_diff, comment, revision_id, is_minor, NULL::DOUBLE AS lat, NULL::DOUBLE AS lon,
  date_trunc('second', ts) AS ts,
  CASE WHEN is_suspicious THEN 'SUSPECTED_BOT' WHEN is_bot THEN 'BOT' ELSE 'HUMAN' END AS editor_type
FROM flagged_content""",
    "wiki_lang": """
SELECT page_id, host AS server_name,
  CASE WHEN contains(host, '.') THEN split_part(host, '.', 1) ELSE '??' END AS wiki_lang
FROM (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host FROM pages)""",
    "editor_type": with_(EDITS, FLAGGED) + """
SELECT event_id,
  CASE WHEN is_suspicious THEN 'SUSPECTED_BOT' WHEN is_bot THEN 'BOT' ELSE 'HUMAN' END AS editor_type
FROM flagged""",
    "editor_type_v1": with_(EDITS)
    + " SELECT event_id, CASE WHEN is_bot THEN 'BOT' ELSE 'HUMAN' END AS editor_type FROM edits",
    "title_filter": with_(EDITS, CONTENT) + " SELECT event_id, title FROM content",
    "revert_flag": with_(EDITS) + f"""
SELECT event_id,
  CASE WHEN regexp_matches(lower(comment), '{REVERT_PATTERN}') THEN 1 ELSE 0 END AS is_revert
FROM edits""",
    "revert_flag_documents": f"""
SELECT doc_id,
  CASE WHEN regexp_matches(lower(text), '{REVERT_PATTERN}') THEN 1 ELSE 0 END AS is_revert
FROM documents""",
    "topic_key": with_(EDITS)
    + " SELECT event_id, regexp_split_to_array(title, '[ _]')[1] AS topic FROM edits",
    "is_ip": with_(EDITS) + f' SELECT event_id, "user", {IS_IP} AS is_ip FROM edits',
    "raw_edits": with_(EDITS) + """
SELECT ts AS time, "user", is_bot, title, length_diff,
  CASE WHEN is_bot THEN 'BOT' ELSE 'HUMAN' END AS editor_type,
  CASE WHEN starts_with(title, 'Category:') THEN 'KATEGORIA'
       WHEN starts_with(title, 'Talk:') THEN 'DYSKUSJA' ELSE 'ARTYKUŁ' END AS category
FROM edits""",
    "suspicious_flag": with_(EDITS, FLAGGED)
    + ' SELECT event_id, "user", is_suspicious FROM flagged',
    "geo_enrich": GEO + """
SELECT event_id, "user", lat, lon FROM edits LEFT JOIN geo ON "user" = ip""",
    "geo_missing": GEO + f"""
SELECT DISTINCT "user" AS ip FROM edits
WHERE {IS_IP} AND "user" NOT IN (SELECT ip FROM geo)""",
    "geo_upsert": GEO + """
SELECT ip, CASE WHEN status = 'success' THEN lat ELSE 0.0::DOUBLE END AS lat,
  CASE WHEN status = 'success' THEN lon ELSE 0.0::DOUBLE END AS lon FROM answers""",
    "geo_range": with_(EDITS, NETWORKS) + " SELECT * FROM located",
    "geo_interval": with_(EDITS, RANGES) + """
SELECT ip, arg_min(net_start, last - first) AS net_start, arg_min(net_end, last - first) AS net_end,
  arg_min(lat, last - first) AS lat, arg_min(lon, last - first) AS lon
FROM (SELECT DISTINCT "user" AS ip, user_id FROM edits WHERE """ + IS_IP + """) a
JOIN ranges ON user_id BETWEEN first AND last GROUP BY ip""",
    "geo_range_enrich": with_(EDITS, NETWORKS) + """
SELECT event_id, "user", lat, lon FROM edits LEFT JOIN located ON "user" = ip""",
    "map_points": GEO + " SELECT event_id, lat, lon, wiki_lang FROM points",
    "map_last_n": GEO + """
SELECT event_id, ts, lat, lon, wiki_lang FROM points ORDER BY ts DESC, event_id DESC LIMIT 500""",
    "map_lang_top10": GEO + """
SELECT wiki_lang, count(*) AS edits FROM points WHERE wiki_lang IS NOT NULL
GROUP BY wiki_lang ORDER BY edits DESC, wiki_lang LIMIT 10""",
    "map_summary": GEO + f"""
SELECT count(*) AS points,
  epoch_us(TIMESTAMP '{AS_OF}') // 1000000 - epoch_us(max(ts)) // 1000000 AS age_seconds
FROM points""",
    "hist_read": WAR_HISTORY + " SELECT * FROM hist",
    "latest_versions": WAR_HISTORY + """
SELECT * FROM hist
QUALIFY row_number() OVER (PARTITION BY start_time, title ORDER BY batch_id DESC) = 1""",
    "hist_war_peaks": WAR_PEAKS + " SELECT * FROM peak",
    "hist_editor_peaks": EDITOR_PEAKS + " SELECT * FROM peak",
    "hist_topic_peaks": TOPIC_PEAKS + " SELECT * FROM peak",
    "hist_last_15m": WAR_HISTORY
    + " SELECT * FROM hist WHERE end_time >= (SELECT max(end_time) FROM hist) - INTERVAL 15 MINUTE",
    "hist_last_1h": WAR_HISTORY
    + " SELECT * FROM hist WHERE end_time >= (SELECT max(end_time) FROM hist) - INTERVAL 1 HOUR",
    "hist_war_kpis": kpis("end_time >= (SELECT max(end_time) FROM hist) - INTERVAL 1 HOUR"),
    "hist_war_kpis_all": kpis("true"),
    "hist_war_trend": WAR_HISTORY
    + " SELECT end_time, sum(total_edits)::BIGINT AS total_edits FROM hist GROUP BY end_time",
    "hist_war_trend_latest": WAR_HISTORY + """
SELECT end_time, sum(total_edits)::BIGINT AS total_edits FROM (
  SELECT * FROM hist
  QUALIFY row_number() OVER (PARTITION BY start_time, title ORDER BY batch_id DESC) = 1
) GROUP BY end_time""",
    "war_links": WAR_PEAKS + f"""
SELECT title, total_edits, reverts_count, unique_users, combatants, latest_comment, start_time,
  '{SITE}/wiki/' || replace(title, ' ', '_') AS url,
  '{SITE}/w/index.php?diff=' || latest_revision AS diff_url
FROM peak""",
    "hist_editor_mix": EDITOR_PEAKS + f"""
SELECT count(*) FILTER (typ = 'HUMAN') AS humans, count(*) FILTER (typ = 'BOT') AS bots,
  count(*) FILTER (typ = 'SUSPECTED_BOT') AS suspects
FROM (SELECT {TYP} AS typ FROM peak)""",
    "hist_top_editors": EDITOR_PEAKS + f"""
SELECT "user", edit_count, avg_length_diff, langs_edited, {TYP} AS typ
FROM peak ORDER BY edit_count DESC, "user" LIMIT 20""",
    "hist_suspicious": EDITOR_PEAKS + """
SELECT "user", edit_count, avg_length_diff, langs_edited FROM peak WHERE is_suspicious_flag""",
    "hist_top_topics": TOPIC_PEAKS + """
SELECT topic, article_count, total_edits, sample_titles
FROM peak ORDER BY total_edits DESC, topic LIMIT 20""",
    "data_status": with_(
        EDITS, CONTENT, FLAGGED, FLAGGED_CONTENT, ANSWERS, POINTS, WAR_WINDOWS,
        totals("wars", WAR_AGGREGATES, "title", WAR_HAVING),
        totals("topics", TOPIC_AGGREGATES, "topic", "article_count >= 2"),
        windowed("flagged_content", "6 hours", "1 hour", 6).replace("windowed AS", "windowed6 AS"),
        totals("editors", EDITOR_AGGREGATES, '"user"', "edit_count >= 3").replace(
            "FROM windowed ", "FROM windowed6 "
        ),
    ) + """
SELECT 'edit_wars' AS table_name, EXISTS (SELECT 1 FROM wars) AS has_data
UNION ALL SELECT 'super_editors', EXISTS (SELECT 1 FROM editors)
UNION ALL SELECT 'topic_trends', EXISTS (SELECT 1 FROM topics)
UNION ALL SELECT 'map_points', EXISTS (SELECT 1 FROM points)""",
}
