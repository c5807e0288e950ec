"""Table layouts, as DDL strings that readers and ``from_json`` take as they are."""

# One change event of the feed. ``timestamp`` (unix seconds) is optional; when a feed
# carries it, it is the event time.
RAW_CHANGE = (
    "`type` string, `user` string, `bot` boolean, `server_name` string, `title` string, "
    "`length` struct<`old`: bigint, `new`: bigint>, `comment` string, "
    "`revision` struct<`old`: bigint, `new`: bigint>, `minor` boolean, `timestamp` bigint"
)

# Flat edit, the JSON message between the feed job and the analytics jobs. Messages of the
# older layout lack is_suspicious and wiki_lang; both then read as null.
EDIT = (
    "`time` string, `user` string, `is_bot` boolean, `is_suspicious` boolean, `title` string, "
    "`wiki_lang` string, `length_diff` int, `comment` string, `revision_id` bigint, "
    "`is_minor` boolean, `lat` double, `lon` double"
)

EDIT_FIELDS = (
    "time", "user", "is_bot", "is_suspicious", "title", "wiki_lang", "length_diff",
    "comment", "revision_id", "is_minor", "lat", "lon",
)

# Result histories. The bounds are read as text and parsed afterwards, so that a damaged row
# is recognised by its bounds instead of failing the scan.
EDIT_WARS = (
    "`start_time` string, `end_time` string, `title` string, `total_edits` bigint, "
    "`unique_users` bigint, `combatants` string, `latest_comment` string, "
    "`latest_revision` bigint, `reverts_count` bigint, `batch_id` bigint"
)
SUPER_EDITORS = (
    "`start_time` string, `end_time` string, `user` string, `edit_count` bigint, "
    "`is_bot_flag` boolean, `is_suspicious_flag` boolean, `avg_length_diff` double, "
    "`langs_edited` string, `batch_id` bigint"
)
TOPIC_TRENDS = (
    "`start_time` string, `end_time` string, `topic` string, `article_count` bigint, "
    "`total_edits` bigint, `sample_titles` string, `batch_id` bigint"
)

# The same results as rows of result tables, with real times; run and batch are added by the table.
WAR_ROWS = EDIT_WARS.replace("_time` string", "_time` timestamp").removesuffix(", `batch_id` bigint")
EDITOR_ROWS = SUPER_EDITORS.replace("_time` string", "_time` timestamp").removesuffix(", `batch_id` bigint")
TOPIC_ROWS = TOPIC_TRENDS.replace("_time` string", "_time` timestamp").removesuffix(", `batch_id` bigint")
LEADER_ROWS = (
    "`start_time` timestamp, `end_time` timestamp, `total_edits` bigint, `max_error` bigint, "
    "`leaders` array<struct<`item`: string, `edits`: bigint>>"
)
POINT_ROWS = "`event_id` bigint, `ts` timestamp, `lat` double, `lon` double, `wiki_lang` string"
GEO_ROWS = "`ip` string, `lat` double, `lon` double, `stored_at` timestamp"

MAP_POINT = "`lat` double, `lon` double, `wiki_lang` string"
GEO = "`ip` string, `lat` double, `lon` double"
GEO_ANSWER = "`ip` string, `status` string, `lat` double, `lon` double"
GEO_NETWORK = "`net_start` string, `prefix_len` int, `lat` double, `lon` double"
