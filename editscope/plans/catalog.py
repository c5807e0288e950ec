"""Registered queries: name -> function of (session, table folder)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ip, text
from ..functions.times import MICROS, event_micros, floor_div
from ..operators import geo, history, leaders, live_map, normalize, rate, windows
from ..schemas import EDIT_WARS, SUPER_EDITORS, TOPIC_TRENDS
from ..sources import messages
from ..sources.history import CSV_WRITE, packed, parse_csv_lines, read_history, to_csv_line
from ..streaming import pipeline
from . import tables as t

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-02-01 00:00:00"


def _content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.edits(spark, sf_dir).filter(text.is_content_title("title"))


def _naive(rows: DataFrame, *names: str) -> DataFrame:
    for name in names:
        rows = rows.withColumn(name, F.col(name).cast("timestamp_ntz"))
    return rows


# ---- parsing and scalar expressions ------------------------------------------------------


def feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one framed feed message of four lines; views are not edits."""
    rows = t.edits(spark, sf_dir)
    change = F.to_json(
        F.struct(
            F.when(F.col("event_type") == "view", "log").otherwise("edit").alias("type"),
            "user",
            F.when(F.col("is_bot"), True).alias("bot"),
            F.concat("wiki_lang", F.lit(".example.org")).alias("server_name"),
            "title",
            F.struct(F.lit(1000).alias("old"), (F.col("length_diff") + 1000).alias("new")).alias("length"),
            "comment",
            F.struct(F.col("revision_id").alias("new")).alias("revision"),
            F.when(F.col("is_minor"), True).alias("minor"),
            floor_div(event_micros(rows, "ts"), MICROS).alias("timestamp"),
        )
    )
    frame = F.array(
        F.lit("event: message"),
        F.concat(F.lit("id: "), F.col("event_id").cast("string")),
        F.concat(F.lit(normalize.DATA_PREFIX), change),
        F.lit(""),
    )
    return rows.select(F.explode(frame).alias("value"))


def feed_parse(spark, sf_dir):
    return normalize.parse_feed(feed_lines(spark, sf_dir)).select(
        F.unix_seconds("ts").alias("event_second"),
        "user", "is_bot", "title", "wiki_lang", "length_diff", "comment", "revision_id", "is_minor",
    )


def feed_parse_odd(spark, sf_dir):
    """Events whose numbers fit no column: lengths that overflow, times that are none."""
    k = F.col("event_id") % 4
    big = F.lit(9_223_372_036_854_775_807)
    change = F.to_json(F.struct(
        F.lit("edit").alias("type"), "user", "title",
        F.struct(
            F.when(k == 0, F.lit(-5_000_000_000)).when(k == 1, -big).otherwise(F.lit(0)).alias("old"),
            F.when(k == 0, F.lit(3_000_000_000)).when(k == 1, big).otherwise(F.col("event_id") % 7).alias("new"),
        ).alias("length"),
        F.struct(F.col("revision_id").alias("new")).alias("revision"),
        F.when(k == 2, F.lit(9_000_000_000_000_000_000)).otherwise(floor_div(event_micros(t.edits(spark, sf_dir), "ts"), MICROS)).alias("timestamp"),
    ))
    lines = t.edits(spark, sf_dir).select(F.concat(F.lit(normalize.DATA_PREFIX), change).alias("value"))
    never = F.lit(None).cast("timestamp")
    return normalize.parse_feed(lines, never).select("revision_id", "length_diff", F.unix_seconds("ts").alias("event_second"))


def edit_to_json(spark, sf_dir):
    rows = geo.geo_enrich(t.flagged_edits(spark, sf_dir), t.geo(spark, sf_dir))
    return normalize.encode_edits(rows, "event_id")


def json_decode(spark, sf_dir):
    messages = normalize.encode_edits(t.flagged_edits(spark, sf_dir), "event_id")
    return _naive(normalize.decode_edits(messages, "event_id"), "ts")


def message_log(spark, sf_dir):
    """Edits sent as messages into a log of four partitions, the first with half of them, and landed from there by a
    stream of bounded micro-batches."""
    folder = f"{t.scratch(spark)}/messages-{uuid.uuid4().hex}"
    partition = F.when(F.col("event_id") % 2 == 0, 0).otherwise(1 + F.pmod("event_id", F.lit(3))).alias("topic")
    sent = normalize.encode_edits(t.flagged_edits(spark, sf_dir), partition)
    sent.write.partitionBy("topic").text(f"{folder}/log")
    edits = normalize.decode_edits(messages.stream_messages(spark, f"{folder}/log", f"{folder}/cursor"))
    landing = pipeline.land(edits, f"{folder}/edits", f"{folder}/checkpoint", {"processingTime": "0 seconds"})
    landing.processAllAvailable()
    landing.stop()
    return _naive(spark.read.schema(edits.schema).parquet(f"{folder}/edits"), "ts")


def wiki_lang(spark, sf_dir):
    host = F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1)
    return t.read(spark, sf_dir, "pages").select(
        "page_id", host.alias("server_name"), text.wiki_lang(host).alias("wiki_lang")
    )


def editor_type(spark, sf_dir):
    return t.flagged_edits(spark, sf_dir).select(
        "event_id", text.editor_type("is_suspicious", "is_bot").alias("editor_type")
    )


def editor_type_v1(spark, sf_dir):
    return t.edits(spark, sf_dir).select(
        "event_id", text.editor_type_v1("is_bot").alias("editor_type")
    )


def title_filter(spark, sf_dir):
    return _content(spark, sf_dir).select("event_id", "title")


def revert_flag(spark, sf_dir):
    return t.edits(spark, sf_dir).select(
        "event_id", text.revert_flag("comment").alias("is_revert")
    )


def revert_flag_documents(spark, sf_dir):
    return t.read(spark, sf_dir, "documents").select(
        "doc_id", text.revert_flag("text").alias("is_revert")
    )


def topic_key(spark, sf_dir):
    return t.edits(spark, sf_dir).select("event_id", text.topic_key("title").alias("topic"))


def is_ip(spark, sf_dir):
    return t.edits(spark, sf_dir).select("event_id", "user", ip.is_ip("user").alias("is_ip"))


def raw_edits(spark, sf_dir):
    return normalize.raw_edit_log(t.edits(spark, sf_dir))


def suspicious_flag(spark, sf_dir):
    return t.flagged_edits(spark, sf_dir).select("event_id", "user", "is_suspicious")


def suspicious_flag_60s(spark, sf_dir):
    """Ten edits in a minute, the operator's own defaults."""
    return rate.suspicious_flag(t.edits(spark, sf_dir)).select("event_id", "user", "is_suspicious")


def suspicious_flag_hot(spark, sf_dir):
    """Long spans and a low threshold, so that hot cells are found and thinned on small tables."""
    rows = rate.suspicious_flag(t.edits(spark, sf_dir), 15 * 24 * 3600, 3, hot_rows=6, max_hot=100_000)
    return rows.select("event_id", "user", "is_suspicious")


def suspicious_flag_fast(spark, sf_dir):
    """The operator's own defaults on thirty days that pass in a minute."""
    rows = t.edits(spark, sf_dir)
    fast = F.timestamp_micros(floor_div(event_micros(rows, "ts"), 50_000))
    return rate.suspicious_flag(rows.withColumn("ts", fast)).select("event_id", "user", "is_suspicious")


def _landed_feed(spark, sf_dir):
    """Parsed and flagged feed lines. Parsed once and landed, since the flag reads its input
    several times."""
    parsed = t.landed(normalize.parse_feed(feed_lines(spark, sf_dir)), "feed")
    return rate.suspicious_flag(parsed, **t.RATE, id_col="revision_id")


def _feed_content(spark, sf_dir):
    rows = _landed_feed(spark, sf_dir)
    return rows.filter(text.is_content_title("title")).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def feed_to_wars(spark, sf_dir):
    return windows.edit_wars(_feed_content(spark, sf_dir), *t.WAR_WINDOW)


def feed_to_editors(spark, sf_dir):
    return windows.super_editors(_feed_content(spark, sf_dir), *t.EDITOR_WINDOW)


def feed_to_topics(spark, sf_dir):
    return windows.topic_trends(_feed_content(spark, sf_dir), *t.WAR_WINDOW)


def feed_to_edits(spark, sf_dir):
    """The whole way of an edit: feed lines, rate flag, coordinates, message, edit table."""
    flagged = _landed_feed(spark, sf_dir)
    located = geo.geo_enrich(flagged, t.geo(spark, sf_dir))
    decoded = normalize.decode_edits(normalize.encode_edits(located))
    return decoded.withColumn("event_second", F.unix_seconds("ts")).drop("ts", "time")


# ---- geolocation and map -----------------------------------------------------------------


def geo_enrich(spark, sf_dir):
    rows = geo.geo_enrich(t.edits(spark, sf_dir), t.geo(spark, sf_dir))
    return rows.select("event_id", "user", "lat", "lon")


def geo_missing(spark, sf_dir):
    return geo.geo_missing(t.edits(spark, sf_dir), t.geo(spark, sf_dir))


def geo_upsert(spark, sf_dir):
    answers = t.geo_answers(spark, sf_dir)
    old = answers.select("ip", F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"))
    return geo.geo_upsert(old, answers)


def geo_range(spark, sf_dir):
    return geo.network_lookup(geo.edit_ips(t.edits(spark, sf_dir)), t.networks(spark, sf_dir))


def geo_range_v6(spark, sf_dir):
    """The users as IPv6 addresses, in /120 networks for every second block and one /3 for all."""
    who, block = F.col("user_id"), F.expr("user_id div 256")
    users = t.read(spark, sf_dir, "events").select("user_id").distinct()

    def address(low):
        return F.concat(F.lit("2001:db8::"), F.lower(F.hex(F.call_function("div", low, F.lit(65_536)))), F.lit(":"), F.lower(F.hex(low % 65_536)))

    narrow = users.filter(block % 2 == 0).select(
        address(block * 256).alias("net_start"), F.lit(120).alias("prefix_len"), block.cast("double").alias("lat"), (block * 2).cast("double").alias("lon")
    ).distinct()
    wide = users.agg(F.lit("2000::").alias("net_start"), F.lit(3).alias("prefix_len"), F.lit(1.0).alias("lat"), F.lit(1.0).alias("lon"))
    return geo.network_lookup(users.select(address(who).alias("ip")), narrow.unionByName(wide))


def geo_range_enrich(spark, sf_dir):
    rows = t.edits(spark, sf_dir)
    places = geo.network_lookup(geo.edit_ips(rows), t.networks(spark, sf_dir))
    return geo.geo_enrich(rows, places).select("event_id", "user", "lat", "lon")


def geo_interval(spark, sf_dir):
    """The smallest of the ranges, nested and overlapping, that hold each address."""
    return geo.interval_lookup(geo.edit_ips(t.edits(spark, sf_dir)), t.ranges(spark, sf_dir))


def map_points(spark, sf_dir):
    return t.points(spark, sf_dir).select("event_id", "lat", "lon", "wiki_lang")


def map_last_n(spark, sf_dir):
    return live_map.rolling_points(t.points(spark, sf_dir)).select(
        "event_id", "ts", "lat", "lon", "wiki_lang"
    )


def map_lang_top10(spark, sf_dir):
    return live_map.lang_counts(t.points(spark, sf_dir))


def map_summary(spark, sf_dir):
    return live_map.map_summary(t.points(spark, sf_dir), F.lit(AS_OF).cast("timestamp_ntz"))


# ---- windowed aggregates -----------------------------------------------------------------


def edit_wars(spark, sf_dir):
    return windows.edit_wars(_content(spark, sf_dir), *t.WAR_WINDOW)


def _against(exact, estimated, key, count):
    """The exact count of each (window, key) and whether the estimate is within a tenth of it."""
    keys = [*windows.STATIC_KEY, key]
    guess = estimated.select(*keys, F.col(count).alias("estimate"))
    close = F.abs(F.col("estimate") - F.col(count)) <= F.col(count) * 0.1
    return exact.join(guess, keys, "left").select(*keys, count, F.coalesce(close, F.lit(False)).alias("is_close"))


def edit_wars_approx(spark, sf_dir):
    rows = _content(spark, sf_dir)
    guess = windows.edit_wars(rows, *t.WAR_WINDOW, exact=False)
    return _against(windows.edit_wars(rows, *t.WAR_WINDOW), guess, "title", "unique_users")


def topic_trends_approx(spark, sf_dir):
    rows = _content(spark, sf_dir)
    guess = windows.topic_trends(rows, *t.WAR_WINDOW, exact=False)
    return _against(windows.topic_trends(rows, *t.WAR_WINDOW), guess, "topic", "article_count")


def topic_trends_members(spark, sf_dir):
    return windows.topic_members(_content(spark, sf_dir), *t.WAR_WINDOW)


def edit_wars_min_users(spark, sf_dir):
    return windows.edit_wars(_content(spark, sf_dir), *t.EDITOR_WINDOW, min_users=2)


def edit_wars_members(spark, sf_dir):
    return windows.war_members(_content(spark, sf_dir), *t.WAR_WINDOW)


def edit_wars_by_edits(spark, sf_dir):
    return windows.wars_by_edits(edit_wars(spark, sf_dir))


def super_editors(spark, sf_dir):
    rows = t.flagged_edits(spark, sf_dir).filter(text.is_content_title("title"))
    return windows.super_editors(rows, *t.EDITOR_WINDOW)


def edit_wars_5m(spark, sf_dir):
    """Windows of five minutes every minute, the operators' own defaults."""
    return windows.edit_wars(_content(spark, sf_dir))


def super_editors_5m(spark, sf_dir):
    rows = t.flagged_edits(spark, sf_dir).filter(text.is_content_title("title"))
    return windows.super_editors(rows)


def topic_trends_5m(spark, sf_dir):
    return windows.topic_trends(_content(spark, sf_dir))


def super_editors_top50(spark, sf_dir):
    return windows.top_editors_of_batch(super_editors(spark, sf_dir))


def super_editors_top_per_window(spark, sf_dir):
    return windows.top_editors_per_window(super_editors(spark, sf_dir), k=5)


def _leaders_audited(spark, sf_dir, key, window, k):
    """Lists by ``k`` counters against exact counts."""
    rows = _content(spark, sf_dir)
    found = leaders.leaders(rows, key, *window, k=k, tracked=k)
    return leaders.audit(rows, key, found, *window, k=k)


def editor_leaders(spark, sf_dir):
    return _leaders_audited(spark, sf_dir, "user", t.EDITOR_WINDOW, 48)


def topic_leaders(spark, sf_dir):
    return _leaders_audited(spark, sf_dir, text.topic_key("title"), t.WAR_WINDOW, 48)


def topic_trends(spark, sf_dir):
    return windows.topic_trends(_content(spark, sf_dir), *t.WAR_WINDOW)


def topic_trends_top20(spark, sf_dir):
    return windows.top_topics_of_batch(topic_trends(spark, sf_dir))


# ---- result history ----------------------------------------------------------------------


def hist_read(spark, sf_dir):
    """The war history written as CSV lines and read back, next to each line a damaged one."""
    rows = t.war_history(spark, sf_dir)
    for name in ("start_time", "end_time"):
        rows = rows.withColumn(name, F.col(name).cast("string"))
    columns = [c.split("`")[1] for c in EDIT_WARS.split(", ")]
    damaged = rows.withColumn("start_time", F.concat(F.lit("Q"), "title"))
    lines = rows.select(to_csv_line(*columns).alias("value")).unionByName(
        damaged.select(to_csv_line(*columns).alias("value"))
    )
    return _naive(
        parse_csv_lines(lines, EDIT_WARS, "start_time", "end_time"), "start_time", "end_time"
    )


def _through_files(rows, schema, *bounds):
    """The history written as CSV files in the shared folder and read back."""
    path = f"{t.scratch(rows.sparkSession)}/history-{uuid.uuid4().hex}"
    packed(rows).write.options(header=True, **CSV_WRITE).csv(path)
    back = read_history(rows.sparkSession, [path, f"{path}-not-yet"], schema, *bounds)
    return _naive(back, "start_time", "end_time")


def hist_read_editors(spark, sf_dir):
    """Editor history through files; the languages are parted by line breaks."""
    rows = t.editor_history(spark, sf_dir)
    broken = rows.withColumn("langs_edited", F.replace("langs_edited", F.lit(", "), F.lit("\r\n")))
    return _through_files(broken, SUPER_EDITORS, "start_time")


def hist_read_topics(spark, sf_dir):
    """Topic history through files; the titles are parted by line breaks."""
    rows = t.topic_history(spark, sf_dir)
    broken = rows.withColumn("sample_titles", F.replace("sample_titles", F.lit(" | "), F.lit("\n")))
    return _through_files(broken, TOPIC_TRENDS, "start_time")


def latest_versions(spark, sf_dir):
    return history.latest_versions(t.war_history(spark, sf_dir), ["start_time", "title"])


def hist_war_peaks(spark, sf_dir):
    return history.war_peaks(t.war_history(spark, sf_dir))


def hist_editor_peaks(spark, sf_dir):
    return history.editor_peaks(t.editor_history(spark, sf_dir))


def hist_topic_peaks(spark, sf_dir):
    return history.topic_peaks(t.topic_history(spark, sf_dir))


def hist_last_15m(spark, sf_dir):
    rows = history.last_range(t.war_history(spark, sf_dir), "end_time", "15 minutes")
    return history.newest_first(rows, "end_time", "title", "batch_id")


def hist_last_1h(spark, sf_dir):
    return history.last_range(t.war_history(spark, sf_dir), "end_time", "1 hour")


def hist_war_kpis(spark, sf_dir):
    return history.war_kpis(t.war_history(spark, sf_dir), "1 hour")


def hist_war_kpis_all(spark, sf_dir):
    return history.war_kpis(t.war_history(spark, sf_dir))


def hist_war_trend(spark, sf_dir):
    return history.war_trend(t.war_history(spark, sf_dir))


def hist_war_trend_latest(spark, sf_dir):
    return history.war_trend_latest(t.war_history(spark, sf_dir))


def war_links(spark, sf_dir):
    return history.war_links(history.war_peaks(t.war_history(spark, sf_dir)))


def hist_editor_mix(spark, sf_dir):
    return history.editor_mix(hist_editor_peaks(spark, sf_dir))


def hist_top_editors(spark, sf_dir):
    return history.top_editors(hist_editor_peaks(spark, sf_dir))


def hist_suspicious(spark, sf_dir):
    return history.suspicious_accounts(hist_editor_peaks(spark, sf_dir))


def hist_top_topics(spark, sf_dir):
    return history.top_topics(hist_topic_peaks(spark, sf_dir))


def data_status(spark, sf_dir):
    return history.data_status(
        {
            "edit_wars": edit_wars(spark, sf_dir),
            "super_editors": super_editors(spark, sf_dir),
            "topic_trends": topic_trends(spark, sf_dir),
            "map_points": map_points(spark, sf_dir),
        }
    )


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        edit_wars, edit_wars_approx, edit_wars_min_users, edit_wars_members, edit_wars_by_edits,
        super_editors, super_editors_top50, super_editors_top_per_window, editor_leaders, topic_leaders,
        topic_trends, topic_trends_top20, topic_trends_members, topic_trends_approx, edit_wars_5m, super_editors_5m, topic_trends_5m,
        feed_parse, feed_parse_odd, feed_to_wars, feed_to_editors, feed_to_topics, edit_to_json, json_decode, message_log, wiki_lang, editor_type, editor_type_v1,
        title_filter, revert_flag, revert_flag_documents, topic_key, is_ip, raw_edits,
        suspicious_flag, suspicious_flag_60s, suspicious_flag_hot, suspicious_flag_fast, feed_to_edits,
        geo_enrich, geo_missing, geo_upsert, geo_range, geo_range_v6, geo_range_enrich, geo_interval,
        map_points, map_last_n, map_lang_top10, map_summary,
        hist_read, hist_read_editors, hist_read_topics, latest_versions, hist_war_peaks, hist_editor_peaks, hist_topic_peaks,
        hist_last_15m, hist_last_1h, hist_war_kpis, hist_war_kpis_all,
        hist_war_trend, hist_war_trend_latest, war_links,
        hist_editor_mix, hist_top_editors, hist_suspicious, hist_top_topics, data_status,
    )
}
