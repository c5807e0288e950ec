import datetime as dt

from editscope.operators import history, live_map

from .edits import T0, at, edit, table

WARS = (
    "start_time timestamp, end_time timestamp, title string, total_edits bigint, unique_users bigint, "
    "combatants string, latest_comment string, latest_revision bigint, reverts_count bigint, batch_id bigint"
)


def war(title, minute, edits, batch, reverts=1, revision=1):
    start = T0 + dt.timedelta(minutes=minute)
    return (start, start + dt.timedelta(minutes=5), title, edits, 2, "a, b", "undo", revision, reverts, batch)


def wars(spark, *rows):
    return spark.createDataFrame(list(rows), WARS)


HISTORY = [
    war("A b", 0, 3, 0), war("A b", 0, 5, 1, 2), war("A b", 1, 5, 1, 3, 2498846264), war("B", 10, 2, 2, 4),
    war("B", 15, 2, 3, 5, None), war("C", 16, 9, 3),
]


def test_peaks_prefer_edits_then_the_later_window(spark):
    got = {r.title: r for r in history.war_peaks(wars(spark, *HISTORY)).collect()}
    assert len(got) == 3
    assert (got["A b"].start_time, got["A b"].reverts_count) == (at(60), 3)
    assert got["B"].batch_id == 3


def test_full_tie_goes_to_the_last_batch(spark):
    got = history.war_peaks(wars(spark, war("A", 0, 3, 0, 1), war("A", 0, 3, 7, 2))).collect()
    assert [(r.batch_id, r.reverts_count) for r in got] == [(7, 2)]


def test_last_range_keeps_its_edge(spark):
    rows = wars(spark, war("edge", 0, 2, 0), war("old", -1, 2, 0), war("now", 15, 2, 0))
    got = history.last_range(rows, "end_time", "15 minutes")
    assert sorted(r.title for r in got.collect()) == ["edge", "now"]
    assert history.last_range(rows, "end_time", None).count() == 3
    assert history.last_range(wars(spark), "end_time", "1 hour").count() == 0


def test_latest_versions(spark):
    got = history.latest_versions(wars(spark, *HISTORY), ["start_time", "title"])
    assert got.count() == 5
    assert got.filter("title = 'A b' and batch_id = 0").count() == 0


def test_kpis(spark):
    rows = wars(spark, *HISTORY)
    assert tuple(history.war_kpis(rows).first()) == (4, 3, 9, 3 + 5 + 1, 6)
    assert tuple(history.war_kpis(rows, "15 minutes").first()) == (4, 3, 9, 9, 4)
    assert tuple(history.war_kpis(wars(spark)).first()) == (0, 0, 0, 0, 0)


def test_kpis_tell_runs_apart(spark):
    from pyspark.sql import functions as F

    rows = wars(spark, *HISTORY)
    twice = rows.withColumn("run_id", F.lit("a")).unionByName(rows.withColumn("run_id", F.lit("b")))
    assert history.war_kpis(twice, run=["run_id"]).first().batches == 8


def test_trends(spark):
    rows = wars(spark, *HISTORY)
    trend = {r.end_time: r.total_edits for r in history.war_trend(rows).collect()}
    latest = {r.end_time: r.total_edits for r in history.war_trend_latest(rows).collect()}
    assert (trend[at(300)], latest[at(300)]) == (8, 5)


def test_links(spark):
    got = {r.title: r for r in history.war_links(history.war_peaks(wars(spark, *HISTORY))).collect()}
    assert got["A b"].url.endswith("/wiki/A_b") and got["A b"].diff_url.endswith("diff=2498846264")
    assert got["B"].diff_url is None


EDITORS = (
    "start_time timestamp, end_time timestamp, user string, edit_count bigint, is_bot_flag boolean, "
    "is_suspicious_flag boolean, avg_length_diff double, langs_edited string, batch_id bigint"
)


def editors(spark):
    rows = [
        (at(60 * i), at(60 * i + 300), user, count, bot, suspect, 1.0, "en", 0)
        for i, (user, count, bot, suspect) in enumerate(
            [("h", 3, False, False), ("h", 7, False, None), ("bot", 9, True, False), ("s", 5, False, True),
             ("null", 4, None, None)]
        )
    ]
    return spark.createDataFrame(rows, EDITORS)


def test_editor_figures(spark):
    peak = history.editor_peaks(editors(spark))
    assert tuple(history.editor_mix(peak).first()) == (2, 1, 1)
    top = history.top_editors(peak, 3).collect()
    assert [(r.user, r.edit_count, r.typ) for r in top] == [
        ("bot", 9, "BOT"), ("h", 7, "HUMAN"), ("s", 5, "SUSPECTED_BOT"),
    ]
    assert [r.user for r in history.suspicious_accounts(peak).collect()] == ["s"]


def test_top_topics_rise(spark):
    rows = spark.createDataFrame(
        [(at(0), at(300), f"t{i}", 2, i, "x | y", 0) for i in range(30)],
        "start_time timestamp, end_time timestamp, topic string, article_count bigint, total_edits bigint, "
        "sample_titles string, batch_id bigint",
    )
    got = [r.total_edits for r in history.top_topics(history.topic_peaks(rows)).collect()]
    assert got == list(range(10, 30))


def test_data_status(spark):
    full = wars(spark, *HISTORY)
    got = {r.table_name: r.has_data for r in history.data_status({"a": full, "b": full.filter("false")}).collect()}
    assert got == {"a": True, "b": False}


def test_rolling_points(spark):
    rows = [edit(i, i // 2, lat=1.0, lon=2.0) for i in range(10)]
    points = table(spark, rows)
    for n, expected in ((3, [9, 8, 7]), (10, list(range(9, -1, -1))), (20, list(range(9, -1, -1)))):
        assert [r.event_id for r in live_map.rolling_points(points, n).collect()] == expected


def test_map_figures(spark):
    from pyspark.sql import functions as F

    rows = [edit(i, i, lat=1.0 if i else None, lon=2.0, wiki_lang=lang)
            for i, lang in enumerate(["en", "en", "de", "en", "pl", "de", None])]
    points = live_map.map_points(table(spark, rows))
    assert points.count() == 6
    assert [tuple(r) for r in live_map.lang_counts(points, 2).collect()] == [("de", 2), ("en", 2)]
    assert tuple(live_map.map_summary(points, F.lit(at(100))).first()) == (6, 94)
