"""Streams with one state row per member against the static operators."""

import pytest
from pyspark.sql import functions as F

from editscope.operators import windows
from editscope.streaming import members, sinks

from .edits import edit, random_edits, table
from .test_streaming import Landing, in_order, latest, plain, run


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


CASES = [
    (members.edit_wars, windows.edit_wars, ["start_time", "title"], {}),
    (members.edit_wars, windows.edit_wars, ["start_time", "title"], {"min_users": 3, "min_reverts": 0}),
    (members.topic_trends, windows.topic_trends, ["start_time", "topic"], {}),
]


@pytest.mark.parametrize("stream,static,keys,options", CASES)
def test_same_as_the_static_form(spark, landing, tmp_path, stream, static, keys, options):
    rows = in_order(41)
    for i in range(0, 240, 60):
        landing.add(rows[i : i + 60])
    found = stream(landing.stream(), **options)
    expected = static(table(spark, rows), **options)
    assert found.dtypes == expected.dtypes
    run(found, sinks.partition_sink(f"{tmp_path}/out", "r"), tmp_path / "cp")
    got = latest(spark, f"{tmp_path}/out", keys).select(expected.columns)
    assert plain(got) == plain(expected) and expected.count() > 0


def test_state_goes_with_the_watermark_and_late_rows_are_dropped(spark, landing, tmp_path):
    landing.add([edit(k, k, user=f"u{k}", comment="undo") for k in range(20)])
    landing.add([edit(100, 3600, user="v")])
    landing.add([edit(101, 7200, user="w")])
    landing.add([edit(102, 5, user="late")])
    wars = members.edit_wars(landing.stream(), "1 minute", "1 minute", watermark="1 minute")
    query = run(wars, sinks.partition_sink(f"{tmp_path}/out", "r"), tmp_path / "cp")
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    assert [(r.unique_users, r.total_edits) for r in rows] == [(20, 20)]
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] < 15


def test_members_are_rows_of_the_state(spark, landing, tmp_path):
    """Many users of one page: a row each, written once, and listed for the condition only."""
    landing.add([edit(k, k % 50, user=f"u{k:04}") for k in range(1500)])
    landing.add([edit(2000 + k, 51, user=f"u{k:04}") for k in range(30)])
    wars = members.edit_wars(landing.stream(), "1 minute", "1 minute", min_edits=1520, min_reverts=0)
    query = run(wars, sinks.partition_sink(f"{tmp_path}/out", "r"), tmp_path / "cp")
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert [(r.total_edits, r.unique_users, r.batch_id) for r in got] == [(1530, 1500, 1)]
    assert got[0].combatants == ", ".join(f"u{k:04}" for k in range(1500))
    progress = query.recentProgress[1]["stateOperators"][0]
    assert progress["numRowsTotal"] >= 1500
    assert progress["numRowsUpdated"] < 50  # the second batch knows all its users


def test_without_lists(spark, landing, tmp_path):
    landing.add([edit(1, 0, comment="undo"), edit(2, 1, user=None), edit(3, 2, user=None, comment=None)])
    run(members.edit_wars(landing.stream(), lists=False, min_edits=1), sinks.partition_sink(f"{tmp_path}/out", "r"), tmp_path / "cp")
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.filter("combatants is null and total_edits = 1 and unique_users = 1").count() == got.count() == 5


def test_restart_keeps_the_members(spark, landing, tmp_path):
    rows = sorted(random_edits(43, 160), key=lambda r: r[1])
    sink = sinks.partition_sink(f"{tmp_path}/out", "r")
    landing.add(rows[:80])
    run(members.topic_trends(landing.stream()), sink, tmp_path / "cp")
    landing.add(rows[80:])
    run(members.topic_trends(landing.stream()), sink, tmp_path / "cp")
    expected = windows.topic_trends(table(spark, rows))
    assert plain(latest(spark, f"{tmp_path}/out", ["start_time", "topic"]).select(expected.columns)) == plain(expected)


def test_wants_a_stream_and_the_right_store(spark):
    with pytest.raises(ValueError, match="static"):
        members.edit_wars(table(spark, [edit(1)]))
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    stream = spark.readStream.format("rate").load().select(F.col("timestamp").alias("ts"), F.lit("T").alias("title"))
    spark.conf.unset(key)
    try:
        if spark.conf.get(key, "") != before:
            with pytest.raises(ValueError, match="stateStore"):
                members.topic_trends(stream)
    finally:
        spark.conf.set(key, before)
