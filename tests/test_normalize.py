import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from editscope.operators import normalize


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def event(**fields):
    return "data: " + json.dumps({"type": "edit", "user": "U", "title": "T", **fields}, ensure_ascii=False)


def test_framing_and_drops(spark):
    got = normalize.parse_feed(
        lines(
            spark, "", "event: message", "data: {bad", "data:" + event()[6:], event(type="log"),
            'data: {"type": "edit", "title": "T"}', 'data: {"type": "edit", "user": "U"}',
            event(user=None), event(title="ok"), "data: 3", "data: []",
        )
    ).collect()
    assert [r.title for r in got] == ["ok"]


def test_only_the_leading_prefix_goes(spark):
    row = normalize.parse_feed(lines(spark, event(comment="see data: here"))).first()
    assert row.comment == "see data: here"


def test_defaults(spark):
    rows = normalize.parse_feed(
        lines(spark, event(), event(length=None), event(length={"new": 5}), event(length={"old": 5}),
              event(bot=True, minor=True, revision={"new": 2498846264}, comment="ż", server_name="pl.x.org")),
        F.lit(dt.datetime(2026, 1, 1)),
    ).collect()
    assert [(r.is_bot, r.comment, r.revision_id, r.is_minor, r.length_diff, r.wiki_lang) for r in rows] == [
        (False, "", 0, False, 0, "??"), (False, "", 0, False, 0, "??"), (False, "", 0, False, 5, "??"),
        (False, "", 0, False, -5, "??"), (True, "ż", 2498846264, True, 0, "pl"),
    ]
    assert {r.ts for r in rows} == {dt.datetime(2026, 1, 1)}


def test_feed_time_wins(spark):
    row = normalize.parse_feed(lines(spark, event(timestamp=1700000000))).select(F.unix_seconds("ts")).first()
    assert row[0] == 1700000000


def message(**fields):
    base = {"time": "2026-05-28 18:14:16", "user": "U", "title": "T", "revision_id": 1}
    return json.dumps({**base, **fields})


def test_decode(spark):
    rows = normalize.decode_edits(
        lines(
            spark, message(revision_id=2400000000, is_bot=True), message(title="wrong type", length_diff="x"),
            "{bad", message(title="Talk:T"), message(title=None), message(title="bad time", time="yesterday"),
        )
    ).collect()
    by_title = {r.title: r for r in rows}
    assert set(by_title) == {"T", "wrong type", "bad time"}
    assert by_title["T"].revision_id == 2400000000
    assert by_title["T"].editor_type == "BOT"
    assert by_title["T"].ts == dt.datetime(2026, 5, 28, 18, 14, 16)
    assert by_title["wrong type"].length_diff is None and by_title["wrong type"].user == "U"
    assert by_title["bad time"].ts is None


def test_decode_binary_and_older_messages(spark):
    old = lines(spark, message(is_bot=False)).select(F.col("value").cast("binary").alias("value"))
    row = normalize.decode_edits(old).first()
    assert (row.is_suspicious, row.wiki_lang, row.editor_type) == (None, None, "HUMAN")


def test_encode_keeps_nulls_and_round_trips(spark):
    edits = normalize.decode_edits(lines(spark, message(comment='say "hi", ż\n', is_bot=False)))
    encoded = normalize.encode_edits(edits)
    fields = json.loads(encoded.first().value)
    assert set(fields) == set(normalize.EDIT_FIELDS)
    assert fields["lat"] is None and fields["time"] == "2026-05-28 18:14:16"
    assert normalize.decode_edits(encoded).select(*edits.columns).collect() == edits.collect()


def test_dead_letters(spark):
    rows = normalize.dead_letters(lines(spark, "{bad", message(), message(length_diff="x"), "not json"))
    assert sorted(r.value for r in rows.collect()) == ["not json", "{bad"]


@pytest.mark.parametrize("title,category", [("Category:A", "KATEGORIA"), ("Talk:A", "DYSKUSJA"), ("A", "ARTYKUŁ")])
def test_raw_log(spark, title, category):
    edits = normalize.parse_feed(lines(spark, event(title=title, bot=True)))
    row = normalize.raw_edit_log(edits).first()
    assert (row.editor_type, row.category, row.title) == ("BOT", category, title)
