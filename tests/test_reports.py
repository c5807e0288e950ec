"""Late rows and broken messages end up in tables, also those of a restarted query."""

import os
import time

import pytest

from editscope.operators import windows
from editscope.sources import feed
from editscope.streaming import reports, sinks

from .edits import edit
from .test_streaming import NOW, Landing, run


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


def settled(read, want, seconds=30):
    """Progress is reported a little after the batch."""
    end = time.time() + seconds
    while read() != want and time.time() < end:
        time.sleep(0.2)
    assert read() == want


def test_late_rows_of_every_run_are_counted(spark, landing, tmp_path):
    output = f"{tmp_path}/reports"
    listener = reports.watch(spark, output)

    def total():
        return sum(r.late_rows for r in reports.late_table(output).read(spark).collect())

    try:
        landing.add([edit(1, 0, comment="undo"), edit(2, 1)])
        landing.add([edit(3, 7200)])
        landing.add([edit(4, 7201)])
        landing.add([edit(5, 1, title="A"), edit(6, 2, title="B")])  # two behind the watermark
        wars = windows.edit_wars(landing.stream(), "1 minute", "1 minute")
        run(wars, sinks.partition_sink(f"{tmp_path}/out", "r"), tmp_path / "cp")
        settled(total, 2)
        landing.add([edit(7, 3)])
        run(windows.edit_wars(landing.stream(), "1 minute", "1 minute"), sinks.partition_sink(f"{tmp_path}/out", "r"), tmp_path / "cp")
        settled(total, 3)
    finally:
        spark.streams.removeListener(listener)
    rows = reports.late_table(output).read(spark)
    assert rows.select("query_id").distinct().count() == 1 and rows.select("run_id").distinct().count() == 2
    assert [r["rows"] for r in reports.losses(spark, output).filter("what like 'late%'").collect()] == [3]


def test_broken_messages_are_kept(spark, tmp_path):
    (tmp_path / "in").mkdir()
    good = '{"time": "2026-05-28 18:00:00", "title": "T", "user": "u"}'
    for k, lines in enumerate([[good, "{bad", good], ["not json", good]]):
        path = tmp_path / "in" / f"{k}.txt"
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
        stream = feed.stream_text(spark, f"{tmp_path}/in")
        reports.start_dead_letters(stream, f"{tmp_path}/out", f"{tmp_path}/cp", "r", NOW).awaitTermination()
    broken = reports.broken_table(f"{tmp_path}/out").read(spark)
    assert sorted(r.value for r in broken.collect()) == ["not json", "{bad"] and broken.filter("read_at is null").count() == 0
    assert [tuple(r) for r in reports.losses(spark, f"{tmp_path}/out").collect()] == [("broken messages", 2)]
