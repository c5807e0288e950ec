"""Result tables by commits: what readers see while batches are written, repeated and put together."""

import datetime as dt
import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from editscope import schemas
from editscope.operators import history
from editscope.streaming import manifest, pipeline
from editscope.streaming.manifest import Table

from .edits import T0

COLUMNS = "start_time timestamp, end_time timestamp, title string, total_edits bigint"


def rows_of(spark, batch, titles, edits=None, at=None):
    end = T0 + dt.timedelta(minutes=batch if at is None else at)
    data = [(end - dt.timedelta(minutes=5), end, t, edits if edits is not None else batch) for t in titles]
    return spark.createDataFrame(data, COLUMNS)


def plain_table(path, **options):
    return Table(str(path), COLUMNS, ("start_time", "end_time"), **options)


def seen(spark, table):
    return sorted((r.title, r.total_edits, r.batch_id) for r in table.read(spark).collect())


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_readers_see_whole_commits_only(spark, tmp_path, fmt):
    table = plain_table(tmp_path / "t", fmt=fmt)
    assert table.read(spark).count() == 0 and table.read(spark).columns[-2:] == ["run_id", "batch_id"]
    table.commit(rows_of(spark, 0, "ab"), "r", 0)
    before = table.read(spark)
    # a repeated batch that stops before it publishes: files are there, readers see the old rows
    table._save(rows_of(spark, 0, "xyz"), f"{table.path}/run_id=r/batch_id=0/attempt=9")
    assert seen(spark, table) == [("a", 0, 0), ("b", 0, 0)]
    # one that publishes replaces them, and who read before still can
    table.commit(rows_of(spark, 0, "abc"), "r", 0)
    assert seen(spark, table) == [("a", 0, 0), ("b", 0, 0), ("c", 0, 0)]
    assert sorted(r.title for r in before.collect()) == ["a", "b"]
    table.commit(rows_of(spark, 0, "z"), "other", 0)
    assert table.read(spark).filter("run_id = 'other'").count() == 1


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_levels_keep_every_row(spark, tmp_path, fmt):
    table = plain_table(tmp_path / "t", fmt=fmt, fan=2)
    odd = 'q"uo,te\n\\n NA'
    for batch in range(8):
        table.commit(rows_of(spark, batch, ["a", odd]), "r", batch)
        table.compact(spark, "r", batch)
    entries = table.entries(spark)
    assert len({e.commit for e in entries}) <= 4 and max(e.level for e in entries) >= 2
    assert seen(spark, table) == sorted((t, b, b) for b in range(8) for t in ("a", odd))
    # the batch in hand is never put together, so a repeat replaces it
    table.commit(rows_of(spark, 7, ["new"]), "r", 7)
    assert ("new", 7, 7) in seen(spark, table) and ("a", 7, 7) not in seen(spark, table)
    # a repeat of one that was covered long ago changes nothing
    table.commit(rows_of(spark, 0, ["late"]), "r", 0)
    assert "late" not in [t for t, _, _ in seen(spark, table)]


def test_a_stopped_compaction_leaves_the_table(spark, tmp_path, monkeypatch):
    table = plain_table(tmp_path / "t", fan=2)
    for batch in range(4):
        table.commit(rows_of(spark, batch, "ab"), "r", batch)
    want = seen(spark, table)

    def stop(*_):
        raise RuntimeError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(Table, "_publish", stop)
        with pytest.raises(RuntimeError):
            table.compact(spark, "r", 4)
    assert seen(spark, table) == want
    assert table.compact(spark, "r", 4) >= 1
    assert seen(spark, table) == want and len(table.entries(spark)) == 1
    assert table.vacuum(spark, "1 hour") == 0
    gone = table.vacuum(spark, "0 seconds")
    assert gone >= 4 and seen(spark, table) == want
    assert len(table.published(spark)) == 1


def test_recent_rows_come_from_recent_files(spark, tmp_path):
    table = plain_table(tmp_path / "t", fan=100)
    for batch in range(20):
        table.commit(rows_of(spark, batch, "ab"), "r", batch)
    assert table.latest(spark, "end_time") == rows_of(spark, 19, "a").select(F.unix_micros("end_time")).first()[0]
    for interval in ("5 minutes", None):
        recent = table.since(spark, "end_time", interval)
        assert sorted(recent.collect()) == sorted(history.last_range(table.read(spark), "end_time", interval).collect())
    assert len(table.since(spark, "end_time", "5 minutes").inputFiles()) <= 6 * 2
    assert plain_table(tmp_path / "none").since(spark, "end_time", "1 hour").count() == 0


def test_newest_points_read_a_bounded_number_of_files(spark, tmp_path):
    table = Table(str(tmp_path / "p"), schemas.POINT_ROWS, ("ts",), fan=8)
    rng = random.Random(1)
    for batch in range(24):
        data = [(batch * 10 + k, T0 + dt.timedelta(seconds=batch * 10 + rng.uniform(0, 25)), 1.0, 2.0, "en") for k in range(10)]
        table.commit(spark.createDataFrame(data, schemas.POINT_ROWS).coalesce(1), "r", batch)
    whole = table.read(spark).orderBy(F.desc("ts"), F.desc("event_id"))
    for n in (1, 25, 10_000):
        got = table.newest(spark, "ts", n).orderBy(F.desc("ts"), F.desc("event_id")).limit(n)
        assert got.collect() == whole.limit(n).collect()
    assert len(table.newest(spark, "ts", 25).inputFiles()) <= 8
    table.compact(spark, "r", 24)
    assert len(table.entries(spark)) < 9
    assert table.newest(spark, "ts", 25).orderBy(F.desc("ts"), F.desc("event_id")).limit(25).collect() == whole.limit(25).collect()


def test_answers_kept_up_equal_the_whole_history(spark, tmp_path):
    """Batches in any order; what is put together are batches of which no earlier one is still to come."""
    rng = random.Random(5)
    tables = pipeline.result_tables(str(tmp_path))
    whole, best, last = tables["edit_wars"], tables["edit_wars_peaks"], tables["edit_wars_latest"]
    shape = partial(spark.createDataFrame, schema=schemas.WAR_ROWS)
    order = list(range(9))
    rng.shuffle(order)
    for place, batch in enumerate(order):
        data = []
        for title in rng.sample("abcdef", 3):
            start = T0 + dt.timedelta(minutes=rng.randint(0, 4))
            edits = rng.randint(1, 5)
            data.append((start, start + dt.timedelta(minutes=5), title, edits, 2, "u, v", None, batch, 1))
        rows = shape({(r[0], r[2]): r for r in data}.values())
        for table in (whole, best, last):
            table.commit(rows, "r", batch)
            if place % 4 == 3:
                Table(table.path, table.schema, table.zone, table.merge, fan=2).compact(spark, "r", min(order[place + 1 :]))
    kept = whole.read(spark)
    assert kept.select("batch_id").distinct().count() == 9
    assert any(e.level for table in (whole, best, last) for e in table.entries(spark))
    peaks = history.peaks(kept, ["title"], [*history.WAR_ORDER, "run_id"])
    versions = history.latest_versions(kept, ["start_time", "title"], ["run_id", "batch_id"])
    names = kept.columns
    assert sorted(map(repr, best.read(spark).select(names).collect())) == sorted(map(repr, peaks.select(names).collect()))
    assert sorted(map(repr, last.read(spark).select(names).collect())) == sorted(map(repr, versions.select(names).collect()))


def test_an_answer_reads_one_large_level_and_the_new_commits(spark, tmp_path):
    best = Table(str(tmp_path / "p"), COLUMNS, ("end_time",), partial(history.peaks, keys=["title"], order=["total_edits", "batch_id"]), fan=3)
    for batch in range(10):
        best.commit(rows_of(spark, batch, "abc").coalesce(1), "r", batch)
        best.compact(spark, "r", batch)
    entries = best.entries(spark)
    assert len(entries) <= 6 and sum(e.rows for e in entries) <= 3 * len(entries)
    assert {(r.title, r.total_edits) for r in best.read(spark).collect()} == {(t, 9) for t in "abc"}
    assert len(best.read(spark).inputFiles()) == len(entries)


def test_ranges_of_attempts():
    def e(level, lo, hi, attempt, run="r"):
        return manifest.Entry(run, level, lo, hi, attempt, "t", f"{level}-{lo}-{hi}-{attempt}", 1, {}, {})

    files = [e(0, 1, 1, 5), e(0, 1, 1, 7), e(0, 2, 2, 6), e(1, 1, 2, 9), e(0, 3, 3, 8), e(0, 1, 1, 4, "q"), e(2, 0, 9, 1, "q")]
    assert [f.file for f in manifest.current(files)] == ["1-1-2-9", "0-3-3-8", "2-0-9-1"]
