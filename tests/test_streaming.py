import datetime as dt
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from editscope import schemas
from editscope.operators import history as results
from editscope.operators import geo, normalize, rate, windows
from editscope.sources import feed, history
from editscope.streaming import pipeline, rate_state, sinks

from .edits import SCHEMA, at, edit, random_edits, table

NOW = {"availableNow": True}


class Landing:
    """A folder of Parquet files that a stream reads one file per micro-batch."""

    def __init__(self, spark, root):
        self.spark, self.path, self.root, self.files = spark, str(root / "in"), root, 0
        (root / "in").mkdir()

    def add(self, rows):
        part = f"{self.root}/part-{self.files}"
        table(self.spark, rows).coalesce(1).write.parquet(part)
        source = next(p for p in (self.root / f"part-{self.files}").iterdir() if p.name.endswith(".parquet"))
        target = self.root / "in" / f"{self.files:03d}.parquet"
        target.write_bytes(source.read_bytes())
        os.utime(target, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1

    def stream(self):
        return self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(self.path)


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


def run(stream, sink, checkpoint, mode="update"):
    query = pipeline.run_batches(stream, sink, str(checkpoint), mode, NOW)
    query.awaitTermination()
    return query


def latest(spark, path, keys):
    rows = spark.read.parquet(path)
    best = F.max_by(F.struct(*rows.columns), "batch_id").alias("r")
    return rows.groupBy(*keys).agg(best).select("r.*").drop("run_id", "batch_id")


def in_order(seed):
    return sorted(random_edits(seed, 240), key=lambda r: r[1])


def plain(df):
    return sorted(map(str, df.collect()))


CASES = [
    (windows.edit_wars, ["start_time", "title"]),
    (windows.super_editors, ["start_time", "user"]),
    (windows.topic_trends, ["start_time", "topic"]),
]


@pytest.mark.parametrize("operator,keys", CASES, ids=lambda c: getattr(c, "__name__", ""))
def test_stream_gives_the_batch_result(spark, landing, tmp_path, operator, keys):
    rows = in_order(11)
    for i in range(0, 240, 80):
        landing.add(rows[i : i + 80])
    result = operator(landing.stream())
    run(result, sinks.partition_sink(f"{tmp_path}/out", "r1"), tmp_path / "cp")
    expected = operator(table(spark, rows))
    assert result.columns == expected.columns
    got = latest(spark, f"{tmp_path}/out", keys).select(expected.columns)
    assert plain(got) == plain(expected)
    emitted = spark.read.parquet(f"{tmp_path}/out")
    assert emitted.count() > got.count()  # update mode emits grown windows again


def test_late_edits(spark, landing, tmp_path):
    landing.add([edit(1, 0, comment="undo"), edit(2, 1)])
    landing.add([edit(3, 200)])  # watermark still behind the first window
    landing.add([edit(4, 2), edit(5, 3600)])  # late but accepted, then far ahead
    landing.add([edit(8, 3602)])  # the batch that moves the watermark on
    landing.add([edit(6, 3), edit(7, 3601, ts=None)])  # below the watermark, and without a time
    wars = windows.edit_wars(landing.stream(), "1 minute", "1 minute", watermark="5 minutes")
    query = run(wars, sinks.partition_sink(f"{tmp_path}/out", "r"), tmp_path / "cp")
    totals = {r.batch_id: r.total_edits for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert sorted(totals.values()) == [2, 3]
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped == 1


def test_restart_goes_on_from_the_checkpoint(spark, landing, tmp_path):
    rows = in_order(12)
    landing.add(rows[:100])
    sink = sinks.partition_sink(f"{tmp_path}/out", "r")
    run(windows.super_editors(landing.stream()), sink, tmp_path / "cp")
    landing.add(rows[100:])
    run(windows.super_editors(landing.stream()), sink, tmp_path / "cp")
    expected = windows.super_editors(table(spark, rows))
    got = latest(spark, f"{tmp_path}/out", ["start_time", "user"])
    assert plain(got.select(expected.columns)) == plain(expected)


def test_failing_sink_stops_the_query_and_the_retry_replaces(spark, landing, tmp_path):
    landing.add([edit(1, 0, lat=1.0, lon=1.0), edit(2, 1, lat=1.0, lon=1.0)])
    write = sinks.partition_sink(f"{tmp_path}/out", "r")

    def torn(batch, batch_id):
        write(batch.limit(1), batch_id)
        raise RuntimeError("disk gone")

    with pytest.raises(Exception, match="disk gone"):
        run(landing.stream(), torn, tmp_path / "cp", "append")
    run(landing.stream(), write, tmp_path / "cp", "append")
    assert sorted(r.event_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2]


def test_sinks(spark, tmp_path):
    rows = table(spark, [edit(1), edit(2)])
    write = sinks.partition_sink(f"{tmp_path}/csv", "r", "csv", lambda d: d.select("event_id", "title"))
    write(rows, 3)
    write(rows, 3)
    write(rows.filter("false"), 4)
    got = spark.read.option("header", True).csv(f"{tmp_path}/csv")
    assert sorted(map(tuple, got.collect())) == [("1", "T", "r", 3), ("2", "T", "r", 3)]
    snapshot = sinks.snapshot_sink(f"{tmp_path}/snap")
    for batch, batch_id in ((rows, 0), (rows.filter("event_id = 2"), 1), (rows.filter("false"), 2)):
        snapshot(batch, batch_id)
    assert [r.event_id for r in spark.read.parquet(f"{tmp_path}/snap").collect()] == [2]


def test_csv_history_of_a_sink_reads_back(spark, landing, tmp_path):
    rows = in_order(16)
    landing.add(rows[:120])
    landing.add(rows[120:])
    run(windows.edit_wars(landing.stream()), sinks.partition_sink(f"{tmp_path}/out", "r7", "csv"), tmp_path / "cp")
    got = history.read_history(spark, f"{tmp_path}/out", schemas.EDIT_WARS, "start_time", "end_time")
    assert {r.run_id for r in got.collect()} == {"r7"} and got.filter("batch_id is null").count() == 0
    last = results.latest_versions(got, ["start_time", "title"], ["run_id", "batch_id"])
    expected = windows.edit_wars(table(spark, rows))
    assert plain(last.select(expected.columns)) == plain(expected)


def test_four_queries_from_landed_edits(spark, landing, tmp_path):
    rows = in_order(13)
    for i in range(0, 240, 120):
        landing.add(rows[i : i + 120])
    queries = pipeline.start_results(
        landing.stream(), f"{tmp_path}/out", f"{tmp_path}/cp", "r", top_editors=5, top_topics=3,
        aggregate_trigger=NOW, map_trigger=NOW,
    )
    assert len(queries) == 4
    for query in queries:
        query.awaitTermination()
        assert query.exception() is None
    counts = {
        name: spark.read.parquet(f"{tmp_path}/out/{name}").groupBy("batch_id").count().collect()
        for name in ("edit_wars", "super_editors", "topic_trends", "map_points")
    }
    assert all(r["count"] <= 5 for r in counts["super_editors"])
    assert all(r["count"] <= 3 for r in counts["topic_trends"])
    with_place = [r for r in rows if r[10] is not None and r[11] is not None]
    assert sum(r["count"] for r in counts["map_points"]) == len(with_place)
    assert counts["edit_wars"]


@pytest.mark.parametrize("seconds,n,per_bucket", [(60, 3, 2), (120, 5, 16), (10, 1, 4)])
def test_rate_flag_stream_gives_the_batch_flags(spark, landing, tmp_path, seconds, n, per_bucket):
    rows = in_order(14)
    for i in range(0, 240, 60):
        landing.add(rows[i : i + 60])
    flagged = rate_state.suspicious_flag_stream(landing.stream(), seconds, n, cells_per_bucket=per_bucket)
    run(flagged, sinks.partition_sink(f"{tmp_path}/out", "r"), tmp_path / "cp", "append")
    expected = rate.suspicious_flag(table(spark, rows), seconds, n)
    got = spark.read.parquet(f"{tmp_path}/out").select(expected.columns)
    assert plain(got) == plain(expected)
    assert expected.filter("is_suspicious").count() > 0


def test_rate_state_goes_when_nothing_arrives(spark, landing, tmp_path):
    landing.add([edit(i, i) for i in range(5)])
    for k, user in enumerate("vwx"):
        landing.add([edit(10 + k, 7200 * (k + 1), user=user)])
    flagged = rate_state.suspicious_flag_stream(landing.stream(), idle="1 millisecond")
    query = run(flagged, sinks.partition_sink(f"{tmp_path}/out", "r"), tmp_path / "cp", "append")
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 2
    assert spark.read.parquet(f"{tmp_path}/out").count() == 8


def test_rate_flag_stream_keeps_every_edit(spark, landing, tmp_path):
    landing.add([edit(1, 0), edit(2, 1), edit(3, 90_000)])
    landing.add([edit(4, 90_001)])
    landing.add([edit(5, 2), edit(6, 3, is_bot=True), edit(7, 0, ts=None), edit(8, 4, user=None)])  # days late
    flagged = rate_state.suspicious_flag_stream(landing.stream(), 60, 2)
    run(flagged, sinks.partition_sink(f"{tmp_path}/out", "r"), tmp_path / "cp", "append")
    got = {r.event_id: r.is_suspicious for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {1: False, 2: True, 3: False, 4: True, 5: True, 6: False, 7: False, 8: False}


def events_of(seed):
    """Feed events in order of time: wars, busy users, topics, a talk page and a category page."""
    rows = sorted(random_edits(seed, 200), key=lambda r: r[1])
    events = []
    for i, r in enumerate(rows):
        title = ["Talk:Hot page", "Category:A_1"][i % 2] if i % 9 == 0 else r[5]
        events.append({
            "type": "edit", "user": r[2] or "1.1.1.1", "title": title, "bot": r[3], "server_name": f"{r[6] or 'en'}.example.org",
            "length": {"old": 0, "new": r[7] or 0}, "comment": r[8], "revision": {"new": i}, "timestamp": 1_700_000_000 + int((r[1] - at(0)).total_seconds()),
        })
    return events


def test_feed_to_results_loses_and_doubles_nothing(spark, tmp_path):
    """Feed lines, flag, landing and the four results, with a batch of each result repeated after a failure."""
    feed_dir, silver = tmp_path / "feed", f"{tmp_path}/silver"
    feed_dir.mkdir()
    events = events_of(31)
    odd = [
        {"type": "edit", "user": "u1", "title": "A_1", "revision": {"new": 900}},  # without a time
        {"type": "edit", "user": "u1", "title": "A_1", "revision": {"new": 901}, "timestamp": 1_600_000_000},  # years late
        {"type": "edit", "user": "u2", "title": "A 3", "revision": {"new": 902}, "timestamp": 9_000_000_000_000_000_000,
         "length": {"old": -9_223_372_036_854_775_807, "new": 9_223_372_036_854_775_807}},
        {"type": "edit", "user": "u2", "title": "A 3", "revision": {"new": 903}, "timestamp": 1_700_000_900, "length": {"new": 3_000_000_000}},
    ]
    lines = lambda part: "".join(f"data: {json.dumps(e)}\n\n" for e in part)
    for k, part in enumerate([events[:80], events[80:] + odd]):
        (feed_dir / f"{k}.txt").write_text(lines(part))
        os.utime(feed_dir / f"{k}.txt", (1_700_000_000 + k, 1_700_000_000 + k))
        edits = normalize.parse_feed(feed.stream_text(spark, str(feed_dir)), F.lit(None).cast("timestamp"))
        pipeline.land(rate_state.suspicious_flag_stream(edits), silver, f"{tmp_path}/cp-land", NOW).awaitTermination()
    landed = spark.read.parquet(silver)
    assert landed.count() == 204
    assert {r.revision_id for r in landed.filter("ts is null").collect()} == {900, 902}
    assert landed.filter("revision_id in (902, 903) and length_diff is null").count() == 2
    def start(resolver):
        return pipeline.start_results(
            feed.stream_landed(spark, silver, landed.schema, 1024), f"{tmp_path}/out", f"{tmp_path}/cp", "r",
            watermark="1 hour", geo_path=f"{tmp_path}/geo", resolver=resolver, aggregate_trigger=NOW, map_trigger=NOW,
        )

    def fail(names):
        raise RuntimeError("no service")

    first = start(fail)
    for query in first[:3]:
        query.awaitTermination()
    with pytest.raises(Exception, match="no service"):
        first[3].awaitTermination()
    # the last batch of each result runs again: its commit is taken back
    for name in ("edit_wars", "super_editors", "topic_trends"):
        commits = tmp_path / "cp" / name / "commits"
        last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
        (commits / str(last)).write_text("")
        (commits / str(last)).unlink()
        for crc in commits.glob(f".{last}.crc"):
            crc.unlink()
    for query in start(lambda names: [(n, "success", 1.5, 2.5) for n in names]):
        query.awaitTermination()
    # events more than the watermark behind are dropped by the aggregates, and only those
    timed = landed.filter("ts >= timestamp'2023-01-01' and not startswith(title, 'Talk:') and not startswith(title, 'Category:')")
    for operator, name, keys in (
        (windows.edit_wars, "edit_wars", ["start_time", "title"]), (windows.super_editors, "super_editors", ["start_time", "user"]),
        (windows.topic_trends, "topic_trends", ["start_time", "topic"]),
    ):
        expected = operator(timed)
        got = latest(spark, f"{tmp_path}/out/{name}", keys).select(expected.columns)
        assert plain(got) == plain(expected), name
    points = pipeline.last_points(spark, f"{tmp_path}/out", 1000)
    want = landed.filter("user = '1.1.1.1' and not startswith(title, 'Talk:') and not startswith(title, 'Category:')")
    assert sorted(r.event_id for r in points.collect()) == sorted(r.event_id for r in want.collect())
    assert {(r.lat, r.lon) for r in points.collect()} == {(1.5, 2.5)}


def test_address_table_stays_small_and_newest_wins(spark, tmp_path):
    path = f"{tmp_path}/geo"
    pipeline.prepare_geo(spark, path)
    places = {}

    def resolver(names):
        return [(n, "success", places["lat"], 0.0) for n in names if n != "9.9.9.9"]

    for run_id, base in (("z", 0.0), ("a", 100.0)):
        write = pipeline.geo_sink(path, f"{tmp_path}/out", run_id, resolver, compact_after=4)
        for batch in range(12):
            places["lat"] = base + batch
            rows = [edit(1, user=f"1.1.{len(run_id)}.{batch}"), edit(2, user="9.9.9.9"), edit(3, user="Alice")]
            write(table(spark, rows if batch % 3 else rows[1:]), batch)
    folders = [p for p in (tmp_path / "geo").rglob("batch_id=*")]
    assert len(folders) <= 8
    got = {r.ip: r.lat for r in pipeline.read_geo(spark, path).collect()}
    assert got == {f"1.1.1.{b}": float(b) for b in range(12) if b % 3}
    # the run that sorts first by name stored last, and its answer counts
    for run_id, lat in (("z", 1.0), ("a", 2.0)):
        stored = spark.createDataFrame([("5.5.5.5", lat, 0.0)], schemas.GEO).withColumn("stored_at", F.current_timestamp())
        stored.write.parquet(f"{path}/run_id={run_id}-x/batch_id=99")
    assert pipeline.read_geo(spark, path, ips=spark.createDataFrame([("5.5.5.5",)], "ip string")).first().lat == 2.0


def test_feed_files_to_landed_edits_and_messages(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    events = [{"type": "edit", "user": f"u{i}", "title": "T", "timestamp": 1_700_000_000 + i} for i in range(5)]
    lines = ["event: message", "", "data: {bad"] + ["data: " + json.dumps(e) for e in events]
    (tmp_path / "feed" / "a.txt").write_text("\n".join(lines) + "\n")
    edits = normalize.parse_feed(feed.stream_text(spark, f"{tmp_path}/feed"))
    for stream, name in ((edits, "silver"), (normalize.encode_edits(edits), "messages"),
                         (normalize.raw_edit_log(edits), "raw")):
        pipeline.land(stream, f"{tmp_path}/{name}", f"{tmp_path}/cp-{name}", NOW).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/silver").count() == 5
    assert normalize.decode_edits(spark.read.parquet(f"{tmp_path}/messages")).count() == 5
    assert spark.read.parquet(f"{tmp_path}/raw").filter("category = 'ARTYKUŁ'").count() == 5


def test_resolving_asks_each_address_until_found(spark, landing, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()

    def resolver(names):
        (asked / uuid.uuid4().hex).write_text("\n".join(names))
        return [(n, "success" if n != "9.9.9.9" else "fail", 1.0, 2.0) for n in names]

    landing.add([edit(1, user="1.1.1.1"), edit(2, user="9.9.9.9"), edit(3, user="Alice"), edit(4, user="1.1.1.1")])
    landing.add([edit(5, user="1.1.1.1"), edit(6, user="9.9.9.9"), edit(7, user="2.2.2.2")])
    for _ in range(2):  # the second start finds nothing new
        pipeline.start_resolving(
            landing.stream(), f"{tmp_path}/geo", f"{tmp_path}/out", f"{tmp_path}/cp", "r", resolver, NOW
        ).awaitTermination()
    got = {r.event_id: r.lat for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {1: 1.0, 2: None, 3: None, 4: 1.0, 5: 1.0, 6: None, 7: 1.0}
    names = sorted(n for f in asked.iterdir() for n in f.read_text().split())
    assert names == ["1.1.1.1", "2.2.2.2", "9.9.9.9", "9.9.9.9"]
    assert pipeline.read_geo(spark, f"{tmp_path}/geo", "r", 99).count() == 2


def test_stream_joins_a_static_address_table(spark, landing, tmp_path):
    landing.add([edit(1, user="1.1.1.1"), edit(2, user="Alice"), edit(3, user="9.9.9.9")])
    places = spark.createDataFrame([("1.1.1.1", 1.0, 2.0)], schemas.GEO)
    located = geo.geo_enrich(landing.stream(), places)
    run(located, sinks.partition_sink(f"{tmp_path}/out", "r"), tmp_path / "cp", "append")
    assert {r.event_id: r.lat for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {1: 1.0, 2: None, 3: None}


def test_feed_to_located_messages(spark, tmp_path):
    """Feed lines, rate flag, addresses and messages as one running job."""
    (tmp_path / "feed").mkdir()
    events = [{"type": "edit", "user": u, "title": "T", "timestamp": 1_700_000_000 + i, "revision": {"new": i}}
              for i, u in enumerate(["1.1.1.1"] * 12 + ["Alice"] * 3)]
    (tmp_path / "feed" / "a.txt").write_text("".join(f"data: {json.dumps(e)}\n\n" for e in events))
    edits = normalize.parse_feed(feed.stream_text(spark, f"{tmp_path}/feed"))
    flagged = rate_state.suspicious_flag_stream(edits, id_col="revision_id")
    pipeline.start_resolving(
        flagged, f"{tmp_path}/geo", f"{tmp_path}/out", f"{tmp_path}/cp", "r",
        lambda names: [(n, "success", 5.0, 6.0) for n in names], NOW,
    ).awaitTermination()
    located = spark.read.parquet(f"{tmp_path}/out")
    decoded = normalize.decode_edits(normalize.encode_edits(located)).collect()
    assert len(decoded) == 15
    assert sorted(r.revision_id for r in decoded if r.editor_type == "SUSPECTED_BOT") == [9, 10, 11]
    assert {(r.user, r.lat) for r in decoded} == {("1.1.1.1", 5.0), ("Alice", None)}


def test_static_watermark_is_ignored(spark):
    rows = table(spark, random_edits(15)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert windows.edit_wars(rows).dtypes[0] == ("start_time", "timestamp_ntz")


def test_at_helper():
    assert at(60) - at(0) == dt.timedelta(minutes=1)


def test_rate_flag_stream_reads_its_source_once(spark, landing):
    landing.add([edit(1)])
    flagged = rate_state.suspicious_flag_stream(landing.stream())
    assert flagged._jdf.queryExecution().analyzed().toString().count("StreamingRelation") == 1


def test_rate_flag_keeps_large_ids_and_exact_values(spark, landing, tmp_path):
    rows = [edit(2**62 + k, k * 0.001, user=None if k % 2 else "u", length_diff=None if k % 3 else 5, revision_id=None) for k in range(40)]
    landing.add(rows)
    run(rate_state.suspicious_flag_stream(landing.stream()), sinks.partition_sink(f"{tmp_path}/out", "r"), tmp_path / "cp", "append")
    expected = rate.suspicious_flag(table(spark, rows))
    got = spark.read.parquet(f"{tmp_path}/out").select(expected.columns)
    assert plain(got) == plain(expected)


def test_results_are_tables_of_commits(spark, landing, tmp_path):
    rows = in_order(51)
    for i in range(0, 240, 60):
        landing.add(rows[i : i + 60])
    for query in pipeline.start_results(landing.stream(), f"{tmp_path}/out", f"{tmp_path}/cp", "r", aggregate_trigger=NOW, map_trigger=NOW):
        query.awaitTermination()
    tables = pipeline.result_tables(f"{tmp_path}/out")
    whole = tables["edit_wars"].read(spark)
    versions = results.latest_versions(whole, ["start_time", "title"], ["run_id", "batch_id"])
    expected = windows.edit_wars(table(spark, rows))
    assert plain(tables["edit_wars_latest"].read(spark).select(expected.columns)) == plain(expected) == plain(
        versions.select(expected.columns))
    peaks = results.peaks(whole, ["title"], [*results.WAR_ORDER, "run_id"])
    assert plain(tables["edit_wars_peaks"].read(spark).select(expected.columns)) == plain(peaks.select(expected.columns))
    assert plain(tables["topic_trends_latest"].read(spark).select(windows.topic_trends(table(spark, rows)).columns)) == plain(
        windows.topic_trends(table(spark, rows)))
    recent = tables["edit_wars"].since(spark, "end_time", "5 minutes")
    assert plain(recent) == plain(results.last_range(whole, "end_time", "5 minutes"))
    points = [r for r in rows if r[10] is not None and r[11] is not None]
    newest = sorted(points, key=lambda r: (r[1], r[0]))[-7:]
    assert [r.event_id for r in pipeline.last_points(spark, f"{tmp_path}/out", 7).collect()] == [r[0] for r in newest[::-1]]
