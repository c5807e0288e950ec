"""The buffer in front of the address service: when it is emptied, how often it calls, what a restart keeps."""

import time
import uuid

import pytest
from pyspark.sql import functions as F

from editscope import schemas
from editscope.streaming import pipeline, resolving, sinks
from editscope.streaming.resolving import Limits

from .edits import edit, table
from .test_streaming import NOW, Landing, plain

OFTEN = {"processingTime": "100 milliseconds"}


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


class Service:
    """Counts its calls in files, which tasks and test share."""

    def __init__(self, folder, missing=()):
        self.folder, self.missing = str(folder), set(missing)
        folder.mkdir()

    def __call__(self, names):
        with open(f"{self.folder}/{uuid.uuid4().hex}", "w") as call:
            call.write("\n".join([str(time.time()), *names]))
        return [(n, "fail" if n in self.missing else "success", float(len(n)), 2.0) for n in names]

    def calls(self):
        import pathlib

        read = [p.read_text().split() for p in pathlib.Path(self.folder).iterdir()]
        return sorted((float(c[0]), sorted(c[1:])) for c in read)


def start(landing, tmp_path, service, limits, trigger, known=None):
    located = resolving.locate(landing.stream(), service, limits, known)
    return pipeline.run_batches(located, sinks.partition_sink(f"{tmp_path}/out", "r"), f"{tmp_path}/cp", "append", trigger)


def found(spark, tmp_path):
    try:
        return {r.event_id: (r.lat, r._answered) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    except Exception:
        return {}


def until(query, ready, seconds=60):
    end = time.time() + seconds
    try:
        while not ready():
            assert query.exception() is None and time.time() < end
            time.sleep(0.1)
    finally:
        query.stop()


def test_waits_for_the_time_and_asks_once(spark, landing, tmp_path):
    service = Service(tmp_path / "calls")
    landing.add([edit(1, user="1.1.1.1"), edit(2, user="Alice"), edit(3, user="2.2.2.2"), edit(4, user="1.1.1.1"), edit(5, user=None)])
    query = start(landing, tmp_path, service, Limits(rows=1000, wait_ms=4000), OFTEN)
    began = time.time()
    passed = []
    until(query, lambda: passed.append((time.time(), set(found(spark, tmp_path)))) or len(passed[-1][1]) == 5)
    assert {2, 5} in [ids for _, ids in passed]  # logged-in users do not wait
    assert [names for _, names in service.calls()] == [["1.1.1.1", "2.2.2.2"]]
    assert service.calls()[0][0] - began > 2
    assert found(spark, tmp_path) == {1: (7.0, True), 2: (None, False), 3: (7.0, True), 4: (7.0, True), 5: (None, False)}


def test_enough_rows_do_not_wait(spark, landing, tmp_path):
    service = Service(tmp_path / "calls")
    landing.add([edit(k, user=f"1.1.1.{k}") for k in range(30)])
    query = start(landing, tmp_path, service, Limits(rows=30, wait_ms=3_600_000), OFTEN)
    until(query, lambda: len(found(spark, tmp_path)) == 30)
    assert len(service.calls()) == 1


@pytest.mark.parametrize("shards,calls", [(1, 2), (2, 4)])
def test_calls_are_limited_over_all_tasks(spark, landing, tmp_path, shards, calls):
    service = Service(tmp_path / "calls")
    landing.add([edit(k, user=f"1.1.1.{k}") for k in range(9)])
    limits = Limits(rows=1, wait_ms=0, calls=calls, per_ms=3000, chunk=1, shards=shards)
    query = start(landing, tmp_path, service, limits, OFTEN)
    until(query, lambda: len(found(spark, tmp_path)) == 9, 90)
    times = [at for at, _ in service.calls()]
    assert len(times) == 9 and sorted(n for _, names in service.calls() for n in names) == [f"1.1.1.{k}" for k in range(9)]
    for at in times:  # no span of that length has more calls
        assert sum(at <= other < at + 2.9 for other in times) <= calls


def test_restart_keeps_buffer_answers_and_calls(spark, landing, tmp_path):
    service = Service(tmp_path / "calls", missing=["9.9.9.9"])
    landing.add([edit(1, user="1.1.1.1"), edit(2, user="9.9.9.9"), edit(3, user="Alice")])
    start(landing, tmp_path, service, Limits(rows=3, wait_ms=3_600_000), NOW).awaitTermination()
    assert set(found(spark, tmp_path)) == {3} and not service.calls()
    landing.add([edit(4, user="2.2.2.2")])
    start(landing, tmp_path, service, Limits(rows=3, wait_ms=3_600_000), NOW).awaitTermination()
    assert found(spark, tmp_path) == {1: (7.0, True), 2: (None, False), 3: (None, False), 4: (7.0, True)}
    assert [names for _, names in service.calls()] == [["1.1.1.1", "2.2.2.2", "9.9.9.9"]]
    # what is known is not asked again, what is not is; the call before counts, so with one allowed it has to wait
    landing.add([edit(5, user="1.1.1.1"), edit(6, user="9.9.9.9")])
    one = Limits(rows=1, wait_ms=0, calls=1, per_ms=3_600_000)
    start(landing, tmp_path, service, one, NOW).awaitTermination()
    assert found(spark, tmp_path)[5] == (7.0, False) and 6 not in found(spark, tmp_path)
    landing.add([edit(7, user="Bob")])
    start(landing, tmp_path, service, Limits(rows=1, wait_ms=0), OFTEN).stop()
    assert len(service.calls()) == 1


def test_rows_are_as_they_came(spark, landing, tmp_path):
    rows = [edit(k, k * 0.25, user=["1.1.1.1", "::1", "u", None][k % 4], comment=None if k % 3 else "é\n", length_diff=None,
                 revision_id=2**60 + k) for k in range(40)]
    landing.add(rows)
    known = spark.createDataFrame([("::1", 5.0, 6.0)], schemas.GEO)
    start(landing, tmp_path, Service(tmp_path / "calls"), Limits(), {"availableNow": True}, known).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").filter("user is null or user != '1.1.1.1'")
    want = table(spark, rows).filter("user is null or user != '1.1.1.1'")
    want = want.withColumns({c: F.when(F.col("user") == "::1", v) for c, v in (("lat", F.lit(5.0)), ("lon", F.lit(6.0)))})
    assert plain(got.select(want.columns)) == plain(want)


def test_source_is_read_once(spark, landing):
    landing.add([edit(1)])
    located = resolving.locate(landing.stream(), lambda names: [], Limits())
    assert located._jdf.queryExecution().analyzed().toString().count("StreamingRelation") == 1


def test_limits_must_leave_each_shard_a_call():
    with pytest.raises(ValueError):
        Limits(calls=2, shards=3)
