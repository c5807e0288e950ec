import datetime as dt
import random
from collections import defaultdict

import pytest

from editscope.operators.rate import suspicious_flag

T0 = dt.datetime(2026, 5, 28, 18, 0, 0)
SCHEMA = "event_id bigint, user string, ts timestamp, is_bot boolean"


def edits(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def brute_force(rows, seconds, n):
    """The rule row by row: per user, edits in arrival order, trailing window with a strict edge."""
    times, flags = defaultdict(list), {}
    for i, user, ts, bot in sorted(rows, key=lambda r: (r[2] or T0, r[0])):
        if bot or user is None or ts is None:
            flags[i] = False
            continue
        kept = [t for t in times[user] if t > ts - dt.timedelta(seconds=seconds)] + [ts]
        times[user] = kept
        flags[i] = len(kept) >= n
    return flags


def flags(df):
    return {r.event_id: r.is_suspicious for r in df.select("event_id", "is_suspicious").collect()}


def test_tenth_edit_within_a_minute(spark):
    rows = [(i, "u", at(i), False) for i in range(10)]
    got = flags(suspicious_flag(edits(spark, rows)))
    assert got == {**{i: False for i in range(9)}, 9: True}


def test_edge_is_strict(spark):
    inside = [(i, "in", at(i * 59.999999 / 9), False) for i in range(10)]
    edge = [(100 + i, "edge", at(i * 60 / 9), False) for i in range(9)] + [(109, "edge", at(60), False)]
    got = flags(suspicious_flag(edits(spark, inside + edge)))
    assert got[9] is True and got[109] is False


def test_equal_times_follow_the_id(spark):
    got = flags(suspicious_flag(edits(spark, [(i, "u", T0, False) for i in range(12)])))
    assert [got[i] for i in range(12)] == [False] * 9 + [True] * 3


def test_bots_and_incomplete_rows_are_kept_unflagged(spark):
    rows = [(i, "bot", at(i), True) for i in range(20)]
    rows += [(100 + i, None, at(i), False) for i in range(20)]
    rows += [(200 + i, "late", None, False) for i in range(20)]
    rows += [(300 + i, "u", at(i), None) for i in range(10)]
    got = flags(suspicious_flag(edits(spark, rows)))
    assert len(got) == 70
    assert [i for i, f in got.items() if f] == [309]


def test_n_of_one_flags_every_tracked_edit(spark):
    rows = [(1, "u", T0, False), (2, "u", T0, True), (3, None, T0, False)]
    assert flags(suspicious_flag(edits(spark, rows), n=1)) == {1: True, 2: False, 3: False}


def test_an_existing_column_is_replaced(spark):
    rows = [(1, "u", T0, False, True)]
    df = suspicious_flag(edits(spark, rows, SCHEMA + ", is_suspicious boolean"))
    assert df.columns == ["event_id", "user", "ts", "is_bot", "is_suspicious"]
    assert flags(df) == {1: False}


def random_rows(seed, count=3000):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        user = "hot" if rng.random() < 0.4 else f"u{rng.randrange(40)}"
        # A third of the hot account's edits share a few instants; some lie before the epoch.
        second = rng.choice([0, 59, 60, 61, 3600]) if user == "hot" and rng.random() < 0.5 else rng.uniform(0, 7200)
        base = dt.datetime(1969, 12, 31, 23, 0) if seed % 2 else T0
        rows.append((i, user, base + dt.timedelta(seconds=second), user.endswith("7")))
    return rows


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("hot_rows,max_hot", [(1_000_000, 100), (12, 1000), (25, 3)])
def test_like_brute_force_with_and_without_thinning(spark, seed, hot_rows, max_hot):
    rows = random_rows(seed)
    n, seconds = (3, 60) if seed % 2 else (10, 45)
    got = suspicious_flag(
        edits(spark, rows), seconds, n, hot_rows=hot_rows, max_hot=max_hot, cells_per_bucket=4, spread=8
    )
    assert flags(got) == brute_force(rows, seconds, n)


def test_ntz_times_in_any_session_zone(spark):
    rows = random_rows(2, 500)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = edits(spark, rows, SCHEMA.replace("ts timestamp", "ts timestamp_ntz"))
        assert flags(suspicious_flag(df, 60, 3, hot_rows=10)) == brute_force(rows, 60, 3)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
