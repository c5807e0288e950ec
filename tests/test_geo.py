import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from editscope.operators import geo

from .edits import edit, table

GEO = [("1.2.3.4", 10.0, 20.0), ("2001:db8::1", -5.0, 7.5)]


def dimension(spark, rows=GEO):
    return spark.createDataFrame(rows, "ip string, lat double, lon double")


def users(spark, *names):
    return table(spark, [edit(i, user=n, revision_id=i) for i, n in enumerate(names)])


NAMES = ("1.2.3.4", "1.2.3.4", "9.9.9.9", "2001:db8::1", "Alice", "Ns:Bob", None, "~2026-31790-93")


def test_every_edit_is_kept(spark):
    rows = geo.geo_enrich(users(spark, *NAMES), dimension(spark)).orderBy("event_id").collect()
    assert [r.lat for r in rows] == [10.0, 10.0, None, -5.0, None, None, None, None]
    assert [r.user for r in rows] == list(NAMES)


def test_shuffle_join_gives_the_same(spark):
    expected = geo.geo_enrich(users(spark, *NAMES), dimension(spark)).collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = geo.geo_enrich(users(spark, *NAMES), dimension(spark)).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(str, got)) == sorted(map(str, expected))


def test_missing(spark):
    got = geo.geo_missing(users(spark, *NAMES, "9.9.9.9"), dimension(spark)).collect()
    assert [r.ip for r in got] == ["9.9.9.9"]


def test_upsert_keeps_successes_only(spark):
    answers = spark.createDataFrame(
        [("1.2.3.4", "success", 1.0, 1.0), ("9.9.9.9", "success", 2.0, 2.0),
         ("8.8.8.8", "fail", None, None), ("2001:db8::1", "fail", 0.0, 0.0)],
        "ip string, status string, lat double, lon double",
    )
    got = sorted(map(tuple, geo.geo_upsert(dimension(spark), answers).collect()))
    assert got == [("1.2.3.4", 1.0, 1.0), ("2001:db8::1", -5.0, 7.5), ("9.9.9.9", 2.0, 2.0)]


def test_resolver_gets_bounded_chunks(spark):
    ips = spark.range(1, 251, numPartitions=2).select(F.format_string("10.0.0.%d", "id").alias("ip"))

    def resolver(names):
        assert 0 < len(names) <= 100
        return [(n, "success" if n.endswith("1") else "fail", float(len(names)), 0.0) for n in names]

    got = geo.resolve(ips, resolver)
    assert got.count() == 250
    assert got.filter("status = 'success'").count() == 25
    assert got.agg(F.max("lat")).first()[0] == 100.0


def brute_force(ips, nets):
    out = {}
    for text in ips:
        try:
            address = ipaddress.ip_address(text)
        except ValueError:
            continue
        hits = [n for n in nets if ipaddress.ip_network(f"{n[0]}/{n[1]}").version == address.version
                and address in ipaddress.ip_network(f"{n[0]}/{n[1]}")]
        if hits:
            out[text] = max(hits, key=lambda n: n[1])[1:]
    return out


def test_network_lookup_like_brute_force(spark):
    rng = random.Random(3)
    nets = {("0.0.0.0", 0): 0}
    for _ in range(60):
        length = rng.randrange(1, 33)
        start = ipaddress.ip_network((rng.getrandbits(32) & 0x0FFFFFFF, length), strict=False)
        nets[str(start.network_address), length] = 1
        length = rng.randrange(1, 129)
        six = rng.getrandbits(128) & ((1 << 122) - 1)
        start = ipaddress.ip_network((six, length), strict=False)
        if start.version == 6:
            nets[str(start.network_address), length] = 1
    rows = [(s, n, float(i), float(-i)) for i, (s, n) in enumerate(nets)]
    ips = [str(ipaddress.IPv4Address(rng.getrandbits(32) & 0x0FFFFFFF)) for _ in range(150)]
    ips += [str(ipaddress.IPv6Address(rng.getrandbits(122))) for _ in range(150)]
    for start, length, *_ in rows:
        net = ipaddress.ip_network(f"{start}/{length}")
        ips += [str(net[0]), str(net[-1])]
    ips += ["user_1", "1.2.3", ips[0]]
    got = geo.network_lookup(
        spark.createDataFrame([(i,) for i in ips], "ip string"),
        spark.createDataFrame(rows, "net_start string, prefix_len int, lat double, lon double"),
    )
    assert {r.ip: tuple(r)[1:] for r in got.collect()} == brute_force(ips, rows)
    assert got.count() == got.select("ip").distinct().count()


def test_network_lookup_without_networks(spark):
    ips = spark.createDataFrame([("1.2.3.4",)], "ip string")
    none = spark.createDataFrame([], "net_start string, prefix_len int, lat double, lon double")
    assert geo.network_lookup(ips, none).count() == 0


def addresses(spark, names):
    return spark.createDataFrame([(n,) for n in names], "ip string")


@pytest.mark.parametrize("family", [4, 6])
def test_intervals_against_all_pairs(spark, family):
    rng = random.Random(family)
    kind = ipaddress.IPv4Address if family == 4 else ipaddress.IPv6Address
    top = 2 ** (32 if family == 4 else 128) - 1
    base = int(kind("10.0.0.0" if family == 4 else "2001:db8::ffff:ffff:ffff:ff00"))

    def place():
        return rng.choice([base + rng.randint(0, 3000), base + rng.randint(0, 40), rng.randint(0, top), 0, top, base])

    ranges = [(str(kind(a)), str(kind(b)), float(k), 1.0) for k in range(150) for a, b in [sorted((place(), place()))]]
    ranges += [("10.0.0.9", "10.0.0.3", 0.0, 0.0), ("1.1.1.1", "::9", 0.0, 0.0), ("x", "10.0.0.1", 0.0, 0.0), (None, "10.0.0.1", 0.0, 0.0)]
    ranges += [ranges[3], (ranges[3][0], ranges[3][1], 999.0, 5.0)]
    names = sorted({str(kind(place())) for _ in range(300)} | {r[k] for r in ranges[:60] for k in (0, 1)})
    table = spark.createDataFrame(ranges, "net_start string, net_end string, lat double, lon double")
    got = geo.interval_lookup(addresses(spark, [*names, "no address", None]), table).collect()
    want = {}
    for name in names:
        value = int(kind(name))
        held = []
        for start, end, lat, lon in ranges:
            try:
                a, b = kind(start), kind(end)
            except ValueError:
                continue
            if a <= b and int(a) <= value <= int(b):
                held.append((int(a) - int(b), lat, lon, start, end))
        if held:
            _, lat, lon, start, end = max(held)
            want[name] = (start, end, lat, lon)
    assert {r.ip: (r.net_start, r.net_end, r.lat, r.lon) for r in got} == want and len(got) == len(want) > 100


def test_intervals_pair_nothing(spark):
    table = spark.createDataFrame([("10.0.0.1", "10.0.9.9", 1.0, 2.0)], "net_start string, net_end string, lat double, lon double")
    plan = geo.interval_lookup(addresses(spark, ["10.0.0.5"]), table)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert geo.interval_lookup(addresses(spark, []), table).count() == geo.interval_lookup(addresses(spark, ["10.0.0.5"]), table.limit(0)).count() == 0
