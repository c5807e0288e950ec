"""Coordinates for edits made from an IP address."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ip
from ..schemas import GEO, GEO_ANSWER

SUCCESS = "success"
CHUNK = 100


def geo_enrich(edits: DataFrame, geo: DataFrame, *, user: str = "user") -> DataFrame:
    """Left join of ``lat``/``lon``: every edit is kept, without coordinates where the user is
    no address or the address is unknown. ``geo`` has one row per ip.

    No broadcast hint: a small dimension is broadcast by its measured size, a large one is
    joined by shuffle with adaptive skew splitting. Edits whose user cannot be an address never
    match, so they go past the join and are not shuffled; ``edits`` is read for them a second
    time.
    """
    plain = edits.drop("lat", "lon")
    may_match = F.coalesce(ip.looks_like_ip(user), F.lit(False))
    places = geo.select(F.col("ip").alias("_key"), F.col("lat").cast("double"), F.col("lon").cast("double"))
    located = plain.filter(may_match).withColumn("_key", F.col(user)).join(places, "_key", "left").drop("_key")
    nowhere = F.lit(None).cast("double")
    return located.unionByName(plain.filter(~may_match).withColumns({"lat": nowhere, "lon": nowhere}))


def edit_ips(edits: DataFrame, user: str = "user") -> DataFrame:
    """The distinct addresses among the users, as ``ip``."""
    return edits.filter(ip.is_ip(user)).select(F.col(user).alias("ip")).distinct()


def geo_missing(edits: DataFrame, geo: DataFrame, user: str = "user") -> DataFrame:
    """The distinct addresses that ``geo`` does not have yet."""
    return edit_ips(edits, user).join(geo, "ip", "left_anti")


def geo_upsert(geo: DataFrame, answers: DataFrame) -> DataFrame:
    """``geo`` with the successful answers put in; an answer replaces the older row of its ip.
    Failures are not stored, so they are asked again."""
    known = geo.select("ip", "lat", "lon", F.lit(0).alias("age"))
    new = answers.filter(F.col("status") == SUCCESS).select("ip", "lat", "lon", F.lit(1).alias("age"))
    newest = F.max(F.struct("age", "lat", "lon")).alias("newest")
    return (
        known.unionByName(new).groupBy("ip").agg(newest).select("ip", "newest.lat", "newest.lon")
    )


def resolve(
    ips: DataFrame, resolver: Callable[[list[str]], list[tuple]], chunk: int = CHUNK
) -> DataFrame:
    """Ask ``resolver`` about the addresses, at most ``chunk`` per call.

    ``resolver`` takes a list of addresses and returns ``(ip, status, lat, lon)`` rows. It runs
    in the tasks, one Arrow batch at a time.
    """

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names = batch["ip"].tolist()
            for start in range(0, len(names), chunk):
                rows = resolver(names[start : start + chunk])
                yield pd.DataFrame(rows, columns=["ip", "status", "lat", "lon"])

    return ips.select("ip").mapInPandas(ask, GEO_ANSWER)


def empty_geo(spark) -> DataFrame:
    return spark.createDataFrame([], GEO)


def _network_key() -> list:
    length = F.col("prefix_len")
    return [
        "family",
        "prefix_len",
        ip.prefix_high(F.col("high"), length).alias("net_high"),
        ip.prefix_low(F.col("low"), length).alias("net_low"),
    ]


#: Networks up to this prefix length, at most 2 ** (length + 1) - 1 a family, are looked up in a
#: broadcast table: a handful of keys would gather all addresses. Longer ones are shuffled.
SHORT_PREFIX = 12


def _by_prefix(numbered: DataFrame, nets: DataFrame, best: Column) -> DataFrame:
    """``best`` of the networks (family, prefix_len, net_high, net_low and more) that hold each address, by equality on
    every prefix length that occurs."""
    keys = ["family", "prefix_len", "net_high", "net_low"]
    short = F.col("prefix_len") <= SHORT_PREFIX

    def cut(wanted):
        v4, v6 = (
            nets.filter(wanted & (F.col("family") == family)).agg(F.collect_set("prefix_len")).scalar()
            for family in (4, 6)
        )
        each = F.explode(F.when(F.col("family") == 4, v4).otherwise(v6))
        return numbered.withColumn("prefix_len", each).select("ip", *_network_key())

    few = F.broadcast(nets.filter(short))  # bounded by the lengths
    found = cut(short).join(few, keys).unionByName(cut(~short).join(nets.filter(~short), keys))
    return found.groupBy("ip").agg(best.alias("best"))


def network_lookup(ips: DataFrame, networks: DataFrame) -> DataFrame:
    """The most specific network holding each address: ``ip, prefix_len, lat, lon``.

    ``networks`` has ``net_start`` (text), ``prefix_len``, ``lat``, ``lon``. Instead of a range
    comparison, each distinct address is cut to every prefix length that occurs in its family (33
    or 129 at most) and joined on equality, so the work is addresses times lengths and no group
    of addresses is ever paired with a group of networks. Of several rows of one network, the
    greatest (lat, lon) counts.
    """
    spans = ip.with_ip_number(networks, "net_start").filter(F.col("family").isNotNull())
    keys = ["family", "prefix_len", "net_high", "net_low"]
    place = F.max(F.struct("lat", "lon")).alias("place")
    nets = spans.select(*_network_key(), "lat", "lon").groupBy(*keys).agg(place)
    numbered = ip.with_ip_number(ips.select("ip").distinct(), "ip").filter(F.col("family").isNotNull())
    best = F.max(F.struct("prefix_len", "place.lat", "place.lon"))
    return _by_prefix(numbered, nets, best).select("ip", "best.prefix_len", "best.lat", "best.lon")


def _pieces(first: Column, last: Column) -> Column:
    """The prefixes, as texts of bits, that make up the range between two addresses given as texts of bits of one length.

    Both have a common prefix; there the first goes on with 0 and the last with 1. Left of the middle are the block of the
    first address (its trailing zeros are free) and, for every 0 of it, the block to the right of that; right of the
    middle it is the same with 1 and 0 exchanged. A range of one address is that address.
    """
    size = F.length(first)
    places = F.sequence(F.lit(1), size)
    common = F.coalesce(
        F.try_element_at(F.filter(places, lambda k: F.substring(first, k, F.lit(1)) != F.substring(last, k, F.lit(1))), F.lit(1)) - 1, size
    )

    def side(bits: Column, stay: str, turn: str) -> Column:
        kept = F.greatest(F.length(F.regexp_replace(bits, f"{stay}+$", "")), common + 1)
        inner = F.filter(places, lambda k: (k > common + 1) & (k <= kept) & (F.substring(bits, k, F.lit(1)) == stay))
        blocks = F.transform(inner, lambda k: F.concat(F.substring(bits, F.lit(1), k - 1), F.lit(turn)))
        return F.concat(blocks, F.array(F.substring(bits, F.lit(1), kept)))

    return F.when(common == size, F.array(first)).otherwise(F.concat(side(first, "0", "1"), side(last, "1", "0")))


def interval_lookup(ips: DataFrame, ranges: DataFrame) -> DataFrame:
    """The smallest range holding each address: ``ip, net_start, net_end, lat, lon``.

    ``ranges`` has ``net_start`` and ``net_end`` (texts, both belong to the range), ``lat``, ``lon``; ranges may be nested or
    overlap and need not be prefixes. A range is cut into the at most 254 prefixes that make it up, of equal prefixes the
    one of the smallest range stays, and addresses are looked up as in ``network_lookup``: no group of addresses is paired
    with a group of ranges. Of ranges of one size the greatest (lat, lon, net_start) counts. Ranges that end before they
    start, mix families or are no addresses hold nothing.
    """
    numbers = ["family", "high", "low"]
    begin = ip.with_ip_number(ranges.select("net_start", "net_end", "lat", "lon"), "net_start").withColumnsRenamed({c: f"s_{c}" for c in numbers})
    both = ip.with_ip_number(begin, "net_end").filter(F.col("family") == F.col("s_family"))

    def bits(high: str, low: str) -> Column:
        whole = F.concat(F.lpad(F.bin(high), 64, "0"), F.lpad(F.bin(low), 64, "0"))
        return F.substring(whole, F.lit(1), F.when(F.col("family") == 4, 32).otherwise(128))

    def unsigned(name: str) -> Column:
        value = F.col(name).cast("decimal(21,0)")
        return F.when(value < 0, value + F.lit(str(1 << 64)).cast("decimal(21,0)")).otherwise(value)

    high, low = unsigned("high") - unsigned("s_high"), unsigned("low") - unsigned("s_low")
    borrow = low < 0
    extent = F.struct(
        (high - F.when(borrow, 1).otherwise(0)).alias("high"),
        (low + F.when(borrow, F.lit(str(1 << 64)).cast("decimal(21,0)")).otherwise(F.lit(0).cast("decimal(21,0)"))).alias("low"),
    )
    sized = both.select(
        "family", "net_start", "net_end", "lat", "lon", extent.alias("extent"), bits("s_high", "s_low").alias("first"), bits("high", "low").alias("last")
    ).filter(F.col("first") <= F.col("last"))
    piece = sized.select("*", F.explode(_pieces(F.col("first"), F.col("last"))).alias("bits"))

    def half(start: int) -> Column:
        return F.conv(F.substring(F.rpad("bits", 128, "0"), start, 64), 2, -10).cast("bigint")

    keys = ["family", "prefix_len", "net_high", "net_low"]
    order = F.struct(
        (-F.col("extent.high")).alias("high"), (-F.col("extent.low")).alias("low"), "lat", "lon", "net_start", "net_end"
    )
    nets = piece.select(
        "family", F.length("bits").alias("prefix_len"), half(1).alias("net_high"), half(65).alias("net_low"), order.alias("place")
    ).groupBy(*keys).agg(F.max("place").alias("place"))
    numbered = ip.with_ip_number(ips.select("ip").distinct(), "ip").filter(F.col("family").isNotNull())
    return _by_prefix(numbered, nets, F.max("place")).select("ip", "best.net_start", "best.net_end", "best.lat", "best.lon")
