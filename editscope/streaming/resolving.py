"""Coordinates for the addresses of a running stream, asked from a service that limits its calls.

Edits by an address wait in a buffer until enough of them have come or the oldest has waited long enough; then their
addresses are asked, so many to a call and so many calls in a span of time. What is over the limit goes on waiting. The
buffer, the answers and the times of the calls are state, so a restart loses and repeats nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..functions import ip
from ..operators.geo import CHUNK, SUCCESS
from .state import plain_schema, plain_times, real_times, require_store

Resolver = Callable[[list[str]], list[tuple]]
APPEND = 100


@dataclass(frozen=True)
class Limits:
    """When the buffer is emptied, and how often the service may be called: ``calls`` in every ``per_ms``, ``chunk``
    addresses a call. The limits hold for all tasks together; ``shards`` divides the buffer and the calls evenly."""

    rows: int = 30
    wait_ms: int = 3000
    calls: int = 15
    per_ms: int = 60_000
    chunk: int = CHUNK
    shards: int = 1

    def __post_init__(self):
        if not 1 <= self.shards <= self.calls:
            raise ValueError("every shard needs a call of its own")


class Waiting(StatefulProcessor):
    """One shard of the buffer. Groups without an address (``shard`` null) have no state and pass their rows on."""

    def __init__(self, resolver: Resolver, limits: Limits, columns: list[str], fields: str, user: str):
        self.resolver, self.limits, self.columns, self.fields, self.user = resolver, limits, columns, fields, user

    def init(self, handle) -> None:
        self.handle = handle
        self.known = handle.getMapState("known", "ip string", "lat double, lon double")
        # rows that go on waiting are written to the other list, so that no list is held in memory
        self.sides = [handle.getListState(f"side{k}", self.fields) for k in (0, 1)]
        self.buffer = handle.getValueState("buffer", "side int, rows long, due long")
        self.called = handle.getListState("called", "ms long")

    def _row(self, values, place: tuple | None, answered: bool) -> Row:
        lat, lon = place or (None, None)
        return Row(*self.columns, "lat", "lon", "_answered")(*values, lat, lon, answered)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if key[1] is None:
            for row in rows:
                yield self._row([row[c] for c in self.columns], (row["lat"], row["lon"]), False)
            return
        side, count, due = self.buffer.get() or (0, 0, None)
        places: dict[str, tuple | None] = {}
        late: list[tuple] = []
        for row in rows:
            address, values = row[self.user], tuple(row[c] for c in self.columns)
            if address not in places:
                places[address] = self.known.getValue((address,))
            if places[address] is not None:
                yield self._row(values, places[address], False)
                continue
            late.append(values)
            count += 1
            if len(late) == APPEND:
                self.sides[side].appendList(late)
                late = []
        if late:
            self.sides[side].appendList(late)
        now = timerValues.getCurrentProcessingTimeInMs()
        if count and due is None:
            due = now + self.limits.wait_ms
            self.handle.registerTimer(due)
        self.buffer.update((side, count, due))
        if count >= self.limits.rows or (due is not None and now >= due):
            yield from self._flush(now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.buffer.get()
        now = timerValues.getCurrentProcessingTimeInMs()
        if held is not None and held[1] and held[2] is not None and now >= held[2]:
            yield from self._flush(now)

    def _flush(self, now: int) -> Iterator[Row]:
        limits = self.limits
        side, count, due = self.buffer.get()
        clock = max(now, int(time.time() * 1000))
        recent = [ms for (ms,) in self.called.get() if ms > clock - limits.per_ms]
        left = limits.calls // limits.shards - len(recent)
        if left > 0:
            user = self.columns.index(self.user)
            names: dict[str, tuple | None] = {}
            for values in self.sides[side].get():
                if len(names) >= left * limits.chunk:
                    break
                names[values[user]] = None
            asked = list(names)
            for start in range(0, len(asked), limits.chunk):
                answers = self.resolver(asked[start : start + limits.chunk])
                recent.append(int(time.time() * 1000))
                names.update({name: (lat, lon) for name, status, lat, lon in answers if status == SUCCESS and name in names})
            for name, place in names.items():
                if place is not None:
                    self.known.updateValue((name,), place)
            self.called.put([(ms,) for ms in recent])
            kept: list[tuple] = []
            count = 0
            for values in self.sides[side].get():
                if values[user] in names:
                    yield self._row(values, names[values[user]], names[values[user]] is not None)
                    continue
                kept.append(tuple(values))
                count += 1
                if len(kept) == APPEND:
                    self.sides[1 - side].appendList(kept)
                    kept = []
            if kept:
                self.sides[1 - side].appendList(kept)
            self.sides[side].clear()
            side = 1 - side
        due = None
        if count:  # over the limit: again when the oldest call is long enough ago
            due = min(recent) + limits.per_ms + 1 if recent else now + limits.wait_ms
            due = max(due, now + 1)
            self.handle.registerTimer(due)
        self.buffer.update((side, count, due))


def locate(
    edits: DataFrame, resolver: Resolver, limits: Limits = Limits(), known: DataFrame | None = None, user: str = "user"
) -> DataFrame:
    """Every edit once, with ``lat`` and ``lon``, and ``_answered``: whether the place was just given by the service.

    Edits whose user is no address pass at once and are spread over groups without state. So do those whose address is in
    ``known`` (ip, lat, lon), a table as it stood when the query was started. Answers are remembered and not asked again;
    an edit whose address has no answer comes out without a place, and later edits ask anew. The same address always goes
    to one shard, where its edits wait together.

    The calls of a task that fails are repeated with it and count once. ``resolver`` must not take longer than a task may.
    """
    spark = edits.sparkSession
    require_store(spark)
    columns = [c for c in edits.columns if c not in ("lat", "lon")]
    rows = edits.select(*columns)
    may_match = F.coalesce(ip.is_ip(user), F.lit(False))
    if known is None:
        nowhere = F.lit(None).cast("double")
        placed = rows.withColumns({"lat": nowhere, "lon": nowhere, "_known": F.lit(False)})
    else:
        places = known.select(
            F.col("ip").alias("_key"), F.col("lat").cast("double"), F.col("lon").cast("double"), F.lit(True).alias("_known")
        )
        placed = rows.withColumn("_key", F.when(may_match, F.col(user))).join(places, "_key", "left").drop("_key")
    waits = may_match & ~F.coalesce("_known", F.lit(False))
    spread = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    group = F.when(waits, F.lit(-1)).otherwise(F.pmod(F.xxhash64(*columns), F.lit(spread)).cast("int"))
    shard = F.when(waits, F.pmod(F.xxhash64(user), F.lit(limits.shards)).cast("int"))
    keyed = plain_times(placed.withColumns({"_group": group, "_shard": shard}))
    kinds = plain_schema(rows.schema)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds.fields)
    out = T.StructType([
        *kinds.fields, T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()),
        T.StructField("_answered", T.BooleanType()),
    ])
    found = keyed.groupBy("_group", "_shard").transformWithState(
        Waiting(resolver, limits, columns, fields, user), out, "Append", "ProcessingTime"
    )
    return real_times(found, rows.schema)
