"""The rate flag on streams: per-user state instead of a lag window."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..functions.times import MICROS, duration_micros, event_micros, floor_div
from .state import plain_schema, plain_times, real_times, require_store

#: How long (on the clock of the job) a user's times are kept after the last edit.
IDLE = "10 minutes"


class RateFlags(StatefulProcessor):
    """The times of the last ``n - 1`` edits of a (user, bucket), forgotten ``idle`` after they were last written.

    Groups of edits that are never flagged (``bucket`` null) have no state; their rows go through one by one.
    """

    def __init__(self, span: int, n: int, id_col: str, columns: list[str], out: str, idle_ms: int):
        self.span, self.n, self.id_col, self.columns, self.out, self.idle_ms = span, n, id_col, columns, out, idle_ms

    def init(self, handle) -> None:
        self.times = handle.getListState("times", "us long", ttlDurationMs=self.idle_ms)

    def _row(self, row: Row, flag: bool) -> Row:
        return Row(*self.columns, self.out)(*[row[c] for c in self.columns], flag)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if key[1] is None:
            for row in rows:
                yield self._row(row, False)
            return
        held = sorted(rows, key=lambda r: (r["_us"], r[self.id_col] is not None, r[self.id_col]))
        before = [us for (us,) in self.times.get()]
        times = np.array(before + [r["_us"] for r in held], dtype="int64")
        flags = np.zeros(len(times), dtype=bool)
        n = self.n
        if len(times) >= n:
            flags[n - 1 :] = times[: len(times) - n + 1] > times[n - 1 :] - self.span
        if n > 1:
            kept = np.sort(times)[max(len(times) - (n - 1), 0) :]
            self.times.put([(us,) for us in kept.tolist()])
        for row, flag in zip(held, flags[len(before) :].tolist()):
            if row["_own"]:
                yield self._row(row, flag)


def suspicious_flag_stream(
    edits: DataFrame,
    seconds: int = 60,
    n: int = 10,
    *,
    user: str = "user",
    time_col: str = "ts",
    id_col: str = "event_id",
    bot_col: str = "is_bot",
    out: str = "is_suspicious",
    idle: str = IDLE,
    cells_per_bucket: int = 8,
) -> DataFrame:
    """Streaming form of ``suspicious_flag``: every edit comes out once, and edits that arrive in
    order get the same flags.

    As in the static form, a user's edits are split by time bucket, with the last ``seconds`` of
    a bucket copied into the next one, so a backlog of one busy user is worked off in parallel.
    The state of a (user, bucket) is the times of the last ``n - 1`` edits. Edits of one
    micro-batch are ordered by (time, id); a late edit, however late, is judged against the state
    and passed on. State goes once nothing has arrived for a bucket for ``idle``, by the store's own
    time to live: there is no watermark, so no edit can be behind it. Bots, unknown users and rows
    without a time are never flagged; they are spread over groups without state, so the source is
    read once.

    What one task holds is at most one bucket of one user out of one micro-batch, and the source
    bounds the bytes of a micro-batch (see ``sources.feed``).
    """
    spark = edits.sparkSession
    require_store(spark)
    columns = [c for c in edits.columns if c != out]
    plain = plain_times(edits.select(*columns))
    us = event_micros(edits, time_col)
    tracked = ~F.coalesce(F.col(bot_col), F.lit(False)) & F.col(user).isNotNull() & us.isNotNull()
    span = seconds * MICROS
    cell = floor_div(F.col("_us"), span)
    home = floor_div(cell, cells_per_bucket)
    last_cell = F.pmod(cell, F.lit(cells_per_bucket)) == cells_per_bucket - 1
    none = F.lit(None).cast("long")
    spread = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    free = F.concat(F.lit("free-"), F.pmod(F.xxhash64(id_col, F.col("_us")), F.lit(spread)).cast("string"))
    buckets = F.when(~F.col("_tracked"), F.array(none)).when(last_cell, F.array(home, home + 1)).otherwise(F.array(home))
    facts = edits.select(*columns, us.alias("_us"), tracked.alias("_tracked"))
    keyed = (
        plain_times(facts)
        .withColumn("_bucket", F.explode(buckets))
        .withColumn("_own", ~F.col("_tracked") | (F.col("_bucket") == home))
        .withColumn("_user", F.when(F.col("_tracked"), F.col(user)).otherwise(free))
    )
    kinds = plain_schema(plain.schema)
    schema = T.StructType([*edits.select(*columns).schema.fields, T.StructField(out, T.BooleanType())])
    processor = RateFlags(span, n, id_col, columns, out, duration_micros(idle) // 1000)
    flagged = keyed.groupBy("_user", "_bucket").transformWithState(
        processor, T.StructType([*kinds.fields, T.StructField(out, T.BooleanType())]), "Append", "ProcessingTime"
    )
    return real_times(flagged, schema).select(*columns, out)
