"""Edit wars and topic trends on streams with one state row per member.

The plain streaming aggregation keeps all users of a page, or all pages of a topic, in one cell of its state and writes
that cell anew for every edit. Here each member of a (window, key) is a row of its own in a map state beside a small row
of totals. An edit reads and writes those two, whatever the number of members, and the members are put into a list only
for rows that meet the conditions. State goes when the watermark passes the end of the window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions import text
from ..functions.times import event_micros
from ..operators.windows import SIZE, SLIDE, TOPIC_COLUMNS, WAR_COLUMNS, WATERMARK
from .state import require_store

TOTALS = "edits long, reverts long, members long, micros long, revision long, comment string"
OUT = f"start_us long, end_us long, key string, listed string, {TOTALS}"


def _newer(a: tuple, b: tuple) -> bool:
    """Whether (micros, revision, comment) ``a`` comes after ``b``; null is before everything."""
    return [(x is not None, x) for x in a] > [(x is not None, x) for x in b]


class MemberWindows(StatefulProcessor):
    """Totals and members of one (window, key). ``wanted`` decides on (edits, reverts, members) whether a row comes out."""

    def __init__(self, wanted: Callable[[int, int, int], bool], separator: str | None):
        self.wanted, self.separator = wanted, separator

    def init(self, handle) -> None:
        self.handle = handle
        self.members = handle.getMapState("members", "member string", "known boolean")
        self.totals = handle.getValueState("totals", TOTALS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        old = self.totals.get()
        edits, reverts, members, *latest = old or (0, 0, 0, None, None, None)
        seen, latest = set(), tuple(latest)
        for row in rows:
            edits += row.counts
            reverts += row.is_revert
            place = (row.micros, row.revision, row.comment)
            if _newer(place, latest):
                latest = place
            member = row.member
            if member is None or member in seen:
                continue
            seen.add(member)
            if not self.members.containsKey((member,)):
                self.members.updateValue((member,), (True,))
                members += 1
        if old is None:
            self.handle.registerTimer(key[1] // 1000)
        self.totals.update((edits, reverts, members, *latest))
        if self.wanted(edits, reverts, members):
            listed = None
            if self.separator is not None:
                listed = self.separator.join(sorted(m for (m,) in self.members.keys()))
            yield Row(
                start_us=key[0], end_us=key[1], key=key[2], listed=listed, edits=edits, reverts=reverts,
                members=members, micros=latest[0], revision=latest[1], comment=latest[2],
            )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.members.clear()
        self.totals.clear()
        return iter([])


def _windowed(
    edits: DataFrame, size: str, slide: str, watermark: str, time_col: str, key: Column, member: str, counts: Column,
    reverts: Column, latest: bool, processor: MemberWindows,
) -> DataFrame:
    if not edits.isStreaming:
        raise ValueError("the static operators are in operators.windows")
    require_store(edits.sparkSession)
    none = F.lit(None)
    # the window carries the watermark: rows go by the end of their window, as in the plain aggregation
    rows = edits.withWatermark(time_col, watermark).select(
        F.window(time_col, size, slide).alias("window"), key.alias("key"), F.col(member).alias("member"),
        counts.cast("long").alias("counts"), reverts.cast("long").alias("is_revert"),
        (event_micros(edits, time_col) if latest else none.cast("long")).alias("micros"),
        (F.col("revision_id").cast("long") if latest else none.cast("long")).alias("revision"),
        (F.col("comment") if latest else none.cast("string")).alias("comment"),
    )
    bounds = {"start_us": F.unix_micros(F.col("window.start")), "end_us": F.unix_micros(F.col("window.end"))}
    found = rows.withColumns(bounds).groupBy("start_us", "end_us", "key").transformWithState(processor, OUT, "Update", "EventTime")
    return found.withColumns({"start_time": F.timestamp_micros("start_us"), "end_time": F.timestamp_micros("end_us")})


def edit_wars(
    edits: DataFrame,
    size: str = SIZE,
    slide: str = SLIDE,
    *,
    min_edits: int = 2,
    min_reverts: int = 1,
    min_users: int = 1,
    revert_pattern: str = text.REVERT_PATTERN,
    lists: bool = True,
    time_col: str = "ts",
    watermark: str = WATERMARK,
) -> DataFrame:
    """The streaming form of ``windows.edit_wars``: same columns and conditions. Without ``lists`` nobody is listed
    (``combatants`` is null), and no cell grows with the users of a page."""

    def wanted(edits: int, reverts: int, members: int) -> bool:
        return edits >= min_edits and reverts >= min_reverts and (min_users <= 1 or members >= min_users)

    found = _windowed(
        edits, size, slide, watermark, time_col, F.col("title"), "user", F.col("user").isNotNull(),
        text.revert_flag("comment", revert_pattern), True, MemberWindows(wanted, ", " if lists else None),
    )
    named = {
        "title": "key", "total_edits": "edits", "unique_users": "members", "combatants": "listed",
        "latest_comment": "comment", "latest_revision": "revision", "reverts_count": "reverts",
    }
    return found.select("start_time", "end_time", *[F.col(named[c]).alias(c) for c in WAR_COLUMNS])


def topic_trends(
    edits: DataFrame,
    size: str = SIZE,
    slide: str = SLIDE,
    *,
    min_articles: int = 2,
    separators: str = "[ _]",
    lists: bool = True,
    time_col: str = "ts",
    watermark: str = WATERMARK,
) -> DataFrame:
    """The streaming form of ``windows.topic_trends``: same columns and condition. Without ``lists`` no titles are listed."""
    found = _windowed(
        edits, size, slide, watermark, time_col, text.topic_key("title", separators), "title", F.lit(1), F.lit(0), False,
        MemberWindows(lambda edits, reverts, members: members >= min_articles, " | " if lists else None),
    )
    named = {"topic": "key", "article_count": "members", "total_edits": "edits", "sample_titles": "listed"}
    return found.select("start_time", "end_time", *[F.col(named[c]).alias(c) for c in TOPIC_COLUMNS])
