"""The keys with most edits of each window from mergeable counters: no row per key is kept, on tables or streams.

A counter set of frequent items (Spark's ``approx_top_k`` family) holds at most ``tracked`` keys. Tasks fill sets of their
own, sets of panes make those of windows, and on streams a window's state is one set. So a hot key or window moves
a few kilobytes for each task, and a top list needs no complete table of keys.

A set over n edits is at most ``max_error(n)`` off for any key. Keys with more than twice that are listed for certain, as
far as ``k`` goes; no key is listed that might not occur.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import windows

TRACKED = 1024
LEADER_COLUMNS = ["total_edits", "max_error", "leaders"]


def map_size(tracked: int) -> int:
    """Places of a counter set's table: the power of two that is three quarters full with ``tracked`` keys."""
    return 1 << math.ceil(math.log2(max(2, math.ceil(tracked / 0.75))))


def max_error(edits: Column, tracked: int) -> Column:
    """The most by which counts over ``edits`` edits are off: 3.5 times their number over the places of the table."""
    return F.floor(edits * 7 / (2 * map_size(tracked))).cast("bigint")


def leaders(
    edits: DataFrame,
    key: Column | str,
    size: str = windows.SIZE,
    slide: str = windows.SLIDE,
    *,
    k: int = 50,
    tracked: int = TRACKED,
    time_col: str = "ts",
    watermark: str = windows.WATERMARK,
) -> DataFrame:
    """One row per window: ``total_edits`` with a key, ``max_error``, and ``leaders``, at most ``k`` of (item, edits) with
    the greatest counts first. Edits without a key or a time are left out; a window without any has no row. Null counts
    as no key, an empty text as one like any other. ``k`` may not exceed ``tracked``.
    """
    if not 0 < k <= tracked:
        raise ValueError("k must lie between 1 and tracked")
    item = F.col(key) if isinstance(key, str) else key
    rows = edits.select(F.col(time_col), item.cast("string").alias("item")).filter(f"item IS NOT NULL AND `{time_col}` IS NOT NULL")
    counted = F.count("*").alias("total_edits")
    filled = F.expr(f"approx_top_k_accumulate(item, {tracked})").alias("counters")
    if edits.isStreaming:
        placed, by = windows._window_rows(rows, size, slide, time_col, watermark)
        found = placed.groupBy(*by).agg(counted, filled)
    else:
        panes = windows._panes(rows, size, slide, time_col, [], [counted, filled])
        merged = F.expr(f"approx_top_k_combine(counters, {tracked})").alias("counters")
        found = windows.in_windows(panes, size, slide).groupBy(*windows.STATIC_KEY).agg(F.sum("total_edits").alias("total_edits"), merged)
    best = F.transform(
        F.expr(f"approx_top_k_estimate(counters, {k})"), lambda e: F.struct(e["item"].alias("item"), e["count"].alias("edits"))
    )
    found = found.withColumns({"max_error": max_error(F.col("total_edits"), tracked), "leaders": best})
    return windows._flat(found, LEADER_COLUMNS)


def leader_rows(found: DataFrame) -> DataFrame:
    """The lists as rows: ``place`` (from 1; equal counts by item), ``item``, and the bounds ``at_least`` and ``at_most`` of
    its edits."""
    order = F.transform("leaders", lambda e: F.struct((-e["edits"]).alias("less"), e["item"].alias("item"), e["edits"].alias("edits")))
    rows = found.select("start_time", "end_time", "total_edits", "max_error", F.posexplode(F.sort_array(order)).alias("at", "e"))
    return rows.select(
        "start_time", "end_time", (F.col("at") + 1).alias("place"), F.col("e.item").alias("item"),
        F.greatest(F.col("e.edits") - F.col("max_error"), F.lit(1)).alias("at_least"),
        F.least("e.edits", "total_edits").alias("at_most"),
    )


def audit(edits: DataFrame, key: Column | str, found: DataFrame, size: str, slide: str, k: int, time_col: str = "ts") -> DataFrame:
    """Lists held against exact counts, for each window: ``certain``, keys with more than twice the error; ``missed``, those of
    them that are not listed though there is room; ``wrong``, listed keys whose count lies outside the bounds."""
    item = F.col(key) if isinstance(key, str) else key
    rows = edits.select(F.col(time_col), item.cast("string").alias("item")).filter(f"item IS NOT NULL AND `{time_col}` IS NOT NULL")
    panes = windows._panes(rows, size, slide, time_col, ["item"], [F.count("*").alias("edits")])
    exact = windows.in_windows(panes, size, slide).groupBy(*windows.STATIC_KEY, "item").agg(F.sum("edits").alias("edits"))
    listed = leader_rows(found).select(*windows.STATIC_KEY, "item", "at_least", "at_most")
    both = exact.join(listed, [*windows.STATIC_KEY, "item"], "full").join(
        found.select(*windows.STATIC_KEY, "total_edits", "max_error", F.size("leaders").alias("n")), windows.STATIC_KEY
    )
    certain = F.coalesce(F.col("edits") > 2 * F.col("max_error"), F.lit(False))
    held = F.coalesce(F.col("edits").between(F.col("at_least"), F.col("at_most")), F.lit(False))
    return both.groupBy(*windows.STATIC_KEY).agg(
        F.max("total_edits").alias("total_edits"),
        F.count_if(certain).alias("certain"),
        F.count_if(certain & F.col("at_least").isNull() & (F.col("n") < k)).alias("missed"),
        F.count_if(F.col("at_least").isNotNull() & ~held).alias("wrong"),
    )
