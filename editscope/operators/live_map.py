"""Points of the live map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: What a stored point has: its place and language, and what orders it.
POINT_COLUMNS = ("event_id", "ts", "lat", "lon", "wiki_lang")


def map_points(edits: DataFrame) -> DataFrame:
    """Edits that have both coordinates."""
    return edits.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())


def point_rows(edits: DataFrame) -> DataFrame:
    """Points as the map stores them."""
    return map_points(edits).select(*POINT_COLUMNS)


def rolling_points(
    points: DataFrame, n: int = 500, order: tuple[str, ...] = ("ts", "event_id")
) -> DataFrame:
    """The ``n`` newest points. A bounded top-k, not a sort of the table."""
    return points.orderBy(*[F.desc(c) for c in order]).limit(n)


def lang_counts(points: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` languages with most points; unknown languages do not count."""
    return (
        points.filter(F.col("wiki_lang").isNotNull())
        .groupBy("wiki_lang")
        .agg(F.count("*").alias("edits"))
        .orderBy(F.desc("edits"), "wiki_lang")
        .limit(k)
    )


def map_summary(points: DataFrame, as_of: Column, time_col: str = "ts") -> DataFrame:
    """One row: number of points and seconds from the newest point to ``as_of``."""
    age = F.unix_timestamp(as_of) - F.unix_timestamp(F.max(time_col))
    return points.agg(F.count("*").alias("points"), age.alias("age_seconds"))
