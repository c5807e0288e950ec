"""Questions on the result history: latest versions, peaks, ranges, rankings, key figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

WAR_ORDER = ["total_edits", "end_time", "start_time", "batch_id"]
EDITOR_ORDER = ["edit_count", "end_time", "start_time", "batch_id"]
TOPIC_ORDER = ["total_edits", "end_time", "start_time", "batch_id"]


def peaks(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is greatest by ``order``. An aggregation, so each task sends
    one row per key and a key with a large share of the history needs no sort."""
    best = F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("best")
    return rows.groupBy(*keys).agg(best).select("best.*")


def latest_versions(
    history: DataFrame, keys: list[str], version: list[str] | None = None
) -> DataFrame:
    """The last emitted row of each key of an update-mode history."""
    return peaks(history, keys, version or ["batch_id"])


def last_range(rows: DataFrame, column: str, interval: str | None) -> DataFrame:
    """Rows from ``interval`` before the latest time in the data on, that edge included; all
    rows for ``None``. The latest time is a scalar subquery over one column. Rows of a sink have
    the ``day`` of their end, a partition, and older days are not read."""
    if interval is None:
        return rows
    since = rows.agg(F.max(column)).scalar() - F.expr(f"interval {interval}")
    recent = rows.filter(F.col(column) >= since)
    # a row that starts or ends late enough ends on that day at the earliest
    return recent.filter(F.col("day") >= F.to_date(since)) if "day" in rows.columns else recent


def newest_first(rows: DataFrame, column: str = "end_time", *ties: str) -> DataFrame:
    return rows.orderBy(F.desc(column), *ties)


def war_peaks(history: DataFrame, interval: str | None = None) -> DataFrame:
    return peaks(last_range(history, "end_time", interval), ["title"], WAR_ORDER)


def editor_peaks(history: DataFrame, interval: str | None = None) -> DataFrame:
    return peaks(last_range(history, "start_time", interval), ["user"], EDITOR_ORDER)


def topic_peaks(history: DataFrame, interval: str | None = None) -> DataFrame:
    return peaks(last_range(history, "start_time", interval), ["topic"], TOPIC_ORDER)


def war_kpis(
    history: DataFrame, interval: str | None = None, run: list[str] | None = None
) -> DataFrame:
    """One row: batches of the whole history, conflicts and their largest size and reverts
    after peak deduplication, and rows in range. ``run`` names columns that tell runs apart
    whose batch numbers start again."""
    in_range = F.lit(True)
    if interval is not None:
        in_range = F.col("end_time") >= history.agg(F.max("end_time")).scalar() - F.expr(f"interval {interval}")
    batch = [*(run or []), "batch_id"]
    # One pass with two groupings: the peak of each title within range, and the distinct batches.
    facts = history.select("title", *batch, in_range.alias("inside"), F.struct(*WAR_ORDER).alias("place"), "total_edits", "reverts_count")
    peak = F.max_by(F.struct("total_edits", "reverts_count"), F.when(F.col("inside"), F.col("place")))
    grouped = facts.groupingSets([["title"], batch], "title", *batch).agg(
        F.grouping("title").alias("is_batch"), F.count_if("inside").alias("rows"), peak.alias("peak"),
        F.count("batch_id").alias("numbered"),
    )
    title = (F.col("is_batch") == 0) & (F.col("rows") > 0)
    return grouped.agg(
        F.count_if((F.col("is_batch") == 1) & (F.col("numbered") > 0)).alias("batches"),
        F.count_if(title).alias("conflicts"),
        F.coalesce(F.max(F.when(title, F.col("peak.total_edits"))), F.lit(0)).cast("bigint").alias("max_edits"),
        F.coalesce(F.sum(F.when(title, F.col("peak.reverts_count"))), F.lit(0)).cast("bigint").alias("reverts"),
        F.coalesce(F.sum(F.when(title, F.col("rows"))), F.lit(0)).cast("bigint").alias("rows_in_range"),
    )


def war_trend(history: DataFrame, interval: str | None = None) -> DataFrame:
    """Edits summed per window end over all rows in range, re-emitted versions included."""
    return (
        last_range(history, "end_time", interval)
        .groupBy("end_time")
        .agg(F.sum("total_edits").alias("total_edits"))
    )


def war_trend_latest(history: DataFrame, interval: str | None = None) -> DataFrame:
    """The same over the last version of each (window, title) only."""
    return war_trend(latest_versions(history, ["start_time", "title"]), interval)


def war_links(wars: DataFrame, site: Column | str = text.SITE) -> DataFrame:
    """The war table with article and comparison addresses."""
    return wars.select(
        "title", "total_edits", "reverts_count", "unique_users", "combatants",
        "latest_comment", "start_time",
        text.page_url("title", site).alias("url"),
        text.diff_url("latest_revision", site).alias("diff_url"),
    )


def _editor_class() -> Column:
    return text.editor_type("is_suspicious_flag", "is_bot_flag")


def editor_mix(peak_editors: DataFrame) -> DataFrame:
    """One row: humans, known bots, suspected bots."""
    kind = _editor_class()
    return peak_editors.agg(
        F.count_if(kind == text.HUMAN).alias("humans"),
        F.count_if(kind == text.BOT).alias("bots"),
        F.count_if(kind == text.SUSPECTED_BOT).alias("suspects"),
    )


def top_editors(peak_editors: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` users with the highest peak, with their class."""
    return (
        peak_editors.orderBy(F.desc("edit_count"), "user")
        .limit(k)
        .select("user", "edit_count", "avg_length_diff", "langs_edited", _editor_class().alias("typ"))
    )


def suspicious_accounts(peak_editors: DataFrame) -> DataFrame:
    return peak_editors.filter("is_suspicious_flag").select(
        "user", "edit_count", "avg_length_diff", "langs_edited"
    )


def top_topics(peak_topics: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` topics with the highest peak, smallest first as a bar list shows them."""
    return (
        peak_topics.orderBy(F.desc("total_edits"), "topic")
        .limit(k)
        .select("topic", "article_count", "total_edits", "sample_titles")
        .orderBy("total_edits", F.desc("topic"))
    )


def data_status(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, has_data) for each table; one row of a table is enough to know."""
    rows = [
        table.limit(1).agg((F.count("*") > 0).alias("has_data")).select(
            F.lit(name).alias("table_name"), "has_data"
        )
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)
