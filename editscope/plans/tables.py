"""The edit tables the registered queries run on, derived from the given ``events`` and
``pages`` tables by Spark."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ip, text
from ..functions.times import duration_micros, event_micros, floor_div
from ..operators import geo as geo_ops
from ..operators import live_map, rate, windows

WAR_WINDOW = ("1 hour", "15 minutes")
EDITOR_WINDOW = ("6 hours", "1 hour")
RATE = {"seconds": 6 * 3600, "n": 3}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _address(third: Column, fourth: Column) -> Column:
    return F.concat(F.lit("10.0."), third.cast("string"), F.lit("."), fourth.cast("string"))


def edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as edits. Columns a query does not use are pruned down to the scan; the JSON
    is read once per row, by a generator that filters on the title do not repeat."""
    events = read(spark, sf_dir, "events")
    k = F.col("k")
    prefix = F.when(k % 20 == 0, "Category:").when(k % 20 == 1, "Talk:").otherwise("")
    address = _address(F.expr("user_id div 256"), F.col("user_id") % 256)
    parsed = events.select("*", F.json_tuple("props", "k").alias("k_text")).withColumn(
        "k", F.col("k_text").cast("int")
    )
    return parsed.select(
        "event_id",
        "ts",
        F.when(F.col("user_id") % 5 == 1, address)
        .otherwise(F.concat(F.lit("user_"), F.col("user_id").cast("string")))
        .alias("user"),
        (F.col("user_id") % 10 == 0).alias("is_bot"),
        F.concat(
            prefix,
            F.lit("Topic"),
            (k % 10).cast("string"),
            F.when(k % 2 == 0, " ").otherwise("_"),
            F.lit("item "),
            k.cast("string"),
        ).alias("title"),
        F.element_at(F.array(*map(F.lit, ("en", "de", "pl", "commons"))), k % 4 + 1).alias("wiki_lang"),
        ((F.col("event_id") * 37) % 2001 - 1000).cast("int").alias("length_diff"),
        F.when(
            F.col("event_type") == "error",
            F.concat(F.lit("Reverted edit "), F.col("event_id").cast("string")),
        )
        .when(F.col("event_type") != "signup", F.concat("event_type", F.lit(" edit")))
        .alias("comment"),
        (F.lit(2147480000) + F.col("event_id")).alias("revision_id"),
        (F.col("event_id") % 5 == 0).alias("is_minor"),
        "event_type",
        "user_id",
    )


def landed(rows: DataFrame, name: str) -> DataFrame:
    """Rows written to the folder that the cluster shares and read again, as a running job lands
    its feed once. A temporary folder stands in only where the session names none."""
    path = f"{scratch(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def scratch(spark: SparkSession) -> str:
    return spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="editscope-")


def flagged_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate.suspicious_flag(edits(spark, sf_dir), **RATE)


def geo_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a resolver says about every address that edits: two of three are found."""
    who = F.col("user_id")
    return (
        edits(spark, sf_dir)
        .filter(ip.is_ip("user"))
        .select(F.col("user").alias("ip"), "user_id")
        .distinct()
        .select(
            "ip",
            F.when(who % 3 == 0, "fail").otherwise(geo_ops.SUCCESS).alias("status"),
            ((who * 7) % 180 - 90).cast("double").alias("lat"),
            ((who * 13) % 360 - 180).cast("double").alias("lon"),
        )
    )


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The address table: the successful answers."""
    return geo_answers(spark, sf_dir).filter(F.col("status") == geo_ops.SUCCESS).drop("status")


def ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges that are no prefixes, nested and overlapping: in every third octet one from .5 to .200, in even ones another
    from .17 to .99, and one from .250 on into the next octet."""
    block, number = F.expr("user_id div 256"), F.col("b")
    some = [
        (_address(number, F.lit(5)), _address(number, F.lit(200)), number, number * 2, F.lit(True)),
        (_address(number, F.lit(17)), _address(number, F.lit(99)), number + 1, number, number % 2 == 0),
        (_address(number, F.lit(250)), _address(number + 1, F.lit(30)), number, number + 2, F.lit(True)),
    ]
    each = F.array(*[
        F.struct(a.alias("net_start"), b.alias("net_end"), c.cast("double").alias("lat"), d.cast("double").alias("lon"), e.alias("there"))
        for a, b, c, d, e in some
    ])
    blocks = read(spark, sf_dir, "events").select(block.alias("b")).distinct()
    return blocks.select(F.inline(each)).filter("there").drop("there")


def networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested networks around the addresses of all users: the lower /25 of every third octet
    and, except in each third group of sixteen addresses, a /28. Some addresses have none."""
    block, last = F.expr("user_id div 256"), F.expr("user_id % 256")
    sixteen = F.expr("(user_id % 256) div 16")
    wide = F.struct(
        _address(block, F.lit(0)).alias("net_start"),
        F.lit(25).alias("prefix_len"),
        block.cast("double").alias("lat"),
        (block * 2).cast("double").alias("lon"),
    )
    narrow = F.struct(
        _address(block, sixteen * 16).alias("net_start"),
        F.lit(28).alias("prefix_len"),
        (block + 1).cast("double").alias("lat"),
        (last - last % 16).cast("double").alias("lon"),
    )
    nets = F.when(sixteen % 3 == 0, F.array(wide)).otherwise(F.array(wide, narrow))
    return (
        read(spark, sf_dir, "events")
        .select("user_id")
        .distinct()
        .select(F.explode(nets).alias("net"))
        .select("net.*")
        .distinct()
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content-page edits with coordinates."""
    rows = edits(spark, sf_dir).filter(text.is_content_title("title"))
    return live_map.map_points(geo_ops.geo_enrich(rows, geo(spark, sf_dir)))


# ---- result histories --------------------------------------------------------------------
#
# What update mode leaves behind when every micro-batch brings the edits of one slide: each
# window is emitted again after every batch that changed it, with all its edits so far. The
# batch number counts slides since the epoch.


def _replay(panes: DataFrame, size: str, slide: str) -> DataFrame:
    """Each pane row once for each (window, batch) that includes it."""
    step = F.expr(f"interval {slide}")
    later = F.explode(F.sequence("pane", F.col("end_time") - step, step))
    return windows.in_windows(panes, size, slide).withColumn("seen_at", later)


def _history(totals: DataFrame, columns: list[str], slide: str) -> DataFrame:
    """Totals per (window, batch) whose batch changed them, flattened."""
    changed = totals.filter(F.col("newest_pane") == F.col("seen_at"))
    number = floor_div(event_micros(totals, "seen_at"), duration_micros(slide))
    return changed.select(
        "start_time",
        "end_time",
        *columns,
        number.alias("batch_id"),
    )


_BY = [*windows.STATIC_KEY, "seen_at"]


def _newest():
    return F.max("pane").alias("newest_pane")


def war_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, slide = WAR_WINDOW
    rows = edits(spark, sf_dir).filter(text.is_content_title("title"))
    totals = windows.war_totals(
        _replay(windows.war_panes(rows, size, slide), size, slide), _BY, _newest()
    ).filter(windows.war_condition())
    return _history(totals, windows.WAR_COLUMNS, slide)


def editor_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, slide = EDITOR_WINDOW
    rows = flagged_edits(spark, sf_dir).filter(text.is_content_title("title"))
    panes = windows.busy_editors(windows.editor_panes(rows, size, slide), size, 3)
    totals = windows.editor_totals(_replay(panes, size, slide), _BY, _newest()).filter(
        F.col("edit_count") >= 3
    )
    return _history(totals, windows.EDITOR_COLUMNS, slide)


def topic_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, slide = WAR_WINDOW
    rows = edits(spark, sf_dir).filter(text.is_content_title("title"))
    totals = windows.topic_totals(
        _replay(windows.topic_panes(rows, size, slide), size, slide), _BY, _newest()
    ).filter(F.col("article_count") >= 2)
    return _history(totals, windows.TOPIC_COLUMNS, slide)
