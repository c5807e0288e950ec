"""From feed lines to the flat edit table and back to JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from ..functions import text
from ..schemas import EDIT, EDIT_FIELDS, RAW_CHANGE

DATA_PREFIX = "data: "
#: Seconds from the first to the last time that a timestamp can be printed as, years 1 to 9999.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def _fields(value: Column | str, schema: str) -> Column:
    """The parsed fields as columns. As a generator it parses each message once; behind a plain
    projection, every filter on a field would be pushed down together with its own parse."""
    return F.inline(F.array(F.from_json(value, schema)))


def _seconds(value: Column | str) -> Column:
    """A time from unix seconds; null where there is no such time."""
    seconds = F.col(value) if isinstance(value, str) else value
    return F.timestamp_seconds(F.when(seconds.between(FIRST_SECOND, LAST_SECOND), seconds))


def feed_payloads(lines: DataFrame) -> DataFrame:
    """The JSON of every data line; blank lines and other fields of the feed are skipped.

    Only the leading prefix goes: the same words inside the JSON stay.
    """
    return lines.filter(F.col("value").startswith(DATA_PREFIX)).select(
        F.substr("value", F.lit(len(DATA_PREFIX) + 1)).alias("value")
    )


def parse_changes(payloads: DataFrame, received_at: Column | None = None) -> DataFrame:
    """Edits out of raw change events: malformed rows, other types, and rows without a user
    or title are dropped; missing fields get their defaults.

    ``ts`` is the event's own time when it has one, else ``received_at`` (the current time).
    A length difference that is no 32-bit number is null; no line can stop the job.
    ``event_id`` is a hash of the event as it came, so a line that is read twice has one id.
    """
    raw = (
        payloads.select(F.xxhash64("value").alias("event_id"), _fields("value", RAW_CHANGE))
        .filter(F.col("type") == "edit")
        .dropna(subset=["user", "title"])
    )
    arrival = F.current_timestamp() if received_at is None else received_at
    length = F.try_subtract(F.coalesce("length.new", F.lit(0)), F.coalesce("length.old", F.lit(0)))
    return raw.select(
        "event_id",
        F.coalesce(_seconds("timestamp"), arrival).alias("ts"),
        "user",
        F.coalesce("bot", F.lit(False)).alias("is_bot"),
        "title",
        text.wiki_lang("server_name").alias("wiki_lang"),
        length.try_cast("int").alias("length_diff"),
        F.coalesce("comment", F.lit("")).alias("comment"),
        F.coalesce("revision.new", F.lit(0)).cast("bigint").alias("revision_id"),
        F.coalesce("minor", F.lit(False)).alias("is_minor"),
    )


def parse_feed(lines: DataFrame, received_at: Column | None = None) -> DataFrame:
    """Feed lines (``value``) to flat edits."""
    return parse_changes(feed_payloads(lines), received_at)


def encode_edits(edits: DataFrame, *keep: str) -> DataFrame:
    """Edits as JSON messages in ``value``. Nulls are written out; fields the edits lack are
    null. ``keep`` names columns to carry beside the message, such as a key."""
    known = edits.withColumn("time", F.date_format("ts", text.TIME_FORMAT))
    types = T.StructType.fromDDL(EDIT)
    fields = [
        F.col(name) if name in known.columns else F.lit(None).cast(types[name].dataType).alias(name)
        for name in EDIT_FIELDS
    ]
    message = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return known.select(*keep, message.alias("value"))


def decode_edits(messages: DataFrame, *keep: str) -> DataFrame:
    """JSON messages (``value``, text or binary) to the edit table with event time ``ts`` and
    ``editor_type``; category and talk pages, and rows without a title, are dropped.

    A field of the wrong type becomes null by itself. A time that does not parse is null.
    """
    edits = messages.select(*keep, _fields(F.col("value").cast("string"), EDIT))
    return (
        edits.filter(text.is_content_title("title"))
        .withColumn("ts", F.try_to_timestamp("time", F.lit(text.TIME_FORMAT)))
        .withColumn("editor_type", text.editor_type("is_suspicious", "is_bot"))
    )


def dead_letters(messages: DataFrame) -> DataFrame:
    """The messages that are not JSON at all, for counting or keeping aside."""
    parsed = F.from_json(
        F.col("value").cast("string"),
        EDIT + ", `_broken` string",
        {"columnNameOfCorruptRecord": "_broken"},
    )
    return messages.withColumn("_p", parsed).filter(
        "_p._broken is not null and _p.time is null and _p.title is null"
    ).drop("_p")


def raw_edit_log(edits: DataFrame) -> DataFrame:
    """The log of all edits with two-way editor class and page category."""
    return edits.select(
        F.col("ts").alias("time"),
        "user",
        "is_bot",
        "title",
        "length_diff",
        text.editor_type_v1("is_bot").alias("editor_type"),
        text.page_category("title").alias("category"),
    )
