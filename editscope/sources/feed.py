"""Inputs of the edit stream: landed feed files, landed JSON messages, Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Rows or bytes one micro-batch may take in. The bound keeps every per-key state update of a
# micro-batch small, also when one account sends most of the edits. A file larger than the bound
# makes a micro-batch by itself.
MAX_OFFSETS_PER_TRIGGER = 5_000_000
MAX_BYTES_PER_TRIGGER = 1 << 30


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Landed feed or message files, one text line per row (``value``)."""
    return spark.read.text(path)


def stream_text(
    spark: SparkSession, path: str, max_bytes: int = MAX_BYTES_PER_TRIGGER
) -> DataFrame:
    """The same as an unbounded input: files are picked up as they land."""
    return spark.readStream.option("maxBytesPerTrigger", max_bytes).text(path)


def stream_landed(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    max_bytes: int = MAX_BYTES_PER_TRIGGER,
) -> DataFrame:
    """A table that ``pipeline.land`` writes, as an unbounded input. Only files in the table's log
    count, so a batch that landing repeats is read once."""
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", max_bytes).parquet(path)


def stream_kafka(
    spark: SparkSession,
    servers: str,
    topic: str = "wiki-edits",
    starting: str = "latest",
    max_offsets: int = MAX_OFFSETS_PER_TRIGGER,
) -> DataFrame:
    """Kafka messages (``value`` binary). Needs the Kafka connector of the Spark build.

    ``starting`` only counts for a query without a checkpoint; afterwards offsets resume.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
    )
