"""What the stateful processors share: the state store they need, exact rows, runs that end."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Lists, maps and timers need this store. A query keeps the store it was first started with.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def require_store(spark: SparkSession) -> None:
    """``session.build_session`` sets the store; other sessions must do so themselves."""
    if spark.conf.get(PROVIDER, "") != STATE_STORE:
        raise ValueError(f"set {PROVIDER} to {STATE_STORE}")


def ends(trigger: dict) -> bool:
    """Whether a query with this trigger stops by itself once its input is read."""
    return bool(trigger.get("availableNow") or trigger.get("once"))


@contextmanager
def batches_for(spark: SparkSession, trigger: dict) -> Iterator[None]:
    """Start a query inside. Timers in processing time make Spark add empty micro-batches for ever, so a query that is to
    end when its input is read must not have them. A query keeps the setting it was started with."""
    before = spark.conf.get(EMPTY_BATCHES)
    if ends(trigger):
        spark.conf.set(EMPTY_BATCHES, "false")
    try:
        yield
    finally:
        spark.conf.set(EMPTY_BATCHES, before)


def plain_times(rows: DataFrame) -> DataFrame:
    """Timestamps as microseconds: Python rows would carry them in the machine's own time zone."""
    times = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return rows.withColumns({name: F.unix_micros(name) for name in times}) if times else rows


def plain_schema(schema: T.StructType) -> T.StructType:
    """The schema that ``plain_times`` gives."""
    kinds = [T.LongType() if isinstance(f.dataType, T.TimestampType) else f.dataType for f in schema.fields]
    return T.StructType([T.StructField(f.name, kind) for f, kind in zip(schema.fields, kinds)])


def real_times(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Back to the timestamps that ``schema`` has."""
    times = [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampType) and f.name in rows.columns]
    return rows.withColumns({name: F.timestamp_micros(name) for name in times}) if times else rows
