"""What running queries leave out, as tables: rows behind the watermark, and messages that are no JSON."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.normalize import dead_letters
from .manifest import Table, table_sink
from .pipeline import MAP_TRIGGER, run_batches

LATE = "query_id string, query_name string, batch bigint, at timestamp, late_rows bigint"
BROKEN = "value string, read_at timestamp"


def late_table(output: str) -> Table:
    return Table(f"{output}/late_rows", LATE, ("at",))


def broken_table(output: str) -> Table:
    return Table(f"{output}/dead_letters", BROKEN, ("read_at",))


class LateRows(StreamingQueryListener):
    """Commits one row for each micro-batch of any query of the session in which rows were behind the watermark. Runs have
    numbers of their own, so a restart adds to what earlier runs reported. Rows are those of the stateful operator: an
    edit counts once for each of its windows, and edits that a task put together before count as one."""

    def __init__(self, spark: SparkSession, table: Table):
        self.spark, self.table = spark, table

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        late = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        if not late:
            return
        at = dt.datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
        row = (str(progress.id), progress.name, progress.batchId, at, late)
        self.table.commit(self.spark.createDataFrame([row], LATE).coalesce(1), str(progress.runId), progress.batchId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def watch(spark: SparkSession, output: str) -> LateRows:
    """Report late rows of all queries of the session below ``output`` until ``spark.streams.removeListener``."""
    listener = LateRows(spark, late_table(output))
    spark.streams.addListener(listener)
    return listener


def start_dead_letters(
    messages: DataFrame, output: str, checkpoint: str, run_id: str, trigger: dict = MAP_TRIGGER
) -> StreamingQuery:
    """Keep the messages (``value``) that are no JSON, which decoding drops, with the time they were read."""
    broken = dead_letters(messages).select(F.col("value").cast("string").alias("value"), F.current_timestamp().alias("read_at"))
    return run_batches(broken, table_sink([(broken_table(output), None)], run_id), checkpoint, "append", trigger)


def losses(spark: SparkSession, output: str) -> DataFrame:
    """(what, rows): late rows for each query, by name or else by id, and broken messages."""
    name = F.coalesce("query_name", "query_id")
    late = late_table(output).read(spark).groupBy(F.concat(F.lit("late: "), name).alias("what")).agg(F.sum("late_rows").alias("rows"))
    broken = broken_table(output).read(spark).agg(F.count("*").alias("rows")).select(F.lit("broken messages").alias("what"), "rows")
    return late.unionByName(broken)
