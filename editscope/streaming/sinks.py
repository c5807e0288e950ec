"""Micro-batch sinks that can be run again without changing the result.

Each sink is a ``foreachBatch`` function. It overwrites the folder of its (run, batch), so a
batch repeated after a failure replaces itself. Nothing is caught: a failing write stops the
query, and the batch is repeated on restart from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.history import CSV_WRITE, packed

Sink = Callable[[DataFrame, int], None]


def batch_folder(path: str, run_id: str, batch_id: int) -> str:
    return f"{path}/run_id={run_id}/batch_id={batch_id}"


def partition_sink(
    path: str,
    run_id: str,
    fmt: str = "parquet",
    shape: Callable[[DataFrame], DataFrame] | None = None,
) -> Sink:
    """Write every non-empty micro-batch, after ``shape``, as partition (run_id, batch_id) and,
    for windowed rows, the ``day`` of their end, by which readers of recent results prune.

    Files are written by the tasks in parallel; reading ``path`` gives the ids back as columns.
    The folders are for static readers: a repeated batch replaces its files, which a stream that
    reads them would take for new ones. Streams start from a landed table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = (shape(batch) if shape else batch).persist()
        try:
            if not rows.isEmpty():
                _write(rows, batch_folder(path, run_id, batch_id), fmt)
        finally:
            rows.unpersist()

    return write


def snapshot_sink(path: str, fmt: str = "parquet") -> Sink:
    """Keep only the newest non-empty micro-batch: each one replaces the table at ``path``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            if not rows.isEmpty():
                _write(rows, path, fmt)
        finally:
            rows.unpersist()

    return write


def _write(rows: DataFrame, folder: str, fmt: str) -> None:
    dated = "end_time" in rows.columns and "day" not in rows.columns
    if dated:
        rows = rows.withColumn("day", F.to_date("end_time"))
    writer = (packed(rows) if fmt == "csv" else rows).write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(header=True, **CSV_WRITE)
    if dated:
        writer = writer.partitionBy("day")
    writer.save(folder)
