"""Result tables that are read by their commits.

A micro-batch writes its files into a folder of its own and then publishes them in a manifest, one small file that
appears as a whole. Readers take published files only, and of a repeated batch the newest attempt: they see its old rows
or its new ones, never none and never both. The manifest holds the least and greatest times of every file, so the latest
time of a table is known without reading it, and questions about recent rows open recent files.

Commits are put together in levels: once ``fan`` of a level are there they become one commit of the next, which covers
them. A table with a ``merge`` keeps, for each key, only what a later answer can need, so an answer reads one large level
and a few small ones, however many batches there were. Covered files stay for readers that have begun, until ``vacuum``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import duration_micros
from ..sources.history import CSV_READ, CSV_WRITE, packed, read_history

ROWS_PER_FILE = 5_000_000
IDS = "run_id string, batch_id bigint"


@dataclass(frozen=True)
class Entry:
    """A published file: the batches ``lo`` to ``hi`` of a run put together ``level`` times, and its rows and times."""

    run_id: str
    level: int
    lo: int
    hi: int
    attempt: int
    token: str
    file: str
    rows: int
    low: dict
    high: dict

    @property
    def commit(self) -> tuple:
        return self.run_id, self.level, self.lo, self.hi, self.attempt, self.token


@dataclass(frozen=True)
class Table:
    """A result table at ``path``: ``schema`` (DDL) of its rows, ``zone``, the timestamps whose range is kept for each
    file, and ``merge``, which reduces rows of several commits without changing any answer (None keeps all). Merging must
    not depend on the order or grouping of commits, and may repeat."""

    path: str
    schema: str
    zone: tuple[str, ...]
    merge: Callable[[DataFrame], DataFrame] | None = None
    fmt: str = "parquet"
    fan: int = 8

    # ---- commits -------------------------------------------------------------------------

    def commit(self, rows: DataFrame, run_id: str, batch_id: int) -> None:
        """Publish the rows of a micro-batch. Doing it again replaces them. Files lie in
        ``run_id=/batch_id=/attempt=`` folders."""
        attempt = time.time_ns()
        self._save(rows, f"{self.path}/run_id={run_id}/batch_id={batch_id}/attempt={attempt}")
        self._publish(rows.sparkSession, run_id, 0, batch_id, batch_id, attempt)

    def _save(self, rows: DataFrame, folder: str) -> None:
        writer = (packed(rows) if self.fmt == "csv" else rows).write.format(self.fmt)
        if self.fmt == "csv":
            writer = writer.options(header=True, **CSV_WRITE)
        writer.save(folder)

    def _folder(self, run_id: str, level: int, lo: int, hi: int, attempt: int) -> str:
        if level == 0:
            return f"{self.path}/run_id={run_id}/batch_id={lo}/attempt={attempt}"
        return f"{self.path}/_levels/{run_id}/{level}-{lo}-{hi}-{attempt}"

    def _publish(self, spark: SparkSession, run_id: str, level: int, lo: int, hi: int, attempt: int) -> None:
        folder = self._folder(run_id, level, lo, hi, attempt)
        if self.fmt == "csv":
            whole = self.schema if level == 0 else f"{self.schema}, {IDS}"
            stored = spark.read.schema(whole).options(**CSV_READ, header="true").csv(folder)
        else:
            stored = spark.read.schema(self.schema).parquet(folder)
        ranges = [
            f(F.unix_micros(F.col(c).cast("timestamp"))).alias(f"{c}_{n}") for c in self.zone for f, n in ((F.min, "low"), (F.max, "high"))
        ]
        facts = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"), *ranges)
        token = uuid.uuid4().hex
        labels = {"run_id": run_id, "token": token, "fmt": self.fmt}
        numbers = {"level": level, "lo": lo, "hi": hi, "attempt": attempt}
        row = facts.select(
            *[F.lit(v).alias(k) for k, v in labels.items()], *[F.lit(v).cast("long").alias(k) for k, v in numbers.items()],
            "file", "rows", *[f"{c}_{n}" for c in self.zone for n in ("low", "high")],
        )
        # one task, so one file, which the commit of the job moves into place at once
        row.coalesce(1).write.parquet(f"{self.path}/_manifest/{run_id}/{level}-{lo}-{hi}-{attempt}")

    def published(self, spark: SparkSession) -> list[Entry]:
        """Every published file, also of covered and replaced commits."""
        names = "run_id string, token string, fmt string, level long, lo long, hi long, attempt long, file string, rows long"
        zone = ", ".join(f"{c}_{n} long" for c in self.zone for n in ("low", "high"))
        try:
            rows = spark.read.schema(f"{names}, {zone}").option("recursiveFileLookup", "true").parquet(f"{self.path}/_manifest").collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return [
            Entry(
                r.run_id, r.level, r.lo, r.hi, r.attempt, r.token, r.file, r.rows,
                {c: r[f"{c}_low"] for c in self.zone}, {c: r[f"{c}_high"] for c in self.zone},
            )
            for r in rows
        ]

    def entries(self, spark: SparkSession) -> list[Entry]:
        """The files that make the table now: of each commit the newest attempt, without those that a higher one covers."""
        return current(self.published(spark))

    # ---- reading -------------------------------------------------------------------------

    def read(self, spark: SparkSession, entries: list[Entry] | None = None) -> DataFrame:
        """The rows of the published files (of ``entries``, if given), with ``run_id`` and ``batch_id``. A table without
        commits has no rows. ``merge`` is applied, so the answer does not depend on what was put together."""
        rows = self._rows(spark, self.entries(spark) if entries is None else entries)
        return self.merge(rows) if self.merge else rows

    def _rows(self, spark: SparkSession, entries: list[Entry]) -> DataFrame:
        whole = f"{self.schema}, {IDS}"
        names = T.StructType.fromDDL(whole).names
        low = [e.file for e in entries if e.level == 0]
        high = [e.file for e in entries if e.level > 0]
        parts = []
        if self.fmt == "csv":
            by_batch = {e.file: (e.run_id, e.lo) for e in entries if e.level == 0}
            batches: dict[tuple, list[str]] = {}
            for file, batch in by_batch.items():
                batches.setdefault(batch, []).append(file)
            for (run_id, batch_id), files in batches.items():
                rows = read_history(spark, files, self.schema, *self.zone)
                parts.append(rows.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("bigint")}))
            if high:
                parts.append(read_history(spark, high, whole, *self.zone))
        else:
            if low:
                parts.append(spark.read.schema(whole).option("basePath", self.path).parquet(*low))
            if high:
                parts.append(spark.read.schema(whole).parquet(*high))
        if not parts:
            return spark.createDataFrame([], whole)
        return reduce(DataFrame.unionByName, [p.select(*names) for p in parts])

    def latest(self, spark: SparkSession, column: str) -> int | None:
        """The greatest value of a zone column in microseconds, from the manifest alone."""
        return max((e.high[column] for e in self.entries(spark) if e.high[column] is not None), default=None)

    def since(self, spark: SparkSession, column: str, interval: str | None) -> DataFrame:
        """The rows from ``interval`` before the latest time on, that edge included, from the files that reach it; all
        rows for None. Equals ``history.last_range`` over the whole table."""
        entries = self.entries(spark)
        if interval is None:
            return self.read(spark, entries)
        latest = max((e.high[column] for e in entries if e.high[column] is not None), default=None)
        edge = latest - duration_micros(interval) if latest is not None else 0
        near = [e for e in entries if e.high[column] is not None and e.high[column] >= edge]
        return self.read(spark, near).filter(F.col(column) >= F.timestamp_micros(F.lit(edge)))

    def newest(self, spark: SparkSession, column: str, n: int) -> DataFrame:
        """The rows of files that hold the ``n`` newest by a zone column, and older ones. Files whose least time is late
        enough for them to have ``n`` rows together give a bound; files that end before it hold none of the newest."""
        entries = self.entries(spark)
        bound, rows = None, 0
        timed = [e for e in entries if e.low[column] is not None]
        for e in sorted(timed, key=lambda e: e.low[column], reverse=True):
            bound, rows = e.low[column], rows + e.rows
            if rows >= n:
                break
        if rows < n:
            return self.read(spark, entries)
        return self.read(spark, [e for e in timed if e.high[column] >= bound])

    # ---- upkeep --------------------------------------------------------------------------

    def compact(self, spark: SparkSession, run_id: str, before: int) -> int:
        """Put together the commits of a run, of batches before ``before``, level by level while there are ``fan`` of one.
        All these batches must be done: one that comes later counts as a repeat of what is covered. Returns how many commits were made. Stopped at any point it leaves a readable table: what is not published does
        not count, and what is covers its parts as a whole."""
        made, level = 0, 0
        while True:
            mine = [e for e in self.entries(spark) if e.run_id == run_id and e.hi < before]
            found = [e for e in mine if e.level == level]
            if len({e.commit for e in found}) < self.fan:
                if not any(e.level > level for e in mine):
                    return made
                level += 1
                continue
            lo, hi = min(e.lo for e in found), max(e.hi for e in found)
            rows = self._rows(spark, found)
            rows = self.merge(rows) if self.merge else rows
            files = sum(e.rows for e in found) // ROWS_PER_FILE + 1
            if files > 1 and self.zone:  # narrow ranges of time for each file
                rows = rows.repartitionByRange(files, *self.zone)
            else:
                rows = rows.coalesce(1)
            attempt = time.time_ns()
            self._save(rows, self._folder(run_id, level + 1, lo, hi, attempt))
            self._publish(spark, run_id, level + 1, lo, hi, attempt)
            made += 1
            level += 1

    def vacuum(self, spark: SparkSession, older_than: str = "1 hour") -> int:
        """Delete the folders of commits that are covered or replaced, once what took their place is older than
        ``older_than``, and their manifests. Returns their number. Deleting needs the file system of a classic session."""
        edge = time.time_ns() - duration_micros(older_than) * 1000
        published = self.published(spark)
        live = {e.commit for e in current(published)}
        gone = {
            e.commit for e in published
            if e.commit not in live and any(_takes_over(other, e) and other.attempt < edge for other in published)
        }
        for run_id, level, lo, hi, attempt, _ in sorted(gone):
            delete_folder(spark, self._folder(run_id, level, lo, hi, attempt))
            delete_folder(spark, f"{self.path}/_manifest/{run_id}/{level}-{lo}-{hi}-{attempt}")
        return len(gone)


def _takes_over(new: Entry, old: Entry) -> bool:
    if new.run_id != old.run_id:
        return False
    if (new.level, new.lo, new.hi) == (old.level, old.lo, old.hi):
        return (new.attempt, new.token) > (old.attempt, old.token)
    return new.level > old.level and new.lo <= old.lo and old.hi <= new.hi


def current(published: list[Entry]) -> list[Entry]:
    """See ``Table.entries``."""
    newest: dict[tuple, tuple] = {}
    for e in published:
        place = e.run_id, e.level, e.lo, e.hi
        newest[place] = max(newest.get(place, (0, "")), (e.attempt, e.token))
    spans: dict[str, list[tuple[int, int, int]]] = {}
    for run_id, level, lo, hi in newest:
        if level:
            spans.setdefault(run_id, []).append((level, lo, hi))

    def covered(e: Entry) -> bool:
        return any(level > e.level and lo <= e.lo and e.hi <= hi for level, lo, hi in spans.get(e.run_id, ()))

    return [e for e in published if newest[e.run_id, e.level, e.lo, e.hi] == (e.attempt, e.token) and not covered(e)]


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Spark has no call for deleting a folder; the file system of the folder does it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table_sink(
    tables: list[tuple[Table, Callable[[DataFrame], DataFrame] | None]], run_id: str, compact: bool = True
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that commits every non-empty micro-batch to each of ``tables``, after its shape. Batches
    before the present one are put together; the present one is not, since it may be repeated."""

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            for table, shape in tables:
                rows = shape(held) if shape else held
                if not rows.isEmpty():
                    table.commit(rows, run_id, batch_id)
                if compact and batch_id % table.fan == 0:
                    table.compact(batch.sparkSession, run_id, batch_id)
        finally:
            held.unpersist()

    return write
