"""The running jobs: landing edits, resolving addresses, and the four result streams."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..functions import text
from ..operators import geo, history, leaders, live_map, windows
from ..schemas import GEO
from ..session import shared_dir
from . import members, resolving
from .manifest import Table, delete_folder, table_sink
from .resolving import Limits
from .sinks import Sink, batch_folder, partition_sink
from .state import batches_for, ends

AGGREGATE_TRIGGER = {"processingTime": "15 seconds"}
MAP_TRIGGER = {"processingTime": "5 seconds"}
RESOLVE_TRIGGER = {"processingTime": "3 seconds"}


def run_batches(
    stream: DataFrame, sink: Sink, checkpoint: str, mode: str, trigger: dict
) -> StreamingQuery:
    """Start one query. The checkpoint folder must stay the same between starts: it is what
    lets the query go on where it stopped."""
    writer = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    with batches_for(stream.sparkSession, trigger):
        return writer.start()


def land(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict = MAP_TRIGGER,
    partition_by: tuple[str, ...] = (),
) -> StreamingQuery:
    """Append a stream (parsed edits, the raw edit log, JSON messages) to a Parquet table, so
    that feeds are parsed once and later jobs push their filters into the scan."""
    writer = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .partitionBy(*partition_by)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    with batches_for(stream.sparkSession, trigger):
        return writer.start()


def publish_kafka(
    messages: DataFrame, servers: str, checkpoint: str, topic: str = "wiki-edits"
) -> StreamingQuery:
    """Send the JSON messages of ``encode_edits`` to Kafka."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


#: For each result: the rows, what names a row, what orders peaks, and whose peak is asked for.
RESULTS = {
    "edit_wars": (schemas.WAR_ROWS, ["start_time", "title"], history.WAR_ORDER, "title"),
    "super_editors": (schemas.EDITOR_ROWS, ["start_time", "user"], history.EDITOR_ORDER, "user"),
    "topic_trends": (schemas.TOPIC_ROWS, ["start_time", "topic"], history.TOPIC_ORDER, "topic"),
}
BOUNDS = ("start_time", "end_time")


def result_tables(output: str, fmt: str = "parquet") -> dict[str, Table]:
    """The tables that ``start_results`` keeps below ``output``: each result as it was emitted, its last version
    (``_latest``) and its peaks (``_peaks``, one row a title, user or topic), and the map points. The last two kinds are
    kept up batch by batch, so an answer reads little however long the history is."""
    tables = {"map_points": Table(f"{output}/map_points", schemas.POINT_ROWS, ("ts",), None, fmt)}
    for name, (rows, keys, order, key) in RESULTS.items():
        version = partial(history.latest_versions, keys=keys, version=["run_id", "batch_id"])
        best = partial(history.peaks, keys=[key], order=[*order, "run_id"])
        tables[name] = Table(f"{output}/{name}", rows, BOUNDS, None, fmt)
        tables[f"{name}_latest"] = Table(f"{output}/{name}_latest", rows, BOUNDS, version)
        tables[f"{name}_peaks"] = Table(f"{output}/{name}_peaks", rows, BOUNDS, best)
    return tables


def start_results(
    edits: DataFrame,
    output: str,
    checkpoints: str | None,
    run_id: str,
    *,
    fmt: str = "parquet",
    size: str = windows.SIZE,
    slide: str = windows.SLIDE,
    watermark: str = windows.WATERMARK,
    top_editors: int | None = None,
    top_topics: int | None = None,
    geo_path: str | None = None,
    resolver: Callable[[list[str]], list[tuple]] | None = None,
    limits: Limits = Limits(),
    answers: bool = True,
    aggregate_trigger: dict = AGGREGATE_TRIGGER,
    map_trigger: dict = MAP_TRIGGER,
) -> list[StreamingQuery]:
    """Start wars, editors, topics (update mode) and map points (append mode) over ``edits``, a
    landed table (``sources.feed.stream_landed``) or another source that does not repeat rows.

    Category and talk pages are left out of all four. Without ``checkpoints`` they go below the
    folder the cluster names. All rows of a micro-batch are stored; ``top_editors`` and
    ``top_topics`` would store the top rows only, and a key that leaves them would keep an old
    version. The outputs are ``result_tables``; ``answers=False`` leaves out latest versions and
    peaks. With ``geo_path`` and ``resolver`` the map looks addresses up in that table and asks for
    those it lacks, within ``limits``; otherwise the edits carry their coordinates.
    ``run_id`` names the series of batch numbers, so it changes with the checkpoint only; runs
    should sort by their start. The caller waits with ``spark.streams.awaitAnyTermination()``, which
    raises a query's error.
    """
    spark = edits.sparkSession
    tables = result_tables(output, fmt)

    def sink(name: str, shape: Callable[[DataFrame], DataFrame] | None = None) -> Sink:
        kinds = ["", "_latest", "_peaks"] if answers and name in RESULTS else [""]
        return table_sink([(tables[name + kind], shape) for kind in kinds], run_id)

    root = checkpoints or f"{shared_dir(spark)}/results/{run_id}"
    common = {"size": size, "slide": slide, "watermark": watermark}
    pages = edits.filter(text.is_content_title("title"))
    wars = members.edit_wars(pages, **common)
    editors = windows.super_editors(pages, **common)
    topics = members.topic_trends(pages, **common)
    best_editors = top_editors and partial(windows.top_editors_of_batch, k=top_editors)
    best_topics = top_topics and partial(windows.top_topics_of_batch, k=top_topics)
    if geo_path and resolver:
        points = locate(spark, pages, geo_path, resolver, limits, map_trigger)
        place = answers_sink(geo_path, run_id, table_sink([(tables["map_points"], live_map.point_rows)], run_id))
    else:
        points, place = live_map.point_rows(pages), sink("map_points")
    jobs = [
        ("edit_wars", wars, sink("edit_wars"), "update", aggregate_trigger),
        ("super_editors", editors, sink("super_editors", best_editors), "update", aggregate_trigger),
        ("topic_trends", topics, sink("topic_trends", best_topics), "update", aggregate_trigger),
        ("map_points", points, place, "append", map_trigger),
    ]
    return [
        run_batches(stream, target, f"{root}/{name}", mode, trigger)
        for name, stream, target, mode, trigger in jobs
    ]


#: What the running top lists count edits of.
LEADERS = {"editor_leaders": lambda: F.col("user"), "topic_leaders": lambda: text.topic_key("title")}


def leader_tables(output: str) -> dict[str, Table]:
    """The last list of each window, one row a window."""
    version = partial(history.latest_versions, keys=["start_time"], version=["run_id", "batch_id"])
    return {name: Table(f"{output}/{name}", schemas.LEADER_ROWS, BOUNDS, version) for name in LEADERS}


def start_leaders(
    edits: DataFrame,
    output: str,
    checkpoints: str | None,
    run_id: str,
    *,
    size: str = windows.SIZE,
    slide: str = windows.SLIDE,
    watermark: str = windows.WATERMARK,
    k: int = 50,
    tracked: int = leaders.TRACKED,
    trigger: dict = AGGREGATE_TRIGGER,
) -> list[StreamingQuery]:
    """Keep the ``k`` most active editors and topics of each window without a row for every one of them, as
    ``leader_tables`` below ``output``. Counts are off by at most the ``max_error`` of their row; ``run_id`` as in
    ``start_results``."""
    root = checkpoints or f"{shared_dir(edits.sparkSession)}/leaders/{run_id}"
    pages = edits.filter(text.is_content_title("title"))
    bounds = {"size": size, "slide": slide, "watermark": watermark, "k": k, "tracked": tracked}
    return [
        run_batches(leaders.leaders(pages, LEADERS[name](), **bounds), table_sink([(table, None)], run_id), f"{root}/{name}", "update", trigger)
        for name, table in leader_tables(output).items()
    ]


def last_points(spark: SparkSession, output: str, n: int = 500) -> DataFrame:
    """The newest points of the map that ``start_results`` keeps below ``output``, from the files that
    can hold them."""
    return live_map.rolling_points(result_tables(output)["map_points"].newest(spark, "ts", n), n)


# ---- addresses ---------------------------------------------------------------------------

#: Folders of answers after which the address table is written anew as one.
COMPACT_AFTER = 64
ROWS_PER_FILE = 5_000_000


def prepare_geo(spark: SparkSession, path: str) -> None:
    """Make the empty address table once, so that it can be read from the start."""
    empty = geo.empty_geo(spark).select(
        "*", F.lit(None).cast("timestamp").alias("stored_at"), F.lit("").alias("run_id"), F.lit(0).cast("bigint").alias("batch_id")
    )
    empty.write.mode("ignore").partitionBy("run_id", "batch_id").parquet(path)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{GEO}, stored_at timestamp, run_id string, batch_id bigint").parquet(path)


def geo_table(path: str) -> Table:
    """The address table of ``start_results`` and ``start_resolving``: one row per ip, that stored last."""
    return Table(path, schemas.GEO_ROWS, ("stored_at",), _newest_rows)


def _newest_rows(stored: DataFrame) -> DataFrame:
    return _newest(stored, "stored_at", "run_id", "batch_id").select("ip", "lat", "lon", "stored_at", "run_id", "batch_id")


def _newest(stored: DataFrame, *more: str) -> DataFrame:
    """One row per ip, that stored last; run and batch only decide between equal times."""
    order = F.struct("stored_at", "run_id", "batch_id")
    columns = ("lat", "lon", *more)
    best = stored.groupBy("ip").agg(F.max_by(F.struct(*columns), order).alias("g"))
    return best.select("ip", *[f"g.{c}" for c in columns])


def read_geo(
    spark: SparkSession, path: str, run_id: str | None = None, before: int | None = None, ips: DataFrame | None = None
) -> DataFrame:
    """The address table, one row per ip with the answer stored last, for all addresses or for
    ``ips`` only. With ``run_id`` and ``before`` it is as it stood before that batch of the run:
    a repeated batch does not see what its first try stored."""
    entries = geo_table(path).entries(spark)
    rows = geo_table(path).read(spark, entries) if entries else _stored(spark, path)
    if run_id is not None and before is not None:
        rows = rows.filter((F.col("run_id") != run_id) | (F.col("batch_id") < before))
    if ips is not None:
        rows = rows.join(ips, "ip", "left_semi")
    return _newest(rows)


def compact_geo(spark: SparkSession, path: str, run_id: str, batch_id: int, after: int = COMPACT_AFTER) -> bool:
    """If the table has more than ``after`` folders of answers, put the newest answers into a
    folder of their own, which every run and batch sees, and delete those it was made of. The
    folder's name is new each time, so a repeated try reads what it does not write. Stopped half-way,
    it leaves older rows beside newer ones, which the newest time settles."""
    folders = [tuple(r) for r in _stored(spark, path).select("run_id", "batch_id").distinct().collect()]
    if len(folders) <= after:
        return False
    stored = _stored(spark, path)
    files = stored.count() // ROWS_PER_FILE + 1
    put = f"{run_id}-compact-{uuid.uuid4().hex}"
    _newest(stored, "stored_at").repartition(files).write.parquet(batch_folder(path, put, batch_id))
    for run, batch in folders:
        delete_folder(spark, batch_folder(path, run, batch))
    return True


def geo_sink(
    geo_path: str,
    output: str,
    run_id: str,
    resolver: Callable[[list[str]], list[tuple]],
    fmt: str = "parquet",
    shape: Callable[[DataFrame], DataFrame] | None = None,
    compact_after: int = COMPACT_AFTER,
) -> Sink:
    """Per micro-batch: find addresses not in the table, resolve them in chunks, store the
    successes, and write the edits with coordinates, after ``shape``. The trigger is the buffer.
    A batch without answers stores nothing, and the table's folders are put together in time."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        edits = batch.persist()
        try:
            known = read_geo(spark, geo_path, run_id, batch_id, geo.edit_ips(edits))
            missing = geo.geo_missing(edits, known)
            answers = geo.resolve(missing, resolver).filter(F.col("status") == geo.SUCCESS)
            answers = answers.select("ip", "lat", "lon", F.current_timestamp().alias("stored_at")).persist()
            try:
                table = known
                if not answers.isEmpty():
                    folder = batch_folder(geo_path, run_id, batch_id)
                    answers.write.mode("overwrite").parquet(folder)
                    new = spark.read.schema(GEO).parquet(folder)
                    table = geo.geo_upsert(known, new.withColumn("status", F.lit(geo.SUCCESS)))
                partition_sink(output, run_id, fmt, shape)(geo.geo_enrich(edits, table), batch_id)
                if batch_id % compact_after == compact_after - 1:
                    compact_geo(spark, geo_path, run_id, batch_id, compact_after)
            finally:
                answers.unpersist()
        finally:
            edits.unpersist()

    return write


def locate(
    spark: SparkSession, edits: DataFrame, geo_path: str, resolver: Callable[[list[str]], list[tuple]], limits: Limits, trigger: dict
) -> DataFrame:
    """``resolving.locate`` with the stored addresses. A run that ends has no later batch for its buffer to wait for, so
    it empties the buffer in every batch, as far as the calls go."""
    prepare_geo(spark, geo_path)
    waits = replace(limits, wait_ms=0) if ends(trigger) else limits
    return resolving.locate(edits, resolver, waits, read_geo(spark, geo_path))


def answers_sink(geo_path: str, run_id: str, target: Sink, user: str = "user") -> Sink:
    """Store the answers in a micro-batch of ``locate`` in the address table, and pass the edits on to ``target``."""
    table = geo_table(geo_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            given = held.filter("_answered").select(F.col(user).alias("ip"), "lat", "lon").distinct()
            if not given.isEmpty():
                table.commit(given.withColumn("stored_at", F.current_timestamp()), run_id, batch_id)
            if batch_id % table.fan == 0:
                table.compact(batch.sparkSession, run_id, batch_id)
            target(held.drop("_answered"), batch_id)
        finally:
            held.unpersist()

    return write


def start_resolving(
    edits: DataFrame,
    geo_path: str,
    output: str,
    checkpoint: str,
    run_id: str,
    resolver: Callable[[list[str]], list[tuple]],
    trigger: dict = RESOLVE_TRIGGER,
    limits: Limits = Limits(),
) -> StreamingQuery:
    """Edits with coordinates. Edits by an unknown address wait until ``limits`` lets it be asked; an
    address is asked again as long as it is not found. The output is for static readers (see ``sinks``)."""
    located = locate(edits.sparkSession, edits, geo_path, resolver, limits, trigger)
    sink = answers_sink(geo_path, run_id, partition_sink(output, run_id))
    return run_batches(located, sink, checkpoint, "append", trigger)
