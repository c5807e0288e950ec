"""What the operators share: scratch tables in the shared folder, batch sizes, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``; a temporary one only if it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = tempfile.mkdtemp(prefix="editscope-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def columns_of(df: DataFrame) -> list[str]:
    """The names of the columns, quoted, so that one with a dot is a column and not a field."""
    return [f"`{c.replace('`', '``')}`" for c in df.columns]


def small_batches(spark: SparkSession) -> None:
    """Few rows to an Arrow batch, so that a batch of very long texts fits a worker's memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def width(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the session has it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _state(edges: DataFrame):
    """Count and order-free checksum of a set of edges; equal states mean that a round changed nothing."""
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of the undirected edges (a, b), two longs: one row (id, root) for each id on an edge,
    root the smallest id of its component.

    Alternating large-star and small-star rounds, each a few shuffles, until a round changes nothing. Each node keeps
    one edge a round, so the edge list never grows beyond its input. The list lives in the shared folder; only a
    count and a checksum reach the driver. Null ends and self-loops link nothing; self-loops keep their id.
    """
    both = edges.select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v")).dropna()
    cur = staged(
        both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-edges"
    )
    alone = cur.filter("u = v").select(F.col("u").alias("id"), F.col("u").alias("root"))
    cur = cur.filter("u != v")
    before = _state(cur)
    while before[0]:
        mirrored = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = mirrored.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = mirrored.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.filter("u != v").distinct(), f"{name}-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                      F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*").filter("u != v").distinct()
        )
        cur = staged(small, f"{name}-small")
        after = _state(cur)
        if after == before:
            break
        before = after
    rooted = cur.select(F.col("u").alias("id"), F.col("v").alias("root"))
    roots = cur.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    return rooted.union(roots).union(alone).groupBy("id").agg(F.min("root").alias("root"))


class UnionFind:
    """Disjoint sets of small integers; the smallest member is the root."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True
