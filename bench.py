"""Wall time of the headline queries: one JSON line on standard output.

Batch queries write to the no-op sink, so the whole result is computed and nothing is kept.
``stream_*`` runs the same operator as a streaming query over the tables until no data is left.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F

from editscope.operators import windows
from editscope.plans import catalog, tables
from editscope.session import build_session
from editscope.sources import feed
from editscope.streaming import pipeline

HEADLINE = [
    "edit_wars", "edit_wars_members", "super_editors", "topic_trends", "suspicious_flag",
    "feed_parse", "feed_to_edits", "json_decode", "geo_enrich", "geo_range", "map_last_n",
    "hist_war_peaks", "hist_editor_peaks", "hist_war_trend_latest", "hist_war_kpis", "hist_last_1h",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def stream_edit_wars(spark, sf_dir: str) -> None:
    """All events through the stateful aggregation, landed as edits first."""
    with tempfile.TemporaryDirectory(prefix="bench-stream-") as folder:
        edits = tables.edits(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
        edits.write.parquet(f"{folder}/edits")
        wars = windows.edit_wars(feed.stream_landed(spark, f"{folder}/edits", edits.schema), *tables.WAR_WINDOW)
        query = pipeline.run_batches(
            wars, lambda batch, _: drain(batch), f"{folder}/checkpoint", "update", {"availableNow": True}
        )
        query.awaitTermination()


def estimated_wars(spark, sf_dir: str):
    return windows.edit_wars(tables.edits(spark, sf_dir), *tables.WAR_WINDOW, exact=False)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    queries = {name: catalog.QUERIES[name] for name in HEADLINE} | {"edit_wars_estimated": estimated_wars}

    def run(name: str) -> float:
        return timed(lambda: drain(queries[name](spark, sf_dir)))

    for name in queries:  # warms up the JVM and the file cache
        run(name)
    seconds = {name: median(run(name) for _ in range(3)) for name in queries}
    seconds["stream_edit_wars"] = median(timed(lambda: stream_edit_wars(spark, sf_dir)) for _ in range(3))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in seconds.items()},
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
