"""Session helpers for jobs that are not handed a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .streaming.state import PROVIDER, STATE_STORE

#: Fixed value: where checkpoints are below a database.
CHECKPOINT_SUFFIX = "/tmp/checkpoint/"


def build_session(app: str = "editscope", **conf: str) -> SparkSession:
    """A session with the settings the results depend on: UTC, adaptive execution, and the state
    store that stateful processors need.

    Master, memory and shuffle width belong to the deployment and are left to ``conf`` or
    spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(PROVIDER, STATE_STORE)
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else ``fallback``.

    There is deliberately no default: a machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not folder:
        raise ValueError("set spark.checkpoint.dir, or pass a folder every executor can reach")
    return folder


def get_checkpoint_location(spark: SparkSession) -> str:
    """Checkpoint folder below the location of the session's current database."""
    database = spark.catalog.getDatabase(spark.catalog.currentDatabase())
    return database.locationUri + CHECKPOINT_SUFFIX
