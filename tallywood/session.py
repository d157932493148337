"""Session settings and the shared folder for materialised intermediates."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here assumes. Partition counts and sizes depend on the cluster and stay
# with the deployment; AQE coalesces or splits from whatever start value it is given.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even where the next step then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# Rows that move to Python may hold images of up to 10 MB (detect_frames).
IMAGE_SETTINGS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "64"}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(
    app: str, master: str | None = None, shared: str | None = None, **settings: str
) -> SparkSession:
    """A session with the settings above; extra settings use ``__`` for the dots.

    ``shared`` is the folder for intermediate tables where the deployment names none.
    """
    builder = SparkSession.builder.appName(app)
    if shared:
        builder = builder.config(CHECKPOINT_DIR, shared)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **IMAGE_SETTINGS}.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the run-time settings on a session somebody else has built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the setting ``spark.checkpoint.dir`` names it.

    The setting has to be there when the session starts (``build_session(..., shared=...)``); a
    folder on one machine would be lost with the machine, so nothing takes its place.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not named:
        raise ValueError(f"start the session with {CHECKPOINT_DIR}, a folder that all executors share")
    return named


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once, for plans that read it several times.

    The result survives the loss of executors, and its lineage ends at the written files.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
