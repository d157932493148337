"""Analyses of stored detection results, and the detection step in batch form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.functions.dates import minute_label, minute_of
from tallywood.functions.numbers import exact, mean_of
from tallywood.operators.ranking import newest
from tallywood.sinks.tables import without_image

# Rows of a listing and of an export.
LISTED, EXPORTED = 20, 500


def _mean_people() -> Column:
    return F.avg("person_count")


def _mean_ms() -> Column:
    """Processing times have two digits, so their decimal sum is exact."""
    ms = F.col("processing_time_ms")
    return mean_of(F.sum(exact(ms)), F.count(ms))


def overall(results: DataFrame) -> DataFrame:
    """One row over all results: frames, mean, highest and lowest count, mean time."""
    return results.agg(
        F.count("frame_id").alias("n_frames"),
        _mean_people().alias("avg_people"),
        F.max("person_count").alias("max_people"),
        F.min("person_count").alias("min_people"),
        _mean_ms().alias("avg_ms"),
    )


def per_minute(results: DataFrame) -> DataFrame:
    """``camera_id, datetime, n_frames, avg_people, max_people`` by minute of processing."""
    timed = results.withColumn("minute", minute_of(F.col("processed_timestamp")))
    counts = timed.groupBy("camera_id", "minute").agg(
        F.count("frame_id").alias("n_frames"),
        _mean_people().alias("avg_people"),
        F.max("person_count").alias("max_people"),
    )
    label = minute_label(F.col("minute")).alias("datetime")
    return counts.select("camera_id", label, "n_frames", "avg_people", "max_people").orderBy("datetime", "camera_id")


def of_camera(results: DataFrame, camera: str) -> DataFrame:
    return results.where(F.col("camera_id") == camera)


def camera_stats(results: DataFrame, camera: str) -> DataFrame:
    """One row for a camera, none when it has no results. Every result counts as a frame."""
    return of_camera(results, camera).groupBy("camera_id").agg(
        F.count("*").alias("total_frames"),
        _mean_people().alias("avg_person_count"),
        F.max("person_count").alias("max_person_count"),
        _mean_ms().alias("avg_processing_time_ms"),
    )


def latest(results: DataFrame, n: int = LISTED, camera: str | None = None) -> DataFrame:
    """The newest results without images, of all cameras or of one; 0 means all results."""
    chosen = results if camera is None else of_camera(results, camera)
    return newest(without_image(chosen), n)


def latest_one(results: DataFrame) -> DataFrame:
    return latest(results, 1)


def latest_image(results: DataFrame) -> DataFrame:
    """``camera_id, frame_id, image``: the newest image as bytes; no row without an image."""
    newest_one = newest(results, 1).where(F.col("annotated_image").isNotNull())
    return newest_one.select("camera_id", "frame_id", F.unbase64("annotated_image").alias("image"))
