"""Storing, publishing and summing up a stream of results."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tallywood.functions.dates import MINUTE_FORMAT
from tallywood.sinks.tables import messages, replace_table, store_results

MINUTE = "1 minute"


def started(
    writer: DataStreamWriter, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Start a query that recovers from ``checkpoint``.

    With an interval it runs until stopped; without one it reads what is there and ends.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    if interval:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def store(
    results: DataFrame, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Add results with their time of storage to a stored table.

    Each batch is a part that is named after the checkpoint and its number, so a batch that runs
    again after a failure replaces itself.
    """
    name = hashlib.md5(checkpoint.encode()).hexdigest()
    writer = results.writeStream.outputMode("append").foreachBatch(
        lambda batch, number: store_results(batch, path, f"{name}-{number}")
    )
    return started(writer, checkpoint, interval)


def publish(
    results: DataFrame, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Results as JSON texts to a landing folder."""
    writer = messages(results).select("value").writeStream.format("text").outputMode("append")
    return started(writer.option("path", path), checkpoint, interval)


def publish_topic(
    results: DataFrame, servers: str, topic: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Results keyed by camera to a Kafka topic; the connector comes with the cluster."""
    target = {"kafka.bootstrap.servers": servers, "topic": topic}
    writer = messages(results).writeStream.format("kafka").options(**target)
    return started(writer, checkpoint, interval)


def minute_stats(results: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """``camera_id, datetime, n_frames, avg_people, max_people`` per minute of processing.

    The watermark matters in append mode only, where it closes a minute and frees its state.
    In complete mode a late result still counts.
    """
    moment = F.timestamp_micros((F.col("processed_timestamp") * 1_000_000).cast("bigint"))
    timed = results.withColumn("moment", moment).withWatermark("moment", lateness)
    stats = timed.groupBy("camera_id", F.window("moment", MINUTE)).agg(
        F.count("frame_id").alias("n_frames"),
        F.avg("person_count").alias("avg_people"),
        F.max("person_count").alias("max_people"),
    )
    label = F.date_format("window.start", MINUTE_FORMAT).alias("datetime")
    return stats.select("camera_id", label, "n_frames", "avg_people", "max_people")


def replace_stats(
    stats: DataFrame, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Keep a table of all minutes, written anew after each batch."""
    writer = stats.writeStream.outputMode("complete").foreachBatch(
        lambda batch, _: replace_table(batch, path)
    )
    return started(writer, checkpoint, interval)


def append_stats(
    stats: DataFrame, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Append each minute once, when the watermark has passed it."""
    writer = stats.writeStream.format("parquet").outputMode("append")
    return started(writer.option("path", path), checkpoint, interval)
