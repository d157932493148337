"""A table of minutes that batches keep up in parts."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallywood.functions.dates import minute_label, minute_of
from tallywood.session import materialize
from tallywood.sinks.records import read_record, remove_folder, write_record
from tallywood.streaming.results import started

CURRENT = "_current"
# The day of results without a readable moment.
NO_DAY = "none"
# ``minute`` counts the minutes since the epoch.
PARTIAL = "camera_id string, minute bigint, n_frames bigint, n_people bigint, sum_people bigint, max_people int"


def partials(results: DataFrame) -> DataFrame:
    """Counts, sums and highest values per camera and minute, which merge by adding up."""
    timed = results.withColumn("minute", minute_of(F.col("processed_timestamp")))
    return timed.groupBy("camera_id", "minute").agg(
        F.count("frame_id").alias("n_frames"),
        F.count("person_count").alias("n_people"),
        F.sum(F.col("person_count").cast("bigint")).alias("sum_people"),
        F.max("person_count").cast("int").alias("max_people"),
    )


def merged(parts: DataFrame) -> DataFrame:
    return parts.groupBy("camera_id", "minute").agg(
        F.sum("n_frames").alias("n_frames"), F.sum("n_people").alias("n_people"),
        F.sum("sum_people").alias("sum_people"), F.max("max_people").alias("max_people"),
    )


def _state(spark: SparkSession, path: str) -> dict:
    record = read_record(spark, f"{path}/{CURRENT}")
    return json.loads(record) if record else {"days": {}, "applied": {}, "left": []}


def _stored(spark: SparkSession, path: str, state: dict, days: list[str]) -> DataFrame | None:
    places = [f"{path}/{state['days'][day]}/day={day}" for day in days if day in state["days"]]
    return spark.read.schema(PARTIAL).parquet(*places) if places else None


def merge_batch(results: DataFrame, path: str, source: str, number: int) -> bool:
    """Add batch ``number`` of a source to the table; a batch that is in it already changes nothing.

    Only the days a batch touches are read and written, into a folder of their own; then one record
    that names the folder of each day and the last batch of each source is renamed into place. So
    a batch counts as a whole or not at all, a repeated one once, and a late result changes its own
    day however old. Nothing else is kept between batches. One writer at a time; the numbers of a
    source rise, as those of a stream do.
    """
    spark, path = results.sparkSession, path.rstrip("/")
    state = _state(spark, path)
    if state["applied"].get(source, -1) >= number:
        return False
    batch = materialize(partials(results))
    day = F.coalesce(F.date_format(F.timestamp_seconds(F.col("minute") * 60), "yyyy-MM-dd"), F.lit(NO_DAY))
    days = sorted(r.day for r in batch.select(day.alias("day")).distinct().collect())
    left = []
    if days:
        version = f"part-{uuid.uuid4().hex}"
        before = _stored(spark, path, state, days)
        rows = merged(batch if before is None else before.unionByName(batch))
        # One file for each day: a day has 1,440 rows a camera.
        dealt = rows.withColumn("day", day).repartition("day")
        dealt.write.partitionBy("day").parquet(f"{path}/{version}")
        left = [f"{state['days'][d]}/day={d}" for d in days if d in state["days"]]
        state["days"].update(dict.fromkeys(days, version))
    state["applied"][source] = number
    unused, state["left"] = state["left"], left
    write_record(spark, f"{path}/{CURRENT}", json.dumps(state))
    for place in unused:  # what the record before this one had left for its readers
        remove_folder(spark, f"{path}/{place}")
    return True


def read_minutes(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """``camera_id, datetime, n_frames, avg_people, max_people`` of all days or of some.

    Days are text such as ``2024-01-31``; only their folders are read.
    """
    path = path.rstrip("/")
    state = _state(spark, path)
    days = [d for d in sorted(state["days"]) if (first is None or d >= first) and (last is None or d <= last)]
    rows = _stored(spark, path, state, days)
    rows = spark.createDataFrame([], PARTIAL) if rows is None else rows
    mean = F.col("sum_people").cast("double") / F.nullif(F.col("n_people"), F.lit(0))
    return rows.select("camera_id", minute_label(F.col("minute")).alias("datetime"), "n_frames", mean.alias("avg_people"), "max_people")


def keep_minutes(results: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Keep a table of minutes from a stream of results, without state in the stream."""
    source = hashlib.md5(checkpoint.encode()).hexdigest()
    writer = results.writeStream.outputMode("append").foreachBatch(
        lambda batch, number: merge_batch(batch, path, source, number)
    )
    return started(writer, checkpoint, interval)
