"""Frames and results: topics, JSON files and stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.functions.documents import FRAME_SCHEMA, RESULT_SCHEMA, decode_json
from tallywood.sinks.tables import DAY, PART

# Topic names and the start position of a first read.
FRAMES_TOPIC = "camera_frames"
RESULTS_TOPIC = "detection_results"
STARTING_OFFSETS = "latest"

# The fields the batch analysis reads.
ANALYSIS_FIELDS = (
    "camera_id",
    "frame_id",
    "person_count",
    "processing_time_ms",
    "processed_timestamp",
)


def topic_options(
    servers: str,
    topic: str,
    starting_offsets: str = STARTING_OFFSETS,
    tasks: int | None = None,
    per_trigger: int | None = None,
) -> dict:
    """Options of a Kafka source; the connector comes with the cluster.

    ``tasks`` splits topic partitions over at least so many tasks, ``per_trigger`` bounds the
    messages of a batch.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
    }
    if tasks:
        options["minPartitions"] = str(tasks)
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def topic_stream(
    spark: SparkSession, servers: str, topic: str, schema: str, **options: str | int
) -> DataFrame:
    """Documents of a topic; further options are those of ``topic_options``."""
    chosen = topic_options(servers, topic, **options)
    source = spark.readStream.format("kafka").options(**chosen).load()
    return documents(source.select(F.col("value").cast("string")), schema)


def folder_stream(
    spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Documents of a landing folder with one JSON text per line."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return documents(reader.load(path), schema)


def documents(messages: DataFrame, schema: str) -> DataFrame:
    """JSON ``value`` to columns; a message that is not a document of this shape is dropped."""
    parsed = messages.select(decode_json(F.col("value"), schema).alias("document"))
    return parsed.select("document.*").where(F.col("camera_id").isNotNull())


def frame_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    return folder_stream(spark, path, FRAME_SCHEMA, files_per_trigger)


def result_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    return folder_stream(spark, path, RESULT_SCHEMA, files_per_trigger)


def read_results(spark: SparkSession, path: str, fields: tuple[str, ...] = ()) -> DataFrame:
    """The stored results, or some of their fields; the scan reads no others."""
    stored = spark.read.parquet(path)
    return stored.select(*fields) if fields else stored.drop(DAY, PART)


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines, with a declared schema or with one inferred from the documents."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)
