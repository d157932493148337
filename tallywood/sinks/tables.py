"""Tables and documents: append, replace, publish, export."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.operators.ranking import newest
from tallywood.sinks.records import folders, read_record, remove_folder, write_record

IMAGE = "annotated_image"
STORED_AT = "stored_at"
# Folders of a stored table.
DAY, PART = "stored_day", "stored_part"
# Folders of a replaced table and the record that names the one in use and the one before it.
VERSION, CURRENT = "version-", "_current"


def stamped(results: DataFrame, moment: float | None = None) -> DataFrame:
    """Results with the moment they are stored, in epoch seconds."""
    now = F.unix_micros(F.current_timestamp()) / 1_000_000
    return results.withColumn(STORED_AT, now if moment is None else F.lit(moment))


def store_stamped(rows: DataFrame, path: str, part: str) -> None:
    """Put rows with their moment of storage into the folders of their days, under a part's name."""
    day = F.to_date(F.timestamp_seconds(STORED_AT))
    writer = rows.withColumns({DAY: day, PART: F.lit(part)}).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(DAY, PART).parquet(path)


def store_results(results: DataFrame, path: str, part: str) -> None:
    """Add results to a stored table, in a folder for the day of storage and the named part.

    Before its rows, a part writes a record of its moment. A part that is written again, on
    whatever day, finds the record, takes the same moment and so replaces itself. Batches and
    streams write alike, and ``read_results`` finds the rows of both.
    """
    spark, record = results.sparkSession, f"{path.rstrip('/')}/_parts/{part}"
    known = read_record(spark, record)
    moment = float(known) if known else int(time.time() * 1_000_000) / 1_000_000
    if not known:
        write_record(spark, record, repr(moment))
    store_stamped(stamped(results, moment), path, part)


def append_results(results: DataFrame, path: str) -> None:
    """Add a batch of results, as a part of its own."""
    store_results(results, path, uuid.uuid4().hex)


def newest_stored(spark: SparkSession, path: str, n: int, fields: tuple[str, ...] = ()) -> DataFrame:
    """The newest ``n`` results of a stored table, from the newest days that hold so many rows.

    The day is that of the moment of storage, so older days cannot hold newer rows. Their folders
    are neither listed nor read, however many there are.
    """
    days, held = [], 0
    for day in reversed(folders(spark, path, f"{DAY}=")):
        days.append(f"{path.rstrip('/')}/{day}")
        held += spark.read.parquet(days[-1]).count()
        if held >= n:
            break
    if not days:
        raise FileNotFoundError(f"no stored results in {path}")
    rows = spark.read.option("basePath", path).parquet(*days).drop(DAY, PART)
    return newest(rows.select(*fields) if fields else rows, n)


def replace_table(df: DataFrame, path: str) -> None:
    """Put a table in the place of the one before it, which readers see until the new one is whole.

    The rows go to a folder of their own; a record that names it is renamed into place last. A
    write that fails leaves the old record and so the old table. The version before stays for those
    who are reading it, older ones are removed. ``df`` may read the table it replaces.
    """
    spark, base = df.sparkSession, path.rstrip("/")
    version = f"{VERSION}{uuid.uuid4().hex}"
    df.write.parquet(f"{base}/{version}")
    kept = [version, *(read_record(spark, f"{base}/{CURRENT}") or "").split()[:1]]
    write_record(spark, f"{base}/{CURRENT}", "\n".join(kept))
    for name in folders(spark, base, VERSION):
        if name not in kept:
            remove_folder(spark, f"{base}/{name}")


def read_replaced(spark: SparkSession, path: str) -> DataFrame:
    """The table that was put in place last."""
    record = read_record(spark, f"{path.rstrip('/')}/{CURRENT}")
    if record is None:
        raise FileNotFoundError(f"no table was put in place at {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/{record.split()[0]}")


def messages(results: DataFrame, key: str = "camera_id") -> DataFrame:
    """``key, value`` pairs for a topic: the key column and the whole row as JSON."""
    return results.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value")
    )


def publish_folder(results: DataFrame, path: str) -> None:
    """Documents to a landing folder, one JSON text per line."""
    messages(results).select("value").write.mode("append").text(path)


def publish_topic(results: DataFrame, servers: str, topic: str) -> None:
    """Documents to a Kafka topic; the connector comes with the cluster."""
    target = {"kafka.bootstrap.servers": servers, "topic": topic}
    messages(results).write.format("kafka").options(**target).save()


def without_image(results: DataFrame) -> DataFrame:
    return results.drop(IMAGE)


def export_newest(results: DataFrame, path: str, n: int = 500) -> bool:
    """Write the newest results as JSON without their images; do nothing when there are none."""
    if results.isEmpty():
        return False
    newest(without_image(results), n).write.mode("overwrite").json(path)
    return True
