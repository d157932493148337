"""Small text files beside a table that say what of it counts."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    """The file system of a path and the path itself, as Spark's own writers use them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def read_record(spark: SparkSession, path: str) -> str | None:
    """The text of a record; None where there is none."""
    system, place = _system(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_record(spark: SparkSession, path: str, text: str) -> None:
    """Put a record in the place of the one before it.

    It is written under another name and then renamed over the old one, so a reader finds the old
    text or the new one, never a part of it.
    """
    system, place = _system(spark, path)
    _, fresh = _system(spark, f"{path}.{uuid.uuid4().hex}")
    stream = system.create(fresh, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    jvm = spark._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    choices = spark.sparkContext._gateway.new_array(rename, 1)
    choices[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(system.makeQualified(fresh), system.makeQualified(place), choices)


def folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names of the folders below a path that begin with a prefix, ascending."""
    system, place = _system(spark, path)
    if not system.exists(place):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(place) if s.isDirectory() and s.getPath().getName().startswith(prefix))


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that no record names any more; one that is gone already is fine."""
    system, place = _system(spark, path)
    system.delete(place, True)
