"""Stored tables: parts that replace themselves, replacement in one step, minutes kept up in parts."""

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallywood.plans import detections as plans
from tallywood.sinks import records, tables
from tallywood.sources import detections as sources
from tallywood.streaming import minutes

RESULTS = "camera_id string, frame_id int, person_count int, processed_timestamp double"
DAY = 86_400


def results(spark, data):
    return spark.createDataFrame(data, RESULTS)


def test_records(spark, tmp_path):
    path = str(tmp_path / "a" / "record")
    assert records.read_record(spark, path) is None
    for text in ("one", "zwei ü", ""):
        records.write_record(spark, path, text)
        assert records.read_record(spark, path) == text
    assert [f for f in os.listdir(tmp_path / "a") if not f.startswith(".")] == ["record"]


def test_part_of_another_day_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "results")
    records.write_record(spark, f"{path}/_parts/p-0", repr(1704067199.25))
    tables.store_results(spark.range(5), path, "p-0")
    tables.store_results(spark.range(3), path, "p-0")
    tables.store_results(spark.range(2), path, "p-1")
    assert sorted(rows(sources.read_results(spark, path).select("id"))) == [(0,), (0,), (1,), (1,), (2,)]
    old = sources.read_results(spark, path, ("stored_day", "stored_part", "stored_at")).where("stored_part = 'p-0'")
    assert {(str(r[0]), r[2]) for r in old.collect()} == {("2023-12-31", 1704067199.25)}


def test_failed_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "stats")
    with pytest.raises(FileNotFoundError):
        tables.read_replaced(spark, path)
    tables.replace_table(spark.range(3), path)
    broken = spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).alias("id"))
    with pytest.raises(Exception, match="broken"):
        tables.replace_table(broken, path)
    assert tables.read_replaced(spark, path).count() == 3
    reader = tables.read_replaced(spark, path)
    tables.replace_table(tables.read_replaced(spark, path).where("id > 0"), path)  # from the table itself
    assert sorted(rows(tables.read_replaced(spark, path))) == [(1,), (2,)]
    assert reader.count() == 3  # whoever was reading goes on
    tables.replace_table(spark.range(9), path)
    assert len(records.folders(spark, path, tables.VERSION)) == 2


def test_minutes_equal_the_batch(spark, tmp_path):
    path = str(tmp_path / "minutes")
    first = [("c", i, i % 4, 1704067200.0 + 13 * i) for i in range(40)] + [("d", 0, None, 1704067200.0), (None, None, 2, None)]
    late = [("c", 99, 9, 1704060000.0), ("d", 1, 3, 1704067230.0), ("d", 2, 5, 1704067200.0 + 3 * DAY), ("c", 1, 1, 1704067201.0)]
    assert minutes.read_minutes(spark, path).collect() == []
    assert minutes.merge_batch(results(spark, first), path, "s", 0)
    assert minutes.merge_batch(results(spark, late), path, "s", 1)
    for data, number in ((first, 0), (late, 1)):  # repeated batches
        assert not minutes.merge_batch(results(spark, data), path, "s", number)
    assert minutes.merge_batch(results(spark, late[:1]), path, "other", 0)
    assert minutes.merge_batch(results(spark, []), path, "s", 2)
    want = plans.per_minute(results(spark, first + late + late[:1]))
    assert sorted(rows(minutes.read_minutes(spark, path)), key=str) == sorted(rows(want), key=str)
    some = minutes.read_minutes(spark, path, "2024-01-01", "2024-01-02").collect()
    assert some and all(r.datetime.startswith("2024-01-01") for r in some)


def test_batch_touches_its_days_only(spark, tmp_path):
    path = str(tmp_path / "minutes")
    minutes.merge_batch(results(spark, [("c", i, 1, 1704067200.0 + DAY * i) for i in range(4)]), path, "s", 0)
    before = minutes._state(spark, path)["days"]
    minutes.merge_batch(results(spark, [("c", 9, 1, 1704067200.0 + DAY)]), path, "s", 1)
    after = minutes._state(spark, path)["days"]
    assert [d for d in after if after[d] != before[d]] == ["2024-01-02"]
    files = [os.path.join(d, f) for d, _, fs in os.walk(f"{path}/{after['2024-01-02']}") for f in fs if f.endswith(".parquet")]
    assert len(files) == 1


def test_failed_batch_counts_as_nothing(spark, tmp_path):
    path = str(tmp_path / "minutes")
    good = results(spark, [("c", 1, 1, 1704067200.0)])
    minutes.merge_batch(good, path, "s", 0)
    broken = good.withColumn("person_count", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        minutes.merge_batch(broken, path, "s", 1)
    assert [r.n_frames for r in minutes.read_minutes(spark, path).collect()] == [1]
    minutes.merge_batch(good, path, "s", 1)
    assert [r.n_frames for r in minutes.read_minutes(spark, path).collect()] == [2]


def test_newest_reads_few_days(spark, tmp_path):
    path = str(tmp_path / "store")
    data = [("c", i, 1704067200.0 + DAY * (i // 10) + i // 2) for i in range(100)]
    tables.store_stamped(spark.createDataFrame(data, "camera_id string, frame_id int, stored_at double"), path, "p")
    for n in (1, 5, 10, 11, 25, 1000):
        got = rows(tables.newest_stored(spark, path, n).select("camera_id", "frame_id", "stored_at"))
        assert got == sorted(data, key=lambda r: (-r[2], r[0], -r[1]))[:n]
    files = tables.newest_stored(spark, path, 15).inputFiles()
    assert {f.split("stored_day=")[1][:10] for f in files} == {"2024-01-10", "2024-01-09"}
