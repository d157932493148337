import json

import pytest
from conftest import rows

from pyspark.sql import functions as F

from tallywood.functions import dates, documents
from tallywood.plans import detections as plans
from tallywood.sinks import tables
from tallywood.sources import detections as sources

SCHEMA = ("camera_id string, frame_id int, person_count int, processing_time_ms double, "
          "processed_timestamp double, stored_at double, annotated_image string")


@pytest.fixture(scope="module")
def results(spark):
    return spark.createDataFrame([
        ("c1", 0, 2, 10.25, 1704067200.5, 100.0, "eA=="), ("c1", 1, 4, 20.5, 1704067259.9, 101.0, None),
        ("c1", None, 0, 0.25, 1704067260.0, 102.0, None), ("c2", 0, 1, 5.0, 1704067230.0, 103.0, "eQ=="),
    ], SCHEMA)


def test_boxes_at_the_threshold_of_the_counted_class(spark):
    data = [(0, 0.4), (0, 0.39999), (1, 0.9), (0, 0.92936)]
    found = spark.createDataFrame([([(k, c, 1.9, -1.9, 3.0, 4.5) for k, c in data],), ([],)], f"d {documents.DETECTION_SCHEMA}")
    boxes = rows(found.select(documents.person_boxes(F.col("d"))))
    assert [(b["confidence"], tuple(b["bbox"])) for b in boxes[0][0]] == [(0.4, (1, -1, 3, 4)), (0.9294, (1, -1, 3, 4))]
    assert boxes[1][0] == []


def test_overall(results):
    assert rows(plans.overall(results)) == [(3, 1.75, 4, 0, 9.0)]


def test_minutes_split_at_the_full_minute(results):
    assert rows(plans.per_minute(results)) == [
        ("c1", "2024-01-01 00:00", 2, 3.0, 4), ("c2", "2024-01-01 00:00", 1, 1.0, 1), ("c1", "2024-01-01 00:01", 0, 0.0, 0)]


def test_camera_stats(results):
    assert rows(plans.camera_stats(results, "c1")) == [("c1", 3, 2.0, 4, 31.0 / 3)]
    assert rows(plans.camera_stats(results, "none")) == []


def test_latest(results):
    assert [r["stored_at"] for r in plans.latest(results, 2).collect()] == [103.0, 102.0]
    assert [r["stored_at"] for r in plans.latest(results, 0, "c1").collect()] == [102.0, 101.0, 100.0]
    assert "annotated_image" not in plans.latest(results).columns
    assert plans.latest_one(results.where("false")).isEmpty()


def test_latest_image(results):
    assert [tuple(r) for r in plans.latest_image(results).collect()] == [("c2", 0, bytearray(b"y"))]
    assert plans.latest_image(results.where("camera_id = 'c1'")).isEmpty()


def test_overall_of_nothing(results):
    assert rows(plans.overall(results.where("false"))) == [(0, None, None, None, None)]


def test_export(spark, results, tmp_path):
    assert tables.export_newest(results, str(tmp_path / "out"), 3)
    exported = sources.read_json(spark, str(tmp_path / "out"))
    assert sorted(r["stored_at"] for r in exported.collect()) == [101.0, 102.0, 103.0]
    assert "annotated_image" not in exported.columns
    assert not tables.export_newest(results.where("false"), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_replacing_a_table(spark, results, tmp_path):
    path = str(tmp_path / "stats")
    tables.replace_table(plans.per_minute(results), path)
    tables.replace_table(plans.per_minute(results.where("camera_id = 'c2'")), path)
    assert tables.read_replaced(spark, path).count() == 1


def test_messages_carry_the_camera_as_key(results):
    key, value = rows(tables.messages(results.where("camera_id = 'c2'")))[0]
    assert key == "c2" and json.loads(value)["person_count"] == 1


def test_stored_results_have_a_time(spark, results, tmp_path):
    path = str(tmp_path / "stored")
    for _ in range(2):
        tables.append_results(results.drop("stored_at"), path)
    stored = sources.read_results(spark, path)
    assert stored.count() == 8 and stored.where("stored_at > 1700000000").count() == 8
    assert sources.read_results(spark, path, sources.ANALYSIS_FIELDS).columns == list(sources.ANALYSIS_FIELDS)


def test_base64_stays_on_one_line(spark):
    encoded = spark.range(1).select(documents.encode_base64(F.repeat(F.lit("a"), 500).cast("binary"))).first()[0]
    assert "\n" not in encoded and "\r" not in encoded and len(encoded) == 668


def test_elapsed_time(spark):
    found = spark.sql("SELECT 10.0D AS a, 10.09338D AS b, 9.9D AS c").select(
        dates.elapsed_ms(F.col("a"), F.col("b")), dates.elapsed_ms(F.col("a"), F.col("c")))
    assert rows(found) == [(93.38, -100.0)]
