import json

import pytest
from conftest import rows

from pyspark.sql import functions as F

from tallywood.plans import detections as plans
from tallywood.sinks import tables
from tallywood.sources import detections as sources
from tallywood.streaming import results as streams
from tallywood.streaming.detect import batches_of, detect_frames


def result(camera, frame, people, moment):
    return (camera, frame, moment, moment, 1.5, (640, 480), people, [], None)


@pytest.fixture
def landing(spark, tmp_path):
    path = str(tmp_path / "landing")

    def add(data):
        from tallywood.functions.documents import RESULT_SCHEMA
        tables.publish_folder(spark.createDataFrame(data, RESULT_SCHEMA).coalesce(1), path)
        return path
    return add


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_each_result_is_stored_once_across_restarts(spark, tmp_path, landing):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    path = landing([result("c", 0, 1, 1704067200.0), result("c", 0, 2, 1704067201.0)])
    run(streams.store(sources.result_stream(spark, path), out, checkpoint))
    landing([result("c", 1, 3, 1704067202.0)])
    run(streams.store(sources.result_stream(spark, path), out, checkpoint))
    run(streams.store(sources.result_stream(spark, path), out, checkpoint))
    stored = spark.read.parquet(out)
    assert sorted(rows(stored.select("frame_id", "person_count"))) == [(0, 1), (0, 2), (1, 3)]
    assert stored.where("stored_at IS NULL").isEmpty()


def test_late_results_count_and_equal_the_batch(spark, tmp_path, landing):
    out, checkpoint = str(tmp_path / "minutes"), str(tmp_path / "checkpoint")
    path = landing([result("c", i, i % 4, 1704067200.0 + 13 * i) for i in range(40)])
    run(streams.replace_stats(streams.minute_stats(sources.result_stream(spark, path)), out, checkpoint))
    landing([result("c", 99, 9, 1704060000.0), result("d", 0, 1, 1704067200.0)])
    run(streams.replace_stats(streams.minute_stats(sources.result_stream(spark, path)), out, checkpoint))
    batch = plans.per_minute(sources.read_json(spark, path, "camera_id string, frame_id int, person_count int, processed_timestamp double"))
    assert sorted(rows(tables.read_replaced(spark, out))) == sorted(rows(batch))


def test_append_mode_emits_closed_minutes(spark, tmp_path, landing):
    out, checkpoint = str(tmp_path / "closed"), str(tmp_path / "checkpoint")
    path = landing([result("c", i, 1, 1704067200.0 + 60 * i) for i in range(30)])
    stats = streams.minute_stats(sources.result_stream(spark, path), "5 minutes")
    run(streams.append_stats(stats, out, checkpoint))
    closed = spark.read.parquet(out)
    assert 0 < closed.count() < 30
    batch = plans.per_minute(sources.read_json(spark, path, "camera_id string, frame_id int, person_count int, processed_timestamp double"))
    assert closed.exceptAll(batch).isEmpty()


def test_detection_of_frames(spark, tmp_path):
    def model(images):
        return [{"detections": json.loads(image), "image": b"drawn " + image} for image in images]

    boxes = [{"class_id": 0, "confidence": 0.4, "x1": 1.9, "y1": 2.0, "x2": 3.0, "y2": 4.0},
             {"class_id": 0, "confidence": 0.3, "x1": 0, "y1": 0, "x2": 0, "y2": 0},
             {"class_id": 2, "confidence": 0.9, "x1": 0, "y1": 0, "x2": 0, "y2": 0}]
    frames = spark.createDataFrame(
        [("c", 0, 1.5, 640, 480, json.dumps(boxes)), ("c", 1, 2.5, 640, 480, "[]"), ("c", 2, 3.5, 640, 480, None)],
        "camera_id string, frame_id int, timestamp double, width int, height int, image_data string",
    ).withColumn("image_data", F.base64(F.col("image_data").cast("binary")))
    frames = frames.unionByName(frames.where("frame_id = 1").withColumns({"frame_id": F.lit(3), "image_data": F.lit("%no base64%")}))
    path, landing, out = (str(tmp_path / x) for x in ("frames", "results", "stored"))
    tables.publish_folder(frames, path)
    run(streams.publish(detect_frames(sources.frame_stream(spark, path), model), landing, str(tmp_path / "c1")))
    run(streams.store(sources.result_stream(spark, landing), out, str(tmp_path / "c2")))
    first, second, *others = spark.read.parquet(out).orderBy("frame_id").collect()
    assert [(o.person_count, o.boxes, o.annotated_image) for o in others] == [(0, [], None)] * 2
    [image] = plans.latest_image(sources.read_results(spark, out).where("frame_id = 1")).collect()
    assert bytes(image.image) == b"drawn []"
    assert (first.person_count, second.person_count) == (1, 0)
    assert first.boxes[0].confidence == 0.4 and first.boxes[0].bbox.x1 == 1
    assert (first.source_timestamp, first.image_size.width) == (1.5, 640)
    assert first.processing_time_ms >= 0 and first.processed_timestamp > 1700000000
    assert second.boxes == []


def test_a_batch_beside_a_stream_is_read_back(spark, tmp_path, landing):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    path = landing([result("c", 0, 1, 1704067200.0)])
    run(streams.store(sources.result_stream(spark, path), out, checkpoint))
    tables.append_results(sources.read_json(spark, path, "camera_id string, frame_id int"), out)
    landing([result("c", 1, 1, 1704067201.0)])
    run(streams.store(sources.result_stream(spark, path), out, checkpoint))
    assert sorted(rows(sources.read_results(spark, out, ("frame_id",)))) == [(0,), (0,), (1,)]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    out = str(tmp_path / "out")
    for n in (5, 3):
        tables.store_results(spark.range(n), out, "query-0")
    tables.store_results(spark.range(2), out, "query-1")
    assert sources.read_results(spark, out).count() == 5


@pytest.mark.parametrize("sizes, want", [([], []), ([None, 0], []), ([9] * 70, [32, 32, 6]), ([40 << 20, 30 << 20, 1], [1, 2])])
def test_images_of_one_call(sizes, want):
    class Image(bytes):
        def __len__(self):
            return self.size

    images = []
    for size in sizes:
        image = None if size is None else Image()
        if image is not None:
            image.size = size
        images.append(image)
    assert [len(run) for run in batches_of(images)] == want
