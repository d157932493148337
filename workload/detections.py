"""Detection analyses, batch and streaming, on the test tables."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tallywood.functions.documents import (
    RESULT_SCHEMA,
    decode_base64,
    decode_json,
    encode_base64,
    encode_json,
    person_boxes,
    result_document,
)
from tallywood.plans import detections as plans
from tallywood.session import fresh_dir
from tallywood.sinks import tables
from tallywood.sinks.records import write_record
from tallywood.sources import detections as sources
from tallywood.streaming import minutes
from tallywood.streaming import results as streams
from tallywood.streaming.detect import detect_frames
from workload import views

CAMERA = "error"

RESULTS_SQL = """(SELECT event_type AS camera_id, CAST(event_id AS INTEGER) AS frame_id,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS person_count, value AS processing_time_ms,
  CAST(epoch_us(ts) AS DOUBLE) / 1000000 AS processed_timestamp,
  CAST(epoch_us(ts) AS DOUBLE) / 1000000 AS stored_at FROM events)"""
MEAN_MS_SQL = "CAST(sum(CAST(processing_time_ms AS DECIMAL(18,2))) AS DOUBLE) / count(*)"
MEAN_PEOPLE_SQL = "sum(person_count) / count(*)"
MINUTE_SQL = f"""SELECT camera_id, strftime(make_timestamp(CAST(floor(processed_timestamp) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M') AS datetime,
  count(frame_id) AS n_frames, {MEAN_PEOPLE_SQL} AS avg_people, max(person_count) AS max_people
FROM {RESULTS_SQL} GROUP BY 1, 2"""
NEWEST_SQL = "ORDER BY stored_at DESC, camera_id, frame_id DESC"
BOXES_SQL = """(SELECT vec_id, CAST(printf('%.4f', c) AS DOUBLE) AS confidence,
  CAST(trunc(x * 100) AS INTEGER) AS x1, CAST(trunc(x * 200) AS INTEGER) AS y1,
  CAST(trunc(x * 300) AS INTEGER) AS x2, CAST(trunc(x * 400) AS INTEGER) AS y2
  FROM (SELECT vec_id, i, x, abs(x) * 2 AS c
        FROM (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x,
              generate_subscripts(embedding, 1) - 1 AS i FROM embeddings))
  WHERE i % 2 = 0 AND c >= 0.4)"""
# What the model below finds in a frame, as SQL.
PEOPLE_SQL = """(SELECT camera_id, frame_id, CAST(len(list_filter(range(0, k % 5),
    lambda j: j % 2 = 0 AND CAST((k * 7 + j * 13) % 100 AS DOUBLE) / 100 >= 0.4)) AS INTEGER) AS person_count
  FROM (SELECT event_type AS camera_id, CAST(event_id AS INTEGER) AS frame_id,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""


def stand_in_model():
    """Boxes made from the number in the payload; a local function travels to the workers whole."""

    def model(images: list[bytes]) -> list[dict]:
        found = []
        for image in images:
            k = json.loads(image)["k"]
            boxes = [
                {"class_id": j % 2, "confidence": (k * 7 + j * 13) % 100 / 100,
                 "x1": 1.5 * j, "y1": 2.5 * j, "x2": 3.5 * j, "y2": 4.5 * j}
                for j in range(k % 5)
            ]
            found.append({"detections": boxes, "image": image})
        return found

    return model


def boxes(spark, d):
    found = views.detections(spark, d).select(
        "vec_id", F.explode(person_boxes(F.col("detections"))).alias("box")
    )
    return found.select("vec_id", "box.confidence", "box.bbox.*")


def box_counts(spark, d):
    found = person_boxes(F.col("detections"))
    return views.detections(spark, d).select("vec_id", F.size(found).alias("person_count"))


def envelope(spark, d):
    """A result document from each frame, to JSON and back."""
    boxed = views.frames(spark, d).select(
        "*", (F.col("timestamp") + 1).alias("processed_timestamp"),
        F.lit(93.38).alias("processing_time_ms"),
        F.array(F.struct(
            F.lit(0.5).alias("confidence"),
            F.struct(*[F.lit(i).alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"))]).alias("bbox"),
        )).alias("boxes"),
    )
    sent = boxed.select(*result_document()).select(encode_json("*").alias("value"))
    read = sent.select(decode_json(F.col("value"), RESULT_SCHEMA).alias("r")).select("r.*")
    return read.select(
        "camera_id", "frame_id", "source_timestamp", "processed_timestamp", "processing_time_ms",
        "image_size.width", "image_size.height", "person_count",
        F.col("boxes")[0]["bbox"]["y2"].alias("y2"),
    )


def base64_roundtrip(spark, d):
    encoded = encode_base64(F.col("text").cast("binary"))
    rows = views.table(spark, d, "documents").select("doc_id", "text", encoded.alias("encoded"))
    decoded = decode_base64(F.col("encoded")).cast("string")
    return rows.select(
        "doc_id", F.md5(F.col("encoded").cast("binary")).alias("encoded_md5"),
        (decoded == F.col("text")).alias("same"),
    )


def stats_overall(spark, d):
    return plans.overall(views.results(spark, d))


def stats_minute(spark, d):
    return plans.per_minute(views.results(spark, d))


def stats_camera(spark, d):
    return plans.camera_stats(views.results(spark, d), CAMERA)


def latest_results(spark, d):
    return plans.latest(views.results(spark, d))


def latest_by_camera(spark, d):
    return plans.latest(views.results(spark, d), camera=CAMERA)


def latest_one(spark, d):
    return plans.latest_one(views.results(spark, d))


def latest_image(spark, d):
    found = plans.latest_image(views.results(spark, d))
    return found.select("camera_id", "frame_id", F.col("image").cast("string").alias("image"))


def export_latest(spark, d):
    path = fresh_dir(spark, "export")
    tables.export_newest(views.results(spark, d), path)
    schema = ("camera_id string, frame_id int, person_count int, processing_time_ms double, "
              "processed_timestamp double, stored_at double")
    return sources.read_json(spark, path, schema)


def replaced_stats(spark, d):
    """The per-minute table, written twice: the second run replaces the first."""
    path = fresh_dir(spark, "stats")
    for _ in range(2):
        tables.replace_table(stats_minute(spark, d), path)
    return tables.read_replaced(spark, path)


def minute_table(spark, d):
    """The per-minute table kept up by batches: on time, late, and on time once more."""
    path = fresh_dir(spark, "minutes")
    found = views.results(spark, d)
    late = F.pmod(F.col("frame_id"), F.lit(7)) == 0
    for number, batch in ((0, found.where(~late)), (1, found.where(late)), (0, found.where(~late)), (1, found.where(late))):
        minutes.merge_batch(batch, path, "results", number)
    return minutes.read_minutes(spark, path)


def stream_minute_table(spark, d):
    """The same from a stream that takes some files at a time and starts again at its end."""
    path, landing, checkpoint = fresh_dir(spark, "minutes"), _result_folder(spark, d), _checkpoint(spark)
    for _ in range(2):
        arriving = sources.result_stream(spark, landing, files_per_trigger=4)
        minutes.keep_minutes(arriving, path, checkpoint).awaitTermination()
    return minutes.read_minutes(spark, path)


def newest_of_store(spark, d):
    """The newest results of a table that is stored by the days of its events."""
    path = fresh_dir(spark, "days")
    tables.store_stamped(tables.without_image(views.results(spark, d)), path, "events")
    return tables.newest_stored(spark, path, plans.LISTED, (*sources.ANALYSIS_FIELDS, tables.STORED_AT))


def stored_on_two_days(spark, d):
    """A part that is written on one day and again on the next is there once."""
    path = fresh_dir(spark, "retried")
    found = views.results(spark, d).drop("stored_at")
    write_record(spark, f"{path}/_parts/batch-0", "1704067199.5")
    for part in ("batch-0", "batch-1", "batch-0"):
        chosen = found.where((F.col("frame_id") % 2 == 0) if part == "batch-0" else (F.col("frame_id") % 2 == 1))
        tables.store_results(chosen, path, part)
    stored = sources.read_results(spark, path, (*sources.ANALYSIS_FIELDS, tables.STORED_AT))
    return stored.withColumn("early", F.col(tables.STORED_AT) == 1704067199.5).drop(tables.STORED_AT)


def stored_batch(spark, d):
    """Results appended as a table and read back with the fields of the analysis."""
    path = fresh_dir(spark, "results")
    tables.append_results(views.results(spark, d).drop("stored_at"), path)
    return sources.read_results(spark, path, sources.ANALYSIS_FIELDS)


def published_inferred(spark, d):
    """Documents in a folder, read back with an inferred schema."""
    path = fresh_dir(spark, "published")
    tables.publish_folder(tables.without_image(views.results(spark, d)), path)
    found = sources.read_json(spark, path)
    return found.select("camera_id", "frame_id", "person_count", "processing_time_ms", "stored_at")


def _frame_folder(spark, d):
    path = fresh_dir(spark, "frames")
    tables.publish_folder(views.frames(spark, d), path)
    return path


def _result_folder(spark, d):
    path = fresh_dir(spark, "detected")
    found = views.results(spark, d).withColumn("source_timestamp", F.col("processed_timestamp"))
    tables.publish_folder(tables.without_image(found), path)
    return path


def _checkpoint(spark):
    return fresh_dir(spark, "checkpoint")


def stream_append(spark, d):
    """Result documents of a landing folder, stored by a stream."""
    path = fresh_dir(spark, "stored")
    arriving = sources.result_stream(spark, _result_folder(spark, d), files_per_trigger=4)
    streams.store(arriving, path, _checkpoint(spark)).awaitTermination()
    return sources.read_results(spark, path, sources.ANALYSIS_FIELDS)


def stream_minute_stats(spark, d):
    path = fresh_dir(spark, "minutes")
    arriving = sources.result_stream(spark, _result_folder(spark, d))
    streams.replace_stats(streams.minute_stats(arriving), path, _checkpoint(spark)).awaitTermination()
    return tables.read_replaced(spark, path)


def stream_detect(spark, d):
    """Frames to results to stored results: two streams with a folder between them."""
    landing, path = fresh_dir(spark, "results"), fresh_dir(spark, "stored")
    frames = sources.frame_stream(spark, _frame_folder(spark, d))
    streams.publish(detect_frames(frames, stand_in_model()), landing, _checkpoint(spark)).awaitTermination()
    found = sources.result_stream(spark, landing)
    streams.store(found, path, _checkpoint(spark)).awaitTermination()
    return sources.read_results(spark, path, ("camera_id", "frame_id", "person_count"))


def batch_detect(spark, d):
    frames = views.frames(spark, d)
    return detect_frames(frames, stand_in_model()).select("camera_id", "frame_id", "person_count")


FIELDS_SQL = "camera_id, frame_id, person_count, processing_time_ms, processed_timestamp"

QUERIES = {
    "detection_boxes": (boxes, f"SELECT * FROM {BOXES_SQL}"),
    "detection_filter_count": (
        box_counts,
        f"SELECT e.vec_id, CAST(count(b.vec_id) AS INTEGER) AS person_count FROM embeddings e "
        f"LEFT JOIN {BOXES_SQL} b ON b.vec_id = e.vec_id GROUP BY e.vec_id"),
    "detection_envelope_json": (
        envelope,
        """SELECT event_type AS camera_id, CAST(event_id AS INTEGER) AS frame_id,
  CAST(epoch_us(ts) AS DOUBLE) / 1000000 AS source_timestamp,
  CAST(epoch_us(ts) AS DOUBLE) / 1000000 + 1 AS processed_timestamp,
  CAST(93.38 AS DOUBLE) AS processing_time_ms, 640 AS width, 480 AS height, 1 AS person_count, 3 AS y2 FROM events"""),
    "payload_base64_roundtrip": (
        base64_roundtrip,
        "SELECT doc_id, md5(to_base64(encode(text))) AS encoded_md5, "
        "decode(from_base64(to_base64(encode(text)))) = text AS same FROM documents"),
    "detection_stats_global": (
        stats_overall,
        f"SELECT count(frame_id) AS n_frames, {MEAN_PEOPLE_SQL} AS avg_people, max(person_count) AS max_people, "
        f"min(person_count) AS min_people, {MEAN_MS_SQL} AS avg_ms FROM {RESULTS_SQL}"),
    "detection_stats_minute": (stats_minute, MINUTE_SQL),
    "detection_stats_camera": (
        stats_camera,
        f"SELECT camera_id, count(*) AS total_frames, {MEAN_PEOPLE_SQL} AS avg_person_count, "
        f"max(person_count) AS max_person_count, {MEAN_MS_SQL} AS avg_processing_time_ms "
        f"FROM {RESULTS_SQL} WHERE camera_id = '{CAMERA}' GROUP BY camera_id"),
    "latest_results": (latest_results, f"SELECT * FROM {RESULTS_SQL} {NEWEST_SQL} LIMIT 20"),
    "latest_by_camera": (
        latest_by_camera, f"SELECT * FROM {RESULTS_SQL} WHERE camera_id = '{CAMERA}' {NEWEST_SQL} LIMIT 20"),
    "latest_one": (latest_one, f"SELECT * FROM {RESULTS_SQL} {NEWEST_SQL} LIMIT 1"),
    "latest_image": (
        latest_image,
        "SELECT event_type AS camera_id, CAST(event_id AS INTEGER) AS frame_id, props AS image FROM events "
        "ORDER BY ts DESC, event_type, event_id DESC LIMIT 1"),
    "export_latest": (export_latest, f"SELECT * FROM {RESULTS_SQL} {NEWEST_SQL} LIMIT 500"),
    "stats_table_replaced": (replaced_stats, MINUTE_SQL),
    "minute_table_kept": (minute_table, MINUTE_SQL),
    "stream_minute_table": (stream_minute_table, MINUTE_SQL),
    "latest_of_store": (newest_of_store, f"SELECT * FROM {RESULTS_SQL} {NEWEST_SQL} LIMIT 20"),
    "results_retried_next_day": (
        stored_on_two_days, f"SELECT {FIELDS_SQL}, frame_id % 2 = 0 AS early FROM {RESULTS_SQL}"),
    "results_appended": (stored_batch, f"SELECT {FIELDS_SQL} FROM {RESULTS_SQL}"),
    "documents_published_inferred": (
        published_inferred,
        "SELECT camera_id, CAST(frame_id AS BIGINT) AS frame_id, CAST(person_count AS BIGINT) AS person_count, "
        f"processing_time_ms, stored_at FROM {RESULTS_SQL}"),
    "detect_batch": (batch_detect, f"SELECT * FROM {PEOPLE_SQL}"),
    "stream_append": (stream_append, f"SELECT {FIELDS_SQL} FROM {RESULTS_SQL}"),
    "stream_minute_stats": (stream_minute_stats, MINUTE_SQL),
    "stream_detect": (stream_detect, f"SELECT * FROM {PEOPLE_SQL}"),
}
