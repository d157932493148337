"""Nested detection documents: boxes, JSON and base64."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywood.functions.numbers import round_half_even

# The class that is counted and the default confidence threshold.
PERSON_CLASS = 0
CONFIDENCE_THRESHOLD = 0.4

FRAME_SCHEMA = (
    "camera_id string, frame_id int, timestamp double, width int, height int, image_data string"
)
DETECTION_SCHEMA = (
    "array<struct<class_id:int,confidence:double,x1:double,y1:double,x2:double,y2:double>>"
)
RESULT_SCHEMA = (
    "camera_id string, frame_id int, source_timestamp double, processed_timestamp double, "
    "processing_time_ms double, image_size struct<width:int,height:int>, person_count int, "
    "boxes array<struct<confidence:double,bbox:struct<x1:int,y1:int,x2:int,y2:int>>>, "
    "annotated_image string"
)


def person_boxes(detections: Column, threshold: float = CONFIDENCE_THRESHOLD) -> Column:
    """Boxes of the counted class at or above the threshold.

    The confidence is compared before it is rounded to four digits, and box corners lose
    their fractions.
    """
    kept = F.filter(
        detections, lambda d: (d.class_id == PERSON_CLASS) & (d.confidence >= threshold)
    )
    return F.transform(
        kept,
        lambda d: F.struct(
            round_half_even(d.confidence, 4).alias("confidence"),
            F.struct(*[d[c].cast("int").alias(c) for c in ("x1", "y1", "x2", "y2")]).alias("bbox"),
        ),
    )


def result_document(boxes: str = "boxes") -> list[Column]:
    """Columns of a result, from a frame with its boxes and its two processing times."""
    return [
        F.col("camera_id"),
        F.col("frame_id"),
        F.col("timestamp").alias("source_timestamp"),
        F.col("processed_timestamp"),
        F.col("processing_time_ms"),
        F.struct("width", "height").alias("image_size"),
        F.size(boxes).alias("person_count"),
        F.col(boxes).alias("boxes"),
    ]


def encode_base64(payload: Column) -> Column:
    """Base64 on one line."""
    return F.translate(F.base64(payload), "\r\n", "")


def decode_base64(text: Column) -> Column:
    return F.unbase64(text)


def encode_json(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))


def decode_json(text: Column, schema: str) -> Column:
    return F.from_json(text, schema)
