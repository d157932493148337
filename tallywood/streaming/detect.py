"""The detection step: frames in, results out, with a model plugged in by the caller."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.functions.dates import elapsed_ms
from tallywood.functions.documents import (
    CONFIDENCE_THRESHOLD,
    DETECTION_SCHEMA,
    encode_base64,
    person_boxes,
    result_document,
)

# Images to what is found in them, in the same order: dicts with ``detections``, which are dicts
# with class_id, confidence and the corners x1, y1, x2, y2, and, where the model draws, ``image``
# with the bytes of the annotated image.
Detector = Callable[[list[bytes]], list[dict]]

# A call of the model gets so many images and bytes at most, one image at least.
MOST_IMAGES, MOST_BYTES = 32, 64 << 20

_KEPT = "camera_id string, frame_id int, timestamp double, width int, height int"
_SCHEMA = (
    f"{_KEPT}, detections {DETECTION_SCHEMA}, annotated binary, started double, "
    "processed_timestamp double"
)


def batches_of(images: list[bytes | None]) -> Iterator[list[int]]:
    """Places of the images that are there, in runs for one call of the model each."""
    run, size = [], 0
    for place, image in enumerate(images):
        if not image:
            continue
        if run and (len(run) == MOST_IMAGES or size + len(image) > MOST_BYTES):
            yield run
            run, size = [], 0
        run.append(place)
        size += len(image)
    if run:
        yield run


def detect_frames(
    frames: DataFrame, detect: Detector, threshold: float = CONFIDENCE_THRESHOLD
) -> DataFrame:
    """Results of a batch or a stream of frames, in the order of each input partition.

    Only the model runs in Python, on several images at once; decoding, filtering and shaping are
    native expressions. A frame without a readable image has no boxes and is not shown to the
    model. Frames of one call share its times. ``detect`` is sent to the workers; one that loads
    a model should do so on its first call.
    """
    names = ["camera_id", "frame_id", "timestamp", "width", "height"]
    added = ["detections", "annotated", "started", "processed_timestamp"]
    corners = [(name, pa.float64()) for name in ("x1", "y1", "x2", "y2")]
    detections = pa.list_(
        pa.struct([("class_id", pa.int32()), ("confidence", pa.float64()), *corners])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            images = batch.column("image").to_pylist()
            now = time.time()
            found: list[dict] = [{"detections": []}] * len(images)
            begun, done = [now] * len(images), [now] * len(images)
            for places in batches_of(images):
                start = time.time()
                answers = detect([images[place] for place in places])
                end = time.time()
                for place, answer in zip(places, answers, strict=True):
                    found[place], begun[place], done[place] = answer, start, end
            kept = [batch.column(name) for name in names]
            made = [
                pa.array([f["detections"] for f in found], detections),
                pa.array([f.get("image") for f in found], pa.binary()),
                pa.array(begun, pa.float64()), pa.array(done, pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(kept + made, [*names, *added])

    readable = F.try_to_binary(F.col("image_data"), F.lit("base64"))
    images = frames.select(*names, readable.alias("image"))
    detected = images.mapInArrow(run, _SCHEMA)
    spent = elapsed_ms(F.col("started"), F.col("processed_timestamp"))
    boxed = detected.withColumn("processing_time_ms", spent).withColumn(
        "boxes", person_boxes(F.col("detections"), threshold)
    )
    return boxed.select(*result_document(), encode_base64(F.col("annotated")).alias("annotated_image"))
