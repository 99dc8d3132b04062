"""Pixel crops of entity views, and keys made of what they show.

Boxes meet pictures one row per picture, so pixels move once however many views are cut from them. A crop's key is a hash
of its size and pixels: equal crops, of one picture or of several, are one request to a view search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenkg.sources.files import stem

CROP = "img_id string, id string, view string, width int, height int, channels int, crop string, pixels binary"
KEY_DIGITS = 16
#: Bytes of pictures that travel to a Python worker at once.
BATCH_BYTES = 64 << 20


def pictures(spark: SparkSession, root: str) -> DataFrame:
    """(img_id, picture) of the images under ``root`` that Spark decodes; pixels are rows of blue, green, red."""
    read = spark.read.format("image").option("dropInvalid", "true").option("recursiveFileLookup", "true").load(root)
    return read.select(stem(F.col("image.origin")).alias("img_id"), F.struct("image.width", "image.height", "image.nChannels", "image.data").alias("picture"))


def _cut(picture: dict, box: dict) -> np.ndarray:
    pixels = np.frombuffer(picture["data"], np.uint8).reshape(picture["height"], picture["width"], picture["nChannels"])
    return np.ascontiguousarray(pixels[max(box["y1"], 0) : box["y2"], max(box["x1"], 0) : box["x2"]])


def _crop_rows(keep_pixels: bool):
    schema = pa.schema([("img_id", pa.string()), ("id", pa.string()), ("view", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("channels", pa.int32()), ("crop", pa.string()), ("pixels", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for img_id, picture, boxes in zip(*b.columns):
                rows, shown = [], picture.as_py()
                for box in boxes.as_py():
                    part = _cut(shown, box)
                    h, w, c = part.shape
                    data = part.tobytes()
                    key = hashlib.sha256(f"{w}x{h}x{c}:".encode() + data).hexdigest()[:KEY_DIGITS]
                    rows.append((img_id.as_py(), box["id"], box["view"], w, h, c, key, data if keep_pixels else None))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    return run


def crops(shown: DataFrame, views: DataFrame, keep_pixels: bool = True) -> DataFrame:
    """The crops of ``views(img_id, id, view, x1, y1, x2, y2)`` from ``shown(img_id, picture)``, with the key of each.

    Where two pictures have one id the first by its pixels counts; a box beyond the picture is cut at its edge; a picture
    without views, or a view without a picture, gives none. ``keep_pixels`` False leaves the pixels null.
    """
    spark = shown.sparkSession
    boxes = views.groupBy("img_id").agg(F.array_sort(F.collect_list(F.struct("id", "view", *[F.col(c).cast("int").alias(c) for c in ("x1", "y1", "x2", "y2")]))).alias("boxes"))
    one = shown.groupBy("img_id").agg(F.min("picture").alias("picture")).join(boxes, "img_id")
    size = str(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")).rstrip("bB")
    if not size.isdigit() or not 0 < int(size) <= BATCH_BYTES:  # pictures are large: few at a time
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return one.select("img_id", "picture", "boxes").mapInArrow(_crop_rows(keep_pixels), CROP)


def crop_keys(shown: DataFrame, views: DataFrame) -> DataFrame:
    """(img_id, id, view, crop) of the views: the key of what each shows."""
    return crops(shown, views, keep_pixels=False).select("img_id", "id", "view", "crop")
