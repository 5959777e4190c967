"""Decoded images as rows of Spark's image struct (BGR bytes)."""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from likeness.functions import paths as P
from likeness.schemas import IMAGE
from likeness.sources.files import contents

# Bytes of decoded images in one batch, and images at most.
BATCH_BYTES, STEP = 64 * 1024 * 1024, 64
# Type codes of 8-bit images with 1, 3 and 4 channels.
MODES = {1: 0, 3: 16, 4: 24}


def decode_folder(spark: SparkSession, folder) -> DataFrame:
    """``path, image`` through Spark's image source (JPEG, PNG, BMP, GIF). Files it
    cannot decode have height -1. ``folder`` may be a list of paths; they are taken
    literally. The source leaves out names that start with "_" or ".": to decode a
    whole catalogue use ``decode_files``."""
    def literal(path):
        return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)

    folder = [literal(f) for f in ([folder] if isinstance(folder, str) else folder)]
    images = (spark.read.format("image").option("dropInvalid", False)
              .option("recursiveFileLookup", True).load(folder))
    return images.select(P.canonical_path(F.col("image.origin"), encoded=True).alias("path"), "image")


def decode_files(files: DataFrame, decode) -> DataFrame:
    """Adds ``image``: each path read and decoded in its task by a function
    ``bytes -> uint8 array (height, width, channels) in BGR``. A file that cannot be
    read or decoded gets height -1. Batches are cut by the bytes of their images."""
    schema = T.StructType([*files.schema.fields, T.StructField("image", IMAGE)])
    kind = pa.struct([("origin", pa.string()), ("height", pa.int32()), ("width", pa.int32()),
                      ("nChannels", pa.int32()), ("mode", pa.int32()), ("data", pa.binary())])

    def run(batches):
        for batch in batches:
            start, images, size = 0, [], 0
            paths = batch.column("path")
            for row, (path, content) in enumerate(zip(paths.to_pylist(), contents(paths))):
                images.append(to_struct(path, decoded(content, decode)[0]))
                size += len(images[-1]["data"])
                if size > BATCH_BYTES or len(images) == STEP or row + 1 == batch.num_rows:
                    piece = batch.slice(start, len(images))
                    yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(images, kind)],
                                                     names=[*piece.schema.names, "image"])
                    start, images, size = row + 1, [], 0

    return files.mapInArrow(run, schema)


def decoded(content, decode):
    """(pixels or None, class of the error or None) of a file's bytes, or of the error
    that came instead. Running out of memory is no property of a file and fails the task."""
    if isinstance(content, OSError):
        return None, type(content).__name__
    try:
        pixels = decode(content)
        if pixels is None:
            return None, "undecodable"
        pixels = np.asarray(pixels, dtype=np.uint8)
        pixels = pixels.reshape(*pixels.shape[:2], -1)
        return (pixels, None) if pixels.shape[2] in MODES and pixels.size else (None, "undecodable")
    except (MemoryError, ImportError):
        raise
    except Exception as error:  # a user's decoder may raise anything on a broken file
        return None, type(error).__name__


def to_struct(path, pixels):
    if pixels is None:
        return {"origin": path, "height": -1, "width": -1, "nChannels": -1, "mode": -1, "data": b""}
    height, width, channels = pixels.shape
    return {"origin": path, "height": height, "width": width, "nChannels": channels,
            "mode": MODES[channels], "data": pixels.tobytes()}


def library_decode(content):
    """Decode with the imaging library of the executor; none installed is an error there."""
    try:
        import cv2
    except ImportError:
        import io
        from PIL import Image
        return np.asarray(Image.open(io.BytesIO(content)).convert("RGB"))[:, :, ::-1]
    return cv2.imdecode(np.frombuffer(content, np.uint8), cv2.IMREAD_COLOR)


def readable(images: DataFrame) -> DataFrame:
    return images.where(F.col("image.height") > 0)
