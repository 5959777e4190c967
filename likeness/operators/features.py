"""Feature extraction as Arrow jobs over decoded images.

Input is a DataFrame with ``image_id``, an image struct in ``image`` and any other
columns, which travel along. Every image gives one output row; where it could not
be read the vector is NULL, so that jobs can count failures and later runs try
again. Each image is unpacked once, however many features are asked for.
"""

import uuid
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, functions as F, types as T

from likeness.functions import pixels as X
from likeness.schemas import FILLED_FLOATS, FLOATS
from likeness.sources import images as source
from likeness.sources.files import contents

# Images taken through a kernel at once.
STEP = 64
_models = {}


@dataclass(frozen=True)
class Extractor:
    """How images are resized and which kernel turns a stack of them into rows.
    ``load`` runs on the executor and returns the kernel; ``dim`` is about how many values
    a vector has, for the size of output files."""
    size: int
    load: Callable
    how: str = "area"
    to_grey: bool = False
    dim: int = 1280


def extract(images: DataFrame, extractors: dict, step: int = STEP) -> DataFrame:
    """The input columns but ``image``, plus one vector column per extractor."""
    return _extract(images, "image", lambda piece: unpacked(piece.column("image")), extractors, step, False)


def extract_files(files: DataFrame, extractors: dict, decode, step: int = STEP) -> DataFrame:
    """The same for files named in ``path``, with the class of the error in ``error`` where a file
    cannot be read or decoded. Files are read, decoded and reduced to vectors in one
    pass, one image at a time, so that neither file contents nor pixels travel and only one
    whole image is in memory."""
    return _extract(files, None, lambda piece: opened(piece.column("path"), decode), extractors, step, True)


def _extract(table, consumed, load_images, extractors, step, with_error):
    others = [c for c in table.columns if c != consumed]
    schema = T.StructType([table.schema[c] for c in others]
                          + [T.StructField(name, FILLED_FLOATS) for name in extractors]
                          + [T.StructField("error", T.StringType())] * with_error)

    def run(batches):
        kernels = {name: e.load() for name, e in extractors.items()}
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                piece = batch.slice(start, step)
                stacks, rows, errors = {name: [] for name in extractors}, [], []
                for row, (image, error) in enumerate(load_images(piece)):
                    errors.append(error)
                    if image is None:
                        continue
                    rows.append(row)
                    for name, e in extractors.items():
                        stacks[name].append(X.resize(X.grey(image) if e.to_grey else image, e.size, e.how))
                columns = [piece.column(c) for c in others]
                for name in extractors:
                    vectors = kernels[name](np.stack(stacks[name])) if rows else None
                    columns.append(with_nulls(vectors, rows, piece.num_rows))
                columns += [pa.array(errors, pa.string())] * with_error
                yield pa.RecordBatch.from_arrays(columns, names=[*others, *extractors, *["error"] * with_error])

    return table.mapInArrow(run, schema)


def opened(paths, decode):
    """(BGR array or None, error class or None) of each file, one after another."""
    for content in contents(paths):
        pixels, error = source.decoded(content, decode)
        if pixels is None:
            yield None, error
        else:
            yield X.to_bgr(pixels.tobytes(), *pixels.shape), None


def unpacked(column):
    """The same of each image of a struct column."""
    for image in column.to_pylist():
        if image is None or image["height"] is None or image["height"] <= 0:
            yield None, "undecodable"
            continue
        try:
            yield X.to_bgr(image["data"], image["height"], image["width"], image["nChannels"]), None
        except ValueError:  # bytes that do not fit the stated size
            yield None, "ValueError"


def with_nulls(vectors, rows, count):
    """List column of ``count`` rows with the vectors at ``rows``, NULL elsewhere; a
    vector that is not finite is NULL too."""
    filled = np.zeros(count, bool)
    flat, width = np.empty(0, np.float32), 0
    if vectors is not None:
        good = np.isfinite(vectors).all(axis=1)
        filled[np.asarray(rows)[good]] = True
        kept = vectors if good.all() else vectors[good]
        flat, width = kept.astype(np.float32, copy=False).ravel(), vectors.shape[1]
    ends = np.concatenate([[0], np.cumsum(filled * width)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(flat), mask=pa.array(~filled, pa.bool_()))


def hsv_extractor():
    return Extractor(X.HSV_SIZE, lambda: X.hsv_descriptors, dim=176)


def unit_hsv_extractor():
    """The colour descriptor of a query: unit length over both parts together."""
    return Extractor(X.HSV_SIZE, lambda: lambda bgr: X.unit(X.hsv_descriptors(bgr), 1e-12))


def hog_extractor():
    return Extractor(X.HOG_SIZE, lambda: X.hog_descriptors, to_grey=True, dim=1764)


def signature_extractor(bins=(8, 8)):
    return Extractor(X.HSV_SIZE, lambda: lambda bgr: X.colour_signatures(bgr, bins), how="linear")


def model_extractor(make_predict_fn):
    """Model output at unit length. The model is loaded once per worker process."""
    key = uuid.uuid4().hex

    def load():
        if key not in _models:
            _models.clear()
            _models[key] = make_predict_fn()
        predict = _models[key]
        return lambda bgr: X.unit(np.asarray(predict(X.model_inputs(bgr)), dtype=np.float64))

    return Extractor(X.MODEL_SIZE, load)


def hsv_vectors(images: DataFrame) -> DataFrame:
    """176 values: hue/saturation histogram and brightness histogram."""
    return extract(images, {"vector": hsv_extractor()})


def hog_vectors(images: DataFrame) -> DataFrame:
    """1764 values: histogram of oriented gradients at unit length."""
    return extract(images, {"vector": hog_extractor()})


def colour_signatures(images: DataFrame, bins=(8, 8)) -> DataFrame:
    """64 values: the older unmasked hue/saturation histogram."""
    return extract(images, {"vector": signature_extractor(bins)})


def embeddings(images: DataFrame, make_predict_fn, batch_size: int = 384) -> DataFrame:
    """Model output at unit length. Reading, preparing and predicting happen in one
    pass through Python, so the large input tensors never travel."""
    return extract(images, {"vector": model_extractor(make_predict_fn)}, batch_size)


def query_features(images: DataFrame, make_predict_fn) -> DataFrame:
    """``query_id, embedding, hsv_vector, hog_vector`` of query images, each at unit
    length or NULL, in one pass over the images."""
    return extract(images.withColumnRenamed("image_id", "query_id"), {
        "embedding": model_extractor(make_predict_fn),
        "hsv_vector": unit_hsv_extractor(), "hog_vector": hog_extractor()})


def grey_images(images: DataFrame, size: int = X.HOG_SIZE) -> DataFrame:
    """Grey values of the resized images, row by row."""
    flat = Extractor(size, lambda: lambda stack: stack.reshape(len(stack), -1), to_grey=True)
    return extract(images, {"vector": flat})


def resized(images: DataFrame, size: int, how: str = "area") -> DataFrame:
    """BGR values of the resized images, row by row."""
    flat = Extractor(size, lambda: lambda stack: stack.reshape(len(stack), -1), how)
    return extract(images, {"vector": flat})


def model_inputs(images: DataFrame) -> DataFrame:
    """Standardised RGB planes, 3 x 224 x 224 values."""
    flat = Extractor(X.MODEL_SIZE, lambda: lambda bgr: X.model_inputs(bgr).reshape(len(bgr), -1))
    return extract(images, {"vector": flat})


def model_inference(inputs: Column, make_predict_fn, batch_size: int = 384) -> Column:
    """Raw model output for prepared inputs; ``make_predict_fn`` loads the model on
    the executor and returns a function of a (n, 3, 224, 224) batch."""
    predict = predict_batch_udf(
        make_predict_fn, return_type=FLOATS, batch_size=batch_size,
        input_tensor_shapes=[[3, X.MODEL_SIZE, X.MODEL_SIZE]])
    return predict(inputs)
