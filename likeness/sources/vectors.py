"""Import and storage of feature vectors."""

import io

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from likeness.functions import paths as P

VECTOR_ROWS = "image_id long, vector array<float>"


# Bytes of vectors that one file of a feature table holds, about.
FILE_BYTES = 256 * 1024 * 1024


def _lists(vectors):
    ends = np.cumsum([0] + [0 if v is None else len(v) for v in vectors]).astype(np.int32)
    present = [v for v in vectors if v is not None]
    flat = np.concatenate(present) if present else np.empty(0, np.float32)
    return pa.ListArray.from_arrays(ends, pa.array(flat.astype(np.float32)),
                                    mask=pa.array([v is None for v in vectors], pa.bool_()))


def from_blobs(table: DataFrame, column: str, dtype: str = "float32") -> DataFrame:
    """``image_id, vector`` from raw little-endian float32 or float16 bytes. Bytes
    that are no whole number of values give NULL. A batch's bytes are read as one array."""
    kind = np.dtype(dtype).newbyteorder("<")

    def run(batches):
        for batch in batches:
            blobs = batch.column(1).cast(pa.large_binary())
            ends = np.frombuffer(blobs.buffers()[1], np.int64)[blobs.offset:blobs.offset + len(blobs) + 1]
            size = np.diff(ends)
            good = blobs.is_valid().to_numpy(zero_copy_only=False) & (size % kind.itemsize == 0)
            data = np.frombuffer(blobs.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]] if len(blobs) else np.zeros(0, np.uint8)
            if not (good | (size == 0)).all():
                data = data[np.repeat(good, size)]
            limits = np.concatenate(([0], np.cumsum(np.where(good, size, 0) // kind.itemsize))).astype(np.int32)
            flat = pa.array(np.frombuffer(data.tobytes(), kind).astype(np.float32))
            vectors = pa.ListArray.from_arrays(limits, flat, mask=pa.array(~good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([batch.column(0), vectors], names=["image_id", "vector"])

    return table.select("image_id", column).mapInArrow(run, VECTOR_ROWS)


def from_npy(files: DataFrame) -> DataFrame:
    """``image_id, vector`` from ``path, content`` rows of .npy files named by id.

    Arrays of shape (D,) and (1, D) are taken; others and broken files are left out.
    """
    def run(batches):
        for batch in batches:
            ids, vectors = [], []
            for name, content in zip(batch.column("name").to_pylist(),
                                     batch.column("content").to_pylist()):
                try:
                    array = np.load(io.BytesIO(content), allow_pickle=False)
                    number = int(name)
                except (ValueError, TypeError, EOFError, OSError):
                    continue
                if array.ndim == 2 and array.shape[0] == 1:
                    array = array[0]
                if array.ndim == 1:
                    ids.append(number)
                    vectors.append(array.astype(np.float32))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), _lists(vectors)],
                                             names=["image_id", "vector"])

    named = files.select(F.regexp_replace(P.file_name(F.col("path")), r"\.npy$", "").alias("name"),
                         "content")
    return named.mapInArrow(run, VECTOR_ROWS)


def files_per_shard(rows: int, dim: int, shards: int = 64) -> int:
    """How many files a shard takes so that each holds about FILE_BYTES of vectors."""
    return max(1, -(-rows * (4 * dim + 32) // (FILE_BYTES * max(1, shards))))


def by_shard(table: DataFrame, shards: int = 64, per_shard: int = 1) -> DataFrame:
    """``table`` with ``shard``, dealt so that each file to be written is one task's rows."""
    width = len(str(max(shards - 1, 0)))
    part = F.pmod(F.xxhash64("image_id"), F.lit(per_shard))
    return (table.withColumn("shard", P.shard_key(F.col("image_id"), shards, width))
            .repartition(max(1, shards) * per_shard, "shard", part))


def append_features(features: DataFrame, path: str, shards: int = 64, per_shard: int | None = None) -> None:
    """Append a batch of feature rows, in folders by shard of the image id. Without
    ``per_shard`` the files' number follows from rows and length (``features`` is then
    run twice and should be a table). The commit makes the batch visible as a whole or not at all."""
    if per_shard is None:
        size = features.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dim")).first()
        per_shard = files_per_shard(size["n"], max(size["dim"] or 0, 1), shards)
    by_shard(features, shards, per_shard).write.partitionBy("shard").mode("append").parquet(path)


def read_features(spark, path: str, schema) -> DataFrame:
    """A feature table; a table not written yet is empty. Any other error is raised: to take a
    damaged or forbidden table for an empty one would compute everything anew."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
