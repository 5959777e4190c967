"""Texts in Arrow tasks: bounded slices, code points, and a map over a text column."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Texts a kernel works on at a time; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20
# Bytes of an Arrow batch of texts, and what Spark says where none are set.
BATCH_BYTES, DEFAULT_BATCH = 8 << 20, "67108864b"


# Where the C library has it (glibc).
MALLOC_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Hand freed memory back to the system: workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    if MALLOC_TRIM is not None:
        MALLOC_TRIM(0)


_held: dict = {}
_asked = [False]


def small_batches(spark) -> None:
    """Let the session hand texts to workers in batches of BATCH_BYTES, unless it sets a size of its
    own: several copies of a batch are in memory at once, outside the heap."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == DEFAULT_BATCH:
        spark.conf.set(name, str(BATCH_BYTES))


def only(key, build):
    """``build()``, kept in this worker process until another operator's tasks run in it: of the
    large models of all operators a worker holds one."""
    _asked[0] = True
    if key not in _held:
        _held.clear()
        give_back()
        _held[key] = build()
    return _held[key]


def only_rows() -> None:
    """Called by tasks that need no model: what this worker process kept of other operators goes."""
    if _held:
        _held.clear()
        give_back()


def whole(column: pa.Array) -> pa.Array:
    """The texts as 64-bit strings that start at offset 0; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def offsets_of(texts: pa.Array) -> np.ndarray:
    return np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, the row limits in them)."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = offsets_of(texts)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[ends[0]:ends[-1]], ends - ends[0]


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all code points, the row limits in them). Bytes that are no UTF-8 count as U+FFFD."""
    data, limits = raw_bytes(texts)
    try:
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    except UnicodeDecodeError:
        mended = [t.decode("utf-8", "replace") for t in texts.cast(pa.large_binary()).to_pylist()]
        return code_points(pa.array(mended, pa.large_string()))
    if len(points) == len(data):
        return points, limits
    leads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)))
    return points, leads[limits]


def slices(texts: pa.Array, most: int = SLICE_BYTES):
    """(first, last) row ranges of at most ``most`` bytes, or one row."""
    ends, start = offsets_of(texts), 0
    while start < len(texts):
        stop = int(np.searchsorted(ends, ends[start] + most, "right")) - 1
        stop = min(max(stop, start + 1), len(texts))
        yield start, stop
        start = stop


def map_text(df: DataFrame, make, fields: str, text: str = "text", keep=None, most: int = SLICE_BYTES) -> DataFrame:
    """``df`` with the columns of ``fields``, computed from its text column.

    ``make()`` runs once a task and gives ``kernel(texts) -> arrays``, one per field,
    over slices of at most ``most`` bytes, or one text. Null texts are handed over as empty. ``keep`` names the
    columns to hand on (all by default); a column whose name is among ``fields`` is replaced.
    """
    small_batches(df.sparkSession)
    new = T.StructType.fromDDL(fields)
    kept = [c for c in (df.columns if keep is None else keep) if c not in new.names]
    if text in kept and dict(df.dtypes)[text] == "string":  # a text that is handed on travels once
        source, at = df.select(*[F.col(f"`{c}`") for c in kept]), kept.index(text)
    else:
        source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("__text"))
        at = len(kept)
    schema = T.StructType([source.schema[c] for c in kept] + new.fields)
    n_kept, n_new = len(kept), len(new.fields)

    def run(batches):
        out = to_arrow_schema(schema)
        _asked[0] = False
        kernel = make()
        if not _asked[0]:
            only_rows()
        for batch in batches:
            columns = batch.columns
            texts = whole(columns[at])
            for start, stop in slices(texts, most):
                made = kernel(texts.slice(start, stop - start))
                assert len(made) == n_new
                arrays = [c.slice(start, stop - start) for c in columns[:n_kept]]
                arrays += [m if isinstance(m, pa.Array) else pa.array(m) for m in made]
                yield pa.RecordBatch.from_arrays(
                    [a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, out, strict=True)], schema=out)
            del columns, texts, batch
            give_back()

    return source.mapInArrow(run, schema)
