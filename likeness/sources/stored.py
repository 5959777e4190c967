"""Tables in the shared folder that tasks read for themselves, batch by batch.

A task that holds a block of queries meets all rows of such a table one batch after another: nothing of the
table is copied, shuffled or held. Files are written by Spark, whole and once, before the tasks that read them start.
"""

from __future__ import annotations

import urllib.parse
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame

from likeness.session import fresh_dir, open_filesystem, shared_dir

# Bytes of one row group of a file written here, and of a reader's buffer.
GROUP_BYTES, BUFFER_BYTES = 8 << 20, 1 << 20


@dataclass(frozen=True)
class Stored:
    """Parquet files (paths inside the file system) below ``location``, which names the file system."""
    location: str
    files: tuple[str, ...]

    def batches(self, columns: list[str], rows: int, key: str | None = None, wanted: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        """Batches of at most ``rows`` rows. Row groups whose ``key`` statistics hold none of the sorted ``wanted`` are left out."""
        filesystem, _ = open_filesystem(self.location)
        for file in self.files:
            with filesystem.open_input_file(file) as source:
                table = pq.ParquetFile(source, buffer_size=BUFFER_BYTES, pre_buffer=False)
                groups = [g for g in range(table.num_row_groups) if key is None or _may_hold(table.metadata.row_group(g), key, wanted)]
                for batch in table.iter_batches(rows, row_groups=groups, columns=columns, use_threads=False):
                    yield batch.select(columns)


def _may_hold(group, key: str, wanted: np.ndarray) -> bool:
    told = next((c.statistics for c in map(group.column, range(group.num_columns)) if c.path_in_schema == key), None)
    if told is None or not told.has_min_max:
        return True
    return np.searchsorted(wanted, told.min, "left") < np.searchsorted(wanted, told.max, "right")


def folder(location: str) -> Stored:
    """The data files of a written folder and of those in it."""
    filesystem, inner = open_filesystem(location)
    inner = inner.rstrip("/")
    names = [i.path for i in filesystem.get_file_info(pafs.FileSelector(inner, recursive=True)) if i.type == pafs.FileType.File]
    return Stored(location, tuple(sorted(n for n in names if n.rsplit("/", 1)[1][0] not in "._")))


def stored(df: DataFrame, name: str, order: list[str] | None = None) -> Stored:
    """The rows of ``df``, written below the shared folder; the rows of a task are sorted by ``order`` first.
    A table that is nothing but files below that folder is read where it lies."""
    spark = df.sparkSession
    if order is None and df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        base = open_filesystem(shared_dir(spark))[1].rstrip("/") + "/"
        files = [urllib.parse.unquote(urllib.parse.urlsplit(f).path) for f in df.inputFiles()]
        if files and all(f.startswith(base) and f.endswith(".parquet") and "=" not in f[len(base):] for f in files):
            return Stored(shared_dir(spark), tuple(sorted(files)))
    path = fresh_dir(spark, name)
    (df.sortWithinPartitions(*order) if order else df).write.option("parquet.block.size", GROUP_BYTES).parquet(path)
    return folder(path)


def key_blocks(batches, key: str, rows: int) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows of batches that come sorted by ``key``; the rows of one key stay together."""
    waiting, held = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            waiting.append(batch.slice(start, rows))
            held += waiting[-1].num_rows
            if held > rows:
                table = pa.Table.from_batches(waiting)
                keys = table[key].to_numpy()
                at = min(rows, int(np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))[-1]))
                while at and keys[at - 1] == keys[at]:
                    at -= 1
                if at:  # else one key fills it all
                    yield table.slice(0, at)
                    waiting = table.slice(at).to_batches()
                    held -= at
    if held:
        yield pa.Table.from_batches(waiting)
