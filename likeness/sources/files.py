"""Listing of image files.

Spark's own file sources hide every name that starts with "_" or ".", and they
descend into folders that are skipped afterwards. The listing here therefore
walks the tree level by level as Spark jobs: each task lists some folders of the
present level, entry by entry, and skipped folders are never opened. Links to folders
are not followed, so a link cannot list a file twice. Levels are written to the shared
folder, so no part of the tree is held by the driver and a lost executor costs one
folder listing again.
"""

import os
import stat
import time

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from likeness.functions import paths as P
from likeness.operators.selection import first_n
from likeness.session import fresh_dir, open_filesystem

ROWS = 10_000
ENTRIES = "path string, is_folder boolean, file_size long, mtime double"
# A folder that cannot be read is tried so often, then the job fails.
ATTEMPTS = 3


def seconds(milliseconds):
    """Times are kept in whole milliseconds, the finest unit that all sources know."""
    return milliseconds / 1000.0


def entries(folder: str):
    """``(path, is_folder, size, mtime)`` of one folder; none where it is gone."""
    filesystem, inner = open_filesystem(folder)
    if isinstance(filesystem, pafs.LocalFileSystem):
        try:
            listed = os.scandir(inner)
        except FileNotFoundError:
            return
        with listed:
            for entry in listed:
                try:
                    state = entry.stat()
                except FileNotFoundError:  # removed meanwhile, or a link to nothing
                    continue
                is_folder = stat.S_ISDIR(state.st_mode)
                if (is_folder and not entry.is_symlink()) or stat.S_ISREG(state.st_mode):
                    yield entry.path, is_folder, state.st_size, seconds(state.st_mtime_ns // 1_000_000)
        return
    scheme = folder.partition("://")[0]
    for info in filesystem.get_file_info(pafs.FileSelector(inner, allow_not_found=True)):
        if info.type in (pafs.FileType.File, pafs.FileType.Directory):
            yield (f"{scheme}://{info.path}", info.type == pafs.FileType.Directory, info.size,
                   None if info.mtime_ns is None else seconds(info.mtime_ns // 1_000_000))


def entry_batches(folder: str, rows: int = ROWS):
    """Arrow batches of a folder's entries; a folder of any size needs one batch of memory."""
    for attempt in range(ATTEMPTS):
        given = False
        try:
            some = []
            for entry in entries(folder):
                some.append(entry)
                if len(some) == rows:
                    given = True
                    yield entry_batch(some)
                    some = []
            yield entry_batch(some)
            return
        except OSError:
            # what was handed on cannot be taken back: then only the whole task may repeat
            if given or attempt + 1 == ATTEMPTS:
                raise
            time.sleep(2 ** attempt)


def entry_batch(some):
    columns = list(zip(*some)) or [(), (), (), ()]
    kinds = (pa.string(), pa.bool_(), pa.int64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      names=["path", "is_folder", "file_size", "mtime"])


def walk_level(folders: DataFrame) -> DataFrame:
    """The entries of each folder in column ``path``. A folder that stays unreadable fails the job:
    a listing is complete or there is none."""
    def run(batches):
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                yield from entry_batches(folder)

    return folders.select("path").mapInArrow(run, ENTRIES)


def absolute(folder: str) -> str:
    """The folder without a trailing slash; a local one as absolute path without scheme."""
    filesystem, inner = open_filesystem(folder.rstrip("/") or "/")
    return os.path.abspath(inner) if isinstance(filesystem, pafs.LocalFileSystem) else folder.rstrip("/")


def list_files(spark: SparkSession, folder: str, *, extensions=P.IMAGE_EXTENSIONS,
               skip=P.SKIP_NAMES, hidden: bool = False, limit: int | None = None) -> DataFrame:
    """``path, file_size, mtime`` of the image files below ``folder``.

    ``skip=None`` with ``hidden=True`` lists by extension alone. ``limit`` takes the
    first paths in order. Paths are absolute, times epoch seconds in milliseconds.
    """
    root = absolute(folder)
    out = fresh_dir(spark, "listing")
    level = spark.createDataFrame([(root,)], "path string")
    tasks = spark.sparkContext.defaultParallelism
    depth = 0
    while True:
        found = walk_level(level)
        path = F.col("path")
        if skip is not None:
            found = found.where(~P.in_skipped_folder(path, skip))
        if not hidden:
            found = found.where(~P.is_hidden(path, root))
        found.write.parquet(f"{out}/level={depth}")
        seen = spark.read.schema(ENTRIES).parquet(f"{out}/level={depth}")
        folders = seen.where("is_folder").select("path")
        if folders.isEmpty():
            break
        level = folders.repartition(tasks, "path")
        depth += 1
    files = (spark.read.schema(ENTRIES + ", level int").parquet(out)
             .where(~F.col("is_folder") & P.has_extension(F.col("path"), extensions))
             .select("path", "file_size", "mtime"))
    return first_n(files, "path", limit)


def contents(paths):
    """The bytes of each path of an Arrow column, or the error that kept them from being read."""
    for path in paths.to_pylist():
        try:
            filesystem, inner = open_filesystem(path)
            with filesystem.open_input_stream(inner) as stream:
                yield stream.readall()
        except OSError as error:
            yield error


def file_state(files: DataFrame) -> DataFrame:
    """``path, file_size, mtime`` (epoch seconds) from rows of a Spark file source."""
    return files.select(P.canonical_path(F.col("path")).alias("path"),
                        F.col("length").alias("file_size"),
                        (F.unix_millis("modificationTime") / 1000.0).alias("mtime"))
