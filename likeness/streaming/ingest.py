"""Incremental ingest with Structured Streaming.

The file stream remembers which files it has seen, so each run picks up new files
only. A changed file has a known path and is not seen again: the batch ``ingest``
compares sizes and times. Spark's stream hides names that start with "_"; files below
such names are listed by the walk at the end of each run. Every micro-batch is an upsert
keyed by path, so a batch that is run twice after a failure changes nothing, and it is
repeated when another job wrote the catalogue meanwhile; new files become a layer, changed
files rewrite the shards of the catalogue that hold them.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from likeness.functions import paths as P
from likeness.operators import catalogue as C
from likeness.plans.jobs import Snapshots, repeated
from likeness.session import materialise
from likeness.sources.files import absolute, file_state, list_files

# Fixed schema of the binary file source.
BINARY_FILES = "path string, modificationTime timestamp, length long, content binary"


def watch_folder(spark: SparkSession, folder: str, files_per_batch: int = 50_000) -> DataFrame:
    """A stream of ``path, file_size, mtime``; file contents are not read."""
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILES)
             .option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch)
             .load(folder))
    return file_state(files)


def stream_ingest(spark: SparkSession, folder: str, snapshots: Snapshots, checkpoint: str, *,
                  extensions=P.IMAGE_EXTENSIONS, skip=P.SKIP_NAMES, image_id=P.image_id,
                  files_per_batch: int = 50_000):
    """Upsert all files not seen before and stop; returns the finished query."""
    path = F.col("path")
    listed = watch_folder(spark, folder, files_per_batch).where(P.has_extension(path, extensions))
    if skip is not None:
        listed = listed.where(~P.in_skipped_folder(path, skip))

    def upsert(batch: DataFrame, _number: int) -> None:
        scan = materialise(C.describe(batch, image_id), "scan")
        repeated(snapshots, lambda: snapshots.upsert(scan))

    query = (listed.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    unseen = list_files(spark, folder, extensions=extensions, skip=skip).where(
        P.hidden_by_spark(path, absolute(folder)))
    if not unseen.isEmpty():
        upsert(unseen, -1)
    return query
