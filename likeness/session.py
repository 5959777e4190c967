"""Session helpers: the shared work folder and size-checked broadcasts."""

import hashlib
import io
import pathlib
import urllib.parse
import uuid
import zipfile

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

# Anything shipped to every executor stays below this many bytes.
BROADCAST_BYTES = 64 * 1024 * 1024
_shipped = set()


def open_filesystem(location: str):
    """(file system, path inside it) of a plain path or a URI."""
    if "://" in location:
        return pafs.FileSystem.from_uri(location)
    if location.startswith("file:"):
        location = urllib.parse.unquote(location[len("file:"):])
    return pafs.LocalFileSystem(), location


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder below the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def ship(spark: SparkSession, *packages) -> None:
    """Make packages importable in Python workers wherever they run: a zip of their
    sources in the shared folder, added to the session once."""
    files = {}
    for package in packages:
        folder = pathlib.Path(package.__file__).parent
        for source in sorted(folder.rglob("*.py")):
            files[str(source.relative_to(folder.parent))] = source.read_bytes()
    mark = hashlib.sha1(repr(sorted(files.items())).encode()).hexdigest()[:12]
    key = (spark.sparkContext.applicationId, mark)
    if key in _shipped:
        return
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, source in files.items():
            archive.writestr(name, source)
    target = f"{fresh_dir(spark, 'sources')}/sources_{mark}.zip"
    filesystem, inner = open_filesystem(target)
    filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with filesystem.open_output_stream(inner) as out:
        out.write(content.getvalue())
    spark.sparkContext.addPyFile(target)
    _shipped.add(key)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and survives
    the loss of executors, unlike a cached or locally checkpointed plan."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reduce_to(table: DataFrame, keys: DataFrame, key: str, row_bytes: int = 256,
              limit: int = BROADCAST_BYTES) -> DataFrame:
    """``table`` cut down, where it lies, to the rows a join by ``key`` with ``keys`` can
    meet. Only done when the counted keys fit a broadcast; otherwise the whole table."""
    wanted = keys.select(key).distinct()
    if wanted.count() * row_bytes > limit:
        return table
    return table.join(F.broadcast(wanted), key, "left_semi")


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after counting that the rows fit the limit. The count
    runs ``df`` once; hand in tables, or plans that are cheap to run."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df
