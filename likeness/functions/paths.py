"""Column expressions over file paths."""

import hashlib

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Image extensions and folder names the catalogue knows.
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".webp")
SKIP_NAMES = (
    "$recycle.bin", "recycler", "recycled",
    "system volume information", "windows",
    "program files", "program files (x86)",
    ".git", "__pycache__", ".trash", "trash", ".ds_store",
)
PURGE_MARKS = ("$recycle.bin", "recycler", "recycled", "system volume information")


def canonical_path(uri: Column, encoded: bool = False) -> Column:
    """Plain absolute path without scheme and authority of a local file URI.

    ``encoded`` is for sources that percent-encode (the image source does, the
    binary source does not). ``+`` is protected: it is no blank in a path.
    """
    bare = F.regexp_replace(uri, "^file:(//[^/]*)?(?=/)", "")
    return F.url_decode(F.replace(bare, F.lit("+"), F.lit("%2B"))) if encoded else bare


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def directory(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def extension(path: Column) -> Column:
    """Lower-cased suffix from the last dot; leading dots start no suffix."""
    return F.lower(F.regexp_extract(file_name(path), r"(?s)^\.*[^.].*(\.[^.]*)$", 1))


def has_extension(path: Column, extensions=IMAGE_EXTENSIONS) -> Column:
    return extension(path).isin([e.lower() for e in extensions])


def in_skipped_folder(path: Column, names=SKIP_NAMES) -> Column:
    """Any component of the whole path, ancestors included, is a skipped name."""
    return F.arrays_overlap(F.split(F.lower(path), "/"), F.array(*[F.lit(n) for n in names]))


def is_hidden(path: Column, root: str = "") -> Column:
    """A component below ``root`` starts with a dot."""
    below = F.substring(path, len(root.rstrip("/")) + 1, 1 << 30)
    return F.exists(F.split(below, "/"), lambda part: part.startswith("."))


def hidden_by_spark(path: Column, root: str = "") -> Column:
    """A component below ``root`` that Spark's file sources leave out: it starts with "_"."""
    below = F.substring(path, len(root.rstrip("/")) + 1, 1 << 30)
    return F.exists(F.split(below, "/"), lambda part: part.startswith("_"))


def has_purge_mark(path: Column, marks=PURGE_MARKS) -> Column:
    """The lower-cased path contains one of the marks, also inside a name."""
    hit = F.lit(False)
    for mark in marks:
        hit = hit | F.lower(path).contains(mark.lower())
    return hit


@F.pandas_udf(T.LongType())
def image_id(path: pd.Series) -> pd.Series:
    """63-bit key from an 8-byte blake2b digest; never 0. Spark has no blake2b."""
    def key(text):
        digest = hashlib.blake2b(text.encode("utf-8"), digest_size=8).digest()
        return (int.from_bytes(digest, "big") & ((1 << 63) - 1)) or 1
    return path.map(key)


def image_id_md5(path: Column) -> Column:
    """60-bit key from md5, all on the JVM; for catalogues started here."""
    return F.conv(F.substring(F.md5(path), 1, 15), 16, 10).cast("long")


def shard_key(image_id_: Column, shards: int = 1024, width: int = 4) -> Column:
    """Zero-padded folder name; no shards gives an empty name. Like an integer
    printed to a least width, a longer number is not cut."""
    if shards <= 0:
        return F.lit("")
    number = F.pmod(image_id_, F.lit(shards)).cast("string")
    return F.when(F.length(number) >= width, number).otherwise(F.lpad(number, width, "0"))
