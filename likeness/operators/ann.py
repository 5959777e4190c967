"""Approximate search by index: inverted lists (``list_index``) or hash lists (``hash_index``)."""

import numpy as np
from pyspark.sql import DataFrame, functions as F

from likeness.functions import vectors as V
from likeness.operators.hash_index import HashIndex, hash_lists, search_hash
from likeness.operators.list_index import ListIndex, build_lists, open_lists, search_lists, update
from likeness.operators.nearest import common_dim, nearest


def hsv_list_count(rows: int) -> int:
    """Lists for a colour index of this size (fixed values: 32 to 1024)."""
    return min(1024, max(32, int(rows ** 0.5)))


build_ivf, load_ivf, search_ivf = build_lists, open_lists, search_lists


def load_or_build(vectors: DataFrame, base: str, **options) -> ListIndex:
    """Reuse the index of exactly these vectors below ``base`` or build it."""
    path = f"{base}/{content_name(vectors)}"
    try:
        return open_lists(vectors.sparkSession, path)
    except FileNotFoundError:
        return build_lists(vectors, path, **options)


def load_or_update(vectors: DataFrame, path: str, **options) -> ListIndex:
    """The index at ``path`` brought to the state of ``vectors``, or built there: of an index that exists
    only new, changed and vanished rows are written."""
    try:
        return update(open_lists(vectors.sparkSession, path), vectors)
    except FileNotFoundError:
        return build_lists(vectors, path, **options)


def fingerprint(count, highest, dim, feature: str = "hsv"):
    """First 12 hex digits of sha1 over "count-highest-dim-feature"."""
    text = F.concat_ws("-", *[F.lit(x) if isinstance(x, int) else x for x in (count, highest, dim)],
                       F.lit(feature))
    return F.substring(F.sha1(text.cast("binary")), 1, 12)


def content_name(vectors: DataFrame, feature: str = "ivf") -> str:
    """Fingerprint that also changes when any vector does: the sum of row hashes
    stands in for the row count next to it. One pass over the table.

    A vector is made from one state of its file. Where the table says which (``file_size,
    mtime``, as feature tables do), only that is hashed and no vector is read.
    """
    stamped = {"file_size", "mtime"} <= set(vectors.columns)
    if stamped:
        rows, marked, dim = vectors, ["image_id", "file_size", "mtime"], F.lit(0)
    else:
        rows, marked = vectors.where(V.is_usable(F.col("vector"))), ["image_id", "vector"]
        dim = F.coalesce(F.max(F.size("vector")), F.lit(0))
    marks = rows.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.max("image_id"), F.lit(0)).alias("high"), dim.alias("dim"),
        F.coalesce(F.sum(F.xxhash64(*marked).cast("decimal(38,0)")), F.lit(0)).alias("mark"))
    return marks.select(F.concat_ws("-", fingerprint(F.col("n"), F.col("high"), F.col("dim"), feature),
                                    F.substring(F.sha1(F.col("mark").cast("string").cast("binary")), 1, 12))
                        .alias("name")).first().name


def search_lsh(queries: DataFrame, corpus: DataFrame | HashIndex, k: int = 5, *, tables: int = 8,
               bits: int = 8, dim: int | None = None, seed: int = 42, planes: np.ndarray | None = None,
               **options) -> DataFrame:
    """Exact scores among vectors that share a hash list in some table: of a stored index, or
    of a table whose lists are made for this search."""
    if not isinstance(corpus, HashIndex):
        dim = dim or common_dim(queries)
        corpus = None if dim is None else hash_lists(corpus, tables=tables, bits=bits, dim=dim, seed=seed, planes=planes)
        if corpus is None:
            return nearest(queries, queries.withColumnRenamed("query_id", "image_id"), 0)
    return search_hash(corpus, queries, k, **options)


def search_ann(queries: DataFrame, corpus: DataFrame | ListIndex | HashIndex, k: int = 5, *,
               method: str = "ivf", **options) -> DataFrame:
    """Approximate nearest images by embedding, by index or by hashing."""
    if method == "ivf":
        return search_ivf(corpus, queries, k, **options)
    if method == "lsh":
        return search_lsh(queries, corpus, k, **options)
    raise ValueError(f"unknown method {method!r}")
