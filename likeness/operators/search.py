"""Exact searches over stored features, one call for any number of queries."""

from pyspark.sql import DataFrame, functions as F

from likeness.functions import vectors as V
from likeness.operators.joins import lookup
from likeness.operators.nearest import nearest
from likeness.operators.selection import first_n
from likeness.session import materialise


def search_embeddings(queries: DataFrame, embeddings: DataFrame, k: int = 5, *,
                      dim: int | None = None, exclude_self: bool = False,
                      limit: int | None = None) -> DataFrame:
    """Best k by cosine; zero and non-finite vectors dropped, self included."""
    return nearest(queries, first_n(embeddings, "image_id", limit), k, dim=dim,
                   exclude_self=exclude_self)


def search_hsv(queries: DataFrame, vectors: DataFrame, k: int = 5, *, dim: int = V.HSV_DIM,
               legacy_dim: int = V.HS_DIM, exclude_self: bool = False) -> DataFrame:
    """Best k by cosine after bringing old vectors to full length; zero vectors
    stay in the corpus and score 0, a query needs a direction."""
    def padded(df):
        return df.withColumn("vector", V.pad_legacy(F.col("vector"), legacy_dim, dim))
    asked = padded(queries).withColumn("vector", V.unit_query(F.col("vector")))
    return nearest(asked.where(F.col("vector").isNotNull()), padded(vectors), k, dim=dim,
                   keep_zero=True, exclude_self=exclude_self)


def search_hog(queries: DataFrame, vectors: DataFrame, k: int = 5, *, dim: int = V.HOG_DIM,
               exclude_self: bool = True, limit: int | None = None) -> DataFrame:
    """Best k by dot product of unit vectors, the query's own image excluded."""
    return nearest(queries, first_n(vectors, "image_id", limit), k, dim=dim,
                   keep_zero=True, exclude_self=exclude_self)


def with_paths(hits: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Hits with the path of each image; unknown ids are dropped."""
    hits = materialise(hits, "hits")
    return lookup(hits, catalogue.select("image_id", "path"), "image_id", spread="query_id")


def stored_units(vectors: DataFrame, limit: int | None = None) -> DataFrame:
    """The usable vectors of a table at unit length, ready to be written once."""
    unit = first_n(vectors, "image_id", limit).withColumn(
        "vector", V.unit_or_null(F.col("vector")))
    return unit.where(F.col("vector").isNotNull())


def scan_vectors(table: DataFrame, column: str, max_rows: int | None = None) -> DataFrame:
    """Path and vector of the rows that have one, in id order up to ``max_rows``."""
    present = table.where(F.col(column).isNotNull())
    return first_n(present, "image_id", max_rows).select("image_id", "path", column)
