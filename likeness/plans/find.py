"""From query images to similar catalogued images."""

from pyspark.sql import DataFrame, Window, functions as F

from likeness.functions import paths as P
from likeness.operators import ann, features as X, fusion, search
from likeness.operators.ann import ListIndex
from likeness.operators.joins import lookup
from likeness.session import materialise

_SEARCHES = {"hsv": search.search_hsv, "hog": search.search_hog, "embedding": search.search_embeddings}


def _extractor(feature, make_predict_fn):
    if feature == "hsv":
        return X.unit_hsv_extractor()
    if feature == "hog":
        return X.hog_extractor()
    if feature == "embedding" and make_predict_fn:
        return X.model_extractor(make_predict_fn)
    raise ValueError(f"unknown feature {feature!r}, or a model is missing")


def find_similar(images: DataFrame, vectors: DataFrame, catalogue: DataFrame, k: int = 5, *,
                 feature: str = "hsv", make_predict_fn=None, index: ListIndex | None = None,
                 nprobe: int = 32, exclude_self: bool | None = None) -> DataFrame:
    """``query_id, rank, image_id, score, path`` for ``query_id, image`` rows.

    ``vectors`` holds the catalogued images' feature; with an ``index`` its lists are
    searched instead. A query that cannot be read has no hits. By default only the
    exact shape search leaves the query's own image out. An image is a query's own when
    its path is the one in the optional column ``path`` of ``images``: query ids are
    numbers of their own and name no catalogued image. Queries without a path have none.
    """
    own = exclude_self if exclude_self is not None else feature == "hog" and not index
    named = own and "path" in images.columns
    asked = X.extract(images.select("query_id", "image", *["path"] * named),
                      {"vector": _extractor(feature, make_predict_fn)})
    asked = materialise(asked.where(F.col("vector").isNotNull()), "queries")
    # a path is catalogued once, so one more hit than asked for makes up for it
    more = k + 1 if named else k
    if index:
        hits = ann.search_ivf(index, asked, more, nprobe=nprobe)
    else:
        hits = _SEARCHES[feature](asked, vectors, more, exclude_self=False)
    hits = search.with_paths(hits, catalogue)
    if not named:
        return hits
    paths = asked.select("query_id", P.canonical_path(F.col("path")).alias("own_path"))
    others = lookup(hits, paths, "query_id", spread="image_id").where(~F.col("path").eqNullSafe(F.col("own_path")))
    order = Window.partitionBy("query_id").orderBy("rank")
    return (others.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select(*hits.columns))


def find_combined(images: DataFrame, embeddings: DataFrame, features: DataFrame, catalogue: DataFrame,
                  make_predict_fn, k: int = 10, **options) -> DataFrame:
    """The combined search for ``query_id, image`` rows, with paths. ``options`` are
    those of ``combined_search``: metrics, weights, candidates, retrieve."""
    asked = X.query_features(images.withColumnRenamed("query_id", "image_id"), make_predict_fn)
    asked = materialise(asked.where(F.col("embedding").isNotNull()), "queries")
    return search.with_paths(
        fusion.combined_search(asked, embeddings, features, k, **options), catalogue)
