"""Corpus analysis: dimension audit, covariance, PCA, kNN graph."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window, functions as F

from likeness.functions.blocks import dense
from likeness.operators.ann import ListIndex, search_ivf
from likeness.operators.nearest import common_dim, nearest


def dimension_audit(vectors: DataFrame) -> DataFrame:
    """``dim, rows, is_reference``: row counts per vector length. The reference
    length is that of the present vector with the lowest id."""
    sizes = (vectors.where(F.col("vector").isNotNull())
             .groupBy(F.size("vector").alias("dim"))
             .agg(F.count(F.lit(1)).alias("rows"), F.min("image_id").alias("_lowest")))
    # One row per length is left, so one group for all of them is tiny.
    reference = F.min_by("dim", "_lowest").over(Window.partitionBy(F.lit(0)))
    return sizes.select("dim", "rows", (F.col("dim") == reference).alias("is_reference"))


def bad_examples(vectors: DataFrame, dim: int, n: int = 3) -> DataFrame:
    """The first n rows whose vector has another length."""
    wrong = vectors.where(F.col("vector").isNotNull() & (F.size("vector") != dim))
    return wrong.select("image_id", F.size("vector").alias("dim")).orderBy("image_id").limit(n)


def valid_vectors(vectors: DataFrame, dim: int) -> DataFrame:
    """Rows of length ``dim`` without NaN or infinity."""
    limit = F.lit(float("inf"))
    finite = F.forall("vector", lambda x: F.coalesce((x < limit) & (x > -limit), F.lit(False)))
    return vectors.where((F.size("vector") == dim) & finite).select("image_id", "vector")


def covariance(vectors: DataFrame, dim: int) -> DataFrame:
    """``i, j, mean_i, mean_j, cov`` for i <= j (sample covariance).

    Each task multiplies its rows into one dim x dim matrix. The matrix rows are
    added up per row number, spread over all tasks, so nothing but one row of sums
    per dimension meets anywhere. Values are first shifted by those of one vector
    to keep the sums small.
    """
    rows = valid_vectors(vectors, dim)
    origin = rows.select("vector").first()
    if origin is None:
        raise ValueError("no valid vectors")
    shift = np.asarray(origin.vector, dtype=np.float64)

    def partial(batches):
        gram, total, count = np.zeros((dim, dim)), np.zeros(dim), 0
        for batch in batches:
            block = dense(batch.column("vector"), dim)[0] - shift
            gram += block.T @ block
            total += block.sum(axis=0)
            count += len(block)
        if count:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dim), pa.int32()), pa.array(list(gram), pa.list_(pa.float64())),
                 pa.array([total] * dim, pa.list_(pa.float64())),
                 pa.array([count] * dim, pa.int64())],
                names=["i", "products", "totals", "n"])

    def combine(batches):
        sums = {}
        for batch in batches:
            products, totals = (dense(batch.column(c), dim)[0] for c in ("products", "totals"))
            for i, p, t, n in zip(batch.column("i").to_pylist(), products, totals,
                                  batch.column("n").to_pylist()):
                if i in sums:
                    sums[i][0] += p
                    sums[i][1] += t
                    sums[i][2] += n
                else:
                    sums[i] = [p.copy(), t.copy(), n]
        for i, (p, t, n) in sums.items():
            cov = (p - t[i] * t / n) / (n - 1) if n > 1 else np.zeros(dim)
            mean = t / n + shift
            j = np.arange(i, dim)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(j), i), pa.int32()), pa.array(j, pa.int32()),
                 pa.array(np.full(len(j), mean[i])), pa.array(mean[j]), pa.array(cov[j])],
                names=["i", "j", "mean_i", "mean_j", "cov"])

    tasks = vectors.sparkSession.sparkContext.defaultParallelism
    sums = rows.coalesce(tasks).mapInArrow(
        partial, "i int, products array<double>, totals array<double>, n long")
    return sums.repartition(min(dim, tasks), "i").mapInArrow(
        combine, "i int, j int, mean_i double, mean_j double, cov double")


@dataclass
class Projection:
    mean: np.ndarray
    components: np.ndarray  # one row per component
    explained_ratio: np.ndarray


def fit_pca(vectors: DataFrame, dims: int = 64, dim: int | None = None) -> Projection:
    """Principal axes of the valid vectors; each axis points so that its largest
    loading is positive."""
    dim = dim or common_dim(vectors)
    if dim is None:
        raise ValueError("no valid vectors")
    rows = valid_vectors(vectors, dim).select(array_to_vector("vector").alias("features"))
    mean = rows.select(Summarizer.mean(F.col("features")).alias("mean")).first().mean
    if mean is None or not mean.size:
        raise ValueError("no valid vectors")
    model = PCA(k=min(dims, dim), inputCol="features").fit(rows)
    axes = model.pc.toArray().T
    largest = axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)]
    return Projection(mean.toArray(), axes * np.where(largest < 0, -1.0, 1.0)[:, None],
                      model.explainedVariance.toArray())


def project(vectors: DataFrame, fitted: Projection) -> DataFrame:
    """``image_id, scores``: coordinates of the centred vectors on the axes."""
    dim = len(fitted.mean)
    shared = vectors.sparkSession.sparkContext.broadcast((fitted.mean, fitted.components))

    def run(batches):
        mean, axes = shared.value
        for batch in batches:
            block, rows = dense(batch.column("vector"), dim)
            if len(rows):
                scores = (block - mean) @ axes.T
                flat = pa.array(scores.astype(np.float32).ravel())
                ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(axes))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("image_id").take(pa.array(rows)),
                     pa.ListArray.from_arrays(ends, flat)],
                    names=["image_id", "scores"])

    return valid_vectors(vectors, dim).mapInArrow(run, "image_id long, scores array<float>")


def coordinates(vectors: DataFrame, dim: int | None = None) -> DataFrame:
    """``x, y, id``: the first two principal coordinates, a linear map."""
    plane = project(vectors, fit_pca(vectors, 2, dim))
    return plane.select(F.col("scores")[0].alias("x"), F.col("scores")[1].alias("y"),
                        F.col("image_id").alias("id"))


def export_coordinates(points: DataFrame, path: str) -> None:
    points.write.csv(path, header=True)


def knn_graph(vectors: DataFrame, neighbours: int = 15, *, index: ListIndex | None = None,
              nprobe: int = 32, dim: int | None = None, **sizes) -> DataFrame:
    """``src, rank, dst, sim``: edges to the most similar other images. Exact, or
    through an index for corpora too large to compare all blocks."""
    asked = vectors.select(F.col("image_id").alias("query_id"), "vector")
    hits = (search_ivf(index, asked, neighbours, nprobe=nprobe, exclude_self=True, **sizes)
            if index else nearest(asked, vectors, neighbours, dim=dim, exclude_self=True, **sizes))
    return hits.select(F.col("query_id").alias("src"), "rank",
                       F.col("image_id").alias("dst"), F.col("score").alias("sim"))

# Halvings of the bandwidth search.
BANDWIDTH_STEPS = 40


def fuzzy_weights(graph: DataFrame, steps: int = BANDWIDTH_STEPS) -> DataFrame:
    """``a, b, weight`` for a < b: how strongly two images are neighbours, from a kNN graph.

    graph: ``src, dst, sim``, at most some dozen edges a source. The distance is 1 - sim. Of every source the least
    distance counts as none, and a bandwidth is searched by halving so that exp(-(distance - least) / bandwidth)
    adds up to log2 of its edges (McInnes, Healy and Melville 2018); both directions of a pair
    are joined as independent chances: p + q - p * q. Edges of an image to itself count for nothing; of
    repeated edges the nearest counts. Sources with one edge give it weight 1.
    """
    edges = (graph.where("src <> dst").groupBy("src", "dst").agg(F.min(F.lit(1.0) - F.col("sim")).alias("distance")))
    around = edges.groupBy("src").agg(F.min("distance").alias("least"), F.collect_list("distance").alias("distances"))
    goal = F.log2(F.size("distances").cast("double"))

    def total(width):
        return F.aggregate(F.array_sort("distances"), F.lit(0.0), lambda sum_, d: sum_ + F.exp(-(d - F.col("least")) / width))

    def halve(state, _):
        middle = state["middle"]
        wide = total(middle) > goal
        low, high = F.when(wide, state["low"]).otherwise(middle), F.when(wide, middle).otherwise(state["high"])
        # without an upper bound yet the bandwidth doubles
        return F.struct(low.alias("low"), high.alias("high"),
                        F.when(high < 0, middle * 2).otherwise((low + high) / 2).alias("middle"))

    start = F.struct(F.lit(0.0).alias("low"), F.lit(-1.0).alias("high"), F.lit(1.0).alias("middle"))
    width = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve)["middle"]
    widths = around.select("src", "least", width.alias("width"))
    one_way = edges.join(widths, "src").select(
        F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"),
        F.exp(-(F.col("distance") - F.col("least")) / F.greatest("width", F.lit(1e-12))).alias("p"))
    pairs = one_way.groupBy("a", "b").agg(F.sum("p").alias("sum"), F.product("p").alias("product"), F.count(F.lit(1)).alias("n"))
    return pairs.select("a", "b", F.when(F.col("n") == 2, F.col("sum") - F.col("product")).otherwise(F.col("sum")).alias("weight"))
