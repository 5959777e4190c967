"""Corpus analysis queries."""

import numpy as np
from pyspark.sql import functions as F

from likeness.functions import vectors as V
from likeness.operators import analysis as A, moments as M
from likeness.session import fresh_dir
from workload import inputs as I
from workload.registry import ORACLE, ctes, query
from workload.search_queries import CENTRES, EMBED, NPROBE, PROBED, _centred_index, ranked_sql, rounded


@query("dimension_audit", ctes(I.ODD_VECTORS) + """
SELECT CAST(len(vector) AS INTEGER) AS dim, CAST(count(*) AS BIGINT) AS rows,
       len(vector) = (SELECT len(vector) FROM odd_vectors WHERE vector IS NOT NULL ORDER BY image_id LIMIT 1) AS is_reference
FROM odd_vectors WHERE vector IS NOT NULL GROUP BY len(vector)""")
def dimension_audit(spark, sf):
    return A.dimension_audit(I.odd_vectors(spark, sf))


@query("bad_vectors", ctes(I.ODD_VECTORS) + """
SELECT image_id, CAST(len(vector) AS INTEGER) AS dim FROM odd_vectors WHERE len(vector) <> 64
ORDER BY image_id LIMIT 3""")
def bad_vectors(spark, sf):
    return A.bad_examples(I.odd_vectors(spark, sf), 64)


@query("covariance", """
WITH parts AS (
  SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::DOUBLE AS x FROM embeddings)
SELECT CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, round(avg(a.x), 9) + 0.0 AS mean_i,
       round(avg(b.x), 9) + 0.0 AS mean_j, round(covar_samp(a.x, b.x), 9) + 0.0 AS cov
FROM parts a JOIN parts b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY a.i, b.i""")
def covariance(spark, sf):
    result = A.covariance(I.vectors(spark, sf), 64)
    return result.withColumns({c: F.round(c, 9) + 0.0 for c in ("mean_i", "mean_j", "cov")})


@query("pca_incremental", ORACLE["covariance"])
def pca_incremental(spark, sf):
    """Moments stored of one batch of the vectors and continued by two others: those of all vectors."""
    rows, path = I.table(spark, sf, "embeddings").select(F.col("vec_id").alias("image_id"), F.col("embedding").alias("vector"), "label"), fresh_dir(spark, "moments")
    for batch in ("label < 3", "label BETWEEN 3 AND 5", "label > 5"):
        M.add_batch(spark, path, rows.where(batch))
    _, state = M.read_moments(spark, path)
    i, j = np.triu_indices(len(state.mean))
    cov = state.scatter[i, j] / (state.n - 1)
    found = spark.createDataFrame(zip(i.tolist(), j.tolist(), state.mean[i].tolist(), state.mean[j].tolist(), cov.tolist()),
                                  "i int, j int, mean_i double, mean_j double, cov double")
    return found.withColumns({c: F.round(c, 9) + 0.0 for c in ("mean_i", "mean_j", "cov")})


# The covariance matrix; what the axes must add up to follows from it.
COVARIANCE = """
WITH parts AS (
  SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
means AS (SELECT i, avg(x) AS mean FROM parts GROUP BY i),
cov AS (
  SELECT a.i, b.i AS j, covar_samp(a.x, b.x) AS c FROM parts a JOIN parts b ON a.vec_id = b.vec_id GROUP BY a.i, b.i)"""


def _variances(rows, fitted):
    """Variance of the projected rows along each axis."""
    parts = A.project(rows, fitted).select(F.posexplode("scores").alias("axis", "score"))
    found = parts.groupBy("axis").agg(F.var_samp(F.col("score").cast("double")).alias("v")).orderBy("axis").collect()
    return np.array([r.v for r in found])  # one number an axis


@query("pca_fit", COVARIANCE + """
SELECT CAST(m.i AS INTEGER) AS i, round(mean, 9) + 0.0 AS mean, round(d.c, 6) AS variance, round(s.energy, 6) AS energy
FROM means m JOIN cov d ON d.i = m.i AND d.j = m.i JOIN (SELECT i, sum(c * c) AS energy FROM cov GROUP BY i) s ON s.i = m.i""")
def pca_fit(spark, sf):
    """All axes with their variances put together give the covariance matrix back: the diagonals
    of it and of its square."""
    rows = I.vectors(spark, sf)
    fitted = A.fit_pca(rows, 64)
    spread, square = _variances(rows, fitted), fitted.components ** 2
    out = spark.createDataFrame(
        [(i, float(fitted.mean[i]), float(spread @ square[:, i]), float(spread ** 2 @ square[:, i]))
         for i in range(len(fitted.mean))], "i int, mean double, variance double, energy double")
    return out.select("i", (F.round("mean", 9) + 0.0).alias("mean"), F.round("variance", 6).alias("variance"),
                      F.round("energy", 6).alias("energy"))


@query("pca_project", COVARIANCE + """,
centred AS (SELECT vec_id, p.i, x - mean AS x FROM parts p JOIN means m ON m.i = p.i)
SELECT a.vec_id AS image_id, CAST(64 AS INTEGER) AS dims, round(sum(CASE WHEN a.i = b.i THEN a.x * a.x END), 3) + 0.0 AS square,
       round(sum(a.x * c * b.x), 4) + 0.0 AS energy
FROM centred a JOIN centred b ON a.vec_id = b.vec_id JOIN cov ON cov.i = a.i AND cov.j = b.i GROUP BY a.vec_id""")
def pca_project(spark, sf):
    """All axes kept, the projection preserves each centred length, and the length that the
    covariance matrix gives it; a mere rotation would not."""
    rows = I.vectors(spark, sf)
    fitted = A.fit_pca(rows, 64)
    scores, spread = A.project(rows, fitted), F.array(*[F.lit(float(v)) for v in _variances(rows, fitted)])
    weighed = F.zip_with(V.doubles(F.col("scores")), spread, lambda s, v: s * s * v)
    energy = F.aggregate(weighed, F.lit(0.0), lambda a, x: a + x)
    return scores.select("image_id", F.size("scores").alias("dims"),
                         (F.round(V.squared_norm(F.col("scores")), 3) + 0.0).alias("square"),
                         (F.round(energy, 4) + 0.0).alias("energy"))


@query("pca_axes", COVARIANCE + """
SELECT (SELECT round(sum(c), 5) FROM cov WHERE i = j) AS total, (SELECT round(sum(c * c), 5) FROM cov) AS squares,
       0::DOUBLE AS mixed, true AS descending, true AS shares""")
def pca_axes(spark, sf):
    """Variances along all axes: their sums are those of the covariance matrix, no two axes vary
    together, they descend, and the fitted shares are theirs."""
    rows = I.vectors(spark, sf)
    fitted = A.fit_pca(rows, 64)
    spread = _variances(rows, fitted)
    scores = A.project(rows, fitted).withColumnRenamed("scores", "vector")
    mixed = A.covariance(scores, 64).where("i < j").agg(F.round(F.max(F.abs("cov")), 5).alias("mixed"))
    shares = bool(np.allclose(spread / spread.sum(), fitted.explained_ratio, atol=1e-5))
    return mixed.select(F.lit(round(float(spread.sum()), 5)).alias("total"),
                        F.lit(round(float((spread ** 2).sum()), 5)).alias("squares"), (F.col("mixed") + 0.0).alias("mixed"),
                        F.lit(bool((np.diff(spread) <= 1e-6).all())).alias("descending"), F.lit(shares).alias("shares"))


@query("coords_csv", COVARIANCE + """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM embeddings) AS placed, 1::DOUBLE AS x_axis, 1::DOUBLE AS y_axis, 0::DOUBLE AS mixed,
       true AS widest""")
def coords_csv(spark, sf):
    """Two-dimensional coordinates written as CSV and read back. Along a principal axis the
    covariances with the vectors' own values have the length of the variance; along no other."""
    path = fresh_dir(spark, "coordinates")
    A.export_coordinates(A.coordinates(I.vectors(spark, sf)), path)
    back = spark.read.csv(path, header=True, schema="x double, y double, id long")
    rows = back.join(I.vectors(spark, sf).withColumnRenamed("image_id", "id"), "id")
    each = rows.select("id", "x", "y", F.posexplode("vector").alias("i", "e")).withColumn("e", F.col("e").cast("double"))
    sums = each.groupBy("i").agg(F.covar_samp("x", "e").alias("cx"), F.covar_samp("y", "e").alias("cy"),
                                 F.var_samp("e").alias("own"), F.var_samp("x").alias("vx"), F.var_samp("y").alias("vy"),
                                 F.covar_samp("x", "y").alias("xy"), F.count("x").alias("n"))
    top = sums.agg(F.max("n").alias("placed"), F.sum(F.col("cx") ** 2).alias("cx"), F.sum(F.col("cy") ** 2).alias("cy"),
                   F.max("vx").alias("vx"), F.max("vy").alias("vy"), F.max(F.abs("xy")).alias("xy"), F.max("own").alias("own"))
    return top.select("placed", F.round(F.sqrt("cx") / F.col("vx"), 3).alias("x_axis"),
                      F.round(F.sqrt("cy") / F.col("vy"), 3).alias("y_axis"), (F.round("xy", 5) + 0.0).alias("mixed"),
                      ((F.col("vx") >= F.col("vy")) & (F.col("vx") >= F.col("own"))).alias("widest"))


KNN = ctes(EMBED, ranked_sql("e", "e", 15, "q.image_id <> c.image_id")) + """
SELECT query_id AS src, "rank", image_id AS dst, round(score, 6) + 0.0 AS sim FROM hits"""


@query("knn_graph", KNN)
def knn_graph(spark, sf):
    return rounded(A.knn_graph(I.vectors(spark, sf)), "sim")


@query("knn_graph_ivf", ctes(EMBED, CENTRES, ranked_sql("e", "e", 15, "q.image_id <> c.image_id AND " + PROBED)) + """
SELECT query_id AS src, "rank", image_id AS dst, round(score, 6) + 0.0 AS sim FROM hits""")
def knn_graph_ivf(spark, sf):
    """Through the lists around given centres: the same edges as in SQL."""
    return rounded(A.knn_graph(I.vectors(spark, sf), index=_centred_index(spark, sf), nprobe=NPROBE), "sim")


FUZZY_STEPS = 40


@query("fuzzy_graph", ctes(EMBED, ranked_sql("e", "e", 15, "q.image_id <> c.image_id")).replace("WITH ", "WITH RECURSIVE ", 1) + f""",
edges AS (SELECT query_id AS src, image_id AS dst, 1 - score AS d FROM hits),
around AS (SELECT src, min(d) AS least, log2(count(*)) AS goal FROM edges GROUP BY src),
halving AS (
  SELECT src, 0 AS step, 0::DOUBLE AS low, -1::DOUBLE AS high, 1::DOUBLE AS middle FROM around
  UNION ALL
  SELECT src, step + 1, CASE WHEN wide THEN low ELSE middle END, CASE WHEN wide THEN middle ELSE high END,
         CASE WHEN NOT wide AND high < 0 THEN middle * 2
              ELSE (CASE WHEN wide THEN low ELSE middle END + CASE WHEN wide THEN middle ELSE high END) / 2 END
  FROM (SELECT h.src, step, low, high, middle, sum(exp(-(d - least) / middle)) > any_value(goal) AS wide
        FROM halving h JOIN edges e ON e.src = h.src JOIN around a ON a.src = h.src
        WHERE step < {FUZZY_STEPS} GROUP BY h.src, step, low, high, middle)),
ways AS (
  SELECT least(e.src, dst) AS a, greatest(e.src, dst) AS b, exp(-(d - least) / greatest(middle, 1e-12)) AS p
  FROM edges e JOIN around r ON r.src = e.src JOIN halving h ON h.src = e.src AND step = {FUZZY_STEPS})
SELECT a, b, round(CASE WHEN count(*) = 2 THEN sum(p) - product(p) ELSE sum(p) END, 5) + 0.0 AS weight FROM ways GROUP BY a, b""")
def fuzzy_graph(spark, sf):
    """Neighbour weights by a bandwidth of every image, both directions joined."""
    return A.fuzzy_weights(A.knn_graph(I.vectors(spark, sf)), FUZZY_STEPS).withColumn("weight", F.round("weight", 5) + 0.0)
