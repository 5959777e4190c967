"""Vector expressions, searches, fusion and indexes."""

import numpy as np
from pyspark.sql import Window, functions as F

from likeness.functions import vectors as V
from likeness.operators import ann, catalogue as C, fusion, hash_index, list_index, search, selection
from likeness.operators.nearest import nearest
from likeness.session import fresh_dir
from workload import inputs as I
from workload.registry import ctes, exploded, exploded_sql, query


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) + 0.0 for c in columns})


def ranked_sql(queries: str, corpus: str, k: int, on: str = "true", name: str = "hits") -> str:
    """CTEs for exact cosine search between tables ``(image_id, v)``."""
    def unit(table):
        return (f"SELECT image_id, v::DOUBLE[] AS v, sqrt(list_inner_product(v::DOUBLE[], v::DOUBLE[])) AS n "
                f"FROM {table}")
    return f"""
{name}_q AS ({unit(queries)}), {name}_c AS ({unit(corpus)}),
{name}_all AS (
  SELECT q.image_id AS query_id, c.image_id,
         CASE WHEN c.n > 0 AND q.n > 0 THEN list_inner_product(q.v, c.v) / (q.n * c.n) ELSE 0 END AS score
  FROM {name}_q q, {name}_c c WHERE {on}),
{name} AS (
  SELECT query_id, CAST(place AS INTEGER) AS "rank", image_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, image_id) AS place
    FROM {name}_all) WHERE place <= {k})"""


HITS = 'SELECT query_id, "rank", image_id, round(score, 6) + 0.0 AS score FROM hits'
EMBED = I.VECTORS + ", e AS (SELECT image_id, vector AS v FROM vectors)"
ODD_USABLE = (I.ODD_VECTORS + """, e AS (SELECT image_id, vector AS v FROM odd_vectors
  WHERE len(vector) = 64 AND label NOT IN (9, 8, 6))""")
COLOUR = I.SUB_VECTORS + ", e AS (SELECT image_id, hsv_vector AS v FROM full_hsv WHERE hsv_vector IS NOT NULL)"
SHAPE = I.SUB_VECTORS + ", e AS (SELECT image_id, hog_vector AS v FROM sub_vectors WHERE hog_vector IS NOT NULL)"


def colours(spark, sf):
    return I.sub_vectors(spark, sf).select("image_id", F.col("hsv_vector").alias("vector"))


def shapes(spark, sf):
    return I.sub_vectors(spark, sf).select("image_id", F.col("hog_vector").alias("vector"))


# ---- vector expressions ----------------------------------------------------

@query("unit_vectors", ctes(ODD_USABLE) + exploded_sql(
    "(SELECT image_id, [x / sqrt(list_inner_product(v::DOUBLE[], v::DOUBLE[])) FOR x IN v::DOUBLE[]] AS u FROM e"
    " UNION ALL SELECT image_id, [x / sqrt(list_inner_product(vector::DOUBLE[], vector::DOUBLE[]))"
    " FOR x IN vector::DOUBLE[]] FROM odd_vectors WHERE label = 2)", "u", "image_id"))
def unit_vectors(spark, sf):
    return exploded(search.stored_units(I.odd_vectors(spark, sf)), "vector", "image_id")


@query("unit_or_null", ctes(I.ODD_VECTORS) + """
SELECT image_id, label NOT IN (9, 8, 6, 4) AS has_unit,
       CASE WHEN label NOT IN (9, 8, 6, 4) THEN round(vector[1]::DOUBLE
         / sqrt(list_inner_product(vector::DOUBLE[], vector::DOUBLE[])), 6) + 0.0 END AS first,
       CASE WHEN label NOT IN (9, 6, 4) THEN round(list_inner_product(vector::DOUBLE[], vector::DOUBLE[])
         / greatest(list_inner_product(vector::DOUBLE[], vector::DOUBLE[]), 1e-300), 6) + 0.0 END AS kept_length
FROM odd_vectors""")
def unit_or_null(spark, sf):
    """Both policies: no direction gives NULL, or zero vectors are kept."""
    unit, kept = V.unit_or_null(F.col("vector")), V.unit_or_same(F.col("vector"))
    finite = V.norm(F.col("vector")) < F.lit(V.INF)
    return I.odd_vectors(spark, sf).select(
        "image_id", unit.isNotNull().alias("has_unit"), (F.round(unit[0], 6) + 0.0).alias("first"),
        F.when(finite, F.round(V.squared_norm(kept), 6) + 0.0).alias("kept_length"))


@query("valid_vectors", ctes(I.ODD_VECTORS) + """
SELECT image_id, CAST(len(vector) AS INTEGER) AS dim FROM odd_vectors WHERE label NOT IN (9, 8, 6, 4)""")
def valid_vectors(spark, sf):
    return I.odd_vectors(spark, sf).where(V.is_usable(F.col("vector"))).select(
        "image_id", F.size("vector").alias("dim"))


_DOT = "list_inner_product(hsv_vector::DOUBLE[], hog_vector::DOUBLE[])"
_FITS = f"len(hsv_vector) = {I.SUB_DIM} AND hog_vector IS NOT NULL"


@query("dot_products", ctes(I.SUB_VECTORS) + f"""
SELECT image_id, CASE WHEN {_FITS} THEN round({_DOT}, 6) + 0.0 END AS dot FROM sub_vectors""")
def dot_products(spark, sf):
    return I.sub_vectors(spark, sf).select(
        "image_id", (F.round(V.dot(F.col("hsv_vector"), F.col("hog_vector")), 6) + 0.0).alias("dot"))


@query("safe_cosine", ctes(I.SUB_VECTORS) + f"""
SELECT image_id, CASE WHEN {_FITS} THEN round({_DOT}
   / sqrt(list_inner_product(hsv_vector::DOUBLE[], hsv_vector::DOUBLE[]))
   / sqrt(list_inner_product(hog_vector::DOUBLE[], hog_vector::DOUBLE[])), 6) + 0.0 ELSE 0 END AS by_column,
   by_column AS by_batch FROM sub_vectors""")
def safe_cosine(spark, sf):
    """The column expression and the Arrow batch kernel agree."""
    a, b = F.col("hsv_vector"), F.col("hog_vector")
    return rounded(I.sub_vectors(spark, sf).select(
        "image_id", V.safe_cosine(V.unit_or_null(a), V.unit_or_null(b)).alias("by_column"),
        F.coalesce(fusion.cosine(a, b), F.lit(0.0)).alias("by_batch")), "by_column", "by_batch")


@query("pad_legacy", ctes(I.SUB_VECTORS) + exploded_sql("full_hsv", "hsv_vector", "image_id"))
def pad_legacy(spark, sf):
    padded = V.pad_legacy(F.col("hsv_vector"), I.SUB_OLD, I.SUB_DIM)
    return exploded(I.sub_vectors(spark, sf).select("image_id", padded.alias("vector")), "vector", "image_id")


@query("storage_cast", ctes(I.VECTORS) + """
SELECT image_id, round(list_sum([CAST(x * x AS FLOAT)::DOUBLE FOR x IN vector::DOUBLE[]]), 6) AS total FROM vectors""")
def storage_cast(spark, sf):
    """Double results stored as 4-byte values."""
    squares = V.storage_cast(F.transform(V.doubles(F.col("vector")), lambda x: x * x))
    total = F.aggregate(V.doubles(squares), F.lit(0.0), lambda acc, x: acc + x)
    return I.vectors(spark, sf).select("image_id", F.round(total, 6).alias("total"))


@query("minmax", """
WITH raw AS (SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN 1.5 ELSE value END AS value FROM events),
ends AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM raw GROUP BY event_type)
SELECT event_id, CASE WHEN event_type = 'click' OR hi - lo < 1e-12 THEN 0
                 ELSE round((value - lo) / (hi - lo), 6) + 0.0 END AS score
FROM raw JOIN ends USING (event_type)""")
def minmax(spark, sf):
    """Rescaling per group by aggregate and join: a group may hold any share of the
    rows. One group is constant, one holds a NaN."""
    value = F.when(F.col("event_type") == "error", 1.5).otherwise(F.col("value"))
    rows = I.table(spark, sf, "events").select("event_id", "event_type", value.alias("value"))
    marked = rows.withColumn("value", F.when(
        (F.col("event_type") == "click") & (F.col("value") > 10), F.lit(float("nan"))).otherwise(F.col("value")))
    ends = marked.groupBy("event_type").agg(F.min("value").alias("lo"), F.max("value").alias("hi"),
                                            F.max(F.isnan("value")).alias("odd"))
    score = V.min_max(F.col("value"), F.col("lo"), F.col("hi"), F.col("odd"))
    return (marked.join(ends, "event_type")
            .select("event_id", (F.round(score, 6) + 0.0).alias("score")))


# ---- exact search ----------------------------------------------------------

@query("exact_topk", ctes(ODD_USABLE, ranked_sql("e", "e", 5)) + HITS)
def exact_topk(spark, sf):
    """Every image against all images; unusable vectors are left out."""
    rows = I.odd_vectors(spark, sf)
    return rounded(search.search_embeddings(I.as_queries(rows), rows, 5, dim=64), "score")


@query("exact_topk_blocks", ctes(EMBED, ranked_sql("e", "e", 5)) + HITS)
def exact_topk_blocks(spark, sf):
    """The route for query sets too large to broadcast."""
    rows = I.vectors(spark, sf)
    return rounded(nearest(I.as_queries(rows), rows, 5, query_bytes=0), "score")


@query("exact_topk_hsv", ctes(COLOUR, ranked_sql("e", "e", 5)) + HITS)
def exact_topk_hsv(spark, sf):
    rows = colours(spark, sf)
    return rounded(search.search_hsv(I.as_queries(rows), rows, 5, dim=I.SUB_DIM, legacy_dim=I.SUB_OLD), "score")


@query("exact_topk_hog_noself", ctes(SHAPE, ranked_sql("e", "e", 5, "q.image_id <> c.image_id")) + HITS)
def exact_topk_hog_noself(spark, sf):
    rows = shapes(spark, sf)
    return rounded(search.search_hog(I.as_queries(rows), rows, 5, dim=I.SUB_DIM), "score")


@query("flat_ip_topk", ctes(SHAPE, ranked_sql("e", "e", 10)) + HITS)
def flat_ip_topk(spark, sf):
    """Exact inner product search over stored unit vectors, self included."""
    units = search.stored_units(shapes(spark, sf))
    return rounded(search.search_hog(I.as_queries(units), units, 10, dim=I.SUB_DIM, exclude_self=False), "score")


@query("hits_with_paths", ctes(EMBED, I.FILES, ranked_sql("e", "e", 5)) + """
SELECT query_id, "rank", image_id, path, round(score, 6) + 0.0 AS score,
       round(1 - (1 - score), 6) + 0.0 AS from_distance
FROM hits JOIN files ON files.doc_id = hits.image_id""")
def hits_with_paths(spark, sf):
    rows = I.vectors(spark, sf)
    known = I.files(spark, sf).withColumnRenamed("doc_id", "image_id")
    hits = search.with_paths(search.search_embeddings(I.as_queries(rows), rows, 5), known)
    distance = F.lit(1.0) - F.col("score")
    return rounded(hits.select("query_id", "rank", "image_id", "path", "score",
                               V.score_from_distance(distance).alias("from_distance")),
                   "score", "from_distance")


@query("find_similar", ctes(COLOUR, I.FILES, ranked_sql("e", "e", 3)) + """
SELECT query_id, "rank", path, round(score, 6) + 0.0 AS score FROM hits JOIN files ON files.doc_id = hits.image_id""")
def find_similar(spark, sf):
    """Query vectors to paths by colour."""
    rows = colours(spark, sf)
    known = I.files(spark, sf).withColumnRenamed("doc_id", "image_id")
    hits = search.search_hsv(I.as_queries(rows), rows, 3, dim=I.SUB_DIM, legacy_dim=I.SUB_OLD)
    return rounded(search.with_paths(hits, known).select("query_id", "rank", "path", "score"), "score")


@query("candidate_features", ctes(EMBED, I.SUB_VECTORS, ranked_sql("e", "e", 5, "q.image_id <> c.image_id")) + """
SELECT image_id, CAST(coalesce(len(hsv_vector), -1) AS INTEGER) AS hsv_dim,
       CAST(coalesce(len(hog_vector), -1) AS INTEGER) AS hog_dim
FROM sub_vectors WHERE image_id IN (SELECT image_id FROM hits)""")
def candidate_features(spark, sf):
    rows = I.vectors(spark, sf)
    hits = search.search_embeddings(I.as_queries(rows), rows, 5, exclude_self=True)
    found = C.fetch(I.sub_vectors(spark, sf), hits, "hsv_vector", "hog_vector")
    return found.select("image_id", F.coalesce(F.size("hsv_vector"), F.lit(-1)).alias("hsv_dim"),
                        F.coalesce(F.size("hog_vector"), F.lit(-1)).alias("hog_dim"))


# ---- fusion ----------------------------------------------------------------

def combined_sql(k, candidates, w_embed, w_hsv, w_hog):
    def cosine(column, weight):
        if not weight:
            return "0"
        q, c = f"q.{column}::DOUBLE[]", f"s.{column}::DOUBLE[]"
        return (f"coalesce(list_inner_product({q}, {c}) / sqrt(list_inner_product({q}, {q})"
                f" * list_inner_product({c}, {c})), 0)")

    def norm(column):
        low, high = (f"{f}({column}) OVER (PARTITION BY query_id)" for f in ("min", "max"))
        return (f"CASE WHEN {high} - {low} < 1e-12 THEN 0 ELSE ({column} - {low}) / ({high} - {low}) END")

    return ctes(EMBED, I.SUB_VECTORS, ranked_sql("e", "e", candidates, name="cands")) + f""", raw AS (
  SELECT h.query_id, h.image_id, h.score AS s_embed, {cosine('hsv_vector', w_hsv)} AS s_hsv,
         {cosine('hog_vector', w_hog)} AS s_hog
  FROM cands h JOIN full_hsv q ON q.image_id = h.query_id JOIN full_hsv s ON s.image_id = h.image_id),
scaled AS (SELECT query_id, image_id, {norm('s_embed')} AS s_embed, {norm('s_hsv')} AS s_hsv,
                  {norm('s_hog')} AS s_hog FROM raw),
mixed AS (SELECT *, ({w_embed} * s_embed + {w_hsv} * s_hsv + {w_hog} * s_hog)
                    / {w_embed + w_hsv + w_hog}::DOUBLE AS score FROM scaled)
SELECT query_id, CAST(place AS INTEGER) AS "rank", image_id, round(score, 6) + 0.0 AS score,
       round(s_embed, 6) + 0.0 AS s_embed, round(s_hsv, 6) + 0.0 AS s_hsv, round(s_hog, 6) + 0.0 AS s_hog
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, image_id) AS place FROM mixed)
WHERE place <= {k}"""


def _combined(spark, sf, k, candidates, metrics, weights):
    rows, parts = I.vectors(spark, sf), I.sub_vectors(spark, sf)
    asked = (rows.withColumnRenamed("vector", "embedding").join(parts, "image_id")
             .withColumnRenamed("image_id", "query_id"))
    hits = fusion.combined_search(asked, rows, parts, k, metrics=metrics, weights=weights,
                                  candidates=candidates, hsv_dim=I.SUB_DIM, legacy_dim=I.SUB_OLD)
    return rounded(hits, "score", "s_embed", "s_hsv", "s_hog")


@query("combined_search", combined_sql(10, 300, 2, 1, 1))
def combined_search(spark, sf):
    return _combined(spark, sf, 10, 300, ("embed", "hsv", "hog"), (2, 1, 1))


@query("combined_search_two_metrics", combined_sql(5, 100, 0, 3, 1))
def combined_search_two_metrics(spark, sf):
    """Embeddings choose the candidates but carry no weight."""
    return _combined(spark, sf, 5, 100, ("hsv", "hog"), (3, 1))


@query("score_fusion", """
SELECT event_id, round((2 * value + 1 * length(props)) / 3::DOUBLE, 6) + 0.0 AS score, 0::DOUBLE AS unweighted
FROM events""")
def score_fusion(spark, sf):
    """Metrics left out weigh 0 and unknown names are ignored."""
    scores = {"embed": F.col("value"), "hsv": F.length("props").cast("double"), "hog": F.col("event_id")}
    mixed = V.weighted_mean(scores, {"embed": 2, "hsv": 1, "other": 9})
    return I.table(spark, sf, "events").select(
        "event_id", (F.round(mixed, 6) + 0.0).alias("score"), V.weighted_mean(scores, {}).alias("unweighted"))


# ---- indexes ---------------------------------------------------------------

def _lists(spark, sf):
    return ann.hsv_list_count(I.table(spark, sf, "embeddings").count())


@query("ivf_full_probe", ctes(EMBED, ranked_sql("e", "e", 5)) + HITS)
def ivf_full_probe(spark, sf):
    """All lists probed: equals exact search."""
    rows = I.vectors(spark, sf)
    index = ann.build_ivf(rows, fresh_dir(spark, "ivf"), nlist=_lists(spark, sf))
    return rounded(ann.search_ivf(index, I.as_queries(rows), 5, nprobe=_lists(spark, sf)), "score")


# Given centres: the first vectors of each label. Lists and probes are then plain SQL.
PER_LABEL, NPROBE = 3, 8
CENTRES = f"""
centres AS (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS list_id, embedding::DOUBLE[] AS c,
         sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS cn
  FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS nth FROM embeddings) t WHERE nth <= {PER_LABEL}),
near AS (
  SELECT image_id, list_id, row_number() OVER (
    PARTITION BY image_id
    ORDER BY round(list_inner_product(v::DOUBLE[], c) / cn / sqrt(list_inner_product(v::DOUBLE[], v::DOUBLE[])), 12) DESC, list_id) AS place
  FROM e, centres)"""
PROBED = f"""EXISTS (
  SELECT 1 FROM near a JOIN near b ON a.list_id = b.list_id AND b.place = 1
  WHERE a.image_id = q.image_id AND a.place <= {NPROBE} AND b.image_id = c.image_id)"""


def _centred_index(spark, sf):
    nth = F.row_number().over(Window.partitionBy("label").orderBy("vec_id"))
    chosen = I.table(spark, sf, "embeddings").withColumn("nth", nth).where(F.col("nth") <= PER_LABEL).orderBy("vec_id")
    centres = np.array([r.embedding for r in chosen.select("embedding").collect()])  # a few rows a label
    return ann.build_ivf(I.vectors(spark, sf), fresh_dir(spark, "ivf"), centres=centres)


@query("ivf_search", ctes(EMBED, CENTRES, ranked_sql("e", "e", 5, PROBED)) + HITS)
def ivf_search(spark, sf):
    """Some lists probed, around given centres: the same neighbours as in SQL."""
    rows = I.vectors(spark, sf)
    return rounded(ann.search_ann(I.as_queries(rows), _centred_index(spark, sf), 5, method="ivf", nprobe=NPROBE), "score")


@query("ivf_lists", ctes(EMBED, CENTRES) + "SELECT image_id, list_id FROM near WHERE place = 1")
def ivf_lists(spark, sf):
    """Every vector lies in the list of its nearest centre."""
    return _centred_index(spark, sf).lists.select("image_id", "list_id")


# Two levels: the first vector of each label is a cell, CENTRES are the lists.
CELLS = f"""
cells AS (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cell, embedding::DOUBLE[] AS t,
         sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS tn
  FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS nth FROM embeddings) x WHERE nth = 1),
homes AS (
  SELECT list_id AS nth, c, cn, cell FROM (
    SELECT list_id, c, cn, cell, row_number() OVER (
      PARTITION BY list_id ORDER BY round(list_inner_product(c, t) / cn / tn, 12) DESC, cell) AS place FROM centres, cells) WHERE place = 1),
named AS (SELECT *, cell * {1 << 16} + row_number() OVER (PARTITION BY cell ORDER BY nth) - 1 AS list_id FROM homes),
entered AS (
  SELECT image_id, v, cell FROM (
    SELECT image_id, v, cell, row_number() OVER (
      PARTITION BY image_id ORDER BY round(list_inner_product(v::DOUBLE[], t) / tn / sqrt(list_inner_product(v::DOUBLE[], v::DOUBLE[])), 12) DESC, cell) AS place
    FROM e, cells WHERE cell IN (SELECT cell FROM named)) WHERE place = 1)"""


def _two_level_index(spark, sf):
    nth = F.row_number().over(Window.partitionBy("label").orderBy("vec_id"))
    chosen = I.table(spark, sf, "embeddings").withColumn("nth", nth).where(F.col("nth") <= PER_LABEL).orderBy("vec_id")
    rows = chosen.select("embedding", "nth").collect()  # a few rows a label
    return ann.build_ivf(I.vectors(spark, sf), fresh_dir(spark, "ivf"), centres=np.array([r.embedding for r in rows]),
                         cells=np.array([r.embedding for r in rows if r.nth == 1]))


@query("ivf_two_levels", ctes(EMBED, CENTRES, CELLS) + """
SELECT image_id, list_id FROM (
  SELECT image_id, list_id, row_number() OVER (
    PARTITION BY image_id ORDER BY round(list_inner_product(v::DOUBLE[], c) / cn / sqrt(list_inner_product(v::DOUBLE[], v::DOUBLE[])), 12) DESC, list_id) AS place
  FROM entered JOIN named USING (cell)) WHERE place = 1""")
def ivf_two_levels(spark, sf):
    """Vectors descend to the nearest cell and to the nearest list of that cell."""
    return _two_level_index(spark, sf).lists.select("image_id", "list_id")


GROWN = """, g AS (
  SELECT image_id, CASE WHEN label = 2 THEN list_reverse(vector) ELSE vector END AS v FROM vectors WHERE label <> 3)"""


@query("ivf_grown", ctes(I.VECTORS + GROWN, ranked_sql("g", "g", 5)) + HITS)
def ivf_grown(spark, sf):
    """An index that lacked label 1 and then gained it, with label 2 replaced and label 3 removed: all
    lists probed equals exact search over the final rows."""
    rows = I.table(spark, sf, "embeddings").select(F.col("vec_id").alias("image_id"), F.col("embedding").alias("vector"), "label")
    index = ann.build_ivf(rows.where("label <> 1"), fresh_dir(spark, "ivf"), nlist=_lists(spark, sf))
    turned = rows.withColumn("vector", F.when(F.col("label") == 2, F.reverse("vector")).otherwise(F.col("vector")))
    index = list_index.append(index, rows.where("label = 1").select("image_id", "vector"))
    index = list_index.replace(index, turned.where("label = 2").select("image_id", "vector"), rows.where("label IN (2, 3)"))
    final = turned.where("label <> 3").select("image_id", "vector")
    return rounded(ann.search_ivf(index, I.as_queries(final), 5, nprobe=index.nlist), "score")


@query("ivf_update", """
SELECT 3 AS commits, CAST(count(*) AS BIGINT) AS appended, CAST((SELECT count(*) FROM embeddings WHERE label <> 4) AS BIGINT) AS rows
FROM embeddings WHERE label = 5""")
def ivf_update(spark, sf):
    """An index brought to the state of its table three times: new rows alone become a layer, vanished
    ones leave no vector behind, and an unchanged table writes nothing."""
    rows, path = I.table(spark, sf, "embeddings").select(F.col("vec_id").alias("image_id"), F.col("embedding").alias("vector"), "label"), fresh_dir(spark, "ivf")
    plain = rows.select("image_id", "vector")
    ann.load_or_update(rows.where("label <> 5").select("image_id", "vector"), path, nlist=_lists(spark, sf))
    grown = ann.load_or_update(plain, path)
    ann.load_or_update(rows.where("label <> 4").select("image_id", "vector"), path)
    index = ann.load_or_update(rows.where("label <> 4").select("image_id", "vector"), path)
    return index.lists.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(index.number).alias("commits"), F.lit(grown.record["layers"][1]["rows"]).cast("bigint").alias("appended"), "rows")


def trained_search(spark, sf):
    rows = I.vectors(spark, sf)
    index = ann.build_ivf(rows, fresh_dir(spark, "ivf"), nlist=_lists(spark, sf))
    return rounded(ann.search_ann(I.as_queries(rows), index, 5, method="ivf", nprobe=8), "score")


@query("ivf_build", """
SELECT vec_id AS image_id, round(list_sum(embedding::DOUBLE[]), 6) + 0.0 AS total FROM embeddings""")
def ivf_build(spark, sf):
    """The index holds every vector exactly once."""
    rows = I.vectors(spark, sf)
    index = ann.build_ivf(rows, fresh_dir(spark, "ivf"), nlist=_lists(spark, sf))
    total = F.aggregate(V.doubles(F.col("vector")), F.lit(0.0), lambda acc, x: acc + x)
    return index.lists.select("image_id", (F.round(total, 6) + 0.0).alias("total"))


# Given planes: the first vectors of the table. Buckets are then plain SQL.
TABLES, BITS = 12, 6
PLANES = f"""
planes AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS nth, embedding::DOUBLE[] AS p FROM embeddings
  QUALIFY nth < {TABLES * BITS}),
buckets AS (
  SELECT image_id, nth // {BITS} AS tab, sum(CASE WHEN list_inner_product(v::DOUBLE[], p) > 0 THEN 1 << (nth % {BITS}) ELSE 0 END) AS cell
  FROM e, planes GROUP BY image_id, nth // {BITS})"""
MET = """EXISTS (SELECT 1 FROM buckets a JOIN buckets b ON a.tab = b.tab AND a.cell = b.cell
  WHERE a.image_id = q.image_id AND b.image_id = c.image_id)"""


@query("lsh_search", ctes(EMBED, PLANES, ranked_sql("e", "e", 5, MET)) + HITS)
def lsh_search(spark, sf):
    """Hash buckets of given planes: the same neighbours as in SQL."""
    rows = I.vectors(spark, sf)
    first = I.table(spark, sf, "embeddings").orderBy("vec_id").limit(TABLES * BITS).select("embedding").collect()
    planes = np.array([r.embedding for r in first]).T
    return rounded(ann.search_ann(I.as_queries(rows), rows, 5, method="lsh", tables=TABLES, bits=BITS, planes=planes), "score")


MULTI = f"""
signs AS (
  SELECT image_id, nth // {BITS} AS tab, nth % {BITS} AS bit, list_inner_product(v::DOUBLE[], p) AS side
  FROM e, planes),
turned AS (
  SELECT image_id, tab, cell, xor(CAST(cell AS BIGINT), CAST(1 << weak AS BIGINT)) AS other FROM buckets JOIN (
    SELECT image_id, tab, arg_min(bit, abs(side)) AS weak FROM signs GROUP BY image_id, tab) USING (image_id, tab))"""
MET_MULTI = """EXISTS (SELECT 1 FROM turned a JOIN buckets b ON a.tab = b.tab AND b.cell IN (a.cell, a.other)
  WHERE a.image_id = q.image_id AND b.image_id = c.image_id)"""


@query("lsh_stored", ctes(EMBED, PLANES, MULTI, ranked_sql("e", "e", 5, MET_MULTI)) + HITS)
def lsh_stored(spark, sf):
    """A stored hash index, opened again, with the least certain sign turned in every table."""
    rows, path = I.vectors(spark, sf), fresh_dir(spark, "hash")
    first = I.table(spark, sf, "embeddings").orderBy("vec_id").limit(TABLES * BITS).select("embedding").collect()
    hash_index.build_hash_index(rows, path, tables=TABLES, bits=BITS, planes=np.array([r.embedding for r in first]).T)
    return rounded(ann.search_ann(I.as_queries(rows), hash_index.load_hash_index(spark, path), 5, method="lsh", flips=1), "score")


def random_search(spark, sf):
    rows = I.vectors(spark, sf)
    return rounded(ann.search_ann(I.as_queries(rows), rows, 5, method="lsh", tables=12, bits=6), "score")


EXACT = """
SELECT vec_id AS query_id, CAST(unnest(range(1, 6)) AS INTEGER) AS "rank", true AS exact FROM embeddings"""


def _rescored(hits, rows):
    """Whether each hit's score is the cosine of its two vectors and each query finds
    itself first."""
    a = rows.select(F.col("image_id").alias("query_id"), F.col("vector").alias("a"))
    pairs = hits.join(a, "query_id").join(rows.withColumnRenamed("vector", "b"), "image_id")
    cosine = V.dot(V.unit_or_null(F.col("a")), V.unit_or_null(F.col("b")))
    exact = (F.abs(cosine - F.col("score")) < 1e-6) & (
        (F.col("rank") > 1) | (F.col("query_id") == F.col("image_id")))
    return pairs.select("query_id", "rank", exact.alias("exact"))


@query("ivf_scores", EXACT)
def ivf_scores(spark, sf):
    return _rescored(trained_search(spark, sf), I.vectors(spark, sf))


@query("lsh_scores", EXACT)
def lsh_scores(spark, sf):
    return _rescored(random_search(spark, sf), I.vectors(spark, sf))


@query("lsh_one_bucket", ctes(EMBED, ranked_sql("e", "e", 5)) + HITS)
def lsh_one_bucket(spark, sf):
    """Without hash bits all vectors share one bucket per table: equals exact search,
    and the bucket is cut into blocks."""
    rows = I.vectors(spark, sf)
    return rounded(ann.search_lsh(I.as_queries(rows), rows, 5, tables=2, bits=0, query_bytes=0,
                                  block_bytes=0), "score")


@query("index_reuse", """SELECT true AS same_path, true AS changed_path, true AS restated_path, count(*) AS rows FROM embeddings""")
def index_reuse(spark, sf):
    """A second call opens the saved index without reading a vector; changed vectors, or a changed
    file, get an index of their own."""
    rows, base = I.vectors(spark, sf), fresh_dir(spark, "indexes")
    lists = _lists(spark, sf)
    first = ann.load_or_build(rows, base, nlist=lists)
    again = ann.load_or_build(rows, base, nlist=lists)
    other = rows.withColumn("vector", F.reverse("vector"))
    changed = ann.content_name(other) != ann.content_name(rows)
    stamped = rows.withColumns({"file_size": F.col("image_id") * 3, "mtime": F.col("image_id").cast("double")})
    touched = stamped.withColumn("mtime", F.col("mtime") + F.when(F.col("image_id") % 7 == 0, 0.001).otherwise(0.0))
    opened = ann.load_or_build(stamped, base, nlist=lists)
    restated = (ann.load_or_build(stamped, base, nlist=lists).path == opened.path
                and ann.content_name(touched) != ann.content_name(stamped))
    return again.lists.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(first.path == again.path).alias("same_path"), F.lit(changed).alias("changed_path"),
        F.lit(restated).alias("restated_path"), "rows")


# ---- samples ---------------------------------------------------------------

@query("sample_md5", ctes(I.SCAN) + """
SELECT image_id, path FROM (
  SELECT image_id, path, CAST(concat('0x', substr(md5('42:' || image_id), 1, 15)) AS BIGINT) AS h FROM scan)
ORDER BY h, image_id LIMIT 100""")
def sample_md5(spark, sf):
    return selection.uniform_sample(I.scan(spark, sf).select("image_id", "path"), "image_id", 100)


@query("sample_uniform", """
SELECT vec_id AS image_id FROM embeddings
ORDER BY CAST(concat('0x', substr(md5('7:' || vec_id), 1, 15)) AS BIGINT), vec_id LIMIT 200""")
def sample_uniform(spark, sf):
    """Training sample without replacement, zero vectors skipped."""
    rows = I.vectors(spark, sf).where(V.is_usable(F.col("vector")))
    return selection.uniform_sample(rows, "image_id", 200, seed=7).select("image_id")
