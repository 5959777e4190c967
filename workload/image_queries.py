"""Colour, shape and model features; relational forms and Arrow jobs."""

from pyspark.sql import functions as F

from likeness.functions import colour, vectors as V
from likeness.operators import features as X
from likeness.plans import find, jobs
from likeness.schemas import FEATURES
from likeness.session import fresh_dir
from likeness.sources.vectors import read_features
from workload import inputs as I
from workload.registry import ctes, exploded, query

HSV = (I.PIXELS, I.hsv_sql("pixels"))

MASKS = """
counts AS (
  SELECT image_id, CAST(count(*) AS BIGINT) AS pixels,
         CAST(count(*) FILTER (s >= 16 AND v >= 16) AS BIGINT) AS colourful,
         CAST(count(*) FILTER (v >= 16) AS BIGINT) AS bright FROM hsv GROUP BY image_id),
masks AS (
  SELECT *, CASE WHEN colourful >= 0.05::DOUBLE * pixels THEN 0 WHEN bright > 0 THEN 1 ELSE 2 END AS level FROM counts)"""

BINS = """
binned AS (
  SELECT image_id, bin, count(*) AS n FROM (
    SELECT h.image_id, unnest([(h * 12 // 180) * 12 + s * 12 // 256, 144 + v * 32 // 256]) AS bin
    FROM hsv h JOIN masks m ON m.image_id = h.image_id
    WHERE level = 2 OR (level = 1 AND v >= 16) OR (level = 0 AND v >= 16 AND s >= 16))
  GROUP BY image_id, bin),
filled AS (
  SELECT image_id, CAST(bin AS BIGINT) AS bin,
         n / sqrt(sum(n * n) OVER (PARTITION BY image_id, bin >= 144)::DOUBLE) AS value FROM binned)"""


def dense_sql(source, total):
    return f"""
SELECT i.image_id, CAST(p.pos AS INTEGER) AS pos, round(coalesce(CAST(f.value AS FLOAT), 0)::DOUBLE, 6) AS val
FROM (SELECT DISTINCT image_id FROM {source}) i CROSS JOIN (SELECT unnest(range({total})) AS pos) p
LEFT JOIN {source} f ON f.image_id = i.image_id AND f.bin = p.pos"""


# ---- relational forms over pixels ------------------------------------------

@query("hsv_pixels", ctes(*HSV) + "SELECT image_id, b, g, r, h, s, v FROM hsv")
def hsv_pixels(spark, sf):
    return colour.hsv_pixels(I.pixels(spark, sf))


@query("adaptive_mask", ctes(*HSV, MASKS) + """
SELECT image_id, pixels, colourful, bright, level,
       CASE level WHEN 0 THEN colourful WHEN 1 THEN bright ELSE pixels END AS kept FROM masks""")
def adaptive_mask(spark, sf):
    return colour.mask_levels(I.pixels(spark, sf))


@query("hs_histogram", ctes(*HSV, MASKS, BINS)
       + "SELECT image_id, bin, round(value, 6) AS value FROM filled WHERE bin < 144")
def hs_histogram(spark, sf):
    bins = colour.histograms(I.pixels(spark, sf)).where(F.col("bin") < colour.HS_TOTAL)
    return bins.withColumn("value", F.round("value", 6))


@query("v_histogram", ctes(*HSV, MASKS, BINS)
       + "SELECT image_id, bin - 144 AS bin, round(value, 6) AS value FROM filled WHERE bin >= 144")
def v_histogram(spark, sf):
    bins = colour.histograms(I.pixels(spark, sf)).where(F.col("bin") >= colour.HS_TOTAL)
    return bins.select("image_id", (F.col("bin") - colour.HS_TOTAL).alias("bin"),
                       F.round("value", 6).alias("value"))


@query("hsv_descriptor", ctes(*HSV, MASKS, BINS) + dense_sql("filled", 176))
def hsv_descriptor(spark, sf):
    return exploded(colour.descriptors(I.pixels(spark, sf)), "vector", "image_id")


@query("legacy_signature", ctes(*HSV, """
signature AS (
  SELECT image_id, bin, n / sqrt(sum(n * n) OVER (PARTITION BY image_id)::DOUBLE) AS value FROM (
    SELECT image_id, CAST((h * 8 // 180) * 8 + s * 8 // 256 AS BIGINT) AS bin, count(*) AS n FROM hsv
    GROUP BY image_id, (h * 8 // 180) * 8 + s * 8 // 256))""") + dense_sql("signature", 64))
def legacy_signature(spark, sf):
    return exploded(colour.legacy_signatures(I.pixels(spark, sf)), "vector", "image_id")


# ---- Arrow jobs over images ------------------------------------------------

@query("resize_images", ctes(I.IMAGES, """
axis AS (
  SELECT i, j, greatest(0, least((i + 1) * 4 / 3::DOUBLE, j + 1) - greatest(i * 4 / 3::DOUBLE, j)) * 0.75::DOUBLE AS w
  FROM range(6) a(i), range(8) b(j)),
mixed AS (
  SELECT image_id, ay.i AS y, ax.i AS x, sum(ay.w * ax.w * b) AS b, sum(ay.w * ax.w * g) AS g, sum(ay.w * ax.w * r) AS r
  FROM image_pixels p JOIN axis ay ON ay.j = p.y AND ay.w > 0 JOIN axis ax ON ax.j = p.x AND ax.w > 0
  GROUP BY image_id, ay.i, ax.i)""") + """
SELECT image_id, CAST(pos AS INTEGER) AS pos, round_even(round(val, 9), 0) AS val FROM (
  SELECT image_id, (y * 6 + x) * 3 + unnest([0, 1, 2]) AS pos, unnest([b, g, r]) AS val FROM mixed)""")
def resize_images(spark, sf):
    """8 x 8 images averaged down to 6 x 6."""
    return exploded(X.resized(I.images(spark, sf), 6), "vector", "image_id")


# The 100 x 100 enlargement blends only where a target cell crosses a border.
ENLARGED = """
axis AS (
  SELECT lo, least(lo + 1, 7) AS hi, share - floor(share) AS share, count(*) AS n FROM (
    SELECT lo, greatest((i + 1) - (lo + 1) / 0.08::DOUBLE, 0) AS share
    FROM (SELECT i, CAST(floor(i * 0.08::DOUBLE) AS BIGINT) AS lo FROM range(100) t(i)))
  GROUP BY ALL),
corners AS (
  SELECT a.lo AS y0, a.hi AS y1, a.share AS sy, c.lo AS x0, c.hi AS x1, c.share AS sx, a.n * c.n AS n FROM axis a, axis c),
large AS (
  SELECT p.image_id, k.n, {blue} AS b, {green} AS g, {red} AS r
  FROM corners k JOIN image_pixels p ON p.y = k.y0 AND p.x = k.x0
  JOIN image_pixels q ON q.image_id = p.image_id AND q.y = k.y0 AND q.x = k.x1
  JOIN image_pixels u ON u.image_id = p.image_id AND u.y = k.y1 AND u.x = k.x0
  JOIN image_pixels w ON w.image_id = p.image_id AND w.y = k.y1 AND w.x = k.x1)""".format(**{
    name: (f"CAST(floor(round((1 - sy) * ((1 - sx) * p.{c} + sx * q.{c}) + sy * ((1 - sx) * u.{c} + sx * w.{c}), 9)"
           " + 0.5::DOUBLE) AS BIGINT)") for name, c in (("blue", "b"), ("green", "g"), ("red", "r"))})

LARGE_HSV = ctes(I.IMAGES, ENLARGED, I.hsv_sql("large", ", n"), """
counts AS (
  SELECT image_id, sum(n) FILTER (s >= 16 AND v >= 16) AS colourful, sum(n) FILTER (v >= 16) AS bright
  FROM hsv GROUP BY image_id),
masks AS (
  SELECT image_id, CASE WHEN coalesce(colourful, 0) >= 500 THEN 0 WHEN bright > 0 THEN 1 ELSE 2 END AS level FROM counts),
binned AS (
  SELECT image_id, bin, sum(n)::DOUBLE AS n FROM (
    SELECT h.image_id, n, unnest([(h * 12 // 180) * 12 + s * 12 // 256, 144 + v * 32 // 256]) AS bin
    FROM hsv h JOIN masks m ON m.image_id = h.image_id
    WHERE level = 2 OR (level = 1 AND v >= 16) OR (level = 0 AND v >= 16 AND s >= 16))
  GROUP BY image_id, bin),
filled AS (
  SELECT image_id, bin, n / sqrt(sum(n * n) OVER (PARTITION BY image_id, bin >= 144)) AS value FROM binned)""")


def _filled(df):
    return exploded(df, "vector", "image_id").where(F.col("val") > 0)


FILLED = """SELECT image_id, CAST(bin AS INTEGER) AS pos, round(CAST(value AS FLOAT)::DOUBLE, 6) AS val FROM filled
WHERE round(CAST(value AS FLOAT)::DOUBLE, 6) > 0"""


@query("hsv_vectors", LARGE_HSV + FILLED)
def hsv_vectors(spark, sf):
    return _filled(X.hsv_vectors(I.images(spark, sf)))


def _job(spark, sf, compute, *options, **named):
    """Ingest a folder of image files, then run a feature job on what is missing."""
    root = I.image_folder(spark, sf, ("photos", "_raw", "summer 2024"))
    snapshots = jobs.Snapshots(spark, fresh_dir(spark, "catalogue"))
    jobs.ingest(spark, root, snapshots)
    path = fresh_dir(spark, "features")
    known = snapshots.read()
    compute(known, path, *options, decode=I.unpng, shards=8, **named)
    current = jobs.current_features(known, read_features(spark, path, FEATURES), "vector")
    number = F.regexp_extract("file_name", r"^(\d+)", 1).cast("long").alias("number")
    return current.join(known.select("image_id", number), "image_id").select(
        F.col("number").alias("image_id"), "vector")


@query("hsv_images", LARGE_HSV + FILLED)
def hsv_images(spark, sf):
    """The colour job over image files, end to end."""
    return _filled(_job(spark, sf, jobs.compute_hsv))


GREY = """
greys AS (
  SELECT image_id, y, x, (3735 * b + 19235 * g + 9798 * r + 16384) // 32768 AS grey FROM image_pixels)"""


@query("grey_images", ctes(I.IMAGES, GREY) + """
SELECT image_id, CAST(4096 AS INTEGER) AS dim, CAST(64 * sum(grey) AS DOUBLE) AS total,
       CAST(max(grey) AS DOUBLE) AS brightest FROM greys GROUP BY image_id""")
def grey_images(spark, sf):
    rows = X.grey_images(I.images(spark, sf))
    total = F.aggregate(V.doubles(F.col("vector")), F.lit(0.0), lambda acc, x: acc + x)
    return rows.select("image_id", F.size("vector").alias("dim"), total.alias("total"),
                       F.array_max("vector").cast("double").alias("brightest"))


# Every grey value covers 8 x 8 pixels of the 64 x 64 image.
HOG = ctes(I.IMAGES, GREY, """
shades AS (SELECT image_id, y, x, grey::DOUBLE AS shade FROM greys),
near AS (
  SELECT i, CASE WHEN i = 0 THEN 1 ELSE i - 1 END // 8 AS before, i // 8 AS here,
         CASE WHEN i = 63 THEN 62 ELSE i + 1 END // 8 AS after FROM range(64) t(i)),
slopes AS (
  SELECT e.image_id, v.i AS y, h.i AS x, e.shade - w.shade AS dx, s.shade - n.shade AS dy
  FROM near v, near h
  JOIN shades e ON e.y = v.here AND e.x = h.after
  JOIN shades w ON w.image_id = e.image_id AND w.y = v.here AND w.x = h.before
  JOIN shades s ON s.image_id = e.image_id AND s.y = v.after AND s.x = h.here
  JOIN shades n ON n.image_id = e.image_id AND n.y = v.before AND n.x = h.here
  WHERE h.before <> h.after OR v.before <> v.after),
turned AS (
  SELECT image_id, y, x, sqrt(dx * dx + dy * dy) AS strength,
         CASE WHEN atan2(dy, dx) < 0 THEN atan2(dy, dx) + 2 * pi() ELSE atan2(dy, dx) END * 9 / pi() - 0.5::DOUBLE AS angle
  FROM slopes WHERE dx <> 0 OR dy <> 0),
votes AS (
  SELECT image_id, y, x, CAST(floor(angle) + 9 AS BIGINT) % 9 AS o, strength * (1 - (angle - floor(angle))) AS w FROM turned
  UNION ALL
  SELECT image_id, y, x, CAST(floor(angle) + 10 AS BIGINT) % 9, strength * (angle - floor(angle)) FROM turned),
shares AS (
  SELECT block, cell, block * 8 + k AS i,
         (1 - abs((k + 0.5::DOUBLE) / 8 - 0.5::DOUBLE - cell)) * exp(-(k - 8) * (k - 8) / 32::DOUBLE) AS w
  FROM range(7) b(block), range(2) c(cell), range(16) a(k)
  WHERE abs((k + 0.5::DOUBLE) / 8 - 0.5::DOUBLE - cell) < 1),
across AS (
  SELECT image_id, y, block AS col_, cell AS cx, o, sum(v.w * s.w) AS w FROM votes v JOIN shares s ON s.i = v.x
  GROUP BY image_id, y, block, cell, o),
cells AS (
  SELECT image_id, col_, block AS row_, cx, cell AS cy, o, sum(a.w * s.w) AS w FROM across a JOIN shares s ON s.i = a.y
  GROUP BY image_id, col_, block, cx, cell, o),
clipped AS (
  SELECT *, least(0.2::DOUBLE, w / (sqrt(sum(w * w) OVER (PARTITION BY image_id, col_, row_)) + 3.6::DOUBLE)) AS u FROM cells),
scaled AS (
  SELECT *, u / (sqrt(sum(u * u) OVER (PARTITION BY image_id, col_, row_)) + 0.001::DOUBLE) AS z FROM clipped),
hog AS (
  SELECT image_id, (col_ * 7 + row_) * 36 + (cx * 2 + cy) * 9 + o AS pos,
         CAST(z / sqrt(sum(z * z) OVER (PARTITION BY image_id)) AS FLOAT)::DOUBLE AS val FROM scaled)""") + """
SELECT image_id, round(sum(val * (pos + 1)), 4) AS mark, round(sum(val * val), 6) AS length, CAST(1764 AS INTEGER) AS dim
FROM hog GROUP BY image_id"""


def _marked(df):
    """A sum that weighs every value by its place, and the squared length."""
    v = V.doubles(F.col("vector"))
    placed = F.transform(v, lambda x, i: x * (i + 1))
    return df.select("image_id", F.round(F.aggregate(placed, F.lit(0.0), lambda a, x: a + x), 4).alias("mark"),
                     F.round(V.squared_norm(F.col("vector")), 6).alias("length"), F.size("vector").alias("dim"))


@query("hog_vectors", HOG)
def hog_vectors(spark, sf):
    return _marked(X.hog_vectors(I.images(spark, sf)))


@query("hog_images", HOG)
def hog_images(spark, sf):
    """The shape job over image files, end to end."""
    return _marked(_job(spark, sf, jobs.compute_hog))


# Standardised in single precision, as the model input is.
PLANES = """
planes AS (
  SELECT image_id, 0 AS c, y * 8 + x AS p, (r::FLOAT / 255::FLOAT - 0.485::FLOAT) / 0.229::FLOAT AS z FROM image_pixels
  UNION ALL SELECT image_id, 1, y * 8 + x, (g::FLOAT / 255::FLOAT - 0.456::FLOAT) / 0.224::FLOAT FROM image_pixels
  UNION ALL SELECT image_id, 2, y * 8 + x, (b::FLOAT / 255::FLOAT - 0.406::FLOAT) / 0.225::FLOAT FROM image_pixels)"""


@query("model_inputs", ctes(I.IMAGES, PLANES) + """
SELECT image_id, CAST(150528 AS INTEGER) AS dim, round(sum(z::DOUBLE) * 784, 3) + 0.0 AS total FROM planes GROUP BY image_id""")
def model_inputs(spark, sf):
    rows = X.model_inputs(I.images(spark, sf))
    total = F.aggregate(F.col("vector"), F.lit(0.0), lambda acc, x: acc + V.doubles(x, one=True))
    return rows.select("image_id", F.size("vector").alias("dim"), (F.round(total, 3) + 0.0).alias("total"))


@query("model_inference", ctes(I.IMAGES, PLANES)
       + "SELECT image_id, CAST(c * 64 + p AS INTEGER) AS pos, round(z::DOUBLE, 6) + 0.0 AS val FROM planes")
def model_inference(spark, sf):
    """Prepared inputs through a stand-in model that averages patches."""
    outputs = X.model_inputs(I.images(spark, sf)).select(
        "image_id", X.model_inference(F.col("vector"), I.pooled_model, 64).alias("vector"))
    return exploded(outputs, "vector", "image_id")


EMBEDDED = ctes(I.IMAGES, PLANES) + """
SELECT image_id, CAST(c * 64 + p AS INTEGER) AS pos,
       round(CAST(z::DOUBLE / sqrt(sum(z::DOUBLE * z::DOUBLE) OVER (PARTITION BY image_id)) AS FLOAT)::DOUBLE, 6) + 0.0 AS val
FROM planes"""


@query("embed_images", EMBEDDED)
def embed_images(spark, sf):
    """The embedding job over image files, end to end."""
    rows = _job(spark, sf, jobs.compute_embeddings, I.pooled_model)
    return exploded(rows, "vector", "image_id")


@query("query_features", f"""
SELECT h.image_id AS query_id, e.mark AS embed_mark, c.mark AS hsv_mark, h.mark AS hog_mark, h.length AS hog_length
FROM ({HOG}) h
JOIN (SELECT image_id, round(sum(val * (pos + 1)), 3) + 0.0 AS mark FROM ({EMBEDDED}) GROUP BY image_id) e USING (image_id)
JOIN (SELECT image_id, round(sum(unit * (bin + 1)), 2) + 0.0 AS mark FROM (
        SELECT image_id, bin, CAST(value / sqrt(sum(value * value) OVER (PARTITION BY image_id)) AS FLOAT)::DOUBLE AS unit
        FROM ({LARGE_HSV} SELECT image_id, bin, CAST(value AS FLOAT)::DOUBLE AS value FROM filled))
      GROUP BY image_id) c USING (image_id)""")
def query_features(spark, sf):
    """All three features of query images by value: sums that weigh each value by its place."""
    rows = X.query_features(I.images(spark, sf), I.pooled_model)

    def mark(column, digits=None):
        values = V.doubles(F.col(column))
        values = F.transform(values, lambda x: F.round(x, digits)) if digits else values
        placed = F.transform(values, lambda x, i: x * (i + 1))
        return F.aggregate(placed, F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        "query_id", (F.round(mark("embedding", 6), 3) + 0.0).alias("embed_mark"),
        (F.round(mark("hsv_vector"), 2) + 0.0).alias("hsv_mark"), F.round(mark("hog_vector"), 4).alias("hog_mark"),
        F.round(V.squared_norm(F.col("hog_vector")), 6).alias("hog_length"))


@query("find_similar_images", LARGE_HSV.rstrip() + """, unit AS (
  SELECT image_id, bin, value / sqrt(sum(value * value) OVER (PARTITION BY image_id)) AS value FROM filled),
pairs AS (
  SELECT q.image_id AS query_id, c.image_id, sum(q.value * c.value) AS score
  FROM unit q JOIN unit c ON q.bin = c.bin GROUP BY q.image_id, c.image_id)
SELECT query_id, CAST(place AS INTEGER) AS "rank", round(score, 4) + 0.0 AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC) AS place FROM pairs)
WHERE place <= 5 AND image_id IN (SELECT doc_id FROM documents)""")
def find_similar_images(spark, sf):
    """Images to similar images by colour, features computed on both sides."""
    rows = I.images(spark, sf)
    known = I.files(spark, sf).withColumnRenamed("doc_id", "image_id")
    held = X.hsv_vectors(rows)
    hits = find.find_similar(rows.withColumnRenamed("image_id", "query_id"), held, known, 5)
    return hits.select("query_id", "rank", (F.round("score", 4) + 0.0).alias("score"))


@query("find_combined_images", """
SELECT vec_id AS query_id, CAST(1 AS INTEGER) AS "rank", vec_id AS image_id, 1::DOUBLE AS score FROM embeddings
WHERE vec_id IN (SELECT doc_id FROM documents)""")
def find_combined_images(spark, sf):
    """Images to similar images by all three features; each finds itself first."""
    rows = I.images(spark, sf)
    known = I.files(spark, sf).withColumnRenamed("doc_id", "image_id")
    held = X.query_features(rows, I.pooled_model).withColumnRenamed("query_id", "image_id")
    path = fresh_dir(spark, "held")
    held.write.parquet(path)
    held = spark.read.parquet(path)
    hits = find.find_combined(
        rows.withColumnRenamed("image_id", "query_id"),
        held.select("image_id", F.col("embedding").alias("vector")), held, known, I.pooled_model, 3, candidates=50)
    first = hits.where(F.col("rank") == 1)
    return first.select("query_id", "rank", "image_id", F.round("score", 6).alias("score"))
