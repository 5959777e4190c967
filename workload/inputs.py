"""Inputs of the queries, derived from whole tables; each Spark form stands next to
the SQL that derives the same rows."""

import zlib
import struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from likeness.functions import paths as P
from likeness.operators import catalogue as C
from likeness.schemas import IMAGE
from likeness.session import fresh_dir, open_filesystem

FOLDERS = ("photos", ".git", "Trash", "Recycled", "summer 2024", "_raw", ".cache",
           "System Volume Information")
ENDINGS = (".jpg", ".JPG", ".png", ".webp", ".txt", ".jpeg")
SUB_DIM, SUB_OLD = 32, 24


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _pick(values, number):
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(number, F.lit(len(values))) + 1).cast("int"))


def _sql_list(values):
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


# ---- files -----------------------------------------------------------------

def files(spark, sf) -> DataFrame:
    """One image file per document."""
    doc = F.col("doc_id")
    path = F.concat(F.lit("/data/"), "source", F.lit("/"), "lang", F.lit("/"), _pick(FOLDERS, doc),
                    F.lit("/"), doc.cast("string"), _pick(ENDINGS, doc))
    return table(spark, sf, "documents").select(
        "doc_id", path.alias("path"), F.col("n_chars").alias("file_size"),
        doc.cast("double").alias("mtime"))


FILES = f"""
files AS (
  SELECT doc_id,
         '/data/' || source || '/' || lang || '/' || {_sql_list(FOLDERS)}[doc_id % {len(FOLDERS)} + 1]
           || '/' || doc_id || {_sql_list(ENDINGS)}[doc_id % {len(ENDINGS)} + 1] AS path,
         n_chars AS file_size, CAST(doc_id AS DOUBLE) AS mtime
  FROM documents)"""

SQL_ID = "CAST(concat('0x', substr(md5(path), 1, 15)) AS BIGINT)"
SQL_NAME = "regexp_extract(path, '[^/]*$')"
SQL_DIR = "regexp_replace(path, '/[^/]*$', '')"
SQL_EXT = r"lower(regexp_extract(regexp_extract(path, '[^/]*$'), '(?s)^\.*[^.].*(\.[^.]*)$', 1))"
SQL_IMAGE = f"{SQL_EXT} IN ('.jpg', '.jpeg', '.png', '.webp')"
SQL_SKIP = ("len(list_intersect(string_split(lower(path), '/'), "
            + _sql_list(P.SKIP_NAMES) + ")) > 0")
SQL_HIDDEN = "regexp_matches(substr(path, 6), '/\\.')"
SQL_PURGE = "(" + " OR ".join(f"contains(lower(path), '{m}')" for m in P.PURGE_MARKS) + ")"


def scan(spark, sf) -> DataFrame:
    """The present scan: all documents' files."""
    return C.describe(files(spark, sf), P.image_id_md5)


SCAN = f"""{FILES},
scan AS (
  SELECT {SQL_ID} AS image_id, path, {SQL_NAME} AS file_name, {SQL_DIR} AS directory, file_size, mtime
  FROM files)"""


def catalogue(spark, sf) -> DataFrame:
    """An older catalogue: labelled documents with partly outdated sizes, colour and
    shape vectors where an embedding exists, and files the scan no longer lists."""
    size = (F.when(F.col("toxic") == 1, None)
            .when(F.col("quality") == 0, F.col("file_size") - 1).otherwise(F.col("file_size")))
    known = (files(spark, sf).join(table(spark, sf, "labels"), "doc_id")
             .join(sub_vectors(spark, sf).withColumnRenamed("image_id", "doc_id"), "doc_id", "left")
             .select("path", size.alias("file_size"), "mtime", "hsv_vector", "hog_vector"))
    gone = table(spark, sf, "pages").select(
        F.concat(F.lit("/web/"), F.col("page_id").cast("string"), F.lit("/RECYCLED"), F.lit("/page.png")).alias("path"),
        F.length("html").cast("long").alias("file_size"), F.lit(0.0).alias("mtime"),
        F.lit(None).cast("array<float>").alias("hsv_vector"),
        F.lit(None).cast("array<float>").alias("hog_vector"))
    listed = known.unionByName(gone)
    return listed.select(P.image_id_md5(F.col("path")).alias("image_id"), "path",
                         P.file_name(F.col("path")).alias("file_name"),
                         P.directory(F.col("path")).alias("directory"),
                         "file_size", "mtime", "hsv_vector", "hog_vector")


# ---- vectors ---------------------------------------------------------------

def vectors(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("image_id"), F.col("embedding").alias("vector"))


def as_queries(rows: DataFrame) -> DataFrame:
    """Every image asks for its neighbours."""
    return rows.withColumnRenamed("image_id", "query_id")


VECTORS = "vectors AS (SELECT vec_id AS image_id, embedding AS vector, label FROM embeddings)"


def sub_vectors(spark, sf) -> DataFrame:
    """Colour and shape stand-ins: the two halves of each embedding. Label 7 has no
    colour vector, label 5 a short one of the old kind, label 3 no shape vector."""
    e = F.col("embedding")
    colour = (F.when(F.col("label") == 7, None)
              .when(F.col("label") == 5, F.slice(e, 1, SUB_OLD)).otherwise(F.slice(e, 1, SUB_DIM)))
    shape = F.when(F.col("label") != 3, F.slice(e, SUB_DIM + 1, SUB_DIM))
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("image_id"), colour.alias("hsv_vector"), shape.alias("hog_vector"))


SUB_VECTORS = f"""
sub_vectors AS (
  SELECT vec_id AS image_id, label,
         CASE WHEN label = 7 THEN NULL WHEN label = 5 THEN embedding[1:{SUB_OLD}]
              ELSE embedding[1:{SUB_DIM}] END AS hsv_vector,
         CASE WHEN label <> 3 THEN embedding[{SUB_DIM + 1}:{2 * SUB_DIM}] END AS hog_vector
  FROM embeddings),
full_hsv AS (
  SELECT image_id, label, CASE WHEN len(hsv_vector) = {SUB_OLD}
      THEN list_concat(hsv_vector, [0 FOR i IN range({SUB_DIM - SUB_OLD})]) ELSE hsv_vector END AS hsv_vector,
    hog_vector FROM sub_vectors)"""

CATALOGUE = f"""{SCAN}, {SUB_VECTORS},
listed AS (
  SELECT f.path, CASE WHEN toxic = 1 THEN NULL WHEN quality = 0 THEN file_size - 1 ELSE file_size END AS file_size,
         mtime, hsv_vector, hog_vector
  FROM files f JOIN labels l ON f.doc_id = l.doc_id LEFT JOIN sub_vectors s ON s.image_id = f.doc_id
  UNION ALL
  SELECT '/web/' || page_id || '/RECYCLED/page.png', length(html), 0.0, NULL, NULL FROM pages),
catalogue AS (
  SELECT {SQL_ID} AS image_id, path, {SQL_NAME} AS file_name, {SQL_DIR} AS directory, file_size, mtime,
         hsv_vector, hog_vector FROM listed)"""


def odd_vectors(spark, sf) -> DataFrame:
    """Embeddings with unusable rows among them: label 9 holds NaN, label 8 is zero,
    label 6 holds infinity, label 4 is missing, label 2 is short."""
    e = F.col("embedding")

    def first(value):
        return F.concat(F.array(F.lit(float(value)).cast("float")), F.slice(e, 2, 63))

    vector = (F.when(F.col("label") == 9, first("nan"))
              .when(F.col("label") == 8, F.transform(e, lambda x: (x * 0).cast("float")))
              .when(F.col("label") == 6, first("inf"))
              .when(F.col("label") == 4, None)
              .when(F.col("label") == 2, F.slice(e, 1, 40)).otherwise(e))
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("image_id"), vector.alias("vector"))


ODD_VECTORS = """
odd_vectors AS (
  SELECT vec_id AS image_id, label,
         CASE label WHEN 9 THEN list_concat(['NaN'::FLOAT], embedding[2:64])
                    WHEN 8 THEN [0::FLOAT FOR x IN embedding]
                    WHEN 6 THEN list_concat(['Infinity'::FLOAT], embedding[2:64])
                    WHEN 4 THEN NULL
                    WHEN 2 THEN embedding[1:40] ELSE embedding END AS vector
  FROM embeddings)"""


# ---- pixels and images -----------------------------------------------------

def pixels(spark, sf) -> DataFrame:
    """One pixel per order line, one image per supplier; some suppliers' images are
    grey, some nearly black."""
    supplier = F.col("l_suppkey")
    b, g, r = (F.pmod(F.col(c), F.lit(256)) for c in ("l_partkey", "l_suppkey", "l_orderkey"))
    kind = F.pmod(supplier, F.lit(10))

    def shade(channel):
        return F.when(kind == 3, r).when(kind == 7, F.pmod(channel, F.lit(16))).otherwise(channel)

    return table(spark, sf, "lineitem").select(
        supplier.alias("image_id"), shade(b).alias("b"), shade(g).alias("g"), shade(r).alias("r"))


PIXELS = """
raw_pixels AS (
  SELECT l_suppkey AS image_id, l_suppkey % 10 AS kind,
         l_partkey % 256 AS b0, l_suppkey % 256 AS g0, l_orderkey % 256 AS r0 FROM lineitem),
pixels AS (
  SELECT image_id,
         CASE kind WHEN 3 THEN r0 WHEN 7 THEN b0 % 16 ELSE b0 END AS b,
         CASE kind WHEN 3 THEN r0 WHEN 7 THEN g0 % 16 ELSE g0 END AS g,
         CASE kind WHEN 3 THEN r0 WHEN 7 THEN r0 % 16 ELSE r0 END AS r
  FROM raw_pixels)"""


def hsv_sql(source: str, extra: str = "") -> str:
    """CTEs ``hsv`` (and helpers) with h, s, v of a pixel table."""
    return f"""
spans AS (
  SELECT *, greatest(b, g, r) AS v, greatest(b, g, r) - least(b, g, r) AS span FROM {source}),
units AS (
  SELECT *, CAST(round(1044480.0::DOUBLE / nullif(v, 0)) AS BIGINT) AS s_unit,
         CAST(round(737280.0::DOUBLE / nullif(6.0::DOUBLE * span, 0)) AS BIGINT) AS h_unit,
         CASE WHEN v = r THEN g - b WHEN v = g THEN b - r + 2 * span ELSE r - g + 4 * span END AS side
  FROM spans),
turned AS (
  SELECT *, CASE WHEN span > 0 THEN CAST(floor((side * h_unit + 2048) / 4096.0::DOUBLE) AS BIGINT) ELSE 0 END AS h0,
         CASE WHEN v > 0 THEN CAST(floor((span * s_unit + 2048) / 4096.0::DOUBLE) AS BIGINT) ELSE 0 END AS s
  FROM units),
hsv AS (
  SELECT image_id, b, g, r, CASE WHEN h0 < 0 THEN h0 + 180 ELSE h0 END AS h, s, v{extra} FROM turned)"""


SIDE = 8
SHIFTS = (0, 21, 42)  # blue, green and red planes start at these dimensions


@F.pandas_udf(T.BinaryType())
def _planes(vectors: pd.Series) -> pd.Series:
    def pack(v):
        e = np.asarray(v, dtype=np.float64)
        level = np.clip(np.floor((e + 1) * 127.5), 0, 255).astype(np.uint8)
        return np.stack([np.roll(level, -s) for s in SHIFTS], axis=1).tobytes()
    return vectors.map(pack)


def images(spark, sf) -> DataFrame:
    """One 8 x 8 colour image per embedding. The small vectors are spread over all
    tasks before the costly work on images begins."""
    parts = [F.lit("").alias("origin"), F.lit(SIDE).alias("height"), F.lit(SIDE).alias("width"),
             F.lit(3).alias("nChannels"), F.lit(16).alias("mode"), _planes("embedding").alias("data")]
    spread = table(spark, sf, "embeddings").select("vec_id", "embedding").repartition(
        spark.sparkContext.defaultParallelism, "vec_id")
    return spread.select(F.col("vec_id").alias("image_id"), F.struct(*parts).cast(IMAGE).alias("image"))


IMAGES = f"""
levels AS (
  SELECT vec_id AS image_id, generate_subscripts(embedding, 1) - 1 AS p, unnest(embedding) AS e FROM embeddings),
level AS (
  SELECT image_id, p, CAST(greatest(0, least(255, floor((e::DOUBLE + 1) * 127.5::DOUBLE))) AS BIGINT) AS x FROM levels),
image_pixels AS (
  SELECT b.image_id, b.p // {SIDE} AS y, b.p % {SIDE} AS x, b.x AS b, g.x AS g, r.x AS r
  FROM level b JOIN level g ON g.image_id = b.image_id AND g.p = (b.p + {SHIFTS[1]}) % 64
  JOIN level r ON r.image_id = b.image_id AND r.p = (b.p + {SHIFTS[2]}) % 64)"""


def png(bgr: np.ndarray) -> bytes:
    """An 8-bit RGB PNG."""
    height, width, _ = bgr.shape
    lines = b"".join(b"\0" + line.tobytes() for line in bgr[:, :, ::-1])

    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b""))


def unpng(content: bytes) -> np.ndarray:
    """BGR array of an unfiltered 8-bit RGB PNG, as ``png`` writes it: the decode function of the jobs."""
    if content[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, body = 8, b""
    while at < len(content):
        size, kind = struct.unpack(">I4s", content[at:at + 8])
        data = content[at + 8:at + 8 + size]
        if kind == b"IHDR":
            width, height = struct.unpack(">II", data[:8])
        if kind == b"IDAT":
            body += data
        at += size + 12
    lines = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, width * 3 + 1)
    return np.ascontiguousarray(lines[:, 1:].reshape(height, width, 3)[:, :, ::-1])


IMAGE_FOLDERS = ("photos", "_raw", "Trash", ".hidden", "summer 2024")


def image_folder(spark, sf, folders=IMAGE_FOLDERS) -> str:
    """The images written as PNG files into a fresh folder by label."""
    root = fresh_dir(spark, "images")
    label = _pick(folders, F.col("label"))
    rows = images(spark, sf).join(
        table(spark, sf, "embeddings").select(F.col("vec_id").alias("image_id"), label.alias("folder")),
        "image_id")

    def write(batches):
        filesystem, base = open_filesystem(root)
        for folder in folders:
            filesystem.create_dir(f"{base}/{folder}", recursive=True)
        for batch in batches:
            for row in batch.to_pylist():
                image = row["image"]
                bgr = np.frombuffer(image["data"], np.uint8).reshape(image["height"], image["width"], 3)
                target = f"{base}/{row['folder']}/{row['image_id']}.png"
                with filesystem.open_output_stream(target) as out:
                    out.write(png(bgr))
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    rows.mapInArrow(write, "n long").agg(F.sum("n")).first()
    return root


def pooled_model():
    """Stand-in model: the mean of each channel over an 8 x 8 grid of patches."""
    def predict(batch):
        n, c, h, w = batch.shape
        grid = batch.astype(np.float64).reshape(n, c, SIDE, h // SIDE, SIDE, w // SIDE)
        return grid.mean(axis=(3, 5)).reshape(n, -1)
    return predict
