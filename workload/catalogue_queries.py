"""File listing and catalogue queries."""

import io

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

from likeness.functions import paths as P
from likeness.operators import ann, catalogue as C, search, selection
from likeness.plans import jobs
from likeness.plans.jobs import Snapshots
from likeness.session import fresh_dir
from likeness.sources import files as files_source, images as images_source, vectors as vector_source
from likeness.streaming.ingest import stream_ingest
from likeness.operators.features import resized
from workload import inputs as I
from workload.registry import ctes, exploded, exploded_sql, query


def at():
    return F.col("path")


# ---- listing ---------------------------------------------------------------

@query("ext_filter", ctes(I.FILES) + f"SELECT path, {I.SQL_EXT} AS ext FROM files WHERE {I.SQL_IMAGE}")
def ext_filter(spark, sf):
    return I.files(spark, sf).where(P.has_extension(at())).select("path", P.extension(at()).alias("ext"))


@query("skip_components", ctes(I.FILES) + f"SELECT path, {I.SQL_SKIP} AS skipped FROM files")
def skip_components(spark, sf):
    return I.files(spark, sf).select("path", P.in_skipped_folder(at()).alias("skipped"))


@query("skip_hidden", ctes(I.FILES) + f"SELECT path, {I.SQL_HIDDEN} AS hidden FROM files")
def skip_hidden(spark, sf):
    return I.files(spark, sf).select("path", P.is_hidden(at(), "/data").alias("hidden"))


@query("file_stats", """
SELECT '/in/' || event_type || '/' || event_id || '.png' AS path, CAST(length(props) AS BIGINT) AS file_size,
       round(epoch_us(ts) / 1e6::DOUBLE, 6) AS mtime FROM events""")
def file_stats(spark, sf):
    """Source rows as a file stream gives them: path URI, time stamp and length."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    arrived = I.table(spark, sf, "events").select(
        F.concat(F.lit("file:/in/"), "event_type", F.lit("/"), F.col("event_id").cast("string"),
                 F.lit(".png")).alias("path"),
        F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, "ts")).alias("modificationTime"), F.length("props").cast("long").alias("length"))
    return files_source.file_state(arrived).withColumn("mtime", F.round("mtime", 6))


@query("path_parts", ctes(I.FILES)
       + f"SELECT path, {I.SQL_NAME} AS file_name, {I.SQL_DIR} AS directory FROM files")
def path_parts(spark, sf):
    return I.files(spark, sf).select("path", P.file_name(at()).alias("file_name"),
                                     P.directory(at()).alias("directory"))


@query("canonical_path", ctes(I.FILES) + "SELECT doc_id, path AS plain, path AS decoded FROM files")
def canonical_path(spark, sf):
    """Both spellings of a file URI lead to one path."""
    plain = F.concat(F.lit("file:"), at())
    coded = F.concat(F.lit("file://"), F.replace(at(), F.lit(" "), F.lit("%20")))
    return I.files(spark, sf).select("doc_id", P.canonical_path(plain).alias("plain"),
                                     P.canonical_path(coded, encoded=True).alias("decoded"))


@query("list_limit", ctes(I.FILES) + f"""
SELECT path FROM files WHERE {I.SQL_IMAGE} AND NOT {I.SQL_SKIP} AND NOT {I.SQL_HIDDEN}
ORDER BY path LIMIT 100""")
def list_limit(spark, sf):
    kept = I.files(spark, sf).where(P.has_extension(at()) & ~P.in_skipped_folder(at())
                                    & ~P.is_hidden(at(), "/data"))
    return selection.first_n(kept.select("path"), "path", 100)


@query("list_unfiltered", ctes(I.FILES) + f"SELECT path, file_size FROM files WHERE {I.SQL_IMAGE}")
def list_unfiltered(spark, sf):
    return I.files(spark, sf).where(P.has_extension(at())).select("path", "file_size")


@query("image_id_md5", ctes(I.FILES) + f"SELECT path, {I.SQL_ID} AS image_id FROM files")
def image_id_md5(spark, sf):
    return I.files(spark, sf).select("path", P.image_id_md5(at()).alias("image_id"))


@query("image_id_blake2b", ctes(I.FILES) + """
SELECT path, true AS positive, CAST(1 AS BIGINT) AS holders, true AS same FROM files""")
def image_id_blake2b(spark, sf):
    """Ids are positive, differ between all paths of the table, and depend on the path alone. (Their
    values are held against golden ones in the tests; SQL has no such digest.)"""
    ids = I.files(spark, sf).select("path", P.image_id(at()).alias("image_id"))
    again = I.files(spark, sf).repartition(3, "path").select("path", P.image_id(at()).alias("other"))
    holders = ids.groupBy("image_id").agg(F.countDistinct("path").alias("holders"))
    return ids.join(holders, "image_id").join(again, "path").select(
        "path", (F.col("image_id") > 0).alias("positive"), "holders", (F.col("image_id") == F.col("other")).alias("same"))


_FOLDER = f"{I._sql_list(I.IMAGE_FOLDERS)}[label % {len(I.IMAGE_FOLDERS)} + 1]"


@query("scan_folder", f"""
SELECT {_FOLDER} || '/' || vec_id || '.png' AS name, true AS has_size, true AS has_time FROM embeddings
WHERE {_FOLDER} NOT IN ('Trash', '.hidden')""")
def scan_folder(spark, sf):
    """Image files written from the embeddings, listed with all rules."""
    root = I.image_folder(spark, sf)
    listed = files_source.list_files(spark, root)
    return listed.select(F.substring_index("path", "/", -2).alias("name"),
                         (F.col("file_size") > 0).alias("has_size"), (F.col("mtime") > 0).alias("has_time"))


@query("decode_images", ctes(I.IMAGES) + """
SELECT image_id, 8 AS height, 8 AS width, CAST(sum(b) AS BIGINT) AS blue, CAST(sum(g) AS BIGINT) AS green,
       CAST(sum(r) AS BIGINT) AS red FROM image_pixels GROUP BY image_id""")
def decode_images(spark, sf):
    """Image files listed and decoded in their tasks by a decode function."""
    root = I.image_folder(spark, sf, ("photos", "_raw", "summer 2024"))
    listed = files_source.list_files(spark, root).select("path")
    decoded = images_source.readable(images_source.decode_files(listed, I.unpng)).select(
        F.regexp_extract("path", r"(\d+)\.png$", 1).cast("long").alias("image_id"),
        F.col("image.height").alias("height"), F.col("image.width").alias("width"), "image")
    values = resized(decoded, I.SIDE)

    def plane(channel):
        return F.aggregate(F.filter("vector", lambda _, i: i % 3 == channel), F.lit(0.0),
                           lambda acc, x: acc + x).cast("long")

    return values.select("image_id", "height", "width", plane(0).alias("blue"),
                         plane(1).alias("green"), plane(2).alias("red"))


@query("stream_ingest", f"""
SELECT CAST(vec_id AS VARCHAR) || '.png' AS file_name,
       {I._sql_list(('photos', '_raw', 'Trash', 'summer 2024'))}[label % 4 + 1] AS folder
FROM embeddings WHERE label % 4 <> 2""")
def ingest_stream(spark, sf):
    """Image files taken in by the file stream in several micro-batches."""
    root = I.image_folder(spark, sf, ("photos", "_raw", "Trash", "summer 2024"))
    snapshots = Snapshots(spark, fresh_dir(spark, "catalogue"))
    few = max(1, I.table(spark, sf, "embeddings").count() // 2)
    stream_ingest(spark, root, snapshots, fresh_dir(spark, "stream"), files_per_batch=few)
    return snapshots.read().select("file_name", F.substring_index("directory", "/", -1).alias("folder"))


@query("stream_then_batch", f"""
SELECT CAST(count(*) AS BIGINT) AS files, CAST(0 AS BIGINT) AS changed, CAST(0 AS BIGINT) AS new, CAST(0 AS BIGINT) AS gone
FROM embeddings WHERE {_FOLDER} NOT IN ('Trash', '.hidden')""")
def stream_then_batch(spark, sf):
    """An untouched folder taken in by the stream, then listed: the same files in the same state."""
    root = I.image_folder(spark, sf)
    snapshots = Snapshots(spark, fresh_dir(spark, "catalogue"))
    stream_ingest(spark, root, snapshots, fresh_dir(spark, "stream"))
    known, scan = snapshots.read(), C.describe(files_source.list_files(spark, root))
    counts = [(known, "files"), (C.changed_files(known, scan), "changed"), (C.new_files(known, scan), "new"),
              (C.missing_files(known, scan), "gone")]
    out = None
    for rows, name in counts:
        one = rows.agg(F.count(F.lit(1)).alias(name))
        out = one if out is None else out.crossJoin(one)  # one row each
    return out


@F.pandas_udf(T.BinaryType())
def _npy(vectors: pd.Series) -> pd.Series:
    def save(v):
        out = io.BytesIO()
        np.save(out, np.asarray(v, dtype=np.float32).reshape(1, -1))
        return out.getvalue()
    return vectors.map(save)


@query("npy_import", ctes(I.VECTORS) + exploded_sql("vectors", "vector", "image_id"))
def npy_import(spark, sf):
    """Per-image array files, as rows of the binary file source."""
    stored = I.vectors(spark, sf).select(
        F.concat(F.lit("/store/"), P.shard_key(F.col("image_id")), F.lit("/"),
                 F.col("image_id").cast("string"), F.lit(".npy")).alias("path"),
        _npy("vector").alias("content"))
    return exploded(vector_source.from_npy(stored), "vector", "image_id")


@F.pandas_udf(T.BinaryType())
def _blob(vectors: pd.Series) -> pd.Series:
    return vectors.map(lambda v: None if v is None else np.asarray(v, dtype="<f4").tobytes())


@query("vector_blob_import", ctes(I.SUB_VECTORS) + exploded_sql("sub_vectors", "hsv_vector", "image_id"))
def vector_blob_import(spark, sf):
    stored = I.sub_vectors(spark, sf).select("image_id", _blob("hsv_vector").alias("blob"))
    return exploded(vector_source.from_blobs(stored, "blob"), "vector", "image_id")


@query("vector_sink", ctes(I.VECTORS) + """
SELECT image_id, printf('%02d', image_id % 16) AS shard, CAST(len(vector) AS INTEGER) AS dim,
       round(list_sum(vector::DOUBLE[]), 6) + 0.0 AS total FROM vectors""")
def vector_sink(spark, sf):
    """Vectors appended in two runs; the second run adds only what is missing."""
    path = fresh_dir(spark, "features")
    schema = "image_id long, vector array<float>, shard string"
    rows = I.vectors(spark, sf)
    middle = rows.approxQuantile("image_id", [0.5], 0.01)[0]
    for part in (rows.where(F.col("image_id") <= middle), rows):
        held = vector_source.read_features(spark, path, schema)
        vector_source.append_features(C.missing_features(part, held), path, shards=16)
    total = F.aggregate(F.col("vector").cast("array<double>"), F.lit(0.0), lambda acc, x: acc + x)
    return vector_source.read_features(spark, path, schema).select(
        "image_id", "shard", F.size("vector").alias("dim"), (F.round(total, 6) + 0.0).alias("total"))


@query("vector_scan", ctes(I.CATALOGUE) + """
SELECT image_id, path, CAST(len(hog_vector) AS INTEGER) AS dim FROM catalogue WHERE hog_vector IS NOT NULL""")
def vector_scan(spark, sf):
    return search.scan_vectors(I.catalogue(spark, sf), "hog_vector").select(
        "image_id", "path", F.size("hog_vector").alias("dim"))


# ---- upsert and purge ------------------------------------------------------

_CHANGED = """coalesce(c.file_size, -1) <> coalesce(s.file_size, -1) OR coalesce(c.mtime, -1) <> coalesce(s.mtime, -1)"""
_NEW = """
fresh AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY path) AS nth FROM scan
                 WHERE path NOT IN (SELECT path FROM catalogue))
  WHERE nth = 1 AND image_id NOT IN (SELECT image_id FROM catalogue))"""


@query("insert_if_absent", ctes(I.CATALOGUE, _NEW) + """
SELECT image_id, path, file_size, mtime FROM catalogue UNION ALL SELECT image_id, path, file_size, mtime FROM fresh""")
def insert_if_absent(spark, sf):
    return C.insert_if_absent(I.catalogue(spark, sf), I.scan(spark, sf)).select(
        "image_id", "path", "file_size", "mtime")


@query("changed_files", ctes(I.CATALOGUE) + f"""
SELECT c.image_id, c.path, c.file_size, c.mtime, s.file_size AS new_size, s.mtime AS new_mtime
FROM catalogue c JOIN scan s ON s.path = c.path WHERE {_CHANGED}""")
def changed_files(spark, sf):
    return C.changed_files(I.catalogue(spark, sf), I.scan(spark, sf)).select(
        "image_id", "path", "file_size", "mtime", "new_size", "new_mtime")


@query("upsert_catalogue", ctes(I.CATALOGUE, _NEW) + f"""
SELECT c.image_id, c.path, c.file_name, c.directory,
       CASE WHEN s.path IS NOT NULL THEN s.file_size ELSE c.file_size END AS file_size,
       CASE WHEN s.path IS NOT NULL THEN s.mtime ELSE c.mtime END AS mtime,
       c.hsv_vector IS NOT NULL AND (s.path IS NULL OR NOT ({_CHANGED})) AS has_hsv,
       c.hog_vector IS NOT NULL AND (s.path IS NULL OR NOT ({_CHANGED})) AS has_hog
FROM catalogue c LEFT JOIN scan s ON s.path = c.path
UNION ALL SELECT image_id, path, file_name, directory, file_size, mtime, false, false FROM fresh""")
def upsert_catalogue(spark, sf):
    return C.upsert(I.catalogue(spark, sf), I.scan(spark, sf)).select(
        "image_id", "path", "file_name", "directory", "file_size", "mtime",
        F.col("hsv_vector").isNotNull().alias("has_hsv"), F.col("hog_vector").isNotNull().alias("has_hog"))


@query("catalogue_layers", ctes(I.CATALOGUE, _NEW) + f"""
SELECT c.image_id, c.path, c.file_name, c.directory,
       CASE WHEN s.path IS NOT NULL THEN s.file_size ELSE c.file_size END AS file_size,
       CASE WHEN s.path IS NOT NULL THEN s.mtime ELSE c.mtime END AS mtime
FROM catalogue c LEFT JOIN scan s ON s.path = c.path WHERE NOT {I.SQL_PURGE.replace("path", "c.path")}
UNION ALL SELECT image_id, path, file_name, directory, file_size, mtime FROM fresh WHERE NOT {I.SQL_PURGE}""")
def catalogue_layers(spark, sf):
    """The stored catalogue after an upsert and a purge: layers that rewrote the touched shards only, opened again."""
    path = fresh_dir(spark, "catalogue")
    snapshots = Snapshots(spark, path, shards=16)
    snapshots.append(I.catalogue(spark, sf))
    snapshots.upsert(I.scan(spark, sf))
    jobs.purge(snapshots)
    return Snapshots(spark, path).read()


@query("id_collisions", ctes(I.SCAN, """
holders AS (SELECT file_size AS image_id, max(path) AS holder FROM scan WHERE file_size % 2 = 0 GROUP BY file_size),
unknown AS (SELECT file_size AS image_id, path FROM scan WHERE path NOT IN (SELECT holder FROM holders)),
kept AS (
  SELECT u.image_id, u.path, coalesce(h.holder, min(u.path) OVER (PARTITION BY u.image_id)) AS kept_path
  FROM unknown u LEFT JOIN holders h ON h.image_id = u.image_id)""") + """
SELECT image_id, path, kept_path FROM kept WHERE path <> kept_path""")
def id_collisions(spark, sf):
    """File sizes as ids make many files claim the same one; even sizes have a holder already."""
    claims = I.scan(spark, sf).withColumn("image_id", F.col("file_size"))
    held = claims.where("file_size % 2 = 0").groupBy("image_id").agg(F.max("path").alias("path"))
    return C.id_collisions(held, claims)


@query("purge", ctes(I.CATALOGUE) + f"SELECT image_id, path FROM catalogue WHERE NOT {I.SQL_PURGE}")
def purge(spark, sf):
    return C.purge(I.catalogue(spark, sf)).select("image_id", "path")


@query("purged_rows", ctes(I.CATALOGUE) + f"SELECT image_id, path FROM catalogue WHERE {I.SQL_PURGE}")
def purged_rows(spark, sf):
    return C.purged_rows(I.catalogue(spark, sf)).select("image_id", "path")


@query("missing_files", ctes(I.CATALOGUE)
       + "SELECT image_id, path FROM catalogue WHERE path NOT IN (SELECT path FROM scan)")
def missing_files(spark, sf):
    return C.missing_files(I.catalogue(spark, sf), I.scan(spark, sf)).select("image_id", "path")


# ---- features in the catalogue ---------------------------------------------

def _new_colours(spark, sf):
    """A full set of colour vectors, keyed like the catalogue."""
    rows = I.files(spark, sf).join(I.vectors(spark, sf).withColumnRenamed("image_id", "doc_id"), "doc_id")
    return rows.select(P.image_id_md5(at()).alias("image_id"),
                       F.slice("vector", 1, I.SUB_DIM).alias("hsv_vector"))


_COLOURS = f"""
colours AS (
  SELECT {I.SQL_ID} AS image_id, vector[1:{I.SUB_DIM}] AS hsv_vector
  FROM files JOIN vectors ON vectors.image_id = files.doc_id)"""


@query("feature_writeback", ctes(I.CATALOGUE, I.VECTORS, _COLOURS) + """
SELECT c.image_id, c.path, CAST(coalesce(len(coalesce(n.hsv_vector, c.hsv_vector)), -1) AS INTEGER) AS dim
FROM catalogue c LEFT JOIN colours n ON n.image_id = c.image_id""")
def feature_writeback(spark, sf):
    written = C.write_back(I.catalogue(spark, sf), _new_colours(spark, sf), "hsv_vector")
    return written.select("image_id", "path", F.coalesce(F.size("hsv_vector"), F.lit(-1)).alias("dim"))


@query("writeback_report", ctes(I.CATALOGUE, I.VECTORS, _COLOURS) + """
SELECT CAST(count(c.image_id) AS BIGINT) AS written, CAST(count(*) - count(c.image_id) AS BIGINT) AS unmatched
FROM colours n LEFT JOIN catalogue c ON n.image_id = c.image_id""")
def writeback_report(spark, sf):
    return C.written_rows(I.catalogue(spark, sf), _new_colours(spark, sf))


@query("missing_hsv", ctes(I.CATALOGUE) + "SELECT image_id, path FROM catalogue WHERE hsv_vector IS NULL")
def missing_hsv(spark, sf):
    return C.missing_vector(I.catalogue(spark, sf), "hsv_vector").select("image_id", "path")


@query("missing_embeddings", ctes(I.CATALOGUE) + f"""
SELECT image_id, path FROM scan s WHERE NOT EXISTS (
  SELECT 1 FROM catalogue f WHERE f.hog_vector IS NOT NULL AND f.image_id = s.image_id
  AND coalesce(f.file_size, -1) = coalesce(s.file_size, -1) AND coalesce(f.mtime, -1) = coalesce(s.mtime, -1))""")
def missing_embeddings(spark, sf):
    """Files without a vector made from their present state."""
    held = I.catalogue(spark, sf).where(F.col("hog_vector").isNotNull()).select(
        "image_id", "file_size", "mtime", F.col("hog_vector").alias("vector"))
    return C.missing_features(I.scan(spark, sf), held).select("image_id", "path")


@query("keyset_pages", ctes(I.SCAN) + """
SELECT image_id, path, CAST((row_number() OVER (ORDER BY image_id) - 1) // 64 AS BIGINT) AS page FROM scan""")
def keyset_pages(spark, sf):
    return selection.paginate(I.scan(spark, sf).select("image_id", "path"), "image_id", 64)


@query("work_limit", ctes(I.CATALOGUE) + """
SELECT image_id, path FROM catalogue WHERE hsv_vector IS NULL ORDER BY image_id LIMIT 50""")
def work_limit(spark, sf):
    return C.missing_vector(I.catalogue(spark, sf), "hsv_vector", limit=50).select("image_id", "path")


@query("coverage_stats", ctes(I.CATALOGUE) + """
SELECT 'hsv_vector' AS feature, CAST(count(hsv_vector) AS BIGINT) AS rows,
       coalesce(max(image_id) FILTER (hsv_vector IS NOT NULL), 0) AS max_id FROM catalogue
UNION ALL
SELECT 'hog_vector', CAST(count(hog_vector) AS BIGINT),
       coalesce(max(image_id) FILTER (hog_vector IS NOT NULL), 0) FROM catalogue""")
def coverage_stats(spark, sf):
    return C.coverage(I.catalogue(spark, sf))


@query("fingerprint", ctes(I.CATALOGUE) + """
SELECT substr(sha1(count(hsv_vector) || '-' || coalesce(max(image_id) FILTER (hsv_vector IS NOT NULL), 0)
              || '-176-hsv'), 1, 12) AS name FROM catalogue""")
def fingerprint(spark, sf):
    line = C.coverage(I.catalogue(spark, sf), ["hsv_vector"])
    return line.select(ann.fingerprint(F.col("rows"), F.col("max_id"), 176).alias("name"))


@query("shard_key", ctes(I.SCAN) + """
SELECT image_id, printf('%04d', image_id % 1024) AS shard, '' AS unsharded FROM scan""")
def shard_key(spark, sf):
    return I.scan(spark, sf).select("image_id", P.shard_key(F.col("image_id")).alias("shard"),
                                    P.shard_key(F.col("image_id"), 0).alias("unsharded"))


@query("add_column", ctes(I.SCAN)
       + "SELECT image_id, path, CAST(NULL AS VARCHAR) AS note, file_size FROM scan")
def add_column(spark, sf):
    rows = I.scan(spark, sf).select("image_id", "path", "file_size")
    return C.add_column(C.add_column(rows, "note", "string"), "file_size", "string")


@query("job_report", ctes(I.SUB_VECTORS) + """
SELECT CAST(count(hsv_vector) AS BIGINT) AS ok, CAST(count(*) - count(hsv_vector) AS BIGINT) AS failed,
       CAST(count(*) AS BIGINT) AS processed FROM sub_vectors""")
def job_report(spark, sf):
    return C.job_report(I.sub_vectors(spark, sf), "hsv_vector")
