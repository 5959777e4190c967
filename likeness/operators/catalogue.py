"""The catalogue of image files: upsert, write-back, purge, reports.

All operators map DataFrames to DataFrames. Features are best kept in tables of
their own next to the narrow catalogue (see ``schemas.FEATURES``); catalogues that
carry vectors as columns work as well, every extra column travels along.
"""

from pyspark.sql import Column, DataFrame, functions as F

from likeness.functions import paths as P
from likeness.operators.joins import lookup
from likeness.operators.selection import first_n
from likeness.session import broadcast_if_small, materialise, reduce_to

SCAN_COLUMNS = ("image_id", "path", "file_name", "directory", "file_size", "mtime")


def describe(listing: DataFrame, image_id=P.image_id) -> DataFrame:
    """Catalogue rows of listed files: ``path, file_size, mtime`` in."""
    path = F.col("path")
    return listing.select(image_id(path).alias("image_id"), path, P.file_name(path).alias("file_name"),
                          P.directory(path).alias("directory"), "file_size", "mtime")


def one_per_path(scan: DataFrame) -> DataFrame:
    """A scan that lists a path twice keeps its latest state."""
    state = [c for c in SCAN_COLUMNS if c != "path"]
    newest = F.max(F.struct(F.coalesce("mtime", F.lit(-1.0)), F.coalesce("file_size", F.lit(-1)),
                            F.struct(*state).alias("state"))).alias("newest")
    return scan.groupBy("path").agg(newest).select(
        "path", *[F.col("newest.state")[c].alias(c) for c in state]).select(*SCAN_COLUMNS)


def differs(old_size: Column, new_size: Column, old_time: Column, new_time: Column) -> Column:
    """Size or time differ; a missing value counts as -1."""
    return ((F.coalesce(old_size, F.lit(-1)) != F.coalesce(new_size, F.lit(-1)))
            | (F.coalesce(old_time, F.lit(-1.0)) != F.coalesce(new_time, F.lit(-1.0))))


def new_files(catalogue: DataFrame, scan: DataFrame) -> DataFrame:
    """Scan rows to insert: path and id both unknown; of several new files with one
    id the lowest path. The choice is an aggregate, so many claims to one id are
    reduced before they are shuffled. A small scan never shuffles the catalogue."""
    known = reduce_to(catalogue.select("path"), scan, "path")
    unknown = one_per_path(scan).join(known, "path", "left_anti")
    rest = [c for c in SCAN_COLUMNS if c not in ("image_id", "path")]
    firsts = (unknown.groupBy("image_id")
              .agg(F.min_by(F.struct("path", *rest), "path").alias("first"))
              .select("image_id", "first.*"))
    taken = reduce_to(catalogue.select("image_id"), scan, "image_id", 64)
    return firsts.join(taken, "image_id", "left_anti").select(*SCAN_COLUMNS)


def insert_if_absent(catalogue: DataFrame, scan: DataFrame) -> DataFrame:
    """Catalogue plus the new files; neither path nor id may repeat."""
    return catalogue.unionByName(new_files(catalogue, scan), allowMissingColumns=True)


def id_collisions(catalogue: DataFrame, scan: DataFrame) -> DataFrame:
    """``image_id, path, kept_path``: new files left out because their id is taken."""
    unknown = (one_per_path(scan).select("image_id", "path")
               .join(catalogue.select("path"), "path", "left_anti"))
    claims = unknown.groupBy("image_id").agg(F.min("path").alias("first"),
                                             F.count(F.lit(1)).alias("claims"))
    holders = catalogue.select("image_id", F.col("path").alias("holder"))
    contested = (claims.join(holders, "image_id", "left")
                 .where(F.col("holder").isNotNull() | (F.col("claims") > 1))
                 .select("image_id", F.coalesce("holder", "first").alias("kept_path")))
    return (lookup(unknown, contested, "image_id", spread="path")
            .where(F.col("path") != F.col("kept_path")).select("image_id", "path", "kept_path"))


def changed_files(catalogue: DataFrame, scan: DataFrame) -> DataFrame:
    """Known paths whose size or time changed, with old and new values."""
    new = one_per_path(scan).select(
        "path", F.col("file_size").alias("new_size"), F.col("mtime").alias("new_mtime"))
    known = reduce_to(catalogue.select("image_id", "path", "file_size", "mtime"), scan, "path")
    return (known.join(new, "path")
            .where(differs(F.col("file_size"), F.col("new_size"), F.col("mtime"), F.col("new_mtime"))))


def refreshed(catalogue: DataFrame, scan: DataFrame, features=("hsv_vector", "hog_vector")) -> DataFrame:
    """The catalogue with the state of changed files, whose feature columns become NULL; every row stays."""
    held = [c for c in features if c in catalogue.columns]
    metadata = ["file_name", "directory", "file_size", "mtime"]
    new = one_per_path(scan).select("path", F.lit(True).alias("_seen"),
                                    *[F.col(c).alias(f"_{c}") for c in metadata])
    changed = F.coalesce(F.col("_seen") & differs(
        F.col("file_size"), F.col("_file_size"), F.col("mtime"), F.col("_mtime")), F.lit(False))
    updates = {c: F.when(changed, F.col(f"_{c}")).otherwise(F.col(c)) for c in metadata}
    updates |= {c: F.when(~changed, F.col(c)) for c in held}
    return catalogue.join(new, "path", "left").select(
        *[updates[c].alias(c) if c in updates else F.col(c) for c in catalogue.columns])


def upsert(catalogue: DataFrame, scan: DataFrame, features=("hsv_vector", "hog_vector")) -> DataFrame:
    """Insert new files and refresh changed ones, whose feature columns become
    NULL. Unchanged rows and rows of vanished files stay as they are."""
    return refreshed(catalogue, scan, features).unionByName(new_files(catalogue, scan), allowMissingColumns=True)


def missing_files(catalogue: DataFrame, scan: DataFrame) -> DataFrame:
    """Catalogue rows whose file the scan no longer lists; they stay catalogued."""
    return catalogue.join(scan.select("path").distinct(), "path", "left_anti")


def write_back(catalogue: DataFrame, features: DataFrame, column: str, key: str = "image_id") -> DataFrame:
    """Set one vector column from ``(key, column)``; rows without a new value keep
    the old one, keys the catalogue does not hold change nothing."""
    new = features.select(key, F.col(column).alias("_new"))
    return (catalogue.join(new, key, "left")
            .select(*[F.coalesce("_new", column).alias(c) if c == column else F.col(c)
                      for c in catalogue.columns]))


def written_rows(catalogue: DataFrame, features: DataFrame, key: str = "image_id") -> DataFrame:
    """``written, unmatched``: how many feature rows met a catalogue row."""
    known = catalogue.select(key, F.lit(1).alias("_known"))
    return features.select(key).join(known, key, "left").agg(
        F.count("_known").alias("written"),
        F.count_if(F.col("_known").isNull()).alias("unmatched"))


def purge(catalogue: DataFrame, marks=P.PURGE_MARKS) -> DataFrame:
    """Catalogue without rows whose path contains a mark."""
    return catalogue.where(~P.has_purge_mark(F.col("path"), marks))


def purged_rows(catalogue: DataFrame, marks=P.PURGE_MARKS) -> DataFrame:
    return catalogue.where(P.has_purge_mark(F.col("path"), marks))


def missing_vector(catalogue: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Rows whose vector column is still empty, in id order up to ``limit``."""
    return first_n(catalogue.where(F.col(column).isNull()), "image_id", limit)


def missing_features(catalogue: DataFrame, features: DataFrame, limit: int | None = None) -> DataFrame:
    """Catalogue rows without a feature row made from the present file state."""
    stamped = {"file_size", "mtime"} <= set(features.columns)
    same = F.col("c.image_id") == F.col("f.image_id")
    if stamped:
        same = same & ~differs(F.col("c.file_size"), F.col("f.file_size"),
                               F.col("c.mtime"), F.col("f.mtime"))
    keys = ["image_id"] + (["file_size", "mtime"] if stamped else [])
    left = catalogue.alias("c").join(features.select(*keys).alias("f"), same, "left_anti")
    return first_n(left, "image_id", limit)


def fetch(catalogue: DataFrame, ids: DataFrame, *columns: str) -> DataFrame:
    """The catalogue rows of an id set."""
    wanted = broadcast_if_small(materialise(ids.select("image_id").distinct(), "ids"), 64)
    return catalogue.join(wanted, "image_id", "left_semi").select("image_id", *columns)


def coverage(catalogue: DataFrame, columns=("hsv_vector", "hog_vector")) -> DataFrame:
    """``feature, rows, max_id`` per vector column, in one pass."""
    values = []
    for c in columns:
        has = F.col(c).isNotNull()
        values += [F.count_if(has).alias(f"n_{c}"),
                   F.coalesce(F.max(F.when(has, F.col("image_id"))), F.lit(0)).alias(f"m_{c}")]
    lines = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"n_{c}").alias("rows"),
                                         F.col(f"m_{c}").alias("max_id")) for c in columns]))
    return catalogue.agg(*values).select(lines.alias("line")).select("line.*")


def add_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    """Add an empty column unless there is one of that name."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def job_report(results: DataFrame, column: str = "vector") -> DataFrame:
    """``ok, failed, processed`` of a feature job's output."""
    done = F.col(column).isNotNull()
    return results.agg(F.count_if(done).alias("ok"), F.count_if(~done).alias("failed"),
                       F.count(F.lit(1)).alias("processed"))
