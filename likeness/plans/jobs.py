"""Whole jobs as a user calls them: ingest a folder, purge, compute features."""

import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from likeness.functions import paths as P
from likeness.operators import catalogue as C
from likeness.operators import features as X
from likeness.schemas import CATALOGUE, FEATURES
from likeness.session import materialise, open_filesystem
from likeness.sources.commits import CommitLog, Conflict
from likeness.sources.files import list_files
from likeness.sources.images import library_decode
from likeness.sources.vectors import by_shard, files_per_shard, read_features

# A shard of more layers than this is rewritten as one.
MOST_LAYERS = 8


class Snapshots:
    """A catalogue in shards of its paths, as layers below one folder.

    A layer holds rows of some shards and is never changed. A commit record names the layers
    that make up each shard (``sources.commits``); readers merge them. New rows are a layer
    more, changed ones rewrite their shards only, and a shard of too many layers is made one
    again. Every writer, appending ones too, gets a ``Conflict`` when another committed since
    it read: refresh and repeat. ``vacuum`` deletes what no recent record names.
    """

    def __init__(self, spark: SparkSession, path: str, schema=CATALOGUE, shards: int = 64):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.log, self.default_shards = CommitLog(self.path), shards
        self.refresh()

    def refresh(self) -> None:
        self.latest, self.record = self.log.latest()
        self.record = self.record or {"shards": self.default_shards, "layers": {}}

    def shard(self):
        """The shard of a row, as a column."""
        return F.pmod(F.xxhash64("path"), F.lit(self.record["shards"])).cast("int")

    def read(self, shards=None) -> DataFrame:
        """All rows, or those of the given shards."""
        wanted = None if shards is None else set(map(str, shards))
        folders = [f"{self.path}/{layer}/shard={shard}" for shard, layers in self.record["layers"].items()
                   if wanted is None or shard in wanted for layer in layers]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def put(self, rows: DataFrame, replaced=()) -> None:
        """Commit ``rows`` as a layer: in the ``replaced`` shards they are all rows from now on, in
        others they are added. Nothing is committed where nothing changes."""
        if self.log.latest()[0] != self.latest:
            raise Conflict(f"commit {self.latest} of {self.path} is no longer the latest")
        layer, replaced = f"layer-{uuid.uuid4().hex}", set(map(str, replaced))
        (rows.select(*self.schema.names).withColumn("shard", self.shard()).repartition("shard")
         .write.partitionBy("shard").parquet(f"{self.path}/{layer}"))
        filesystem, inner = open_filesystem(f"{self.path}/{layer}")
        written = {f.base_name.removeprefix("shard=") for f in filesystem.get_file_info(pafs.FileSelector(inner))
                   if f.base_name.startswith("shard=")}
        held = self.record["layers"]
        layers = {s: l for s, l in held.items() if s not in replaced}
        layers |= {s: [*layers.get(s, []), layer] for s in written}
        if layers == held:
            return
        record = self.record | {"layers": layers}
        self.latest, self.record = self.log.commit(self.latest, record), record
        deep = [s for s, l in layers.items() if len(l) > MOST_LAYERS]
        if deep:
            try:
                self.put(self.read(deep), deep)
            except Conflict:
                self.refresh()  # another writer came first; a later one will do it

    def write(self, table: DataFrame) -> None:
        """Make ``table`` the whole catalogue."""
        self.put(table, range(self.record["shards"]))

    def append(self, rows: DataFrame) -> None:
        """Add rows; nothing already there is rewritten."""
        self.put(rows)

    def upsert(self, scan: DataFrame) -> None:
        """Insert new files and refresh changed ones; only shards that hold a changed file are rewritten."""
        known = self.read()
        changed = materialise(C.changed_files(known, scan).select(self.shard().alias("shard")).distinct(), "changed")
        new, shards = C.new_files(known, scan), [row.shard for row in changed.collect()]  # a number a shard
        if shards:
            mine = scan.where(self.shard().isin(shards))
            new = C.refreshed(self.read(shards), mine).unionByName(new, allowMissingColumns=True)
        self.put(new, shards)

    def vacuum(self, keep: int = 2) -> int:
        """Delete the layers that none of the last ``keep`` commits names; returns how many. Not to be run
        beside a writer whose layer is not committed yet."""
        named = {layer for number in self.log.numbers()[-keep:] for layers in self.log.record(number)["layers"].values() for layer in layers}
        filesystem, inner = open_filesystem(self.path)
        old = [f.path for f in filesystem.get_file_info(pafs.FileSelector(inner, allow_not_found=True))
               if f.base_name.startswith("layer-") and f.base_name not in named]
        for folder in old:
            filesystem.delete_dir(folder)
        return len(old)


def repeated(snapshots: Snapshots, work, attempts: int = 3) -> None:
    """Run ``work()`` on the catalogue; when another job wrote it meanwhile, again on what it wrote."""
    for left in reversed(range(attempts)):
        try:
            return work()
        except Conflict:
            if not left:
                raise
            snapshots.refresh()


def ingest(spark: SparkSession, folder: str, snapshots: Snapshots, *, limit: int | None = None,
           extensions=P.IMAGE_EXTENSIONS, skip=P.SKIP_NAMES, hidden: bool = False, attempts: int = 3) -> int:
    """List a folder and upsert it into the catalogue; returns the files listed. When
    another job wrote the catalogue meanwhile, the upsert is repeated on what it wrote."""
    # ids are computed once, however many branches of the upsert read the scan
    scan = materialise(C.describe(list_files(spark, folder, extensions=extensions, skip=skip,
                                             hidden=hidden, limit=limit)), "scan")
    repeated(snapshots, lambda: snapshots.upsert(scan), attempts)
    return scan.count()


def purge(snapshots: Snapshots, marks=P.PURGE_MARKS) -> int:
    """Drop rows whose path holds a mark; returns how many."""
    known = snapshots.read()
    gone = C.purged_rows(known, marks)
    shards = materialise(gone.groupBy(snapshots.shard().alias("shard")).agg(F.count(F.lit(1)).alias("n")), "gone").collect()
    if shards:  # a row a shard; the others stay as they are
        touched = [row.shard for row in shards]
        snapshots.put(C.purge(snapshots.read(touched), marks), touched)
    return sum(row.n for row in shards)


def compute_features(catalogue: DataFrame, path: str, extractor: X.Extractor, *, decode=library_decode,
                     limit: int | None = None, shards: int = 64, step: int = X.STEP) -> dict:
    """Compute a feature for every catalogued image that lacks it or whose file has
    changed, and append it to the feature table at ``path``, in one job.

    ``decode`` turns a file's bytes into a BGR array; by default the imaging library of
    the executors does. Each file is read in the task that writes its vector: the narrow
    rows are dealt to the output files beforehand, and their number follows from rows and
    vector length. Returns ``ok, failed, processed`` and ``errors``, the classes of the
    errors met. Rows of older file states stay in the table; ``current_features`` leaves
    them out.
    """
    spark = catalogue.sparkSession
    held = read_features(spark, path, FEATURES)
    todo = materialise(C.missing_features(catalogue, held, limit).select(
        "image_id", "path", "file_size", "mtime"), "todo")
    files = files_per_shard(todo.count(), extractor.dim, shards)
    done = X.extract_files(by_shard(todo, shards, files), {"vector": extractor}, decode, step)
    seen, good = Observation("feature job"), F.col("vector").isNotNull()
    done = done.observe(seen, F.count_if(good).alias("ok"), F.count_if(~good).alias("failed"),
                        F.count(F.lit(1)).alias("processed"),
                        F.sort_array(F.collect_set("error")).alias("errors"))
    done.where(good).select(*FEATURES.names, "shard").write.partitionBy("shard").mode("append").parquet(path)
    return dict(seen.get)


def current_features(catalogue: DataFrame, features: DataFrame, name: str) -> DataFrame:
    """``image_id, <name>`` made from the catalogued file states. A job appends only what is
    missing, so ids are unique unless two jobs ran at once; only then vectors are shuffled."""
    same = ((F.col("f.image_id") == F.col("c.image_id"))
            & ~C.differs(F.col("c.file_size"), F.col("f.file_size"), F.col("c.mtime"), F.col("f.mtime")))
    current = features.alias("f").join(catalogue.alias("c"), same, "left_semi")
    if not current.groupBy("image_id").count().where(F.col("count") > 1).isEmpty():
        current = current.dropDuplicates(["image_id"])
    return current.select("image_id", F.col("vector").alias(name))


def compute_hsv(catalogue, path, **options):
    return compute_features(catalogue, path, X.hsv_extractor(), **options)


def compute_hog(catalogue, path, **options):
    return compute_features(catalogue, path, X.hog_extractor(), **options)


def compute_signatures(catalogue, path, **options):
    return compute_features(catalogue, path, X.signature_extractor(), **options)


def compute_embeddings(catalogue, path, make_predict_fn, batch_size=64, **options):
    return compute_features(catalogue, path, X.model_extractor(make_predict_fn),
                            step=batch_size, **options)
