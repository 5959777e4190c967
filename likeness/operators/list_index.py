"""Inverted lists around k-means centres that are stored once and then grow.

* Centres form one level or two. With two, a vector descends: to the nearest of some
  hundred cells, and to the nearest list of that cell. No more than the top level and one
  cell's centres must fit a task, so the number of lists has no limit.
* Lists are written as blocks of vectors, bucketed by list and part, in folders by group of
  lists. A search joins its probes to them without shuffling a vector, and reads the groups it
  probes only. Where queries and their probes would outweigh the index, tasks with a block of queries
  read its files instead. A list with many vectors is many parts, in as many buckets.
* New vectors become a layer beside the base, removed ones a table of ids; a commit record
  names what counts (``sources.commits``). The record also holds a mark of the content, a sum of row
  hashes that an update moves by the rows it adds and removes. ``compact`` makes one layer of all.
"""

from __future__ import annotations

import math
import re
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from likeness.functions import vectors as V
from likeness.functions.blocks import BestK, load_units, thin_copies
from likeness.operators.nearest import MOST_BLOCK_ROWS, QUERY_BYTES, RANKED, asked_units, best, block_rows, common_dim, nearest, query_parts, ranked, scanned
from likeness.operators.selection import first_n, sample_hash, uniform_sample
from likeness.schemas import HITS
from likeness.session import BROADCAST_BYTES, broadcast_if_small, materialise
from likeness.sources.bucketed import read_bucketed, write_bucketed
from likeness.sources.commits import CommitLog
from likeness.sources.stored import Stored, folder, key_blocks

# Bytes of vectors of one block, of one part of a list, of one bucket, about.
BLOCK_BYTES, PART_BYTES, BUCKET_BYTES = 1 << 20, 256 << 20, 256 << 20
# A list's number is its cell's times this, plus its place in the cell.
CELL_LISTS = 1 << 16
# Sampled vectors that train one list, and bytes of the sample of one cell.
TRAIN_ROWS, CELL_BYTES = 64, 256 << 20
# Queries that meet a block at a time; rows a task gathers before it cuts them to k a query.
ASK_ROWS, HELD_HITS = 256, 1 << 20
# Rows of the index that blocks of queries may read for each (query, list) that would travel instead.
READ_ROWS = 64
# More removed rows than this are compacted away; more layers too.
MOST_REMOVED, MOST_LAYERS = 1 << 20, 16

BLOCKS = "list_id bigint, part int, ids array<bigint>, marks array<bigint>, vectors binary, list_group int"
CENTRES = "cell int, list_id bigint, centre array<double>"


@dataclass
class ListIndex:
    """``tops``: the cells' centres, a row each (None with one level); ``centres``: those of the
    lists where they fit a broadcast, else None; ``record`` as committed under ``number``."""
    spark: SparkSession
    path: str
    number: int
    record: dict
    tops: np.ndarray | None
    list_ids: np.ndarray | None
    centres: np.ndarray | None
    cells: np.ndarray | None = field(default=None)

    @property
    def dim(self) -> int:
        return self.record["dim"]

    @property
    def nlist(self) -> int:
        return self.record["lists"]

    @property
    def layers(self) -> list[DataFrame]:
        return [read_bucketed(self.spark, f"{self.path}/{layer['name']}", BLOCKS, ["list_id", "part"], self.record["buckets"],
                              partition="list_group") for layer in self.record["layers"]]

    @property
    def centre_table(self) -> DataFrame:
        return self.spark.read.schema(CENTRES).parquet(f"{self.path}/centres")

    def gone(self, layer: int) -> np.ndarray:
        """Sorted ids of rows of a layer that later commits removed; at most MOST_REMOVED."""
        names = [r["name"] for r in self.record["removed"] if layer < r["before"]]
        if not names:
            return np.zeros(0, np.int64)
        ids = self.spark.read.parquet(*[f"{self.path}/{name}" for name in names])
        return np.unique(ids.select("image_id").toArrow()["image_id"].to_numpy())

    @property
    def lists(self) -> DataFrame:
        """``list_id, image_id, mark, vector`` of every row that counts."""
        dim, made = self.dim, None
        for k, layer in enumerate(self.layers):
            gone = self.spark.sparkContext.broadcast(self.gone(k))

            def run(batches, gone=gone):
                for batch in batches:
                    for row in range(batch.num_rows):
                        ids, marks = (batch.column(c)[row].values for c in ("ids", "marks"))
                        flat = np.frombuffer(batch.column("vectors")[row].as_py(), np.float32).reshape(len(ids), dim)
                        kept = np.flatnonzero(~_among(ids.to_numpy(), gone.value))
                        ends = pa.array(np.arange(len(kept) + 1, dtype=np.int32) * dim)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(kept), batch.column("list_id")[row].as_py())), ids.take(pa.array(kept)),
                             marks.take(pa.array(kept)), pa.ListArray.from_arrays(ends, pa.array(flat[kept].ravel()))],
                            names=["list_id", "image_id", "mark", "vector"])

            rows = layer.mapInArrow(run, "list_id bigint, image_id bigint, mark bigint, vector array<float>")
            made = rows if made is None else made.union(rows)
        return made


def _among(ids: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which ``ids`` are among the sorted ``some``."""
    if not len(some):
        return np.zeros(len(ids), bool)
    return some[np.minimum(np.searchsorted(some, ids), len(some) - 1)] == ids


def row_mark(vectors: DataFrame):
    """The hash of a row: of the file state it was made from where the table says so, else of the vector."""
    stamped = {"file_size", "mtime"} <= set(vectors.columns)
    return F.xxhash64(*(["image_id", "file_size", "mtime"] if stamped else ["image_id", "vector"]))


# ---- centres ---------------------------------------------------------------

def train_centres(vectors, dim, nlist, sample_size, seed, iterations):
    """(centres, share of the sample nearest to each). Unusable rows are left out before the
    sample is drawn, so it is full whenever enough usable vectors exist."""
    usable = vectors.where((F.size("vector") == dim) & V.is_usable(F.col("vector")))
    sample = uniform_sample(usable, "image_id", sample_size, seed)
    # A fixed order makes the training repeatable.
    tasks = vectors.sparkSession.sparkContext.defaultParallelism
    training = (sample.repartition(tasks, "image_id").sortWithinPartitions("image_id")
                .select(array_to_vector(V.unit_or_null(F.col("vector"))).alias("features")))
    training.persist()
    try:
        trained_on = training.count()
        if trained_on == 0:
            raise ValueError("no usable vectors to index")
        if trained_on == 1:
            return training.first().features.toArray()[None], np.ones(1)
        model = KMeans(k=max(2, min(nlist, trained_on)), seed=seed, maxIter=iterations,
                       distanceMeasure="cosine").fit(training)
        centres = np.array(model.clusterCenters())
        sizes = np.ones(len(centres))
        for row in model.transform(training).groupBy("prediction").count().toLocalIterator():
            sizes[row.prediction] = row["count"]
    finally:
        training.unpersist()
    return _unit(centres), sizes / trained_on


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1.0)


def _k_means(units: np.ndarray, k: int, iterations: int) -> np.ndarray:
    """Centres of unit rows by direction, at most k; the first ones are spread over the given order."""
    centres = units[np.unique(np.linspace(0, len(units) - 1, min(k, len(units))).astype(int))]
    for _ in range(iterations):
        own = np.argmax(units @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, units)
        held = np.bincount(own, minlength=len(centres)) > 0
        centres = np.where(held[:, None], _unit(sums), centres)
    return centres


def train_cells(vectors: DataFrame, dim: int, tops: np.ndarray, shares: np.ndarray, nlist: int, sample_size: int,
                seed: int, iterations: int) -> DataFrame:
    """``cell, list_id, centre``: the lists of every cell, as many as its share of the vectors asks for, each
    cell trained by one task on a sample of its own of at most CELL_BYTES."""
    spark = vectors.sparkSession
    wanted = np.clip(np.rint(shares * nlist), 1, CELL_LISTS).astype(np.int64)
    shared = spark.sparkContext.broadcast((tops, wanted))
    sample = uniform_sample(vectors, "image_id", max(sample_size, TRAIN_ROWS * nlist), seed)

    def nearest_cell(batches):
        tops, _ = shared.value
        for batch in batches:
            units, rows = load_units(batch.column("vector"), dim, False)
            if len(rows):
                kept = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(np.argmax(units @ tops.T, axis=1).astype(np.int32))],
                                                 names=["image_id", "vector", "cell"])

    placed = sample.select("image_id", "vector").mapInArrow(nearest_cell, "image_id long, vector array<float>, cell int")
    order = Window.partitionBy("cell").orderBy(sample_hash(F.col("image_id"), seed + 1), "image_id")
    most = max(1, CELL_BYTES // (8 * dim))
    chosen = placed.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most)

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by("nth")
        cell = table["cell"][0].as_py()
        units, _ = load_units(table["vector"], dim, False)
        centres = _k_means(units, int(shared.value[1][cell]), iterations)
        return pa.table({"cell": pa.array([cell] * len(centres), pa.int32()),
                         "list_id": pa.array(np.arange(len(centres), dtype=np.int64) + cell * CELL_LISTS),
                         "centre": pa.array(centres.tolist(), pa.list_(pa.float64()))})

    return chosen.groupBy("cell").applyInArrow(train, CENTRES)


def nearest_lists(index: ListIndex, rows: DataFrame, id_column: str, lists: int, cells: int, keep: list[str]) -> DataFrame:
    """``<id>, keep..., list_id, list_group``: of each usable row its ``lists`` nearest lists in its ``cells`` nearest cells.

    Where not all centres fit a broadcast, rows meet the centres of their cells in a grouped
    join; a cell with many rows is cut into parts.
    """
    spark, dim, kinds = rows.sparkSession, index.dim, dict(rows.dtypes)
    columns = [id_column, *keep]
    told = ", ".join(f"{c} {kinds[c]}" for c in columns)
    groups = index.record["group_lists"]

    def pick(columns, units, list_ids, centres, n):
        scores = units @ centres.T
        chosen = np.argsort(-scores, axis=1, kind="stable")[:, :n]
        at = pa.array(np.repeat(np.arange(len(units)), chosen.shape[1]))
        return [*[c.take(at) for c in columns], pa.array(list_ids[chosen.ravel()]),
                pa.array(np.take_along_axis(scores, chosen, 1).ravel())]

    names = [*columns, "list_id", "near"]
    if index.centres is not None:
        shared = spark.sparkContext.broadcast((index.tops, index.cells, index.list_ids, index.centres))

        def run(batches):
            tops, cell_of, list_ids, centres = shared.value
            for batch in batches:
                units, kept = load_units(batch.column("vector"), dim, False)
                if not len(kept):
                    continue
                some = [batch.column(c).take(pa.array(kept)) for c in columns]
                if tops is None:
                    yield pa.RecordBatch.from_arrays(pick(some, units, list_ids, centres, lists), names=names)
                    continue
                near = np.argsort(-(units @ tops.T), axis=1, kind="stable")[:, :cells]
                for cell in np.unique(near):
                    mine, at = np.flatnonzero((near == cell).any(axis=1)), np.flatnonzero(cell_of == cell)
                    if len(at):
                        yield pa.RecordBatch.from_arrays(pick([c.take(pa.array(mine)) for c in some], units[mine], list_ids[at],
                                                              centres[at], lists), names=names)

        found = rows.select(*dict.fromkeys([*columns, "vector"])).mapInArrow(run, f"{told}, list_id bigint, near double")
    else:
        top = spark.sparkContext.broadcast(index.tops)

        def descend(batches):
            for batch in batches:
                units, kept = load_units(batch.column("vector"), dim, False)
                if len(kept):
                    near = np.argsort(-(units @ top.value.T), axis=1, kind="stable")[:, :cells]
                    at = pa.array(np.repeat(kept, near.shape[1]))
                    yield pa.RecordBatch.from_arrays([*[c.take(at) for c in batch.columns], pa.array(near.ravel().astype(np.int32))],
                                                     names=[*batch.schema.names, "cell"])

        source = rows.select(*dict.fromkeys([*columns, "vector"]))
        source_told = ", ".join(f"{c} {kinds[c]}" for c in source.columns)
        placed = source.mapInArrow(descend, f"{source_told}, cell int")
        parts = max(1, -(-rows.count() * 4 * dim * cells // PART_BYTES))  # of the fullest cell, were it the only one
        placed = placed.withColumn("cut", F.pmod(F.xxhash64(id_column), F.lit(parts)))
        centres = index.centre_table.withColumn("cut", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))))

        def choose(mine: pa.Table, centres: pa.Table) -> pa.Table:
            units, kept = load_units(mine["vector"], dim, False)
            some = [mine[c].combine_chunks().take(pa.array(kept)) for c in columns]
            matrix, at = load_units(centres["centre"], dim, True)
            made = pick(some, units, centres["list_id"].to_numpy()[at], matrix, lists)
            return pa.table(made, names=names)

        found = placed.groupBy("cell", "cut").cogroup(centres.groupBy("cell", "cut")).applyInArrow(
            choose, f"{told}, list_id bigint, near double")
    if index.tops is not None and cells > 1:
        order = Window.partitionBy(id_column).orderBy(F.desc("near"), F.asc("list_id"))
        found = found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= lists).drop("nth")
    return found.drop("near").withColumn("list_group", F.floor(F.col("list_id") / groups).cast("int"))


# ---- building --------------------------------------------------------------

def build_lists(vectors: DataFrame, path: str, *, nlist: int = 4096, sample_size: int = 200_000, dim: int | None = None,
                seed: int = 42, iterations: int = 10, limit: int | None = None, centres: np.ndarray | None = None,
                cells: np.ndarray | None = None, levels: int | None = None) -> ListIndex:
    """Train the centres on uniform samples of the usable vectors, assign every usable vector and
    write the lists below ``path``.

    vectors: ``image_id, vector``. One level up to as many centres as fit a broadcast, two beyond
    (or as ``levels`` says). Given ``centres`` (directions) are taken as they are: of one level, or, with
    ``cells`` (directions of the cells), the lists of the nearest cell. Raises ValueError when no vector is usable.
    """
    spark = vectors.sparkSession
    stamps = [c for c in ("file_size", "mtime") if c in vectors.columns]
    vectors = first_n(vectors, "image_id", limit).select("image_id", "vector", *stamps)
    dim = dim or common_dim(vectors)
    if dim is None:
        raise ValueError("no vectors to index")
    if centres is not None:
        centres = _unit(np.asarray(centres, np.float64))
        tops = None if cells is None else _unit(np.asarray(cells, np.float64))
        of = np.zeros(len(centres), np.int64) if tops is None else np.argmax(centres @ tops.T, axis=1)
        ids = np.arange(len(centres)) if tops is None else np.array(
            [c * CELL_LISTS + (of[:k] == c).sum() for k, c in enumerate(of)], np.int64)
        made = spark.createDataFrame(zip(of.tolist(), ids.tolist(), centres.tolist()), CENTRES)
    elif (levels or (1 if 8 * nlist * dim <= BROADCAST_BYTES else 2)) == 1:
        tops, (found, _) = None, train_centres(vectors, dim, nlist, sample_size, seed, iterations)
        made = spark.createDataFrame([(0, k, c) for k, c in enumerate(found.tolist())], CENTRES)
    else:
        usable = vectors.where((F.size("vector") == dim) & V.is_usable(F.col("vector")))
        n_cells = max(2, min(math.isqrt(nlist), BROADCAST_BYTES // (8 * dim)))
        tops, shares = train_centres(vectors, dim, n_cells, sample_size, seed, iterations)
        made = train_cells(usable, dim, tops, shares, nlist, sample_size, seed, iterations)
    made.coalesce(1).write.parquet(f"{path}/centres") if centres is not None or tops is None else made.write.parquet(f"{path}/centres")
    if tops is not None:
        spark.createDataFrame([(k, c) for k, c in enumerate(tops.tolist())], "cell int, centre array<double>").coalesce(
            1).write.parquet(f"{path}/cells")
    held = spark.read.parquet(f"{path}/centres").agg(F.count(F.lit(1)).alias("n"), F.max("list_id").alias("high")).first()
    if not held.n:
        raise ValueError("no usable vectors to index")
    record = {"dim": dim, "lists": held.n, "layers": [], "removed": [], "mark": 0, "rows": 0,
              "group_lists": CELL_LISTS if tops is not None else max(1, math.isqrt(held.high + 1))}
    return _with_rows(_opened(spark, path, 0, record), vectors)


def _opened(spark: SparkSession, path: str, number: int, record: dict) -> ListIndex:
    tops = list_ids = centres = cells = None
    if record["group_lists"] == CELL_LISTS:
        table = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()
        tops = np.array([row.centre for row in table])
    if 8 * record["lists"] * record["dim"] <= BROADCAST_BYTES:
        table = spark.read.schema(CENTRES).parquet(f"{path}/centres").orderBy("list_id").toArrow()
        list_ids, cells = table["list_id"].to_numpy(), table["cell"].to_numpy()
        centres = load_units(table["centre"], record["dim"], True)[0]
    return ListIndex(spark, path, number, record, tops, list_ids, centres, cells)


def open_lists(spark: SparkSession, path: str) -> ListIndex:
    """Open a finished index; FileNotFoundError when there is none."""
    number, record = CommitLog(path).latest()
    if not number:
        raise FileNotFoundError(f"no finished index at {path}")
    return _opened(spark, path, number, record)


def _layer(index: ListIndex, placed: DataFrame) -> tuple[dict | None, int, int]:
    """Write ``list_id, list_group, image_id, mark, vector`` as a layer: (its entry in the record, rows, sum of marks)."""
    spark, dim = index.spark, index.dim
    name = f"layer-{uuid.uuid4().hex}"
    sizes = placed.groupBy("list_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("mark").cast("decimal(38,0)")).alias("mark"))
    sizes = materialise(sizes.withColumn("parts", F.ceil(F.col("n") * 4 * dim / PART_BYTES).cast("int")), "sizes")
    told = sizes.agg(F.sum("n").alias("n"), F.sum("mark").alias("mark"), F.max("parts").alias("parts")).first()
    if not told.n:
        return None, 0, 0
    if told.parts > 1:
        large = broadcast_if_small(sizes.where("parts > 1").select("list_id", "parts"), 16)
        placed = placed.join(large, "list_id", "left").withColumn(
            "part", F.pmod(F.xxhash64("image_id"), F.coalesce("parts", F.lit(1))).cast("int"))
    else:
        placed = placed.withColumn("part", F.lit(0))
    # the base sets the number of buckets for all layers
    index.record.setdefault("buckets", int(max(spark.sparkContext.defaultParallelism, min(told.n * 4 * dim // BUCKET_BYTES, 50_000))))
    keys, buckets, most = ["list_id", "part"], index.record["buckets"], max(1, BLOCK_BYTES // (4 * dim))
    dealt = (placed.repartition(buckets, *keys).sortWithinPartitions(*keys, "image_id")
             .select("list_id", "part", "list_group", "image_id", "mark", "vector"))

    def blocks(batches):
        waiting, kept = [], None

        def made(rows):
            table = pa.Table.from_batches(rows)
            for start in range(0, table.num_rows, most):
                block = table.slice(start, most)
                flat = np.ascontiguousarray(block["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False), np.float32)
                lists = [pa.array([block[c].to_pylist()], pa.list_(pa.int64())) for c in ("image_id", "mark")]
                yield pa.RecordBatch.from_arrays(
                    [*[block[c].combine_chunks().slice(0, 1) for c in keys], *lists,
                     pa.array([flat.tobytes()], pa.binary()), block["list_group"].combine_chunks().slice(0, 1)],
                    names=[*keys, "ids", "marks", "vectors", "list_group"])

        for batch in batches:
            lists, parts = (batch.column(c).to_numpy() for c in keys)
            starts = np.flatnonzero(np.concatenate([[True], (np.diff(lists) != 0) | (np.diff(parts) != 0)]))
            for start, end in zip(starts, np.append(starts[1:], batch.num_rows)):
                key = lists[start], parts[start]
                # whole blocks leave as soon as they are full
                if waiting and (key != kept or sum(w.num_rows for w in waiting) >= most):
                    yield from made(waiting)
                    waiting = []
                kept = key
                waiting.append(batch.slice(start, end - start))
        if waiting:
            yield from made(waiting)

    write_bucketed(dealt.mapInArrow(blocks, BLOCKS), f"{index.path}/{name}", keys, buckets, partition="list_group", dealt=True)
    return {"name": name, "rows": told.n}, told.n, int(told.mark)


def _with_rows(index: ListIndex, rows: DataFrame, removed: tuple | None = None) -> ListIndex:
    """Commit a layer of new rows, and a table of removed ones (name, rows, sum of marks)."""
    rows = rows.withColumn("mark", row_mark(rows)).withColumn("vector", F.col("vector").cast("array<float>"))
    placed = materialise(nearest_lists(index, rows, "image_id", 1, 1, ["mark", "vector"]), "placed")
    layer, n, mark = _layer(index, placed)
    record = dict(index.record)
    if removed:
        record["removed"] = [*record["removed"], {"name": removed[0], "before": len(record["layers"]), "rows": removed[1]}]
        n, mark = n - removed[1], mark - removed[2]
    if layer:
        record["layers"] = [*record["layers"], layer]
    if not record["layers"]:
        raise ValueError("no usable vectors to index")
    record["rows"], record["mark"] = record["rows"] + n, record["mark"] + mark
    number = CommitLog(index.path).commit(index.number, record)
    new = ListIndex(index.spark, index.path, number, record, index.tops, index.list_ids, index.centres, index.cells)
    if len(record["layers"]) > MOST_LAYERS or sum(r["rows"] for r in record["removed"]) > MOST_REMOVED:
        return compact(new)
    return new


# ---- growing ---------------------------------------------------------------

def append(index: ListIndex, rows: DataFrame) -> ListIndex:
    """The index with ``rows`` (``image_id, vector``, ids not in it yet) as a layer; nothing else is read or written."""
    return _with_rows(index, rows)


def held_rows(index: ListIndex) -> DataFrame:
    """``image_id, mark`` of every row that counts; no vector is read."""
    made = None
    for k, layer in enumerate(index.layers):
        pairs = layer.select(F.explode(F.arrays_zip("ids", "marks")).alias("r")).select(
            F.col("r.ids").alias("image_id"), F.col("r.marks").alias("mark"))
        gone = [r["name"] for r in index.record["removed"] if k < r["before"]]
        if gone:
            ids = index.spark.read.parquet(*[f"{index.path}/{name}" for name in gone]).select("image_id").distinct()
            pairs = pairs.join(broadcast_if_small(ids, 16), "image_id", "left_anti")
        made = pairs if made is None else made.union(pairs)
    return made


def replace(index: ListIndex, rows: DataFrame, ids: DataFrame) -> ListIndex:
    """The index without the images of ``ids`` (``image_id``; unknown ones count for nothing) and with ``rows``."""
    name = f"removed-{uuid.uuid4().hex}"
    held = held_rows(index).join(broadcast_if_small(materialise(ids.select("image_id").distinct(), "ids"), 16), "image_id", "left_semi")
    held.write.parquet(f"{index.path}/{name}")
    told = index.spark.read.parquet(f"{index.path}/{name}").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("mark").cast("decimal(38,0)")).alias("mark")).first()
    return _with_rows(index, rows, (name, told.n, int(told.mark or 0)) if told.n else None)


def remove(index: ListIndex, ids: DataFrame) -> ListIndex:
    none = index.spark.createDataFrame([], "image_id bigint, vector array<float>")
    return replace(index, none, ids)


def update(index: ListIndex, vectors: DataFrame) -> ListIndex:
    """The index brought to the state of ``vectors``: rows it lacks are added, changed ones replaced,
    vanished ones removed. Narrow columns are compared; vectors are read of new and changed rows."""
    usable = vectors.where((F.size("vector") == index.dim) & V.is_usable(F.col("vector")))
    want = usable.select("image_id", row_mark(usable).alias("mark"))
    told = want.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("mark").cast("decimal(38,0)")).alias("mark")).first()
    if told.n == index.record["rows"] and int(told.mark or 0) == index.record["mark"]:
        return index
    held = held_rows(index)
    new = materialise(want.join(held, ["image_id", "mark"], "left_anti"), "new")
    old = materialise(held.join(want, ["image_id", "mark"], "left_anti"), "old")
    rows = usable.join(broadcast_if_small(new.select("image_id"), 16), "image_id", "left_semi")
    return append(index, rows) if old.isEmpty() else replace(index, rows, old)


def compact(index: ListIndex) -> ListIndex:
    """One layer in place of all, without the removed rows. The old ones stay for readers that have begun."""
    groups = index.record["group_lists"]
    placed = index.lists.withColumn("list_group", F.floor(F.col("list_id") / groups).cast("int"))
    layer, _, _ = _layer(index, materialise(placed, "placed"))
    record = dict(index.record) | {"layers": [layer] if layer else [], "removed": []}
    number = CommitLog(index.path).commit(index.number, record)
    return ListIndex(index.spark, index.path, number, record, index.tops, index.list_ids, index.centres, index.cells)


# ---- search ----------------------------------------------------------------

def probe(queries: DataFrame, index: ListIndex, nprobe: int, cells: int | None = None) -> DataFrame:
    """``query_id, list_id, list_group``: the ``nprobe`` nearest lists per query. With two levels the lists
    of the ``cells`` nearest cells are compared (all of them where ``nprobe`` takes in every list)."""
    nprobe = min(nprobe, index.nlist)
    if cells is None and index.tops is not None:
        cells = len(index.tops) if nprobe == index.nlist else min(len(index.tops), max(4, 2 * nprobe * len(index.tops) // index.nlist))
    return nearest_lists(index, queries, "query_id", nprobe, cells or 1, [])


def search_lists(index: ListIndex, queries: DataFrame, k: int = 5, *, nprobe: int = 32, cells: int | None = None,
                 exclude_self: bool = False, query_bytes: int = QUERY_BYTES, block_bytes: int | None = None) -> DataFrame:
    """``(query_id, rank, image_id, score)``: exact scores inside the probed lists; all lists probed equals exact search.

    No vector of the index is shuffled. Few queries (their size is checked) are broadcast; of many, blocks
    read the lists they probe where that is less than what would travel, else those that probe a list
    travel to its parts in blocks of ASK_ROWS (or of ``block_bytes``). A query id that repeats is asked once."""
    if k <= 0:
        return nearest(queries, queries.withColumnRenamed("query_id", "image_id"), 0)
    every = nprobe >= index.nlist and (index.tops is None or cells is None or cells >= len(index.tops))
    probes = None if every else materialise(probe(queries, index, nprobe, cells), "probes")
    queries = queries.select("query_id", "vector").where(F.size("vector") == index.dim)
    asked, nprobe = queries.count(), min(nprobe, index.nlist)
    few = scanned(queries, asked, index.dim, k, lambda: index.record["rows"], 0 if every else asked * nprobe, query_bytes)
    parts = query_parts(index.spark, asked, block_rows(8 * index.dim, k))
    if not few and (every or parts * index.record["rows"] <= READ_ROWS * asked * nprobe):
        return _stream_lists(index, queries, probes, parts, k, exclude_self)
    hits = None
    for n, layer in enumerate(index.layers):
        layer = layer if every else pruned(layer, probes)
        gone = index.spark.sparkContext.broadcast(index.gone(n))
        if few:
            named = None if every else probes.select("query_id", "list_id").toArrow()
            found = _scan_lists(index, layer, queries.toArrow(), named, k, exclude_self, gone)
        else:
            rows = ASK_ROWS if block_bytes is None else max(1, block_bytes // (8 * index.dim))
            found = _join_lists(index, layer, queries, probes, k, exclude_self, gone, rows)
        hits = found if hits is None else hits.union(found)
    return best(hits, k)


def pruned(layer: DataFrame, probes: DataFrame) -> DataFrame:
    """The blocks of probed lists. Folders of groups nobody probes are left out when the query runs:
    the probed groups, no more numbers than the index has groups, are broadcast."""
    groups = probes.where("list_group >= 0").select("list_group").distinct()
    return layer.join(F.broadcast(groups), "list_group", "left_semi")


class _Hits:
    """The k best images of every query among those found, cut now and then."""

    def __init__(self, k: int):
        self.k, self.parts, self.size = k, [], 0

    def add(self, batch: pa.RecordBatch) -> None:
        self.parts.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        self.size += batch.num_rows
        if self.size > HELD_HITS:
            self.cut()

    def cut(self) -> None:
        if self.parts:
            query, image, score = (np.concatenate(c) for c in zip(*self.parts))
            order = np.lexsort((image, -score, query))
            query = query[order]
            kept = order[np.arange(len(query)) - np.searchsorted(query, query) < self.k]
            self.parts = [[np.concatenate(c)[kept] for c in zip(*self.parts)]]
            self.size = len(kept)

    def batches(self):
        self.cut()
        for query, image, score in self.parts:
            yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(image, pa.int64()), pa.array(score, pa.float64())],
                                             names=["query_id", "image_id", "score"])


def _block(batch: pa.RecordBatch, row: int, dim: int, gone: np.ndarray, keep: int):
    """(unit rows, ids) of a stored block, without removed rows and needless copies."""
    ids = batch.column("ids")[row].values.to_numpy()
    matrix = np.frombuffer(batch.column("vectors")[row].as_py(), np.float32).reshape(len(ids), dim).astype(np.float64)
    alive = ~_among(ids, gone)
    return thin_copies(_unit(matrix[alive]), ids[alive], keep)


def _gathered(blocks, keep: int):
    """(unit rows, ids) of stored blocks, small ones together."""
    waiting, held = [], 0
    for block in blocks:
        waiting.append(block)
        held += len(block[1])
        if held >= MOST_BLOCK_ROWS:
            yield thin_copies(*map(np.concatenate, zip(*waiting)), keep)
            waiting, held = [], 0
    if waiting:
        yield thin_copies(*map(np.concatenate, zip(*waiting)), keep)


def _scan_lists(index, layer, asked: pa.Table, probes: pa.Table | None, k, exclude_self, gone) -> DataFrame:
    units, rows = load_units(asked["vector"], index.dim, False)
    ids = asked["query_id"].to_numpy()[rows].astype(np.int64)
    order = np.argsort(ids)
    ids, units, groups = ids[order], units[order], None
    if probes is None:
        ids, once = np.unique(ids, return_index=True)
        units = units[once]
    else:
        place = np.searchsorted(ids, probes["query_id"].to_numpy())
        lists = probes["list_id"].to_numpy()
        by = np.argsort(lists, kind="stable")
        names, starts = np.unique(lists[by], return_index=True)
        groups = dict(zip(names.tolist(), np.split(place[by], starts[1:]))) if len(names) else {}
    shared, dim, spare = index.spark.sparkContext.broadcast((ids, units, groups)), index.dim, k + exclude_self

    def run(batches):
        ids, units, groups = shared.value
        found = BestK(len(ids), k)
        if groups is None:
            every = (_block(batch, row, dim, gone.value, spare) for batch in batches for row in range(batch.num_rows))
            for block in _gathered(every, spare):
                found.offer(units, *block, None, ids if exclude_self else None)
            yield found.batch(ids)
            return
        for batch in batches:
            lists = batch.column("list_id").to_pylist()
            for row, name in enumerate(lists):
                asking = groups.get(name)
                if asking is not None:
                    found.offer(units[asking], *_block(batch, row, dim, gone.value, spare), asking,
                                ids[asking] if exclude_self else None)
        yield found.batch(ids)

    return layer.select("list_id", "ids", "vectors").mapInArrow(run, HITS)


def _stream_lists(index, queries, probes: DataFrame | None, parts: int, k, exclude_self) -> DataFrame:
    """Every block of queries, dealt by id, reads the blocks of the lists it probes from the index's files: all
    lists without ``probes``. No vector of the index travels, and a query leaves with its k hits only."""
    spark, dim, spare, rows = index.spark, index.dim, k + exclude_self, block_rows(8 * index.dim, k)
    if probes is not None:
        queries = queries.join(probes.groupBy("query_id").agg(F.collect_set("list_id").alias("lists")), "query_id")
    dealt = queries.repartition(parts, "query_id").sortWithinPartitions("query_id")
    held = []
    for n, layer in enumerate(index.record["layers"]):
        files = folder(f"{index.path}/{layer['name']}")
        groups = [re.search(r"/list_group=(\d+)/", f) for f in files.files]
        held.append((files.location, [(f, g and int(g[1])) for f, g in zip(files.files, groups)], index.gone(n)))
    every = probes is None
    shared, group_lists = spark.sparkContext.broadcast(held), index.record["group_lists"]

    def blocks(wanted):
        """(list, unit rows, ids) of the stored blocks of ``wanted`` lists, or of all."""
        groups = None if wanted is None else {name // group_lists for name in wanted}
        for location, files, gone in shared.value:
            some = tuple(f for f, g in files if groups is None or g is None or g in groups)
            for batch in Stored(location, some).batches(["list_id", "ids", "vectors"], 8):
                for row, name in enumerate(batch.column("list_id").to_pylist()):
                    if wanted is None or name in wanted:
                        yield name, *_block(batch, row, dim, gone, spare)

    def run(batches):
        for table in key_blocks(batches, "query_id", 2 * rows):
            units, ids, kept = asked_units(table, dim)
            ids, once = np.unique(ids, return_index=True)
            units, kept = units[once], kept[once]
            found, own = BestK(len(ids), k), ids if exclude_self else None
            if not len(ids):
                continue
            if every:
                for block in _gathered((b[1:] for b in blocks(None)), spare):
                    found.offer(units, *block, None, own)
            else:
                lists = table["lists"].combine_chunks().take(pa.array(kept))
                names, row = lists.flatten().to_numpy(), np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
                by = np.argsort(names, kind="stable")
                wanted, starts = np.unique(names[by], return_index=True)
                asking = dict(zip(wanted.tolist(), np.split(row[by], starts[1:])))
                for name, *block in blocks(asking):
                    some = asking[name]
                    found.offer(units[some], *block, some, None if own is None else own[some])
            yield ranked(found, ids, k)

    return dealt.mapInArrow(run, RANKED)


def _join_lists(index, layer, queries, probes, k, exclude_self, gone, rows) -> DataFrame:
    """The blocks of a list meet the queries that probe it, a block of queries at a time."""
    spark, dim = index.spark, index.dim
    parts = materialise(layer.select("list_id", "part").distinct(), "parts")
    asked = probes.groupBy("list_id").agg(F.ceil(F.count(F.lit(1)) / rows).alias("asks"))
    plan = broadcast_if_small(materialise(parts.join(asked, "list_id"), "asks"), 32)
    ask = F.pmod(F.xxhash64("query_id"), F.col("asks"))
    blocks = (probes.select("query_id", "list_id").join(plan, "list_id").withColumn("ask", ask)
              .join(broadcast_if_small(queries, 8 * dim + 64), "query_id")
              .groupBy("list_id", "part", "ask")
              .agg(F.collect_list("query_id").alias("asking"), F.flatten(F.collect_list(F.col("vector").cast("array<float>"))).alias("asked")))
    met = layer.select("list_id", "part", "ids", "vectors").hint("merge").join(blocks, ["list_id", "part"])

    def run(batches):
        kept = _Hits(k)
        for batch in batches:
            for row in range(batch.num_rows):
                asking = batch.column("asking")[row].values.to_numpy()
                asked = np.asarray(batch.column("asked")[row].values, np.float64).reshape(len(asking), dim)
                with np.errstate(all="ignore"):
                    good = np.flatnonzero(np.isfinite(asked).all(axis=1) & (np.abs(asked).sum(axis=1) > 0))
                asking, asked = asking[good], _unit(asked[good])
                found = BestK(len(asking), k)
                found.offer(asked, *_block(batch, row, dim, gone.value, k + exclude_self), None, asking if exclude_self else None)
                kept.add(found.batch(asking))
        yield from kept.batches()

    return met.select("ids", "vectors", "asking", "asked").mapInArrow(run, HITS)
