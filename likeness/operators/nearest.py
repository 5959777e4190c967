"""Best k corpus rows per query by cosine similarity.

No pair of rows ever becomes a DataFrame row. Vectors meet as matrix blocks
inside Arrow batches and only the k best per query and block leave a task:

* Few queries (their size is checked): the query matrix is broadcast and the
  corpus is scanned where it lies. Nothing of the corpus is shuffled.
* Many queries: the corpus is written once below the shared folder. A task holds a
  block of queries and reads the corpus batch by batch, so no vector is copied per block pair
  and a query leaves with its k hits only. A list that very many queries look into is cut
  into more blocks of them.

``probes`` restricts the pairs: a query only meets corpus rows that share a value
of ``list_id`` with it (inverted-file cells or hash buckets). Copies of one vector
are thinned out inside each block before scoring, which changes no result.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from likeness.functions import vectors as V
from likeness.functions.blocks import BestK, best_of_each, load_units, thin_copies
from likeness.schemas import HITS
from likeness.session import broadcast_if_small, materialise
from likeness.sources.stored import Stored, key_blocks, stored

# A query set below this size is broadcast.
QUERY_BYTES = 32 * 1024 * 1024
# ... unless its tasks together would hand on more rows than this, or one keep more than that.
SCAN_HITS, TASK_HITS = 1_000_000_000, 16_000_000
# ... or than the corpus weighs, where that is more rows than this: blocks then read it with less.
FEW_HITS, HIT_BYTES = 1 << 22, 24
# Tasks of a scan for each core.
SCAN_TASKS = 8
# A batch of the corpus stays below this size.
BLOCK_BYTES = 32 * 1024 * 1024
# Nor does it hold more rows than this, which bounds the work on one block pair.
MOST_BLOCK_ROWS = 8192
# Blocks are not cut below this many rows for the sake of parallel tasks.
LEAST_BLOCK_ROWS = 256
# Bytes of the queries of one block, and hits it gathers.
ASKED_BYTES, ASKED_HITS = 16 * 1024 * 1024, 1 << 20
# Blocks of queries are spread over at most this many tasks.
MOST_PARTS = 50_000


def nearest(queries: DataFrame, corpus: DataFrame, k: int, *, dim: int | None = None,
            exclude_self: bool = False, keep_zero: bool = False, probes: DataFrame | None = None,
            copies: int = 1, query_bytes: int = QUERY_BYTES,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(query_id, rank, image_id, score)``, at most ``k`` rows per query.

    queries: ``query_id, vector``; corpus: ``image_id, vector``, ids unique on both
    sides. Rows whose vector is NULL, of another length than ``dim`` or not finite are
    left out, zero vectors too unless ``keep_zero`` (they then score 0).
    ``exclude_self`` drops the corpus row whose id equals the query's. Ties go to the
    smaller id.

    ``probes`` (``query_id, list_id``, best a written table) names the lists each query looks
    into; the corpus then has a ``list_id`` too. ``copies`` says in how many lists one
    corpus row may appear.
    """
    if dim is None:
        dim = common_dim(queries)
    if dim is None or k <= 0:
        return queries.sparkSession.createDataFrame([], HITS).select(
            "query_id", F.lit(0).alias("rank"), "image_id", "score")
    queries = queries.select("query_id", "vector").where(F.size("vector") == dim)
    corpus = corpus.select("image_id", "vector", *(["list_id"] if probes is not None else []))
    asked = queries.count()
    probed = 0 if probes is None else probes.count()
    if scanned(queries, asked, dim, k * copies, corpus.count, probed, query_bytes):
        lists = None if probes is None else probes.select("query_id", "list_id").toArrow()
        hits = _scan(queries.toArrow(), lists, corpus, k, copies, dim, exclude_self, keep_zero, block_bytes)
    elif probes is None:
        return _stream(queries, asked, corpus, k, dim, exclude_self, keep_zero, block_bytes)
    else:
        hits = _stream_lists(queries, probes, corpus, k, dim, exclude_self, keep_zero, block_bytes)
    if copies > 1:
        hits = hits.groupBy("query_id", "image_id").agg(F.max("score").alias("score"))
    return best(hits, k)


def scanned(queries: DataFrame, asked: int, dim: int, k: int, held, probed: int = 0, query_bytes: int = QUERY_BYTES) -> bool:
    """Whether the queries are few enough to be broadcast. Every scanning task hands on k rows per query,
    however little it read; ``held`` counts the rows of the corpus."""
    hits = asked * k * SCAN_TASKS * queries.sparkSession.sparkContext.defaultParallelism
    if asked * 8 * dim + probed * 16 > query_bytes or asked * k > TASK_HITS or hits > SCAN_HITS:
        return False
    return hits <= FEW_HITS or hits * HIT_BYTES <= held() * 4 * dim


def best(hits: DataFrame, k: int) -> DataFrame:
    """Keep the k best rows per query and number them from 1. The filter on the
    row number lets Spark cut each task's rows to k per query before the shuffle."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("image_id"))
    return (hits.withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k)
            .select("query_id", "rank", "image_id", "score"))


def common_dim(vectors: DataFrame) -> int | None:
    """Length of the usable vector with the lowest id (the first column), however the rows
    are stored; None when no vector is usable."""
    usable = vectors.where(V.is_usable(F.col("vector")))
    return usable.agg(F.min_by(F.size("vector"), vectors.columns[0]).alias("n")).first().n


def _scan(table, lists, corpus, k, copies, dim, exclude_self, keep_zero, block_bytes):
    """Corpus scanned in place against a broadcast query matrix."""
    units, rows = load_units(table["vector"], dim, True)
    # A query without direction scores 0 everywhere; it only has hits where the
    # corpus keeps zero vectors too.
    if not keep_zero:
        alive = np.einsum("ij,ij->i", units, units) > 0
        units, rows = units[alive], rows[alive]
    ids = table["query_id"].to_numpy()[rows].astype(np.int64)
    order = np.argsort(ids)
    ids, units = ids[order], units[order]
    groups = None
    if lists is not None:
        place = np.searchsorted(ids, lists["query_id"].to_numpy())
        known = np.flatnonzero(np.append(ids, -1)[place] == lists["query_id"].to_numpy())
        cells, place = lists["list_id"].to_numpy()[known], place[known]
        by_cell = np.argsort(cells, kind="stable")
        names, starts = np.unique(cells[by_cell], return_index=True)
        groups = dict(zip(names.tolist(), np.split(place[by_cell], starts[1:])))
    spark = corpus.sparkSession
    shared = spark.sparkContext.broadcast((ids, units, groups))
    spare = k + exclude_self
    lists_asked = None if groups is None else np.array(list(groups), np.int64)

    def run(batches):
        ids, units, groups = shared.value
        # A row found in several lists may hold that many places for now.
        found = BestK(len(ids), k * copies)
        waiting, size = [], 0

        def offer_lists():
            """The rows gathered so far, list by list: the more of them, the fewer small products."""
            block, names, cells = (np.concatenate(c) for c in zip(*waiting))
            order = np.argsort(cells, kind="stable")
            block, names, cells = block[order], names[order], cells[order]
            lists, starts = np.unique(cells, return_index=True)
            for cell, start, end in zip(lists.tolist(), starts, np.append(starts[1:], len(cells))):
                asking = groups.get(cell)
                if asking is not None:
                    found.offer(units[asking], *thin_copies(block[start:end], names[start:end], spare), asking,
                                ids[asking] if exclude_self else None)

        for batch in batches:
            block, kept = load_units(batch.column("vector"), dim, keep_zero)
            names = batch.column("image_id").to_numpy(zero_copy_only=False)[kept]
            if groups is None:
                found.offer(units, *thin_copies(block, names, spare), None, ids if exclude_self else None)
                continue
            cells = batch.column("list_id").to_numpy(zero_copy_only=False)[kept]
            asked_for = np.isin(cells, lists_asked)
            waiting.append((block[asked_for], names[asked_for], cells[asked_for]))
            size += waiting[-1][0].nbytes
            if size > block_bytes:
                offer_lists()
                waiting, size = [], 0
        if waiting:
            offer_lists()
        yield found.batch(ids)

    # Fewer, longer tasks: each hands on k rows per query however much it read.
    tasks = SCAN_TASKS * spark.sparkContext.defaultParallelism
    return corpus.coalesce(tasks).mapInArrow(run, HITS)


def block_rows(row_bytes: int, k: int) -> int:
    """Queries that one block holds at most."""
    return max(LEAST_BLOCK_ROWS, min(ASKED_BYTES // row_bytes, ASKED_HITS // k))


def query_parts(spark, asked: int, rows: int) -> int:
    """Blocks of queries: of about ``rows`` rows or fewer, and enough of them for all tasks."""
    tasks = 4 * spark.sparkContext.defaultParallelism
    return min(MOST_PARTS, square_blocks(asked, asked, rows, tasks * tasks)[0])


def batch_rows(row_bytes: int, block_bytes: int = BLOCK_BYTES) -> int:
    return max(LEAST_BLOCK_ROWS, min(MOST_BLOCK_ROWS, block_bytes // row_bytes))


def asked_units(table: pa.Table, dim: int, keep_zero: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit vectors, ids, rows) of the usable queries. One without direction scores 0 everywhere; it only has
    hits where the corpus keeps zero vectors too."""
    units, rows = load_units(table["vector"], dim, keep_zero)
    return units, table["query_id"].to_numpy()[rows].astype(np.int64), rows


def search_stored(units: np.ndarray, ids: np.ndarray, corpus: Stored, k: int, dim: int, exclude_self: bool, keep_zero: bool,
                  rows: int) -> BestK:
    """The k best of every query over all rows (``image_id, vector``) of a stored corpus."""
    found = BestK(len(ids), k)
    for batch in corpus.batches(["image_id", "vector"], rows) if len(ids) else ():
        block, kept = load_units(batch.column("vector"), dim, keep_zero)
        names = batch.column("image_id").to_numpy(zero_copy_only=False)[kept].astype(np.int64)
        found.offer(units, *thin_copies(block, names, k + exclude_self), None, ids if exclude_self else None)
    return found


def ranked(found: BestK, ids: np.ndarray, k: int) -> pa.RecordBatch:
    """``query_id, rank, image_id, score`` of a block; rows of one query id share a list."""
    row, names, scores = found.entries()
    order, rank = best_of_each(ids[row], names, scores, k)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[row][order], pa.int64()), pa.array(rank, pa.int32()), pa.array(names[order], pa.int64()),
         pa.array(scores[order], pa.float64())], names=["query_id", "rank", "image_id", "score"])


RANKED = "query_id long, rank int, image_id long, score double"


def _stream(queries, asked, corpus, k, dim, exclude_self, keep_zero, block_bytes):
    """Every block of queries, dealt by id, reads the whole corpus."""
    spark = corpus.sparkSession
    held, rows, read = stored(corpus, "corpus"), block_rows(8 * dim, k), batch_rows(4 * dim, block_bytes)
    dealt = queries.repartition(query_parts(spark, asked, rows), "query_id").sortWithinPartitions("query_id")

    def run(batches):
        for table in key_blocks(batches, "query_id", 2 * rows):
            units, ids, _ = asked_units(table, dim, keep_zero)
            yield ranked(search_stored(units, ids, held, k, dim, exclude_self, keep_zero, read), ids, k)

    return dealt.mapInArrow(run, RANKED)


def _stream_lists(queries, probes, corpus, k, dim, exclude_self, keep_zero, block_bytes):
    """The queries of a list, in blocks, read the rows of that list."""
    spark = corpus.sparkSession
    tasks = spark.sparkContext.defaultParallelism
    plan = materialise(list_blocks(probes, corpus, 1), "blocks")
    told = plan.agg(F.sum("q_blocks").alias("asked"), F.sum("cells").alias("cells")).first()
    rows, read = block_rows(8 * dim, k), batch_rows(4 * dim, block_bytes)
    rows = max(LEAST_BLOCK_ROWS, min(rows, (told.asked or 0) // (4 * tasks)))
    parts = max(tasks, min((told.asked or 0) // rows + 1, MOST_PARTS))
    plan = broadcast_if_small(plan.select("list_id", F.ceil(F.col("q_blocks") / rows).alias("cuts")), 64)
    held = stored(corpus.join(plan, "list_id", "left_semi").select("list_id", "image_id", "vector"), "corpus", ["list_id"])
    # a query looks into a bounded number of lists, so its vector meets them by its id
    asked = (queries.join(probes.join(plan, "list_id"), "query_id").withColumn("cut", F.pmod(F.xxhash64("query_id"), "cuts"))
             .select("list_id", "cut", "query_id", "vector").repartition(parts, "list_id", "cut").sortWithinPartitions("list_id", "query_id"))

    def search(table):
        units, ids, kept = asked_units(table, dim, keep_zero)
        lists = table["list_id"].to_numpy()[kept]
        names, starts = np.unique(lists, return_index=True)
        asking = dict(zip(names.tolist(), zip(starts, np.append(starts[1:], len(lists)))))
        found = BestK(len(ids), k)
        for batch in held.batches(["list_id", "image_id", "vector"], read, "list_id", names):
            cells = batch.column("list_id").to_numpy()
            limits = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1], [True]]))
            for start, end in zip(limits[:-1], limits[1:]):
                if cells[start] not in asking:
                    continue
                low, high = asking[cells[start]]
                piece = batch.slice(start, end - start)
                block, some = load_units(piece.column("vector"), dim, keep_zero)
                images = piece.column("image_id").to_numpy()[some].astype(np.int64)
                found.offer(units[low:high], *thin_copies(block, images, k + exclude_self), np.arange(low, high),
                            ids[low:high] if exclude_self else None)
        return found.batch(ids)

    def run(batches):
        # a task's lists come one after another; small ones share a block
        for batch in key_blocks(batches, "list_id", 2 * rows):
            for start in range(0, batch.num_rows, 2 * rows):
                yield search(batch.slice(start, 2 * rows))

    return asked.mapInArrow(run, HITS)


def square_blocks(asked, held, block_rows, tasks):
    """Numbers of blocks of both sides: small enough for memory, enough pairs for
    all tasks, and near-square pairs, which move the fewest rows (the one-bucket
    scheme of Okcan and Riedewald, 2011)."""
    edge = min(block_rows, max(LEAST_BLOCK_ROWS, math.isqrt(max(1, asked * held) // tasks)))
    return max(1, -(-asked // edge)), max(1, -(-held // edge))


def list_blocks(queries, corpus, block_rows):
    """Into how many blocks each list is cut on both sides, from its row counts, and
    what that costs in scored cells and moved rows. Lists only one side has fall out."""
    asked = queries.groupBy("list_id").agg(F.count(F.lit(1)).alias("n_asked"))
    held = corpus.groupBy("list_id").agg(F.count(F.lit(1)).alias("n_held"))
    both = asked.join(held, "list_id").withColumns({
        "q_blocks": F.ceil(F.col("n_asked") / block_rows), "c_blocks": F.ceil(F.col("n_held") / block_rows)})
    return both.select(
        "list_id", "q_blocks", "c_blocks",
        (F.col("n_asked").cast("double") * F.col("n_held")).alias("cells"),
        (F.col("n_asked").cast("double") * F.col("c_blocks") + F.col("n_held") * F.col("q_blocks")).alias("moved"))
