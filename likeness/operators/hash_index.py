"""Approximate search by stored hash lists.

A vector's list in each of some hash tables is the signs of its random projections (Charikar
2002). The index deals the images to buckets and stores each bucket's vectors once, and beside
them a narrow table ``bucket, list_id, ids``. A search looks into its own list of every table
and into those that differ in the least certain signs (multi-probe). The queries of a list meet
its ids in the bucket, and ids meet vectors there: nothing of a stored index is shuffled, no vector is
copied per table, and each is read once a search however many lists name it. A list that
very many queries share with very many images is compared as matrix blocks instead of pairs.
"""

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from likeness.functions.blocks import TIE_DIGITS, load_units
from likeness.operators.nearest import QUERY_BYTES, best, common_dim, nearest
from likeness.schemas import HITS
from likeness.session import BROADCAST_BYTES, broadcast_if_small, materialise
from likeness.sources.bucketed import read_bucketed, write_bucketed

# A list with more (query, image) pairs than this is compared as blocks.
LIST_PAIRS = 1 << 22
# Pairs scored at once, and gathered before they are cut to k a query.
PIECE_PAIRS, HELD_PAIRS = 1 << 14, 1 << 21
# A list with more pairs than this in a bucket is scored as one product.
PRODUCT_PAIRS = 1 << 10
# Near pairs that wait before they are scored in double precision and cut to k a query.
CUT_PAIRS = 1 << 18
# More than a bound is off by as it becomes a single precision number.
FLOAT_SLACK = 2.0 ** -22
# Bytes of vectors of one bucket, about.
BUCKET_BYTES = 64 * 1024 * 1024
ENTRIES, VECTORS = "bucket int, list_id bigint, ids array<bigint>", "bucket int, image_id bigint, vector array<float>"


@dataclass
class HashIndex:
    """``entries`` (bucket, list_id, ids), ``sizes`` (list_id, n), ``vectors`` (bucket, image_id, vector)."""
    dim: int
    tables: int
    bits: int
    planes: np.ndarray
    entries: DataFrame
    sizes: DataFrame
    vectors: DataFrame
    buckets: int


def random_planes(dim: int, tables: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, tables * bits))


def _lists(units: np.ndarray, planes: np.ndarray, tables: int, bits: int, flips: int = 0) -> np.ndarray:
    """(row, list): in every table the list of the signs, then those with one of the ``flips`` least certain signs turned."""
    sides = (units @ planes).reshape(len(units), tables, bits)
    place = 1 << np.arange(bits, dtype=np.int64)
    own = (sides > 0) @ place + (np.arange(tables, dtype=np.int64) << bits)
    if not flips:
        return own
    weak = np.argsort(np.abs(sides), axis=2, kind="stable")[:, :, :flips]
    return np.concatenate([own[:, :, None], own[:, :, None] ^ place[weak]], axis=2).reshape(len(units), -1)


def probed_lists(queries: DataFrame, index: HashIndex, flips: int) -> DataFrame:
    """``query_id, list_id``: ``flips`` + 1 lists in every table."""
    shared, dim, tables, bits = queries.sparkSession.sparkContext.broadcast(index.planes), index.dim, index.tables, index.bits
    flips = min(flips, bits)

    def run(batches):
        for batch in batches:
            units, rows = load_units(batch.column("vector"), dim, False)
            if len(rows):
                lists = _lists(units, shared.value, tables, bits, flips)
                ids = batch.column("query_id").take(pa.array(np.repeat(rows, lists.shape[1])))
                yield pa.RecordBatch.from_arrays([ids, pa.array(lists.ravel())], names=["query_id", "list_id"])

    return queries.select("query_id", "vector").mapInArrow(run, "query_id bigint, list_id bigint")


def bucket_of(column: str, buckets: int):
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def list_entries(dealt: DataFrame, dim: int, planes: np.ndarray, tables: int, bits: int) -> DataFrame:
    """The entries of ``bucket, image_id, vector``, bucket by bucket. Unusable vectors are in no list."""
    shared = dealt.sparkSession.sparkContext.broadcast(planes)

    def run(table: pa.Table) -> pa.Table:
        units, rows = load_units(table["vector"], dim, False)
        lists = _lists(units, shared.value, tables, bits).ravel()
        ids = np.repeat(table["image_id"].to_numpy()[rows].astype(np.int64), tables)
        order = np.argsort(lists, kind="stable")
        names, starts = np.unique(lists[order], return_index=True)
        ends = pa.array(np.append(starts, len(order)), pa.int32())
        return pa.table({"bucket": pa.array(np.full(len(names), table["bucket"][0].as_py()), pa.int32()), "list_id": pa.array(names, pa.int64()),
                         "ids": pa.ListArray.from_arrays(ends, pa.array(ids[order], pa.int64()))})

    return dealt.groupBy("bucket").applyInArrow(run, ENTRIES)


def hash_lists(vectors: DataFrame, *, tables: int = 8, bits: int = 8, dim: int | None = None, seed: int = 42,
               planes: np.ndarray | None = None, path: str | None = None) -> HashIndex | None:
    """An index for one search: the entries are written, the vectors stay where they are, or are written
    below ``path``. None where no vector is usable. Given ``planes`` (dim rows, tables * bits columns) replace
    the random ones."""
    spark, dim = vectors.sparkSession, dim or common_dim(vectors)
    if dim is None:
        return None
    planes = random_planes(dim, tables, bits, seed) if planes is None else np.asarray(planes, np.float64)
    buckets = int(max(spark.sparkContext.defaultParallelism, min(vectors.count() * 4 * dim // BUCKET_BYTES, 1_000_000)))
    dealt = vectors.select(bucket_of("image_id", buckets).alias("bucket"), "image_id", F.col("vector").cast("array<float>").alias("vector"))
    if path is not None:
        dealt = write_bucketed(dealt, f"{path}/vectors", ["bucket"], buckets)
    entries = list_entries(dealt, dim, planes, tables, bits)
    entries = materialise(entries, "entries") if path is None else write_bucketed(entries, f"{path}/entries", ["bucket"], buckets)
    sizes = entries.groupBy("list_id").agg(F.sum(F.size("ids").cast("bigint")).alias("n"))
    return HashIndex(dim, tables, bits, planes, entries, sizes, dealt, buckets)


def build_hash_index(vectors: DataFrame, path: str, **options) -> HashIndex:
    """``hash_lists`` stored below ``path``, entries and vectors bucketed alike."""
    spark = vectors.sparkSession
    made = hash_lists(vectors, path=path, **options)
    if made is None:
        raise ValueError("no usable vectors to index")
    made.sizes.coalesce(1).write.parquet(f"{path}/sizes")
    # written last: its presence marks a finished index
    spark.createDataFrame([(made.dim, made.tables, made.bits, made.buckets, made.planes.ravel().tolist())],
                          "dim int, tables int, bits int, buckets int, planes array<double>").coalesce(1).write.parquet(f"{path}/planes")
    return load_hash_index(spark, path)


def load_hash_index(spark: SparkSession, path: str) -> HashIndex:
    """Open a finished index; FileNotFoundError when there is none."""
    try:
        told = spark.read.parquet(f"{path}/planes").first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no finished index at {path}") from missing
    return HashIndex(told.dim, told.tables, told.bits, np.array(told.planes).reshape(told.dim, -1),
                     read_bucketed(spark, f"{path}/entries", ENTRIES, ["bucket"], told.buckets),
                     spark.read.parquet(f"{path}/sizes"),
                     read_bucketed(spark, f"{path}/vectors", VECTORS, ["bucket"], told.buckets), told.buckets)


def search_hash(index: HashIndex, queries: DataFrame, k: int = 5, *, flips: int = 0, exclude_self: bool = False,
                query_bytes: int = QUERY_BYTES, list_pairs: int = LIST_PAIRS, **sizes) -> DataFrame:
    """``(query_id, rank, image_id, score)``: exact scores among the images of the probed lists.

    ``flips`` more lists are probed in every table. Ties go to the smaller id; rows of unusable
    vectors are left out on both sides."""
    queries = queries.select("query_id", "vector").where(F.size("vector") == index.dim)
    size = queries.count() * 8 * index.dim
    turns = 0 if size <= query_bytes else -(-size // (query_bytes or QUERY_BYTES))
    probes = materialise(probed_lists(queries, index, flips), "probes")
    # the queries of every list, in turns of bounded size, and what its ids and theirs amount to
    turn = [] if not turns else [bucket_of("query_id", turns).alias("turn")]
    asking = probes.groupBy("list_id", *turn).agg(F.collect_list("query_id").alias("asking"))
    met = materialise(asking.join(broadcast_if_small(index.sizes, 32), "list_id")
                      .withColumn("large", F.size("asking") * F.col("n") > list_pairs), "asking")
    told = met.agg(F.sum("n").alias("images"), F.max("large").alias("large")).first()
    small = met.where("NOT large").drop("large", "n") if told.large else met.drop("large", "n")
    hits = _listed_pairs(index, queries, small, turns, told.images or 0, k, exclude_self)
    if told.large:
        heavy = materialise(met.where("large").select("list_id", F.explode("asking").alias("query_id")), "heavy")
        lists = broadcast_if_small(heavy.select("list_id").distinct(), 16)
        held = index.entries.join(lists, "list_id", "left_semi").select("list_id", F.explode("ids").alias("image_id"))
        held = index.vectors.select("image_id", "vector").join(held, "image_id")
        more = nearest(queries, held, k, dim=index.dim, exclude_self=exclude_self, copies=index.tables, probes=heavy, **sizes)
        hits = hits.union(more.select("query_id", "image_id", "score")).groupBy("query_id", "image_id").agg(F.max("score").alias("score"))
    return best(hits, k)


def _listed_pairs(index, queries, asking, turns, images, k, exclude_self):
    """``query_id, image_id, score``: the best of each bucket of images (and turn of queries)."""
    spark, dim = queries.sparkSession, index.dim
    lists = index.entries.join(broadcast_if_small(asking, 8 * 64), "list_id")
    vectors = index.vectors
    if images * 64 <= BROADCAST_BYTES and images * 8 <= vectors.count():  # few images are named: the others stay unread
        named = lists.select(F.explode("ids").alias("image_id")).distinct()
        vectors = vectors.join(F.broadcast(named), "image_id", "left_semi").select("bucket", "image_id", "vector")
    if not turns:
        table = queries.toArrow()
        shared = spark.sparkContext.broadcast(_sorted_units(table["query_id"], table["vector"], dim))

        def score(lists: pa.Table, held: pa.Table) -> pa.Table:
            return _best_pairs(lists, *shared.value, *_sorted_units(held["image_id"], held["vector"], dim), k, exclude_self)

        return lists.groupBy("bucket").cogroup(vectors.groupBy("bucket")).applyInArrow(score, HITS)
    # queries travel to the buckets with a candidate of theirs
    lists, keys = materialise(lists, "lists"), ["bucket", "turn"]
    asked = lists.select(*keys, F.explode("asking").alias("query_id")).distinct().join(queries, "query_id")
    turned = vectors.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    held = turned.select(*keys, F.lit(False).alias("asks"), F.col("image_id").alias("id"), "vector").union(
        asked.select(*keys, F.lit(True), "query_id", F.col("vector").cast("array<float>")))

    def score_turn(lists: pa.Table, held: pa.Table) -> pa.Table:
        held = held.combine_chunks()
        sides = [held.filter(pc.equal(held["asks"], asks)) for asks in (True, False)]
        return _best_pairs(lists, *[x for side in sides for x in _sorted_units(side["id"], side["vector"], dim)], k, exclude_self)

    return lists.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(score_turn, HITS)


def _sorted_units(ids, vectors, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids in order, their unit vectors) of the usable rows."""
    units, rows = load_units(vectors, dim, False)
    ids = ids.to_numpy()[rows].astype(np.int64)
    order = np.argsort(ids)
    return ids[order], units[order]


def _places(ids: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted id among the sorted ids, -1 where it isn't."""
    if not len(ids):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
    return np.where(ids[at] == wanted, at, -1)


def _distinct(values: np.ndarray) -> np.ndarray:
    """The different values in order."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])[:len(values)]]


def _best_pairs(lists: pa.Table, query_ids, queries, image_ids, images, k: int, exclude_self: bool) -> pa.Table:
    """The k best images of every query over the pairs (asking, ids) of all lists, each pair counted once.

    Pairs are scored in single precision, those of a list with many as one product of its queries and images.
    Only pairs that can still be among the best, given the rounding of that, are scored in double precision."""
    sides = []
    for name, ids in (("asking", query_ids), ("ids", image_ids)):
        column = lists[name].combine_chunks()
        size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        sides.append((_places(ids, column.flatten().to_numpy(zero_copy_only=False)), size, np.concatenate(([0], np.cumsum(size)))))
    (asking, n_asking, a_limits), (held, n_held, h_limits) = sides
    light, width = [queries.astype(np.float32), images.astype(np.float32)], max(len(image_ids), 1)
    error = (queries.shape[1] + 8) * 2.0 ** -23 if len(queries) else 0.0
    n_pairs = n_asking * n_held
    # what a pair of each query must reach in single precision, by the pairs seen so far; below -1 while all can
    least = np.full(len(query_ids), -2, np.float32)

    def products():
        """Near pairs of the lists with many, as query place * width + image place."""
        for row in np.flatnonzero(n_pairs > PRODUCT_PAIRS):
            q, i = (_distinct(places[limits[row]:limits[row + 1]]) for places, limits in ((asking, a_limits), (held, h_limits)))
            q, i = q[q >= 0], i[i >= 0]
            step, those = max(1, HELD_PAIRS // max(len(i), 1)), light[1][i].T
            for some in (q[start:start + step] for start in range(0, len(q), step)):
                rough = light[0][some] @ those
                if exclude_self:
                    rough[query_ids[some][:, None] == image_ids[i]] = -np.inf
                new = np.flatnonzero(least[some] == -2)
                if len(i) > k and len(new):
                    kth = np.partition(rough[new], len(i) - k, axis=1)[:, len(i) - k]
                    least[some[new]] = np.maximum(kth - 2 * error - FLOAT_SLACK, -2)
                row_of, column_of = np.nonzero(rough >= least[some][:, None])
                yield some[row_of] * width + i[column_of]

    def listed():
        """Near pairs of the other lists, some lists at a time."""
        rows = np.flatnonzero(n_pairs <= PRODUCT_PAIRS)
        ends, start = np.cumsum(n_pairs[rows]), 0
        while start < len(rows):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + HELD_PAIRS, "right")))
            size = n_pairs[rows[start:stop]]
            row = np.repeat(rows[start:stop], size)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            q, i = asking[a_limits[row] + nth // n_held[row]], held[h_limits[row] + nth % n_held[row]]
            known = (q >= 0) & (i >= 0)
            if exclude_self:
                known &= query_ids[q] != image_ids[i]
            keys = _distinct(q[known] * width + i[known])
            rough = scored(keys, *light)
            near = rough >= least[keys // width]
            keys, rough = keys[near], rough[near]
            yield keys[_near_best(keys // width, rough, k, error)]
            start = stop

    def scored(keys, left, right):
        scores = np.empty(len(keys), left.dtype)
        for at in range(0, len(keys), PIECE_PAIRS):
            q, i = np.divmod(keys[at:at + PIECE_PAIRS], width)
            np.einsum("ij,ij->i", left[q], right[i], out=scores[at:at + PIECE_PAIRS])
        return scores

    def cut(keys, scores):
        """The k best of every query, by key."""
        order = np.argsort(keys, kind="stable")
        keys, scores = keys[order], scores[order]
        owner = keys // width
        order = np.lexsort((-scores, owner))  # equal scores stay by key
        kept = np.sort(order[np.arange(len(owner)) - np.searchsorted(owner, owner) < k])
        return keys[kept], scores[kept]

    best_keys, best_scores = np.zeros(0, np.int64), np.zeros(0)
    waiting, n_waiting = [], 0
    for keys in itertools.chain(products(), listed(), [None]) if k > 0 else ():
        if keys is not None:
            waiting.append(keys)
            n_waiting += len(keys)
        # the more is kept, the more may wait: then a pair is sorted a few times only
        if n_waiting and (keys is None or n_waiting > max(CUT_PAIRS, len(best_keys))):
            keys = _distinct(np.concatenate(waiting))
            keys = keys[_places(best_keys, keys) < 0]
            scores = np.round(scored(keys, queries, images), TIE_DIGITS)
            best_keys, best_scores = cut(np.append(best_keys, keys), np.append(best_scores, scores))
            names, starts, counts = np.unique(best_keys // width, return_index=True, return_counts=True)
            full = counts == k
            least[names[full]] = np.maximum(np.minimum.reduceat(best_scores, starts)[full] - error - FLOAT_SLACK, -2)
            waiting, n_waiting = [], 0
    q, i = np.divmod(best_keys, width)
    return pa.table({"query_id": pa.array(query_ids[q], pa.int64()), "image_id": pa.array(image_ids[i], pa.int64()),
                     "score": pa.array(best_scores, pa.float64())})


def _near_best(query: np.ndarray, rough: np.ndarray, k: int, error: float) -> np.ndarray:
    """Which pairs, sorted by query, come within twice ``error`` of their query's k-th best."""
    if not len(query):
        return np.zeros(0, bool)
    starts = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
    size = np.diff(np.append(starts, len(query)))
    nth = np.repeat(np.arange(len(starts)), size)
    ranked = np.sort(4.0 * nth - rough)  # by query, then from the best on
    kth = 4.0 * np.arange(len(starts)) - ranked[starts + np.minimum(size, k) - 1]
    return rough >= kth[nth] - 2 * error - 1e-8
