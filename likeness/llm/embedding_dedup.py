"""Embedding near-duplicates by a robust-pruned flat graph.

Vectors are put into overlapping shards, those of their nearest centres. Each shard builds a
flat graph whose lists are robustly pruned (a neighbour is left out when a kept one is much
nearer to it), with the nearest ones always kept and every edge in both directions. The lists
that a vector got in its shards are united. In each shard every member then searches: a greedy
beam from the shard's medoids, then all neighbours of whatever lies in range, until the range
holds nothing new. Found pairs are verified by their cosine in double precision.

Equal vectors are one row before any of this. A shard with too many rows is cut into blocks,
which meet two by two, so no task grows with the largest group. Pairs never leave a task:
it adds up its members' links and joins them to components. A pair that meets in several
shards counts in the first of those both vectors are in.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from likeness.llm.components import components, contract
from likeness.session import materialise

# Vectors that centres are fitted on, at most: those with the smallest hashes, within so many bytes.
SAMPLE_ROWS, SAMPLE_BYTES = 100_000, 64 << 20
# Centres at most, within the same bytes; a shard that grows beyond a block is cut into blocks.
MOST_CENTRES = 20_000
OVERLAP = 3
SHARD_ROWS, BLOCK_ROWS = 1000, 2500
DEGREE, NEAREST, CANDIDATES, ALPHA = 20, 8, 48, 1.2
BEAM, MEDOIDS = 24, 8
SEED = 3


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centres_of(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Directions of k clusters of unit vectors, by Lloyd's rounds from a fixed draw."""
    draw = np.random.default_rng(SEED)
    centres = sample[draw.permutation(len(sample))[:k]].astype(np.float32)
    points = sample.astype(np.float32)
    for _ in range(rounds):
        own = np.concatenate([(points[a:a + 4096] @ centres.T).argmax(axis=1) for a in range(0, len(points), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        size = np.linalg.norm(sums, axis=1)
        centres = np.where(size[:, None] > 1e-9, sums / np.maximum(size, 1e-9)[:, None], centres)
    return centres


def matrix(column, dim: int) -> np.ndarray:
    """Lists as rows of doubles, short ones filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1])
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(column), dim))
    out[np.arange(dim) < lengths[:, None]] = flat
    return out


def pruned(x: np.ndarray) -> np.ndarray:
    """Neighbour lists (rows of indices, -1 for none) of unit vectors: the NEAREST ones and,
    of CANDIDATES, up to DEGREE that no kept one shadows."""
    n = len(x)
    if n < 2:
        return np.full((n, 1), -1)
    near = (x @ x.T).astype(np.float32)
    np.fill_diagonal(near, -2)
    c = min(CANDIDATES, n - 1)
    cand = np.argpartition(-near, c - 1, axis=1)[:, :c]
    row = np.arange(n)[:, None]
    cand = np.take_along_axis(cand, np.argsort(-near[row, cand], axis=1, kind="stable"), 1)
    far = 1 - near[row, cand]
    np.fill_diagonal(near, 1)
    alive = np.ones(cand.shape, bool)
    kept = np.full((n, min(DEGREE, c)), -1)
    for k in range(kept.shape[1]):
        pick = alive.argmax(axis=1)
        some = alive[np.arange(n), pick]
        if not some.any():
            break
        best = np.where(some, cand[np.arange(n), pick], 0)
        kept[some, k] = best[some]
        alive &= ALPHA * (1 - near[best[:, None], cand]) > far
        alive[np.arange(n), pick] = False
    return np.concatenate([kept, cand[:, :NEAREST]], axis=1)


def both_ways(lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All edges, each in both directions, sorted by their start."""
    n = len(lists)
    a = np.repeat(np.arange(n), lists.shape[1])
    b = lists.ravel()
    a, b = a[b >= 0], b[b >= 0]
    codes = np.unique(np.concatenate([a * n + b, b * n + a]))
    return codes // n, codes % n


def padded(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Edges sorted by start as rows of ends, -1 for none."""
    degree = np.bincount(start, minlength=n)
    out = np.full((n, max(int(degree.max()) if n else 0, 1)), -1)
    first = np.concatenate(([0], np.cumsum(degree)))[:-1]
    out[start, np.arange(len(start)) - np.repeat(first, degree)] = end
    return out


def medoids(x: np.ndarray) -> np.ndarray:
    """The members nearest to the shard's mean and to the means of its parts along fixed directions."""
    draw = np.random.default_rng(SEED).normal(size=(x.shape[1], 3))
    part = ((x @ draw) > np.median(x @ draw, axis=0)) @ np.array([1, 2, 4])
    means = [x.mean(axis=0)] + [x[part == p].mean(axis=0) for p in np.unique(part)]
    return np.unique((x @ np.stack(means).T).argmax(axis=0))[:MEDOIDS + 1]


def in_range(asked: np.ndarray, x: np.ndarray, lists: np.ndarray, own: np.ndarray, radius: float):
    """Pairs (row of ``asked``, row of ``x``) with a similarity of ``radius`` or more that the
    search finds. ``own`` is each asked vector's row of x, -1 where it has none."""
    asked, x = asked.astype(np.float32), x.astype(np.float32)
    m, n = len(asked), len(x)
    seen, done = np.zeros((m, n), bool), np.zeros((m, n), bool)
    entries = medoids(x)
    start = np.concatenate([np.broadcast_to(entries, (m, len(entries))), own[:, None]], axis=1)
    found_q, found_x = [], []

    def look(q, node):
        """Similarities of unseen pairs; those in range are noted."""
        value = np.einsum("ij,ij->i", asked[q], x[node])
        hit = value >= radius
        found_q.append(q[hit])
        found_x.append(node[hit])
        return value

    def fresh(rows, nodes):
        """Mask of the unseen, valid and not repeated nodes of each row; they are seen from now on."""
        order = np.argsort(nodes, axis=1, kind="stable")
        ranked = np.take_along_axis(nodes, order, 1)
        good = ranked >= 0
        good[:, 1:] &= ranked[:, 1:] != ranked[:, :-1]
        good &= ~seen[rows[:, None], np.maximum(ranked, 0)]
        i, j = np.nonzero(good)
        seen[rows[i], ranked[i, j]] = True
        return ranked, i, j

    beam = np.full((m, 0), -1)
    value = np.zeros((m, 0), np.float32)
    rows, nodes = np.arange(m), start
    for _ in range(n + 1):
        ranked, i, j = fresh(rows, nodes)
        new = np.full(ranked.shape, -2, np.float32)
        new[i, j] = look(rows[i], ranked[i, j])
        beam_, value_ = np.concatenate([beam[rows], ranked], 1), np.concatenate([value[rows], new], 1)
        width = min(BEAM, beam_.shape[1])
        top = np.argsort(-value_, axis=1, kind="stable")[:, :width]
        if beam.shape[1] != width:
            beam, value = np.full((m, width), -1), np.full((m, width), -2, np.float32)
        beam[rows], value[rows] = np.take_along_axis(beam_, top, 1), np.take_along_axis(value_, top, 1)
        open_ = (value > -2) & ~done[np.arange(m)[:, None], np.maximum(beam, 0)]
        pick = open_.argmax(axis=1)
        rows = np.flatnonzero(open_.any(axis=1))
        if not len(rows):
            break
        best = beam[rows, pick[rows]]
        done[rows, best] = True
        nodes = lists[best]
    # whatever lies in range is expanded as well, wherever that leads
    q, node = np.concatenate(found_q), np.concatenate(found_x)
    while len(q):
        going = ~done[q, node]
        q, node = q[going], node[going]
        done[q, node] = True
        mark = len(found_q)
        for a in range(0, len(q), 8192):
            near = lists[node[a:a + 8192]]
            wide = np.repeat(q[a:a + 8192], near.shape[1])
            flat = near.ravel()
            ok = flat >= 0
            codes = np.unique(wide[ok] * n + flat[ok])
            codes = codes[~seen.ravel()[codes]]
            seen.ravel()[codes] = True
            look(codes // n, codes % n)
        q, node = np.concatenate([*found_q[mark:], q[:0]]), np.concatenate([*found_x[mark:], node[:0]])
    return np.concatenate(found_q), np.concatenate(found_x)


def usable(vectors: DataFrame, id_: str, vector: str) -> DataFrame:
    """(rep, n, vec): distinct usable vectors, their smallest id and number of rows."""
    good = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (
        F.abs(x) != float("inf"))) & F.exists(vector, lambda x: x != 0)
    return vectors.where(good & F.col(id_).isNotNull()).groupBy(F.col(vector).alias("vec")).agg(
        F.min(id_).alias("rep"), F.count(F.lit(1)).alias("n"))


def near_duplicates(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", radius: float = 0.95) -> DataFrame:
    """(id, n_links, component_id, kept) for every row.

    ``n_links`` counts the other rows with a cosine of ``radius`` or more that were found, in double
    precision; ``component_id`` is the smallest id reachable, itself included; ``kept`` marks the row
    that bears it. Vectors that are null, empty, zero or hold a null or non-finite component
    link with nothing, nor do those of different lengths with each other or rows with a null id.
    Repeated rows link with each other and stay. An id is thought to name one vector.
    """
    reps = materialise(usable(vectors, id_, vector), "distinct")
    size = reps.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim")).first()
    if not size["n"]:
        return vectors.select(id_, F.lit(0).cast("bigint").alias("n_links"), F.col(id_).cast("bigint").alias("component_id"),
                              F.lit(True).alias("kept"))
    dim, n = int(size["dim"]), int(size["n"])
    k = int(min(max(1, -(-n * OVERLAP // SHARD_ROWS)), MOST_CENTRES, max(1, SAMPLE_BYTES // (8 * dim))))
    if n <= BLOCK_ROWS:
        k = 1
    sample = reps.orderBy(F.xxhash64("rep"), "rep").limit(max(k, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim)))).select("vec").toArrow()
    centres = centres_of(unit(matrix(sample.column(0), dim)), min(k, len(sample)))
    found = search(materialise(placed(reps, centres, dim), "placed"), dim, radius)
    return joined(vectors, reps, found, id_, vector)


def placed(reps: DataFrame, centres: np.ndarray, dim: int) -> DataFrame:
    """Each vector once in every shard it belongs to: (shard, block, blocks, rep, n, vec, shards)."""
    shipped = reps.sparkSession.sparkContext.broadcast(centres)  # at most MOST_CENTRES rows

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            x = unit(matrix(table.column("vec"), dim)).astype(np.float32)
            c = shipped.value
            most = min(OVERLAP, len(c))
            own = np.concatenate([np.sort(np.argpartition(-(x[a:a + 2048] @ c.T), most - 1, axis=1)[:, :most], axis=1)
                                  for a in range(0, len(x), 2048)]).astype(np.int32)
            rows = pa.array(np.arange(0, own.size + 1, most, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*[c_.combine_chunks() for c_ in table.columns],
                                              pa.ListArray.from_arrays(rows, pa.array(own.ravel()))],
                                             names=["vec", "rep", "n", "shards"])

    wide = reps.select(F.col("vec").cast("array<double>").alias("vec"), F.col("rep").cast("bigint").alias("rep"),
                       "n").mapInArrow(run, "vec array<double>, rep bigint, n bigint, shards array<int>")
    wide = wide.withColumn("shard", F.explode("shards"))
    blocks = wide.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))  # one row a centre
    return wide.join(F.broadcast(blocks), "shard").withColumn(
        "block", F.pmod(F.xxhash64("rep", F.lit(SEED)), F.col("blocks")).cast("int"))


def search(rows: DataFrame, dim: int, radius: float) -> DataFrame:
    """(rep, links, root): what each task adds to a vector's links, and links to components."""
    def build(table: pa.Table) -> pa.Table:
        rep = table.column("rep").to_numpy()
        order = np.argsort(rep, kind="stable")
        x = unit(matrix(table.column("vec"), dim))[order]
        a, b = both_ways(pruned(x))
        return pa.table({"rep": rep[order][a], "near": rep[order][b]})

    edges = rows.select("shard", "block", "rep", "vec").groupBy("shard", "block").applyInArrow(build, "rep bigint, near bigint")
    lists = edges.groupBy("rep").agg(F.sort_array(F.collect_set("near")).alias("near"))  # at most the lists of OVERLAP shards
    rows = materialise(rows.join(lists, "rep", "left"), "graph")
    # block i asks block j, i <= j
    last = F.col("blocks") - 1
    asks = rows.select("*", F.col("block").alias("i"), F.explode(F.sequence(F.col("block"), last)).alias("j"))
    told = rows.where("block > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("block") - 1)).alias("i"),
                                          F.col("block").alias("j"))

    def run(table: pa.Table) -> pa.Table:
        i, j, block, shard = (table.column(c).to_numpy() for c in ("i", "j", "block", "shard"))
        rep, n = table.column("rep").to_numpy(), table.column("n").to_numpy()
        order = np.argsort(rep, kind="stable")
        rep, n, block = rep[order], n[order], block[order]
        x = unit(matrix(table.column("vec"), dim))[order]
        lengths = np.concatenate([np.diff(np.frombuffer(c.buffers()[1], np.int32)[c.offset:c.offset + len(c) + 1])
                                  for c in table.column("vec").chunks])[order]
        own = matrix(table.column("shards"), len(table.column("shards")[0])).astype(np.int64)[order]
        index = np.flatnonzero(block == j[0])
        query = np.flatnonzero(block == i[0])
        empty = pa.table({"rep": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        if not len(index) or not len(query):
            return empty
        # the united lists, as far as they stay in the block that is asked
        near = table.column("near").combine_chunks().take(pa.array(order))
        ends = near.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        counts = np.array(near.value_lengths().fill_null(0))
        starts = np.repeat(np.arange(len(rep)), counts)
        at = np.minimum(np.searchsorted(rep[index], ends), len(index) - 1)
        inside = (rep[index][at] == ends) & (block[starts] == j[0])
        lists = padded(np.searchsorted(index, starts[inside]), at[inside], len(index))
        place = np.full(len(rep), -1)
        place[index] = np.arange(len(index))
        q, t = in_range(x[query], x[index], lists, place[query], radius - 1e-4)
        a, b = query[q], index[t]
        good = (a != b) & (lengths[a] == lengths[b])
        a, b = a[good], b[good]
        codes = np.unique(np.minimum(a, b) * len(rep) + np.maximum(a, b))
        a, b = codes // len(rep), codes % len(rep)
        exact = np.concatenate([np.einsum("ij,ij->i", x[a[s:s + 65536]], x[b[s:s + 65536]])
                                for s in range(0, len(a), 65536)]) if len(a) else np.zeros(0)
        a, b = a[exact >= radius], b[exact >= radius]
        if not len(a):
            return empty
        common = (own[a][:, :, None] == own[b][:, None, :]).any(axis=2)
        first = np.where(common, own[a], 1 << 40).min(axis=1) == shard[0]
        links = np.zeros(len(rep), np.int64)
        np.add.at(links, a[first], n[b[first]])
        np.add.at(links, b[first], n[a[first]])
        node, root = contract(rep[a], rep[b])
        some = np.flatnonzero(links)
        return pa.table({"rep": np.concatenate([rep[some], node]),
                         "links": np.concatenate([links[some], np.zeros(len(node), np.int64)]),
                         "root": pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(root)])})

    return asks.union(told.select(*asks.columns)).groupBy("shard", "i", "j").applyInArrow(
        run, "rep bigint, links bigint, root bigint")


def joined(vectors: DataFrame, reps: DataFrame, found: DataFrame, id_: str, vector: str) -> DataFrame:
    found = materialise(found, "found")
    roots = components(found.where("root IS NOT NULL").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = reps.join(links, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("vec").alias("__vec"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("root", F.col("rep").cast("bigint")).alias("component_id"))
    whole = vectors.select(F.col(id_), F.col(vector).alias("__v"))
    # vectors find their class by all of their components; rows that link with nothing have none
    out = whole.join(classes, (F.col("__v") == F.col("__vec")) & F.col(id_).isNotNull(), "left")
    out = out.select(id_, F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                     F.coalesce("component_id", F.col(id_).cast("bigint")).alias("component_id"))
    return out.withColumn("kept", F.col(id_).eqNullSafe(F.col("component_id")))


def audit(vectors: DataFrame, result: DataFrame, id_: str = "vec_id", vector: str = "embedding", radius: float = 0.95,
          asked: int = 200) -> float:
    """Found links over all links of ``asked`` vectors (those with the smallest hashes), by brute force."""
    good = usable(vectors, id_, vector)
    sample = good.orderBy(F.xxhash64("rep"), "rep").limit(asked).toArrow()
    if not len(sample):
        return 1.0
    dim = vectors.agg(F.max(F.size(vector))).first()[0]
    shipped = vectors.sparkSession.sparkContext.broadcast(unit(matrix(sample.column("vec"), dim)))
    ids = sample.column("rep").to_numpy()

    def run(batches):
        for batch in batches:
            x = unit(matrix(batch.column(0), dim))
            near = (shipped.value @ x.T >= radius) * batch.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(near.sum(axis=1))], names=["rep", "links"])

    true = good.select("vec", "n").mapInArrow(run, "rep bigint, links bigint").groupBy("rep").agg(
        (F.sum("links") - 1).alias("links"))
    both = true.join(result.select(F.col(id_).alias("rep"), "n_links"), "rep").agg(F.sum("links").alias("t"), F.sum("n_links").alias("f")).first()
    return 1.0 if not both["t"] else both["f"] / both["t"]


def op7(spark, sf_dir: str) -> DataFrame:
    """The near-duplicates with ``recall``, the share of 200 vectors' true links that were found."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = materialise(near_duplicates(vectors), "near")
    return found.withColumn("recall", F.lit(float(audit(vectors, found))))
