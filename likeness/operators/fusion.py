"""Two-stage retrieval and weighted score fusion."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from likeness.functions import vectors as V
from likeness.functions.blocks import best_of_each
from likeness.operators.nearest import (
    asked_units, batch_rows, block_rows, common_dim, nearest, query_parts, scanned, search_stored)
from likeness.session import materialise
from likeness.sources.stored import key_blocks, stored

METRICS = ("embed", "hsv", "hog")
# Vectors that one block of queries gathers, at most, and pairs scored at once.
BLOCK_BYTES, PAIRS = 128 * 1024 * 1024, 8192
# Values of one side of pairs scored at once.
PAIR_VALUES = 1 << 18
# Rows of features that blocks of queries may read for each candidate; bytes of a batch of them.
READ_ROWS, READ_BYTES = 8, 8 * 1024 * 1024
# Queries of as many bytes each stay where they lie, if they have more than this together.
WIDE_ROW, MOVED_BYTES = 4096, 64 * 1024 * 1024


def combined_search(queries: DataFrame, embeddings: DataFrame, features: DataFrame, k: int = 10, *,
                    metrics=METRICS, weights=(1, 1, 1), candidates: int = 300,
                    dim: int | None = None, hsv_dim: int = V.HSV_DIM,
                    legacy_dim: int = V.HS_DIM, retrieve=None) -> DataFrame:
    """``(query_id, rank, image_id, score, s_embed, s_hsv, s_hog)``.

    Candidates are the ``max(k, candidates)`` nearest by embedding, also when
    "embed" is not among the metrics. Each metric is rescaled to [0, 1] over one
    query's candidates, then mixed. A candidate or query without a colour or shape
    vector scores 0 there before rescaling.

    queries: ``query_id, embedding, hsv_vector, hog_vector``; embeddings:
    ``image_id, vector``; features: ``image_id, hsv_vector, hog_vector``.
    ``retrieve(queries, k)`` may replace the exact first stage by an index search.

    With many queries a task takes a block of them through both stages and hands on k rows a query;
    neither candidates nor vectors travel. Few queries search a corpus that stays where it lies.
    """
    used = named_weights(metrics, weights)
    asked = queries.select("query_id", F.col("embedding").alias("vector"))
    wanted = max(k, candidates)
    dim = dim or (None if retrieve else common_dim(asked))
    if not retrieve and dim and k > 0:
        told = queries.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.max(F.size(f"{m}_vector")), F.lit(0)).alias(m)
                                                          for m in METRICS[1:]]).first()
        row_bytes = 8 * dim + 4 * (max(told.hsv, hsv_dim) + told.hog)
        rows = block_rows(row_bytes, wanted)
        parts = query_parts(queries.sparkSession, told.n, rows)
        if not scanned(asked, told.n, dim, wanted, embeddings.count) or parts * features.count() <= READ_ROWS * told.n * wanted:
            return _in_blocks(queries, embeddings, features, k, used, wanted, dim, hsv_dim, legacy_dim, told.n, rows, row_bytes)
    found = (retrieve(asked, wanted) if retrieve
             else nearest(asked, embeddings, wanted, dim=dim))
    # Several steps below read the candidates; the search runs once.
    cands = materialise(
        found.select("query_id", "image_id", F.col("score").alias("s_embed")), "candidates")
    raw = candidate_scores(cands, queries, features, [m for m in METRICS[1:] if m in used],
                           hsv_dim, legacy_dim)
    return fuse(raw, used, k)


def named_weights(metrics, weights) -> dict:
    if len(metrics) != len(weights):
        raise ValueError("metrics and weights must have the same length")
    if len(set(metrics)) != len(metrics):
        raise ValueError("a metric is named twice")
    return dict(zip(metrics, map(float, weights)))


def row_cosine(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Row-wise cosine of two list columns; NaN where a side is missing, has no
    direction or the lengths differ."""
    n_left = left.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    n_right = right.value_lengths().fill_null(-2).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero((n_left == n_right) & (n_left > 0))
    result = np.full(len(left), np.nan)
    if len(rows):
        chosen = pa.array(rows)
        starts = np.concatenate([[0], np.cumsum(n_left[rows])[:-1]])
        a, b = (side.take(chosen).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                for side in (left, right))
        with np.errstate(all="ignore"):
            aa, bb, ab = (np.add.reduceat(x, starts) for x in (a * a, b * b, a * b))
            result[rows] = np.where((aa > 0) & (bb > 0), ab / np.sqrt(aa * bb), np.nan)
            result[rows[~(np.isfinite(aa) & np.isfinite(bb))]] = np.nan
    return result


def pair_cosine(left: pa.Array, right: pa.Array, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosine of ``left[i]`` and ``right[j]``, pair by pair; NaN as for ``row_cosine``. Rows are unpacked once, however
    many pairs name them."""
    result = np.full(len(i), np.nan)
    sizes = [np.unique(side.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)) for side in (left, right)]
    for size in np.intersect1d(*sizes):
        if size <= 0:
            continue
        sides = []
        for side, named in ((left, i), (right, j)):
            matrix, rows = packed(side, size)
            place = np.full(len(side), -1)
            place[rows] = np.arange(len(rows))
            with np.errstate(all="ignore"):
                sides.append((matrix, np.concatenate([_dots(matrix[a:a + PAIRS], matrix[a:a + PAIRS]) for a in range(0, len(rows), PAIRS)]),
                              place[named]))
        (a, aa, at), (b, bb, to) = sides
        known = np.flatnonzero((at >= 0) & (to >= 0))
        step = max(64, PAIR_VALUES // int(size))
        for start in range(0, len(known), step):
            some = known[start:start + step]
            p, q = at[some], to[some]
            with np.errstate(all="ignore"):
                value = _dots(a[p], b[q]) / np.sqrt(aa[p] * bb[q])
            good = (aa[p] > 0) & (bb[q] > 0) & np.isfinite(aa[p]) & np.isfinite(bb[q])
            result[some] = np.where(good, value, np.nan)
    return result


def packed(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``dense`` in the column's own precision."""
    rows = np.flatnonzero(column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == size)
    values = (column if len(rows) == len(column) else column.take(pa.array(rows))).flatten()
    values = values.fill_null(float("nan")) if values.null_count else values
    return values.to_numpy(zero_copy_only=False).reshape(len(rows), size), rows


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a.astype(np.float64), b.astype(np.float64))


@F.arrow_udf(T.DoubleType())
def cosine(left: pa.Array, right: pa.Array) -> pa.Array:
    """The same as a column; NULL where it is NaN."""
    result = row_cosine(left, right)
    return pa.array(result, mask=np.isnan(result))


def candidate_scores(cands: DataFrame, queries: DataFrame, features: DataFrame, metrics,
                     hsv_dim: int, legacy_dim: int) -> DataFrame:
    """Adds ``s_hsv`` and ``s_hog`` to the candidates; metrics left out get 0."""
    columns = [f"{m}_vector" for m in metrics]
    if not columns:
        return cands.withColumns({"s_hsv": F.lit(0.0), "s_hog": F.lit(0.0)})

    def full(df):
        if "hsv_vector" not in columns:
            return df
        return df.withColumn("hsv_vector", V.pad_legacy(F.col("hsv_vector"), legacy_dim, hsv_dim))

    # A block of queries gathers each image its candidates name once; only scores leave it.
    row_bytes = 8 + 4 * (V.HSV_DIM + V.HOG_DIM)
    blocks = max(4, -(-cands.count() * row_bytes // BLOCK_BYTES))

    def block(column):
        return F.pmod(F.xxhash64(column), F.lit(blocks)).alias("block")

    asked = cands.select(block("query_id"), "query_id", "image_id", "s_embed")
    wanted = asked.select("block", "image_id").distinct()
    # an image is wanted once a block at most, so no key is hot
    held = full(features.select("image_id", *columns)).join(wanted, "image_id")
    own = full(queries.select("query_id", *columns))
    vectors = held.select(F.col("block").alias("part"), F.lit(False).alias("is_query"), F.col("image_id").alias("id"), *columns).union(
        own.select(block("query_id"), F.lit(True), "query_id", *columns))

    def score(pairs: pa.Table, found: pa.Table) -> pa.Table:
        found = found.combine_chunks()
        is_query = found["is_query"].to_numpy()
        sides = []
        for kind, name in ((True, "query_id"), (False, "image_id")):
            some = found.filter(pa.array(is_query == kind))
            some = some.take(pc.sort_indices(some["id"]))
            ids, asked_ids = some["id"].to_numpy(), pairs[name].to_numpy()
            at = np.searchsorted(ids, asked_ids)
            known = at < len(ids)
            known[known] = ids[at[known]] == asked_ids[known]
            held = {m: some[f"{m}_vector"].combine_chunks() for m in metrics}
            sides.append((held, at, known))
        out = {c: pairs[c] for c in ("query_id", "image_id", "s_embed")}
        (asked, i, some), (images, j, others) = sides
        both = np.flatnonzero(some & others)
        for m in METRICS[1:]:
            value = np.zeros(pairs.num_rows)
            if m in metrics:
                value[both] = np.nan_to_num(pair_cosine(asked[m], images[m], i[both], j[both]), nan=0.0)
            out[f"s_{m}"] = pa.array(value)
        return pa.table(out)

    kinds = "query_id long, image_id long, s_embed double, s_hsv double, s_hog double"
    return asked.groupBy("block").cogroup(vectors.groupBy("part")).applyInArrow(score, kinds)


def _in_blocks(queries, embeddings, features, k, weights, wanted, dim, hsv_dim, legacy_dim, asked, rows, row_bytes) -> DataFrame:
    """Both stages for a block of queries at a time, which reads the stored embeddings and features batch by batch."""
    spark = queries.sparkSession
    metrics = [m for m in METRICS[1:] if m in weights]
    columns = [f"{m}_vector" for m in metrics]
    corpus = stored(embeddings.select("image_id", "vector"), "corpus")
    held = stored(features, "features") if columns else None
    asking = queries.select("query_id", F.col("embedding").alias("vector"), *[
        V.pad_legacy(F.col(c), legacy_dim, hsv_dim).alias(c) if c == "hsv_vector" else F.col(c) for c in columns])
    # queries of one id share a list; where ids are unique, wide rows need not meet
    wide = row_bytes >= WIDE_ROW and asked * row_bytes > MOVED_BYTES
    apart = wide and asked == queries.agg(F.count_distinct("query_id").alias("n")).first().n
    if not apart:
        asking = asking.repartition(query_parts(spark, asked, rows), "query_id").sortWithinPartitions("query_id")
    read, read_features = batch_rows(4 * dim), batch_rows(row_bytes, READ_BYTES)

    def run(batches):
        for table in key_blocks(batches, "query_id", rows if apart else 2 * rows):
            units, ids, _ = asked_units(table, dim)
            if not len(ids):
                continue
            order = np.argsort(ids, kind="stable")
            units, ids = units[order], ids[order]
            row, images, scores = search_stored(units, ids, corpus, wanted, dim, False, False, read).entries()
            if (ids[1:] == ids[:-1]).any():
                chosen, _ = best_of_each(ids[row], images, scores, wanted)
                row, images, scores = row[chosen], images[chosen], scores[chosen]
            asked_ids, found = ids[row], {"embed": scores}
            found |= _pair_scores(asked_ids, images, table, held, metrics, hsv_dim, legacy_dim, read_features)
            yield fused(asked_ids, images, found, weights, k)

    return asking.mapInArrow(run, FUSED)


def _pair_scores(asked, images, table, held, metrics, hsv_dim, legacy_dim, rows) -> dict:
    """The cosine of every pair (asked, image) in each metric, 0 where there is none."""
    found = {m: np.zeros(len(asked)) for m in METRICS[1:]}
    if not metrics or not len(asked):
        return found
    own, first = np.unique(table["query_id"].to_numpy(), return_index=True)
    place = first[np.searchsorted(own, asked)]
    queries = {m: table[f"{m}_vector"].combine_chunks() for m in metrics}
    order = np.argsort(images, kind="stable")
    names, starts = np.unique(images[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    for batch in held.batches(["image_id", *[f"{m}_vector" for m in metrics]], rows):
        ids = batch.column("image_id").to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(names, ids), len(names) - 1)
        met = np.flatnonzero(names[at] == ids)
        size = (ends - starts)[at[met]]
        pairs = order[np.repeat(starts[at[met]], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]
        image_rows = np.repeat(met, size)
        for m in metrics:
            column = batch.column(f"{m}_vector")
            column = padded(column, legacy_dim, hsv_dim) if m == "hsv" else column
            found[m][pairs] = np.nan_to_num(pair_cosine(queries[m], column, place[pairs], image_rows), nan=0.0)
    return found


def padded(column: pa.Array, old: int, full: int) -> pa.Array:
    """``V.pad_legacy`` of a list column."""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    if np.isin(lengths, (full, -1)).all():
        return column
    known = np.isin(lengths, (full, old))
    values = column.take(pa.array(np.flatnonzero(known))).flatten()
    values = values.fill_null(float("nan")).to_numpy(zero_copy_only=False)
    flat = np.zeros((known.sum(), full), values.dtype)
    flat[np.arange(full) < lengths[known, None]] = values
    ends = np.concatenate([[0], np.cumsum(known * full)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(flat.ravel()), mask=pa.array(~known))


FUSED = "query_id long, rank int, image_id long, score double, s_embed double, s_hsv double, s_hog double"


def fused(asked: np.ndarray, images: np.ndarray, scores: dict, weights: dict, k: int) -> pa.RecordBatch:
    """``fuse`` of the candidates of some queries, whose rows stand together."""
    starts = np.flatnonzero(np.append(True, asked[1:] != asked[:-1]))[:len(asked)]
    size = np.diff(np.append(starts, len(asked)))
    mixed, parts = np.zeros(len(asked)), {}
    for m in METRICS:
        value = scores[m]
        with np.errstate(invalid="ignore", divide="ignore"):
            low = np.minimum.reduceat(value, starts) if len(starts) else value
            span = (np.maximum.reduceat(value, starts) if len(starts) else value) - low
            good = np.isfinite(span) & (span >= 1e-12)
            parts[m] = np.where(np.repeat(good, size), (value - np.repeat(low, size)) / np.repeat(span, size), 0.0)
        mixed = mixed + weights.get(m, 0.0) * parts[m]
    mixed = mixed / max(1e-8, sum(weights.get(m, 0.0) for m in METRICS))
    # Tied mixes differ by rounding noise only; cut it off so that ids decide.
    value, kept = np.round(mixed, 12), np.arange(len(asked))
    if len(size) and size.min() == size.max() > k:  # what is below a query's k-th best need not be sorted
        table = value.reshape(len(size), -1)
        kept = np.flatnonzero(table >= np.partition(table, table.shape[1] - k, axis=1)[:, -k, None])
    order, rank = best_of_each(asked[kept], images[kept], value[kept], k)
    order = kept[order]
    return pa.RecordBatch.from_arrays(
        [pa.array(asked[order], pa.int64()), pa.array(rank, pa.int32()), pa.array(images[order], pa.int64()),
         *[pa.array(x[order], pa.float64()) for x in (mixed, *parts.values())]],
        names=["query_id", "rank", "image_id", "score", *[f"s_{m}" for m in METRICS]])


def rescaled(raw: DataFrame, columns) -> DataFrame:
    """Each score column rescaled to [0, 1] over the rows of one query. A NaN
    anywhere, a constant or an infinite range makes the column 0 for that query."""
    group = Window.partitionBy("query_id")
    return raw.withColumns({
        c: V.min_max(F.col(c), F.min(c).over(group), F.max(c).over(group),
                     F.max(F.isnan(c)).over(group))
        for c in columns})


def fuse(raw: DataFrame, weights: dict, k: int) -> DataFrame:
    """Rescale, mix by weight and keep the k best per query. Rescaling and ranking
    share one shuffle by ``query_id``."""
    parts = [f"s_{m}" for m in METRICS]
    scored = rescaled(raw, parts).withColumn(
        "score", V.weighted_mean({m: F.col(f"s_{m}") for m in METRICS}, weights))
    # Tied mixes differ by rounding noise only; cut it off so that ids decide.
    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 12)), F.asc("image_id"))
    return (scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "image_id", "score", *parts))
