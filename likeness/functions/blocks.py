"""NumPy kernels on Arrow batches: vector blocks and running best-k lists."""

import numpy as np
import pyarrow as pa

# Score matrices are built in pieces of at most this many cells.
PIECE_CELLS = 2_000_000
# Pairs are scored in double precision so many at a time.
PAIRS = 2048
# Scores equal to this many digits count as tied and are ordered by id.
TIE_DIGITS = 12
LAST_ID = np.iinfo(np.int64).max
LOWEST = np.finfo(np.float32).min


def dense(column, dim):
    """(matrix, rows): the lists of length ``dim`` as float64, and which rows
    they came from. NULL and other lengths are left out."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dim)
    if len(rows) != len(column):
        column = column.take(pa.array(rows))
    values = column.flatten()
    if values.null_count:
        values = values.fill_null(float("nan"))
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(rows), dim), rows


def unit_rows(matrix, keep_zero):
    """(unit matrix, rows kept). Non-finite rows always go; zero rows stay as
    zeros only when asked for."""
    with np.errstate(over="ignore", invalid="ignore"):
        length = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    good = np.isfinite(length)
    if not keep_zero:
        good &= length > 0
    rows = np.flatnonzero(good)
    if len(rows) != len(matrix):
        matrix, length = matrix[rows], length[rows]
    return matrix / np.where(length > 0, length, 1.0)[:, None], rows


def load_units(column, dim, keep_zero):
    matrix, rows = dense(column, dim)
    units, kept = unit_rows(matrix, keep_zero)
    return units, rows[kept]


def thin_copies(units, ids, keep):
    """(units, ids) without copies of one vector beyond its ``keep`` smallest ids.

    Equal vectors have equal scores, so under ties by id no other copy can be among
    the best. This keeps a block that is full of copies as cheap as any other. Rows
    are grouped by one projection; only rows found equal in full are dropped.
    """
    if len(units) <= keep:
        return units, ids
    mark = units @ np.cos(np.arange(units.shape[1]) + 1.0)
    order = np.lexsort((ids, mark))
    starts = np.flatnonzero(np.concatenate([[True], np.diff(mark[order]) != 0]))
    ends = np.append(starts[1:], len(order))
    drop = np.zeros(len(units), bool)
    for g in np.flatnonzero(ends - starts > keep):  # groups of copies only
        group = order[starts[g]:ends[g]]
        same = group[(units[group] == units[group[0]]).all(axis=1)]
        drop[same[keep:]] = True
    return (units[~drop], ids[~drop]) if drop.any() else (units, ids)


def few_true(marks):
    """Places of the true cells of a matrix where few are, eight looked at together."""
    flat = marks.ravel()
    whole = len(flat) // 8 * 8
    cells = (np.flatnonzero(flat[:whole].view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate([cells[flat[cells]], whole + np.flatnonzero(flat[whole:])])


class BestK:
    """The k best (score, id) per query over all blocks seen so far, in no order.

    Ties are ordered by smaller id. A block is first scored in single precision.
    Only cells that can reach the list, given the rounding error of that product,
    are scored again in double precision; once the lists are full these are few.
    """

    def __init__(self, count, k):
        self.k = k
        self.scores = np.full((count, k), -np.inf)
        self.ids = np.full((count, k), LAST_ID, dtype=np.int64)
        # the last entry of each list: the lowest score, and of its ids the largest
        self.worst, self.worst_id = np.full(count, -np.inf), np.full(count, LAST_ID, dtype=np.int64)
        self.rough = np.empty(0, np.float32)  # one piece, kept as new memory costs more than the product

    def offer(self, queries, units, ids, rows=None, own=None):
        """``rows`` names the lists the given queries belong to; ``own`` holds for each
        of them an id that must not be offered. Rows must be distinct."""
        if not len(units) or not len(queries) or not self.k:
            return
        rows = np.arange(len(queries)) if rows is None else rows
        light = np.ascontiguousarray(units.T, np.float32)
        step = max(1, PIECE_CELLS // (len(units) + self.k))
        for start in range(0, len(queries), step):
            part = slice(start, start + step)
            self._piece(queries[part], units, light, ids, rows[part],
                        None if own is None else own[part])

    def _piece(self, queries, units, light, ids, rows, own):
        cells = len(queries) * light.shape[1]
        if cells > len(self.rough):
            self.rough = np.empty(cells, np.float32)
        rough = np.matmul(queries.astype(np.float32), light, out=self.rough[:cells].reshape(len(queries), -1))
        if own is not None:
            order = np.argsort(ids, kind="stable")
            low = np.searchsorted(ids[order], own, "left")
            high = np.searchsorted(ids[order], own, "right")
            for i in np.flatnonzero(high > low):
                rough[i, order[low[i]:high[i]]] = -np.inf
        # No product of two unit rows is further off than this.
        error = (units.shape[1] + 8) * 2.0 ** -23
        worst, worst_id = self.worst[rows], self.worst_id[rows]
        bound = worst - error
        unfilled = np.flatnonzero(np.isneginf(worst))
        if rough.shape[1] > 4 * self.k and len(unfilled):
            kth = np.partition(rough[unfilled], rough.shape[1] - self.k, axis=1)[:, -self.k]
            bound[unfilled] = kth - 2 * error
        # a little lower in single precision; what must not be offered stays below all
        with np.errstate(over="ignore"):
            light_bound = np.nextafter(np.maximum(bound, LOWEST).astype(np.float32), np.float32(-np.inf))
        light_bound = np.maximum(light_bound, LOWEST)[:, None]
        near, col = np.divmod(few_true(rough >= light_bound), rough.shape[1])
        if not len(near):
            return
        if len(near) > rough.size // 20:
            value = (queries @ units.T)[near, col]
        else:
            value = np.empty(len(near))
            for start in range(0, len(near), PAIRS):
                some = slice(start, start + PAIRS)
                np.einsum("ij,ij->i", queries[near[some]], units[col[some]], out=value[some])
        value, name = np.round(value, TIE_DIGITS), ids[col]
        better = (value > worst[near]) | ((value == worst[near]) & (name < worst_id[near]))
        if better.any():
            self._merge(rows, near[better], value[better], name[better])

    def _merge(self, rows, lists, value, name):
        """Put new entries for ``rows[lists]`` into their lists; ``lists`` is sorted."""
        touched, first, counts = np.unique(lists, return_index=True, return_counts=True)
        target, width = rows[touched], int(counts.max())
        scores = np.full((len(touched), self.k + width), -np.inf)
        names = np.full(scores.shape, LAST_ID, dtype=np.int64)
        scores[:, :self.k], names[:, :self.k] = self.scores[target], self.ids[target]
        nth, place = np.repeat(np.arange(len(touched)), counts), self.k + np.arange(len(lists)) - np.repeat(first, counts)
        scores[nth, place], names[nth, place] = value, name
        # the k-th best score of each list; of the entries that have it, those of the smallest ids stay
        worst = np.partition(scores, width, axis=1)[:, width]
        kept, tied = scores > worst[:, None], scores == worst[:, None]
        room = self.k - kept.sum(axis=1)
        many = np.flatnonzero(tied.sum(axis=1) > room)
        if len(many):
            order = np.argsort(np.where(tied[many], names[many], LAST_ID), axis=1, kind="stable")
            # entries that are not tied come last, with empty ones of the same id
            order = np.take_along_axis(order, np.argsort(~np.take_along_axis(tied[many], order, 1), axis=1, kind="stable"), 1)
            at = np.empty_like(order)
            np.put_along_axis(at, order, np.broadcast_to(np.arange(order.shape[1]), order.shape), 1)
            tied[many] &= at < room[many, None]
        kept |= tied
        self.scores[target] = scores[kept].reshape(-1, self.k)
        self.ids[target] = names[kept].reshape(-1, self.k)
        self.worst[target] = worst
        self.worst_id[target] = np.where(tied, names, np.iinfo(np.int64).min).max(axis=1)

    def entries(self):
        """(row, id, score) of all entries, by row."""
        row, col = np.nonzero(self.scores > -np.inf)
        return row, self.ids[row, col], self.scores[row, col]

    def batch(self, query_ids):
        row, ids, scores = self.entries()
        return pa.RecordBatch.from_arrays(
            [pa.array(query_ids[row], pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.float64())],
            names=["query_id", "image_id", "score"])


def best_of_each(owner, ids, scores, k):
    """(order, rank): the k best entries of every owner, by owner and from the best on, numbered from 1."""
    order = np.lexsort((ids, -scores, owner))
    owner = owner[order]
    rank = np.arange(len(owner)) - np.searchsorted(owner, owner) + 1
    return order[rank <= k], rank[rank <= k]
