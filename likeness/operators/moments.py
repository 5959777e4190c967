"""Principal axes from moments that are stored and continued.

Count, mean and scatter of disjoint sets of vectors add up (Chan, Golub and LeVeque 1979), so
a corpus that grows is not read again: each batch adds its own moments to the stored ones, and
the axes follow from the sum. The state is one row a dimension, whatever the number of vectors.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from likeness.operators.analysis import Projection, covariance, valid_vectors
from likeness.operators.nearest import common_dim
from likeness.sources.commits import CommitLog

STATE = "i int, mean double, scatter array<double>"


@dataclass(frozen=True)
class Moments:
    """``scatter``: sums of products of the differences from the mean."""
    n: int
    mean: np.ndarray
    scatter: np.ndarray

    def merged(self, other: "Moments") -> "Moments":
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        step = other.mean - self.mean
        return Moments(n, self.mean + step * (other.n / n),
                       self.scatter + other.scatter + np.outer(step, step) * (self.n * other.n / n))

    def axes(self, dims: int) -> Projection:
        """The ``dims`` axes of most variance; each points so that its largest loading is positive."""
        values, columns = np.linalg.eigh(self.scatter)
        order = np.argsort(-values)[:dims]
        rows, values = columns.T[order], np.maximum(values, 0.0)
        largest = rows[np.arange(len(rows)), np.abs(rows).argmax(axis=1)]
        return Projection(self.mean, rows * np.where(largest < 0, -1.0, 1.0)[:, None], values[order] / max(values.sum(), 1e-300))


def moments_of(vectors: DataFrame, dim: int) -> Moments:
    """Of the valid vectors; ``dim`` rows reach the driver."""
    n = valid_vectors(vectors, dim).count()
    mean, scatter = np.zeros(dim), np.zeros((dim, dim))
    if n:
        table = covariance(vectors, dim).toArrow()
        i, j, cov = (table[c].to_numpy() for c in ("i", "j", "cov"))
        mean[i] = table["mean_i"].to_numpy()
        scatter[i, j] = scatter[j, i] = cov * (n - 1)
    return Moments(n, mean, scatter)


def read_moments(spark: SparkSession, path: str) -> tuple[int, Moments | None]:
    """(commit, state) of the moments stored at ``path``; (0, None) where there are none."""
    number, record = CommitLog(path).latest()
    if not number:
        return 0, None
    table = spark.read.schema(STATE).parquet(f"{path}/{record['state']}").orderBy("i").toArrow()
    scatter = table["scatter"].combine_chunks().flatten().to_numpy().reshape(table.num_rows, table.num_rows)
    return number, Moments(record["n"], table["mean"].to_numpy(), scatter)


def add_batch(spark: SparkSession, path: str, batch: DataFrame, dim: int | None = None) -> Moments:
    """Add the vectors of ``batch`` (``image_id, vector``; none of them added before) to the state at ``path``.

    Only the batch is read. Vectors of another length than the state's, or not finite, are left out. Raises
    ValueError when the first batch holds no valid vector, and ``Conflict`` when another job added one meanwhile."""
    number, held = read_moments(spark, path)
    dim = dim or (len(held.mean) if held else common_dim(batch))
    if dim is None:
        raise ValueError("no valid vectors")
    new = moments_of(batch, dim)
    state = held.merged(new) if held else new
    if not state.n:
        raise ValueError("no valid vectors")
    if held and not new.n:
        return held
    name = f"state-{uuid.uuid4().hex}"
    spark.createDataFrame([(i, float(state.mean[i]), state.scatter[i].tolist()) for i in range(dim)], STATE).coalesce(
        1).write.parquet(f"{path}/{name}")
    CommitLog(path).commit(number, {"state": name, "n": state.n})
    return state
