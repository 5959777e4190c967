"""Exact row selections that never move whole rows through one task."""

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

from likeness.session import materialise

# Below this many rows the smallest keys are picked without a first cut.
SMALL_TABLE = 1_000_000
# So many keys may be sorted in one task.
HEAD_ROWS = 200_000
HASH_RANGE = 1 << 60


def sample_hash(key, seed: int):
    """60 uniform bits from md5 of seed and key, the same under any partitioning."""
    text = F.concat(F.lit(f"{seed}:"), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def uniform_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``min(n, rows)`` rows without replacement, repeatable for a seed.

    The rows with the n smallest (hash, key) pairs. Only such pairs are sorted,
    after a first cut at the hash value that about n rows stay below; the table
    itself is then filtered by the pair found, without any shuffle.
    """
    rows = df.count()
    if rows <= n:
        return df
    if n <= 0:
        return df.where(F.lit(False))
    pairs = df.select(sample_hash(F.col(key), seed).alias("h"), F.col(key).alias("k"))
    cut = HASH_RANGE if rows <= SMALL_TABLE else min(
        HASH_RANGE, int(HASH_RANGE * (1.2 * n + 1000) / rows))
    last = _nth(pairs.where(F.col("h") < cut), n, "h", "k")
    if last is None:
        last = _nth(pairs, n, "h", "k")
    h = sample_hash(F.col(key), seed)
    return df.where((h < last.h) | ((h == last.h) & (F.col(key) <= last.k)))


def _nth(keys: DataFrame, n: int, *order):
    """The n-th smallest key, or None when there are fewer rows. Beyond HEAD_ROWS the keys
    are range-partitioned and only the part that holds the n-th one is searched."""
    if n > HEAD_ROWS:
        rows = keys.count()
        if rows < n:
            return None
        parts = max(2, min(10_000, -(-rows // HEAD_ROWS) * 2))
        ranged = materialise(keys.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "keys")
        for row in sorted(ranged.groupBy("_part").count().collect()):  # one row a part
            if n <= row["count"]:
                return _nth(ranged.where(F.col("_part") == row["_part"]).drop("_part"), n, *order)
            n -= row["count"]
    head = keys.orderBy(*order).limit(n)
    row = head.agg(F.count(F.lit(1)).alias("n"), F.max(F.struct(*order)).alias("last")).first()
    return row["last"] if row["n"] == n else None


def first_n(df: DataFrame, key: str, n: int | None) -> DataFrame:
    """The n rows with the smallest unique keys; None means all, 0 means none."""
    if n is None:
        return df
    if n <= 0:
        return df.where(F.lit(False))
    rows = df.count()
    if rows <= n:
        return df
    keys = df.select(F.col(key).alias("k"))
    last = None
    if rows > SMALL_TABLE:
        # About 10,000 sampled keys tell below which key n rows surely lie.
        seen = [r.k for r in keys.sample(10_000 / rows, seed=1).orderBy("k").collect()]
        place = int(1.2 * n / rows * len(seen)) + 100
        if place < len(seen):
            last = _nth(keys.where(F.col("k") <= F.lit(seen[place])), n, "k")
    if last is None:
        last = _nth(keys, n, "k")
    return df.where(F.col(key) <= F.lit(last.k))


def number_rows(df: DataFrame, key: str, name: str = "row_number",
                rows_per_bucket: int = 1_000_000) -> DataFrame:
    """Global 1-based position in the order of a unique integer key.

    The key range is cut at quantiles into buckets; positions are counted inside
    each bucket in parallel and shifted by the sizes of the buckets before. The
    cuts are literals, so counting and numbering see the same buckets.
    """
    rows = df.count()
    buckets = max(min(-(-rows // rows_per_bucket), 10_000),
                  min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // 1000)))
    cuts = []
    if buckets > 1:
        shares = [i / buckets for i in range(1, buckets)]
        cuts = sorted(set(df.approxQuantile(key, shares, 1 / (4 * buckets))))
    if cuts:
        # Binary search on the JVM. Doubles order 63-bit keys correctly, only keys
        # closer than their precision always share a bucket.
        finder = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="_at",
                            outputCol="_bucket", handleInvalid="keep")
        placed = finder.transform(df.withColumn("_at", F.col(key).cast("double"))).drop("_at")
    else:
        placed = df.withColumn("_bucket", F.lit(0.0))
    sizes = placed.groupBy("_bucket").count()
    # One row per bucket, at most 10,000 of them.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("_bucket").orderBy(key)
    return (placed.join(F.broadcast(shifts), "_bucket")
            .withColumn(name, F.row_number().over(inside) + F.col("_shift"))
            .drop("_bucket", "_shift"))


def paginate(df: DataFrame, key: str, page_rows: int) -> DataFrame:
    """Adds ``page``, counted from 0, for pages of ``page_rows`` in key order."""
    return (number_rows(df, key, "_row")
            .withColumn("page", F.floor((F.col("_row") - 1) / page_rows).cast("long"))
            .drop("_row"))
