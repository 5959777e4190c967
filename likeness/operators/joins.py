"""Join of many rows to a table with a unique key, safe against hot keys."""

from pyspark.sql import DataFrame, functions as F

from likeness.session import broadcast_if_small, reduce_to

# A key with more rows than this on the many side is cut into parts.
HOT_ROWS = 1_000_000


def lookup(facts: DataFrame, table: DataFrame, key: str, spread: str, how: str = "inner",
           hot_rows: int = HOT_ROWS) -> DataFrame:
    """``facts`` with the columns of ``table`` for their key.

    When the keys asked for are few (checked), they are broadcast and the table
    is reduced where it lies. Otherwise both sides are shuffled once; a key that holds
    more than ``hot_rows`` facts is cut by the hash of ``spread`` into parts and
    its single table row copied to each part. At most facts / hot_rows keys can be
    that hot, so the table of hot keys stays small. The facts are read several
    times and should be a table.
    """
    needed = reduce_to(table, facts, key, 64)
    hot = broadcast_if_small(
        facts.groupBy(key).count().where(F.col("count") > hot_rows)
        .select(key, F.ceil(F.col("count") / hot_rows).alias("_parts")), 64)
    parts = F.coalesce("_parts", F.lit(1).cast("long"))
    cut = (facts.join(hot, key, "left")
           .withColumn("_part", F.pmod(F.xxhash64(spread), parts)).drop("_parts"))
    copied = (needed.join(hot, key, "left")
              .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
              .drop("_parts"))
    return cut.join(copied, [key, "_part"], how).drop("_part")
