"""Exact order statistics of a numeric column, without a sort or a sketch."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Parts that a range of values is counted in; as many rows at most reach the driver a round.
PARTS = 1024


def value_at(rows: DataFrame, column: str, rank: int) -> float:
    """The value of rank ``rank`` (from 1) among those of ``column``, which holds no null and no NaN.

    The range that holds it is parted evenly and counted anew until it is one value; each round leaves
    one part of it, with its own ends. ``rows`` is read once a round: hand in a written table.
    """
    value = F.col(column)
    low, high = rows.agg(F.min(value), F.max(value)).first()
    while low < high:
        part = F.least(F.floor((value - F.lit(low)) / F.lit(high - low) * PARTS), F.lit(PARTS - 1))
        counted = rows.where(value.between(low, high)).groupBy(part.alias("part")).agg(
            F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")).collect()
        for r in sorted(counted, key=lambda r: r["part"]):
            if rank <= r["n"]:
                low, high = r["low"], r["high"]
                break
            rank -= r["n"]
    return low
