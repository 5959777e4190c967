"""Mixing sources to target weights by a time-varying curriculum.

Each source gets a target of words and a weight schedule over the training time 0 to 1. The
integral of the schedule, scaled to the target, is the source's cumulative demand. The
documents of a source are laid one after another in the order of a hash, in passes that follow
each other; the time at which the demand reaches the middle of a document's words in a pass is a
training position, and a document is taken as often as the demand reaches it by time 1. The
documents of all sources are then range-sorted by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from likeness.session import materialise

MOST_TIMES = 3
WORD = r"[^\x20\x09-\x0D]+"
# Steepness of the schedules: source k starts at 1 + TILT * c(k) and ends at 1 - TILT * c(k), c from -1 to 1.
TILT = 0.8
# Documents of one running sum, on average.
BUCKET_ROWS = 50_000
# Parts of the hash that sizes are counted for; a bucket is one or more of them.
FINE_BITS = 14
SEED_ORDER = 11


def words_in(text):
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("bigint")


def targets(sizes: DataFrame, most_times: int = MOST_TIMES) -> DataFrame:
    """(source, source_size, weight, target, tilt), one row a source.

    Sources in code-point order, null last, weigh 1, 2, 3, 1, ... and share all words; a target
    stops at ``most_times`` its source's size and the excess goes to the others by weight. The
    driver only sees two sums a round; each round caps at least one more source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row a source
    rows = materialise(sizes.withColumn("weight", (F.row_number().over(order) - 1) % 3 + 1).withColumn(
        "rank", F.percent_rank().over(order)), "sources")
    level = None  # words per unit of weight of the sources below their cap
    cap = F.col("source_size") * most_times
    while True:
        under = F.lit(True) if level is None else cap > F.col("weight") * F.lit(level)
        sums = rows.agg(F.sum("source_size").alias("all"), F.sum(F.when(under, F.col("weight"))).alias("weight"),
                        F.sum(F.when(~under, cap)).alias("capped")).first()
        new = ((sums["all"] or 0) - (sums["capped"] or 0)) / sums["weight"] if sums["weight"] else 0.0
        if level is not None and (new <= level or not sums["weight"]):
            break
        level = new
    tilt = (1 - 2 * F.col("rank")) * TILT
    return rows.select("source", "source_size", "weight",
                       F.least(cap.cast("double"), F.col("weight") * F.lit(float(level))).alias("target"),
                       tilt.alias("tilt"))


def demand_time(share, tilt):
    """The time at which the demand 1 of schedule 1 + tilt - 2 * tilt * t reaches ``share``.

    The integral of the schedule is (1 + tilt) * t - tilt * t**2; this is its inverse on [0, 1].
    """
    root = F.sqrt(F.greatest((1 + tilt) * (1 + tilt) - 4 * tilt * share, F.lit(0.0)))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * share / (1 + tilt + root)))


def reached(share, tilt):
    """``demand_time``, or null where the demand ends before ``share`` of it."""
    return F.when(share < 1, demand_time(share, tilt))


def mixture(docs: DataFrame, id_: str = "doc_id", source: str = "source", text: str = "text",
            most_times: int = MOST_TIMES, keep=None) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``copies``, ``taken``, ``position`` and ``positions``.

    ``positions`` are the times at which the demand of the source's schedule reaches the middle of a
    document in each of up to ``most_times`` passes, ``copies`` is their number, ``taken`` the words
    times copies, ``position`` the first of them (null if none). The demand at time 1 is the target, so
    a source misses it by less than its largest document. Null and empty texts, or texts
    without words, have size 0 and are taken as often as the running sum says, at no cost. A
    null source is a source of its own, the last one. Rows with null or repeated ids are rows
    like others (rows equal in all columns are interchangeable). The result depends on the rows
    alone. ``keep`` names the columns handed on; columns of the new names are replaced.
    """
    made = ("size", "source_size", "target", "copies", "taken", "position", "positions")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in made]
    order = F.xxhash64(id_, text, F.lit(SEED_ORDER))
    sized = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(id_).alias("__id"),
                        F.col(source).cast("string").alias("__source"), words_in(F.col(text)).alias("size"),
                        order.alias("__order"))
    fine = sized.groupBy("__source", F.shiftrightunsigned("__order", 64 - FINE_BITS).cast("int").alias("__fine")).agg(
        F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
    return laid_out(sized, materialise(fine, "sizes"), kept, most_times)


def laid_out(sized: DataFrame, fine: DataFrame, kept: list[str], most_times: int) -> DataFrame:
    """``fine`` holds words and rows for each source and part of the hash."""
    sizes = fine.groupBy("__source").agg(F.sum("words").alias("source_size"), F.sum("n").alias("n"))
    goals = materialise(targets(sizes.select(F.col("__source").alias("source"), "source_size"), most_times), "targets")
    # running sums start anew in each bucket of the hash: as many as the largest source asks for
    largest = sizes.agg(F.max("n")).first()[0] or 0
    bits = min(max((largest // BUCKET_ROWS).bit_length(), 6), FINE_BITS)
    # a new name for the sources, as nulls never join
    key = F.coalesce(F.concat(F.lit("="), "__source"), F.lit("null"))
    rows = sized.withColumn("__key", key).withColumn("__bucket", F.shiftrightunsigned("__order", 64 - bits).cast("int"))
    sums = fine.withColumn("__key", key).groupBy(
        "__key", F.shiftrightunsigned("__fine", FINE_BITS - bits).alias("__bucket")).agg(F.sum("words").alias("words"))
    before = Window.partitionBy("__key").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)  # buckets only
    shifts = sums.select("__key", "__bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("__start"))
    named = goals.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")).alias("__key"), "source_size", "target",
                         F.col("tilt").alias("__tilt"))
    shifts = shifts.join(named, "__key")
    inside = Window.partitionBy("__key", "__bucket").orderBy("__order", "__id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    run = rows.withColumn("__in", F.sum("size").over(inside)).join(shifts, ["__key", "__bucket"])
    end = F.col("__start") + F.col("__in")
    middle = end - F.col("size") / 2
    # a pass over the source begins where the one before it ended; a source without words has one, at its middle
    passes = F.array(*[F.lit(k) for k in range(most_times)]).cast("array<int>")
    shares = F.when(F.col("source_size") > 0, F.transform(
        passes, lambda k: (middle + k * F.col("source_size")) / F.col("target"))).otherwise(
        F.array(*[F.lit(0.5)][:most_times]).cast("array<double>"))
    times = F.filter(F.transform(shares, lambda x: reached(x, F.col("__tilt"))), lambda t: t.isNotNull())
    return run.withColumn("positions", times).withColumn("copies", F.size("positions")).select(
        *kept, "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"),
        F.get("positions", F.lit(0)).alias("position"), "positions", "__tilt")


def range_sorted(rows: DataFrame, *columns: str, parts: int | None = None) -> DataFrame:
    """``rows`` by ``columns``, nulls last, in parts that follow each other."""
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c).asc_nulls_last() for c in columns]
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)


def ordered(mixed: DataFrame, columns: list[str], parts: int | None = None) -> DataFrame:
    """One row per copy taken, with ``columns`` and its ``position``, range-sorted by position."""
    placed = mixed.select(*columns, F.posexplode("positions").alias("__pass", "__position"))
    return range_sorted(placed, "__position", "__pass", columns[0], parts=parts).withColumnRenamed(
        "__position", "position").drop("__pass")


def in_order(docs: DataFrame, id_: str = "doc_id", source: str = "source", text: str = "text", keep=None) -> DataFrame:
    """Every row of a mix (a document as often as it is taken) with its training ``position``, range-sorted by it.

    A mix that was written and read again has lost its order; it is found anew from the rows alone. The
    schedules and the order of hashes are those of ``mixture``; the repeated rows of a document
    lie in successive passes over its source. Rows equal in all columns are counted before anything
    is shuffled. Null and empty texts have size 0 and a place like others; null ids and sources
    are values; no rows give none. A column named ``position`` is replaced; others are handed on (or those of ``keep``).
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c != "position"]
    columns = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.withColumns({"__m1": F.xxhash64(*columns), "__m2": F.xxhash64(F.lit(SEED_ORDER), *columns)})
    marks = ["__m1", "__m2"]
    counted = materialise(marked.groupBy(*marks).agg(
        F.max(F.col(f"`{source}`").cast("string")).alias("__source"), F.max(words_in(F.col(f"`{text}`"))).alias("size"),
        F.max(F.xxhash64(id_, text, F.lit(SEED_ORDER))).alias("__order"), F.count(F.lit(1)).alias("n")), "counted")
    # the pass comes first in the order: two bits before those of the hash
    passes = counted.withColumn("__pass", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
    order = F.shiftleft(F.least("__pass", F.lit(3)), 62).bitwiseOR(F.shiftrightunsigned("__order", 2))
    key = F.coalesce(F.concat(F.lit("="), "__source"), F.lit("null"))
    rows = passes.select(*marks, "__source", "size", order.alias("__order"), "__pass", key.alias("__key"),
                         F.shiftrightunsigned(order, 64 - FINE_BITS).cast("int").alias("__bucket"))
    sums = materialise(rows.groupBy("__key", "__source", "__bucket").agg(F.sum("size").alias("words")), "sizes")
    total = Window.partitionBy("__key")  # buckets only
    before = total.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    tilts = targets(sums.groupBy(F.col("__source").alias("source")).agg(F.sum("words").alias("source_size")))
    starts = sums.select("__key", "__bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("__start"),
                         F.sum("words").over(total).alias("__all")).join(
        tilts.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")).alias("__key"), F.col("tilt").alias("__tilt")), "__key")
    inside = Window.partitionBy("__key", "__bucket").orderBy("__order", "__pass", *marks).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("__in", F.sum("size").over(inside)).join(starts, ["__key", "__bucket"])
    share = F.when(F.col("__all") > 0, (F.col("__start") + F.col("__in") - F.col("size") / 2) / F.col("__all")).otherwise(F.lit(0.5))
    placed = materialise(placed.select(*marks, demand_time(share, F.col("__tilt")).alias("__position")), "positions")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = marked.dropDuplicates(marks).join(placed, marks)
    return (met.repartitionByRange(parts, "__position", *marks).sortWithinPartitions("__position", *marks)
            .select(*[F.col(f"`{c}`") for c in kept], F.col("__position").alias("position")))


def op9(spark, sf_dir: str) -> DataFrame:
    """One row a document, range-sorted by its first training position; documents not taken come last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mixed = mixture(docs, keep=["doc_id"]).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "position", "positions")
    return range_sorted(materialise(mixed, "mixed"), "position", "doc_id")
