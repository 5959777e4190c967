"""Shards by balanced label propagation, with DataFrame functions only.

Documents with equal texts are linked. Every document starts in the shard of its id's hash.
In each round the linked documents of a text ask for the shard that holds most bytes of
that text and still has room; a shard takes as many bytes as its quota leaves, decided by a
hash of the text (of the document, where one text alone would fill the room). The quota counts
linked documents only: those without a link cut nothing wherever they are, and even out the
sizes at last. The shard of a document is its label, but for the surplus of a shard: in the order of
linked documents first, what lies beyond an equal share of all bytes is laid in a line and fills
up the shards that are short of theirs. So a text is parted only if it is too large for one
shard, or if linked documents alone overfill one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from likeness.session import materialise

SEED_LABEL, SEED_MOVE = 1, 2


def narrow(docs: DataFrame, id_: str, text: str) -> DataFrame:
    """(id, size, crc, twin): twin is a 64-bit name of the text, the link between copies."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(id_).alias("id"), (F.octet_length(body).cast("long") + 8).alias("size"),
                       F.crc32(body.cast("binary")).alias("crc"), F.xxhash64(body).alias("twin"))


def share(*parts):
    """A number in [0, 1) that depends on the given columns alone."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) / float(1 << 40)


def propagate(rows: DataFrame, shards: int, rounds: int, quota: float) -> DataFrame:
    """``rows`` (id, size, crc, twin) with ``alone`` (1 if no other row has its text) and ``label``, after
    ``rounds`` of moves under a quota of bytes of linked rows."""
    labelled = rows.withColumn("label", F.pmod(F.xxhash64("id", "crc", F.lit(SEED_LABEL)), F.lit(shards)).cast("int"))
    # written, so that the join with a hot text's rows is of two plain shuffles, which Spark can split
    twins = materialise(rows.groupBy("twin").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("twin"), "twins")
    linked = materialise(labelled.join(twins, "twin", "left_semi"), "linked")
    alone = labelled.join(twins, "twin", "left_anti")
    for _ in range(rounds):
        held = linked.groupBy("twin", "label").agg(F.sum("size").alias("bytes"))
        held = materialise(held, "held")
        room = held.groupBy("label").agg((F.lit(quota) - F.sum("bytes")).alias("room"))  # one row a shard
        here = Window.partitionBy("twin")  # at most one row per shard
        most = held.join(F.broadcast(room), "label").withColumn(
            "best", F.max(F.struct(F.col("room") > 0, "bytes", (-F.col("label")).alias("low"))).over(here))
        asks = most.select("twin", F.col("label").alias("source"), "bytes", (-F.col("best.low")).alias("target")).where(
            "source <> target")
        wanted = asks.groupBy("target").agg(F.sum("bytes").alias("asked"))
        leaving = asks.groupBy(F.col("source").alias("label")).agg(F.sum("bytes").alias("leaves"))
        # what asks to leave a shard makes room for what asks to come
        room = room.join(leaving, "label", "left").select(
            "label", (F.col("room") + F.coalesce("leaves", F.lit(0))).alias("room"))
        taken = wanted.join(F.broadcast(room), wanted.target == room.label).select(
            "target", "room", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("room") / F.col("asked"))).alias("p"))
        moves = asks.join(F.broadcast(taken), "target").where("p > 0")
        # a small cell moves whole or not at all; one that alone matters to the quota moves in part
        whole = F.col("bytes") * 50 <= F.col("room")
        moves = materialise(moves.where(~whole | (share("twin", "source", F.lit(SEED_MOVE)) < F.col("p"))).select(
            "twin", F.col("source").alias("label"), "target", F.when(whole, F.lit(1.0)).otherwise(F.col("p")).alias("p")),
            "moves")
        linked = linked.join(moves, ["twin", "label"], "left").withColumn(
            "label", F.when(share("id", "crc", "twin", F.lit(SEED_MOVE)) < F.col("p"), F.col("target")).otherwise(
                F.col("label"))).select(*linked.columns)
        linked = materialise(linked, "linked")
    return linked.select("id", "size", "crc", "twin", F.lit(0).alias("alone"), "label").union(
        alone.select("id", "size", "crc", "twin", F.lit(1), "label"))


def in_line(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``end`` (sum of sizes up to the row) and ``nth`` (from 0) in the given order.

    The order is made by a range partitioning; running sums inside its parts are shifted by
    the sizes of the parts before, one number a part.
    """
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2, 16)
    ranged = materialise(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    shifts = materialise(sums.select("part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes0"),
                                     F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0")), "shifts")
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranged.join(F.broadcast(shifts), "part").withColumn(
        "end", F.col("bytes0") + F.sum("size").over(inside)).withColumn(
        "nth", F.col("n0") + F.count(F.lit(1)).over(inside) - 1)


def even_out(rows: DataFrame, shards: int, quota: float) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``: the label, but for rows beyond ``quota`` bytes of a label.

    These, in order of label, fill what the other shards are short of. All of it follows from one order of
    the rows, in which a label's surplus is the tail of its rows, and from one row a label.
    """
    placed = materialise(in_line(rows, ["label", "alone", "twin", "id", "crc", "size"]), "placed")
    firsts = placed.groupBy("label").agg(F.min("nth").alias("nth0"), F.min(F.col("end") - F.col("size")).alias("end0"))
    # the middle of a row decides
    stays = F.col("end") - F.col("end0") - F.col("size") / 2 <= quota
    placed = placed.join(F.broadcast(firsts), "label").withColumn("stays", stays)
    zero = F.lit(0).cast("long")
    found = {r["label"]: r for r in placed.groupBy("label").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("stays"), F.col("size")).otherwise(zero)).alias("kept"),
        F.count_if("stays").alias("n_kept")).collect()}  # one row a shard
    per_shard, bytes_before, n_before, short = [], 0, 0, 0.0
    for shard in range(shards):
        bytes_, n, kept, n_kept = ([found[shard][c] for c in ("bytes", "n", "kept", "n_kept")] if shard in found else [0] * 4)
        need = max(quota - kept, 0.0)
        per_shard.append((shard, kept, n_kept, bytes_before, n_before, short, short + need))
        bytes_before, n_before, short = bytes_before + bytes_ - kept, n_before + n - n_kept, short + need
    labels = rows.sparkSession.createDataFrame(
        per_shard, "label int, kept long, n_kept long, bytes_before long, n_before long, low double, high double")
    # where a row lies among the surplus, on the scale of what is short
    scale = short / bytes_before if bytes_before else 0.0
    tops = F.array(*[F.lit(p[6]) for p in per_shard[:-1]])
    at = (F.col("bytes_before") + F.col("end") - F.col("end0") - F.col("kept") - F.col("size") / 2) * scale
    goes = F.size(F.filter(tops, lambda top: top <= F.col("at")))
    placed = placed.join(F.broadcast(labels), "label").withColumn("at", at).withColumn(
        "shard", F.when(F.col("stays"), F.col("label")).otherwise(goes)).withColumn(
        "rank", F.col("nth") - F.col("nth0") + F.when(F.col("stays"), zero).otherwise(F.col("n_before") - F.col("n_kept")))
    placed = materialise(placed.select("id", "size", "crc", "twin", "stays", "shard", "rank"), "even")
    # rows that came are numbered after those that stayed
    came = placed.where("NOT stays").groupBy("shard").agg(F.min("rank").alias("first"))  # one row a shard
    stayed = labels.select(F.col("label").alias("shard"), "n_kept")
    return placed.join(F.broadcast(stayed), "shard").join(F.broadcast(came), "shard", "left").withColumn(
        "slot", F.when(F.col("stays"), F.col("rank")).otherwise(F.col("n_kept") + F.col("rank") - F.col("first")))


def shards_of(docs: DataFrame, shards: int = 24, id_: str = "doc_id", text: str = "text",
              rounds: int = 4) -> DataFrame:
    """(id, size, text_crc32, shard, slot) for every row of ``docs``.

    Shards have near equal bytes (a row counts its UTF-8 bytes plus 8): each is off by at
    most two rows' sizes. Slots count the rows of a shard from 0. Null texts
    count as empty, and all empty texts are one group; rows with null or repeated ids are
    rows like others. The result depends on the rows alone, not on how they are partitioned;
    among rows equal in all columns the slots are interchangeable.
    """
    rows = materialise(narrow(docs, id_, text), "narrow")
    quota = (rows.agg(F.sum("size")).first()[0] or 0) / shards
    placed = even_out(propagate(rows, shards, rounds, quota), shards, quota)
    return placed.select(F.col("id").alias(id_), "size", F.col("crc").alias("text_crc32"), "shard", "slot")


def op10(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return shards_of(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                  F.lit(None).cast("int").alias("grown_shard"))
