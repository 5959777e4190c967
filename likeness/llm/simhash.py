"""SimHash near-duplicates by a grid join of segment bit counts.

A fingerprint is cut into 32 segments of two bits; its embedding is the number of set bits
in each. The Manhattan distance of two embeddings never exceeds the Hamming distance of the
fingerprints. Fingerprints within two bits differ in at most two of five groups of segments,
so they share the grid cell of at least one choice of three groups: the range join is an
equi-join of cells, filtered by Manhattan distance, then by the exact distance.

Equal fingerprints are one row before any join. A cell with very many fingerprints is not
joined with itself: there each fingerprint is linked to the 65 values within one bit of it;
two fingerprints are within two bits exactly when they meet in such a value, and at most
65 fingerprints meet in one.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from likeness.llm.components import components
from likeness.llm.text import map_text
from likeness.session import broadcast_if_small, materialise

LOW = 0x5555555555555555
GROUPS = ((0, 7), (7, 14), (14, 20), (20, 26), (26, 32))  # of segments
CELL_ROWS = 256


def fingerprint(words: list[bytes], width: int) -> list[bytes]:
    """The shingles of a text's words."""
    if len(words) < width:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[k:] for k in range(width)))))


def fingerprints(docs: DataFrame, text: str = "text", width: int = 3, seed: int = 42, keep=None) -> DataFrame:
    """``docs`` with ``fp``, the 64-bit SimHash of each whole text as a signed integer.

    Words are parted by blanks and the controls U+0009 to U+000D, A-Z in lower case. Texts
    with fewer than ``width`` words are one shingle; null, empty and blank texts have 0.
    """
    def make():
        from xxhash import xxh64_digest
        def kernel(texts):
            hashes, rows = [], [0]
            for t in texts.cast(pa.large_binary()).to_pylist():
                shingles = fingerprint(t.lower().split(), width)
                hashes.append(b"".join([xxh64_digest(s, seed) for s in shingles]))
                rows.append(rows[-1] + len(shingles))
            values = np.frombuffer(b"".join(hashes), np.uint8).reshape(-1, 8)
            n = np.diff(rows)
            votes = np.zeros((len(n), 64), np.int64)
            for start in range(0, len(n), 256):  # unpacked bits of a few texts at a time
                part = np.flatnonzero(n[start:start + 256]) + start
                if len(part):
                    first = rows[part[0]]
                    bits = np.unpackbits(values[first:rows[part[-1] + 1]], axis=1)
                    votes[part] = np.add.reduceat(bits, np.array(rows)[part] - first, axis=0, dtype=np.int64)
            set_ = np.packbits(2 * votes > n[:, None], axis=1)
            return [set_.view(">u8").ravel().astype(np.uint64).view(np.int64)]
        return kernel

    return map_text(docs, make, "fp bigint", text, keep)


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def cell_masks() -> list[int]:
    spans = [sum(3 << (2 * s) for s in range(*g)) for g in GROUPS]
    return [signed(sum(c)) for c in itertools.combinations(spans, 3)]


def embedded(fp):
    """Set bits of each two-bit segment, packed as 32 counts of two bits."""
    right = F.shiftrightunsigned(fp, 1)  # sums of two bits without a carry: both set, or one of them
    two, one = fp.bitwiseAND(right).bitwiseAND(F.lit(LOW)), fp.bitwiseXOR(right).bitwiseAND(F.lit(LOW))
    return F.shiftleft(two, 1).bitwiseOR(one)


def manhattan(x):
    """Distance of two packed embeddings from their exclusive or (counts are 0, 1 or 2)."""
    low = x.bitwiseAND(F.lit(LOW))
    high = F.shiftrightunsigned(x, 1).bitwiseAND(F.lit(LOW)).bitwiseAND(F.bitwise_not(low))
    return F.bit_count(low) + 2 * F.bit_count(high)


def near_links(values: DataFrame, most: int = 2, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints ``fp`` within ``most`` (0 to 2) bits."""
    masks = cell_masks()
    cells = values.select("fp", embedded(F.col("fp")).alias("e")).select(
        "fp", "e", F.posexplode(F.array(*[F.col("e").bitwiseAND(F.lit(m)) for m in masks])).alias("k", "cell"))
    sizes = cells.groupBy("k", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    filled = materialise(cells.join(sizes, ["k", "cell"]), "cells")
    calm = filled.where(F.col("n") <= cell_rows).select("k", "cell", "fp", "e")
    x = F.col("l.e").bitwiseXOR(F.col("r.e"))
    first = F.coalesce(*[F.when(x.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(masks)])
    pairs = calm.alias("l").join(calm.alias("r"), (F.col("l.k") == F.col("r.k")) & (F.col("l.cell") == F.col("r.cell"))
                                 & (F.col("l.fp") < F.col("r.fp")) & (manhattan(x) <= most)
                                 & (F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= most)
                                 & (first == F.col("l.k")))
    links = pairs.select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))
    hot = filled.where(F.col("n") > cell_rows).select("fp").distinct()
    # within two bits: a value one bit away from both; within one bit: a value of theirs
    flips = [signed(1 << i) for i in range(64)] if most else []
    reach = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(f)) for f in flips]
    balls = hot.select("fp", F.explode(F.array(*reach)).alias("ball"))
    if most == 1:  # of two values in a ball, one must be its centre
        balls = balls.join(hot.select(F.col("fp").alias("ball")), "ball", "left_semi")
        stars = balls.where("fp <> ball").select(F.col("fp").alias("a"), F.col("ball").alias("b"))
    else:
        stars = balls.groupBy("ball").agg(F.collect_set("fp").alias("all")).where(F.size("all") > 1).select(
            F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a <> b")
    return links.union(stars).distinct()


def with_roots(prints: DataFrame, least, most: int = 2, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(fp, least, root) of every distinct fingerprint; ``least`` is aggregated over its rows."""
    if not 0 <= most <= 2:
        raise ValueError("the five groups of segments prove links of at most two bits")
    values = materialise(prints.groupBy("fp").agg(least.alias("least")), "values")
    roots = components(near_links(values.select("fp"), most, cell_rows))
    return values.join(roots, values.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_: str = "doc_id", text: str = "text", width: int = 3,
                    most: int = 2, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(id, fp, component_id) per row of ``docs``; component_id is the smallest id reachable
    by links of at most ``most`` differing bits, itself included.

    Texts without words have fingerprint 0 and link like any other. Rows with a null id
    link and get the component of their fingerprint, but are never its name; a component of
    such rows alone is named null. Repeated rows stay.
    """
    prints = materialise(fingerprints(docs, text, width, keep=[id_]), "prints")
    rooted = with_roots(prints, F.min(id_), most, cell_rows)
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id")
    return prints.join(named, "fp", "left").select(id_, "fp", "component_id")


def one_of_each(docs: DataFrame, id_: str = "doc_id", text: str = "text", width: int = 3, most: int = 2) -> DataFrame:
    """One row of ``docs`` per component: that of the smallest id, null last, then of the smallest text hash.

    A row is known by its id and a 64-bit hash of its text, so rows that share an id or have none
    are told apart; of rows alike in both one stays. The rows to drop, fewer than those to keep,
    are sent to the texts when their counted size allows; otherwise both sides are shuffled.
    """
    own = F.xxhash64(F.col(text).cast("string"))
    prints = materialise(fingerprints(docs.select(F.col(id_).alias("__id"), F.col(text), own.alias("__own")), text, width,
                                      keep=["__id", "__own"]), "prints")
    rooted = with_roots(prints, F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__own")), most)
    names = rooted.groupBy("root").agg(F.min("least").alias("name"))
    named = rooted.join(names, "root").select("fp", "name")
    kept = F.col("__id").eqNullSafe(F.col("name.__id")) & (F.col("__own") == F.col("name.__own"))
    marks = materialise(prints.join(named, "fp").withColumn("kept", kept).groupBy("__id", "__own").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")), "kept")
    dropped = marks.where(~F.col("kept")).select(F.col("__id").alias("__dropped"), F.col("__own").alias("__text"))
    out = docs.withColumn("__own", own).join(broadcast_if_small(dropped, 32), F.col(id_).eqNullSafe(F.col("__dropped")) & (
        F.col("__own") == F.col("__text")), "left_anti")
    repeated = not marks.where("kept AND n > 1").isEmpty()
    return (out.dropDuplicates([id_, "__own"]) if repeated else out).drop("__own")


def op4(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
