"""Merkle manifest of a table: one digest a row, one a group, one for all, and a proof for every row.

Rows are leaves. The leaves of a group, in order, are hashed two by two, level by level, to the
group's root; the groups' roots likewise to the root of the table. Of a tree only every few
levels are written (``BAND``): the leaves, the nodes above each aligned run of 2**BAND of them,
and so on. Proofs go the other way, from the top: each aligned subtree is rebuilt from the
stored nodes below it, hands every one of them its siblings inside the subtree, followed by
those of the subtree's own top, and is forgotten. Everything is DataFrame functions; a task
holds one subtree at a time, and no row of the driver's depends on the number of leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from likeness.session import broadcast_if_small, materialise

# Levels between two stored ones.
BAND = 8
# Bytes a row of counts (group and part) is taken to have.
COUNT_BYTES = 128
SIBLING = "struct<side:int,digest:string>"  # side -1: left of the node, 1: right of it, 0: the node is alone


def field(value: Column) -> Column:
    """One value as it enters the leaf: its UTF-8 byte count, a colon and the value, or a dash for null."""
    value = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(columns, more: str | None = None) -> Column:
    """The digest of a row; ``more`` names a number to which one is added."""
    values = [F.col(f"`{c}`") + 1 if c == more else F.col(f"`{c}`") for c in columns]
    return F.sha2(F.concat(*map(field, values)), 256)


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``__pos``, from 0 in each group by ``order`` (nulls first), and ``__n``, the group's rows.

    The rows are range-partitioned, so a group with most of the rows is many parts; what the
    parts before hold of the same group is one number a part and group.
    """
    order = [F.col(f"`{c}`").asc_nulls_first() for c in order]
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    ranged = materialise(rows.repartitionByRange(parts, F.col(f"`{group}`").asc_nulls_first(), *order)
                         .withColumn("__part", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy(F.col(f"`{group}`").alias("__g"), F.col("__part").alias("__p")).agg(F.count(F.lit(1)).alias("__c"))
    mine = Window.partitionBy("__g")
    starts = materialise(counts.select(
        "__g", "__p", (F.sum("__c").over(mine.orderBy("__p")) - F.col("__c")).alias("__start"),
        F.sum("__c").over(mine).alias("__n")), "starts")
    inside = Window.partitionBy("__part", f"`{group}`").orderBy(*order)
    same = F.col(f"`{group}`").eqNullSafe(F.col("__g")) & (F.col("__part") == F.col("__p"))
    return (ranged.withColumn("__nth", F.row_number().over(inside) - 1)
            .join(broadcast_if_small(starts, COUNT_BYTES), same)
            .withColumn("__pos", F.col("__start") + F.col("__nth")).drop("__g", "__p", "__part", "__start", "__nth"))


def height(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return F.when(n <= 1, 0).otherwise(F.length(F.bin(n - 1)))


def parents(nodes: Column) -> Column:
    """The level above ``nodes`` (an array): every two neighbours hashed, a last single one alone."""
    return F.transform(
        F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int")),
        lambda i: F.sha2(F.concat(F.get(nodes, i * 2), F.coalesce(F.get(nodes, i * 2 + 1), F.lit(""))), 256))


def some(steps: Column) -> Column:
    """The array 0, 1, ... steps - 1, of at most BAND numbers."""
    return F.filter(F.sequence(F.lit(0), F.lit(BAND - 1)), lambda k: k < steps)


def top(nodes: Column, steps: Column) -> Column:
    """The node ``steps`` levels above all of ``nodes``; no level between is kept."""
    return F.get(F.aggregate(some(steps), nodes, lambda level, _: parents(level)), F.lit(0))


def siblings(nodes: Column, steps: Column) -> Column:
    """For every one of ``nodes`` the array of its siblings, level by level, ``steps`` levels up."""
    levels = F.aggregate(some(steps), F.array(nodes),
                         lambda kept, _: F.concat(kept, F.array(parents(F.element_at(kept, -1)))))

    def sibling(kept, j, k):
        at = F.call_function("shiftright", j, k)
        other = F.get(F.get(kept, k), F.when(at % 2 == 0, at + 1).otherwise(at - 1))
        side = F.when(other.isNull(), 0).when(at % 2 == 0, 1).otherwise(-1)
        return F.struct(side.alias("side"), F.coalesce(other, F.lit("")).alias("digest"))

    # the levels are bound as a variable, so they are made once a subtree and not once a node
    return F.get(F.transform(F.array(levels), lambda kept: F.transform(
        F.sequence(F.lit(0), F.size(F.get(kept, F.lit(0))) - 1),
        lambda j: F.transform(some(steps), lambda k: sibling(kept, j, k)))), F.lit(0))


def stored_levels(leaves: DataFrame, keep: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """(written bands from the leaves up, (__group, __root)). ``leaves``: ``__group, __pos, __n, __node`` and ``keep``.

    A band row is one aligned run of at most 2**BAND nodes: ``__group, __block, __n, __steps, __items``."""
    bands, level, k = [], leaves, 0
    while True:
        level = level.withColumn("__steps", F.greatest(F.lit(0), F.least(F.lit(BAND), height(F.col("__n")) - k * BAND)))
        item = F.struct(F.col("__pos").alias("pos"), F.col("__node").alias("node"), *(keep if k == 0 else []))
        band = materialise(
            level.groupBy("__group", F.shiftright("__pos", BAND).alias("__block"), "__n", "__steps")
            .agg(F.sort_array(F.collect_list(item)).alias("__items")), "band")
        bands.append(band)
        level = band.select("__group", F.col("__block").alias("__pos"), "__n",
                            top(F.col("__items.node"), F.col("__steps")).alias("__node"))
        highest = band.agg(F.max(height(F.col("__n")))).first()[0] or 0
        k += 1
        if highest <= k * BAND:
            return bands, level.select("__group", F.col("__node").alias("__root"))


def with_siblings(leaves: DataFrame, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """((__group, __node, __path, keep...) a leaf, (__group, __root) a group): ``__path`` are the siblings up to the root.

    ``__group`` is an integer. Going down, a band row meets the path of its own top node: one
    row of 2**BAND leaves, not one a leaf, is joined."""
    bands, roots = stored_levels(leaves, keep)
    above = None
    for k in range(len(bands) - 1, -1, -1):
        if above is None:
            band = bands[k].withColumn("__above", F.array().cast(f"array<{SIBLING}>"))
        else:
            band = bands[k].join(above, ["__group", "__block"])
        inner = siblings(F.col("__items.node"), F.col("__steps"))
        made = band.select("__group", "__above", F.explode(F.arrays_zip(
            F.col("__items").alias("item"), inner.alias("inner"))).alias("one")).select(
            "__group", F.col("one.item").alias("item"), F.concat("one.inner", "__above").alias("__path"))
        above = made.select("__group", F.col("item.pos").alias("__block"), F.col("__path").alias("__above"))
    return made.select("__group", F.col("item.node").alias("__node"), "__path",
                       *[F.col(f"item.{c}").alias(c) for c in keep]), roots


def folded(start: Column, path: Column) -> Column:
    """The root that ``start`` leads to along the siblings of ``path``."""
    return F.aggregate(path, start, lambda node, s: F.sha2(F.concat(
        F.when(s["side"] < 0, s["digest"]).otherwise(F.lit("")), node,
        F.when(s["side"] > 0, s["digest"]).otherwise(F.lit(""))), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: s["digest"])), 256)


def manifest(docs: DataFrame, group: str = "lang", order: str = "doc_id",
             columns=("doc_id", "source", "lang", "n_chars", "text"), claimed: Column | None = None) -> DataFrame:
    """(order column, leaf, subroot, root, path, claimed) for every row of ``docs``.

    A leaf is the SHA-256 of ``columns``, each spelt by ``field``: null and empty values differ,
    texts of any length are hashed whole. Leaves of a group ascend by ``order`` (null first), ties
    by leaf, so the root depends on the rows alone; equal rows are equal leaves, each with a
    proof of its own. The null group is a group, the first one; others follow bytewise. No
    rows, no manifest: the result is empty. ``path`` holds the siblings from the leaf up,
    first to the subroot, then to the root; ``claimed`` is the given expression over a row's columns, a
    leaf to fold in place of the real one. Columns beside ``columns`` have no part in it.
    """
    own = leaf(columns)
    # the salt parts equal rows into several ranges; they are interchangeable
    rows = materialise(docs.select(
        F.col(f"`{group}`").alias("lang"), F.col(f"`{order}`").alias("id"), own.alias("__node"),
        (own if claimed is None else F.coalesce(claimed, own)).alias("claimed"), F.monotonically_increasing_id().alias("salt")), "leaves")
    rows = numbered(rows, "lang", ["id", "__node", "salt"]).drop("salt")
    groups = rows.groupBy("lang").agg(F.max("__n").alias("leaves"))
    groups = numbered(groups.withColumn("all", F.lit(0)), "all", ["lang"])
    groups = materialise(groups.select("lang", F.col("__pos").alias("__group"), F.col("__n").alias("groups")), "groups")
    leaves = rows.alias("r").join(broadcast_if_small(groups.alias("g"), COUNT_BYTES),
                                  F.col("r.lang").eqNullSafe(F.col("g.lang"))).select(
        "__group", "__pos", "__n", "__node", "id", "claimed")
    own, subroots = with_siblings(leaves, ["id", "claimed"])
    subroots = subroots.join(groups.select("__group", "groups"), "__group").select(
        F.lit(0).cast("bigint").alias("__group"), F.col("__group").alias("__pos"), F.col("groups").alias("__n"),
        F.col("__root").alias("__node"), F.col("__group").alias("of"))
    tops, root = with_siblings(subroots, ["of"])
    tops = materialise(tops.crossJoin(F.broadcast(root.select("__root"))).select(
        F.col("of").alias("__group"), F.col("__node").alias("subroot"), F.col("__root").alias("root"),
        F.col("__path").alias("outer")), "subroots")
    return own.join(broadcast_if_small(tops, 1024), "__group").select(
        F.col("id").alias(order), F.col("__node").alias("leaf"), "subroot", "root",
        F.concat("__path", "outer").alias("path"), "claimed")


def op13(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = manifest(docs, columns=columns, claimed=F.when(tampered, leaf(columns, more="n_chars")))
    end = folded(F.col("claimed"), F.col("path"))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                       end.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
