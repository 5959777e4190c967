"""Merkle manifest against a tree built in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from likeness.llm import merkle
from tests.llm.fixtures import DOCS, SF, no_docs, odd_docs, real_docs, texts

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def slow_leaf(row, more=0):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"]]
    if values[3] is not None:
        values[3] += more
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def slow_tree(nodes):
    """(root, siblings of every leaf, level by level: (left, digest))."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, path in enumerate(paths):
            other = at[k] ^ 1
            path.append((other < at[k], nodes[other]) if other < len(nodes) else (False, ""))
            at[k] //= 2
        nodes = [digest(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def slow_manifest(rows):
    """{(doc_id, leaf): [(subroot, root, siblings)]}."""
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(((row["doc_id"] is not None, row["doc_id"] or 0, slow_leaf(row)), row["doc_id"]))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [slow_tree([key[2] for key, _ in sorted(groups[g])]) for g in order]
    root, outer = slow_tree([t[0] for t in trees])
    out = {}
    for g, (subroot, inner), above in zip(order, trees, outer):
        for (key, doc), path in zip(sorted(groups[g], key=lambda x: x[0]), inner):
            out.setdefault((doc, key[2]), []).append((subroot, root, path + above))
    return out


def check(got, rows):
    want = slow_manifest(rows)
    assert len(got) == len(rows)
    side = {-1: True, 0: False, 1: False}
    for r in got:
        path = [(side[s["side"]], s["digest"]) for s in r["path"]]
        assert (r["subroot"], r["root"], path) in want[r["doc_id"], r["leaf"]]
    assert sorted(map(repr, want)) == sorted({repr((r["doc_id"], r["leaf"])) for r in got})


@pytest.mark.parametrize("band", [1, 2, 8])
def test_manifest(spark, monkeypatch, band):
    monkeypatch.setattr(merkle, "BAND", band)
    both = odd_docs(spark).union(real_docs(spark))
    check(texts(merkle.manifest(both.withColumn("leaf", F.lit("clash")))), texts(both))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 9])
def test_small_trees(spark, monkeypatch, n):
    monkeypatch.setattr(merkle, "BAND", 2)
    docs = spark.createDataFrame([(k, "é" * k, "en", None, k) for k in range(n)], DOCS)
    check(texts(merkle.manifest(docs)), texts(docs))


def test_hot_group_and_repeated_rows(spark):
    docs = spark.range(700).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("same").alias("text"),
                                   F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(4).cast("bigint").alias("n_chars"))
    docs = docs.union(real_docs(spark).select(docs.columns))
    rows = texts(merkle.manifest(docs.repartition(5)))
    check(rows, texts(docs))
    assert {r["root"] for r in rows} == {r["root"] for r in texts(merkle.manifest(docs.repartition(3)))}


def test_proofs_fold_to_the_root_and_find_tampering(spark):
    got = texts(merkle.op13(spark, SF))
    rows = {r["doc_id"]: r for r in texts(real_docs(spark))}
    want = slow_manifest(rows.values())
    assert len(got) == len(rows) and list(got[0]) == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    for r in got:
        [(subroot, root, path)] = want[r["doc_id"], r["leaf"]]
        assert (r["subroot"], r["root"], r["proof_sha256"]) == (subroot, root, digest(*(d for _, d in path)))
        hit = zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
        node = slow_leaf(rows[r["doc_id"]], int(hit))
        for left, other in path:
            node = digest(other, node) if left else digest(node, other)
        assert r["folded_root"] == node and r["verified"] == (node == root)
    assert 0 < sum(not r["verified"] for r in got) < len(got) / 3


def test_no_rows(spark):
    assert merkle.manifest(no_docs(spark)).count() == 0
