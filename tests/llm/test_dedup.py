"""SimHash, embedding near-duplicates and components against brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from likeness.llm import embedding_dedup, simhash
from likeness.llm.components import components, contract
from tests.llm.fixtures import SF, no_docs, odd_docs, real_docs, texts


def slow_print(text, width=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words)] if 0 < len(words) < width else [
        b" ".join(words[k:k + width]) for k in range(len(words) - width + 1)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(n, linked):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a in range(n):
            for b in range(n):
                if label[b] < label[a] and linked(a, b):
                    label[a], changed = label[b], True
    return label


def test_components(spark):
    draw = np.random.default_rng(1)
    a, b = draw.integers(0, 300, 260), draw.integers(0, 300, 260)
    # a chain, a star, a loop, a repeated link and null ends besides the random links
    a = np.concatenate([a, np.arange(1000, 1100), np.full(200, 2000), [7]])
    b = np.concatenate([b, np.arange(1001, 1101), np.arange(2001, 2201), [7]])
    rows = list(zip(a.tolist(), b.tolist())) + [(1000, 1001), (None, 3), (4, None)]
    got = {r["node"]: r["root"] for r in texts(components(spark.createDataFrame(rows, "a bigint, b bigint")))}
    node, root = contract(a, b)
    assert got == dict(zip(node.tolist(), root.tolist()))
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("cell_rows", [256, 1])
def test_links_of_fingerprints(spark, cell_rows):
    """Both ways to find links, by cells and by values one bit away, miss none and invent none."""
    draw = np.random.default_rng(2)
    values = set(draw.integers(0, 1 << 63, 150).tolist()) | {0, (1 << 63) - 1}
    for v in list(values)[:60]:
        values.add(v ^ 1 << int(draw.integers(0, 63)))
        values.add(v ^ 1 << int(draw.integers(0, 63)) ^ 1 << int(draw.integers(0, 63)))
    values = sorted(values | {simhash.signed(v ^ 1 << 63) for v in list(values)[:20]})
    frame = spark.createDataFrame([(v,) for v in values], "fp bigint")
    for most in (0, 1, 2):
        found = [(r["a"], r["b"]) for r in texts(simhash.near_links(frame, most, cell_rows))]
        near = {(x, y) for i, x in enumerate(values) for y in values[i + 1:]
                if ((x ^ y) & (1 << 64) - 1).bit_count() <= most}
        place = {v: i for i, v in enumerate(values)}

        def joined(pairs):
            a = np.array([place[p[0]] for p in pairs], int)
            return {k: v for k, v in zip(*contract(a, np.array([place[p[1]] for p in pairs], int)))}
        assert joined(found) == joined(near)


def test_fingerprints_and_components(spark):
    docs = odd_docs(spark).union(real_docs(spark).withColumn("doc_id", F.col("doc_id") + 100))
    got = texts(simhash.near_duplicates(docs.withColumn("fp", F.lit("clash"))))
    rows = texts(docs)
    assert sorted(map(str, [(r["doc_id"], r["fp"] & (1 << 64) - 1) for r in got])) == sorted(
        map(str, [(r["doc_id"], slow_print(r["text"])) for r in rows]))
    values = sorted({slow_print(r["text"]) for r in rows})
    label = slow_components(len(values), lambda a, b: (values[a] ^ values[b]).bit_count() <= 2)
    least = {}
    for r in rows:
        k = label[values.index(slow_print(r["text"]))]
        if r["doc_id"] is not None:
            least[k] = min(least.get(k, r["doc_id"]), r["doc_id"])
    for r in got:
        assert r["component_id"] == least.get(label[values.index(r["fp"] & (1 << 64) - 1)])
    assert simhash.near_duplicates(no_docs(spark)).count() == 0


def test_one_of_each(spark):
    out = texts(simhash.one_of_each(odd_docs(spark)))
    assert [r["doc_id"] for r in out].count(3) == 1
    assert {0, 1, 2} & {r["doc_id"] for r in out} == {0}  # texts without a word are one group
    assert (12 in {r["doc_id"] for r in out}) and (13 not in {r["doc_id"] for r in out})
    assert simhash.one_of_each(no_docs(spark)).count() == 0


def test_one_of_each_tells_rows_without_own_id_apart(spark):
    far = ["the quick brown fox jumps over the lazy dog", "completely other words stand in this long line here",
           "nothing of the above is found in what follows now", "a fourth text of its very own kind and making"]
    rows = [(None, far[0]), (None, far[1]), (None, far[1]), (7, far[2]), (7, far[3]), (8, far[3]), (6, far[3])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = [(r["doc_id"], r["text"]) for r in texts(simhash.one_of_each(docs))]
    assert sorted(out, key=str) == sorted([(None, far[0]), (None, far[1]), (7, far[2]), (6, far[3])], key=str)


def brute(rows, radius=0.95):
    """{row: (links, component)} of (id, vector) rows."""
    good = [i for i, (k, v) in enumerate(rows) if k is not None and v and all(
        c is not None and np.isfinite(c) for c in v) and any(v)]
    unit = {i: np.array(rows[i][1], float) / np.linalg.norm(np.array(rows[i][1], float)) for i in good}
    near = {i: [j for j in good if i != j and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= radius] for i in good}
    ids = {i: rows[i][0] for i in range(len(rows))}
    out, comp = {}, {i: i for i in range(len(rows))}
    for i in good:
        for j in near[i]:
            a, b = comp[i], comp[j]
            comp = {k: (a if v == b else v) for k, v in comp.items()}
    for i in range(len(rows)):
        members = [ids[k] for k in comp if comp[k] == comp[i] and ids[k] is not None]
        out[i] = (len(near.get(i, [])), min(members) if members else None)
    return [(ids[i], *out[i]) for i in range(len(rows))]


def cases():
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(size=8).tolist()) for i in range(60)]
    rows += [(100 + i, (np.array(rows[i][1]) * 3 + draw.normal(size=8) * 0.05).tolist()) for i in range(30)]
    rows += [(200 + i, rows[0][1]) for i in range(25)]
    rows += [(300, None), (301, []), (302, [0.0] * 8), (303, [1.0, None] * 4), (304, [float("nan")] * 8),
             (305, [float("inf")] * 8), (306, [1.0, 2.0]), (307, [1.0, 2.0]), (None, rows[0][1]), (308, rows[3][1])]
    return [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]


def test_embeddings_against_brute_force(spark):
    rows = cases()
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<float>, n_links string")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in texts(embedding_dedup.near_duplicates(frame))), key=str)
    want = sorted(((i, n, c) for i, n, c in brute(rows)), key=str)
    assert got == want
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert embedding_dedup.near_duplicates(empty).count() == 0
    flat = embedding_dedup.near_duplicates(frame.where("vec_id BETWEEN 300 AND 302"))
    assert {(r["n_links"], r["kept"]) for r in texts(flat)} == {(0, True)}


def test_embeddings_in_many_shards_and_blocks(spark, monkeypatch):
    """Small shards and blocks: pairs that meet several times, and blocks that meet two by two."""
    monkeypatch.setattr(embedding_dedup, "SHARD_ROWS", 100)
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 40)
    draw = np.random.default_rng(5)
    centre = draw.normal(size=(30, 16))
    dense = centre[0] + draw.normal(size=(90, 16)) * 0.02  # a group larger than a block
    rows = np.concatenate([centre, dense, centre[1:15] + draw.normal(size=(14, 16)) * 0.05, draw.normal(size=(200, 16))])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id bigint, embedding array<double>")
    out = embedding_dedup.near_duplicates(frame)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in texts(out)}
    want = {i: (n, c) for i, n, c in brute([(i, v.tolist()) for i, v in enumerate(rows)])}
    found, true = sum(v[0] for v in got.values()), sum(v[0] for v in want.values())
    assert all(got[i][0] <= want[i][0] for i in want) and found >= 0.9 * true
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.95 * len(want)


def test_recall_audit(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    out = embedding_dedup.near_duplicates(vectors)
    assert embedding_dedup.audit(vectors, out, asked=500) >= 0.9


def test_audit_counts_what_was_missed(spark):
    vectors = spark.createDataFrame(cases(), "vec_id bigint, embedding array<float>").where("vec_id BETWEEN 0 AND 299")
    out = embedding_dedup.near_duplicates(vectors)
    assert embedding_dedup.audit(vectors, out) == 1.0
    blind = out.withColumn("n_links", F.lit(0).cast("bigint"))
    assert embedding_dedup.audit(vectors, blind) == 0.0
    assert embedding_dedup.audit(vectors.limit(0), out) == 1.0
