import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from likeness.operators import analysis, ann, fusion, joins, search, selection
from likeness.operators.nearest import common_dim, nearest, square_blocks
from likeness.session import fresh_dir
from tests.conftest import rows
from tests.helpers import slow_top

DIM = 16


def corpus(n=600, seed=0, dim=DIM, copies=0):
    """Random vectors; the last ``copies`` are exact copies of the first."""
    vectors = np.random.default_rng(seed).standard_normal((n, dim)).astype(np.float32)
    if copies:
        vectors[-copies:] = vectors[0]
    return {i: v for i, v in enumerate(vectors)}


def frame(spark, vectors, name="image_id", parts=4):
    data = [(int(i), None if v is None else [float(x) for x in v]) for i, v in vectors.items()]
    return spark.createDataFrame(data, f"{name} long, vector array<float>").repartition(parts)


def found(hits):
    out = {}
    for q, rank, image, score in rows(hits.select("query_id", "rank", "image_id", "score"), "query_id", "rank"):
        out.setdefault(q, []).append((image, score))
        assert rank == len(out[q])
    return out


def agree(hits, expected):
    got = found(hits)
    assert set(got) == {q for q, e in expected.items() if e}
    for q, best in got.items():
        assert [i for i, _ in best] == [i for i, _ in expected[q]], q
        assert [s for _, s in best] == pytest.approx([s for _, s in expected[q]], abs=1e-9)


@pytest.mark.parametrize("options", [{}, {"query_bytes": 0}, {"query_bytes": 0, "block_bytes": 0}])
@pytest.mark.parametrize("parts", [1, 4, 17])
def test_both_routes_equal_brute_force(spark, options, parts):
    vectors = corpus(copies=200)
    asked = {i: vectors[i] for i in range(0, 600, 7)}
    hits = nearest(frame(spark, asked, "query_id", parts), frame(spark, vectors, parts=parts), 6, **options)
    agree(hits, slow_top(asked, vectors, 6))


@pytest.mark.parametrize("options", [{}, {"query_bytes": 0}])
def test_self_can_be_left_out(spark, options):
    vectors = corpus(300)
    hits = nearest(frame(spark, vectors, "query_id"), frame(spark, vectors), 3, exclude_self=True, **options)
    agree(hits, slow_top(vectors, vectors, 3, own=True))


@pytest.mark.parametrize("options", [{}, {"query_bytes": 0}])
@pytest.mark.parametrize("keep_zero", [False, True])
def test_unusable_vectors(spark, options, keep_zero):
    vectors = corpus(40)
    odd = dict(vectors)
    odd[3], odd[4], odd[5] = np.zeros(DIM), np.full(DIM, np.nan), np.full(DIM, np.inf)
    given = odd | {6: None, 7: odd[7][:5]}
    kept = {i: v for i, v in odd.items() if i not in (4, 5, 6, 7)}
    asked = {i: vectors[i] for i in (0, 1)}
    hits = nearest(frame(spark, asked, "query_id"), frame(spark, given), 100, dim=DIM, keep_zero=keep_zero, **options)
    agree(hits, slow_top(asked, kept, 100, keep_zero=keep_zero))


def test_k_of_any_size(spark):
    vectors = corpus(10)
    asked = frame(spark, vectors, "query_id")
    assert nearest(asked, frame(spark, vectors), 10).count() == 100
    assert nearest(asked, frame(spark, vectors), 50).count() == 100
    assert nearest(asked, frame(spark, vectors), 0).count() == 0


def test_empty_tables(spark):
    vectors, none = corpus(5), {}
    assert nearest(frame(spark, none, "query_id"), frame(spark, vectors), 3).count() == 0
    assert nearest(frame(spark, vectors, "query_id"), frame(spark, none), 3).count() == 0
    assert nearest(frame(spark, vectors, "query_id"), frame(spark, none), 3, query_bytes=0).count() == 0


def test_colour_search_pads_and_finds_itself(spark):
    vectors = corpus(50, dim=20)
    mixed = {i: (v[:12] if i % 5 == 0 else v) for i, v in vectors.items()} | {99: np.ones(3)}
    hits = found(search.search_hsv(frame(spark, mixed, "query_id"), frame(spark, mixed), 2, dim=20, legacy_dim=12))
    assert set(hits) == set(vectors)
    assert all(best[0][0] == q and best[0][1] == pytest.approx(1) for q, best in hits.items())


def test_shape_search_excludes_self_and_limits(spark):
    vectors = corpus(50)
    asked, held = frame(spark, vectors, "query_id"), frame(spark, vectors)
    agree(search.search_hog(asked, held, 3, dim=DIM), slow_top(vectors, vectors, 3, own=True))
    first = {i: vectors[i] for i in range(10)}
    agree(search.search_hog(asked, held, 3, dim=DIM, limit=10), slow_top(vectors, first, 3, own=True))


def test_paths_of_hits(spark):
    hits = spark.createDataFrame([(1, 1, 7, 0.9), (1, 2, 8, 0.8)], "query_id long, rank int, image_id long, score double")
    known = spark.createDataFrame([(7, "/a"), (9, "/b")], "image_id long, path string")
    assert rows(search.with_paths(hits, known).select("query_id", "image_id", "path"), "image_id") == [(1, 7, "/a")]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_splits_hot_keys(spark, how):
    facts = spark.range(3000).select(F.col("id").alias("query_id"),
                                     F.when(F.col("id") < 2000, 5).otherwise(F.col("id") % 40).alias("image_id"))
    known = spark.range(30).select(F.col("id").alias("image_id"), (F.col("id") * 10).alias("value"))
    expected = facts.join(known, "image_id", how)
    for hot_rows in (10, 1_000_000):
        got = joins.lookup(facts, known, "image_id", "query_id", how, hot_rows)
        assert rows(got.select("query_id", "image_id", "value"), "query_id") == rows(
            expected.select("query_id", "image_id", "value"), "query_id")


def test_blocks_fit_memory_and_tasks():
    assert square_blocks(100, 100, 1000, 8) == (1, 1)
    q, c = square_blocks(10 ** 6, 10 ** 8, 10 ** 5, 64)
    assert 10 ** 6 / q <= 10 ** 5 and 10 ** 8 / c <= 10 ** 5 and q * c >= 64


def plan_of(frame_):
    return frame_._jdf.queryExecution().executedPlan().toString()


def test_many_queries_copy_no_vector_per_block(spark):
    """Blocks of queries read the corpus from its files: its rows are neither exploded nor exchanged, nor do hits meet again."""
    vectors = corpus(700, copies=40)
    hits = nearest(frame(spark, vectors, "query_id", 1), frame(spark, vectors, parts=1), 4, query_bytes=0, block_bytes=0)
    assert "Generate" not in plan_of(hits) and "image_id" not in "".join(x for x in plan_of(hits).split("\n") if "Exchange" in x)
    agree(hits, slow_top(vectors, vectors, 4))


def test_lists_of_many_queries_copy_no_vector_per_block(spark):
    """Queries of two lists, one of them with most rows, against the lists' stored rows; some lists are on one side only."""
    vectors = corpus(600, copies=30)
    place = {i: 3 if i % 5 else 8 for i in vectors}
    lists = spark.createDataFrame([(i, place[i]) for i in vectors] + [(0, 77)], "query_id long, list_id long")
    held = frame(spark, vectors).join(lists.where("list_id < 77").union(spark.createDataFrame([(5, 99)], "query_id long, list_id long"))
                                      .withColumnRenamed("query_id", "image_id"), "image_id")
    hits = nearest(frame(spark, vectors, "query_id"), held, 4, probes=lists, query_bytes=0, block_bytes=0, copies=2)
    assert "Generate" not in plan_of(hits)
    want = {}
    for name in (3, 8):
        some = {i: v for i, v in vectors.items() if place[i] == name}
        want |= slow_top(some, some, 4)
    agree(hits, want)


def test_a_scan_hands_on_less_than_the_corpus_weighs(spark, monkeypatch):
    from likeness.operators import nearest as module
    vectors = frame(spark, corpus(300))
    asked = vectors.withColumnRenamed("image_id", "query_id")
    monkeypatch.setattr(module, "FEW_HITS", 10)
    assert not module.scanned(asked, 300, 8, 5, vectors.count) and module.scanned(asked, 300, 8, 5, lambda: 10 ** 9)


def test_best_lists_with_ties_equal_sorting():
    """Lists filled by many blocks with tied scores and repeated ids hold what sorting everything gives."""
    draw = np.random.default_rng(4)
    units = np.round(draw.normal(size=(900, 3)) * 2)
    units = units[np.abs(units).sum(axis=1) > 0]
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    ids, queries = draw.permutation(len(units)).astype(np.int64) - 400, units[:40]
    from likeness.functions.blocks import BestK
    for k in (1, 7, 60, 2000):
        best = BestK(len(queries), k)
        for start in range(0, len(units), 110):
            best.offer(queries, units[start:start + 110], ids[start:start + 110], None, ids[:40])
        row, got, scores = best.entries()
        for q in range(len(queries)):
            value = np.round(units @ queries[q], 12)
            order = [i for i in np.lexsort((ids, -value)) if ids[i] != ids[q]][:k]
            assert sorted(zip(-scores[row == q], got[row == q])) == sorted(zip(-value[order], ids[order]))


# ---- indexes ---------------------------------------------------------------

@pytest.fixture(scope="module")
def index(spark):
    vectors = corpus(800, copies=250)
    table = frame(spark, vectors)
    return vectors, table, ann.build_ivf(table, fresh_dir(spark, "ivf"), nlist=12, sample_size=400)


def test_index_holds_every_vector_once(index):
    vectors, _, ivf = index
    assert sorted(r.image_id for r in ivf.lists.select("image_id").collect()) == sorted(vectors)


@pytest.mark.parametrize("options", [{}, {"query_bytes": 0}, {"query_bytes": 0, "block_bytes": 0}])
def test_full_probe_is_exact(spark, index, options):
    vectors, _, ivf = index
    asked = {i: vectors[i] for i in range(0, 800, 11)}
    hits = ann.search_ivf(ivf, frame(spark, asked, "query_id"), 5, nprobe=99, **options)
    agree(hits, slow_top(asked, vectors, 5))


def test_recall_grows_with_probes(spark, index):
    vectors, _, ivf = index
    asked = {i: vectors[i] for i in range(1, 500, 5)}
    exact = slow_top(asked, vectors, 5)
    recalls = []
    for nprobe in (1, 3, 6, 12):
        got = found(ann.search_ann(frame(spark, asked, "query_id"), ivf, 5, method="ivf", nprobe=nprobe))
        recalls.append(np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in e}) / 5 for q, e in exact.items()]))
    assert recalls == sorted(recalls) and recalls[-1] == 1.0 and recalls[0] < 1.0


def test_hash_search(spark, index):
    vectors, table, _ = index
    asked = {i: vectors[i] for i in range(1, 500, 5)}
    exact = slow_top(asked, vectors, 5)
    for options in ({}, {"query_bytes": 0}):
        got = found(ann.search_ann(frame(spark, asked, "query_id"), table, 5, method="lsh", tables=10, bits=4, **options))
        assert all(best[0][0] == q for q, best in got.items())
        assert all(len({i for i, _ in best}) == len(best) for best in got.values())
        assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in e}) / 5 for q, e in exact.items()]) > 0.5


def test_stored_hash_index(spark, index, monkeypatch):
    """The stored index finds what the lists made for one search find, in pairs and in blocks; more probes find more."""
    from likeness.operators import hash_index as H
    vectors, table, _ = index
    asked = {i: vectors[i] for i in range(1, 500, 5)}
    exact, queries = slow_top(asked, vectors, 5), frame(spark, asked, "query_id")
    stored = H.build_hash_index(table, fresh_dir(spark, "hash"), tables=4, bits=6)
    assert stored.entries.select(F.explode("ids")).count() == 4 * stored.vectors.count() and "vector" not in stored.entries.columns
    want = found(ann.search_lsh(queries, table, 5, tables=4, bits=6))
    opened = H.load_hash_index(spark, stored.entries.inputFiles()[0].rsplit("/entries/", 1)[0])
    recalls = []
    for flips in (0, 1, 3):
        got = found(ann.search_lsh(queries, opened, 5, flips=flips))
        recalls.append(np.mean([len({i for i, _ in got[q]} & {i for i, _ in e}) / 5 for q, e in exact.items()]))
        if not flips:
            assert got == want
        for options in ({"list_pairs": 50}, {"list_pairs": 0, "query_bytes": 0}, {"query_bytes": 0}, {"query_bytes": 2000}):
            assert found(ann.search_lsh(queries, opened, 5, flips=flips, **options)) == got
    assert recalls == sorted(recalls) and recalls[0] < recalls[-1] and recalls[-1] > 0.8
    alone = found(ann.search_lsh(queries, opened, 5, flips=2, exclude_self=True))
    assert all(q not in {i for i, _ in best} for q, best in alone.items())
    with pytest.raises(FileNotFoundError):
        H.load_hash_index(spark, fresh_dir(spark, "nowhere"))


@pytest.mark.parametrize("exclude_self", [False, True])
@pytest.mark.parametrize("k", [0, 3, 40, 500])
def test_lists_of_many_pairs_are_scored_as_products(monkeypatch, k, exclude_self):
    """Large and small lists, repeated ids and ids that are not here: the k best of the distinct pairs, and only
    the pairs of small lists are written out."""
    import pyarrow as pa
    from likeness.operators import hash_index as H
    vectors = corpus(300, copies=40)
    ids = np.array(list(vectors))
    units = np.stack([v / np.linalg.norm(v) for v in vectors.values()]).astype(np.float64)
    draw = np.random.default_rng(3)
    lists = [(draw.choice(330, 200), draw.choice(330, 180)) for _ in range(6)] + [(draw.choice(300, 7), draw.choice(300, 9)) for _ in range(20)]
    table = pa.table({"asking": [q.tolist() for q, _ in lists] + [[], [1]], "ids": [i.tolist() for _, i in lists] + [[2], []]},
                     schema=pa.schema([("asking", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64()))]))
    written, near_best = [], H._near_best
    monkeypatch.setattr(H, "_near_best", lambda query, *rest: written.append(len(query)) or near_best(query, *rest))
    out = H._best_pairs(table, ids, units, ids, units, k, exclude_self)
    pairs = {(q, i) for asking, held in lists for q in asking.tolist() for i in held.tolist()
             if q < 300 and i < 300 and not (exclude_self and q == i)}
    score = np.round(units @ units.T, 12)
    want = {}
    for q, i in sorted(pairs, key=lambda p: (p[0], -score[p], p[1])):
        want.setdefault(q, []).append(i)
    got = {}
    for row in sorted(out.to_pylist(), key=lambda r: (r["query_id"], -r["score"], r["image_id"])):
        assert row["score"] == pytest.approx(score[row["query_id"], row["image_id"]], abs=1e-11)
        got.setdefault(row["query_id"], []).append(row["image_id"])
    assert got == {q: best[:k] for q, best in want.items() if k}
    assert sum(written) <= 20 * 7 * 9 < len(pairs) // 10


def above_scan(frame_, column):
    """The operators above the scan that reads ``column``, from the top of the plan."""
    path = []
    for line in frame_._jdf.queryExecution().executedPlan().toString().split("\n"):
        depth = len(line) - len(line.lstrip(" :+-"))
        path = [p for p in path if p[0] < depth] + [(depth, line.strip(" :+-"))]
        if "FileScan" in line and column in line.split("[", 1)[1].split("]")[0]:
            return [p for _, p in path]


def test_lists_are_searched_without_a_shuffle(spark, index):
    """No exchange stands above the stored blocks; unprobed groups are left out at run time."""
    vectors, _, ivf = index
    queries = frame(spark, {i: vectors[i] for i in range(0, 60, 7)}, "query_id")
    from likeness.operators import list_index as L
    probes = L.probe(queries, ivf, 2)
    gone = spark.sparkContext.broadcast(np.zeros(0, np.int64))
    [layer] = ivf.layers
    pruned = L.pruned(layer, probes)
    for found_, joins in ((L._join_lists(ivf, pruned, queries, probes, 3, False, gone, 4), True),
                          (L._scan_lists(ivf, pruned, queries.toArrow(), probes.toArrow(), 3, False, gone), False)):
        path = above_scan(found_, "vectors")
        assert not any(p.startswith("Exchange") for p in path) and any("SortMergeJoin" in p for p in path) == joins
        assert "dynamicpruning" in path[-1]


def written(spark, name):
    from likeness.session import open_filesystem, shared_dir
    import os
    return {f for f in os.listdir(open_filesystem(shared_dir(spark))[1]) if f.startswith(name)}


@pytest.mark.parametrize("options", [{}, {"query_bytes": 0}])
def test_all_lists_probed_need_no_probes(spark, index, options):
    """A full probe writes no table of (query, list) and moves no query per list."""
    vectors, _, ivf = index
    before = written(spark, "probes-")
    hits = ann.search_ivf(ivf, frame(spark, vectors, "query_id"), 5, nprobe=12, **options)
    assert "collect_list" not in plan_of(hits) and "vectors#" not in "".join(x for x in plan_of(hits).split("\n") if "Exchange" in x)
    agree(hits, slow_top(vectors, vectors, 5))
    assert written(spark, "probes-") == before


@pytest.mark.parametrize("options", [{"nprobe": 12}, {"nprobe": 12, "query_bytes": 0}, {"nprobe": 11}, {"nprobe": 11, "query_bytes": 0}])
def test_a_repeated_query_is_asked_once(spark, index, options):
    vectors, _, ivf = index
    asked = frame(spark, {i: vectors[i] for i in range(0, 90, 7)}, "query_id")
    assert found(ann.search_ivf(ivf, asked.union(asked), 5, **options)) == found(ann.search_ivf(ivf, asked, 5, **options))


def test_blocks_of_queries_read_all_layers(spark):
    """A grown index, searched by many queries: removed rows are no hits, in whichever layer they lie."""
    vectors = corpus(500, copies=60)
    ivf = ann.build_ivf(frame(spark, {i: v for i, v in vectors.items() if i % 4}), fresh_dir(spark, "ivf"), nlist=9)
    from likeness.operators import list_index as L
    ivf = L.append(ivf, frame(spark, {i: v for i, v in vectors.items() if not i % 4}))
    turned = {i: v[::-1].copy() for i, v in vectors.items() if i % 10 == 3}
    gone = [i for i in vectors if i % 10 in (3, 6)]
    ivf = L.replace(ivf, frame(spark, turned), spark.createDataFrame([(i,) for i in gone], "image_id long"))
    final = {i: v for i, v in vectors.items() if i % 10 not in (3, 6)} | turned
    for options in ({"nprobe": 9, "query_bytes": 0}, {"nprobe": 9}):
        hits = ann.search_ivf(ivf, frame(spark, final, "query_id"), 5, **options)
        assert not [x for x in plan_of(hits).split("\n") if "SortMergeJoin" in x]
        agree(hits, slow_top(final, final, 5))


def test_blocks_of_queries_read_the_lists_they_probe(spark, index, monkeypatch):
    """Many queries with some lists each: the same hits as when they travel to the lists, without a join of the vectors."""
    vectors, _, ivf = index
    from likeness.operators import list_index as L
    asked = frame(spark, vectors, "query_id")
    for options in ({"nprobe": 3}, {"nprobe": 2, "exclude_self": True}):
        read = ann.search_ivf(ivf, asked, 4, query_bytes=0, **options)
        assert "vectors#" not in plan_of(read) and "collect_list" not in plan_of(read)
        with monkeypatch.context() as changed:
            changed.setattr(L, "READ_ROWS", 0)
            assert found(ann.search_ivf(ivf, asked, 4, query_bytes=0, **options)) == found(read)


def test_given_centres_and_many_queries(spark):
    """Lists around given centres, some probed: what comparing the lists' images gives, and no block of queries per list."""
    vectors = {i: v for i, v in corpus(260).items() if np.isfinite(v).all() and np.abs(v).sum()}
    centres = np.array([vectors[i] for i in list(vectors)[:6]], np.float64)
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    ivf = ann.build_ivf(frame(spark, vectors), fresh_dir(spark, "ivf"), centres=centres)
    near = {i: np.argsort(-(centres @ np.asarray(v, np.float64)), kind="stable") for i, v in vectors.items()}
    hits = ann.search_ann(frame(spark, vectors, "query_id"), ivf, 3, method="ivf", nprobe=2, query_bytes=0)
    assert "collect_list" not in plan_of(hits)
    want = {}
    for q, v in vectors.items():
        want |= slow_top({q: v}, {i: x for i, x in vectors.items() if near[i][0] in near[q][:2]}, 3)
    agree(hits, want)


def test_knn_graph_through_lists_moves_no_vector_per_list(spark, index):
    """The graph by some lists: blocks of images read the lists they probe, without a join of the vectors."""
    vectors, table, ivf = index
    edges = analysis.knn_graph(table, 4, index=ivf, nprobe=3, query_bytes=0)
    assert "vectors#" not in plan_of(edges) and "collect_list" not in plan_of(edges)
    assert rows(edges, "src", "rank") == rows(analysis.knn_graph(table, 4, index=ivf, nprobe=3), "src", "rank")


def two_level(spark, vectors, monkeypatch, limit=None, **options):
    from likeness.operators import list_index as L
    if limit is not None:
        monkeypatch.setattr(L, "BROADCAST_BYTES", limit)
    return L.build_lists(frame(spark, vectors), fresh_dir(spark, "ivf"), levels=2, sample_size=400, **options)


@pytest.mark.parametrize("limit", [None, 4000])
def test_two_levels(spark, index, monkeypatch, limit):
    """Centres beyond a broadcast are met in a grouped join; every list probed equals exact search."""
    vectors, _, _ = index
    ivf = two_level(spark, vectors, monkeypatch, limit, nlist=60)
    assert (ivf.centres is None) == (limit is not None) and ivf.nlist > 40 and len(ivf.tops) >= 7
    assert sorted(r.image_id for r in ivf.lists.select("image_id").collect()) == sorted(vectors)
    asked = {i: vectors[i] for i in range(0, 800, 13)}
    exact = slow_top(asked, vectors, 5)
    for options in ({}, {"query_bytes": 0}):
        agree(ann.search_ivf(ivf, frame(spark, asked, "query_id"), 5, nprobe=10_000, **options), exact)
    some = found(ann.search_ivf(ivf, frame(spark, asked, "query_id"), 5, nprobe=12))
    assert np.mean([len({i for i, _ in some.get(q, [])} & {i for i, _ in e}) / 5 for q, e in exact.items()]) > 0.5


def test_every_vector_is_in_its_nearest_list(spark, index, monkeypatch):
    vectors, _, _ = index
    for limit in (None, 4000):
        ivf = two_level(spark, vectors, monkeypatch, limit, nlist=60)
        centres = {}
        for r in ivf.centre_table.collect():
            centres.setdefault(r.cell, []).append((r.list_id, np.array(r.centre)))
        for r in ivf.lists.collect():
            unit = np.array(r.vector) / np.linalg.norm(r.vector)
            cell = int(np.argmax(np.round(ivf.tops @ unit, 9)))
            near = [round(float(c @ unit), 6) for _, c in centres[cell]]
            assert round(float(dict(centres[cell])[r.list_id] @ unit), 6) == max(near)


def test_index_that_grows(spark, index):
    """Appended, replaced and removed rows: the search equals one over an index of the final rows, the mark too."""
    from likeness.operators import list_index as L
    vectors, _, _ = index
    ids = sorted(vectors)
    draw = np.random.default_rng(3)
    base = {i: vectors[i] for i in ids[:500]}
    grown = L.build_lists(frame(spark, base), fresh_dir(spark, "ivf"), nlist=8, sample_size=400)
    first_layer = grown.record["layers"][0]["name"]
    grown = L.append(grown, frame(spark, {i: vectors[i] for i in ids[500:520]}))
    changed = {i: draw.normal(size=len(vectors[ids[0]])) for i in ids[:5]}
    grown = L.replace(grown, frame(spark, changed), spark.createDataFrame([(i,) for i in [*changed, 10 ** 9]], "image_id long"))
    grown = L.remove(grown, spark.createDataFrame([(ids[510],), (ids[7],)], "image_id long"))
    want = {**{i: vectors[i] for i in ids[:520]}, **changed}
    del want[ids[510]], want[ids[7]]
    assert grown.record["layers"][0]["name"] == first_layer and len(grown.record["layers"]) == 3
    centres = grown.centres
    rebuilt = L.build_lists(frame(spark, want), fresh_dir(spark, "ivf"), centres=centres)
    assert (grown.record["rows"], grown.record["mark"]) == (rebuilt.record["rows"], rebuilt.record["mark"]) == (len(want), rebuilt.record["mark"])
    asked = frame(spark, {i: want[i] for i in sorted(want)[::9]}, "query_id")
    for options in ({"nprobe": 2}, {"nprobe": 8, "query_bytes": 0, "exclude_self": True}):
        expected = rows(ann.search_ivf(rebuilt, asked, 4, **options), "query_id", "rank")
        opened = L.open_lists(spark, grown.path)
        assert rows(ann.search_ivf(opened, asked, 4, **options), "query_id", "rank") == expected
        assert rows(ann.search_ivf(L.compact(opened), asked, 4, **options), "query_id", "rank") == expected
    with pytest.raises(Exception, match="no longer the latest"):
        L.remove(grown, spark.createDataFrame([(ids[20],)], "image_id long"))


def test_update_writes_what_changed(spark, index):
    from likeness.operators import list_index as L
    vectors, _, _ = index
    path = fresh_dir(spark, "ivf")
    base = {i: vectors[i] for i in list(vectors)[:300]}
    one = ann.load_or_update(frame(spark, base), path, nlist=6, sample_size=200)
    assert ann.load_or_update(frame(spark, base), path).number == one.number == 1
    later = {**{i: v for i, v in base.items() if i % 50}, 10 ** 6: vectors[next(iter(vectors))] + 1, **{5: -np.asarray(base[5])}}
    two = ann.load_or_update(frame(spark, later), path)
    assert two.number == 2 and two.record["layers"][1]["rows"] == 2
    assert sorted(r.image_id for r in two.lists.select("image_id").collect()) == sorted(later)
    assert two.record["mark"] == L.build_lists(frame(spark, later), fresh_dir(spark, "ivf"), centres=two.centres).record["mark"]


def test_large_list_is_many_parts(spark, monkeypatch):
    from likeness.operators import list_index as L
    monkeypatch.setattr(L, "PART_BYTES", 2000)
    monkeypatch.setattr(L, "BLOCK_BYTES", 400)
    draw = np.random.default_rng(4)
    vectors = {i: draw.normal(size=8).astype(np.float32) for i in range(300)}
    ivf = L.build_lists(frame(spark, vectors), fresh_dir(spark, "ivf"), centres=np.eye(8)[:2])
    parts = ivf.layers[0].groupBy("list_id").agg(F.countDistinct("part").alias("n"), F.max(F.size("ids")).alias("most")).collect()
    assert all(p.n > 1 and p.most <= 12 for p in parts)
    for options in ({}, {"query_bytes": 0, "block_bytes": 256}):
        agree(ann.search_ivf(ivf, frame(spark, vectors, "query_id"), 3, nprobe=2, **options), slow_top(vectors, vectors, 3))


def test_unknown_method(spark, index):
    with pytest.raises(ValueError):
        ann.search_ann(None, None, method="other")


def test_index_reuse_and_missing_index(spark, index):
    _, table, _ = index
    base = fresh_dir(spark, "indexes")
    first = ann.load_or_build(table, base, nlist=4)
    again = ann.load_or_build(table, base, nlist=4)
    assert first.path == again.path and np.allclose(first.centres, again.centres)
    moved = table.withColumn("vector", F.reverse("vector"))
    assert ann.content_name(moved) != ann.content_name(table)
    with pytest.raises(FileNotFoundError):
        ann.load_ivf(spark, f"{base}/nowhere")


def test_nothing_to_index(spark):
    for vectors in ({}, {1: np.zeros(4)}, {1: None}):
        with pytest.raises(ValueError):
            ann.build_ivf(frame(spark, vectors), fresh_dir(spark, "ivf"), nlist=4)


def test_one_vector_index(spark):
    vectors = {5: np.array([3.0, 4.0])}
    ivf = ann.build_ivf(frame(spark, vectors), fresh_dir(spark, "ivf"), nlist=4)
    assert found(ann.search_ivf(ivf, frame(spark, vectors, "query_id"), 3)) == {5: [(5, pytest.approx(1.0))]}


def test_fingerprint_value(spark):
    assert spark.range(1).select(ann.fingerprint(2, 9, 176)).first()[0] == "14b1de422064"
    assert [ann.hsv_list_count(n) for n in (10, 10_000, 10 ** 9)] == [32, 100, 1024]


# ---- samples, limits, pages ------------------------------------------------

def test_sample_size_and_repeatability(spark, monkeypatch):
    df = spark.range(5000).withColumnRenamed("id", "image_id")
    picks = []
    for parts, small in ((1, 10 ** 6), (17, 10 ** 6), (5, 100)):
        monkeypatch.setattr(selection, "SMALL_TABLE", small)
        picks.append(rows(selection.uniform_sample(df.repartition(parts), "image_id", 500), "image_id"))
    assert picks[0] == picks[1] == picks[2] and len(picks[0]) == 500
    assert picks[0] != rows(selection.uniform_sample(df, "image_id", 500, seed=7), "image_id")
    assert 2000 < np.mean(picks[0]) < 3000
    assert selection.uniform_sample(df, "image_id", 9999).count() == 5000
    assert selection.uniform_sample(df, "image_id", 0).count() == 0


@pytest.mark.parametrize("small", [10 ** 6, 100])
def test_first_rows(spark, monkeypatch, small):
    monkeypatch.setattr(selection, "SMALL_TABLE", small)
    df = spark.range(20_000).select((F.col("id") * 37 % 20_011).alias("image_id"),
                                    F.format_string("/p%05d", F.col("id")).alias("path"))
    expected = sorted(i * 37 % 20_011 for i in range(20_000))[:700]
    assert [r[0] for r in rows(selection.first_n(df, "image_id", 700).select("image_id"), "image_id")] == expected
    assert selection.first_n(df, "path", 30).agg(F.max("path")).first()[0] == "/p00029"
    assert selection.first_n(df, "image_id", None).count() == 20_000
    assert selection.first_n(df, "image_id", 0).count() == 0


def test_pages_of_two(spark):
    df = spark.createDataFrame([(i, f"/{i}") for i in (1, 2, 3, 4, 5)], "image_id long, path string")
    pages = selection.paginate(df, "image_id", 2)
    assert rows(pages.select("image_id", "page"), "image_id") == [(1, 0), (2, 0), (3, 1), (4, 1), (5, 2)]


def test_row_numbers_over_many_buckets(spark):
    big = 2 ** 62
    df = spark.range(9000).select((F.col("id") + big).alias("k")).union(spark.range(1000).toDF("k"))
    numbered = selection.number_rows(df.repartition(7), "k", rows_per_bucket=200)
    got = rows(numbered.select("k", "row_number"), "k")
    assert [n for _, n in got] == list(range(1, 10_001))


# ---- fusion ----------------------------------------------------------------

def features(spark, vectors, skip=()):
    data = [(int(i), None if i in skip else [float(x) for x in v[:8]], [float(x) for x in v[8:]])
            for i, v in vectors.items()]
    return spark.createDataFrame(data, "image_id long, hsv_vector array<float>, hog_vector array<float>")


def slow_combined(vectors, skip, k, weights, candidates):
    def norm(x):
        span = x.max() - x.min()
        return np.zeros(len(x)) if span < 1e-12 else (x - x.min()) / span

    def cos(a, b):
        return float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))

    out = {}
    vectors = {i: v.astype(np.float64) for i, v in vectors.items()}
    for q, best in slow_top(vectors, vectors, max(k, candidates)).items():
        ids = [i for i, _ in best]
        embed = norm(np.array([s for _, s in best]))
        hsv = norm(np.array([0.0 if q in skip or i in skip else cos(vectors[q][:8], vectors[i][:8]) for i in ids]))
        hog = norm(np.array([cos(vectors[q][8:], vectors[i][8:]) for i in ids]))
        total = (weights[0] * embed + weights[1] * hsv + weights[2] * hog) / max(1e-8, sum(weights))
        order = sorted(range(len(ids)), key=lambda n: (-round(total[n], 12), ids[n]))[:k]
        out[q] = [(ids[n], total[n]) for n in order]
    return out


@pytest.mark.parametrize("weights", [(2, 1, 1), (1, 0, 0), (0, 1, 3)])
def test_combined_search(spark, weights):
    vectors, skip = corpus(60), {4, 9, 14}
    parts = features(spark, vectors, skip)
    asked = parts.withColumnRenamed("image_id", "query_id").join(
        frame(spark, vectors, "query_id").withColumnRenamed("vector", "embedding"), "query_id")
    hits = fusion.combined_search(asked, frame(spark, vectors), parts, 5, weights=weights, candidates=20,
                                  hsv_dim=8, legacy_dim=6)
    agree(hits, slow_combined(vectors, skip, 5, weights, 20))
    if weights == (1, 0, 0):
        plain = found(search.search_embeddings(frame(spark, vectors, "query_id"), frame(spark, vectors), 5))
        assert {q: [i for i, _ in best] for q, best in found(hits).items()} == {
            q: [i for i, _ in best] for q, best in plain.items()}


def test_combined_search_of_many_queries_moves_no_candidates(spark):
    """Both stages for a block of queries: nothing but the queries is exchanged and no candidates are written. Old colour
    vectors are filled up, those of other lengths count as missing, and so does a shape that is missing."""
    vectors = corpus(300)
    data = [(int(i), v[:5 if i % 7 == 1 else 6 if i % 7 == 2 else 8].tolist(), None if i % 11 == 3 else v[8:].tolist()) for i, v in vectors.items()]
    parts = spark.createDataFrame(data, "image_id long, hsv_vector array<float>, hog_vector array<float>")
    asked = parts.withColumnRenamed("image_id", "query_id").join(
        frame(spark, vectors, "query_id").withColumnRenamed("vector", "embedding"), "query_id")
    before = written(spark, "candidates-")
    options = {"weights": (2, 1, 1), "candidates": 40, "hsv_dim": 8, "legacy_dim": 6}
    hits = fusion.combined_search(asked, frame(spark, vectors), parts, 5, **options)
    assert "CoGroup" not in plan_of(hits) and "Window" not in plan_of(hits) and written(spark, "candidates-") == before
    apart = fusion.combined_search(asked, frame(spark, vectors), parts, 5, **options, retrieve=lambda q, k: nearest(q, frame(spark, vectors), k))
    names = ["query_id", "rank", "image_id", "score", "s_embed", "s_hsv", "s_hog"]
    assert hits.columns == apart.columns == names and hits.dtypes == apart.dtypes
    assert rows(hits, "query_id", "rank") == rows(apart, "query_id", "rank")


def test_combined_search_without_embeddings_among_the_metrics(spark):
    """They choose the candidates only; both stages run in one pass over the queries."""
    vectors, skip = corpus(90), {5, 8}
    parts = features(spark, vectors, skip)
    asked = parts.withColumnRenamed("image_id", "query_id").join(
        frame(spark, vectors, "query_id").withColumnRenamed("vector", "embedding"), "query_id")
    hits = fusion.combined_search(asked, frame(spark, vectors), parts, 4, metrics=("hsv", "hog"), weights=(3, 1), candidates=15,
                                  hsv_dim=8, legacy_dim=6)
    assert "CoGroup" not in plan_of(hits) and "Window" not in plan_of(hits)
    agree(hits, slow_combined(vectors, skip, 4, (0, 3, 1), 15))


def test_pair_cosine_equals_rows():
    """Pairs of rows of several lengths, missing, zero and infinite ones."""
    import pyarrow as pa
    draw = np.random.default_rng(8)
    lists = [draw.normal(size=n).tolist() for n in draw.choice([0, 3, 5], 60)]
    lists[4], lists[9], lists[12], lists[20] = None, [0.0] * 3, [float("inf"), 1.0, 2.0], [None, 1.0, 2.0, 3.0, 4.0]
    column = pa.array(lists, pa.list_(pa.float32()))
    i, j = (x.ravel() for x in np.indices((60, 60)))
    assert np.allclose(fusion.pair_cosine(column, column, i, j), fusion.row_cosine(column.take(pa.array(i)), column.take(pa.array(j))), equal_nan=True)


def test_stored_tables_are_read_where_they_lie(spark):
    """A table that is files below the shared folder isn't written again; one with expressions is."""
    from likeness.session import materialise
    from likeness.sources import stored as S
    table = materialise(frame(spark, corpus(50)), "table")
    held = S.stored(table, "again")
    assert not written(spark, "again-") and sum(b.num_rows for b in held.batches(["vector", "image_id"], 7)) == 50
    other = S.stored(table.where("image_id < 20"), "again")
    assert len(written(spark, "again-")) == 1 and sum(b.num_rows for b in other.batches(["image_id"], 7)) == 20


def test_combined_search_through_an_index(spark, index):
    vectors, table, ivf = index
    parts = features(spark, vectors)
    asked = parts.withColumnRenamed("image_id", "query_id").join(
        frame(spark, vectors, "query_id").withColumnRenamed("vector", "embedding"), "query_id").where("query_id < 20")
    exact = fusion.combined_search(asked, table, parts, 5, candidates=30, hsv_dim=8, legacy_dim=6)
    through = fusion.combined_search(asked, table, parts, 5, candidates=30, hsv_dim=8, legacy_dim=6,
                                     retrieve=lambda q, k: ann.search_ivf(ivf, q, k, nprobe=12))
    assert found(exact) == found(through)


# ---- analysis --------------------------------------------------------------

def test_dimension_audit(spark):
    df = frame(spark, {3: np.ones(4), 1: np.ones(2), 2: np.ones(4), 9: None})
    assert rows(analysis.dimension_audit(df), "dim") == [(2, 1, True), (4, 2, False)]
    assert rows(analysis.bad_examples(df, 2), "image_id") == [(2, 4), (3, 4)]


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_covariance_equals_numpy(spark, parts):
    vectors = corpus(300, dim=6)
    matrix = np.array(list(vectors.values()), dtype=np.float64)
    expected = np.cov(matrix.T)
    given = vectors | {901: np.full(6, np.nan), 902: np.ones(3)}
    for i, j, mean_i, mean_j, cov in rows(analysis.covariance(frame(spark, given, parts=parts), 6), "i", "j"):
        assert cov == pytest.approx(expected[i, j], abs=1e-9)
        assert (mean_i, mean_j) == pytest.approx((matrix[:, i].mean(), matrix[:, j].mean()), abs=1e-9)


def test_pca_equals_svd(spark):
    vectors = corpus(200, dim=6)
    matrix = np.array(list(vectors.values()), dtype=np.float64)
    centred = matrix - matrix.mean(axis=0)
    _, sizes, axes = np.linalg.svd(centred, full_matrices=False)
    fitted = analysis.fit_pca(frame(spark, vectors), 3)
    assert np.abs(np.abs((fitted.components * axes[:3]).sum(axis=1)) - 1).max() < 1e-6
    assert (fitted.components[np.arange(3), np.abs(fitted.components).argmax(axis=1)] > 0).all()
    assert fitted.explained_ratio == pytest.approx((sizes ** 2 / (sizes ** 2).sum())[:3])
    scores = dict(rows(analysis.project(frame(spark, vectors), fitted), "image_id"))
    expected = centred @ fitted.components.T
    assert max(np.abs(np.array(scores[i]) - expected[i]).max() for i in vectors) < 1e-5
    assert np.abs(np.mean(list(scores.values()), axis=0)).max() < 1e-5


def test_coordinates_export(spark):
    vectors = corpus(30, dim=5)
    points = analysis.coordinates(frame(spark, vectors))
    path = fresh_dir(spark, "points")
    analysis.export_coordinates(points, path)
    back = spark.read.csv(path, header=True, inferSchema=True)
    assert back.columns == ["x", "y", "id"] and back.count() == 30


def test_knn_graph(spark):
    vectors = corpus(120)
    edges = rows(analysis.knn_graph(frame(spark, vectors), 4), "src", "rank")
    expected = slow_top(vectors, vectors, 4, own=True)
    assert [(s, d) for s, _, d, _ in edges] == [(q, i) for q in sorted(expected) for i, _ in expected[q]]


def test_copies_are_thinned_without_loss():
    from likeness.functions.blocks import thin_copies
    rng = np.random.default_rng(1)
    units = rng.standard_normal((500, 8))
    units[100:400] = units[0]
    units[450:] = 0.0
    ids = rng.permutation(500)
    kept, names = thin_copies(units, ids, 6)
    copies = sorted([ids[0], *ids[100:400]])[:6]
    zeros = sorted(ids[450:])[:6]
    rest = [*ids[1:100], *ids[400:450]]
    assert sorted(names) == sorted([*copies, *zeros, *rest])
    assert all((kept[i] == units[list(ids).index(n)]).all() for i, n in enumerate(names))


# ---- order of rows, unusable rows, large limits ----------------------------

def test_dimension_is_that_of_the_lowest_usable_id(spark):
    """However the rows are stored, the same length decides and the same hits come back."""
    data = [(1, None), (2, [0.0, 0.0]), (3, [1.0, 0.0, 0.0]), (4, [1.0, 0.5]), (5, [0.9, 0.1, 0.0]), (6, [0.0, 1.0])]
    found = []
    for order in (data, data[::-1], data[3:] + data[:3]):
        df = spark.createDataFrame(order, "image_id long, vector array<float>").coalesce(1)
        assert common_dim(df) == 3
        found.append(rows(nearest(df.withColumnRenamed("image_id", "query_id"), df, 2), "query_id", "rank"))
    assert found[0] == found[1] == found[2] and {r[0] for r in found[0]} == {3, 5}
    assert common_dim(spark.createDataFrame([(1, None)], "image_id long, vector array<float>")) is None


def test_training_sample_skips_unusable_rows(spark):
    draw = np.random.default_rng(11)
    data = [(i, draw.normal(size=4).tolist() if i % 10 == 0 else [None, [0.0] * 4, [1.0]][i % 3]) for i in range(400)]
    df = spark.createDataFrame(data, "image_id long, vector array<float>")
    index = ann.build_ivf(df, fresh_dir(spark, "ivf"), nlist=4, sample_size=20, dim=4)
    assert len(index.centres) == 4 and index.lists.count() == 40


def test_large_limits_are_not_sorted_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(selection, "HEAD_ROWS", 7)
    df = spark.range(200).select((F.col("id") * 37 % 200).alias("k")).repartition(5)
    for n in (1, 7, 8, 63, 199, 200, 201):
        assert sorted(r.k for r in selection.first_n(df, "k", n).collect()) == list(range(min(n, 200)))


def test_many_rows_handed_on_choose_blocks(spark, monkeypatch):
    """A scan whose tasks would hand on too many rows gives way to blocks; the hits stay the same."""
    draw = np.random.default_rng(12)
    df = spark.createDataFrame([(i, draw.normal(size=6).tolist()) for i in range(80)], "image_id long, vector array<float>")
    asked = df.withColumnRenamed("image_id", "query_id")
    scanned = rows(nearest(asked, df, 5), "query_id", "rank")
    from likeness.operators import nearest as module
    monkeypatch.setattr(module, "SCAN_HITS", 10)
    assert rows(nearest(asked, df, 5), "query_id", "rank") == scanned


def test_own_image_is_left_out_by_its_path(spark):
    """The query's id says nothing: it equals that of another image, while its file is catalogued under a third."""
    from likeness.plans import find
    from likeness.operators import features as X
    from likeness.schemas import IMAGE
    from tests.helpers import shapes, struct_of
    pictures = {11: shapes((30, 60, 90)), 12: shapes((200, 10, 60)), 13: shapes((90, 90, 200))}
    kind = f"image_id long, image {IMAGE.simpleString()}"
    held = X.hog_vectors(spark.createDataFrame([(i, struct_of(p)) for i, p in pictures.items()], kind))
    known = spark.createDataFrame([(i, f"/pics/{i}.png") for i in pictures], "image_id long, path string")
    asked = spark.createDataFrame([(12, "file:/pics/11.png", struct_of(pictures[11])), (5, None, struct_of(pictures[13]))],
                                  f"query_id long, path string, image {IMAGE.simpleString()}")
    hits = rows(find.find_similar(asked, held, known, 2, feature="hog").select("query_id", "rank", "image_id"), "query_id", "rank")
    assert [h[:2] for h in hits] == [(5, 1), (5, 2), (12, 1), (12, 2)]
    assert {h[2] for h in hits if h[0] == 12} == {12, 13} and hits[0][2] == 13


def test_moments_of_batches_are_those_of_all(spark, monkeypatch):
    """Stored moments continued by new batches give the axes of one fit; only the batch is read."""
    from likeness.operators import moments
    draw = np.random.default_rng(21)
    vectors = {i: (draw.normal(size=5) * [3, 2, 1, 0.5, 0.1] + 4).astype(np.float32) for i in range(300)}
    path, read = fresh_dir(spark, "moments"), []
    count = moments.moments_of
    monkeypatch.setattr(moments, "moments_of", lambda rows_, dim: read.append(rows_.count()) or count(rows_, dim))
    for low, high in ((0, 10), (10, 250), (250, 300)):
        state = moments.add_batch(spark, path, frame(spark, {i: vectors[i] for i in range(low, high)}))
    assert read == [10, 240, 50] and state.n == 300
    matrix = np.array([vectors[i] for i in range(300)], np.float64)
    assert np.allclose(state.scatter / 299, np.cov(matrix.T)) and np.allclose(state.mean, matrix.mean(axis=0))
    fitted, whole = moments.read_moments(spark, path)[1].axes(3), analysis.fit_pca(frame(spark, vectors), 3)
    assert np.allclose(fitted.components, whole.components, atol=1e-6) and np.allclose(fitted.explained_ratio, whole.explained_ratio)
    odd = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [float("nan")] * 5)], "image_id long, vector array<float>")
    assert moments.add_batch(spark, path, odd).n == 300 and moments.read_moments(spark, path)[0] == 3
    with pytest.raises(ValueError):
        moments.add_batch(spark, fresh_dir(spark, "moments"), odd.limit(0))


def test_fuzzy_weights(spark):
    """Each source's own weights add up to log2 of its edges; both directions are joined as chances."""
    draw = np.random.default_rng(22)
    edges = [(s, int(d), float(draw.uniform(-0.5, 1))) for s in range(12) for d in draw.choice(12, 6, replace=False) if d != s]
    edges += [(20, 21, 0.5), (3, 3, 1.0)]
    got = {(r.a, r.b): r.weight for r in analysis.fuzzy_weights(spark.createDataFrame(edges, "src long, dst long, sim double")).collect()}
    one = {}
    for s in {e[0] for e in edges}:
        mine = {d: 1 - sim for a, d, sim in edges if a == s and d != s}
        if not mine:
            continue
        least, low, high, middle = min(mine.values()), 0.0, None, 1.0
        for _ in range(analysis.BANDWIDTH_STEPS):
            if sum(math.exp(-(d - least) / middle) for d in mine.values()) > math.log2(len(mine)):
                high = middle
            else:
                low = middle
            middle = middle * 2 if high is None else (low + high) / 2
        one.update({(s, d): math.exp(-(x - least) / middle) for d, x in mine.items()})
    want = {}
    for (s, d), p in one.items():
        q = one.get((d, s), 0.0)
        want[min(s, d), max(s, d)] = p + q - p * q
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)
