"""Mixing and sharding against their laws and slow forms; the pipeline against its stages."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from likeness.llm import curriculum, sharding
from tests.llm.fixtures import SF, no_docs, odd_docs, real_docs, texts


def slow_targets(sizes):
    """{source: target} by the rule as it is told: cap, share the excess by weight, repeat."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, free, left = {s: 0.0 for s in order}, set(order), float(sum(sizes.values()))
    while left > 1e-9 and free:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(free):
            if target[s] > 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                free.remove(s)
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 10, "c": 10}, {"a": 1000, "b": 1, "c": 5, "d": 0, None: 40}, {"é": 3, "z": 70, "Z": 1, "": 2}, {None: 8}, {"a": 0}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in texts(curriculum.targets(rows))}
    want = slow_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 * (1 + want[k]) for k in want)


def check_mix(rows, words):
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
    want, taken, largest = slow_targets(dict(sizes)), Counter(), Counter()
    for r in rows:
        assert r["size"] == words(r["text"]) and r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * (1 + want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        assert (r["position"] is None) == (r["copies"] == 0)
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6


def test_mixture(spark, monkeypatch):
    words = lambda t: len((t or "").encode().split())
    both = odd_docs(spark).union(real_docs(spark))
    first = texts(curriculum.mixture(both.withColumn("size", F.lit("clash"))))
    check_mix(first, words)
    monkeypatch.setattr(curriculum, "BUCKET_ROWS", 1)  # other buckets, other partitions: the same mix
    again = texts(curriculum.mixture(both.repartition(7)))
    key = lambda r: (str(r["doc_id"]), str(r["text"]), r["copies"], round(r["position"] or 0, 9))
    assert sorted(map(key, first)) == sorted(map(key, again))
    assert curriculum.mixture(no_docs(spark)).count() == 0


def test_positions_follow_the_schedule(spark):
    """The words of a source placed up to a time are its demand until then."""
    docs = real_docs(spark)
    mixed = curriculum.mixture(docs)
    rows = texts(curriculum.ordered(mixed, ["doc_id", "source", "size"]).withColumn("part", F.spark_partition_id()))
    assert len(rows) == sum(r["copies"] for r in texts(mixed))
    of = defaultdict(list)
    for r in rows:
        assert 0 <= r["position"] <= 1
        of[r["source"]].append(r)
    info = {r["source"]: (r["target"], r["__tilt"]) for r in texts(mixed)}
    for s, mine in of.items():
        target, tilt = info[s]
        for t in (0.25, 0.5, 0.75):
            placed = sum(r["size"] for r in mine if r["position"] <= t)
            demand = target * ((1 + tilt) * t - tilt * t * t)
            assert abs(placed - demand) <= 2 * max(r["size"] for r in mine)
    parts = defaultdict(list)
    for r in rows:
        parts[r["part"]].append(r["position"])
    ends = [(min(p), max(p)) for _, p in sorted(parts.items())]
    assert all(a[1] <= b[0] for a, b in zip(ends[:-1], ends[1:]))


def test_op9_is_the_sorted_curriculum(spark, tmp_path):
    """The query's written files follow each other by position, and its positions follow the schedules."""
    from likeness.llm import curriculum as c
    c.op9(spark, SF).write.parquet(f"{tmp_path}/out")
    rows = texts(spark.read.parquet(f"{tmp_path}/out").withColumn("file", F.input_file_name()))
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in texts(real_docs(spark)))
    files = defaultdict(list)
    for r in rows:
        files[r["file"]].append(2 if r["position"] is None else r["position"])
    ranges = sorted((min(p), max(p)) for _, p in files.items())
    assert all(p == sorted(p) for p in files.values()) and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    tilts = {r["source"]: r["__tilt"] for r in texts(c.mixture(real_docs(spark)))}
    source = {r["doc_id"]: r["source"] for r in texts(real_docs(spark))}
    of = defaultdict(list)
    for r in rows:
        assert r["taken"] == r["size"] * len(r["positions"]) and r["positions"] == sorted(r["positions"])
        of[source[r["doc_id"]]].append(r)
    for s, mine in of.items():
        for t in (0.25, 0.5, 0.75, 1.0):
            placed = sum(r["size"] for r in mine for p in r["positions"] if p <= t)
            demand = mine[0]["target"] * ((1 + tilts[s]) * t - tilts[s] * t * t)
            assert abs(placed - demand) <= 3 * max(r["size"] for r in mine)


def check_shards(rows, n=24):
    slots, size = defaultdict(list), Counter()
    for r in rows:
        body = (r["text"] or "").encode()
        assert r["size"] == len(body) + 8 and r["text_crc32"] == zlib.crc32(body) and 0 <= r["shard"] < n
        slots[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max((r["size"] for r in rows), default=0)
    total = sum(size.values())
    assert all(abs(size[k] - total / n) <= 2 * largest for k in range(n))


def test_shards(spark):
    real = real_docs(spark).withColumn("doc_id", F.col("doc_id") + 100)
    hot = spark.range(400).select((F.col("id") + 10_000).alias("doc_id"), F.lit("one text that is a third of all rows " * 12).alias("text"))
    docs = odd_docs(spark).union(real).select("doc_id", "text").union(hot)
    first = sharding.shards_of(docs.withColumn("shard", F.lit("clash")))
    joined = texts(first.join(docs.dropDuplicates().withColumnRenamed("doc_id", "d"), (F.col("doc_id").eqNullSafe(F.col("d"))), "left"))
    assert first.count() == docs.count()
    check_shards(joined)
    again = sharding.shards_of(docs.repartition(5))
    strip = lambda df: sorted(map(str, [(r["doc_id"], r["size"], r["text_crc32"], r["shard"]) for r in texts(df)]))
    assert strip(first) == strip(again)
    assert sharding.shards_of(no_docs(spark)).count() == 0


def test_propagation_cuts_few_links(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = sharding.shards_of(docs).join(docs.select("doc_id", "text"), "doc_id").groupBy("text").agg(
        F.count("*").alias("n"), F.countDistinct("shard").alias("shards")).where("n > 1")
    groups = texts(out)
    assert sum(g["shards"] > 1 for g in groups) == 0


def test_pipeline_stages(spark):
    """Each stage against a slow form of its decision, on what the stage before kept."""
    docs = real_docs(spark).union(odd_docs(spark).withColumn("doc_id", F.col("doc_id") + 5000))
    columns = docs.columns
    names = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "language ID" and len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    stages = [f for _, f in corpus_pipeline.STAGES]
    kept = stages[0](spark, docs, SF)
    assert kept.columns == columns
    rows = texts(kept)
    assert all(any(c.isalpha() for c in r["text"] or "") for r in rows) and len(rows) >= 200
    from tests.llm.test_dedup import slow_print
    groups = defaultdict(list)
    single = texts(stages[1](spark, kept, SF))
    for r in rows:
        groups[slow_print(r["text"])].append(r["doc_id"])
    assert {r["doc_id"] for r in single} <= {min((d for d in g if d is not None), default=None) for g in groups.values()}
    assert len(single) >= len(groups) - 20
    from tests.llm.test_text_models import slow_spans
    clean = texts(stages[2](spark, spark.createDataFrame(single, docs.schema), SF))
    before = {r["doc_id"]: r["text"] for r in single}
    for r in clean:
        assert r["n_chars"] == len(r["text"]) and ((r["text"] != before[r["doc_id"]]) == bool(slow_spans(before[r["doc_id"]])))
    mixed = stages[3](spark, spark.createDataFrame(clean, docs.schema), SF)
    assert mixed.columns == columns
    taken = Counter()
    for r in texts(mixed):
        taken[r["source"]] += len(r["text"].encode().split())
    sizes, largest = Counter(), Counter()
    for r in clean:
        n = len(r["text"].encode().split())
        sizes[r["source"]] += n
        largest[r["source"]] = max(largest[r["source"]], n)
    assert all(abs(taken[s] - t) <= largest[s] + 1e-6 for s, t in slow_targets(dict(sizes)).items())
    coded = texts(stages[4](spark, mixed, SF))
    assert len(coded) == mixed.count() and all(len(r["ids"]) == r["n_ids"] for r in coded)


def test_order_outlives_the_write(spark, tmp_path):
    """A mix that was written and read in another order: every row is placed, on the schedule of its source."""
    docs = real_docs(spark).union(odd_docs(spark).withColumn("doc_id", F.col("doc_id") + 5000))
    mixed = dict(corpus_pipeline.STAGES)["mixing sources to target weights"](spark, docs, SF)
    mixed.repartition(7).write.parquet(f"{tmp_path}/mixed")
    back = spark.read.parquet(f"{tmp_path}/mixed")
    placed = curriculum.in_order(back)
    placed.write.parquet(f"{tmp_path}/placed")
    rows = texts(spark.read.parquet(f"{tmp_path}/placed").orderBy("position"))
    strip = lambda made: sorted(str([r[c] for c in docs.columns]) for r in made)
    assert strip(rows) == strip(texts(back)) and all(0 <= r["position"] <= 1 for r in rows)
    again = texts(curriculum.in_order(back.repartition(3)))
    key = lambda r: (str(r["doc_id"]), str(r["text"]), round(r["position"], 9))
    assert sorted(map(key, again)) == sorted(map(key, rows))
    tilts = {r["source"]: r["tilt"] for r in texts(curriculum.targets(back.groupBy("source").agg(
        F.sum(curriculum.words_in(F.col("text"))).alias("source_size"))))}
    of = defaultdict(list)
    for r in rows:
        of[r["source"]].append((r["position"], len((r["text"] or "").encode().split())))
    for source, mine in of.items():
        total, tilt = sum(n for _, n in mine), tilts[source]
        for t in (0.25, 0.5, 0.75):
            assert abs(sum(n for p, n in mine if p <= t) - total * ((1 + tilt) * t - tilt * t * t)) <= 2 * max(n for _, n in mine)
    passes = defaultdict(list)
    for r in rows:
        passes[r["doc_id"]].append(r["position"])
    assert any(len(p) > 1 and max(p) - min(p) > 0.1 for p in passes.values())
    assert curriculum.in_order(no_docs(spark)).count() == 0


def test_stages_take_clashing_columns(spark):
    docs = real_docs(spark).union(odd_docs(spark).withColumn("doc_id", F.col("doc_id") + 5000))
    for name in ("weight", "tilt", "mean", "top", "most", "size", "copies", "position", "kept", "id", "n", "rejected", "score"):
        docs = docs.withColumn(name, F.lit(f"my {name}"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert {"weight", "tilt", "mean", "top", "size"} <= set(docs.columns), name
        row = docs.first()
        assert all(row[c] == f"my {c}" for c in ("weight", "tilt", "mean", "top", "size")), name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_pipeline_runs_and_takes_no_rows(spark, tmp_path):
    no_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    corpus_pipeline.run(spark, SF).write.parquet(f"{tmp_path}/out")
    out = texts(spark.read.parquet(f"{tmp_path}/out").withColumn("file", F.input_file_name()))
    assert len(out) > 100
    files = defaultdict(list)
    for r in out:
        files[r["file"]].append(r["position"])
    ranges = sorted((min(p), max(p)) for _, p in files.items())
    assert all(p == sorted(p) for p in files.values()) and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
