"""Decontamination against a search by sets of words; the FM-index against plain search."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from likeness.llm import decontamination
from likeness.llm.fm_index import FIRST, FmIndex
from tests.llm.fixtures import SF, no_docs, odd_docs, real_docs, texts

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
ITEM = "item_id bigint, text string"


def slow_words(text):
    return WORDS.findall((text or "").translate(LOWER))


def slow_hits(text, items, window=10):
    """(words, hit words, item ids as strings) of one text."""
    words, hit, found = slow_words(text), set(), set()
    for name, body in items:
        asked = slow_words(body)
        n = min(window, len(asked))
        phrases = {tuple(asked[k:k + n]) for k in range(len(asked) - n + 1)} if asked else ()
        for k in range(len(words) - n + 1) if asked else ():
            if tuple(words[k:k + n]) in phrases:
                hit.update(range(k, k + n))
                found.add(name)
    return words, hit, sorted((str(f) for f in found if f is not None)), None in found


def odd_items(spark, docs):
    whole = [r["text"] for r in docs]
    parts = [" ".join(slow_words(t)[3:30]) for t in whole[20:200:20]]
    return [(10, "lazy DOG"), (2, "!!!"), (3, None), (None, "the the the"), (4, "word " * 12), (5, "word word"), (6, "日本"),
            (7, whole[40]), (7, "the quick brown"), (8, "brown fox jumps over the lazy dog"), *[(100 + k, p) for k, p in enumerate(parts)]]


def check(got, rows, items, window=10):
    want = {}
    for r in rows:
        want.setdefault(r["doc_id"], []).append(slow_hits(r["text"], items, window))
    assert len(got) == len(rows)
    for r in got:
        hit = sorted(k for s in r["spans"] for k in range(s["first"], s["end"]))
        assert all(a["end"] < b["first"] for a, b in zip(r["spans"], r["spans"][1:]))
        names = [n for n in r["items"] if n is not None], None in r["items"]
        assert (r["n_words"], hit, *names) in [(len(w), sorted(h), i, n) for w, h, i, n in want[r["id"]]]


@pytest.mark.parametrize("sizes", [{}, {"SHARD_BYTES": 3000}, {"SHARD_WORDS": 50, "SHARD_BYTES": 100}, {"BLOCK_BYTES": 500, "PIECE_WORDS": 15}])
def test_spans(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(decontamination, name, value)
    both = odd_docs(spark).union(real_docs(spark).withColumn("doc_id", F.col("doc_id") + 100))
    rows = texts(both)
    items = odd_items(spark, texts(real_docs(spark)))
    table = spark.createDataFrame(items, ITEM)
    check(texts(decontamination.contaminated_spans(both.withColumn("words", F.lit("clash")), table)), rows, items)


def test_no_rows_and_no_items(spark):
    items = spark.createDataFrame([(1, "a b"), (2, None)], ITEM)
    assert decontamination.contaminated_spans(no_docs(spark), items).count() == 0
    clean = texts(decontamination.contaminated_spans(odd_docs(spark), items.limit(0)))
    assert len(clean) == odd_docs(spark).count() and not any(r["spans"] or r["items"] for r in clean)


def test_texts_without_the_spans(spark):
    rows = [(1, "Keep this. One two, three FOUR! And keep that.", 5), (2, "one two three four", 6), (3, None, 7), (None, "x one  two three four", 8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans bigint")
    clean = decontamination.without_spans(docs, spark.createDataFrame([(1, "one two three four")], ITEM), window=4)
    assert clean.columns == docs.columns
    assert sorted(map(str, [(r["doc_id"], r["text"], r["spans"]) for r in texts(clean)])) == sorted(map(str, [
        (1, "Keep this. ! And keep that.", 5), (2, "", 6), (3, None, 7), (None, "x ", 8)]))


def test_query(spark):
    got = texts(decontamination.op11(spark, SF))
    items = [(r["item_id"], r["text"]) for r in texts(spark.read.parquet(f"{SF}/benchmark.parquet"))]
    docs = {r["doc_id"]: r["text"] for r in texts(real_docs(spark))}
    assert len(got) == len(docs)
    for r in got:
        words, hit, names, _ = slow_hits(docs[r["doc_id"]], items)
        assert r == {"doc_id": r["doc_id"], "n_words": len(words), "n_hit": len(hit), "n_items": len(names), "contaminated": bool(hit),
                     "items_sha256": hashlib.sha256(",".join(names).encode()).hexdigest()}


@pytest.mark.parametrize("seed,alphabet,docs", [(0, 2, 3), (1, 40, 50), (2, 1, 2), (3, 3000, 5), (4, 5, 1)])
def test_index_finds_every_place(seed, alphabet, docs):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(0, 400, docs)
    codes = rng.integers(0, alphabet, sizes.sum())
    names, codes = np.unique(codes, return_inverse=True)
    limits = np.concatenate(([0], np.cumsum(sizes)))
    n, first, tree, marks, samples = FmIndex.build(codes, limits)
    fm = FmIndex(n, first, tree, marks, samples)
    body = np.insert(codes + FIRST, limits[1:], 0).tolist()
    phrases, lengths = [], []
    for _ in range(60):
        m = int(rng.integers(1, 8))
        at = int(rng.integers(0, max(1, len(codes) - m)))
        phrases.append(np.append(codes[at:at + m] + FIRST, np.full(8 - len(codes[at:at + m]), -1)))
        lengths.append(len(codes[at:at + m]))
    which, low, high = fm.search(np.array(phrases), np.array(lengths))
    found = {int(w): sorted(fm.locate(np.arange(a, b)).tolist()) for w, a, b in zip(which, low, high)}
    for k, (p, m) in enumerate(zip(phrases, lengths)):
        p = p[:m].tolist()
        assert found.get(k, []) == [i for i in range(len(body) - m + 1) if body[i:i + m] == p]
