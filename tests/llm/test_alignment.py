"""Alignment of two tokenizers against overlaps found token by token, and the bitmaps against sets."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from likeness.llm import alignment, bitmaps
from tests.llm.fixtures import DOCS, SF, no_docs, odd_docs, real_docs, texts

FIRST = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
FIRST.encode_special_tokens = True
SECOND = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
HARD = ["a ▁ b", "▁", "<|endoftext|> x", "<s> </s> <0x41>", "tab\tand  two   blanks ", " lead", "\r\n\n", "é" * 300, "日本語のテキスト 𝒳𝒴", "aaa" * 500,
        "it's we'll they've", "one two three " * 40, "\x00\x01", "don 't  do a b c d e f"]


def slow_links(text):
    """(first ids, second ids, number of groups, links, spelt groups), or None where there are no tokens."""
    if not text:
        return None
    a, b = FIRST.encode(" " + text, add_special_tokens=False).ids, SECOND.encode(text)
    spelt = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(SECOND.id_to_piece, b)]
    if b"".join(spelt) != (" " + text).encode():
        return None
    a_end, b_end = np.cumsum([len(FIRST.id_to_token(i)) for i in a]), np.cumsum([len(p) for p in spelt])
    links = [(x, y) for x, ae, al in zip(a, a_end, np.append(0, a_end)) for y, be, bl in
             [(b[k], b_end[k], b_end[k - 1] if k else 0) for k in range(np.searchsorted(b_end, al, "right"), len(b))][:len(FIRST.id_to_token(x)) + 1]
             if bl < ae and al < be]
    groups, i, j = [], 0, 0
    for end in sorted(set(a_end.tolist()) & set(b_end.tolist())):
        m, n = np.searchsorted(a_end, end, "right"), np.searchsorted(b_end, end, "right")
        groups.append(",".join(map(str, a[i:m])) + "|" + ",".join(map(str, b[j:n])))
        i, j = m, n
    return len(a), len(b), len(groups), links, ";".join(groups)


def slow_align(bodies):
    found = [slow_links(t) for t in bodies]
    docs, links = Counter(), Counter()
    for f in found:
        if f:
            docs.update(set(f[3]))
            links.update(f[3])
    top = defaultdict(int)
    for (a, _), n in docs.items():
        top[a] = max(top[a], n)
    rows = [(0,) * 6 + ("",) if f is None else (
        f[0], f[1], f[2], len(f[3]), sum(docs[p] == top[p[0]] for p in f[3]), sum(docs[p] for p in f[3]), hashlib.sha256(f[4].encode()).hexdigest())
        for f in found]
    return rows, {p: (n, links[p], n == top[p[0]]) for p, n in docs.items()}


def check(made, docs):
    bodies = [(r["doc_id"], r["text"]) for r in texts(docs)]
    rows, pairs = slow_align([t for _, t in bodies])
    got = [(r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in texts(made.documents)]
    assert sorted(map(str, got)) == sorted(str((d, *r)) for (d, _), r in zip(bodies, rows))
    assert {(r["a"], r["b"]): (r["docs"], r["links"], r["best"]) for r in texts(made.pairs)} == pairs


@pytest.mark.parametrize("sizes", [{}, {"PIECE": 60, "SLICE": 500, "CONTAINER_POSTINGS": 800}])
def test_alignment(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(alignment, name, value)
    hard = spark.createDataFrame([(1000 + k, t, None, None, None) for k, t in enumerate(HARD)], DOCS)
    docs = odd_docs(spark).union(hard).union(real_docs(spark).limit(60)).coalesce(2)
    check(alignment.align(docs.withColumn("n_a", F.lit("clash")).withColumn("bits", F.lit(1))), docs)


def test_scores_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(alignment, "SCORE_LIMIT", 0)
    docs = real_docs(spark).limit(50).repartition(3)
    check(alignment.align(docs), docs)


def gathered(both, bodies):
    """A container of texts in short pieces, checked against the overlaps found token by token."""
    made = alignment.Container()
    for k, body in enumerate(bodies):
        made.open(k)
    made.add(both, [(k, piece) for k, body in enumerate(bodies) for piece in both.pieces(body, 60)])
    made.merge()
    want = [slow_links(t) for t in bodies]
    assert [not f for f in made.failed] == [f is not None for f in want]
    links = {(k, x << alignment.SECOND_BITS | y): n for k, f in enumerate(want) if f for (x, y), n in Counter(f[3]).items()}
    keys, times = made.keys[0], made.times[0]
    got = {(key & (bitmaps.SLOTS - 1), key >> bitmaps.SLOT_BITS): n for key, n in zip(keys.tolist(), times.tolist())}
    assert {key: n for key, n in got.items() if not made.failed[key[0]]} == links
    for counts, digest, found in zip(made.counts, made.digests, want):
        if found:
            assert counts.tolist() == [found[0], found[1], found[2], len(found[3])]
            assert digest.hexdigest() == hashlib.sha256(found[4].encode()).hexdigest()


def test_distinct_words_are_encoded_once():
    both, read = alignment.Tokenizers(*alignment.default_models()), Counter()

    class Counted:
        def __init__(self, name):
            self.name, self.model = name, getattr(both, name)

        def __getattr__(self, called):
            def run(given, **more):
                read[self.name] += sum(map(len, given))
                return getattr(self.model, called)(given, **more)
            return run

    words = ["the", "quick,", "brown", "fox's", "jumps.\nOver", "12", "été", "слово", "한국어"]
    rng = np.random.default_rng(0)
    bodies = [" ".join(rng.choice(words, 200)) for _ in range(30)]
    both.first, both.second = Counted("first"), Counted("second")
    gathered(both, bodies)
    assert 0 < max(read.values()) < sum(map(len, bodies)) // 50


def test_every_character_beside_a_blank(monkeypatch):
    monkeypatch.setattr(alignment, "LOT", 7)
    monkeypatch.setattr(alignment, "DISTINCT", 5000)
    both = alignment.Tokenizers(*alignment.default_models())
    chars = [*map(chr, range(0x3100)), "\u4e00", "\ua000", "\ud55c", "\ufeff", "\uffff", "\U0001d4b3", "\U0010ffff"]
    gathered(both, [t for c in chars for t in (f"a{c} b{c}", f"{c}  {c} c ")] + HARD)


def test_no_rows_and_the_query(spark):
    none = alignment.align(no_docs(spark))
    assert none.documents.count() == 0 and none.pairs.count() == 0
    got = alignment.op12(spark, SF)
    assert dict(got.dtypes) == {**{c: "bigint" for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")}, "groups_sha256": "string"}
    assert got.count() == real_docs(spark).count()


def test_bitmaps():
    rng = np.random.default_rng(0)
    sets = [rng.choice(bitmaps.SLOTS, n, replace=False) for n in (1, 5, bitmaps.LONGEST_LIST, bitmaps.LONGEST_LIST + 1, 40_000, 3, bitmaps.SLOTS, 2)]
    keys = np.sort(np.concatenate([(np.int64(7 * k) << bitmaps.SLOT_BITS) | s for k, s in enumerate(sets)]))
    owners, packed = bitmaps.pack(keys)
    assert owners.tolist() == [7 * k for k in range(len(sets))]
    assert bitmaps.popcount(packed).tolist() == [len(s) for s in sets]
    for low in (0, 2, 5):
        row, slot = bitmaps.unpack(packed.slice(low))
        for k, s in enumerate(sets[low:]):
            assert np.array_equal(np.sort(slot[row == k]), np.sort(s))
    times = rng.integers(1, 300, len(keys))
    total = Counter()
    for plane, some in bitmaps.planes(keys, times):
        for key in some.tolist():
            total[key] += int(bitmaps.weight(np.array([plane]))[0])
    assert [total[k] for k in keys.tolist()] == times.tolist()
    both, n = bitmaps.either(np.append(keys, keys[:10]), np.append(times, times[:10]))
    assert np.array_equal(both, keys) and np.array_equal(n[:10], 2 * times[:10])
