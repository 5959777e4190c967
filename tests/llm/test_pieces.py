"""Token counts, encoding and decoding against the library."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from likeness.llm import piece_codec, pieces, token_counts
from likeness.llm.text import code_points
from tests.llm.fixtures import no_docs, odd_docs, real_docs, texts

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=token_counts.default_model())


def texts_of_all_kinds(machine):
    draw = random.Random(4)
    letters, known = list(machine.letter), list(machine.ids)
    out = ["", " ", "a", "   a   ", "a" * 3001, "=" * 2500, "-" * 70 + "a", "abc" * 900, "日本語" * 60, "é" * 999, "\x00\t\n",
           "</s> <0x41>", "𝒳" * 9, "x" * 3000 + " " * 3000 + "y"]
    out += ["".join(draw.choices("abeinrst  .=▁é日①\n", k=draw.randint(0, 1500))) for _ in range(40)]
    out += ["".join(draw.choices(letters, k=draw.randint(0, 400))) for _ in range(30)]
    out += ["".join(draw.choices(known, k=draw.randint(0, 90))) for _ in range(30)]
    return out + ["".join(draw.choices("ab=-", k=draw.randint(0, 4000))) for _ in range(15)]


def test_machine_equals_library(library):
    machine = pieces.machine(token_counts.default_model())
    some = texts_of_all_kinds(machine)
    points, limits = code_points(pa.array(some, pa.large_string()))
    want = library.encode(some)
    assert machine.count(points, limits).tolist() == [len(w) for w in want]
    ids, rows = machine.encode(points, limits)
    assert [ids[a:b].tolist() for a, b in zip(rows[:-1], rows[1:])] == want


def test_long_run_is_composed_of_chunk_maps(library):
    """One word of many chunks: entry states of all chunks but the first come from the scan."""
    machine = pieces.machine(token_counts.default_model())
    long = "ab" * 40_000 + "=" * 30_001
    points, limits = code_points(pa.array([long, "", long[1:]], pa.large_string()))
    kind = machine.kinds[machine.symbols(points, limits)[0]]
    assert machine.cuts(kind, machine.symbols(points, limits)[1])[2].sum() > 50
    assert machine.count(points, limits).tolist() == [len(library.encode(t)) for t in (long, "", long[1:])]


def test_states_are_forgotten_between_slices(library, monkeypatch):
    monkeypatch.setattr(pieces, "MAX_STATES", 10)
    monkeypatch.setattr(pieces, "MAX_FOLLOWERS", 10)
    machine = pieces.Machine(token_counts.default_model())
    for text in ("some words here", "other words there", "some words here"):
        points, limits = code_points(pa.array([text], pa.large_string()))
        assert machine.count(points, limits)[0] == len(library.encode(text))


def test_counts_of_documents(spark, library):
    for docs in (odd_docs(spark), real_docs(spark), no_docs(spark)):
        got = texts(token_counts.count_tokens(docs.withColumn("n_tokens", F.lit("clash")), limit=100))
        assert len(got) == docs.count()
        for r in got:
            assert r["n_tokens"] == len(library.encode(r["text"] or "")) and r["over_limit"] == (r["n_tokens"] > 100)
            assert r["n_bytes"] == len((r["text"] or "").encode())


def test_codec_round_trip(spark, library):
    for docs in (odd_docs(spark), real_docs(spark), no_docs(spark)):
        coded = piece_codec.encode(docs.withColumn("ids", F.lit(1)), verify=True)
        got = texts(piece_codec.decode(coded.withColumn("decoded", F.lit(2))))
        assert len(got) == docs.count()
        for r in got:
            assert r["ids"] == library.encode(r["text"] or "") and r["n_ids"] == len(r["ids"])
            assert r["decoded"] == (r["text"] or "").replace("▁", " ") and r["round_trip"]


def test_decode_odd_ids(spark, library):
    rows = [(1, [3 + 0xC3]), (2, [1, 2, 0, 413]), (3, None), (4, []), (5, [3 + 0xE6, 3 + 0x97, 3 + 0xA5])]
    got = {r["k"]: r["decoded"] for r in texts(piece_codec.decode(spark.createDataFrame(rows, "k int, ids array<int>")))}
    assert got[1] == "�" and got[3] == "" and got[4] == "" and got[5] == "日"
    assert got[2].strip().startswith("⁇")
    bad = piece_codec.decode(spark.createDataFrame([(1, [99_999])], "k int, ids array<int>"))
    with pytest.raises(Exception, match="out of range"):
        bad.collect()


def test_invalid_utf8_counts_as_replacement():
    raw = pa.array([b"a\xff", b"", b"\xc3"], pa.large_binary())
    broken = pa.Array.from_buffers(pa.large_string(), 3, raw.buffers())
    points, limits = code_points(broken)
    assert points.tolist() == [97, 0xFFFD, 0xFFFD] and limits.tolist() == [0, 2, 2, 3]
    assert isinstance(points, np.ndarray)
