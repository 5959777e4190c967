"""Tokens of two tokenizers aligned by bytes, and how widely each pair of tokens is linked.

A token of the first and one of the second are linked where their byte ranges overlap. The
links are kept inverted: of each id pair, for each container of up to 65,536 documents, one
compressed bitmap of the documents that hold it, and bit planes of how often they do
(``bitmaps``). The bitmaps of a container's slices are OR-merged; their bits, counted and
added over containers, are a pair's documents. The counts are joined to the postings, whose
bits bring them back to the documents of the container.

Texts are cut at blanks between letters, where both tokenizers begin anew, so a text of any
length is encoded in short pieces. Pieces are cut further, at all blanks after a character that
is none, and of the words of many pieces each distinct one is encoded and aligned once; tokens,
groups and links of a piece are those of its words.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from likeness.llm import bitmaps
from likeness.llm.text import give_back, only, raw_bytes, small_batches
from likeness.session import broadcast_if_small, materialise

# Characters of a piece, of the pieces encoded at a time, and what a container may hold.
PIECE, SLICE, CONTAINER_POSTINGS = 1 << 15, 1 << 22, 1 << 22
LOT, DISTINCT = 256, 1 << 21  # distinct words encoded as one text; bytes of them at a time
POSTING_ROWS = 1 << 14
SECOND_BITS = 20  # bits of a pair that name the second id; the first has the rest
SCORE_BYTES, SCORE_LIMIT = 64, 32 << 20

SPLIT = re.compile("(?<=[a-z]) (?=[a-z])")


def default_models() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Tokenizers:
    """Both vocabularies with the bytes of their ids."""

    def __init__(self, first: str, second: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        import tokenizers
        self.first = tokenizers.Tokenizer.from_file(first)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=second)
        # byte-level letters: the printable ones stand for themselves, the others follow from U+0100 on
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
        ids = range(self.first.get_vocab_size())
        names = [self.first.id_to_token(i) or "" for i in ids]
        bodies = [bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode() for t in names]
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        spelt = [bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        assert len(pieces) <= 1 << SECOND_BITS
        # an id, and what follows it in the spelling of the groups
        self.spelling = pa.array([f"{i}{c}" for n, marks in ((len(bodies), ",|"), (len(pieces), ",;")) for c in marks for i in range(n)],
                                 pa.large_string())
        self.base = 2 * len(bodies), len(bodies), len(pieces)
        self.names = bodies, spelt
        self.sizes = [np.array([len(x) for x in names], np.int64) for names in self.names]
        begins = self.first.pre_tokenizer
        self.splits = (not any(re.search("[^▁]▁", p) for p in pieces) and begins is not None
                       and [w for w, _ in begins.pre_tokenize_str("a b")] == ["a", "Ġb"])

    def pieces(self, text: str, size: int):
        """``text`` in pieces that both encode as they would the whole; the blank at a cut is left out."""
        start = 0
        while self.splits and len(text) - start > size:
            cut = SPLIT.search(text, start + size)
            if cut is None:
                break
            yield text[start:cut.start()]
            start = cut.end()
        yield text[start:]

    def words(self, pieces: list[str]) -> tuple[pa.Array, np.ndarray]:
        """(words, limits of the pieces in them): each piece in UTF-8 with a blank before it, cut before
        the blanks that follow a word. Every word begins with a blank, and none is a blank alone."""
        bodies = [b" " + p.encode("utf-8", "surrogatepass") for p in pieces]
        limits = np.concatenate(([0], np.cumsum([len(x) for x in bodies], dtype=np.int64)))
        body = b"".join(bodies)
        data, begins = np.frombuffer(body, np.uint8), np.zeros(len(body), bool)
        if self.splits:
            blanks = np.flatnonzero(data == 0x20)
            begins[blanks[closed(data, blanks)]] = True
            begins[limits[1:] - 1] = False
        begins[limits[:-1]] = True
        starts = np.flatnonzero(begins)
        offsets = np.append(starts, len(data))
        return (pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)]),
                np.searchsorted(offsets, limits))

    def encode(self, parts: list[bytes]):
        """(whether the tokens of both spell it, the ids of either) of every part, which begins with a blank."""
        texts = [p.decode("utf-8", "surrogatepass") for p in parts]
        first = self.first.encode_batch_fast(texts, add_special_tokens=False)
        second = self.second.encode([t[1:] for t in texts], num_threads=1)
        for part, found in zip(parts, zip((e.ids for e in first), second)):
            yield all(b"".join(map(names.__getitem__, ids)) == part for names, ids in zip(self.names, found)), *found


def closed(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a character that is no blank of any kind ends before the places ``at`` of UTF-8 ``data``.
    Not said of all: beyond ASCII only of those whose lead byte no blank has."""
    last, two, three = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
    longer, middle = last >= 0x80, (two >= 0x80) & (two < 0xC0)
    return ((last > 0x20) & (last < 0x7F) | longer & (two >= 0xC3) & (two < 0xE0)
            | longer & middle & ((three == 0xE0) | (three >= 0xE4) & (three < 0xF0)))


def spans(offsets: pa.Array) -> np.ndarray:
    return np.frombuffer(offsets.buffers()[1], np.int64)[offsets.offset:offsets.offset + len(offsets) + 1]


def aligned(both: Tokenizers, words: pa.Array):
    """(valid, counts (first, second, groups, links), spelt groups, link limits, pairs) of the words.

    Words are encoded in lots that are one text; a lot whose tokens don't spell it, word by word."""
    data, limits = raw_bytes(words)
    lots = np.unique(np.concatenate([np.arange(0, len(words), LOT), np.flatnonzero(~closed(data, limits[1:])) + 1, [len(words)]]))

    def found(lots):
        parts = [data[limits[i]:limits[j]].tobytes() for i, j in lots]
        return [(i, j, *ids) for (i, j), ids in zip(lots, both.encode(parts))]

    tried = found(list(zip(lots[:-1].tolist(), lots[1:].tolist())))
    good = [t for t in tried if t[2] or t[1] - t[0] == 1]
    alone = [(k, k + 1) for i, j, fits, *_ in tried if not fits and j - i > 1 for k in range(i, j)]
    if alone:
        good = sorted(good + found(alone), key=lambda t: t[0])
    valid = np.repeat(np.array([t[2] for t in good], bool), [t[1] - t[0] for t in good])
    a, b = (np.fromiter(itertools.chain.from_iterable(t[k] for t in good if t[2]), np.int64) for k in (3, 4))
    a_end, b_end = (np.cumsum(n[ids]) for n, ids in zip(both.sizes, (a, b)))
    ends = np.cumsum(np.diff(limits) * valid)
    a_limits, b_limits = (np.concatenate(([0], np.searchsorted(e, ends, "right"))) for e in (a_end, b_end))
    cut, times = np.unique(np.concatenate([a_end, b_end]), return_counts=True)
    common = cut[times == 2]
    link_limits = np.concatenate(([0], np.searchsorted(cut, ends, "right")))
    groups = np.diff(np.concatenate(([0], np.searchsorted(common, ends, "right"))))
    pairs = (a[np.searchsorted(a_end, cut)] << SECOND_BITS) | b[np.searchsorted(b_end, cut)]
    # the tokens of each group, those of the first tokenizer before those of the second
    a_group, b_group = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
    second, n_first, n_second = both.base
    spelt = np.zeros(len(a) + len(b), np.int64)
    closes = [np.append(g[1:] != g[:-1], True)[:len(g)] for g in (a_group, b_group)]
    spelt[np.arange(len(a)) + np.searchsorted(b_group, a_group)] = a + n_first * closes[0]
    spelt[np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")] = second + b + n_second * closes[1]
    spelling = both.spelling.take(pa.array(spelt))
    at = (spans(spelling) - spans(spelling)[0])[a_limits + b_limits]
    text = pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(at), spelling.buffers()[2] or pa.py_buffer(b"")])
    return valid, np.stack([np.diff(a_limits), np.diff(b_limits), groups, np.diff(link_limits)], axis=1), text, link_limits, pairs


def linked(both: Tokenizers, coded: pa.DictionaryArray, limits: np.ndarray, slots: np.ndarray):
    """(valid, counts (first, second, groups, links), spelt groups) of pieces of documents ``slots``, whose words
    are ``coded``, then (keys, times) of the documents' pairs."""
    word = coded.indices.to_numpy().astype(np.int64)
    valid, counts, spelt, link_limits, pairs = aligned(both, coded.dictionary)
    spelling = spelt.take(coded.indices)
    at = (spans(spelling) - spans(spelling)[0])[limits]
    text = memoryview(spelling.buffers()[2] or b"").cast("B")
    keys, times = bitmaps.either((word << bitmaps.SLOT_BITS) | np.repeat(slots, np.diff(limits)), np.ones(len(word), np.int64))
    owners = keys >> bitmaps.SLOT_BITS
    n = np.diff(link_limits)[owners]
    of = np.repeat(link_limits[owners] - np.cumsum(n) + n, n) + np.arange(n.sum())
    made = bitmaps.either((pairs[of] << bitmaps.SLOT_BITS) | np.repeat(keys & (bitmaps.SLOTS - 1), n), np.repeat(times, n))
    return (np.logical_and.reduceat(valid[word], limits[:-1]), np.add.reduceat(counts[word], limits[:-1]),
            [text[low:high] for low, high in zip(at[:-1], at[1:])], *made)


class Container:
    """The documents and postings of one container while they are gathered."""

    def __init__(self):
        self.ids, self.counts, self.digests, self.failed = [], [], [], []
        self.keys, self.times, self.waiting, self.size = [], [], [], 0

    def open(self, id_):
        self.ids.append(id_)
        self.counts.append(np.zeros(4, np.int64))
        self.digests.append(None)
        self.failed.append(False)

    def add(self, both: Tokenizers, work: list[tuple[int, str]]):
        """Encode (document, piece) pairs; the pieces of a document come in order."""
        words, limits = both.words([piece for _, piece in work])
        coded = words.dictionary_encode()
        if len(work) > 1 and spans(coded.dictionary)[-1] > DISTINCT:  # few words come again
            half = len(work) // 2
            del words, coded
            self.add(both, work[:half])
            return self.add(both, work[half:])
        valid, counts, spelt, keys, times = linked(both, coded, limits, np.array([slot for slot, _ in work]))
        for k, (slot, _) in enumerate(work):
            self.counts[slot] += counts[k]
            self.failed[slot] |= not valid[k]
            if len(spelt[k]):
                if self.digests[slot] is None:
                    self.digests[slot] = hashlib.sha256(spelt[k][:-1])
                else:
                    self.digests[slot].update(b";")
                    self.digests[slot].update(spelt[k][:-1])
        self.keys.append(keys)
        self.times.append(times)
        self.size += len(keys)
        if self.size > 2 * CONTAINER_POSTINGS:  # one very long text: its pieces share most pairs
            self.merge()

    def merge(self):
        keys, times = bitmaps.either(np.concatenate(self.keys or [np.zeros(0, np.int64)]),
                                     np.concatenate(self.times or [np.zeros(0, np.int64)]))
        self.keys, self.times, self.size = [keys], [times], len(keys)

    def close(self, name: int, out: pa.Schema):
        """Record batches: the documents, then the postings of every pair and plane."""
        self.merge()
        failed, n = np.array(self.failed, bool), len(self.ids)
        counts = np.array(self.counts).reshape(n, 4) * ~failed[:, None]
        digests = [d.hexdigest() if d is not None and not f else "" for d, f in zip(self.digests, failed)]
        first = [pa.array(np.full(n, name)), pa.array(np.arange(n)), pa.array(self.ids, out.field("id").type),
                 *[pa.array(c) for c in counts.T], pa.array(digests), *[pa.nulls(n) for _ in range(4)]]
        yield first
        keys, times = self.keys[0], self.times[0]
        alive = ~failed[keys & (bitmaps.SLOTS - 1)] if len(keys) else np.zeros(0, bool)
        for plane, chosen in bitmaps.planes(keys[alive], times[alive]):
            pairs, packed = bitmaps.pack(chosen)
            bits = bitmaps.popcount(packed)
            for k in range(0, len(pairs), POSTING_ROWS):
                some = pairs[k:k + POSTING_ROWS]
                yield [pa.array(np.full(len(some), name)), *[pa.nulls(len(some)) for _ in range(7)], pa.array(some),
                       pa.array(np.full(len(some), plane)), pa.array(bits[k:k + POSTING_ROWS]), packed.slice(k, len(some))]


def inverted(docs: DataFrame, id_: str, text: str, models: tuple[str, str] | None) -> DataFrame:
    """Rows of documents (pair is null) and of postings (pair, plane, n, bits), written to the shared folder."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(f"`{id_}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([
        *T.StructType.fromDDL("container bigint, slot int").fields, source.schema["id"],
        *T.StructType.fromDDL("n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
                              "pair bigint, plane int, n bigint, bits binary").fields])

    def run(batches):
        from pyspark import TaskContext
        out, base = to_arrow_schema(schema), TaskContext.get().partitionId() << 32
        paths = models or default_models()
        both = only(("alignment", paths), lambda: Tokenizers(*paths))
        now, serial, work, size = Container(), 0, [], 0

        def rows(made):
            return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(made, out, strict=True)], schema=out)

        for batch in batches:
            for id_value, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                now.open(id_value)
                for piece in both.pieces(body.as_py(), PIECE) if body.is_valid and len(body.as_py()) else ():
                    work.append((len(now.ids) - 1, piece))
                    size += len(piece)
                    if size > SLICE:
                        now.add(both, work)
                        work, size = [], 0
                if len(now.ids) == bitmaps.SLOTS or now.size > CONTAINER_POSTINGS:
                    if work:
                        now.add(both, work)
                    yield from map(rows, now.close(base + serial, out))
                    now, serial, work, size = Container(), serial + 1, [], 0
            give_back()
        if work:
            now.add(both, work)
        if now.ids:
            yield from map(rows, now.close(base + serial, out))

    return materialise(source.mapInArrow(run, schema), "inverted")


@dataclass
class Alignment:
    """``documents``: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, one row a document.
    ``pairs``: a, b, docs (documents that hold the pair linked), links (all of them), best (no other pair of ``a`` has more documents)."""
    documents: DataFrame
    pairs: DataFrame


def align(docs: DataFrame, id_: str = "doc_id", text: str = "text", models: tuple[str, str] | None = None) -> Alignment:
    """Align the tokens of a byte-level vocabulary (of blank and text) and of a piece vocabulary (of the text).

    ``models`` are the two files, which every executor can read; None are the installed ones.
    Byte offsets where tokens of both end cut a text into groups, which ``groups_sha256`` spells:
    ``a1,a2|b1;a3|b2``. Null and empty texts, and those whose tokens do not spell blank and text,
    have no tokens, zeros and an empty ``groups_sha256``. Every row is a document of its own, repeated
    ids and equal rows too; all ties of the highest count are best; other columns have no part.
    No rows, no pairs.
    """
    table = inverted(docs, id_, text, models)
    postings = table.where("pair IS NOT NULL")
    times = F.when(F.col("plane") == 0, F.col("n")).otherwise(F.lit(0))
    counts = postings.groupBy("pair").agg(
        F.sum(times).alias("docs"), F.sum(F.col("n") * F.expr("shiftleft(1L, greatest(plane - 1, 0))")).alias("links"))
    counts = counts.withColumn("a", F.shiftright("pair", SECOND_BITS))
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    scores = materialise(counts.join(most, "a").select(
        "pair", "a", F.col("pair").bitwiseAND((1 << SECOND_BITS) - 1).alias("b"), "docs", "links",
        (F.col("docs") == F.col("most")).alias("best")), "scores")
    scored = broadcast_if_small(scores.select("pair", "docs", "best"), SCORE_BYTES, SCORE_LIMIT)
    bits = postings.select("container", "pair", "plane", "bits").join(scored, "pair")
    named = table.where("pair IS NULL").drop("pair", "plane", "n", "bits")
    rows = named.unionByName(bits, allowMissingColumns=True)
    rows = rows.repartition("container").sortWithinPartitions("container")
    kept = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = T.StructType([named.schema[c] for c in kept] + T.StructType.fromDDL("n_best bigint, count_sum bigint").fields)

    def run(batches):
        out = to_arrow_schema(schema)
        now, best, total, found = None, None, None, []

        def done():
            docs = pa.Table.from_batches(found)
            slots = docs["slot"].to_numpy()
            arrays = [docs[c].combine_chunks() for c in kept] + [pa.array(best[slots]), pa.array(total[slots])]
            yield from pa.table(arrays, schema=out).to_batches()

        for batch in batches:
            containers = batch.column("container").to_numpy()
            starts = np.flatnonzero(np.append(True, containers[1:] != containers[:-1]))
            for start, end in zip(starts, np.append(starts[1:], len(containers))):
                if containers[start] != now:
                    if found:
                        yield from done()
                    now, found = containers[start], []
                    best, total = np.zeros(bitmaps.SLOTS, np.int64), np.zeros(bitmaps.SLOTS, np.int64)
                part = batch.slice(start, end - start)
                posted = part.column("pair").is_valid()
                found.append(part.filter(pc.invert(posted)))
                part = part.filter(posted)
                row, slot = bitmaps.unpack(part.column("bits"))
                times = bitmaps.weight(part.column("plane").to_numpy())
                np.add.at(total, slot, (times * part.column("docs").to_numpy())[row])
                np.add.at(best, slot, (times * part.column("best").to_numpy(zero_copy_only=False))[row])
        if found:
            yield from done()
        give_back()

    return Alignment(rows.mapInArrow(run, schema).select(F.col("id").alias(id_), *kept[1:], "n_best", "count_sum"),
                     scores.select("a", "b", "docs", "links", "best"))


def op12(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return align(docs).documents.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
