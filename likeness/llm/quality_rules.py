"""Quality rules: base counts, and a hashed n-gram likelihood ratio with a fixed threshold.

Two multinomials over hashed four-byte sequences are counted: one over the trusted documents
(all that are labelled good) and one over the whole raw corpus. A text's score is the mean logarithm of their ratio over its sequences, so it does not depend on
length. The threshold lies as far below a low quantile of the trusted documents' own scores as
their median lies above it, both exact: every document from there on is kept, deterministically.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from likeness.llm.ranks import value_at
from likeness.llm.text import map_text, raw_bytes, slices, small_batches, whole
from likeness.session import BROADCAST_BYTES, materialise

WIDTH, HASH_BITS = 4, 16
BUCKETS = 1 << HASH_BITS
# Bytes of a trusted id that is sent out, as measured; ids beyond BROADCAST_BYTES are joined.
ID_BYTES = 72
SMOOTH = 1.0
QUANTILE = 0.002
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"


def buckets_of(data: np.ndarray) -> np.ndarray:
    """The bucket of the sequence that ends at each byte (blanks and line ends alike)."""
    codes = data.astype(np.uint32)
    codes = np.where(np.isin(data, np.frombuffer(BLANKS, np.uint8)), np.uint32(32), codes)
    key = codes.copy()
    for back in range(1, WIDTH):
        key[back:] |= codes[:-back] << np.uint32(8 * back)
    return (key * np.uint32(2654435761)) >> np.uint32(32 - HASH_BITS)


def inner(limits: np.ndarray, n: int) -> np.ndarray:
    """Places whose sequence lies in one text: not the first WIDTH - 1 bytes of a text."""
    keep = np.ones(n, bool)
    for k in range(WIDTH - 1):
        at = limits[:-1] + k
        keep[at[at < limits[1:]]] = False
    return keep


def sequence_counts(docs: DataFrame, trusted: str = "trusted", text: str = "text") -> DataFrame:
    """(bucket, target, raw): sequences of the trusted rows and of all rows, per bucket."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(trusted).cast("boolean").alias("t"), F.col(text).cast("string").alias("text"))

    def run(batches):
        n = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            texts = whole(batch.column(1))
            good = batch.column(0).fill_null(False).to_numpy(zero_copy_only=False)
            for start, stop in slices(texts):
                data, limits = raw_bytes(texts.slice(start, stop - start))
                key, keep = buckets_of(data), inner(limits, len(data))
                n[1] += np.bincount(key[keep], minlength=BUCKETS)
                keep &= np.repeat(good[start:stop], np.diff(limits))
                n[0] += np.bincount(key[keep], minlength=BUCKETS)
        some = np.flatnonzero(n[1])
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[0, some]), pa.array(n[1, some])],
                                         names=["bucket", "target", "raw"])

    return source.mapInArrow(run, "bucket int, target bigint, raw bigint").groupBy("bucket").agg(
        F.sum("target").alias("target"), F.sum("raw").alias("raw"))


def counts_with(docs: DataFrame, good: DataFrame, sent: bool, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """``sequence_counts`` where the ids ``__t`` of ``good``, each once, are trusted; without ``sent`` only
    the trusted texts are met by a join, the raw counts need none."""
    met = F.col(id_) == F.col("__t")
    if sent:
        marked = docs.join(F.broadcast(good), met, "left").withColumn("__trusted", F.col("__t").isNotNull())
        return sequence_counts(marked, "__trusted", text)
    every = sequence_counts(docs.withColumn("__trusted", F.lit(False)), "__trusted", text)
    own = sequence_counts(docs.join(good, met, "left_semi").withColumn("__trusted", F.lit(True)), "__trusted", text)
    return every.union(own.withColumn("raw", F.lit(0).cast("bigint"))).groupBy("bucket").agg(
        F.sum("target").alias("target"), F.sum("raw").alias("raw"))


def ratios(counts: DataFrame) -> np.ndarray:
    """log(target share / raw share) of each bucket, smoothed; at most BUCKETS rows are gathered."""
    rows = counts.toPandas()
    target, raw = np.zeros(BUCKETS), np.zeros(BUCKETS)
    target[rows["bucket"]], raw[rows["bucket"]] = rows["target"], rows["raw"]
    return (np.log((target + SMOOTH) / (target.sum() + SMOOTH * BUCKETS))
            - np.log((raw + SMOOTH) / (raw.sum() + SMOOTH * BUCKETS)))


def base_counts(data: bytes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a UTF-8 text."""
    words = data.split()
    n = len(words)
    chars = len(data.translate(None, BLANKS).decode("utf-8", "replace")) if n else 0
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip(BLANKS)] if b"\n" in data else []
    repeats = 0
    if n >= 3:
        names: dict[bytes, int] = {}
        ids = np.array([names.setdefault(w, len(names)) for w in words], np.int64)
        m = len(names)
        if m < 1 << 21:
            windows = (ids[:-2] * m + ids[1:-1]) * m + ids[2:]
        else:
            pairs = np.unique(ids[:-1] * m + ids[1:], return_inverse=True)[1]
            windows = pairs[:-1] * m + ids[2:]
        order = np.argsort(windows, kind="stable")
        ranked = windows[order]
        same = ranked[1:] == ranked[:-1]
        if same.any():
            twice = np.zeros(len(windows), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            covered = np.zeros(n, bool)
            for k in range(3):
                covered[k:n - 2 + k] |= twice
            repeats = int(covered.sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeats


def rated(docs: DataFrame, log_ratio: np.ndarray, text: str = "text", keep=None) -> DataFrame:
    """``docs`` with the base counts and ``score``, the mean log ratio of its sequences (0 for
    texts of fewer than four bytes)."""
    shipped = docs.sparkSession.sparkContext.broadcast(log_ratio)

    def make():
        def kernel(texts):
            data, limits = raw_bytes(texts)
            keep_ = inner(limits, len(data))
            values = np.where(keep_, shipped.value[buckets_of(data)], 0.0) if len(data) else np.zeros(0)
            n = np.maximum(np.diff(limits) - (WIDTH - 1), 0)
            sums = np.zeros(len(n))
            some = np.diff(limits) > 0
            if some.any():
                sums[some] = np.add.reduceat(values, limits[:-1][some])
            base = np.array([base_counts(t) for t in texts.cast(pa.large_binary()).to_pylist()], np.int64).reshape(-1, 5)
            return [*base.T, sums / np.maximum(n, 1)]
        return kernel

    return map_text(docs, make, "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
                                "n_repeat_words bigint, score double", text, keep)


def apply_rules(docs: DataFrame, trusted_ids: DataFrame, id_: str = "doc_id", text: str = "text", keep=None) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ``score``,
    ``base_failed`` and ``kept``.

    ``trusted_ids`` holds the ids (in a column named ``id_``) of documents labelled good; all of them
    are counted and set the threshold. Null and empty texts have no words, score 0 and
    fail the base rules. Without trusted documents the ratio is flat and only the base rules
    decide. Repeated rows stay, and count as often as they occur.
    """
    made = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed", "kept")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in made]
    good = materialise(trusted_ids.select(F.col(id_).alias("__t")).where("__t IS NOT NULL").distinct(), "trusted")
    sent = good.count() * ID_BYTES <= BROADCAST_BYTES
    log_ratio = ratios(counts_with(docs, good, sent, id_, text))
    scores = materialise(rated(docs.withColumn("__id", F.col(id_)), log_ratio, text, [*kept, "__id"]), "rated")
    own = materialise(scores.where("n_words > 0").join(
        F.broadcast(good) if sent else good, F.col("__id") == F.col("__t"), "left_semi").select("score"), "trusted_scores")
    n = own.count()
    edge = 2 * value_at(own, "score", math.ceil(QUANTILE * n)) - value_at(own, "score", math.ceil(n / 2)) if n else float("-inf")
    base = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return scores.withColumn("base_failed", base).withColumn(
        "kept", ~base & (F.col("score") >= F.lit(edge))).drop("__id")


def op5(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    return apply_rules(docs, good, keep=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
