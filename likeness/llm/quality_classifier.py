"""Quality scores by regularised quadratic discriminant analysis.

Each document gives a vector of transformed statistics. Mean and covariance of either class
are sums over all labelled training rows, computed by Spark; the covariances are shrunk
towards their pooled one and a multiple of the identity. A document's score is the logistic
of the difference of the two log densities, each a Mahalanobis distance under the class's
Cholesky factor, which is computed once and shipped.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from likeness.llm.text import map_text, raw_bytes
from likeness.session import materialise

STATISTICS = ("word_length", "upper", "symbols", "marks", "bars", "digits", "distinct", "lines", "accents",
              "long_words")
POOL, RIDGE = 0.1, 1e-4
# Usual words that every text is thought to hold besides its own, so that very short ones aren't extreme.
PRIOR_WORDS = 20
LOWER, UPPER, DIGIT, BLANK, NEWLINE, SYMBOL, MARK, BAR, REST, HIGH = range(10)


def byte_kinds() -> np.ndarray:
    kinds = np.full(256, REST, np.uint8)
    for chars, kind in ((b"abcdefghijklmnopqrstuvwxyz", LOWER), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", UPPER),
                        (b"0123456789", DIGIT), (b" \t\x0b\x0c\r", BLANK), (b"\n", NEWLINE), (b"#*$%&<>", SYMBOL),
                        (b"!?", MARK), (b"|", BAR)):
        kinds[np.frombuffer(chars, np.uint8)] = kind
    kinds[0x80:] = HIGH
    return kinds


KINDS = byte_kinds()


def statistics(data: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """One row of STATISTICS a text, its own words and PRIOR_WORDS usual ones taken together."""
    n = len(limits) - 1
    row = np.repeat(np.arange(n), np.diff(limits))
    kind = KINDS[data]
    counts = np.bincount(row * 10 + kind, minlength=10 * n).reshape(n, 10).astype(np.float64)
    inside = (kind != BLANK) & (kind != NEWLINE)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = limits[:-1][np.diff(limits) > 0]
    begins[first] = inside[first]
    starts = np.flatnonzero(begins)
    words = np.bincount(row[starts], minlength=n).astype(np.float64)
    # a word's bytes, weighed by place, give it a number; only the share of different ones matters
    word = np.cumsum(begins) - 1
    place = np.arange(len(data)) - starts[word] if len(starts) else np.zeros(len(data), np.int64)
    weights = np.random.default_rng(7).integers(1, 1 << 62, 64, dtype=np.int64).astype(np.uint64) | np.uint64(1)
    mixed = np.where(inside, (data.astype(np.uint64) + np.uint64(1)) * weights[place & 63], np.uint64(0))
    length = np.zeros(0)
    distinct = np.zeros(n)
    if len(starts):
        names = np.add.reduceat(mixed, starts) * np.uint64(0x9E3779B97F4A7C15)
        owner = row[starts].astype(np.uint64)
        unique = np.unique((names >> np.uint64(24)) | (owner << np.uint64(40)))
        distinct = np.bincount((unique >> np.uint64(40)).astype(np.int64), minlength=n).astype(np.float64)
        length = np.add.reduceat(inside.astype(np.int64), starts)
    long_ = np.bincount(row[starts], weights=length > 12, minlength=n) if len(starts) else np.zeros(n)
    bytes_ = counts.sum(axis=1) + 5 * PRIOR_WORDS
    letters = counts[:, [LOWER, UPPER, HIGH]].sum(axis=1) + 5 * PRIOR_WORDS
    some = words + PRIOR_WORDS  # shares are those of the text and of some usual words

    def spread(share):  # square roots hold rare and common characters apart alike
        return np.sqrt(share)

    return np.stack([
        np.log((counts.sum(axis=1) - counts[:, BLANK] - counts[:, NEWLINE] + 5 * PRIOR_WORDS) / some),
        spread(counts[:, UPPER] / letters), spread(counts[:, SYMBOL] / bytes_), spread(counts[:, MARK] / some), spread(counts[:, BAR] / some),
        spread(counts[:, DIGIT] / bytes_), np.log((distinct + PRIOR_WORDS) / some) / np.log(words + 8),
        np.log1p((counts[:, NEWLINE] + 1) / some * 20), spread(counts[:, HIGH] / bytes_), spread(long_ / some)], axis=1)


def described(docs: DataFrame, text: str = "text", keep=None) -> DataFrame:
    """``docs`` with one double column per statistic."""
    def make():
        def kernel(texts):
            return list(statistics(*raw_bytes(texts)).T)
        return kernel
    return map_text(docs, make, ", ".join(f"{s} double" for s in STATISTICS), text, keep)


def fit(rows: DataFrame, label: str = "quality"):
    """[(log prior, mean, inverse Cholesky factor, log determinant)] of classes 0 and 1, or None
    when one has fewer than two rows. Two rows of sums reach the driver."""
    pairs = list(itertools.combinations_with_replacement(range(len(STATISTICS)), 2))
    sums = rows.where(F.col(label).isin(0, 1)).groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(s).alias(f"s{i}") for i, s in enumerate(STATISTICS)],
        *[F.sum(F.col(STATISTICS[i]) * F.col(STATISTICS[j])).alias(f"p{i}_{j}") for i, j in pairs]).collect()
    by = {r[label]: r for r in sums}
    if any(by.get(k) is None or by[k]["n"] < 2 for k in (0, 1)):
        return None
    stats, total = [], sum(by[k]["n"] for k in (0, 1))
    for k in (0, 1):
        n, mean = by[k]["n"], np.array([by[k][f"s{i}"] for i in range(len(STATISTICS))]) / by[k]["n"]
        square = np.zeros((len(STATISTICS),) * 2)
        for i, j in pairs:
            square[i, j] = square[j, i] = by[k][f"p{i}_{j}"] / n
        stats.append((n, mean, square - np.outer(mean, mean)))
    pooled = sum(n * c for n, _, c in stats) / total
    out = []
    for n, mean, own in stats:
        cov = (1 - POOL) * own + POOL * pooled
        cov = cov + RIDGE * max(np.trace(cov) / len(cov), 1e-6) * np.eye(len(cov))
        factor = np.linalg.cholesky(cov)
        out.append((float(np.log(n / total)), mean, np.linalg.inv(factor), 2 * float(np.log(np.diag(factor)).sum())))
    return out


def log_odds(x: np.ndarray, classes) -> np.ndarray:
    logs = [prior - 0.5 * (det + (((x - mean) @ inverse.T) ** 2).sum(axis=1)) for prior, mean, inverse, det in classes]
    return logs[1] - logs[0]


def score_quality(docs: DataFrame, labels: DataFrame, training, id_: str = "doc_id", text: str = "text",
                  label: str = "quality", threshold: float = 0.3, keep=None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted``.

    ``training`` is the condition on ``docs`` that marks the rows whose label may be learnt; a row
    with two labels counts once for each. Labels, ids and other columns are no input of a score;
    null and empty texts are scored by their statistics, those of the usual words alone. Without rows of both
    classes every score is 0.5. Repeated rows stay.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted", *STATISTICS)]
    marked = docs.withColumn("__training", F.coalesce(training, F.lit(False))).withColumn("__id", F.col(id_))
    rows = materialise(described(marked, text, [*kept, "__training", "__id"]), "statistics")
    known = labels.select(F.col(id_).alias("__id"), F.col(label).cast("int").alias("__label"))
    classes = fit(rows.where("__training").select("__id", *STATISTICS).join(known, "__id"), "__label")
    shipped = docs.sparkSession.sparkContext.broadcast(classes)
    from pyspark.sql import types as T
    schema = T.StructType([rows.schema[c] for c in kept] + [T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(kept), batch.num_columns)], 1)
            odds = np.zeros(len(x)) if shipped.value is None else log_odds(x, shipped.value)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(1 / (1 + np.exp(-np.clip(odds, -50, 50))))],
                                             names=[*kept, "score"])

    return rows.select(*kept, *STATISTICS).mapInArrow(run, schema).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def held_out(id_: str = "doc_id", folds: int = 5, fold: int = 0):
    return F.coalesce(F.crc32(F.col(id_).cast("string").cast("binary")) % folds == fold, F.lit(False))


def op8(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_quality(docs, labels, ~held_out(), keep=["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted")
