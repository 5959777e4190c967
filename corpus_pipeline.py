"""From raw documents to token ids: five stages, each one operator of ``likeness.llm``.

A stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. The
first four return the columns of ``documents``, the last one piece ids in training order.
Every stage takes null and empty texts, null or repeated ids, equal rows, empty tables and columns of
any name, which it hands on; the functions say what becomes of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import likeness
from likeness.llm import curriculum, language, piece_codec, secrets, simhash
from likeness.session import materialise, ship


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a rejected language stay; models learn from the op2 training fold of ``docs``.
    Null, empty and letterless texts go; rows of equal texts stay or go together."""
    ship(spark, likeness)
    found = language.identify(docs, ~language.held_out())
    return found.where(~F.col("rejected")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies stays (fingerprints of
    three-word shingles within two bits, as for op4). Texts without a word are copies of each other;
    of equal rows one stays; null ids are rows like others."""
    ship(spark, likeness)
    return simhash.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays, with its new length."""
    ship(spark, likeness)
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else clean


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a null source is a source, documents without words weigh
    nothing. The columns of ``documents`` cannot tell an order: ``encoding`` finds it from the rows."""
    ship(spark, likeness)
    columns = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)]  # names that no operator makes
    roles = {name: f"c{docs.columns.index(name)}" for name in ("doc_id", "source", "text")}
    mixed = curriculum.mixture(docs.select(*columns), roles["doc_id"], roles["source"], roles["text"])
    copies = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return mixed.where("copies > 0").select("*", copies.alias("copy")).select(
        *[F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)])


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, lang, position, n_ids, ids) of every row, range-sorted by training position; a
    null or empty text has no ids."""
    ship(spark, likeness)
    placed = curriculum.in_order(docs, keep=["doc_id", "source", "lang", "text"])
    return piece_codec.encode(placed, keep=["doc_id", "source", "lang", "position"], most=ENCODED_BYTES).select(
        "doc_id", "source", "lang", "position", "n_ids", "ids")


# Bytes of text that a task of the last stage encodes at a time: executors also hold what the stages before it left.
ENCODED_BYTES = 1 << 18

STAGES = [("language ID", language_id), ("SimHash near-dedup", near_dedup), ("secret scans", secret_scan),
          ("mixing sources to target weights", mixing), ("SentencePiece encoding", encoding)]

# Fingerprints, trained models and piece ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
