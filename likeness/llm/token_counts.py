"""Token counts by a finite-state tokenizer.

The vocabulary is compiled to a deterministic transducer whose transitions carry the
change of the token count (``pieces``). Texts are cut into chunks, mostly at places where
the machine starts anew whatever came before; all chunks of a slice advance together, and
the chunk maps (entry state -> exit state, count) of a text are composed by a parallel
prefix scan. No text is cut short, and a run of millions of letters is many chunks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from likeness.llm import pieces
from likeness.llm.text import code_points, map_text, raw_bytes


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def count_tokens(docs: DataFrame, model: str | None = None, text: str = "text", limit: int = 4096,
                 keep=None) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Counts are those of the SentencePiece library without begin and end marks. Null and
    empty texts have 0 bytes and 0 tokens. One row comes out per row, repeated rows
    included; columns of these names are replaced, all others handed on (or those of
    ``keep``). ``model`` is a path that every executor can read; None is the installed file.
    """
    def make():
        machine = pieces.machine(model or default_model())

        def kernel(texts):
            points, limits = code_points(texts)
            n = machine.count(points, limits)
            return [np.diff(raw_bytes(texts)[1]), n, n > limit]
        return kernel

    return map_text(docs, make, "n_bytes bigint, n_tokens bigint, over_limit boolean", text, keep)


def op1(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs.select("doc_id", "text"), keep=["doc_id"]).select(
        "doc_id", "n_bytes", "n_tokens", F.col("over_limit"))
