"""SentencePiece encoding and decoding with a weighted transducer.

Three machines are compiled: the normaliser (a space mark before the text and for each
blank), the pieces, and the byte fallback (one arc per byte for characters without a
piece). Composed with a text they give a lattice of (position, last piece); an arc weighs 0
where the two pieces may stand side by side and infinity where a better merge would cross
their limit. Exactly one path has a finite weight, the shortest in the tropical semiring.
The composition is made deterministic while it is built (``pieces``), so relaxing the arcs
of a position is one look-up, and the path is read backwards along the last pieces.

A merge vocabulary has no additive scores: the sum of its piece scores would choose other
pieces than the library does, hence the 0/infinity weights.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from likeness.llm import pieces
from likeness.llm.text import SLICE_BYTES, code_points, map_text
from likeness.llm.token_counts import default_model


def encode(docs: DataFrame, model: str | None = None, text: str = "text", keep=None, verify: bool = False,
           most: int = SLICE_BYTES) -> DataFrame:
    """``docs`` with ``ids`` (array of piece ids, as the library gives them) and ``n_ids``.

    With ``verify`` also ``round_trip``: the ids were decoded and gave the text back (with
    blanks for space marks). Null and empty texts have an empty array. Rows, repeated
    ones included, map one to one; columns of these names are replaced. Tasks work on ``most`` bytes at a time.
    """
    def make():
        machine = pieces.machine(model or default_model())

        def kernel(texts):
            ids, rows = machine.encode(*code_points(texts))
            out = [pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(ids, pa.int32())), np.diff(rows)]
            if verify:
                plain = pc.replace_substring(texts, pieces.SPACE, " ")
                out.append(pc.equal(spell(machine, ids, rows), plain))
            return out
        return kernel

    return map_text(docs, make, "ids array<int>, n_ids bigint" + ", round_trip boolean" * verify, text, keep, most)


def spell(machine, ids: np.ndarray, rows: np.ndarray) -> pa.Array:
    """The texts of piece ids; bytes that make no character become U+FFFD, as in the library."""
    known = (ids >= 0) & (ids < machine.n_pieces)
    if not known.all():
        raise ValueError("piece ids out of range")
    parts = pc.take(pa.array(machine.surface, pa.large_binary()), pa.array(ids, pa.int64()))
    if isinstance(parts, pa.ChunkedArray):
        parts = parts.combine_chunks()
    if not len(parts):
        return pa.array([""] * (len(rows) - 1), pa.large_string())
    ends = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset:parts.offset + len(parts) + 1]
    data = parts.buffers()[2].to_pybytes()
    limits = ends[rows].tolist()
    out = []
    for a, b in zip(limits[:-1], limits[1:]):
        piece = data[a:b].decode("utf-8", "replace")
        out.append(piece[1:] if machine.starts_with_space and piece[:1] == " " else piece)
    return pa.array(out, pa.large_string())


def decode(coded: DataFrame, model: str | None = None, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``coded`` with the text of its piece ids in column ``name``; null or empty ids give ''.

    The normaliser's first blank is taken off, so texts come back as they were but for a
    space mark U+2581 in the text itself, which is a blank afterwards. Ids outside the
    vocabulary are an error.
    """
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema
    rest = [c for c in coded.columns if c != name]
    source = coded.select(*rest, F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("__ids"))
    schema = T.StructType([source.schema[c] for c in rest] + [T.StructField(name, T.StringType())])

    def run(batches):
        machine, out = pieces.machine(model or default_model()), to_arrow_schema(schema)
        for batch in batches:
            lists = batch.column(len(rest))
            rows = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset:lists.offset + len(lists) + 1].astype(np.int64)
            start = 0
            while start < len(lists):  # by slices of about a million pieces
                stop = max(int(np.searchsorted(rows, rows[start] + (1 << 20), "right")) - 1, start + 1)
                stop = min(stop, len(lists))
                flat = lists.values.slice(rows[start], rows[stop] - rows[start]).to_numpy(zero_copy_only=False)
                texts = spell(machine, flat, rows[start:stop + 1] - rows[start])
                columns = [c.slice(start, stop - start) for c in batch.columns[:len(rest)]] + [texts]
                yield pa.RecordBatch.from_arrays(
                    [c if c.type == f.type else c.cast(f.type) for c, f in zip(columns, out)], schema=out)
                start = stop

    return source.mapInArrow(run, schema)


def op3(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids and whether decoding the ids gives the text back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, keep=["doc_id"], verify=True).select("doc_id", "n_ids", "ids", "round_trip")
