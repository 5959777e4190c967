"""Benchmark decontamination: phrases of test items found in training shards by FM-indexes.

The documents are cut into shards of bounded size, each indexed once (``fm_index``) and
written as one row. Test items are cut into windows of some words; windows come in blocks of
bounded size, and a block is searched in all shards by backward search. Located occurrences
become spans of words, merged per document. A document too long for one shard is
several shards that share some words; its spans are merged by a grouped pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from likeness.llm.fm_index import FIRST, FmIndex
from likeness.llm.text import give_back, map_text, raw_bytes, slices, small_batches, whole
from likeness.session import materialise

WINDOW = 10
# Text of one shard; words of one shard of a longer document, shared words not counted.
SHARD_BYTES, SHARD_WORDS = 2 << 20, 1 << 18
# Text of test items searched at a time, and words of an item's piece.
BLOCK_BYTES, PIECE_WORDS = 4 << 20, 4096

_bytes = np.arange(256)
LOWER = np.where((_bytes >= 65) & (_bytes <= 90), _bytes + 32, _bytes).astype(np.uint8)
IN_WORD = ((_bytes >= 48) & (_bytes <= 57)) | ((LOWER >= 97) & (LOWER <= 122)) | (_bytes >= 128)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-case words of all texts, row limits among them, first byte of each, last byte + 1 of each)."""
    data, limits = raw_bytes(texts)
    inside = IN_WORD[data]
    edge = np.zeros(len(data) + 1, bool)  # a text's end parts words
    edge[limits] = True
    begin = np.flatnonzero(inside & (edge[:-1] | ~np.append(False, inside[:-1])))
    end = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False))) + 1
    offsets = np.concatenate(([0], np.cumsum(end - begin)))
    words = pa.Array.from_buffers(pa.large_binary(), len(begin), [
        None, pa.py_buffer(offsets), pa.py_buffer(LOWER[data[inside]])])
    return words, np.searchsorted(begin, limits), begin, end


def ragged(offsets: np.ndarray, body) -> pa.Array:
    """Large binary values from one buffer."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(body)])


def index_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("shard", T.LongType()), T.StructField("owner", T.LongType()), T.StructField("first", T.LongType()),
        T.StructField("cut", T.BooleanType()), T.StructField("ids", T.ArrayType(id_type)),
        T.StructField("marks", T.ArrayType(T.LongType())), T.StructField("n_words", T.ArrayType(T.LongType())),
        T.StructField("limits", T.BinaryType()), T.StructField("word_ends", T.BinaryType()),
        T.StructField("words", T.BinaryType()), T.StructField("first_place", T.BinaryType()),
        T.StructField("tree", T.BinaryType()), T.StructField("sampled", T.BinaryType()), T.StructField("samples", T.BinaryType())])


def index_shards(docs: DataFrame, id_: str = "doc_id", text: str = "text", longest: int = WINDOW) -> DataFrame:
    """One row a shard with its FM-index, written to the shared folder. Phrases of up to ``longest`` words can be asked.

    Every document is in one shard (``cut`` false), or, when longer than SHARD_WORDS words, alone in
    several (``cut`` true) of one ``owner``, each with ``longest`` - 1 words of the next. Null texts have no words.
    """
    small_batches(docs.sparkSession)
    body = F.col(f"`{text}`").cast("string")
    source = docs.select(F.col(f"`{id_}`").alias("id"), body.alias("text"), F.xxhash64(body).alias("mark"))
    schema = index_schema(source.schema["id"].dataType)

    def run(batches):
        from pyspark import TaskContext
        made, serial, out = TaskContext.get().partitionId() << 32, 0, to_arrow_schema(schema)
        for batch in batches:
            texts = whole(batch.column(1))
            for start, stop in slices(texts, SHARD_BYTES):
                words, limits, _, _ = words_of(texts.slice(start, stop - start))
                pieces = [(0, len(words))]
                if len(limits) == 2 and len(words) > SHARD_WORDS:
                    pieces = [(k, min(k + SHARD_WORDS + longest - 1, len(words))) for k in range(0, len(words), SHARD_WORDS)]
                owner = made + serial
                for low, high in pieces:
                    mine = np.clip(limits, low, high) - low
                    coded = words.slice(low, high - low).dictionary_encode()
                    n, first, tree, marks, samples = FmIndex.build(coded.indices.to_numpy(), mine)
                    ends, body = np.zeros(1, np.int64), b""
                    if len(coded.dictionary):
                        ends = np.concatenate(([0], np.cumsum(pc.binary_length(coded.dictionary).to_numpy())))
                        body = b"".join(coded.dictionary.to_pylist())
                    row = [made + serial, owner, low, len(pieces) > 1, None, None, np.diff(limits).tolist()]
                    row += [x.astype(np.int64).tobytes() for x in (mine, ends)] + [body]
                    row += [first.astype(np.int64).tobytes(), tree.tobytes(), marks.tobytes(), samples.tobytes()]
                    arrays = [pa.array([v], f.type) for v, f in zip(row, out)]
                    for k, c in ((4, 0), (5, 2)):
                        part = batch.column(c).slice(start, stop - start).cast(out.field(k).type.value_type)
                        arrays[k] = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part).cast(out.field(k).type)
                    serial += 1
                    yield pa.RecordBatch.from_arrays(arrays, schema=out)
            give_back()

    return materialise(source.mapInArrow(run, schema), "fm_index")


def item_pieces(items: DataFrame, id_: str, text: str, window: int) -> DataFrame:
    """(item, piece): the words of every item, in pieces that share ``window`` - 1 words; items without words give none."""
    def make():
        def kernel(texts):
            words, limits, _, _ = words_of(texts)
            rows = []
            for low, high in zip(limits[:-1], limits[1:]):
                found = words.slice(low, high - low).to_pylist()
                rows.append([b" ".join(found[k:k + PIECE_WORDS + window - 1]) for k in range(0, len(found), PIECE_WORDS)
                             if k == 0 or len(found) - k >= window])
            return [pa.array(rows, pa.list_(pa.binary()))]
        return kernel

    source = items.select(F.col(f"`{id_}`").cast("string").alias("item"), F.col(f"`{text}`").cast("string").alias("text"))
    return map_text(source, make, "pieces array<binary>", keep=["item"]).select("item", F.explode("pieces").alias("piece"))


def phrases_of(rows: pa.Table, window: int):
    """(vocabulary, phrases as vocabulary places, lengths, items of each phrase, limits in them, item names in string order)."""
    items = rows["item"].combine_chunks().cast(pa.string())
    names = sorted(set(items.to_pylist()), key=lambda s: (s is not None, s))
    place = {name: k for k, name in enumerate(names)}
    owner = np.array([place[i] for i in items.to_pylist()], np.int64)
    words, limits, _, _ = words_of(rows["piece"].combine_chunks().cast(pa.large_binary()))
    coded = words.dictionary_encode()
    codes, size = coded.indices.to_numpy().astype(np.int64), np.diff(limits)
    n = np.where(size >= window, size - window + 1, np.minimum(size, 1))
    row = np.repeat(np.arange(len(n)), n)
    start = limits[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    length = np.minimum(size[row], window)
    steps = np.arange(window)
    grid = np.where(steps < length[:, None], np.append(codes, np.zeros(window, np.int64))[start[:, None] + steps], -1)
    phrases, at = np.unique(grid, axis=0, return_inverse=True)
    pairs = np.unique(at.ravel() * max(len(names), 1) + owner[row]) if len(row) else np.zeros(0, np.int64)
    phrase, item = pairs // max(len(names), 1), pairs % max(len(names), 1)
    return (coded.dictionary, phrases, (phrases >= 0).sum(axis=1), item, np.searchsorted(phrase, np.arange(len(phrases) + 1)), names)


def ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which range, number) for all numbers of the ranges low to high, exclusive."""
    n = high - low
    of = np.repeat(np.arange(len(n)), n)
    return of, low[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)


def search_shards(index: DataFrame, shared) -> DataFrame:
    """(owner, slot, id, mark, n_words, cut, spans, items) for every document of every shard: the merged
    word spans that any phrase of ``shared`` (a broadcast of ``phrases_of``) covers there."""
    spans = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([
        T.StructField("owner", T.LongType()), T.StructField("slot", T.IntegerType()),
        T.StructField("id", index.schema["ids"].dataType.elementType), T.StructField("mark", T.LongType()),
        T.StructField("n_words", T.LongType()), T.StructField("cut", T.BooleanType()), T.StructField("spans", spans),
        T.StructField("items", T.ArrayType(T.StringType()))])

    def hits(row, vocabulary, phrases, lengths, item_of, item_limits):
        """(documents' first places, hit words as a mask, sorted (document, item) pairs)."""
        limits, ends, first, sampled, samples = (np.frombuffer(row[c].as_py(), t) for c, t in (
            ("limits", np.int64), ("word_ends", np.int64), ("first_place", np.int64), ("sampled", np.uint64), ("samples", np.int32)))
        docs, n = len(limits) - 1, int(limits[-1]) + len(limits) - 1
        starts = limits[:-1] + np.arange(docs)
        none = starts, np.zeros(n + 1, bool), np.zeros((0, 2), np.int64)
        if not len(phrases) or not limits[-1]:
            return none
        known = pc.index_in(vocabulary, value_set=ragged(ends, row["words"].as_buffer()))
        symbol = pc.fill_null(known, -FIRST).to_numpy().astype(np.int64) + FIRST  # 0: not in this shard
        asked = np.where(phrases >= 0, symbol[phrases], 0)
        usable = np.flatnonzero(((asked > 0) | (phrases < 0)).all(axis=1))
        tree = np.frombuffer(row["tree"].as_py(), np.uint64).reshape(-1, n // 64 + 1)
        fm = FmIndex(n, first, tree, sampled.reshape(1, -1), samples)
        which, low, high = fm.search(asked[usable], lengths[usable])
        of, place = ranges(low, high)
        phrase, at = usable[which][of], fm.locate(place)
        cover = np.zeros(n + 1, np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + lengths[phrase], -1)
        doc = np.searchsorted(starts, at, "right") - 1
        pairs = np.unique(doc * len(phrases) + phrase)
        of, place = ranges(item_limits[pairs % len(phrases)], item_limits[pairs % len(phrases) + 1])
        found = np.stack([(pairs // len(phrases))[of], item_of[place]], axis=1)
        return starts, np.cumsum(cover) > 0, np.unique(found, axis=0) if len(found) else none[2]

    def run(batches):
        vocabulary, phrases, lengths, item_of, item_limits, names = shared.value
        out, names = to_arrow_schema(schema), pa.array(names, pa.string())
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(j)[k] for j, c in enumerate(batch.schema.names)}
                starts, hit, found = hits(row, vocabulary, phrases, lengths, item_of, item_limits)
                docs, offset = len(starts), row["first"].as_py()
                begin = np.flatnonzero(hit & ~np.append(False, hit[:-1]))
                end = np.flatnonzero(hit & ~np.append(hit[1:], False)) + 1
                doc = np.searchsorted(starts, begin, "right") - 1
                shift = offset - starts[doc]
                spans_of = pa.StructArray.from_arrays([pa.array(begin + shift, pa.int64()), pa.array(end + shift, pa.int64())],
                                                      fields=list(out.field("spans").type.value_type))
                lists = [pa.ListArray.from_arrays(pa.array(np.searchsorted(d, np.arange(docs + 1)), pa.int32()), v)
                         for d, v in ((doc, spans_of), (found[:, 0], names.take(pa.array(found[:, 1]))))]
                arrays = [pa.array(np.full(docs, row["owner"].as_py())), pa.array(np.arange(docs)), row["ids"].values,
                          row["marks"].values, row["n_words"].values, pa.array(np.full(docs, row["cut"].as_py())), *lists]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, out)], schema=out)
            give_back()

    return index.mapInArrow(run, schema)


def merged(found: DataFrame) -> DataFrame:
    """One row a document of rows that tell parts of it: spans joined where they meet, items named once."""
    key = ["owner", "slot"]
    spans = found.select(*key, F.explode("spans").alias("s")).select(*key, "s.first", "s.end")
    order = Window.partitionBy(*key).orderBy("first", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", (before.isNull() | (F.col("first") > before)).cast("int"))
    spans = spans.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = spans.groupBy(*key, "run").agg(F.min("first").alias("first"), F.max("end").alias("end"))
    spans = spans.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("first", "end"))).alias("spans"))
    items = found.select(*key, F.explode("items").alias("item")).distinct().groupBy(*key).agg(
        F.sort_array(F.collect_list(F.struct("item"))).getField("item").alias("items"))
    rows = found.select(*key, "id", "mark", "n_words").distinct()
    return rows.join(spans, key, "left").join(items, key, "left").select(
        "id", "mark", "n_words", F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, id_: str = "doc_id", text: str = "text", item: str = "item_id",
                       item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, mark, n_words, spans, items) for every row of ``docs``.

    Words are maximal runs of letters a to z (upper case counts as lower), digits and characters
    beyond ASCII. A phrase is ``window`` consecutive words of an item, or all words of a shorter
    one. ``spans`` are the document's words ``first`` to ``end`` (exclusive, from 0) that occurrences
    cover, joined where they touch; ``items`` the ids of the items with an occurring phrase, as strings in
    order, each once; items with a null id count together as one null. ``mark`` is xxhash64 of the text.
    Null, empty and wordless texts, of documents or items, hit nothing; repeated rows are rows; no
    items, no hits; other columns have no part. A document of any length is searched whole.
    """
    index = index_shards(docs, id_, text, window)
    pieces = materialise(item_pieces(benchmark, item, item_text, window), "pieces")
    size = pieces.agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES) or 1
    found = []
    for k in range(blocks):
        rows = pieces.where(F.pmod(F.xxhash64("piece"), F.lit(blocks)) == k).toArrow()
        found.append(search_shards(index, docs.sparkSession.sparkContext.broadcast(phrases_of(rows, window))))
    columns = ["id", "mark", "n_words", "spans", "items"]
    if blocks == 1:
        all_ = materialise(found[0], "found")
        return all_.where("NOT cut").select(*columns).union(merged(all_.where("cut")))
    for k in range(1, blocks):
        found[0] = found[0].union(found[k])
    return merged(materialise(found[0], "found"))


def without_spans(docs: DataFrame, benchmark: DataFrame, id_: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with the hit words cut out of the texts, from a span's first letter to its last; all rows stay.

    Other columns are handed on, a null text stays null. Options and rules as for ``contaminated_spans``."""
    body = F.col(f"`{text}`").cast("string")
    spans = contaminated_spans(docs, benchmark, id_, text, **options).where(F.size("spans") > 0).dropDuplicates(["id", "mark"])
    spans = materialise(spans.select(F.col("id").alias("__id"), F.col("mark").alias("__mark"), F.col("spans").alias("__spans")), "spans")
    met = docs.join(spans, F.col(f"`{id_}`").eqNullSafe(F.col("__id")) & (F.xxhash64(body) == F.col("__mark")), "left")
    schema = T.StructType([f if f.name != text else T.StructField(text, T.StringType()) for f in docs.schema.fields])
    names = docs.columns
    at = names.index(text)

    def run(batches):
        out = to_arrow_schema(schema)
        for batch in batches:
            columns, spans = list(batch.columns), batch.column(batch.num_columns - 1)
            texts = columns[at].to_pylist()
            for k in np.flatnonzero(spans.is_valid().to_numpy(zero_copy_only=False)).tolist():
                body = texts[k].encode()
                _, _, begin, end = words_of(pa.array([texts[k]], pa.large_string()))
                kept, last = [], 0
                for span in spans[k].as_py():
                    kept.append(body[last:begin[span["first"]]])
                    last = end[span["end"] - 1]
                texts[k] = b"".join([*kept, body[last:]]).decode("utf-8", "replace")
            columns[at] = pa.array(texts, pa.large_string())
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    return met.select(*[F.col(f"`{c}`") if c != text else body.alias(text) for c in names], "__spans").mapInArrow(run, schema)


def op11(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = contaminated_spans(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["first"])
    return found.select(F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))
