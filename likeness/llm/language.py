"""Language identification by character models with interpolated Kneser-Ney smoothing.

One model of four-character sequences per language, counted over all training texts.
A run of characters that are neither letters nor marks is one sign, every other character is
its lower-case code point: no two scripts share a sign. Sequences travel as two exact words
(two signs each); each order of a model is a sorted array of 64-bit hashes with its values.
Models whose sequences fit a broadcast are looked up by the tasks that read the texts, larger
ones are tables that the texts' sequences are joined with: both give the same sums, and the
number of sequences or languages has no limit. The language with the lowest cross-entropy per
sign wins; a text is rejected when it has no letter, or when its cross-entropy, plain and
standardised by its length, is worse than what the training texts of that language show. Every
text, of the training rows or not, is scored by the models of all training texts, so equal texts
get equal results. What is worse is told by texts the models don't know: training texts are
dealt to two halves by a hash of the text, and for this purpose alone scored by the models of
the half they are not in.
"""

from __future__ import annotations

import functools
import unicodedata
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from likeness.llm.text import code_points, give_back, map_text, only, only_rows, slices, small_batches, whole
from likeness.session import materialise

ORDER, BITS = 4, 21
SIGN = (1 << BITS) - 1
# The least number of signs that a model spreads the chance of unknown ones over.
SIGNS = 64
FLUSH_ROWS = 1 << 19
# Bytes of text worked on at a time: their sequences and what sorts them take some 200 times as much.
SLICE = 1 << 18
# Signs of a text worked on at a time, and bytes of looked-up sequences that a worker keeps.
PIECE, KEPT_BYTES = 1 << 20, 32 << 20
# Sequences that are gathered and sent out (40 bytes each); more are joined.
BROADCAST_ROWS = 1 << 20


@functools.lru_cache(maxsize=1)
def sign_table() -> np.ndarray:
    """The sign of each code point: 0 for all but letters and marks."""
    table = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha() or unicodedata.category(char)[0] == "M":
            table[point] = ord(char.lower()[0])
    return table


def signs(points: np.ndarray, limits: np.ndarray):
    """(signs, row limits): one 0 for each run of non-letters, a 0 before the text."""
    sign = sign_table()[points]
    letter = sign != 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    first = limits[:-1][np.diff(limits) > 0]
    keep[first] = letter[first]  # the 0 before the text stands for its leading non-letters
    kept = np.concatenate(([0], np.cumsum(keep)))[limits]
    return sign[keep], kept


def sequences(sign: np.ndarray, limits: np.ndarray):
    """Pieces (row, high, low): of each position its text, and as two words of two signs each the
    sign and the three before it in the same text, 0 where there is none."""
    for start in range(0, len(sign), PIECE):
        at = np.arange(start, min(start + PIECE, len(sign)))
        row = np.searchsorted(limits, at, "right") - 1
        place = at - limits[row]
        near = [np.where(place >= back, sign[np.maximum(at - back, 0)], 0).astype(np.int64) for back in range(ORDER)]
        yield row, near[3] << BITS | near[2], near[1] << BITS | near[0]


def hashed(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """A 64-bit hash of a sequence; of up to three signs it is their exact code."""
    mixed = (high >> BITS).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ ((high & SIGN) << 2 * BITS | low).astype(np.uint64)


def each_once(key: np.ndarray, n: np.ndarray, *others: np.ndarray):
    """(keys in order, their summed n, the other columns of each)."""
    unique, first, at = np.unique(key, return_index=True, return_inverse=True)
    return unique, np.bincount(at, n, len(unique)).astype(np.int64), *[x[first] for x in others]


def sequence_counts(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, high, low, n) over all texts, added up per task before the shuffle."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))

    def run(batches):
        names, parts, size = {}, [], 0
        only_rows()

        def merged():
            return each_once(*[np.concatenate(column) for column in zip(*parts)])

        def rows():
            _, n, which, high, low = merged()
            langs = pa.array(list(names), pa.string()).take(pa.array(which))
            yield pa.RecordBatch.from_arrays([langs, pa.array(high), pa.array(low), pa.array(n)],
                                             names=["lang", "high", "low", "n"])

        for batch in batches:
            texts, langs = whole(batch.column(1)), batch.column(0).to_pylist()
            for start, stop in slices(texts, SLICE):
                sign, limits = signs(*code_points(texts.slice(start, stop - start)))
                own = np.array([names.setdefault(x, len(names)) for x in langs[start:stop]], np.int64)
                for row, high, low in sequences(sign, limits):
                    which = own[row]
                    key = hashed(high, low) ^ (which.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
                    parts.append(each_once(key, np.ones(len(key), np.int64), which, high, low))
                    size += len(parts[-1][0])
                    if size > FLUSH_ROWS:
                        parts = [merged()]
                        size = len(parts[0][0])
                        if size > FLUSH_ROWS // 2:
                            yield from rows()
                            parts, size = [], 0
            give_back()
        if parts:
            yield from rows()
            parts = []
            give_back()

    return source.mapInArrow(run, "lang string, high bigint, low bigint, n bigint").groupBy("lang", "high", "low").agg(
        F.sum("n").alias("n"))


def discount_of(ones, twos):
    return ones / (ones + 2 * twos) if ones and twos else 0.5


class Model:
    """The smoothed model of one language: for each order sorted hashes and their values."""

    def __init__(self, high: np.ndarray, low: np.ndarray, counts: np.ndarray, alphabet: int = SIGNS):
        self.orders = []
        for k in range(ORDER, 1, -1):
            discount = discount_of((counts == 1).sum(), (counts == 2).sum())
            contexts, at = np.unique(high << BITS | low >> BITS, return_inverse=True)
            total, kinds = np.bincount(at, counts), np.bincount(at)
            key = hashed(high, low)
            order = np.argsort(key)
            self.orders.append((key[order], (np.maximum(counts - discount, 0) / total[at])[order],
                                contexts, discount * kinds / total))
            # how many signs precede each shorter sequence
            high, low = (high & SIGN, low) if k == ORDER else (high * 0, low) if k == 3 else (high, low & SIGN)
            _, counts, high, low = each_once(hashed(high, low), np.ones(len(low), np.int64), high, low)
        discount = 0.5
        self.rest = discount * len(counts) / counts.sum() / alphabet
        self.signs, self.base = low, np.maximum(counts - discount, 0) / counts.sum()

    @staticmethod
    def found(keys: np.ndarray, values: np.ndarray, asked: np.ndarray, otherwise: float) -> np.ndarray:
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        return np.where(keys[at] == asked, values[at], otherwise)

    def log(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Logarithm of each sign's probability after the three before it."""
        p = self.rest + self.found(self.signs, self.base, low & SIGN, 0.0)
        for part, (hashes, value, contexts, rest) in zip((0, SIGN, -1), reversed(self.orders)):
            upper = high & part
            p = p * self.found(contexts, rest, upper << BITS | low >> BITS, 1.0)
            p = p + self.found(hashes, value, hashed(upper, low), 0.0)
        return np.log(p)


class Scorer:
    """Sums of -log probabilities under all models; a worker keeps the sequences it has met, up to a size."""

    def __init__(self, models: list[Model]):
        self.models = models
        self.forget()

    def forget(self):
        self.keys, self.logs = np.zeros(0, np.uint64), np.zeros((0, len(self.models)))

    def looked_up(self, keys, high, low):
        """The logarithms of sequences, given once each in the order of their keys."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        logs = np.empty((len(keys), len(self.models)))
        logs[known] = self.logs[at[known]]
        if not known.all():
            new = ~known
            logs[new] = np.stack([m.log(high[new], low[new]) for m in self.models], 1)
            if (len(self.keys) + new.sum()) * 8 * (len(self.models) + 1) > KEPT_BYTES:
                self.forget()
            else:
                every = np.concatenate([self.keys, keys[new]])
                order = np.argsort(every)
                self.keys, self.logs = every[order], np.concatenate([self.logs, logs[new]])[order]
        return logs

    def __call__(self, points, limits):
        """(signs a text, letters a text, -log probability a text and model)."""
        sign, limits = signs(points, limits)
        n = np.diff(limits)
        letters, sums = np.zeros(len(n), np.int64), np.zeros((len(n), len(self.models)))
        for row, high, low in sequences(sign, limits):
            unique, first, at = np.unique(hashed(high, low), return_index=True, return_inverse=True)
            logs = self.looked_up(unique, high[first], low[first])
            starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            letters[row[starts]] += np.add.reduceat(((low & SIGN) != 0).astype(np.int64), starts)
            for k in range(len(self.models)):
                sums[row[starts], k] += np.add.reduceat(logs[at, k], starts)
        return n, letters, -sums


def half_of(text: str = "text"):
    """0 or 1 by the text, so that copies are in one half."""
    return F.pmod(F.xxhash64(F.col(text).cast("string")), F.lit(2)).cast("int")


class Trained:
    """What ``train`` found: ``names`` in order, ``counts`` (lang, high, low, n0, n1) as a written table,
    its number of rows and the number of signs that unknown ones are taken from."""

    def __init__(self, names: list[str], counts: DataFrame, rows: int, alphabet: int):
        self.names, self.counts, self.rows, self.alphabet = names, counts, rows, alphabet


def train(docs: DataFrame, lang: str = "lang", text: str = "text") -> Trained:
    """Counts of every sequence, in either half, from all rows whose language is not null."""
    known = docs.where(F.col(lang).isNotNull()).select(
        F.concat(half_of(text).cast("string"), F.col(lang).cast("string")).alias("lang"), F.col(text).alias("text"))
    half = F.col("lang").substr(1, 1)
    counts = sequence_counts(known).groupBy(F.expr("substring(lang, 2)").alias("lang"), "high", "low").agg(
        *[F.sum(F.when(half == str(k), F.col("n")).otherwise(0)).alias(f"n{k}") for k in (0, 1)])
    counts = materialise(counts, "sequences")
    rows = counts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # one row a language
    alphabet = counts.select(F.col("low").bitwiseAND(SIGN)).distinct().count() + 1
    return Trained(sorted(r["lang"] for r in rows), counts, sum(r["n"] for r in rows), max(alphabet, SIGNS))


def arrays_of(trained: Trained) -> list[tuple]:
    """(high, low, counts in either half) of each language."""
    table = trained.counts.toPandas()
    by = dict(tuple(table.groupby("lang")))
    return [tuple(by[x][c].to_numpy() for c in ("high", "low", "n0", "n1")) for x in trained.names]


def model_sets(arrays, alphabet: int) -> list[Model]:
    """The models of all training texts, of the second half, then of the first, by language in each;
    a language without a text in a half has the model of all there."""
    sets = [[], [], []]
    for high, low, first, second in arrays:
        everything = Model(high, low, first + second, alphabet)
        sets[0].append(everything)
        for k, n in ((1, second), (2, first)):
            some = n > 0
            sets[k].append(Model(high[some], low[some], n[some], alphabet) if some.any() else everything)
    return [m for s in sets for m in s]


def bits_by_lookup(docs: DataFrame, trained: Trained, text: str, keep) -> DataFrame:
    """The columns of ``keep`` with ``__n`` signs, ``__letters`` and ``__bits`` (one sum a model)."""
    shipped = docs.sparkSession.sparkContext.broadcast((arrays_of(trained), trained.alphabet))
    mark = uuid.uuid4().hex

    def make():
        scorer = only(("languages", mark), lambda: Scorer(model_sets(*shipped.value)))

        def kernel(texts):
            n, letters, bits = scorer(*code_points(texts))
            ends = pa.array(np.arange(len(n) + 1) * bits.shape[1], pa.int32())
            return [n, letters, pa.ListArray.from_arrays(ends, pa.array(bits.ravel()))]
        return kernel

    return map_text(docs, make, "__n bigint, __letters bigint, __bits array<double>", text, keep, SLICE)


def models_as_tables(trained: Trained):
    """Of the orders from 2 up: (order, values (high, low, v), contexts (high, low, r)), and the single signs
    (low, v) with what is left for unknown ones; v and r map the number of a model to its value.
    Models are numbered as in ``model_sets``. A key's map has one entry a model at most."""
    spark, size = trained.counts.sparkSession, len(trained.names)
    names = spark.createDataFrame(list(enumerate(trained.names)), "at int, lang string")
    halves = trained.counts.groupBy("lang").agg(F.sum("n0").alias("all0"), F.sum("n1").alias("all1"))
    n, n0, n1 = F.col("n0") + F.col("n1"), F.col("n0"), F.col("n1")
    sets = F.array(n, F.when(F.col("all1") > 0, n1).otherwise(n), F.when(F.col("all0") > 0, n0).otherwise(n))
    level = trained.counts.join(F.broadcast(names), "lang").join(F.broadcast(halves), "lang").select(
        "at", "high", "low", F.posexplode(sets).alias("set", "n")).where("n > 0").select(
        (F.col("set") * size + F.col("at")).alias("model"), "high", "low", "n")
    orders = []
    for k in range(ORDER, 0, -1):
        level = materialise(level, "order")
        if k == 1:
            break
        found = level.groupBy("model").agg(F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos"))
        discounts = spark.createDataFrame([(r["model"], float(discount_of(r["ones"], r["twos"]))) for r in found.collect()],
                                          "model int, discount double")  # one row a model
        before = F.shiftright("low", BITS)
        contexts = level.groupBy("model", "high", before.alias("before")).agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")).join(F.broadcast(discounts), "model")
        values = level.withColumn("before", before).join(contexts, ["model", "high", "before"]).select(
            "high", "low", "model", (F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total")).alias("x"))
        rests = contexts.select("high", F.col("before").alias("low"), "model",
                                (F.col("discount") * F.col("kinds") / F.col("total")).alias("x"))
        orders.append((k, *[materialise(t.groupBy("high", "low").agg(F.map_from_entries(
            F.collect_list(F.struct("model", "x"))).alias(name)), "models") for t, name in ((values, "v"), (rests, "r"))]))
        shorter = {4: (F.col("high").bitwiseAND(SIGN), F.col("low")), 3: (F.lit(0).cast("long"), F.col("low")),
                   2: (F.lit(0).cast("long"), F.col("low").bitwiseAND(SIGN))}[k]
        level = level.groupBy("model", shorter[0].alias("high"), shorter[1].alias("low")).agg(F.count(F.lit(1)).alias("n"))
    totals = level.groupBy("model").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    rest = {r["model"]: 0.5 * r["kinds"] / r["total"] / trained.alphabet for r in totals.collect()}  # one row a model
    single = level.join(F.broadcast(totals), "model").groupBy("low").agg(F.map_from_entries(F.collect_list(
        F.struct("model", ((F.col("n") - 0.5) / F.col("total")).alias("x")))).alias("v"))
    return orders[::-1], single, [rest[m] for m in range(3 * size)]


def bits_by_join(docs: DataFrame, trained: Trained, text: str, keep) -> DataFrame:
    """As ``bits_by_lookup``, for models of any size: the sequences of every different text, with their
    numbers, meet the logarithms of the different sequences by a join, and are added up by text."""
    named = docs.withColumn("__t1", F.xxhash64(F.col(text).cast("string"))).withColumn(
        "__t2", F.xxhash64(F.lit(7), F.col(text).cast("string")))
    distinct = named.select("__t1", "__t2", F.col(text).cast("string").alias("text")).dropDuplicates(["__t1", "__t2"])

    def run(batches):
        only_rows()
        for batch in batches:
            texts = whole(batch.column(2))
            for start, stop in slices(texts, SLICE):
                sign, limits = signs(*code_points(texts.slice(start, stop - start)))
                for row, high, low in sequences(sign, limits):
                    key = hashed(high, low) ^ (row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
                    _, n, row, high, low = each_once(key, np.ones(len(key), np.int64), row, high, low)
                    where = pa.array(row + start)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(where), batch.column(1).take(where), pa.array(high), pa.array(low), pa.array(n)],
                        names=["__t1", "__t2", "high", "low", "n"])
            give_back()

    met = materialise(distinct.mapInArrow(run, "__t1 bigint, __t2 bigint, high bigint, low bigint, n bigint"), "met")
    orders, single, rest = models_as_tables(trained)
    asked = met.select("high", "low").distinct()
    high, low = F.col("high"), F.col("low")

    def value(name, m, otherwise):
        return F.coalesce(F.element_at(F.col(name), m), F.lit(otherwise))

    asked = asked.withColumn("low1", low.bitwiseAND(SIGN)).join(
        single.select(F.col("low").alias("low1"), "v"), "low1", "left").select(
        "high", "low", F.transform(F.array(*[F.lit(x) for x in rest]), lambda x, m: x + value("v", m, 0.0)).alias("p"))
    for k, values, rests in orders:
        upper = {2: F.lit(0).cast("long"), 3: high.bitwiseAND(SIGN), 4: high}[k]
        asked = asked.withColumn("upper", upper).withColumn("before", F.shiftright(low, BITS))
        asked = asked.join(values.select(F.col("high").alias("upper"), "low", "v"), ["upper", "low"], "left").join(
            rests.select(F.col("high").alias("upper"), F.col("low").alias("before"), "r"), ["upper", "before"], "left").select(
            "high", "low", F.transform("p", lambda x, m: x * value("r", m, 1.0) + value("v", m, 0.0)).alias("p"))
    logs = materialise(asked.select("high", "low", F.transform("p", lambda x: -F.log(x)).alias("p")), "logarithms")
    sums = met.join(logs, ["high", "low"]).groupBy("__t1", "__t2").agg(
        F.sum("n").alias("__n"), F.sum(F.when(low.bitwiseAND(SIGN) != 0, F.col("n")).otherwise(0)).alias("__letters"),
        F.array(*[F.sum(F.col("n") * F.get("p", F.lit(m))) for m in range(len(rest))]).alias("__bits"))
    nothing = F.array_repeat(F.lit(0.0), len(rest))
    return named.join(sums, ["__t1", "__t2"], "left").select(
        *[F.col(f"`{c}`") for c in keep], F.coalesce("__n", F.lit(0)).alias("__n"),
        F.coalesce("__letters", F.lit(0)).alias("__letters"), F.coalesce("__bits", nothing).alias("__bits"))


def scored(docs: DataFrame, trained: Trained, text: str = "text", keep=None) -> DataFrame:
    """``docs`` with ``lang_pred``, ``n_signs``, ``entropy`` (nats a sign) and ``score``.

    ``score`` is the winner's share when each language weighs exp(-entropy * min(n, 64)), from
    0 to 1; ties go to the smaller name. Null, empty and letterless texts: und, 0 signs, score 0.
    ``__own_lang`` and ``__own_entropy`` are what the models of the half say that a row's text is not in.
    """
    made = ("lang_pred", "n_signs", "entropy", "score")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in made]
    names, none = F.array(*[F.lit(x) for x in trained.names]), F.lit(0.0)
    if not trained.names:
        und = F.lit("und")
        return docs.select(*[F.col(f"`{c}`") for c in kept], und.alias("lang_pred"), F.lit(0).cast("long").alias("n_signs"),
                           none.alias("entropy"), none.alias("score"), und.alias("__own_lang"), none.alias("__own_entropy"))
    route = bits_by_lookup if trained.rows <= BROADCAST_ROWS else bits_by_join
    rows = route(docs.withColumn("__half", half_of(text)), trained, text, [*kept, "__half"])
    size, known = len(trained.names), F.col("__letters") > 0

    def means(first):
        return F.transform(F.slice("__bits", first, size), lambda x: x / F.greatest(F.col("__n"), F.lit(1)))

    rows = rows.withColumn("__all", means(F.lit(1))).withColumn("__own", means((F.col("__half") + 1) * size + 1))
    low, own = F.array_min("__all"), F.array_min("__own")
    weights = F.transform("__all", lambda x: F.exp((low - x) * F.least(F.col("__n"), F.lit(64))))

    def winner(means, low):
        return F.when(known, F.element_at(names, F.array_position(means, low).cast("int"))).otherwise("und")

    return rows.select(
        *[F.col(f"`{c}`") for c in kept], winner("__all", low).alias("lang_pred"),
        F.when(known, F.col("__n")).otherwise(0).alias("n_signs"), F.when(known, low).otherwise(none).alias("entropy"),
        F.when(known, 1 / F.aggregate(weights, none, lambda a, x: a + x)).otherwise(none).alias("score"),
        winner("__own", own).alias("__own_lang"), F.when(known, own).otherwise(none).alias("__own_entropy"))


def calibrated(marks: DataFrame, slack: float = 5.0, share: float = 0.95):
    """``marks`` (lang_pred, n_signs, entropy, __own_lang, __own_entropy, __training, __lang) with ``rejected``.

    Per language: median entropy and, over the training rows it won rightly, the quantiles
    ``share`` of the entropy and of its deviation scaled by the root of the length, all by the models
    of the half that a row is not in. A row, of the training too, is rejected when by these models it
    lies above ``slack`` times both: what a model has learnt by heart is no less odd. A few noisy
    training rows do not move the quantiles. On the given tables the factor rejects less than one
    row in a hundred. Rows without a letter are rejected; a language won by no training row
    rejects none of its rows.
    """
    mine = marks.where("__training AND __lang = __own_lang AND n_signs > 0").select(
        F.col("__own_lang").alias("lang_pred"), F.col("__own_entropy").alias("entropy"), "n_signs")

    def quantile(x, q):
        return F.percentile_approx(x, F.lit(q), F.lit(10_000))

    middle = mine.groupBy("lang_pred").agg(quantile(F.col("entropy"), 0.5).alias("__mean"),
                                           quantile(F.col("entropy"), share).alias("__high"))
    z = (F.col("entropy") - F.col("__mean")) * F.sqrt("n_signs")
    worst = mine.join(F.broadcast(middle), "lang_pred").groupBy(F.col("lang_pred").alias("__own_lang")).agg(
        F.max("__mean").alias("__mean"), F.max(F.col("__mean") + F.lit(slack) * (F.col("__high") - F.col("__mean"))).alias("__top"),
        (F.lit(slack) * F.greatest(quantile(z, share), F.lit(1.0))).alias("__most"))
    own = (F.col("__own_entropy") - F.col("__mean")) * F.sqrt("n_signs")
    return marks.join(F.broadcast(worst), "__own_lang", "left").withColumn(
        "rejected", (F.col("lang_pred") == "und") | F.coalesce(
            (own > F.col("__most")) & (F.col("__own_entropy") > F.col("__top")), F.lit(False)))


def identify(docs: DataFrame, training, lang: str = "lang", text: str = "text", keep=None) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``.

    ``training`` is the condition (a column) that marks the rows to learn from; of these, rows
    with a null language teach nothing. ``lang`` and ids are never inputs of a prediction.
    Equal texts have equal results whatever their other columns hold. With no training row everything is und and rejected. Repeated rows count as often as
    they occur.
    """
    keep = [c for c in (docs.columns if keep is None else keep)
            if c not in ("lang_pred", "score", "rejected", "n_signs", "entropy")]
    trained = train(docs.where(training), lang, text)
    inner = docs.withColumn("__training", F.coalesce(training, F.lit(False))).withColumn("__lang", F.col(lang))
    marks = materialise(scored(inner, trained, text, keep=[*keep, "__training", "__lang"]), "languages")
    return calibrated(marks).select(*keep, "lang_pred", "score", "rejected")


def held_out(id_: str = "doc_id", folds: int = 3, fold: int = 1):
    return F.coalesce(F.crc32(F.col(id_).cast("string").cast("binary")) % folds == fold, F.lit(False))


def op2(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    return identify(docs, ~held_out(), keep=["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
