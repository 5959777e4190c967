"""Secret scans: fixed patterns, and a character network over every other candidate.

A candidate is a run of at least 16 letters, digits and `+/_.=-` with a letter and a digit.
A small convolutional network in NumPy reads its characters and the surrounding ones. It is
trained on labelled findings: candidates that a fixed pattern marks are secrets, the others
are not, but for those that look like a key, which teach nothing. All distinct findings take
part, halved by a hash: one half trains, in shards of bounded size whose networks are averaged
after some epochs, the other calibrates: the threshold is the highest one that still
finds RECALL of its secrets, whatever others score. Fixed findings always stay.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from likeness.llm.ranks import value_at
from likeness.llm.text import map_text, small_batches
from likeness.session import materialise

KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a maximal run, so the same as runs of 32 or more
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
# Looks like a key: an unbroken piece of 16 with both, or letters and digits changing often.
UNBROKEN = re.compile(r"[A-Za-z0-9]{16,}")
CHANGE = re.compile(r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])")
CHANGES, SPREAD = 4, 16
HAS_DIGIT, HAS_LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")

# The network sees this many characters of the candidate and around it.
BEFORE, INSIDE, AFTER = 24, 40, 8
WINDOW = BEFORE + INSIDE + AFTER
# A longer candidate is read in pieces of INSIDE characters, this far apart.
STRIDE = INSIDE // 2
# Training findings of a shard, on average. Of a rarer class a shard holds CLASS_ROWS, as long as there are as many:
# such a finding trains in several shards.
SHARD_ROWS, CLASS_ROWS = 2048, 512
SIGNS, FILTERS, SPAN = 32, 12, 5
# The networks of several shards are averaged so many times.
EPOCHS, ROUNDS, RATE, SEED = 60, 12, 0.01, 5
RECALL = 0.95


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, leftmost and not overlapping within a kind."""
    spans = []
    if ":" in text or "=" in text:
        low = text.lower()
        if any(h in low for h in HINTS):
            spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CANDIDATE.finditer(text) if HAS_DIGIT.search(m[0]) and HAS_LETTER.search(m[0])]


def pieces(start: int, end: int) -> list[tuple[int, int]]:
    """Overlapping spans of at most INSIDE characters over a whole candidate."""
    if end - start <= INSIDE:
        return [(start, end)]
    return [(a, a + INSIDE) for a in (*range(start, end - INSIDE, STRIDE), end - INSIDE)]


def label(base, candidate: tuple[int, int], piece: tuple[int, int]) -> tuple[bool, bool]:
    """(secret, touched) of a piece: a secret holds a finding's part of the candidate, or 16 signs of it."""
    secret = touched = False
    for _, s, e in base:
        part = min(e, candidate[1]) - max(s, candidate[0])
        held = min(e, piece[1]) - max(s, piece[0])
        secret |= held > 0 and held >= min(part, 16)
        touched |= held > 0
    return secret, touched


def key_like(run: str) -> bool:
    """Whether a candidate without a fixed finding may still be a key, so that it is no sure non-secret."""
    if any(HAS_DIGIT.search(m[0]) and HAS_LETTER.search(m[0]) for m in UNBROKEN.finditer(run)):
        return True
    at = [m.start() for m in CHANGE.finditer(run)]
    return any(b - a < SPREAD for a, b in zip(at, at[CHANGES - 1:]))


def window(text: str, start: int, end: int) -> bytes:
    """The signs of a candidate and its surroundings; the same length for all."""
    before = text[max(0, start - BEFORE):start].rjust(BEFORE, "\0")
    inside = text[start:min(end, start + INSIDE)].ljust(INSIDE, "\0")
    after = text[end:end + AFTER].ljust(AFTER, "\0")
    return (before + inside + after).translate(SIGN).encode("latin-1")


def sign_of(point: int) -> int:
    """0 none, 1 digit, 2 upper, 3 lower a to f, 4 other lower, 5 blank, 6 rest, then each mark."""
    char = chr(point)
    if char == "\0":
        return 0
    if char.isdigit():
        return 1
    if char.isupper():
        return 2
    if char.isalpha():
        return 3 if char in "abcdef" else 4
    if char.isspace():
        return 5
    marks = "=:\"'-_+/.@#$%&*(),;!|<>?"
    return 7 + marks.index(char) if char in marks else 6


class _Signs(dict):
    def __missing__(self, point):
        self[point] = sign_of(point)
        return self[point]


SIGN = _Signs()


class Network:
    """One-hot signs, a convolution, rectifier, maximum over three zones, logistic output."""

    ZONES = ((0, BEFORE), (BEFORE, BEFORE + INSIDE), (BEFORE + INSIDE - SPAN + 1, WINDOW - SPAN + 1))
    NAMES = ("kernel", "bias", "out", "base")

    def __init__(self):
        draw = np.random.default_rng(SEED)
        self.kernel = draw.normal(0, 0.3, (SPAN, SIGNS, FILTERS))
        self.bias = np.zeros(FILTERS)
        self.out = draw.normal(0, 0.3, 2 * len(self.ZONES) * FILTERS)
        self.base = np.zeros(1)
        self.first = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        self.second = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        self.step = 0

    def arrays(self) -> list[np.ndarray]:
        return [d[n] for d in (vars(self), self.first, self.second) for n in self.NAMES]

    def state(self) -> np.ndarray:
        """Weights, moments and step in one row."""
        return np.concatenate([*[a.ravel() for a in self.arrays()], [self.step]])

    def resume(self, state: np.ndarray):
        at = 0
        for a in self.arrays():
            a[...] = state[at:at + a.size].reshape(a.shape)
            at += a.size
        self.step = round(state[at])
        return self

    def hidden(self, x: np.ndarray):
        length = WINDOW - SPAN + 1
        h = np.broadcast_to(self.bias, (len(x), length, FILTERS)).copy()
        for k in range(SPAN):
            h += self.kernel[k][x[:, k:k + length]]
        h = np.maximum(h, 0)
        tops = [h[:, a:b].argmax(axis=1) + a for a, b in self.ZONES]
        peaks = [np.take_along_axis(h, t[:, None], 1)[:, 0] for t in tops]
        means = [h[:, a:b].mean(axis=1) for a, b in self.ZONES]
        return h, tops, np.concatenate(peaks + means, axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for start in range(0, len(x), 1024):
            z = self.hidden(x[start:start + 1024])[2] @ self.out + self.base
            out[start:start + 1024] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS):
        """Adam on the logistic loss, both classes weighing the same; goes on from the present state."""
        weight = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1)) * len(y)
        draw, length = np.random.default_rng([SEED, self.step]), WINDOW - SPAN + 1
        n_peaks = len(self.ZONES) * FILTERS
        for _ in range(epochs):
            order = draw.permutation(len(x))
            for start in range(0, len(x), 128):
                at = order[start:start + 128]
                xs, h_all = x[at], None
                h_all, tops, features = self.hidden(xs)
                p = 1 / (1 + np.exp(-np.clip(features @ self.out + self.base, -30, 30)))
                d = (p - y[at]) * weight[at] / len(at)
                back = d[:, None] * self.out
                dh = np.zeros_like(h_all)
                for z, (a, b) in enumerate(self.ZONES):
                    peak = back[:, z * FILTERS:(z + 1) * FILTERS]
                    np.put_along_axis(dh, tops[z][:, None],
                                      np.take_along_axis(dh, tops[z][:, None], 1) + peak[:, None], 1)
                    dh[:, a:b] += back[:, None, n_peaks + z * FILTERS:n_peaks + (z + 1) * FILTERS] / (b - a)
                dh *= h_all > 0
                grad = {"out": features.T @ d, "base": np.array([d.sum()]), "bias": dh.sum(axis=(0, 1)),
                        "kernel": np.zeros_like(self.kernel)}
                for k in range(SPAN):
                    np.add.at(grad["kernel"][k], xs[:, k:k + length].ravel(), dh.reshape(-1, FILTERS))
                self.step += 1
                for n in self.NAMES:
                    first, second, value = self.first[n], self.second[n], getattr(self, n)
                    first[...] = 0.9 * first + 0.1 * grad[n]
                    second[...] = 0.999 * second + 0.001 * grad[n] ** 2
                    value -= RATE * (first / (1 - 0.9 ** self.step)) / (np.sqrt(second / (1 - 0.999 ** self.step)) + 1e-8)
        return self


def signs_of(windows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(windows), np.uint8).reshape(-1, WINDOW)


def labelled(docs: DataFrame, text: str = "text") -> DataFrame:
    """(window, secret, unsure): every piece of the candidates, a secret where a fixed finding lies in it,
    unsure where it holds but an end of one, or none and looks like a key."""
    def make():
        def kernel(texts):
            found, marks, doubts = [], [], []
            for t in texts.to_pylist():
                spans = candidates(t)
                base = base_spans(t) if spans else []
                parts = [(c, p) for c in spans for p in pieces(*c)]
                found.append([window(t, *p) for _, p in parts])
                near = {c: [f for f in base if f[1] < c[1] and c[0] < f[2]] for c in spans}
                labels = [label(near[c], c, p) for c, p in parts]
                marks.append([secret for secret, _ in labels])
                doubts.append([not secret and (touched or key_like(t[a:b])) for (_, (a, b)), (secret, touched) in zip(parts, labels)])
            return [pa.array(found, pa.list_(pa.binary())), pa.array(marks, pa.list_(pa.bool_())),
                    pa.array(doubts, pa.list_(pa.bool_()))]
        return kernel

    return map_text(docs, make, "w array<binary>, s array<boolean>, u array<boolean>", text, []).select(
        F.explode(F.arrays_zip("w", "s", "u")).alias("c")).select(
        F.col("c.w").alias("window"), F.col("c.s").alias("secret"), F.col("c.u").alias("unsure"))


def in_shards(rows: DataFrame, counts: dict[bool, int]) -> tuple[DataFrame, int]:
    """(shard, windows, secrets) of the training findings, one row a shard, and the number of shards."""
    n = math.ceil(sum(counts.values()) / SHARD_ROWS)
    times = {secret: min(n, math.ceil(CLASS_ROWS * n / counts[secret])) for secret in counts}
    turns = F.explode(F.sequence(F.lit(0), F.when(F.col("secret"), times[True]).otherwise(times[False]) - 1))
    dealt = rows.select("h", "window", "secret", turns.alias("turn")).withColumn(
        "shard", F.pmod(F.shiftrightunsigned("h", 1) + F.col("turn"), F.lit(n)).cast("int"))
    shards = dealt.repartitionByRange(n, "shard").groupBy("shard").agg(
        F.sort_array(F.collect_list(F.struct("h", "window", "secret"))).alias("all"))
    return materialise(shards.select("shard", F.col("all.window").alias("windows"), F.col("all.secret").alias("secrets")), "shards"), n


def fitted(shards: DataFrame, n: int) -> Network:
    """The network trained on all shards: each goes on from the common state, which becomes their mean.

    The driver gets one state a round. The mean is added up in the order of the shards, so reruns agree.
    """
    network, rounds = Network(), 1 if n == 1 else ROUNDS
    for _ in range(rounds):
        state = network.state()

        def run(batches, state=state):
            for batch in batches:
                for shard, windows, secret in zip(*[c.to_pylist() for c in batch.columns]):
                    mine = Network().resume(state).fit(signs_of(windows), np.array(secret, float), EPOCHS // rounds).state()
                    yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([mine.tolist()])],
                                                     names=["shard", "state"])

        states = shards.mapInArrow(run, "shard int, state array<double>").select("shard", F.posexplode("state").alias("at", "x"))
        means = states.groupBy("at").agg(F.sort_array(F.collect_list(F.struct("shard", "x"))).alias("all")).select(
            "at", (F.aggregate("all", F.lit(0.0), lambda a, r: a + r["x"]) / n).alias("x")).collect()
        network.resume(np.array([r["x"] for r in sorted(means, key=lambda r: r["at"])]))
    return network


def calibrated(rows: DataFrame, network: Network) -> DataFrame:
    """(secret, score) of findings."""
    def run(batches):
        for batch in batches:
            if len(batch):
                score = network.score(signs_of(batch.column(0).to_pylist()))
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(score)], names=["secret", "score"])

    return materialise(rows.select("window", "secret").mapInArrow(run, "secret boolean, score double"), "scores")


def train(findings: DataFrame):
    """(network, threshold), or None when a class has fewer than eight distinct findings.

    All distinct findings train or calibrate, by a hash; a class that the hash leaves out of a half does both.
    ``network.recall`` and ``network.precision`` are those of the calibration half at the threshold,
    precision with both classes weighing the same: what RECALL costs.
    """
    small_batches(findings.sparkSession)
    distinct = findings.groupBy("window").agg(F.max("secret").alias("secret"), F.max("unsure").alias("unsure"))
    distinct = materialise(distinct.where("secret OR NOT unsure").select(
        F.xxhash64("window").alias("h"), "window", "secret"), "distinct")
    half = F.pmod("h", F.lit(2)).cast("int")
    counts = {(r["secret"], r["half"]): r["count"] for r in distinct.groupBy("secret", half.alias("half")).count().collect()}
    each = {secret: [counts.get((secret, k), 0) for k in (0, 1)] for secret in (True, False)}
    if min(sum(n) for n in each.values()) < 8:
        return None
    whole = F.lit(False)
    for secret, n in each.items():
        if 0 in n:
            whole, each[secret] = whole | (F.col("secret") == F.lit(secret)), [sum(n)] * 2
    shards, n = in_shards(distinct.where((half == 0) | whole), {secret: m[0] for secret, m in each.items()})
    network = fitted(shards, n)
    scores = calibrated(distinct.where((half == 1) | whole), network)
    edge = value_at(scores.where("secret"), "score", int((1 - RECALL) * each[True][1]) + 1)
    over = {r["secret"]: r["n"] for r in scores.groupBy("secret").agg(F.count_if(F.col("score") >= F.lit(edge)).alias("n")).collect()}
    network.recall, wrong = over[True] / each[True][1], over[False] / each[False][1]
    network.precision = network.recall / (network.recall + wrong)
    return network, edge


def scan(docs: DataFrame, text: str = "text", keep=None) -> DataFrame:
    """``docs`` with ``secrets``: array of (kind, start, end) over the whole text, by start, then
    kind as listed in KINDS; positions are code points, ends exclusive.

    Kind "model" is a candidate that the network finds and no fixed finding overlaps. Null
    and empty texts have an empty array. Rows map one to one; a text of any length is
    read whole. Without enough labelled findings of both classes only fixed patterns are used.
    """
    trained = train(materialise(labelled(docs, text), "findings"))
    shipped = docs.sparkSession.sparkContext.broadcast(trained)

    def make():
        def kernel(texts):
            out, asked, where = [], [], []
            for row, t in enumerate(texts.to_pylist()):
                base = base_spans(t)
                out.append(base)
                if shipped.value is not None:
                    for a, b in candidates(t):
                        if not any(s < b and a < e for _, s, e in base):
                            for piece in pieces(a, b):
                                asked.append(window(t, *piece))
                                where.append((row, a, b))
            if asked:
                network, edge = shipped.value
                hits = [w for w, p in zip(where, network.score(signs_of(asked))) if p >= edge]
                for row, a, b in dict.fromkeys(hits):
                    out[row].append(("model", a, b))
            spans = [sorted(s, key=lambda x: (x[1], KINDS.index(x[0]), x[2])) for s in out]
            rows = np.concatenate(([0], np.cumsum([len(s) for s in spans])))
            flat = [s for row in spans for s in row]
            items = pa.StructArray.from_arrays(
                [pa.array([f[0] for f in flat], pa.string()), pa.array([f[1] for f in flat], pa.int64()),
                 pa.array([f[2] for f in flat], pa.int64())], names=["kind", "start", "end"])
            return [pa.ListArray.from_arrays(pa.array(rows, pa.int32()), items)]
        return kernel

    return map_text(docs, make, "secrets array<struct<kind: string, start: bigint, end: bigint>>", text, keep)


def redact(docs: DataFrame, mark: str = "[secret]", text: str = "text") -> DataFrame:
    """``docs`` with every secret of its text replaced by ``mark``; overlapping spans are one."""
    found = scan(docs.withColumnRenamed("secrets", "__secrets"), text)
    columns = [F.col("__secrets").alias("secrets") if c == "secrets" else F.col(f"`{c}`") for c in docs.columns]

    def step(state, span):
        begin = F.greatest(span["start"], state["at"])
        return F.struct(
            F.concat(state["out"], F.substring(text, state["at"].cast("int") + 1, F.greatest(
                span["start"] - state["at"], F.lit(0).cast("bigint")).cast("int")),
                F.when(span["end"] > begin, F.lit(mark)).otherwise(F.lit(""))).alias("out"),
            F.greatest(span["end"], state["at"]).alias("at"))

    # spans that overlap one before them only lengthen it
    state = F.aggregate("secrets", F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at")), step)
    clean = F.concat(state["out"], F.substring(text, state["at"].cast("int") + 1, 2147483647))
    return found.withColumn(text, F.when(F.size("secrets") > 0, clean).otherwise(F.col(text))).select(*columns)


def joined(spans):
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def of_kind(kind: str):
    return lambda s: s["kind"] == kind


def op6(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(docs, keep=["doc_id"])
    of = {k: F.filter("secrets", of_kind(k)) for k in KINDS}
    base = F.filter("secrets", lambda s: s["kind"] != "model")
    return found.select("doc_id", *[F.size(of[k]).cast("bigint").alias(f"n_{k}") for k in KINDS],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))
