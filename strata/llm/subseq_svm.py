"""Toxicity by a subsequence string kernel and a linear support vector machine.

The kernel compares short windows of a text through their gapped subsequences
of three letters: each subsequence that spans up to ``SPAN`` letters weighs
``DECAY`` to the power of its span, so an insult with letters put in or left
out still shares most of them. Nyström landmarks, insults and ordinary words
found in the training texts, give each window a vector K(x, L) K(L, L)^-1/2;
on these a linear SVM is trained (hinge loss, averaged subgradient steps) as a
latent one: a text is as toxic as its worst window, which is sought anew in
every round, in toxic texts as a positive example and in clean ones as a
negative one. Since the kernel is a product of sparse vectors, the trained
machine is one weight per subsequence: scoring a text of any length is a
table look-up per gapped triple and a running sum, all windows included, in
slices of ``SLICE`` letters.

Training texts are a bounded sample: at most ``SAMPLE`` labelled texts of each
class, chosen by the hash of their id, and of each the whole text. They stay in
a stored table: Spark counts their words and finds their worst windows, and
only those windows, of a few letters each, come to the driver, which trains on
them. Scores are a logistic function of the worst window, fitted to the
training texts.

Defined results: a NULL or empty text has the score of a text without any
letter; repeated rows each give a row; of a repeated labelled id one text is
learned from; with no labelled text of both classes, or no word of three
letters in toxic ones, every score is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fold_of, stored

SAMPLE = 2_500  # texts of each class; a window of each comes to the driver
SLICE = 1 << 16  # letters scored at a time
WINDOW, SPAN, DECAY = 9, 5, 0.7
LANDMARKS, ROUNDS, STEPS = 160, 4, 4_000
SYMBOLS = 64
#: Offsets of the second and third letter, with the weight of the span.
TRIPLES = [(a, b, DECAY ** (b + 1)) for a, b in combinations(range(1, SPAN), 2)]
_CODE = np.zeros(256, np.int32)  # white space and signs are 0
_CODE[97:123] = _CODE[65:91] = np.arange(1, 27)
_CODE[48:58] = np.arange(27, 37)
_CODE[0x80:0xC0] = 37 + np.arange(64) % 27  # the second byte of an accented letter


def codes(text: str) -> np.ndarray:
    """A text's letters as numbers; first bytes of longer letters are left out,
    signs within words too, so that they are no gap at all."""
    raw = np.frombuffer(re.sub(r"(?<=\w)[^\w\s]+(?=\w)", "", text).encode(), np.uint8)
    return _CODE[raw[raw < 0xC0]]


def contributions(code: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """For each position the weights of all triples that start there."""
    n = len(code)
    out = np.zeros(n, np.float32)
    for a, b, w in TRIPLES:
        if n > b:
            key = (code[:n - b] * SYMBOLS + code[a:n - b + a]) * SYMBOLS + code[b:]
            some = weight[key]
            out[:n - b] += w * some
    return out


def windows(code: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The value of every window: the sum over the triples that start in it."""
    total = np.concatenate([[0.0], np.cumsum(contributions(code, weight), dtype=np.float64)])
    reach = max(WINDOW - 2, 1)
    if len(total) <= reach:
        return total[-1:]
    return total[reach:] - total[:-reach]


def features(code: np.ndarray) -> dict[int, float]:
    """A window's subsequences with their weights; none holds a sign."""
    out: dict[int, float] = {}
    for a, b, w in TRIPLES:
        for i in range(len(code) - b):
            if code[i] and code[i + a] and code[i + b]:
                key = int((code[i] * SYMBOLS + code[i + a]) * SYMBOLS + code[i + b])
                out[key] = out.get(key, 0.0) + w
    return out


class Landmarks:
    """The landmarks' sparse vectors and the Nyström map."""

    def __init__(self, words: list[str]):
        self.words = words
        rows = [features(codes(w)) for w in words]
        keys = sorted({k for r in rows for k in r})
        self.place = np.full(SYMBOLS ** 3, -1, np.int32)
        self.place[keys] = np.arange(len(keys))
        self.keys = np.array(keys, np.int64)
        self.phi = np.zeros((len(words), len(keys)))
        for i, r in enumerate(rows):
            norm = sum(v * v for v in r.values()) ** 0.5 or 1.0
            for k, v in r.items():
                self.phi[i, self.place[k]] = v / norm
        value, vector = np.linalg.eigh(self.phi @ self.phi.T)
        good = value > 1e-6
        self.root = vector[:, good] / np.sqrt(value[good])

    def vector(self, code: np.ndarray) -> np.ndarray:
        own = np.zeros(len(self.keys))
        for k, v in features(code).items():
            if self.place[k] >= 0:
                own[self.place[k]] += v
        return (self.phi @ own) @ self.root

    def weight(self, w: np.ndarray) -> np.ndarray:
        """The machine's weight of each subsequence."""
        out = np.zeros(SYMBOLS ** 3, np.float32)
        out[self.keys] = (self.root @ w) @ self.phi
        return out


def svm(x: np.ndarray, y: np.ndarray, steps: int, rng: np.random.Generator, c: float = 1e-4) -> tuple[np.ndarray, float]:
    """Averaged subgradient descent on the hinge loss, classes balanced."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, mean = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    sides = [np.flatnonzero(y > 0), np.flatnonzero(y < 0)]
    scale = float((x ** 2).sum(1).mean())
    for t in range(1, steps + 1):
        pick = np.concatenate([rng.choice(s, 16) for s in sides])
        wrong = pick[y[pick] * (x[pick] @ w) < 1]
        w = (1 - c) * w + (0.5 / scale) / (1 + t / 500) * (y[wrong, None] * x[wrong]).sum(0) / 32
        if t > steps // 2:
            mean += w
    mean /= steps - steps // 2
    return mean[:-1], float(mean[-1])


def worst(code: np.ndarray, weight: np.ndarray) -> tuple[float, int]:
    """The largest window of a text and its place, the first one at ties."""
    reach = max(WINDOW - 2, 1)
    best, place = -np.inf, 0
    for at in range(0, max(len(code) + 1 - reach, 1), SLICE):
        value = windows(code[at:at + SLICE + reach + SPAN], weight)[:SLICE]
        k = int(value.argmax())
        if value[k] > best:
            best, place = float(value[k]), at + k
    return best, place


def logistic(z: np.ndarray, label: np.ndarray, penalty: float = 1e-4, steps: int = 60) -> tuple[float, float]:
    """Slope and offset of the logistic function nearest to the labels: Newton
    steps on the penalised mean loss, each halved until the loss falls, since a
    whole one may leap to where every probability is 0 or 1 and no slope is left."""
    x, held = np.stack([z, np.ones_like(z)], 1), np.array([1.0, 0.0])
    ridge = np.diag([penalty, 1e-6])

    def loss(v: np.ndarray) -> float:
        t = x @ v
        return float((np.logaddexp(0, t) - label * t).mean() + 0.5 * v @ ridge @ v)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ held, -30, 30)))
        g = x.T @ (p - label) / len(label) + ridge @ held
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / len(label) + ridge, g)
        part, now = 1.0, loss(held)
        while part > 1e-9 and loss(held - part * step) > now - 1e-4 * part * (g @ step):
            part /= 2
        if part <= 1e-9:
            break
        held = held - part * step
    return float(held[0]), float(held[1])


class Machine:
    """The trained weights: a bounded array, the same for any corpus."""

    def __init__(self, weight: np.ndarray, slope: float, offset: float):
        self.weight, self.slope, self.offset = weight, slope, offset

    def raw(self, text: str) -> float:
        return max(worst(codes(text), self.weight)[0], 0.0)

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.raw(text) + self.offset, -30, 30))))


def terms(held: DataFrame) -> DataFrame:
    """(word, bad, plain): in how many toxic and clean texts each word of three
    letters or more stands; first letters count too: stems over all endings."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,}"), F.lit(0)))

    def stems(k: int):
        return F.transform(F.filter("words", lambda w: F.length(w) > k), lambda w: F.substring(w, 1, k))
    every = held.select("toxic", words.alias("words")).select(
        "toxic", F.explode(F.array_distinct(F.concat("words", stems(4), stems(5), stems(6)))).alias("word"))
    return every.groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("plain"))


def landmark_words(held: DataFrame, n: dict[int, int], landmarks: int) -> tuple[list[str], list[str]]:
    """The words most peculiar to toxic texts, and the commonest that are not."""
    odds = (F.log((F.col("bad") + 0.5) / (n[1] + 1) / ((F.col("plain") + 0.5) / (n[0] + 1))) * F.sqrt("bad"))
    counted = stored(terms(held).withColumn("odds", odds), "terms")

    def first(rows: DataFrame, order, most: int) -> list[str]:
        return [r["word"] for r in rows.orderBy(order, "word").limit(most).collect()]
    bad = first(counted.where("bad > 1 AND odds > 0"), F.desc("odds"), landmarks // 2)
    bad = bad or first(counted.where("bad > 0"), F.desc("odds"), 1)
    return bad, first(counted.where((F.length("word") <= WINDOW) & F.expr("plain > 0 AND odds <= 0")), F.desc("plain"), landmarks - len(bad))


def worst_windows(held: DataFrame, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Sides (1 or -1), values and letters of the worst window of every text, in order of their ids."""
    shared = held.sparkSession.sparkContext.broadcast(weight)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for text in b["text"].to_pylist():
                code = codes(text)
                value, at = worst(code, shared.value)
                found.append((value, code[at:at + WINDOW + 2].astype(np.uint8).tobytes()))
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["toxic"], pa.array([v for v, _ in found], pa.float64()),
                                              pa.array([c for _, c in found], pa.binary())], names=["doc_id", "toxic", "value", "code"])
    rows = held.select("doc_id", "toxic", "text").mapInArrow(find, "doc_id long, toxic int, value double, code binary").collect()
    rows.sort(key=lambda r: (r["toxic"], r["doc_id"]))
    return (np.array([1.0 if r["toxic"] else -1.0 for r in rows]), np.array([r["value"] for r in rows]),
            [np.frombuffer(bytes(r["code"]), np.uint8).astype(np.int32) for r in rows])


def train(held: DataFrame, landmarks: int = LANDMARKS, rounds: int = ROUNDS, seed: int = 5) -> Machine | None:
    """A latent SVM over windows of labelled texts: (doc_id, toxic, text) rows, read once a round."""
    n = {r["toxic"]: r["count"] for r in held.groupBy("toxic").count().collect()}
    if not (n.get(0) and n.get(1)):
        return None
    bad, plain = landmark_words(held, n, landmarks)
    if not bad:
        return None
    rng = np.random.default_rng(seed)
    marks = Landmarks(bad + plain)
    first = np.array([1.0] * len(bad) + [0.0] * len(plain))
    # to begin with, a window is as bad as it is like the bad landmarks
    weight = np.zeros(SYMBOLS ** 3, np.float32)
    weight[marks.keys] = np.maximum(marks.phi[first > 0].max(0) - 0.5 * marks.phi[first == 0].max(0, initial=0.0), 0)
    more_x, more_y = [], []
    for _ in range(rounds):
        y, _, found = worst_windows(held, weight)
        x = [marks.vector(code) for code in found]
        # what a round took for the worst of clean texts stays a counterexample
        more_x, more_y = more_x + [v for v, s in zip(x, y) if s < 0], more_y + [s for s in y if s < 0]
        w, _ = svm(np.array(x + more_x), np.array([*y, *more_y]), STEPS, rng)
        weight = marks.weight(w)
    side, raw, _ = worst_windows(held, weight)
    raw, label = np.maximum(raw, 0.0), (1 + side) / 2
    # where classes overlap, the larger one wins
    mid, spread = np.median(raw), raw.std() or 1.0
    slope, offset = logistic((raw - mid) / spread, label)
    return Machine(weight, float(slope / spread), float(offset - slope * mid / spread))


def sample(docs: DataFrame, labels: DataFrame, learn, bound: int = SAMPLE) -> DataFrame:
    """(doc_id, toxic, text): whole training texts of at most ``bound`` ids a
    class, stored; of a repeated id one text, chosen by its hash."""
    chosen = []
    for value in (1, 0):
        ids = labels.where((F.col("toxic") == value) & learn).select("doc_id").distinct()
        chosen += [(r["doc_id"], value) for r in ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound).collect()]
    spark = docs.sparkSession
    ids = spark.createDataFrame(chosen, "doc_id long, toxic int")
    rows = (docs.where(F.length("text") > 0).join(F.broadcast(ids), "doc_id")
            .groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("of"))
            .select("doc_id", "toxic", F.col("of.text").alias("text")))
    return stored(rows.repartition(spark.sparkContext.defaultParallelism, "doc_id"), "labelled")


def machine(docs: DataFrame, labels: DataFrame, held_out: int = 1, folds: int = 3, id_col: str = "doc_id",
            text_col: str = "text") -> Machine | None:
    """Trained on labels whose fold (crc32 of the id as text, modulo ``folds``) isn't ``held_out``."""
    d = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    own = labels.select("doc_id", "toxic").where("doc_id IS NOT NULL")
    return train(sample(d, own, fold_of(F.col("doc_id"), folds) != held_out))


def scores(docs: DataFrame, trained: Machine | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(trained)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(
                [m.score(t or "") if m else 0.0 for t in b["text"].to_pylist()], pa.float64())], names=["doc_id", "score"])
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(rows, "doc_id long, score double")


def clean(docs: DataFrame, trained: Machine | None, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, that score under the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(trained)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            yield b.filter(pa.array([m is None or m.score(t or "") < threshold for t in b[text_col].to_pylist()], pa.bool_()))
    return docs.mapInArrow(rows, docs.schema)
