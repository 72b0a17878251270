"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a word, both ways, and labels every position
with a distribution over languages; a text's is the mean over all positions
of its words. It is trained in numpy by backpropagation through time (Adam,
cross entropy at every position) on words of a bounded sample of labelled texts,
chosen by the hash of their id: of each language an equal part of ``SAMPLE``, but
``LEAST`` at least. A text of more than ``CHARS`` characters gives ``DRAWN`` windows
from all over it, each at a hashed place of its equal part. Words are read in pieces
of up to ``LONGEST`` bytes, cut at characters, in training as in prediction. The
state starts anew at each piece (no context reaches over words), so equal words have
equal labels: a bounded table per worker holds what the network said of them.

Every language with a word to learn from is learned, however rare; beyond
``MANY`` languages the steps grow with their number. Defined results: a NULL text, or one without a letter, is ``und`` with
score 0; with no language to learn every text is; repeated rows each give a
row; an empty table gives an empty result. Ties fall to the first language in
order.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from strata.llm.common import fold_of

SAMPLE, CHARS, LEAST = 4_000, 4_000, 16  # 16 MB of text at the driver, beyond 250 languages 64 kB for each
DRAWN = 8  # windows of a long text, CHARS characters in all
WIDTH, EMBED, LONGEST = 16, 16, 24  # state, embedding, bytes read at a time
STEPS, BATCH, RATE = 500, 128, 0.01
MANY = 16  # languages that STEPS suffice for
TABLE = 800_000  # words remembered per worker; only speed depends on it
SIGNS = bytes(x for x in range(33, 127) if not chr(x).isalpha())
LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether some character is a letter; number signs like ½ are none."""
    return any(m[0].isalpha() for m in LETTER.finditer(text))


def pieces(word: bytes) -> list[bytes]:
    """The word in parts of up to ``LONGEST`` bytes, no character cut."""
    out = []
    while len(word) > LONGEST:
        end = LONGEST
        while end > LONGEST - 4 and word[end] & 0xC0 == 0x80:
            end -= 1
        out.append(word[:end])
        word = word[end:]
    return [*out, word] if word else out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Gru:
    """One direction: h = (1 - z) h' + z n with n = tanh(x + r (U h'))."""

    def __init__(self, rng: np.random.Generator):
        self.w = {"x": rng.normal(0, EMBED ** -0.5, (EMBED, 3 * WIDTH)), "u": rng.normal(0, WIDTH ** -0.5, (WIDTH, 3 * WIDTH)),
                  "b": np.zeros(3 * WIDTH)}
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """States at every step of x (step, row, EMBED); masked steps keep the state."""
        h, out, cache, n = np.zeros((x.shape[1], WIDTH), np.float32), [], [], WIDTH
        inner = x @ self.w["x"] + self.w["b"]
        for t in range(len(x)):
            rec = h @ self.w["u"]
            gate = sigmoid(inner[t, :, :2 * n] + rec[:, :2 * n])
            z, r = gate[:, :n], gate[:, n:]
            new = np.tanh(inner[t, :, 2 * n:] + r * rec[:, 2 * n:])
            z = z * mask[t][:, None]
            if keep:
                cache.append((h, z, r, new, rec[:, 2 * n:]))
            h = h + z * (new - h)
            out.append(h)
        return np.stack(out), cache

    def backward(self, x: np.ndarray, mask: np.ndarray, cache: list, dout: np.ndarray) -> tuple[np.ndarray, dict]:
        """Through time: the gradient of x and of the weights."""
        g = {k: np.zeros_like(v) for k, v in self.w.items()}
        dx, dh, n = np.zeros_like(x), np.zeros(dout.shape[1:], np.float32), WIDTH
        for t in range(len(x) - 1, -1, -1):
            h, z, r, new, rec = cache[t]
            dh = dh + dout[t]
            dz, dnew = dh * (new - h), dh * z
            m = mask[t][:, None]
            raw = np.divide(z, m, out=np.zeros_like(z), where=m > 0)
            da = np.concatenate([dz * m * raw * (1 - raw), np.zeros_like(dz), dnew * (1 - new ** 2)], 1)
            dr = da[:, 2 * n:] * rec
            da[:, n:2 * n] = dr * r * (1 - r)
            du = da.copy()
            du[:, 2 * n:] *= r
            g["x"] += x[t].T @ da
            g["b"] += da.sum(0)
            g["u"] += h.T @ du
            dx[t] = da @ self.w["x"].T
            dh = dh * (1 - z) + du @ self.w["u"].T
        return dx, g


class Model:
    """Embedding, two directions, and a softmax over both states at each position."""

    def __init__(self, langs: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs, self.key = langs, uuid.uuid4().hex
        self.embed = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.ways = Gru(rng), Gru(rng)
        self.out = rng.normal(0, (2 * WIDTH) ** -0.5, (2 * WIDTH, len(langs))).astype(np.float32)
        self.bias = np.zeros(len(langs), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, *self.ways[0].w.values(), *self.ways[1].w.values(), self.out, self.bias]

    def forward(self, raw: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Log probabilities (step, row, language) of bytes (step, row)."""
        x = self.embed[raw]
        ahead, c0 = self.ways[0].forward(x, mask, keep)
        back, c1 = self.ways[1].forward(x[::-1], mask[::-1], keep)
        both = np.concatenate([ahead, back[::-1]], 2)
        logit = both @ self.out + self.bias
        logit -= logit.max(2, keepdims=True)
        return logit - np.log(np.exp(logit).sum(2, keepdims=True)), (x, both, c0, c1)

    def step(self, raw: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Loss and gradients of one batch."""
        log, (x, both, c0, c1) = self.forward(raw, mask, True)
        weight = mask / mask.sum()
        rows = np.arange(len(label))
        loss = -float((log[:, rows, label] * weight).sum())
        d = np.exp(log)
        d[:, rows, label] -= 1
        d *= weight[:, :, None]
        dboth = d @ self.out.T
        dx0, g0 = self.ways[0].backward(x, mask, c0, dboth[:, :, :WIDTH])
        dx1, g1 = self.ways[1].backward(x[::-1], mask[::-1], c1, dboth[::-1, :, WIDTH:])
        dembed = np.zeros_like(self.embed)
        np.add.at(dembed, raw.ravel(), (dx0 + dx1[::-1]).reshape(-1, EMBED))
        flat = both.reshape(-1, 2 * WIDTH)
        return loss, [dembed, *g0.values(), *g1.values(), flat.T @ d.reshape(-1, d.shape[2]), d.sum((0, 1))]

    def positions(self, words: list[bytes]) -> list[np.ndarray]:
        """Probabilities (position, language) of every byte of each word."""
        parts = [(i, p) for i, w in enumerate(words) for p in pieces(w)]
        out: list[list[np.ndarray]] = [[] for _ in words]
        parts.sort(key=lambda p: len(p[1]))
        done: dict[tuple[int, int], np.ndarray] = {}
        for at in range(0, len(parts), 1024):
            some = parts[at:at + 1024]
            raw, mask = padded([p for _, p in some])
            p = np.exp(self.forward(raw, mask)[0])
            for k, (_, part) in enumerate(some):
                done[at + k, 0] = p[:len(part), k]
        order = sorted(range(len(parts)), key=lambda k: parts[k][0])
        for k in order:
            out[parts[k][0]].append(done[k, 0])
        return [np.concatenate(x) if x else np.zeros((0, len(self.langs))) for x in out]


def sums(model: Model, words: list[bytes]) -> np.ndarray:
    """The probabilities of each word's positions, added up."""
    parts = sorted(((i, p) for i, w in enumerate(words) for p in pieces(w)), key=lambda p: len(p[1]))
    out = np.zeros((len(words), len(model.langs)), np.float32)
    for at in range(0, len(parts), 1024):
        some = parts[at:at + 1024]
        raw, mask = padded([p for _, p in some])
        p = np.exp(model.forward(raw, mask)[0]) * mask[:, :, None]
        np.add.at(out, [i for i, _ in some], p.sum(0))
    return out


#: What each worker knows of words, by model.
_KNOWN: dict[str, dict[bytes, bytes]] = {}


def padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    length = np.array([len(w) for w in words])
    mask = (np.arange(max(length.max(initial=1), 1))[:, None] < length).astype(np.float32)
    raw = np.zeros(mask.T.shape, np.uint8)
    raw[mask.T > 0] = np.frombuffer(b"".join(words), np.uint8)
    return raw.T.astype(np.int64), mask


def words_of(text: str) -> list[bytes]:
    """The words in lower case, without the signs around them."""
    return [w for x in text.lower().encode().split() if (w := x.strip(SIGNS))]


def train(samples: list[tuple[str, str]], steps: int = STEPS, seed: int = 7) -> Model | None:
    """A network trained on (language, text) samples, languages balanced."""
    words: dict[str, list[bytes]] = {}
    for lang, text in samples:
        if held := [p for w in words_of(text) for p in pieces(w)]:
            words.setdefault(lang, []).extend(held)
    langs = sorted(words)
    if not langs:
        return None
    model, rng = Model(langs, seed), np.random.default_rng(seed)
    pool = [words[lang] for lang in langs]
    steps = steps * max(len(langs), MANY) // MANY
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in model.parameters()]
    for step in range(1, steps + 1):
        label = rng.integers(0, len(langs), BATCH)
        raw, mask = padded([pool[k][rng.integers(0, len(pool[k]))] for k in label])
        _, grads = model.step(raw, mask, label)
        rate = RATE * min(1, step / 20) * (1 - 0.9 * step / steps)
        for p, g, (m, v) in zip(model.parameters(), grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return model


def drawn(text: Column, key: Column) -> Column:
    """A text of up to ``CHARS`` characters as it is; of a longer one ``DRAWN``
    windows, one at a hashed place of each equal part, without the words that
    their ends cut (a window without white space stays whole)."""
    size = CHARS // DRAWN

    def window(i: Column) -> Column:
        start = F.floor(i * F.length(text) / DRAWN)
        room = F.floor((i + 1) * F.length(text) / DRAWN) - start - size + 1
        part = F.substring(text, (start + F.pmod(F.xxhash64(key, i), room) + 1).cast("int"), F.lit(size))
        inner = F.regexp_extract(part, r"(?s)^\S*\s+(.*\s)\S*$", 1)
        return F.when(F.trim(inner) != "", inner).otherwise(part)
    return F.when(F.length(text) <= CHARS, text).otherwise(
        F.array_join(F.transform(F.sequence(F.lit(0), F.lit(DRAWN - 1)), window), "\n"))


def sample(docs: DataFrame, learn, bound: int = SAMPLE) -> list[tuple[str, str]]:
    """(lang, text) of an equal number of texts of every language, chosen by the
    hash of their id: ``bound`` in all, but ``LEAST`` a language at least."""
    labelled = docs.where(learn & F.col("lang").isNotNull() & (F.trim("text") != ""))
    langs = labelled.select("lang").distinct().count()
    if not langs:
        return []
    each = max(bound // langs, LEAST)

    def first(rows: DataFrame) -> DataFrame:
        rank = F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
        return rows.withColumn("rank", rank).where(F.col("rank") <= each).drop("rank")
    ids = first(labelled.select("lang", "doc_id")).distinct().withColumnsRenamed({"lang": "of", "doc_id": "id"})
    # an id may be repeated, so the texts are counted again
    texts = first(labelled.join(F.broadcast(ids), (F.col("lang") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id")))
                  .select("lang", "doc_id", drawn(F.col("text"), F.col("doc_id")).alias("text")))
    return [(r["lang"], r["text"]) for r in texts.sort("lang", F.xxhash64("doc_id"), "doc_id", "text").collect()]


def predict(docs: DataFrame, held_out: int = 2, folds: int = 4, id_col: str = "doc_id", text_col: str = "text",
            lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learned from the labelled texts
    whose fold (crc32 of the id as text, modulo ``folds``) isn't ``held_out``."""
    d = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))
    fold = fold_of(F.col("doc_id"), folds)
    model = train(sample(d, fold != held_out))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        if net and net.key not in _KNOWN:
            _KNOWN.clear()  # one model's table
        known = _KNOWN.setdefault(net.key, {}) if net else {}
        for b in batches:
            out = []
            for text in b["text"].to_pylist():
                words = words_of(text or "")
                if net is None or not words or not has_letter(text):
                    out.append(("und", 0.0))
                    continue
                if len(known) > TABLE:
                    known.clear()
                new = list({w for w in words if w not in known})
                known.update(zip(new, map(bytes, sums(net, new)), strict=True))
                total = np.frombuffer(b"".join(map(known.__getitem__, words)), np.float32)
                total = total.reshape(len(words), -1).sum(0, dtype=np.float64)
                total /= total.sum()
                best = int(total.argmax())
                out.append((net.langs[best], float(total[best])))
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["held_out"], pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])
    return d.select("doc_id", "text", (fold == held_out).alias("held_out")).mapInArrow(
        label, "doc_id long, held_out boolean, lang_pred string, score double")
