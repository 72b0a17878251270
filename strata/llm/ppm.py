"""Prediction by partial matching over bytes, pretrained on the corpus.

The trie of byte contexts up to ``ORDER`` bytes holds, for every byte string of 1
to ORDER + 1 bytes, how often it occurs (n) and, read as a context, how often
(total) and by how many symbols (kinds) it goes on, and how often these symbols
follow the context one byte shorter (shared). That is all that method D's escape
estimates and the exclusion of symbols already tried in longer contexts need. The
code length of a byte is that of escaping from the longest known context down to
one that knows the byte; a text's is the sum over its bytes and an end mark.
Beside it stands a unigram base score over words.

Texts are dealt into blocks of about ``BLOCK`` bytes, kept compressed in the
shared folder. A block's distinct strings of ORDER + 1 bytes travel packed, one
row for each block and bucket: strings whose last ``LOW`` bytes of context agree
share a bucket, so a bucket holds every string that their contexts of LOW bytes
and more are made of. It adds up the counts of all blocks, builds its part of the
trie and sends each block the code lengths of that block's strings, in the order
in which the block finds them again. Words go the same way, by hash.
Strings of up to LOW bytes, of which UTF-8 has a few million at most, are counted
in a table that every bucket gets. A task holds one block of text, or the strings
of one bucket.

Defined results: a NULL or empty text is its end mark alone (one token);
repeated rows are counted, and scored, once each; a NULL id is held out (its
crc32 is that of the empty text); with nothing to train on, every byte and the
end mark cost 1/257 and words have no counts; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fold_of, stored, texts

ORDER = 6  # bytes of the longest context; up to 6 fit a key
LOW = 3  # bytes of context that strings of a bucket share
BUCKETS = 1024  # parts of the trie
BLOCK = 16 << 20  # bytes of text that a task scores together
CHUNK = 4 << 20  # bytes of text whose strings are counted at a time
SLICE = 1 << 20  # bytes of text whose strings are looked up at a time
SYMBOLS = 257  # 256 byte values and the end mark
# Not in UTF-8: the byte before a text, as context, and the end mark.
START, END = b"\xfe", b"\xff"
SCORED = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")
HELD = "block long, bucket int, strings binary, words binary, counts binary, key long, n long"


def strings(texts: list[bytes], order: int) -> np.ndarray:
    """The key of each symbol with its whole context: the bytes in an integer,
    led by a 1 that marks their number."""
    raw = np.frombuffer(b"".join(START * order + t + END for t in texts), np.uint8)
    key = np.full(max(len(raw) - order, 0), 1, np.int64)
    for k in range(order + 1):
        key <<= 8
        key |= raw[k:len(raw) - order + k]
    ends = np.cumsum(np.array([len(t) + 1 + order for t in texts], np.int64))[:-1]  # windows that reach into the next text
    keep = np.ones(len(key), bool)
    drop = (ends[:, None] - order + np.arange(order)).ravel()
    keep[drop] = False
    return key[keep]


def shorter(key: np.ndarray, size: int) -> np.ndarray:
    """The last ``size`` bytes of each string."""
    return key & ((1 << 8 * size) - 1) | 1 << 8 * size


def added(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, with the sum of each one's ``n``."""
    if not len(key):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(n[order], first)


def at(keys: np.ndarray, values: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The value of each key among sorted ``keys``, 0 for any other."""
    if not len(keys):
        return np.zeros(len(key))
    i = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    return np.where(keys[i] == key, values[i], 0).astype(float)


def turned(key: np.ndarray, order: int) -> np.ndarray:
    """The keys with the bytes of their context in reverse, so that in numeric
    order the strings of like contexts are neighbours; turned twice they are as
    before."""
    b = key.astype("<i8").view(np.uint8).reshape(-1, 8).copy()
    b[:, 1:order + 1] = b[:, order:0:-1]
    return b.reshape(-1).view("<i8").astype(np.int64)


def packed(values: np.ndarray) -> bytes:
    """Fixed-width numbers byte plane by byte plane, compressed."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpacked(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def bucket_of(key: np.ndarray, low: int, buckets: int) -> np.ndarray:
    """The part of the trie that holds a string: a hash of its last ``low`` bytes
    of context."""
    context = (key >> 8 & (1 << 8 * low) - 1).astype(np.uint64)
    return ((context * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def cut(data: bytes, lengths: list[int]) -> list[bytes]:
    """The texts of a block."""
    whole, ends = zstandard.ZstdDecompressor().decompress(data) if any(lengths) else b"", np.cumsum([0, *lengths])
    return [whole[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)]


def blocks(docs: DataFrame, size: int) -> DataFrame:
    """A row for each block: its texts, compressed, with their ids."""
    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, part = TaskContext.get().partitionId() << 24, 0, []

        def row() -> pa.RecordBatch:
            ids, out, raw = zip(*part, strict=True)
            data = zstandard.ZstdCompressor(level=3).compress(b"".join(raw))
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([out], pa.list_(pa.bool_())),
                pa.array([[len(t) for t in raw]], pa.list_(pa.int32())), pa.array([data], pa.binary())],
                ["block", "ids", "held", "lengths", "texts"])
        for b in batches:
            for doc_id, out, text in zip(*(b[c].to_pylist() for c in ("doc_id", "held_out", "text")), strict=True):
                part.append((doc_id, out, text.encode()))
                held += len(part[-1][2]) + 64  # so that empty texts end a block, too
                if held >= size:
                    yield row()
                    part, held, number = [], 0, number + 1
        if part:
            yield row()
    return docs.mapInArrow(dealt, "block long, ids array<long>, held array<boolean>, lengths array<int>, texts binary")


class Block:
    """The distinct longest strings and words of a block, in one order for all who
    tally the same texts: by bucket, and within one as they are packed."""

    def __init__(self, order: int, low: int, buckets: int):
        self.order, self.low, self.buckets = order, low, buckets
        self.held, self.size, self.grams, self.counted = [], 0, [], Counter()

    def add(self, text: bytes, held_out: bool) -> None:
        self.held.append((text, held_out))
        self.size += len(text)
        if held_out:
            for w in text.lower().split():
                self.counted[w] += 0
        else:
            self.counted.update(text.lower().split())
        if self.size >= CHUNK:
            self.tally()

    def tally(self) -> None:
        for learn in (True, False):
            part = [t for t, out in self.held if out != learn]
            if part:
                key, n = np.unique(strings(part, self.order), return_counts=True)
                self.grams.append((key, n if learn else np.zeros_like(n)))
        self.held, self.size = [], 0

    def strings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(turned key, n, bucket), with n from texts to learn from."""
        self.tally()
        key, n = added(np.concatenate([k for k, _ in self.grams]), np.concatenate([c for _, c in self.grams]))
        self.grams = []
        key = turned(key, self.order)
        by = np.argsort(key)
        key, n = key[by], n[by]
        bucket = bucket_of(turned(key, self.order), self.low, self.buckets)
        by = np.argsort(bucket.astype(np.uint16) if self.buckets <= 1 << 16 else bucket, kind="stable")
        return key[by], n[by], bucket[by]

    def words(self) -> list[tuple[int, list[bytes]]]:
        """By bucket, its words in order."""
        parts = {}
        for w in self.counted:
            parts.setdefault(zlib.crc32(w) % self.buckets, []).append(w)
        return [(bucket, sorted(parts[bucket])) for bucket in sorted(parts)]


def block_rows(docs: DataFrame, order: int, low: int, buckets: int) -> DataFrame:
    """Per block, by bucket and packed: its distinct longest strings and its words,
    with how often they occur in texts to learn from; and the counts of its strings
    of 1 to ``low`` bytes."""
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("strings", pa.binary()), ("words", pa.binary()),
                        ("counts", pa.binary()), ("key", pa.int64()), ("n", pa.int64())])

    def batch(block: int, size: int, **columns) -> pa.RecordBatch:
        columns["block"] = np.full(size, block)
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns
                                           else pa.nulls(size, f.type) for f in schema], schema=schema)

    def out(number: int, block: Block) -> Iterator[pa.RecordBatch]:
        parts = block.words()
        counts = [np.array([block.counted[w] for w in part], np.int32) for _, part in parts]
        yield batch(number, len(parts), bucket=[b for b, _ in parts], n=[int(c.sum()) for c in counts],
                    words=[zstandard.ZstdCompressor(level=3).compress(b" ".join(part)) for _, part in parts],
                    counts=[packed(c) for c in counts])
        key, n, bucket = block.strings()
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        parts = list(zip(first, [*first[1:], len(key)], strict=True))
        yield batch(number, len(parts), bucket=bucket[first],
                    strings=[packed(np.diff(key[i:j], prepend=0)) for i, j in parts],
                    counts=[packed(n[i:j].astype(np.int32)) for i, j in parts])
        key = turned(key, order)
        for length in range(1, low + 1):
            short, m = added(shorter(key, length), n)
            yield batch(number, int((m > 0).sum()), key=short[m > 0], n=m[m > 0])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                number, held, lengths, data = (b[c][i].as_py() for c in ("block", "held", "lengths", "texts"))
                block = Block(order, low, buckets)
                for text, held_out in zip(cut(data, lengths), held, strict=True):
                    block.add(text, held_out)
                yield from out(number, block)
    return docs.mapInArrow(rows, HELD)


def levels(key: np.ndarray, n: np.ndarray, sizes: range, tails: dict | None = None) -> dict:
    """By size of string: (its keys, n), and (the keys of the contexts one byte
    shorter, total, kinds, shared). ``tails`` are the levels below the first."""
    made, below = {}, (tails or {}).get(sizes[0] - 1)
    for size in sizes:
        own = added(shorter(key, size), n)
        tail = at(*below[0], shorter(own[0], size - 1)) if below else np.zeros(len(own[0]))
        context = own[0] >> 8  # in order, as the strings are
        counts = added(context, own[1]), added(context, np.ones(len(context))), added(context, tail)
        made[size] = below = (own, (counts[0][0], *(c for _, c in counts)))
    return made


def code_lengths(strings: np.ndarray, trie: dict, order: int) -> np.ndarray:
    """log10 probability of the last symbol of each string of order + 1 bytes,
    given the levels of a trie that it needs. By method D a symbol seen n times has
    2n - 1 parts of twice the context's total, and each kind of symbol leaves one
    to the escape; symbols of longer contexts count in neither."""
    out, open_ = np.zeros(len(strings)), np.ones(len(strings), bool)
    kinds_above, shared_above = np.zeros(len(strings)), np.zeros(len(strings))
    kinds = np.zeros(len(strings))
    for size in range(order + 1, 0, -1):
        key = shorter(strings, size)
        own, (context, *counts) = trie[size]
        n = at(*own, key)
        total, kinds, shared = (at(context, c, key >> 8) for c in counts)
        new = kinds - kinds_above
        parts = 2 * (total - shared_above)
        known = open_ & (total > 0) & (parts > 0)
        coded = known & (n > 0)
        escaped = known & (n == 0) & (new > 0)
        out[coded] += np.log10((2 * n[coded] - 1) / parts[coded])
        out[escaped] += np.log10(new[escaped] / parts[escaped])
        open_ &= ~coded
        kinds_above, shared_above = kinds, shared
    out[open_] -= np.log10(np.maximum(SYMBOLS - kinds[open_], 1))
    return out


def bucket_lengths(rows: pd.DataFrame, below: dict, order: int, low: int) -> pd.DataFrame:
    """The code lengths of the strings of each block in one bucket, in their order."""
    key, n = np.empty(0, np.int64), np.empty(0, np.int64)
    waiting, size = [], 0
    for strings_, counts in [*zip(rows["strings"], rows["counts"], strict=True), (None, None)]:
        if strings_ is not None:
            k, c = np.cumsum(unpacked(strings_, "<i8")), unpacked(counts, "<i4").astype(np.int64)
            waiting.append((k, c))
            size += len(k)
        if waiting and (strings_ is None or size > max(len(key), 1 << 16)):  # blocks join the sums by and by
            key, n = added(np.concatenate([key, *(k for k, _ in waiting)]), np.concatenate([n, *(c for _, c in waiting)]))
            waiting, size = [], 0
    plain = turned(key, order)
    seen = n > 0
    trie = below | levels(plain[seen], n[seen], range(low + 1, order + 2), below)
    lengths = code_lengths(plain, trie, order).astype(np.float32)
    sent = [np.unique(lengths[np.searchsorted(key, np.cumsum(unpacked(x, "<i8")))], return_inverse=True) for x in rows["strings"]]
    return pd.DataFrame({"block": rows["block"], "bucket": rows["bucket"], "values": [packed(v) for v, _ in sent],
                         "lengths": [packed(i.astype(np.int32)) for _, i in sent]})


def bucket_words(rows: pd.DataFrame) -> pd.DataFrame:
    """How often the words of each block occur in all, in their order; the first
    row tells how many kinds of words to learn from the bucket has."""
    own = [zstandard.ZstdDecompressor().decompress(w).split(b" ") for w in rows["words"]]
    total = dict.fromkeys((w for part in own for w in part), 0)
    for part, counts in zip(own, rows["counts"], strict=True):
        for w, n in zip(part, unpacked(counts, "<i4").tolist(), strict=True):
            total[w] += n
    kinds = np.zeros(len(rows), np.int64)
    kinds[0] = sum(n > 0 for n in total.values())
    return pd.DataFrame({"block": rows["block"], "bucket": rows["bucket"], "kinds": kinds,
                         "totals": [packed(np.array([total[w] for w in part], np.int64)) for part in own]})


class Lookup:
    """Values of sorted distinct keys: a table by hash, the rest by bisection."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        self.shift = np.uint64(64 - max(int(4 * max(len(keys), 1)).bit_length(), 4))
        self.held = np.zeros(1 << int(64 - int(self.shift)), np.int32)
        self.held[self.slot(keys)] = np.arange(len(keys), dtype=np.int32)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        i = self.held[self.slot(keys)]
        miss = self.keys[i] != keys
        i[miss] = np.searchsorted(self.keys, keys[miss])
        return self.values[i]


def score_block(docs: pd.DataFrame, rows: pd.DataFrame, order: int, low: int, buckets: int,
                tokens: int, kinds: int, ends: int) -> pd.DataFrame:
    """Scores of a block's texts from the code lengths of its strings and the counts of its words."""
    ids, texts_, held_out, block = [], [], [], Block(order, low, buckets)
    for i, h, lengths, data in zip(docs["ids"], docs["held"], docs["lengths"], docs["texts"], strict=True):
        ids += [None if pd.isna(x) else int(x) for x in i]
        texts_ += cut(data, list(lengths))
        held_out += [bool(x) for x in h]
    for text in texts_:
        block.add(text, False)  # in which texts the strings occur makes no difference here
    rows = rows.sort_values("bucket")
    found = rows["totals"].dropna()
    totals = np.concatenate([unpacked(x, "<i8") for x in found]) if len(found) else np.empty(0, np.int64)
    words = [w for _, part in block.words() for w in part]
    log = dict(zip(words, np.log10((totals + 0.1) / (tokens + 0.1 * (kinds + 1))).tolist(), strict=True))
    unknown = {w for w, n in zip(words, totals.tolist(), strict=True) if not n}
    end = float(np.log10((ends + 0.1) / (tokens + 0.1 * (kinds + 1))))
    grams = rows[rows["lengths"].notna()]
    key = turned(block.strings()[0], order)
    lengths = np.concatenate([unpacked(v, "<f4")[unpacked(i, "<i4")] for v, i in zip(grams["values"], grams["lengths"], strict=True)])
    by = np.argsort(key)
    lookup = Lookup(key[by], lengths[by].astype(float))
    base, held, scores, size = [], [], [], 0

    def looked_up() -> None:
        starts = np.cumsum([0, *(len(t) + 1 for t in held)])[:-1]
        scores.extend(np.add.reduceat(lookup(strings(held, order)), starts))
        held.clear()
    for raw in texts_:
        own = raw.lower().split()
        known = len(own) - sum(map(unknown.__contains__, own)) if unknown else len(own)
        base.append((len(own) + 1, known + (ends > 0), tokens, sum(map(log.__getitem__, own)) + end))
        held.append(raw)
        size += len(raw)
        if size >= SLICE:
            looked_up()
            size = 0
    if held:
        looked_up()
    made = pd.DataFrame(base, columns=["n_tokens", "n_known", "train_tokens", "base_score"])
    made.insert(0, "doc_id", pd.array(ids, "Int64"))
    made.insert(1, "held_out", held_out)
    return made.assign(score=np.array(scores, float))


def score(docs: DataFrame, order: int = ORDER, block: int = BLOCK, held_out: int = 0, folds: int = 10,
          id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """log10 probability of every text, learned from the texts whose fold
    (crc32 of the id as text, modulo ``folds``) isn't ``held_out``."""
    spark, low = docs.sparkSession, min(LOW, order)
    d = texts(docs, id_col, text_col).withColumn("held_out", fold_of(F.col("doc_id"), folds) == held_out)
    # a row is megabytes: row groups are looked at after every few
    d = stored(blocks(d, block), "ppm-texts", **{"parquet.block.size": 2 * BLOCK, "parquet.page.size.row.check.min": 2})
    held = stored(block_rows(d, order, low, buckets), "ppm-blocks")
    short = held.where("key IS NOT NULL").groupBy("key").agg(F.sum("n").alias("n")).toPandas().sort_values("key")
    key, n = short["key"].to_numpy(np.int64), short["n"].to_numpy(np.int64)
    below = {}
    for size in range(1, low + 1):
        own = (key >> 8 * size) == 1
        below |= levels(key[own], n[own], range(size, size + 1), below)
    shared = spark.sparkContext.broadcast(below)
    words = stored(held.where("words IS NOT NULL").select("block", "bucket", "words", "counts").groupBy("bucket")
                   .applyInPandas(bucket_words, "block long, bucket int, kinds long, totals binary"), "ppm-words")
    kinds = words.agg(F.coalesce(F.sum("kinds"), F.lit(0))).first()[0]
    tokens = held.where("words IS NOT NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ends = d.agg(F.coalesce(F.sum(F.size(F.filter("held", lambda h: ~h))), F.lit(0))).first()[0]
    tokens, kinds = tokens + ends, kinds + (ends > 0)

    def measured(rows: pd.DataFrame) -> pd.DataFrame:
        return bucket_lengths(rows, shared.value, order, low)
    needed = (held.where("strings IS NOT NULL").select("block", "bucket", "strings", "counts").groupBy("bucket")
              .applyInPandas(measured, "block long, bucket int, values binary, lengths binary")
              .unionByName(words.drop("kinds"), allowMissingColumns=True))

    def scored(texts: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        return score_block(texts, rows, order, low, buckets, tokens, kinds, ends)
    return d.groupBy("block").cogroup(needed.groupBy("block")).applyInPandas(scored, SCORED)
