"""Collocation mining by Rabin-Karp fingerprints.

A text is lower-cased (A-Z), split into pieces at punctuation and line ends and
these into words at blanks; phrases never cross a piece. Texts of a language
are gathered into blocks. In a block, prefix sums of a polynomial over the bytes
give every word's hash, and prefix sums over those hashes give the fingerprint
of every phrase by one subtraction. A block emits a fingerprint once, with its
number of occurrences: at most four a word, packed by slice of the fingerprints,
a row for each slice.

A shuffle by slice sums the occurrences. Only fingerprints that reach the
minimum go back, packed by block, to their blocks, which find the places,
compare them word by word, so that a group is one phrase, and read its text:
frequent phrases alone are materialised, packed by slice as before. Counts are
summed once more by that text, which parts phrases that share a fingerprint, so the result is exact at
any width of the fingerprint. Words and pairs go first; longer phrases are
fingerprinted where all their pairs are frequent, which no frequent phrase fails.

A block is one task's memory, and so is a slice; there are the more slices the
more words. The rest is spread by text.
A word in all texts is one row a block. The best phrases of a language are
taken from salted parts first. Arithmetic is exact (long, decimal(38) products).

Defined results: a NULL or empty text has no words; a NULL language is ``und``,
like the language of that name. Repeated rows count as often as they stand. Ids
and other columns are ignored. An empty table has no phrases.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from strata.llm.common import stored
from strata.llm.hashing import BASE, mixed, runs, window_hashes, word_hashes

BLOCK = 8 << 20  # bytes of text in a block
SALTS = 64
GAP, END = 32, 10  # after folding: between words, between pieces

FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A"):ord("Z") + 1] += 32
FOLD[list(b".,;:!?\n\x0b\x0c\r")] = END
FOLD[9] = GAP

BLOCKS = "block long, lang string, words long, data binary"
GROUPS = "slice long, block long, keys binary, counts binary"  # int64 and int32 of one slice
TIMES = 24  # bits of a count
SLICES, SLICE_WORDS = 256, 1 << 20  # the fewest slices, and the most words for each
PHRASES = "lang string, phrases array<string>, times array<long>"  # of one slice


# --- one block, in numpy

class Block:
    """Words of folded bytes: where they start and end, their piece, hash and exact number."""

    def __init__(self, data: bytes, bits: int = 64):
        self.data = np.frombuffer(data, np.uint8)
        self.drop = np.uint64(64 - bits)
        self.start, self.end = runs((self.data != GAP) & (self.data != END))
        self.piece = np.searchsorted(np.flatnonzero(self.data == END), self.start)
        self.hash = word_hashes(self.data, self.start, self.end) >> self.drop
        self.number = self._numbers()

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()

    def _numbers(self) -> np.ndarray:
        """A number for each different word, by hash where the bytes agree with the first word of it."""
        _, first, number = np.unique(self.hash, return_index=True, return_inverse=True)
        other = first[number]
        size = self.end - self.start
        clash = bool((size != size[other]).any())
        todo, k = np.flatnonzero(other != np.arange(len(other))), 0
        while not clash and len(todo):
            todo = todo[size[todo] > k]
            if k == 64:  # few words are longer: whole comparisons
                clash = any(self.word(i) != self.word(other[i]) for i in todo)
                break
            clash = bool((self.data[self.start[todo] + k] != self.data[self.start[other[todo]] + k]).any())
            k += 1
        if clash:
            seen: dict[bytes, int] = {}
            return np.array([seen.setdefault(self.word(i), len(seen)) for i in range(len(size))])
        return number

    def keys(self, n: int, seed: int) -> np.ndarray:
        """The fingerprint of the ``n`` words from each word on."""
        sums = window_hashes(self.hash, n)
        return (mixed(sums + np.uint64((seed + n * BASE) % (1 << 64))) >> self.drop).view(np.int64)

    def fits(self, n: int) -> np.ndarray:
        """Whether the ``n`` words from each word on lie in one piece."""
        m = max(len(self.start) - n + 1, 0)
        return self.piece[:m] == self.piece[n - 1:n - 1 + m]

    def groups(self, n: int, keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(key, first word, times) of the different phrases of ``n`` words at ``at``."""
        key = keys[at]
        order = np.argsort(key, kind="stable")
        new, differ = self._borders(n, key, at, order)
        if (differ & ~new).any():  # two phrases with one fingerprint: sort by the words too
            order = np.lexsort([self.number[at + j] for j in range(n - 1, -1, -1)] + [key])
            new, differ = self._borders(n, key, at, order)
        border = np.flatnonzero(np.concatenate([[True], new | differ])) if len(at) else np.empty(0, np.int64)
        times = np.diff(np.concatenate([border, [len(at)]]))
        lead = order[border]
        return key[lead], at[lead], times

    def _borders(self, n, key, at, order):
        sorted_keys = key[order]
        differ = np.zeros(max(len(at) - 1, 0), bool)
        for j in range(n):
            word = self.number[at[order] + j]
            differ |= word[1:] != word[:-1]
        return sorted_keys[1:] != sorted_keys[:-1], differ

    def phrases(self, first: np.ndarray, n: int, rows: int = 1 << 16) -> pa.Array:
        """The ``n`` words from each of ``first`` on, a blank between them."""
        return pa.concat_arrays([self._phrases(first[i:i + rows], n) for i in range(0, max(len(first), 1), rows)])

    def _phrases(self, first, n):
        word = (first[:, None] + np.arange(n)).ravel()
        size = self.end[word] - self.start[word] + 1  # with the blank after it
        stop = np.cumsum(size)
        text = self.data[(np.arange(size.sum()) + np.repeat(self.start[word] - stop + size, size)).clip(max=len(self.data) - 1)]
        text[stop - 1] = GAP
        text = np.delete(text, stop[n - 1::n] - 1)  # none after the last word
        ends = stop[n - 1::n] - np.arange(1, len(first) + 1)
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(text))


def seed_of(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "big")


GROUP_SCHEMA = pa.schema([("slice", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
FOUND_SCHEMA = pa.schema([("block", pa.int64()), ("keys", pa.binary())])
PHRASE_SCHEMA = pa.schema([("lang", pa.string()), ("phrases", pa.list_(pa.string())), ("times", pa.list_(pa.int64()))])
SUM_SCHEMA = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64())])


def _counted(number: int, keys: np.ndarray) -> list:
    """(key, pointer) of the different keys; a number of occurrences beyond TIMES bits is several rows."""
    key, times = np.unique(keys, return_counts=True)
    out, most = [], (1 << TIMES) - 1
    while len(key):
        out.append((key, number << TIMES | np.minimum(times, most)))
        key, times = key[times > most], times[times > most] - most
    return [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 2


def _binary(values: np.ndarray, stops: np.ndarray) -> pa.Array:
    """The values up to each stop as one binary value."""
    offsets = np.concatenate([[0], stops * values.itemsize]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(stops), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _values(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _packed(number: int, several: list[np.ndarray], slices: int) -> list:
    """Columns of GROUPS: the different keys of each array with their counts, a row a slice (a power of two of them)."""
    key, pointer = (np.concatenate(c) for c in zip(*(_counted(number, keys) for keys in several)))
    order, used, stops = _by_slice(key, slices)
    counts = (pointer[order] & ((1 << TIMES) - 1)).astype(np.int32)
    return [pa.array(used), pa.array(np.full(len(used), number)), _binary(key[order], stops), _binary(counts, stops)]


def _by_slice(key: np.ndarray, slices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order by slice, the slices with keys and where each of them ends."""
    of = (key & (slices - 1)).astype(np.uint16 if slices <= 1 << 16 else np.int64)  # short ones are sorted by radix
    order = np.argsort(of, kind="stable")
    stops = np.cumsum(np.bincount(of, minlength=slices))
    used = np.flatnonzero(np.diff(stops, prepend=0))
    return order, used, stops[used]


# --- Spark

def blocks(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """The folded texts in blocks of one language, written compressed, with their number of words."""
    schema = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("words", pa.int64()), ("data", pa.binary())])
    d = docs.select(F.coalesce(docs["lang"], F.lit("und")).alias("lang"), docs["text"].alias("text"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        made = 0

        def flush(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal made
            data = FOLD[np.frombuffer(b"\n".join(held.pop(lang)), np.uint8)]
            sizes.pop(lang)
            stops = np.flatnonzero(data == END)
            at = 0
            while at < len(data):  # a long text is cut between pieces
                i = int(np.searchsorted(stops, at + size, "right"))
                within = i > 0 and stops[i - 1] >= at and len(data) - at > size
                to = len(data) if len(data) - at <= size else int(stops[i - 1] + 1 if within else stops[i] + 1 if i < len(stops) else len(data))
                part = data[at:to]
                inside = (part != GAP) & (part != END)
                words = int(inside[:1].sum() + (inside[1:] & ~inside[:-1]).sum())
                if words:
                    number = TaskContext.get().partitionId() << 16 | made  # 39 bits are left
                    made += 1
                    yield pa.RecordBatch.from_pylist([{"block": number, "lang": lang, "words": words, "data":
                                                       zstandard.ZstdCompressor(level=3).compress(part.tobytes())}], schema=schema)
                at = to
        for b in batches:
            texts = b["text"].cast(pa.binary())
            for k, lang in enumerate(b["lang"].to_pylist()):
                text = texts[k].as_py()
                if not text:
                    continue
                held.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text) + 1
                if sizes[lang] >= size:
                    yield from flush(lang)
                elif sum(sizes.values()) >= 2 * size:  # many languages: bound them together
                    yield from flush(max(sizes, key=sizes.get))
        for lang in list(held):
            yield from flush(lang)
    return stored(d.mapInArrow(gather, BLOCKS), "blocks")


def opened(data: bytes, bits: int) -> Block:
    return Block(zstandard.ZstdDecompressor().decompress(data), bits)


def slices_of(held: DataFrame) -> int:
    """A power of two, the more the more words there are."""
    words = held.agg(F.sum("words")).first()[0] or 0
    return max(SLICES, 1 << (words // SLICE_WORDS).bit_length())


def short_groups(held: DataFrame, bits: int, slices: int) -> DataFrame:
    """GROUPS of every word and pair of every block."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                block, seed = opened(b["data"][i].as_py(), bits), seed_of(b["lang"][i].as_py())
                keys = [block.keys(n, seed)[block.fits(n)] for n in (1, 2)]
                yield pa.RecordBatch.from_arrays(_packed(b["block"][i].as_py(), keys, slices), schema=GROUP_SCHEMA)
    return held.mapInArrow(count, GROUPS)


def frequent(groups: DataFrame, least: int) -> DataFrame:
    """(block, keys): the fingerprints of each block that reach ``least`` occurrences in all."""
    def reach(rows: pa.Table) -> pa.Table:
        keys, counts = _values(rows["keys"], np.int64), _values(rows["counts"], np.int32)
        stops = np.cumsum(pc.binary_length(rows["keys"]).to_numpy() // 8)
        order = np.argsort(keys)
        border = np.flatnonzero(np.diff(keys[order], prepend=~keys[order[:1]]))
        total = np.add.reduceat(counts[order], border, dtype=np.int64)
        kept = np.empty(len(keys), bool)
        kept[order] = np.repeat(total >= least, np.diff(border, append=len(keys)))
        left = np.cumsum(kept)[stops - 1]
        used = np.flatnonzero(np.diff(left, prepend=0))
        return pa.table([rows["block"].combine_chunks().take(pa.array(used)), _binary(keys[kept], left[used])], schema=FOUND_SCHEMA)
    return groups.groupBy("slice").applyInArrow(reach, "block long, keys binary")


def phrases_at(held: DataFrame, found: DataFrame, bits: int, lengths: tuple, slices: int, longest: int = 0) -> DataFrame:
    """(lang, phrases, times) of the phrases of ``lengths`` words whose fingerprints
    ``found`` names in a block, a row a slice, and, up to ``longest`` words, the
    GROUPS of longer phrases all of whose pairs are among them; one kind of
    column is NULL in a row of the other."""
    schema = pa.schema(list(PHRASE_SCHEMA) + list(GROUP_SCHEMA))

    def read(block_rows: pa.Table, key_rows: pa.Table) -> pa.Table:
        out = []
        if block_rows.num_rows and key_rows.num_rows:
            lang, number = block_rows["lang"][0].as_py(), block_rows["block"][0].as_py()
            block, seed = opened(block_rows["data"][0].as_py(), bits), seed_of(lang)
            wanted = np.unique(_values(key_rows["keys"], np.int64))
            for n in lengths:
                keys = block.keys(n, seed)
                hit = np.flatnonzero(block.fits(n))
                hit = hit[wanted[np.searchsorted(wanted, keys[hit]).clip(max=len(wanted) - 1)] == keys[hit]]
                key, first, times = block.groups(n, keys, hit)
                order, used, stops = _by_slice(key, slices)
                at = pa.array(np.concatenate([[0], stops]), pa.int32())
                none = [pa.nulls(len(used), f.type) for f in list(GROUP_SCHEMA)[1:]]
                out.append(pa.table([pa.array([lang] * len(used), pa.string()), pa.ListArray.from_arrays(
                    at, block.phrases(first[order], n)), pa.ListArray.from_arrays(at, pa.array(times[order], pa.int64())),
                    pa.array(used), *none], schema=schema))
                if n == 2 and longest > 2:
                    pair = np.zeros(len(keys), bool)
                    pair[hit] = True
                    several = []
                    for m in range(3, longest + 1):
                        size = max(len(block.start) - m + 1, 0)
                        good = np.ones(size, bool)
                        for j in range(m - 1):
                            good &= pair[j:j + size]
                        several.append(block.keys(m, seed)[good])
                    packed = _packed(number, several, slices)
                    none = [pa.nulls(len(packed[0]), f.type) for f in PHRASE_SCHEMA]
                    out.append(pa.table([*none, *packed], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()
    return (held.select("block", "lang", "data").groupBy("block")
            .cogroup(found.groupBy("block")).applyInArrow(read, f"{PHRASES}, {GROUPS}"))


def summed(found: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, a) of the phrases that occur ``least`` times in all; a phrase is in one slice."""
    def total(rows: pa.Table) -> pa.Table:
        phrases, times = rows["phrases"].combine_chunks(), rows["times"].combine_chunks()
        each = pa.table([rows["lang"].combine_chunks().take(pc.list_parent_indices(phrases)), phrases.flatten(), times.flatten()], schema=SUM_SCHEMA)
        sums = each.group_by(["lang", "phrase"]).aggregate([("a", "sum")]).select(["lang", "phrase", "a_sum"])
        return sums.filter(pc.greater_equal(sums["a_sum"], least)).rename_columns(SUM_SCHEMA.names)
    return found.groupBy("slice").applyInArrow(total, "lang string, phrase string, a long")


def counted(docs: DataFrame, least: int = 30, longest: int = 4, bits: int = 64, size: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, a) of all phrases of up to ``longest`` words that
    occur ``least`` times or more in their language, and (lang, n) of all its words."""
    held = blocks(docs, size)
    slices = slices_of(held)
    short = stored(frequent(short_groups(held, bits, slices), least), "short")
    both = stored(phrases_at(held, short, bits, (1, 2), slices, longest), "phrases")
    long = stored(frequent(both.where(F.col("keys").isNotNull()).select("slice", "block", "keys", "counts"), least), "long")
    columns = ["lang", "slice", "phrases", "times"]
    found = both.where(F.col("phrases").isNotNull()).select(*columns).unionByName(
        phrases_at(held, long, bits, tuple(range(3, longest + 1)), slices).select(*columns))
    sums = summed(found, least)
    return (stored(sums.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("words"), "a"), "frequent"),
            stored(held.groupBy("lang").agg(F.sum("words").alias("n")), "totals"))


def part(words: Column, first: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, first, size), " ")


def scored(phrases: DataFrame, scale: int = 2_000_000) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of the phrases of two words or more, by the lowest cut."""
    several = phrases.where(F.col("words") > 1).withColumn("w", F.split("phrase", " "))
    cuts = several.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "words", "a", "k", part(F.col("w"), F.lit(1), F.col("k")).alias("first"),
        part(F.col("w"), F.col("k") + 1, F.col("words")).alias("rest"))
    first = phrases.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    rest = phrases.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    # the parts of a frequent phrase are frequent
    both = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).withColumn(
        "score", F.expr(f"cast({scale} as decimal(38,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + r)"))
    best = both.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    return best.select("lang", "phrase", "words", "a", "b.l", "b.r", "b.score")


def longest_cover(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, cover): the most occurrences of a longer phrase around it."""
    big = phrases.where(F.col("words") > 2).withColumn("w", F.split("phrase", " "))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: part(F.col("w"), i, m))))
    return (big.select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase")
            .agg(F.max("a").alias("cover")))


def mine(docs: DataFrame, least: int = 30, longest: int = 4, scale: int = 2_000_000, percent: int = 80, top: int = 2000,
         bits: int = 64, size: int = BLOCK) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each
    language, without those that a longer one with ``percent`` of their
    occurrences contains. ``bits`` is the width of all fingerprints."""
    phrases, totals = counted(docs, least, longest, bits, size)
    kept = scored(phrases, scale).join(longest_cover(phrases), ["lang", "phrase"], "left").where(
        F.col("cover").isNull() | (F.col("cover").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * percent))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    some = (kept.withColumn("salt", salt)
            .withColumn("rank", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top))
    best = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
