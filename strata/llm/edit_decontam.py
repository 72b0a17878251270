"""Benchmark decontamination by pigeonhole edit matching.

Each test item gets an error budget k, a percentage of its length, and is cut
into k + 1 pieces. A passage with at most k edits must hold one piece exactly,
so exact piece hits (an Aho-Corasick automaton over the text) are all the
places to look at; around each, Myers' bit-parallel algorithm finds the least
edit distance of the item to any part of the text. Hits of an item on nearby
diagonals share one verification.

Texts are compared in lower case with each run of white space as one blank,
and places are given in that form. The items go to the tasks in blocks of at
most ``BLOCK`` characters, one scan of the texts per block: a test set of any
size fits, and usually is one block.

Defined results: a NULL or empty text, or item, matches nothing; one row per
(document row, item) with the least distance, the earliest place at ties;
repeated rows and items with the same text each give their rows; an empty table
gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import texts

PERCENT = 6  # edits allowed per 100 characters of an item
BLOCK = 500_000  # characters of items in one automaton
HITS = "doc_id long, item_id long, edits int, start int, end int"


def normal(text: str) -> str:
    return re.sub(r"\s+", " ", text.lower()).strip()


def budget(length: int, percent: int = PERCENT) -> int:
    return length * percent // 100


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of nearly equal length with their offsets."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def myers(item: str, text: str, peq: dict[str, int]) -> tuple[int, int]:
    """(distance, end) of the part of ``text`` nearest to ``item``, the first
    end at ties; ``peq`` holds the item's positions of each character."""
    m = len(item)
    mask, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, now = mask, 0, m
    best, end = m, 0
    for at, char in enumerate(text, 1):
        eq = peq.get(char, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | ~(xh | plus) & mask
        mh = plus & xh
        if ph & high:
            now += 1
        if mh & high:
            now -= 1
        if now < best:
            best, end = now, at
        ph, mh = ph << 1 & mask, mh << 1 & mask
        plus = mh | ~(xv | ph) & mask
        minus = ph & xv
    return best, end


def positions(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, char in enumerate(item):
        out[char] = out.get(char, 0) | 1 << i
    return out


class Matcher:
    """Finds all items of a block in a text."""

    def __init__(self, items: list[tuple[int, str]], percent: int = PERCENT):
        import ahocorasick

        self.items = [(i, n, budget(len(n), percent)) for i, t in items if (n := normal(t or ""))]
        self.tree = ahocorasick.Automaton()
        found: dict[str, list[tuple[int, int]]] = {}
        for number, (_, item, k) in enumerate(self.items):
            for offset, piece in pieces(item, k):
                found.setdefault(piece, []).append((number, offset))
        for piece, where in found.items():
            self.tree.add_word(piece, (len(piece), where))
        if found:
            self.tree.make_automaton()
        self.peq: dict[int, tuple[dict, dict]] = {}

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, edits, start, end) of the best place of every item found."""
        text, out, hits = normal(text), [], {}
        if not self.items or not text:
            return out
        for last, (size, where) in self.tree.iter(text):
            for number, offset in where:
                hits.setdefault(number, set()).add(last + 1 - size - offset)
        for number, places in hits.items():
            item_id, item, k = self.items[number]
            best = None
            ordered = sorted(places)
            while ordered:
                near = 1  # diagonals so close that their windows overlap are searched at once
                while near < len(ordered) and ordered[near] - ordered[near - 1] <= 2 * k:
                    near += 1
                low, high = max(ordered[0] - k, 0), ordered[near - 1] + len(item) + k
                ordered = ordered[near:]
                if number not in self.peq:
                    self.peq[number] = positions(item), positions(item[::-1])
                edits, end = myers(item, text[low:high], self.peq[number][0])
                if edits <= k and (best is None or edits < best[0]):
                    back, size = myers(item[::-1], text[max(low + end - len(item) - k, 0):low + end][::-1], self.peq[number][1])
                    best = edits, low + end - size, low + end
            if best:
                out.append((item_id, *best))
        return out


def matches(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, block: int = BLOCK, id_col: str = "doc_id",
            text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, edits, start, end): every item found in every text."""
    spark, d = docs.sparkSession, texts(docs, id_col, text_col)
    items = benchmark.select(benchmark[item_col].alias("item_id"), benchmark[item_text].alias("text")).where("length(text) > 0")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    number = max(1, -(-2 * size // block))
    out = None
    for k in range(number):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == k)
        held = spark.sparkContext.broadcast([(r["item_id"], r["text"]) for r in own.collect()])

        def search(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(held.value, percent)
            for b in batches:
                rows = [(i, *hit) for i, t in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True)
                        for hit in matcher.find(t)]
                columns = list(zip(*rows)) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()))],
                    names=["doc_id", "item_id", "edits", "start", "end"])
        part = d.mapInArrow(search, HITS)
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, block: int = BLOCK, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, whose text holds no item."""
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text").where("length(text) > 0")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    number = max(1, -(-2 * size // block))
    for k in range(number):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == k)
        held = spark.sparkContext.broadcast([(r["item_id"], r["text"]) for r in own.collect()])

        def search(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(held.value, percent)
            for b in batches:
                free = [t is None or not matcher.find(t) for t in b[text_col].to_pylist()]
                yield b.filter(pa.array(free, pa.bool_()))
        docs = docs.mapInArrow(search, docs.schema)
    return docs
