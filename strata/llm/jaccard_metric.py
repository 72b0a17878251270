"""Exact n-gram Jaccard join in the metric space of shingle sets.

1 - J is a metric, so pivots cut the space into Voronoi regions and a link of
length ``eps`` can only lead from a region to documents within its
triangle-inequality window: if x lies nearest to pivot p and d(x, y) <= eps
then d(y, p) <= d(y, nearest pivot of y) + 2 eps. Such boundary documents are
replicated into the region, regions join recursively, and every pair within
eps meets in the region of either side. A ball of radius eps around a pivot is
one component by that alone, so copies by the thousand need one comparison
each and are never expanded into pairs.

Most documents are at distance 1 from any pivot that isn't a copy of them.
The coarsest level therefore takes single shingles as pivots, in one order of
all shingles (once-found ones first, then by the number of their texts): a
document lies in the windows of its first n - ceil(t n) + 1 shingles, and sets
with J >= t share one of those. Unrelated texts share single shingles as well,
the more of them the larger the table, so the pairs of a region of up to
``PAIRED`` documents are candidates only if their sizes and odd sketches allow a
link: a sketch is the parity of a set's shingles in each of its bits, and two
sets differ by at least as many shingles as their sketches by bits. The
connected groups of the candidates, and of whole regions that are larger, hold
all links. A group of up to ``limit``
shingles joins in one task around document pivots; a larger one is first cut
by Voronoi rounds in Spark, in salted blocks of bounded size. A region that
no round makes smaller is joined block by block.

Defined results: a set is the distinct ``width``-word shingles; with fewer
words, the whole sequence as one; without words, or text, empty and linked
with nothing. Rows with the same doc_id count as one document whose texts are
linked; each of its different texts is a node of its own. A NULL doc_id never names a component: such a row gets the smallest
doc_id it reaches, else NULL. Shingles are compared by 64-bit hashes. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored, texts
from strata.llm.hashing import runs, window_hashes, word_hashes

WIDTH = 5
NUMBER, OF = 75, 100  # the threshold as a fraction
LIMIT = 4_000_000  # shingles that a task joins at once
PIVOTS = 16  # of a region and round
HEAVY = 1 << 21  # at most so many frequent shingles are sent to all tasks (24 MB)
BITS = 28  # repeated shingles are marked in a bitmap of 2^BITS at most (32 MB); a fuller one takes more once-found ones for repeated
SENT = 1 << 18  # up to so many candidates are sent to the texts (12 MB), instead of dealing all texts out
BUCKET, SLOT = 10, 30  # shingles are counted by their first bits: those of a bucket, and of their slot in it
PACKED = 1 << 20  # shingles of a task that are packed at a time
PAIRED = 16  # up to so many documents of a shingle make pairs
READ = 1 << 20  # bytes of text whose shingles are made at a time

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


@np.errstate(over="ignore")
def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX[0]
    x = (x ^ (x >> np.uint64(29))) * _MIX[1]
    return x ^ (x >> np.uint64(32))


FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A"):ord("Z") + 1] += 32
BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True


def shingle_sets(texts: list[str], width: int = WIDTH) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles."""
    raw = [t.encode() for t in texts]
    out, at = [], 0
    while at < len(raw):  # texts of about READ bytes at a time
        to, size = at, 0
        while to < len(raw) and (to == at or size + len(raw[to]) <= READ):
            size += len(raw[to]) + 1
            to += 1
        out += _sets(raw[at:to], width)
        at = to
    return out


def _sets(raw: list[bytes], width: int) -> list[np.ndarray]:
    data = FOLD[np.frombuffer(b"\n".join(raw), np.uint8)]
    start, end = runs(~BLANK[data])
    words = word_hashes(data, start, end)
    border = np.searchsorted(start, np.cumsum([len(r) + 1 for r in raw]))  # each text's last word, exclusive
    windows = mix(window_hashes(words, width) + np.uint64(width))
    out, first = [], 0
    for last in border.tolist():
        n = last - first
        if n >= width:
            out.append(np.unique(windows[first:last - width + 1]))
        else:
            out.append(mix(window_hashes(words[first:last], n) + np.uint64(n)) if n else np.empty(0, np.uint64))
        first = last
    return out


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    return shingle_sets([text], width)[0]


def _slices(b: pa.RecordBatch, size: int = 512) -> Iterator[pa.RecordBatch]:
    for at in range(0, b.num_rows, size):
        yield b.slice(at, size)


def prefix_size(n: int, t: Fraction) -> int:
    return n - -(-n * t.numerator // t.denominator) + 1


class Sets:
    """The shingle sets of some documents, side by side."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        _, ids = np.unique(np.concatenate(sets), return_inverse=True)
        self.ids = ids.astype(np.int32)
        self.mark = np.zeros(int(ids.max()) + 1, bool)

    def of(self, x: int) -> np.ndarray:
        return self.ids[self.start[x]:self.start[x + 1]]

    def common(self, x: int, members: np.ndarray) -> np.ndarray:
        """Shingles that x shares with each member (none is empty)."""
        self.mark[self.of(x)] = True
        size = self.size[members]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(self.start[members] - ends + size, size)
        out = np.add.reduceat(self.mark[self.ids[at]].astype(np.int64), ends - size)
        self.mark[self.of(x)] = False
        return out


class Join:
    """Components of the sets within eps of each other, exactly."""

    def __init__(self, sets: Sets, t: Fraction, pivots: int = PIVOTS, direct: int = 32):
        self.sets, self.t, self.pivots, self.direct = sets, t, pivots, direct
        self.eps = 1 - float(t) + 1e-9  # of windows; links are compared in integers
        self.root = np.arange(len(sets.size))

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return int(x)

    def link(self, x: int, members: np.ndarray) -> np.ndarray:
        """Distances from x; what is within the threshold is united with it."""
        both = self.sets.common(x, members)
        union = self.sets.size[members] + self.sets.size[x] - both
        for y in members[both * self.t.denominator >= union * self.t.numerator]:
            a, b = self.find(x), self.find(int(y))
            self.root[max(a, b)] = min(a, b)
        return 1 - both / union

    def run(self, members: np.ndarray, home: np.ndarray) -> None:
        """Unite what is linked, over the pairs with a member that is at home."""
        while len(members) > self.direct and home.any():
            chosen = np.flatnonzero(home)
            chosen = chosen[np.unique(np.linspace(0, len(chosen) - 1, self.pivots).astype(int))]
            far = np.stack([self.link(int(members[p]), members) for p in chosen])
            nearest, least = far.argmin(0), far.min(0)
            shrunk = True
            parts = []
            for i in range(len(chosen)):
                window = far[i] <= least + 2 * self.eps
                own = home & (nearest == i)
                # members that the ball around the pivot has united need no pairs among them
                ball = far[i] <= self.eps - 2e-9
                rest = own & ~ball
                reach = window & (far[i] >= far[i][rest].min() - self.eps) if rest.any() else np.zeros(len(members), bool)
                outer = window & ~own & ~ball
                if outer.any():
                    lo = far[i][outer].min() - self.eps
                    reach |= own & (far[i] >= lo)
                keep = reach | rest | outer if (rest.any() or (own.any() and outer.any())) else np.zeros(len(members), bool)
                if keep.any():
                    shrunk &= keep.sum() <= 0.8 * len(members)
                    parts.append((members[keep], own[keep]))
            if not shrunk:
                break
            for part, own in parts[1:]:
                self.run(part, own)
            if not parts:
                return
            members, home = parts[0]
        self.by_rare(members, home)

    def by_rare(self, members: np.ndarray, home: np.ndarray) -> None:
        """The pairs of a region that no pivot divides: through their rarest
        shingles, each candidate compared unless it is united already."""
        if len(members) < 2 or not home.any():
            return
        every = np.concatenate([self.sets.of(x) for x in members])
        value, count = np.unique(every, return_counts=True)
        order = np.argsort(np.argsort(count, kind="stable"))
        seen: dict[int, list[int]] = {}
        by_size = sorted(zip(members.tolist(), home.tolist(), strict=True), key=lambda m: (self.sets.size[m[0]], m[0]))
        at_home = dict(by_size)
        for x, own in by_size:
            ids = self.sets.of(x)
            rank = order[np.searchsorted(value, ids)]
            first = ids[np.argsort(rank)[:prefix_size(len(ids), self.t)]]
            others: dict[int, int] = {}
            for s in first.tolist():
                held = seen.setdefault(s, [])
                for y in held:
                    others[y] = 1
                held.append(x)
            me = self.find(x)
            apart = [y for y in others if (own or at_home[y]) and self.sets.size[y] * self.t.denominator
                     >= len(ids) * self.t.numerator and self.find(y) != me]
            while apart:  # one link is enough to unite a whole component
                part, apart = apart[:64], apart[64:]
                self.link(x, np.array(part))
                me = self.find(x)
                apart = [y for y in apart if self.find(y) != me]

    def components(self) -> np.ndarray:
        everyone = np.arange(len(self.root))
        self.run(everyone, np.ones(len(everyone), bool))
        return np.array([self.find(x) for x in everyone])


def connected(edges: DataFrame, name: str) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges(a, b)`` reaches,
    by alternating large and small stars over written tables."""
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.col("b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            return e.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
        before = now
        both = e.union(e.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(
            low.select("a", F.col("m").alias("b"))).distinct()
        e = stored(small, name)


def sketch(s: np.ndarray) -> bytes:
    """Odd sketch of a set: as many bits as it has shingles or up to twice as
    many, each the parity of the shingles with these low bits."""
    m = max(64, 1 << (len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1, bitorder="little").tobytes()


def may_link(n: int, m: int, one: bytes, other: bytes, t: Fraction) -> bool:
    """Whether sets of these sizes and sketches can be within the threshold."""
    if min(n, m) * t.denominator < max(n, m) * t.numerator:
        return False
    if len(one) < len(other):
        one, other = other, one
    size, x = len(one) * 4, int.from_bytes(one, "little")
    while size >= len(other) * 8:  # the sketch of half the bits
        x = (x >> size) ^ (x & ((1 << size) - 1))
        size //= 2
    apart = (x ^ int.from_bytes(other, "little")).bit_count()
    return apart * (t.denominator + t.numerator) <= (n + m) * (t.denominator - t.numerator)


def _packed(sets: list[np.ndarray]) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(bucket, size, gaps, more) of the shingles of some texts: the gaps between their
    sorted slots, in three bytes or four each, and the place and number of
    those that several of the texts hold."""
    key, n = np.unique(np.concatenate(sets) >> np.uint64(64 - BUCKET - SLOT), return_counts=True)
    slot = (key & np.uint64((1 << SLOT) - 1)).astype(np.uint32)
    at = np.searchsorted(key, np.arange((1 << BUCKET) + 1, dtype=np.uint64) << np.uint64(SLOT)).tolist()
    for bucket, (i, j) in enumerate(zip(at, at[1:], strict=False)):
        if i < j:
            gaps = np.diff(slot[i:j], prepend=np.uint32(0)).astype("<u4")
            several = np.flatnonzero(n[i:j] > 1)
            yield (bucket, j - i, (gaps.view(np.uint8).reshape(-1, 4)[:, :3] if gaps.max() < 1 << 24 else gaps).tobytes(),
                   np.stack([several, n[i:j][several]]).astype("<u4").tobytes())


def _unpacked(size: int, gaps: bytes, more: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The slots, and those that several texts hold with their number."""
    raw = np.frombuffer(gaps, np.uint8).reshape(size, -1)
    wide = np.zeros((size, 4), np.uint8)
    wide[:, :raw.shape[1]] = raw
    slots = np.cumsum(wide.view("<u4")[:, 0], dtype=np.uint32)
    several, n = np.frombuffer(more, "<u4").reshape(2, -1)
    return slots, slots[several], n


def _read(docs: DataFrame, width: int) -> DataFrame:
    """Of one pass over the texts: a row (doc_id, node, n_shingles, sign, sketch)
    each, sign being equal for equal sets, and rows (bucket, size, gaps, more)
    of the packed shingles of many texts."""
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("n_shingles", pa.int64()), ("sign", pa.binary()),
                        ("sketch", pa.binary()), ("bucket", pa.int32()), ("size", pa.int64()), ("gaps", pa.binary()), ("more", pa.binary())])

    def batch(**own) -> pa.RecordBatch:
        made = {k: v if isinstance(v, pa.Array) else pa.array(v, schema.field(k).type) for k, v in own.items()}
        length = len(next(iter(made.values())))
        return pa.RecordBatch.from_arrays([made[f.name] if f.name in made else pa.nulls(length, f.type) for f in schema], schema=schema)

    def counts(sets: list[np.ndarray]) -> pa.RecordBatch:
        bucket, size, gaps, more = zip(*_packed(sets), strict=True)
        return batch(bucket=bucket, size=size, gaps=gaps, more=more)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in (part for whole in batches for part in _slices(whole)):
            sets = shingle_sets(b["text"].to_pylist(), width)
            yield batch(doc_id=b["doc_id"], node=b["node"], n_shingles=[len(s) for s in sets], sketch=[sketch(s) for s in sets], sign=[
                np.bitwise_xor.reduce(s).tobytes() + mix(s ^ _MIX[1]).sum(dtype=np.uint64).tobytes() for s in sets])
            for s in sets:
                held.append(s)
                n += len(s)
                if n >= PACKED:
                    yield counts(held)
                    held, n = [], 0
        if n:
            yield counts(held)
    return docs.mapInArrow(rows, "doc_id long, node long, n_shingles long, sign binary, sketch binary, bucket int, size long, gaps binary, more binary")


STEPS = [2, 3, 4, 6, *(1 << i for i in range(3, 32))]


def _counted(packed: DataFrame) -> DataFrame:
    """A row (bucket, slots, numbers, above) each: the repeated shingles with the
    number of their texts, and how many have at least so many texts as STEPS."""
    def count(group: pa.Table) -> pa.Table:
        parts = [_unpacked(*row) for row in zip(*(group[c].to_pylist() for c in ("size", "gaps", "more")), strict=True)]
        slot, n = np.unique(np.concatenate([p[0] for p in parts]), return_counts=True)
        for _, several, m in parts:
            n[np.searchsorted(slot, several)] += m.astype(np.int64) - 1
        slot, n = slot[n > 1], np.minimum(n[n > 1], (1 << 31) - 1)
        return pa.table({"bucket": group["bucket"][:1], "slots": [slot.astype("<u4").tobytes()], "numbers": [n.astype("<u4").tobytes()],
                         "above": pa.array([[int((n >= k).sum()) for k in STEPS]], pa.list_(pa.int64()))})
    return packed.groupBy("bucket").applyInArrow(count, "bucket int, slots binary, numbers binary, above array<long>")


def _frequent(counted: DataFrame, rare: int) -> tuple[np.ndarray, np.ndarray]:
    """The first bits of the shingles that at least ``rare`` texts hold, sorted, and their numbers."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for bucket, slots, numbers in zip(*(b[c].to_pylist() for c in ("bucket", "slots", "numbers")), strict=True):
                n = np.frombuffer(numbers, "<u4")
                key = np.frombuffer(slots, "<u4")[n >= rare].astype(np.int64) + (bucket << SLOT)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n[n >= rare].astype(np.int32))], names=["key", "n"])
    out = counted.select("bucket", "slots", "numbers").mapInArrow(rows, "key long, n int").toArrow()
    key, n = out["key"].to_numpy().view(np.uint64), out["n"].to_numpy()
    by = np.argsort(key)
    return key[by], n[by]


def _bitmap(counted: DataFrame, bits: int) -> np.ndarray:
    """The first ``bits`` bits of all repeated shingles, made bucket by bucket."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for slots in b["slots"].to_pylist():
                flags = np.zeros(1 << bits - BUCKET, bool)
                flags[np.frombuffer(slots, "<u4") >> np.uint32(BUCKET + SLOT - bits)] = True
                made.append(np.packbits(flags, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([b["bucket"], pa.array(made, pa.binary())], names=["bucket", "bits"])
    out = np.zeros((1 << BUCKET, 1 << bits - BUCKET - 3), np.uint8)
    part = counted.select("bucket", "slots").mapInArrow(rows, "bucket int, bits binary").toArrow()
    for bucket, made in zip(part["bucket"], part["bits"], strict=True):
        out[bucket.as_py()] = np.frombuffer(made.as_buffer(), np.uint8)
    return out.reshape(-1)


def _prefixes(docs: DataFrame, heavy, width: int, t: Fraction) -> DataFrame:
    """(shingle, node, prev) of the first shingles of every text, but those that the
    bitmap knows to occur nowhere else, prev being the one before in their order, or 0;
    equal texts that a task meets again are left out, their sets being linked by their sign."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, often, marks = heavy.value
        short = np.uint64(BUCKET + SLOT - (len(marks) * 8).bit_length() + 1)
        met: set[int] = set()
        for b in (part for whole in batches for part in _slices(whole)):
            found, nodes, prev = [], [], []
            for node, s in zip(b["node"].to_pylist(), shingle_sets(b["text"].to_pylist(), width), strict=True):
                if not len(s):
                    continue
                sign = hash((len(s), int(np.bitwise_xor.reduce(s)), int(s.sum(dtype=np.uint64))))
                if sign in met:
                    continue
                if len(met) < 200_000:
                    met.add(sign)
                k = prefix_size(len(s), t)
                key = s >> np.uint64(64 - BUCKET - SLOT)
                at = key >> short
                group = (marks[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(np.int64) * 2
                if len(known):
                    i = np.minimum(np.searchsorted(known, key), len(known) - 1)
                    group = np.where(known[i] == key, 2 + often[i].astype(np.int64), group)
                chosen = np.lexsort((s, group))[:k]
                first = s[chosen[group[chosen] != 0]]  # the first kind is this text's alone
                if len(first):
                    found.append(first)
                    nodes.append(np.full(len(first), node, np.int64))
                    prev.append(np.concatenate([np.zeros(1, np.uint64), first[:-1]]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(nodes)),
                                                  pa.array(np.concatenate(prev).view(np.int64))], names=["shingle", "node", "prev"])
    return docs.mapInArrow(rows, "shingle long, node long, prev long")


class Pairs:
    """Pairs of the nodes of each shingle, as rows sorted by it come by."""

    def __init__(self, most: int = PAIRED):
        self.most = most
        self.rest = [np.empty(0, np.int64)] * 3
        self.hot = False  # whether the first of the rest is the centre of a larger region

    def take(self, shingle: np.ndarray, node: np.ndarray, prev: np.ndarray, last: bool = False) -> tuple[np.ndarray, ...]:
        """(a, b, whole) of the shingles that are complete: all pairs of up to
        ``most`` nodes, but those that the shingle before in the order of both
        has given already; of a larger region each node and its centre, ``whole``."""
        shingle, node, prev = (np.concatenate(x) for x in zip(self.rest, (shingle, node, prev), strict=True))
        none = np.empty(0, np.int64)
        if not len(shingle):
            return none, none, none.astype(bool)
        start = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]]))
        size = np.diff(np.append(start, len(shingle)))
        whole = size > self.most
        whole[0] |= self.hot
        if last:
            self.rest, self.hot, n = [none] * 3, False, len(shingle)
        elif whole[-1]:  # goes on with its centre
            self.rest, self.hot, n = [x[start[-1]:start[-1] + 1] for x in (shingle, node, prev)], True, len(shingle)
        else:
            self.rest, self.hot, n = [x[start[-1]:] for x in (shingle, node, prev)], False, start[-1]
        run = np.repeat(np.arange(len(start)), size)[:n]
        at = np.flatnonzero(whole[run])
        a, b = [node[at]], [node[start[run[at]]]]
        left = np.flatnonzero(~whole[run])
        for gap in range(1, min(self.most, len(left))):
            i, j = left[:-gap], left[gap:]
            same = run[i] == run[j]
            if not same.any():
                break
            i, j = i[same], j[same]
            new = (prev[i] != prev[j]) | (prev[i] == 0)
            a.append(node[i[new]])
            b.append(node[j[new]])
        first = len(a[0])
        a, b = np.concatenate(a), np.concatenate(b)
        whole = np.arange(len(a)) < first
        return np.minimum(a, b)[a != b], np.maximum(a, b)[a != b], whole[a != b]


def _pairs(prefixes: DataFrame) -> DataFrame:
    """(a, b, whole) of the nodes that share a shingle."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, held = Pairs(), []

        def made(last: bool) -> pa.RecordBatch:
            out = work.take(*(np.concatenate([np.empty(0, np.int64), *(b[c].to_numpy() for b in held)]) for c in ("shingle", "node", "prev")), last)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["a", "b", "whole"])
        n = 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= 1 << 17:
                yield made(False)
                n = 0
        yield made(True)
    return (prefixes.repartition("shingle").sortWithinPartitions("shingle").mapInArrow(rows, "a long, b long, whole boolean")
            .groupBy("a", "b").agg(F.max("whole").alias("whole")))


def _near(pairs: DataFrame, equal: DataFrame, t: Fraction) -> DataFrame:
    """(a, b) of the pairs that may be linked, or belong to a region as a whole,
    each node by the first one of an equal set."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [whole or may_link(*x, t) for whole, *x in zip(*(b[c].to_pylist() for c in ("whole", "na", "nb", "sa", "sb")), strict=True)]
            yield pa.RecordBatch.from_arrays([b["fa"], b["fb"]], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    of = {x: equal.select(F.col("node").alias(x), F.col("first").alias(f"f{x}"), F.col("n_shingles").alias(f"n{x}"),
                          F.col("sketch").alias(f"s{x}")) for x in "ab"}
    return pairs.join(of["a"], "a").join(of["b"], "b").mapInArrow(rows, "a long, b long")


def _joined(grouped: DataFrame, width: int, t: Fraction) -> DataFrame:
    """(a, b) links that connect what is linked, of (region, node, home, text)
    rows: each region joins in one task, as its rows come by."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bool, str]] = []
        region = None
        out = [[], []]

        def join() -> None:
            if len(held) > 1:
                sets = shingle_sets([text for _, _, text in held], width)
                work = Join(Sets(sets), t)
                everyone = np.arange(len(sets))
                work.run(everyone, np.array([home for _, home, _ in held]))
                for x in everyone:
                    if (r := work.find(int(x))) != x:
                        out[0].append(held[x][0])
                        out[1].append(held[r][0])
            held.clear()

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], names=["a", "b"])
            out[0].clear()
            out[1].clear()
            return made
        for b in batches:
            for row in zip(*(b[c].to_pylist() for c in ("region", "node", "home", "text")), strict=True):
                if row[0] != region:
                    join()
                    region = row[0]
                held.append(row[1:])
            if len(out[0]) > 10_000:
                yield batch()
        join()
        yield batch()
    return (grouped.select("region", "node", "home", "text").repartition("region").sortWithinPartitions("region", "node")
            .mapInArrow(rows, "a long, b long"))


def _round(part: DataFrame, width: int, t: Fraction, pivots: int, limit: int) -> DataFrame:
    """A Voronoi round over (region, node, home, n_shingles, text): rows
    (region, pivot, node, d, own, n_shingles) of every region that the node
    belongs to, as at home or within its window."""
    sizes = part.groupBy("region").agg(F.sum("n_shingles").alias("all"))
    rank = F.xxhash64("node", "region")
    # the home document of the smallest hash in each slot of hashes
    best = (part.where("home").withColumn("r", rank).withColumn("slot", F.pmod("r", F.lit(pivots)))
            .groupBy("region", "slot").agg(F.min_by("node", "r").alias("node")))
    parts = F.ceil(F.col("all") / limit).cast("int")
    centres = (best.join(part.select("region", "node", "text"), ["region", "node"]).join(sizes, "region")
               .select(F.col("region").alias("of"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "node", "text"))
    salted = part.join(sizes, "region").withColumn("salt", F.pmod(F.xxhash64("node"), parts).cast("int"))

    def distances(docs: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        eps, out = 1 - float(t) + 1e-9, []
        if not len(docs) or not len(pivots):
            return pd.DataFrame({"region": [], "pivot": [], "node": [], "d": [], "own": [], "n_shingles": []})
        sets = Sets(shingle_sets([*pivots["text"], *docs["text"]], width))
        members = np.arange(len(pivots), len(sets.size))
        far = []
        for p in range(len(pivots)):
            both = sets.common(p, members)
            far.append(1 - both / (sets.size[members] + sets.size[p] - both))
        far = np.stack(far)
        least = far.min(0)
        # ties go to the pivot of the smallest id, in every block alike
        order = np.argsort(pivots["node"].to_numpy())
        nearest = order[far[order].argmin(0)]
        for p, node in enumerate(pivots["node"]):
            keep = far[p] <= least + 2 * eps
            out.append(pd.DataFrame({"region": docs["region"].iloc[0], "pivot": node, "node": docs["node"].to_numpy()[keep],
                                     "d": far[p][keep], "own": (nearest == p)[keep] & docs["home"].to_numpy()[keep],
                                     "n_shingles": docs["n_shingles"].to_numpy()[keep]}))
        return pd.concat(out)
    return salted.groupBy("region", "salt").cogroup(centres.groupBy("of", "part")).applyInPandas(
        distances, "region long, pivot long, node long, d double, own boolean, n_shingles long")


def _large(members: DataFrame, docs: DataFrame, width: int, t: Fraction, limit: int, pivots: int) -> list[DataFrame]:
    """Links (a, b) within regions of (region, node, home, n_shingles) beyond
    the limit: Voronoi rounds until regions fit a task; those that a round
    leaves as large as they were are joined block by block."""
    links, members = [], stored(members, "regions")
    while members.limit(1).count():
        part = members.join(docs, "node")
        made = stored(_round(part, width, t, pivots, limit), "round")
        eps = 1 - float(t)
        links.append(made.where(F.col("d") <= eps - 1e-9).select(F.col("node").alias("a"), F.col("pivot").alias("b")))
        old = members.groupBy("region").agg(F.sum("n_shingles").alias("old"))
        # what the ball unites needs no pairs among itself: it stays only while others are near
        kept = made.withColumn("ball", F.col("d") <= eps - 1e-9)
        some = kept.groupBy("region", "pivot").agg(F.min(F.when(~F.col("ball"), F.col("d"))).alias("near"),
                                                   F.max("own").alias("any_own"))
        kept = (kept.join(some.where("near IS NOT NULL AND any_own"), ["region", "pivot"])
                .where(F.col("d") >= F.col("near") - eps - 1e-9))
        size = stored(kept.groupBy("region", "pivot").agg(F.sum("n_shingles").alias("size")).join(old, "region"), "sizes")
        # of a region with several parts about as large as it is, all in all larger, the region itself is joined, once
        whole = stored(size.where((F.col("size") > limit) & (F.col("size") > 0.8 * F.col("old"))).groupBy("region")
                       .agg(F.sum("size").alias("size"), F.max("old").alias("old")).where("size > old").select("region", "old"), "whole")
        kept = kept.join(whole, "region", "left_anti")
        kept = kept.drop("near", "any_own").join(size, ["region", "pivot"]).select(
            F.xxhash64("region", "pivot").alias("region"), "node", F.col("own").alias("home"), "n_shingles", "size", "old")
        kept = stored(kept, "regions")
        links.append(_joined(kept.where(F.col("size") <= limit).join(docs, "node"), width, t))
        stuck = kept.where((F.col("size") > limit) & (F.col("size") > 0.8 * F.col("old"))).select("region", "node", "home", "size")
        stuck = stuck.union(members.join(whole, "region").select("region", "node", "home", F.col("old").alias("size")))
        # block by block: every pair of blocks of half the limit is a region
        n = F.ceil(2 * F.col("size") / limit).cast("int")
        block = F.pmod(F.xxhash64("node"), n).cast("int")
        pairs = (stuck.withColumn("n", n).withColumn("block", block)
                 .select("region", "node", "home", "block", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
                 .select(F.xxhash64("region", F.least("block", "other"), F.greatest("block", "other")).alias("region"), "node", "home"))
        links.append(_joined(pairs.join(docs, "node"), width, t))
        members = stored(kept.where((F.col("size") > limit) & (F.col("size") <= 0.8 * F.col("old")))
                         .select("region", "node", "home", "n_shingles"), "regions")
    return links


def components(docs: DataFrame, width: int = WIDTH, threshold: tuple[int, int] = (NUMBER, OF), limit: int = LIMIT,
               pivots: int = PIVOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per row of ``docs``."""
    spark, t = docs.sparkSession, Fraction(*threshold)
    d = texts(docs, id_col, text_col)
    # a row without an id, or of an id with several texts, stands for its text
    several = stored(d.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(F.xxhash64("text")).alias("low"), F.max(F.xxhash64("text")).alias("high")).where("low <> high").select("doc_id"), "several")
    own = F.xxhash64("doc_id", "text").bitwiseOR(F.lit(-(1 << 63)))
    repeated = not several.isEmpty()
    if repeated:
        d = d.join(several.withColumn("several", F.lit(True)), "doc_id", "left").select(
            "doc_id", "text", F.when(F.col("doc_id").isNull() | F.col("several"), own).otherwise(F.col("doc_id")).alias("node"))
    else:
        d = d.withColumn("node", F.coalesce("doc_id", own))
    read = stored(_read(d, width), "sets")
    meta = read.where("bucket IS NULL").drop("bucket", "size", "gaps", "more")
    counted = stored(_counted(read.where("bucket IS NOT NULL").select("bucket", "size", "gaps", "more")), "shingles")
    # the least number of texts that no more than HEAVY shingles have
    above = np.sum([np.zeros(len(STEPS), np.int64), *(r.above for r in counted.select("above").collect())], axis=0)
    rare = next((k for k, n in zip(STEPS, above.tolist(), strict=True) if n <= HEAVY), STEPS[-1])
    bits = min(BITS, max(BUCKET + 6, int(16 * above[0]).bit_length()))
    heavy = spark.sparkContext.broadcast((*_frequent(counted, rare), _bitmap(counted, bits)))
    pairs = _pairs(_prefixes(d, heavy, width, t))

    full = meta.where("n_shingles > 0")
    first = full.groupBy("n_shingles", "sign").agg(F.min("node").alias("first"))
    equal = stored(full.dropDuplicates(["node"]).join(first, ["n_shingles", "sign"]).select("node", "first", "n_shingles", "sketch"), "equal")
    copies = equal.where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    # groups of candidates among the first texts of each set
    near = _near(pairs, equal, t)
    groups = stored(connected(near, "near"), "groups")
    members = groups.select("node", F.col("root").alias("region")).union(
        groups.select(F.col("root").alias("node"), F.col("root").alias("region")).distinct())
    members = members.join(equal.select("node", "n_shingles"), "node")
    sizes = members.groupBy("region").agg(F.sum("n_shingles").alias("size"))
    # the texts of the candidates, once, are all that is dealt from here on
    members = stored(members.join(sizes, "region").withColumn("home", F.lit(True)), "members")
    few = F.broadcast(members) if members.count() <= SENT else members
    members = stored(d.select("node", "text").join(few, "node"), "texts")
    one = members.select("node", "text")
    links = [copies, _joined(members.where(F.col("size") <= limit), width, t)]
    links += _large(members.where(F.col("size") > limit).select("region", "node", "home", "n_shingles"), one, width, t, limit, pivots)
    if repeated:  # the texts of one id are linked
        same = full.join(several, "doc_id").select("doc_id", "node")
        links.append(same.join(same.groupBy("doc_id").agg(F.min("node").alias("first")), "doc_id")
                     .where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")))
    every = links[0]
    for part in links[1:]:
        every = every.union(part)
    roots = connected(every, "links")
    named = meta.select("doc_id", "node", "n_shingles").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "root").select("doc_id", "n_shingles", "component_id")
