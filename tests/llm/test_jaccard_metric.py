"""The candidates of the Jaccard join: counted shingles, sketches and pairs."""

from __future__ import annotations

import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

import corpus_pipeline
from strata.llm import jaccard_metric as jm


def hashes(rng: random.Random, n: int) -> np.ndarray:
    return np.unique(np.array([rng.getrandbits(64) for _ in range(n)], np.uint64))


PASSAGES = [" ".join(f"p{i}w{k}" for k in range(14)) for i in range(62)]
CHAIN = [(i, " ".join(PASSAGES[i:i + 3])) for i in range(60)]  # each shares two of three passages with the next one


@pytest.fixture
def dealt(monkeypatch) -> dict[str, int]:
    """How many rows each written table of the join has had."""
    rows, stored = {}, jm.stored

    def seen(df, name, **options):
        out = stored(df, name, **options)
        rows[name] = out.count()
        return out
    monkeypatch.setattr(jm, "stored", seen)
    return rows


def test_texts_that_only_share_passages_are_no_candidates(spark, dealt):
    rows = CHAIN + [(100, CHAIN[7][1] + " more"), (101, CHAIN[50][1] + " and more")]
    got = jm.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i for i in range(60)} | {100: 7, 101: 50}
    assert dealt["texts"] < 12  # and not the whole chain


def test_the_pipeline_deals_no_texts_that_only_share_passages(spark, dealt):
    rows = [(i, text, "s", "en") for i, text in [*CHAIN, (100, CHAIN[7][1] + " more"), (None, CHAIN[9][1])]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(kept.collect(), key=str) == sorted((r for r in docs.collect() if r.doc_id != 100), key=str)
    assert dealt["texts"] < 12


def test_components_do_not_depend_on_how_full_the_bitmap_is(spark, monkeypatch):
    rng, rows = random.Random(3), []
    words = [f"w{k}" for k in range(60)]
    for _ in range(40):
        base = rng.choices(words, k=rng.randint(20, 60))
        rows += [(len(rows) + k, " ".join(rng.choice(words) if rng.random() < 0.02 else w for w in base)) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(jm.components(docs).collect())
    monkeypatch.setattr(jm, "HEAVY", 3)
    monkeypatch.setattr(jm, "BITS", 13)
    assert sorted(jm.components(docs).collect()) == want


def test_packed_shingles_are_counted(spark):
    rng = random.Random(5)
    sets = [hashes(rng, 3000), hashes(rng, 5), np.empty(0, np.uint64)]
    sets += [np.sort(np.concatenate([sets[0][:700], hashes(rng, 40)])), sets[1]]
    want = Counter(int(x) >> 64 - jm.BUCKET - jm.SLOT for s in sets for x in s)
    rows = [(*r[:2], bytearray(r[2]), bytearray(r[3])) for part in (sets[:2], sets[2:], sets) for r in jm._packed(part)]
    got = {}
    for r in jm._counted(spark.createDataFrame(rows, "bucket int, size long, gaps binary, more binary")).collect():
        slots, numbers = np.frombuffer(r.slots, "<u4"), np.frombuffer(r.numbers, "<u4")
        got |= {(r.bucket << jm.SLOT) + int(s): int(n) for s, n in zip(slots, numbers, strict=True)}
        assert list(r.above) == [int((numbers >= k).sum()) for k in jm.STEPS]
    assert got == {k: 2 * n for k, n in want.items()}


@pytest.mark.parametrize("t", [Fraction(3, 4), Fraction(2, 5)])
def test_sketches_never_reject_a_link(t):
    rng, rejected = random.Random(7), 0
    for _ in range(400):
        a = hashes(rng, rng.randint(1, 300))
        b = np.unique(np.concatenate([a[:rng.randint(0, len(a))], hashes(rng, rng.randint(1, 120))]))
        both = len(np.intersect1d(a, b))
        linked = both * t.denominator >= len(np.union1d(a, b)) * t.numerator
        may = jm.may_link(len(a), len(b), jm.sketch(a), jm.sketch(b), t)
        assert may == jm.may_link(len(b), len(a), jm.sketch(b), jm.sketch(a), t) and (may or not linked)
        rejected += not may
    assert rejected > 50


def test_pairs_cover_all_that_share_a_shingle():
    rng = random.Random(11)
    of = {node: sorted(rng.sample(range(1, 60), rng.randint(1, 9))) for node in range(80)}
    rows = sorted((s, node, prev) for node, x in of.items() for prev, s in zip([0, *x], x, strict=False))
    for most in (2, 5, 100):
        work, a, b, whole, at = jm.Pairs(most), [], [], [], 0
        while at <= len(rows):  # in parts of any size
            n = rng.choice([0, 1, 3, 40])
            part = np.array(rows[at:at + n], np.int64).reshape(-1, 3)
            for out, x in zip((a, b, whole), work.take(*part.T), strict=True):
                out += x.tolist()
            at += n or 1 if at >= len(rows) else n
        for out, x in zip((a, b, whole), work.take(*np.empty((3, 0), np.int64), last=True), strict=True):
            out += x.tolist()
        pairs = {(x, y) for x, y, w in zip(a, b, whole, strict=True) if not w}
        stars = {(x, y) for x, y, w in zip(a, b, whole, strict=True) if w}
        held = Counter(s for x in of.values() for s in x)
        root = {x: x for x in of}

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x
        for x, y in stars:
            root[find(x)] = find(y)
        for x in of:
            for y in range(x):
                shared = set(of[x]) & set(of[y])
                assert not shared or (y, x) in pairs or find(x) == find(y)
                assert shared or (y, x) not in pairs | stars
        assert most < 100 or not stars
        assert all(x == y or find(x) == find(y) for s, n in held.items() if n > most
                   for x in of if s in of[x] for y in of if s in of[y])
