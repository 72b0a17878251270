"""Mined phrases against a brute-force version, with narrow fingerprints, small blocks and awkward rows."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL

from strata.llm import collocations as C
from strata.llm import hashing as H
from strata.llm.common import table

COLUMNS = "doc_id long, text string, lang string, phrase string, key long, block long, a long, n long, rank string, score double"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, lang, "x", 1, 2, 3, 4, "y", 0.5) for k, (t, lang) in enumerate(rows)], COLUMNS)


def low(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def brute(rows, least=30, top=2000):
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    f[lang, tuple(words[i:i + n])] += 1
    cands = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    rows = {}
    for (lang, w), a in cands.items():
        cover = max((b for (g, v), b in cands.items() if g == lang and len(v) > len(w)
                     and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1))), default=0)
        if 100 * cover >= 80 * a and cover:
            continue
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
        score, _, left, right = min(cuts)
        rows.setdefault(lang, []).append((" ".join(w), a, left, right, total[lang], score))
    out = []
    for lang, found in rows.items():
        found.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, k + 1, *r) for k, r in enumerate(found[:top])]
    return sorted(out)


def found(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def corpus(seed=1, size=250):
    rng = random.Random(seed)
    words = [rng.choice("abcdefghÄß") * rng.randint(1, 3) + rng.choice("xyz") for _ in range(25)]
    fixed = ["Old  King\tCole was", "merry old soul", "no end", "x " * 40]
    rows = []
    for _ in range(size):
        bits = []
        for _ in range(rng.randint(0, 25)):
            bits.append(rng.choice(fixed) if rng.random() < 0.2 else " ".join(rng.choice(words) for _ in range(rng.randint(1, 6))))
        rows.append((rng.choice([". ", "\n", "? ", " ", " ; ", "\x0b", "\x0c"]).join(bits), rng.choice(["en", "en", "en", "de", None])))
    return rows


ROWS = corpus() + [(None, "en"), ("", "de"), (" \t\n ", None), ("Same text here", "fr")] + [("Same text here", "fr")] * 40 + [
    ("a b c d " * 20_000, "long"), ("z" * 300_000 + " z", "long"), ("née\x85ici \U0001f600 née\x85ici \U0001f600. " * 50, "und")]


def test_against_brute_force(spark):
    want = brute(ROWS)
    assert {r[0] for r in want} >= {"en", "de", "und", "fr", "long"}
    assert found(C.mine(frame(spark, ROWS).repartition(3))) == want


@pytest.mark.parametrize("bits, size", [(5, 2_000), (12, 20_000)])
def test_fingerprints_that_collide(spark, bits, size):
    rows = corpus(2, 120) + [("tick tock. " * 2_000, "en")]
    assert found(C.mine(frame(spark, rows), bits=bits, size=size)) == brute(rows)


def test_best_phrases_and_ties(spark):
    rows = [(f"w{i % 90} v{i % 90}", "en") for i in range(90 * 30)]
    got = found(C.mine(frame(spark, rows), top=7))
    assert got == brute(rows, top=7) and len(got) == 7


def test_products_beyond_64_bits(spark):
    a, big = 4 * 10**17, 9 * 10**17
    rows = [("en", "p q", 2, a), ("en", "p", 1, big), ("en", "q", 1, big - 1)]
    got = C.scored(spark.createDataFrame(rows, "lang string, phrase string, words int, a long")).collect()
    assert [(r.score, r.l, r.r) for r in got] == [(2_000_000 * a // (2 * big - 1), big, big - 1)]


def test_lowest_cut_and_its_ties(spark):
    rows = [("en", "p q r", 3, 30), ("en", "p", 1, 100), ("en", "q r", 2, 40), ("en", "p q", 2, 60), ("en", "r", 1, 80), ("en", "q", 1, 100)]
    got = {r.phrase: (r.score, r.l, r.r) for r in C.scored(spark.createDataFrame(rows, "lang string, phrase string, words int, a long")).collect()}
    assert got["p q r"] == (2_000_000 * 30 // 140, 100, 40)


def test_polynomials_do_not_depend_on_the_place():
    block = C.Block(b"one two\none two three  one two")
    keys = block.keys(2, 5)
    assert keys[0] == keys[2] == keys[5] and len(set(keys.tolist())) == 4
    assert block.fits(2).tolist() == [True, False, True, True, True, True]
    values = np.arange(1, 6, dtype=np.uint64)
    whole = sum(int(v) * pow(H.INVERSE, i, 1 << 64) for i, v in enumerate(values[2:5])) % (1 << 64)
    assert int(H.polynomials(values, np.array([2]), np.array([5]))[0]) == whole


def test_a_count_beyond_its_bits_is_several_rows(monkeypatch):
    monkeypatch.setattr(C, "TIMES", 3)
    key, pointer = C._counted(5, np.array([9] * 20 + [4]))
    assert sorted(zip(key.tolist(), (pointer >> 3).tolist(), (pointer & 7).tolist())) == [(4, 5, 1), (9, 5, 6), (9, 5, 7), (9, 5, 7)]


def test_empty_table_and_given_documents(spark):
    docs = table(spark, SF_SMALL, "documents")
    assert C.mine(docs.limit(0)).count() == 0
    rows = [(r.text, r.lang) for r in docs.collect()]
    assert found(C.mine(docs)) == brute(rows)


def test_a_block_gives_a_row_a_slice(spark):
    held = C.blocks(frame(spark, ROWS).coalesce(1))
    groups = C.short_groups(held, 64, 8).collect()
    assert len({(r.slice, r.block) for r in groups}) == len(groups) <= 8 * held.count()
    sizes = [(len(r["keys"]) // 8, len(r["counts"]) // 4) for r in groups]
    assert all(a == b for a, b in sizes) and sum(a for a, _ in sizes) > 8 * held.count()
    short = C.stored(C.frequent(C.short_groups(held, 64, 8), 30), "short")
    both = C.phrases_at(held, short, 64, (1, 2), 8, 4).collect()
    assert max(Counter((r.lang, r.slice, r["keys"] is None) for r in both).values()) <= 2 * held.count()


def test_phrases_are_read_at_once():
    block = C.Block(C.FOLD[np.frombuffer("née  Zwei\tdrei\nx y zwölf".encode(), np.uint8)].tobytes())
    assert block.phrases(np.array([0, 1]), 2).to_pylist() == ["née zwei", "zwei drei"]
    assert block.phrases(np.array([5, 3, 0]), 1, rows=2).to_pylist() == ["zwölf", "x", "née"]
    assert block.phrases(np.array([3]), 3).to_pylist() == ["x y zwölf"]
    assert block.phrases(np.empty(0, np.int64), 2).to_pylist() == []
