"""The Merkle manifest against a brute-force version, at sizes around its blocks, and on awkward tables."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from conftest import SF_SMALL

from strata.llm import merkle_levels as M
from strata.llm.common import table

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, pos long, tree string, item string, n long"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def low(text):
    return None if text is None else "".join(c.lower() if c.isascii() else c for c in text)


def leaf(doc_id, source, lang, n_chars, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climb(nodes):
    """(root, per node its list of (left, right))."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, p in enumerate(at):
            start = p - p % 16
            paths[i].append(("".join(level[start:p]), "".join(level[p + 1:start + 16])))
            at[i] = p // 16
        level = [h("".join(level[k:k + 16])) for k in range(0, len(level), 16)]
    return level[0], paths


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    subs, inner = [], {}
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        top, paths = climb([leaf(*r) for r in by[s]])
        subs.append(top)
        inner[s] = paths
    root, outer = climb(subs)
    out = []
    for s, sub, tail in zip(order, subs, outer):
        for r, path in zip(by[s], inner[s]):
            path = path + tail
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            cur = leaf(*r[:4], low(r[4])) if hit else leaf(*r)
            for left, right in path:
                cur = h(left + cur + right)
            out.append((r[0], leaf(*r), sub, root, h("".join(a + b for a, b in path)), cur, cur == root))
    return sorted(out, key=repr)


def found(df):
    cols = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, n, 3, "x", "y", 9) for i, s, lang, n, t in rows], COLUMNS)


def test_sizes_around_runs_and_blocks(spark):
    rows, k = [], 0
    for source, size in (("a", 1), ("b", 15), ("c", 16), ("d", 17), ("e", 256), ("f", 257), ("g", 4096), ("h", 4097), (None, 4113), ("é", 2)):
        for _ in range(size):
            k += 1
            rows.append((k * 7919 % 100_003, source, "en", k, f"Text {k} Ä"))
    want = brute(rows)
    assert found(M.verify(frame(spark, rows))) == want
    assert {v for *_, v in want} == {True, False}


def test_more_sources_than_a_run(spark):
    rows = [(i, f"s{i % 40}", None, None, None) for i in range(300)]
    got = found(M.verify(frame(spark, rows)))
    assert got == brute(rows) and all(r[-1] for r in got)


def test_awkward_rows(spark):
    rows = [(1, "s", "en", 0, ""), (2, None, None, None, None), (None, "s", "de", 5, "Ab"), (None, None, "de", 5, "AB"),
            (3, "s", "fr", 2, "Same"), (3, "s", "fr", 2, "Same"), (3, "s", "fr", 2, "Other"), (10, "", "en", 9, "W" * 500_000),
            (-4, "\U0001f600", "x", -1, "é\x00Z\n")]
    got = found(M.verify(frame(spark, rows)))
    assert got == brute(rows) and len(got) == len(rows)
    one = [(7, "only", "en", 1, "A")]
    assert found(M.verify(frame(spark, one))) == brute(one)
    assert M.verify(frame(spark, rows).limit(0)).count() == 0


def test_recursion_over_many_layers(spark, monkeypatch):
    monkeypatch.setattr(M, "FAN", 2)
    monkeypatch.setattr(M, "RUN", 2 * M.DIGEST)
    monkeypatch.setattr(M, "SPAN", 8)
    nodes = [f"{i:064x}" for i in range(601)]
    leaves = spark.createDataFrame([("s", i, x, (i,)) for i, x in enumerate(nodes)],
                                   "source string, order long, leaf string, item struct<doc_id:long>")
    got = M.manifest(leaves).collect()
    level = list(nodes)
    while len(level) > 1:
        level = [h("".join(level[k:k + 2])) for k in range(0, len(level), 2)]
    assert len(got) == 601 and {r.root for r in got} == {level[0]}
    for r in got:
        cur = r.leaf
        for s in r.segments:
            cur = h(s.left + cur + s.right)
        assert cur == level[0]


@pytest.mark.parametrize("column", ["text", "lang", "source", "n_chars"])
def test_any_change_moves_the_root(spark, column):
    docs = table(spark, SF_SMALL, "documents")
    base = M.verify(docs).first().root
    other = docs.selectExpr(*(c if c != column else f"CASE WHEN doc_id = 5 THEN NULL ELSE {c} END AS {c}" for c in docs.columns))
    assert M.verify(other).first().root != base
