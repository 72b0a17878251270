"""The mixture against a brute-force version, a reshared target, hot and awkward sources."""

from __future__ import annotations

import hashlib
import re
from fractions import Fraction

from conftest import SF_SMALL

from strata.llm import hash_mixture as M
from strata.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, source string, text string, size string, key string, target string, bucket long, weight long"


def frame(spark, rows):
    return spark.createDataFrame([(i, s, t, "x", "y", "z", 3, 4) for i, s, t in rows], COLUMNS)


def goals(sizes):
    """Targets by repeated resharing, in fractions."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in stopped)
        free = sum(weight[s] for s in sizes if s not in stopped)
        share = {s: Fraction(left * weight[s], free) for s in sizes if s not in stopped}
        above = {s for s in share if share[s] > 3 * sizes[s]}
        if not above:
            return {s: share.get(s, Fraction(3 * sizes[s])) for s in sizes}
        stopped |= above


def brute(rows):
    full = []
    for i, s, t in rows:
        key = int(hashlib.md5(f"{'-' if i is None else i}:{t or ''}".encode()).hexdigest()[:15], 16)
        full.append((i, s, len(WORD.findall(t or "")), key))
    sizes = {s: sum(r[2] for r in full if r[1] == s) for s in {r[1] for r in full}}
    target = goals(sizes)
    out = []
    for s in sizes:
        mine = sorted((r for r in full if r[1] == s), key=lambda r: r[3])
        whole = int(target[s] / sizes[s]) if sizes[s] else 0
        budget = target[s] - whole * sizes[s]
        best, acc, k = (abs(budget), -1), 0, 0
        for key in sorted({r[3] for r in mine}):
            acc += sum(r[2] for r in mine if r[3] == key)
            if abs(budget - acc) <= best[0]:
                best = (abs(budget - acc), key)
        out += [(i, size, sizes[s], float(target[s]), size * (whole + (key <= best[1]))) for i, _, size, key in mine]
    return sorted(out, key=repr)


def check(spark, rows):
    df = M.mix(frame(spark, rows))
    got = sorted(((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in df.collect()), key=repr)
    want = brute(rows)
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    assert all(abs(g[3] - w[3]) <= 1e-9 * max(1, w[3]) for g, w in zip(got, want))
    assert all(r[4] <= 3 * r[1] for r in got)
    return got


def test_against_brute_force(spark):
    sizes = {"a": 400, "b": 40, "c": 25, "d": 90, None: 30, "é": 7}
    rows = [(i * 6 + k, s, "w " * (1 + (i * 37 + k) % 50)) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    got = check(spark, rows)
    by = {}
    for _, size, total, target, taken in got:
        e = by.setdefault((total, target), [0, 0])
        e[0] += taken
        e[1] = max(e[1], size)
    assert all(abs(taken - target) <= largest for (_, target), (taken, largest) in by.items())
    assert any(target == 3 * total for total, target in by)  # some source is stopped


def test_one_bucket_needs_every_level(spark, monkeypatch):
    monkeypatch.setattr(M, "BITS", 60)
    monkeypatch.setattr(M, "STEP", 1)  # halves, so that refining is forced
    check(spark, [(i, f"s{i % 4}", "x " * (i % 9)) for i in range(300)])


def test_awkward_rows(spark):
    rows = [(1, "a", ""), (2, "a", None), (None, "a", "x y"), (None, "a", "x z w"), (3, "a", "p q"), (3, "a", "p q"), (3, "a", "r"),
            (4, None, "word " * 30_000), (5, None, "\t\n"), (6, "", "one two three"), (7, "none", ""), (8, "none", None)]
    check(spark, rows)
    check(spark, [(1, "a", None), (2, "b", " ")])
    check(spark, [(1, "only", "a b c")])
    assert M.mix(frame(spark, rows).limit(0)).count() == 0


def test_reruns_agree(spark):
    docs = table(spark, SF_SMALL, "documents")
    a, b = (sorted((r.doc_id, r.taken) for r in M.mix(d).collect()) for d in (docs, docs.repartition(7, "text")))
    assert a == b
    assert sum(t for _, t in a) > 0
