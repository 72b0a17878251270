"""Each text operator against a brute-force version, and on awkward tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from conftest import SF_SMALL

from strata.llm import (
    bigru_langid,
    edit_decontam,
    jaccard_metric,
    link_trust,
    ppm,
    quality_divergence,
    queries,
    secret_ledger,
    subseq_svm,
    tree_bpe,
    warc_zstd,
)
from strata.llm.common import scratch, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# NULLs, an empty text, repeated rows, a NULL id, a long text, columns whose names operators use inside
AWKWARD = [(1, "", None), (2, None, "en"), (3, "a b a b a b a b a b a b a b", "en"), (3, "a b a b a b a b a b a b a b", "en"),
           (None, "password = hunter22 x", "de"), (4, "word " * 30_000, "en"), (5, "\t\n ", None), (6, "ÄÖ é\x85x \U0001f600", "fr")]
COLUMNS = "doc_id long, text string, lang string, score double, node long, found string, words string"


def awkward(spark, rows=AWKWARD):
    return spark.createDataFrame([(i, t, lang, 0.5, 7, "x", "y") for i, t, lang in rows], COLUMNS)


def small(spark, name):
    return table(spark, SF_SMALL, name)


def low(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


# --- op1

def test_rules_and_hosts(spark):
    urls = ["http://A.ORG/x", "https://example.org/es/1", "https://example.org/en/12?q", "http://notorg/", "http://org/", "http://b.com/fr/",
            "http://b.com/de/#x", None, "no scheme", "http://example.org", "ftp://x.net?/de/", "http://b.com/other"]
    pages = spark.createDataFrame([(i, u, '<a href="//evil.net/">' if i == 11 else None, "h") for i, u in enumerate(urls)],
                                  "page_id long, url string, html string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in link_trust.judge(pages, iterations=2).collect()}
    assert got[0] == ("a.org", "/x", "org/", "allow") and got[1][2:] == ("example.org/es/", "block")
    assert got[2][1:] == ("/en/12", "example.org/en/1", "block") and got[3][2] is None and got[4][2] == "org/"
    assert got[5][2:] == ("com/fr/", "allow") and got[6][1:] == ("/de/", "com/de/", "block")
    assert got[7] == got[8] == ("", "", None, "allow") and got[9][:3] == ("example.org", "", None)
    assert got[10][:2] == ("x.net", "")
    assert link_trust.judge(pages.limit(0), iterations=1).count() == 0


def test_spread_is_personalised_pagerank(spark):
    edges = [("a", "b", 1), ("b", "c", 3), ("b", "a", 1), ("c", "a", 2)]
    graph = spark.createDataFrame([("trust", *e) for e in edges], "kind string, a string, b string, n long")
    seeds = spark.createDataFrame([("trust", "a", 5)], "kind string, host string, n long")
    got = {r.host: r.score for r in link_trust.spread(graph, seeds, 0.8, 30).collect()}
    p = np.zeros((3, 3))
    for a, b, n in edges:
        p["abc".index(b), "abc".index(a)] = n / sum(m for x, _, m in edges if x == a)
    want = np.linalg.solve(np.eye(3) - 0.8 * p, 0.2 * np.array([1.0, 0, 0]))
    assert np.allclose([got[h] for h in "abc"], want, atol=1e-2)


def test_parent_domains_are_joined_to_the_top(spark):
    pages = spark.createDataFrame([("blog.x.example.com", None), ("y.example.com", None), ("a.b.c.d.net", None)], "host string, html string")
    got = {(r.a, r.b, r.n) for r in link_trust.edges(pages).collect()}
    up = [("blog.x.example.com", "x.example.com"), ("x.example.com", "example.com"), ("y.example.com", "example.com"),
          ("a.b.c.d.net", "b.c.d.net"), ("b.c.d.net", "c.d.net"), ("c.d.net", "d.net")]
    assert got == {(a, b, 1) for a, b in up} | {(b, a, 1) for a, b in up}
    # distrust of a blocked page reaches a host three levels away
    web = spark.createDataFrame([(1, "http://blog.x.bad.net/de/"), (2, "http://shop.z.bad.net/a")], "page_id long, url string").selectExpr("*", "'' AS html")
    rules = (("blog.x.bad.net", "/de/", "block"),)
    assert {r.page_id: r.verdict for r in link_trust.judge(web, rules).collect()} == {1: "block", 2: "block"}


# --- op2

def edit_distance_inside(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        above, row[0], diag = row[:], i, i - 1
        for j, d in enumerate(text, 1):
            row[j] = min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (c != d))
    return min(row)


def test_edit_matches_brute_force():
    rng = random.Random(3)
    items = [(k, "".join(rng.choices("abcde f", k=rng.randint(20, 70)))) for k in range(12)]
    matcher = edit_decontam.Matcher(items, percent=10)
    for _ in range(60):
        _, base = rng.choice(items)
        text = list(base)
        for _ in range(rng.randint(0, 8)):
            at = rng.randrange(len(text))
            text[at:at + rng.randint(0, 1)] = rng.choice(["", "x", "ab"])
        text = "".join(rng.choices("abcdef", k=30)) + "".join(text) + "".join(rng.choices("abcdef ", k=30))
        found = {i: e for i, e, _, _ in matcher.find(text)}
        for i, item in items:
            n = edit_decontam.normal(item)
            d = edit_distance_inside(n, edit_decontam.normal(text))
            assert found.get(i) == (d if d <= len(n) * 10 // 100 else None)


def test_decontamination_tables(spark):
    docs, bench = small(spark, "documents"), small(spark, "benchmark")
    got = edit_decontam.matches(docs, bench)
    again = edit_decontam.matches(docs, bench, block=4000)  # many blocks, the same result
    assert sorted(got.collect()) == sorted(again.collect()) and got.count() > 0
    kept = edit_decontam.clean(awkward(spark), spark.createDataFrame([(1, "a b a b a b"), (2, None), (3, "")], "item_id long, text string"))
    assert kept.columns == awkward(spark).columns and kept.count() == 6
    assert edit_decontam.matches(docs, bench.limit(0)).count() == 0 == edit_decontam.matches(docs.limit(0), bench).count()


# --- op3

def brute_ppm(train, text, order):
    counts = {}
    for t in train:
        raw = b"\xfe" * order + t + b"\xff"
        for i in range(order, len(raw)):
            for k in range(order + 1):
                counts.setdefault(raw[i - k:i], Counter())[raw[i]] += 1
    raw, total = b"\xfe" * order + text + b"\xff", 0.0
    for i in range(order, len(raw)):
        gone, coded = set(), False
        for k in range(order, -1, -1):
            seen = {s: n for s, n in counts.get(raw[i - k:i], {}).items() if s not in gone}
            if not seen:
                continue
            whole = 2 * sum(seen.values())  # escape method D
            if raw[i] in seen:
                total, coded = total + math.log10((2 * seen[raw[i]] - 1) / whole), True
                break
            total += math.log10(len(seen) / whole)
            gone |= seen.keys()
        if not coded:
            total -= math.log10(257 - len(gone))
    return total


def test_ppm_matches_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choices(["the ", "cat", " on", "ñ", "x\n", "A"], k=rng.randint(0, 12)))) for i in range(60)] + [(99, None), (None, "the")]
    rows += [rows[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = 5
    got = ppm.score(docs, order=order, block=60, buckets=7).collect()
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    train = [(t or "").encode() for i, t in rows if not out(i)]
    words = Counter(w for t in train for w in WORD.findall(low(t.decode())))
    words["end of text"] = len(train)
    n, v = sum(words.values()), len(words)
    assert len(got) == len(rows)
    text_of = dict(rows)
    for r in got:
        text = text_of[r.doc_id] or ""
        tokens = WORD.findall(low(text)) + ["end of text"]
        base = sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out(r.doc_id), len(tokens), sum(words[w] > 0 for w in tokens), n)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(brute_ppm(train, text.encode(), order), rel=1e-6)
    assert ppm.score(docs.limit(0)).count() == 0
    alone = ppm.score(spark.createDataFrame([(None, "ab")], "doc_id long, text string")).first()
    assert alone.score == pytest.approx(-3 * math.log10(257)) and alone.train_tokens == 0
    for short in (0, 1, 3):  # contexts no longer than those that a bucket shares
        for r in ppm.score(docs, order=short, block=60, buckets=7).collect():
            assert r.score == pytest.approx(brute_ppm(train, (text_of[r.doc_id] or "").encode(), short), rel=1e-6)


def test_ppm_beats_its_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = ppm.score(docs).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert held["sum(score)"] > held["sum(base_score)"]


def test_ppm_long_text_and_clashing_columns(spark):
    long = "über den Wolken 長い " * 60_000
    docs = spark.createDataFrame([(1, long, 0, "x"), (2, long[:40], 1, "y"), (3, "", 2, None)],
                                 "doc_id long, text string, block int, score string")
    got = {r.doc_id: r for r in ppm.score(docs, block=1 << 16).collect()}
    assert set(got) == {1, 2, 3} and got[1].n_tokens == len(WORD.findall(long)) + 1
    assert got[1].score < got[2].score < 0


# --- op4

def brute_spans(text):
    found = []
    for rank, (kind, pattern, least, group) in enumerate([
            ("assign", r"(?a:(?i:(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?))([A-Za-z0-9+/_.=-]+)", 6, 2),
            ("access", "AKIA[A-Z0-9]+", 20, 0), ("hex", "[0-9a-f]+", 24, 0)]):
        found += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return [s for _, _, s in sorted(found)]


def test_secrets_match_brute_force(spark):
    tricky = ["secret=token:abcdefgh", "Api_Key : 'abcdef' é token=ab password=abcdefg", "AKIA" * 6, "\U0001f600 " + "0a" * 13 + "g" + "f" * 23,
              "passwd=" + "0123456789abcdef" * 2, "SECRET=\"abc\" secret='abcdefé", "x" + "AKIAAAA" + " AKIA" + "Z9" * 8]
    docs = small(spark, "documents").select("doc_id", "text").union(
        spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(tricky)] + [(20_000, None), (20_000, None)], "doc_id long, text string"))
    ledger = secret_ledger.Ledger(spark, scratch(spark, "ledger"))
    got = secret_ledger.digest(secret_ledger.scan_paths(docs, ledger)).collect()
    text_of = {r.doc_id: r.text or "" for r in docs.collect()}
    assert len(got) == docs.count()
    for r in got:
        spans = brute_spans(text_of[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in spans) for k in ("assign", "access", "hex"))
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s.split(":")[0] in ("assign", "access", "hex")] == (spans or [])
    # a second scan finds nothing new; a new rule version scans each blob once more
    before = ledger.read().count()
    ledger.scan(docs.selectExpr("sha2(cast(coalesce(text, '') as binary), 256) AS blob", "coalesce(text, '') AS text"))
    assert ledger.read().count() == before
    newer = (*secret_ledger.RULES[:-1], secret_ledger.Rule("pem", "PRIVATE KEY", 3, version=2))
    secret_ledger.scan_paths(docs, ledger, newer)
    assert ledger.read().count() == before + before // len(secret_ledger.RULES)
    masked = secret_ledger.clean_spans(awkward(spark)).where("text LIKE '%hunter%'").count()
    assert masked == 0 and secret_ledger.clean_spans(awkward(spark)).count() == len(AWKWARD)
    assert secret_ledger.scan_paths(docs.limit(0), secret_ledger.Ledger(spark, scratch(spark, "ledger"))).count() == 0


def test_texts_are_masked_by_the_ledgers_spans(spark):
    key = "-----BEGIN RSA PRIVATE KEY-----\nMIIEabc+/=\nline\n-----END RSA PRIVATE KEY-----"
    rows = [(1, f"😀 a {key} z AKIA{'A' * 16}.", 7), (1, f"😀 a {key} z AKIA{'A' * 16}.", 8), (2, key[:60] + " cut", 7),
            (3, "token=" + "0a" * 16 + " x", 7), (4, None, 7), (5, "", 7), (None, "none", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, blob int")
    ledger = secret_ledger.Ledger(spark, scratch(spark, "ledger"))
    out = secret_ledger.clean_spans(docs, ledger=ledger)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text, r.blob) for r in out.collect()), key=repr)
    one = "😀 a [PEM] z [ACCESS]."
    assert got == sorted([(1, one, 7), (1, one, 8), (2, "[PEM]", 7), (3, "[ASSIGN] x", 7), (4, None, 7), (5, "", 7), (None, "none", 7)], key=repr)
    before = ledger.read().count()
    secret_ledger.clean_spans(docs, ledger=ledger).count()  # nothing is left to scan
    assert ledger.read().count() == before == 5 * len(secret_ledger.RULES)
    spans = {r.doc_id: [(s.kind, s.start, s.end) for s in r.found] for r in secret_ledger.scan_paths(docs, ledger).collect()}
    assert spans[1] == [("pem", 4, 4 + len(key)), ("access", 7 + len(key), 27 + len(key))]


# --- op5

def test_bpe_equals_the_library(spark):
    enc = tree_bpe.bpe(queries.vocabulary())
    rng = random.Random(5)
    alphabet = "abzÀéßñ'sdtrve²½9 .,!-_\t\n\x0b\x1c\x1f\xa0\x85　ıİſǅ́你ªº×÷€ŉĿ|<\U0001f600"
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 14)))
        want = enc.lib.encode(text, add_special_tokens=False).ids
        assert enc.encode(text).tolist() == want
        assert enc.decode(enc.encode(text)) == enc.lib.decode(want, skip_special_tokens=False)
    for _ in range(200):
        text = "".join(rng.choices(rng.choice(["ab", "abcdefghij .", "aaab", "thinger ", "é'sx1 "]), k=rng.randint(1, 700)))
        size = rng.randint(3, 60)
        parts = [(text[i:i + size], *enc.spans(text[i:i + size])) for i in range(0, len(text), size)]
        assert tree_bpe.tree(enc, parts).tolist() == enc.whole(text).tolist()


def test_bpe_tables(spark):
    rows = [*AWKWARD, (7, "thing" * 3000 + " <|endoftext|> x", None), (8, "unsplit" * 4000, None)]
    enc = tree_bpe.bpe(queries.vocabulary())
    got = tree_bpe.encode_documents(awkward(spark, rows), queries.vocabulary(), leaf=1000).collect()
    assert len(got) == len(rows)
    text_of = {i: t or "" for i, t, _ in rows}
    for r in got:
        want = enc.lib.encode(text_of[r.doc_id], add_special_tokens=False).ids
        assert r.ids == want and r.ids_text == " ".join(map(str, want))
        assert r.decoded == enc.lib.decode(want, skip_special_tokens=False)
    assert tree_bpe.encode_documents(awkward(spark).limit(0), queries.vocabulary()).count() == 0


# --- op6

def brute_components(rows):
    sets = {}
    for i, text in rows:
        w = WORD.findall(low(text or ""))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    held = sorted(sets)
    for k, i in enumerate(held):
        for j in held[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("limit, pivots", [(4_000_000, 16), (3_000, 4)])
def test_components_match_brute_force(spark, limit, pivots):
    rng = random.Random(6)
    rows, words = [], [f"w{k}" for k in range(400)]
    shared = rng.choices(words, k=40)
    for k in range(14):  # families of near copies that drift apart, sharing a passage
        base = rng.choices(words, k=rng.randint(8, 90)) + shared
        for _ in range(rng.randint(1, 12)):
            base = [rng.choice(words) if rng.random() < 0.012 else w for w in base]
            rows.append((len(rows), " ".join(base)))
    rows += [(1000, "One two"), (1001, "ONE  two"), (1002, "two one"), (1003, ""), (1004, None), (1005, rows[3][1])]
    got = jaccard_metric.components(spark.createDataFrame(rows, "doc_id long, text string"), limit=limit, pivots=pivots)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(rows)


def test_components_of_awkward_rows(spark):
    got = jaccard_metric.components(awkward(spark)).collect()
    assert len(got) == len(AWKWARD) and {r.component_id for r in got if r.doc_id == 3} == {3}
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert jaccard_metric.components(awkward(spark).limit(0)).count() == 0


# --- op7

def test_kernel_weights_equal_the_nystrom_machine():
    marks = subseq_svm.Landmarks(["idiot", "moron", "thing", "house"])
    w = np.random.default_rng(0).normal(size=marks.root.shape[1])
    weight = marks.weight(w)
    for text in ("idiot", "idi-ot", "mooron", "nothing"):
        code = subseq_svm.codes(text)
        assert subseq_svm.contributions(code, weight).sum() == pytest.approx(marks.vector(code) @ w, abs=1e-4)


def test_toxicity_held_out(spark):
    words = [f"{a}{b}{c}" for a in ("ba", "do", "fu", "ki") for b in ("la", "ne", "so") for c in ("tra", "min", "pel")]
    rng = random.Random(7)
    text = lambda bad: " ".join(rng.choices(words, k=40) + ([rng.choice(["scoundrel", "sc-oundrel", "scounxdrel"])] if bad else []))
    rows = [(i, text(i % 4 == 0), int(i % 4 == 0)) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    machine = subseq_svm.machine(docs, labels)
    got = {r.doc_id: r.score for r in subseq_svm.scores(docs, machine).collect()}
    held = [(y, got[i]) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((s >= 0.7) == bool(y) for y, s in held) >= 0.97 * len(held)
    odd = subseq_svm.scores(awkward(spark), machine).collect()
    assert len(odd) == len(AWKWARD) and all(0 <= r.score <= 1 for r in odd)
    assert subseq_svm.clean(awkward(spark), None, 0.7).count() == len(AWKWARD)
    assert subseq_svm.scores(awkward(spark).limit(0), machine).count() == 0
    nothing = subseq_svm.machine(docs.limit(0), labels.limit(0))
    assert nothing is None and {r.score for r in subseq_svm.scores(awkward(spark), nothing).collect()} == {0.0}


def test_toxic_words_far_into_long_texts_are_learned(spark):
    words = [f"{a}{b}{c}" for a in ("ba", "do", "fu", "ki") for b in ("la", "ne", "so") for c in ("tra", "min", "pel")]
    rng = random.Random(11)
    text = lambda bad: " ".join(rng.choices(words, k=1500) + ([rng.choice(["scoundrel", "scounxdrel"])] if bad else []))
    rows = [(i, text(i % 3 == 0), int(i % 3 == 0)) for i in range(150)]
    assert min(t.find("scoun") for _, t, y in rows if y) > 6000
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [rows[0][:2]], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(rows[0][0], 1)], "doc_id long, toxic int")
    held = subseq_svm.sample(docs, labels, labels.doc_id.isNotNull())
    assert sorted((r.doc_id, r.toxic, r.text) for r in held.collect()) == sorted((i, y, t) for i, t, y in rows)
    machine = subseq_svm.machine(docs, labels)
    held_out = [(y, machine.score(t)) for i, t, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((s >= 0.7) == bool(y) for y, s in held_out) >= 0.97 * len(held_out)


@pytest.mark.parametrize("gap", [0.0, 1.0, 20.0, 400.0])
def test_logistic_fit_reaches_its_minimum(gap):
    rng = np.random.default_rng(3)
    label = np.repeat([0.0, 1.0], [2000, 250])
    z = rng.normal(size=len(label)) + gap * label
    z = (z - np.median(z)) / z.std()
    held = subseq_svm.logistic(z, label)

    def loss(slope, offset):
        t = slope * z + offset
        return (np.logaddexp(0, t) - label * t).mean() + 0.5e-4 * slope ** 2 + 0.5e-6 * offset ** 2
    best = loss(*held)
    assert all(best <= loss(held[0] + a, held[1] + b) + 1e-9 for a in (-0.1, 0, 0.1) for b in (-0.1, 0, 0.1))
    if gap >= 20:
        assert all((1 / (1 + np.exp(-(held[0] * z + held[1]))) >= 0.7) == (label > 0))


def test_toxicity_of_the_given_labels(spark):
    d = SF_SMALL.replace("sf0.001", "sf0.01")
    got = {r.doc_id: r.predicted for r in queries.op7_subseq_svm(spark, d).where("held_out").collect()}
    held = [(r.toxic, got[r.doc_id]) for r in table(spark, d, "labels").collect() if r.doc_id in got]
    bad = [p for y, p in held if y]
    assert sum(bad) >= 0.6 * len(bad) > 0
    assert sum(p for y, p in held if not y) <= 0.03 * len(held)


def test_counts_of_landmark_words(spark):
    rows = [(1, 1, "Scoundrel, scoundrel abc"), (2, 1, "scoundrels 12 ab"), (3, 0, "abc ÄBCD x")]
    got = {r.word: (r.bad, r.plain) for r in subseq_svm.terms(spark.createDataFrame(rows, "doc_id long, toxic int, text string")).collect()}
    assert got == {"scoundrel": (1, 0), "scoundrels": (1, 0), "scou": (2, 0), "scoun": (2, 0), "scound": (2, 0), "abc": (1, 1), "äbcd": (0, 1)}


@pytest.mark.parametrize("size", [0, 2, 30, 500])
def test_scores_of_every_window_by_brute_force(size, monkeypatch):
    monkeypatch.setattr(subseq_svm, "SLICE", 16)
    rng = random.Random(size)
    weight = np.random.default_rng(size).normal(size=subseq_svm.SYMBOLS ** 3).astype(np.float32)
    code = subseq_svm.codes("".join(rng.choices("abcdé f", k=size)))
    starts = max(len(code) + 1 - (subseq_svm.WINDOW - 2), 1)
    values = []
    for at in range(starts):
        value = 0.0
        for i in range(at, min(at + subseq_svm.WINDOW - 2, len(code))):
            for a, b, w in subseq_svm.TRIPLES:
                if i + b < len(code):
                    value += w * weight[(code[i] * 64 + code[i + a]) * 64 + code[i + b]]
        values.append(value)
    got, at = subseq_svm.worst(code, weight)
    assert got == pytest.approx(max(values), abs=1e-4) and values[at] == pytest.approx(max(values), abs=1e-4)


# --- op8

def test_words_are_cut_at_characters_and_windows_come_from_the_whole_text(spark):
    import pyspark.sql.functions as F
    for word in (b"", b"a" * 24, b"b" * 25, ("\u20ac" * 30).encode(), ("a" + "\U0001f600" * 20).encode()):
        parts = bigru_langid.pieces(word)
        assert b"".join(parts) == word and all(0 < len(p) <= bigru_langid.LONGEST and p.decode() for p in parts)
    words = [f"w{i}" for i in range(20_000)]
    rows = [(1, " ".join(words)), (2, "x" * 5_000), (3, "short text"), (4, "y" * 4_001)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.t for r in d.select("doc_id", bigru_langid.drawn(F.col("text"), F.col("doc_id")).alias("t")).collect()}
    held = got[1].split()
    assert set(held) <= set(words) and len(got[1]) <= bigru_langid.CHARS + bigru_langid.DRAWN
    place = [int(w[1:]) for w in held]
    assert place == sorted(place) and place[0] < 2_500 + 100 and place[-1] > 17_000
    assert got[2].replace("\n", "") == "x" * 4_000 and got[3] == "short text" and got[4].replace("\n", "") == "y" * 4_000
    line = spark.createDataFrame([(i, c * 5_000, c) for i, c in enumerate("ab" * 8)], "doc_id long, text string, lang string")
    assert all(r.lang_pred == "ab"[r.doc_id % 2] for r in bigru_langid.predict(line, held_out=9).collect())
    odd = spark.createDataFrame([(1, "\u00bd \u00b2"), (2, "")], "doc_id long, text string").withColumn("lang", F.lit("en"))
    assert {r.lang_pred for r in bigru_langid.predict(odd, held_out=9).collect()} == {"und"}
    assert bigru_langid.predict(line.limit(0)).count() == 0


def test_gradients_and_held_out_languages(spark):
    model = bigru_langid.Model(["a", "b", "c"])
    for way in model.ways:
        way.w = {k: v.astype(float) for k, v in way.w.items()}
    model.embed, model.out, model.bias = (x.astype(float) for x in (model.embed, model.out, model.bias))
    raw, mask = bigru_langid.padded([b"hello", b"x", b"abc"])
    label = np.array([0, 1, 2])
    _, grads = model.step(raw, mask, label)
    for p, g in zip(model.parameters(), grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, e = p[at], 1e-5
        p[at] = old + e
        up = model.step(raw, mask, label)[0]
        p[at] = old - e
        down = model.step(raw, mask, label)[0]
        p[at] = old
        assert (up - down) / (2 * e) == pytest.approx(g[at], rel=1e-3)
    docs = small(spark, "documents")
    got = bigru_langid.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    odd = bigru_langid.predict(awkward(spark)).collect()
    assert len(odd) == len(AWKWARD) and {r.lang_pred for r in odd if r.doc_id in (1, 2, 5)} == {"und"}
    none = bigru_langid.predict(spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string"))
    assert none.first().lang_pred == "und"


def test_rare_and_many_languages_are_learned(spark):
    rng = random.Random(8)
    letters = {"rare": "абвгд", **{f"l{k:02}": "".join(chr(0x3B1 + (5 * k + i) % 24) + chr(0x61 + (7 * k + i) % 26) for i in range(3)) for k in range(70)}}
    text = lambda lang: " ".join("".join(rng.choices(letters[lang], k=5)) for _ in range(30))
    rows = [(lang, text(lang)) for lang in letters for _ in range(2 if lang == "rare" else 6)]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    import pyspark.sql.functions as F
    drawn = bigru_langid.sample(docs, F.lit(True))
    assert {lang for lang, _ in drawn} == set(letters) and len(drawn) == len(rows)
    few = docs.where("lang IN ('rare', 'l00', 'l05')").withColumn("n", F.explode(F.when(F.col("lang") == "rare", F.array(F.lit(0))).otherwise(F.sequence(F.lit(1), F.lit(40)))))
    got = bigru_langid.predict(few.withColumn("doc_id", F.col("doc_id") + 1000 * F.col("n")), held_out=9).collect()
    rare = [r for r in got if r.doc_id < 2]
    assert len(rare) == 2 and {r.lang_pred for r in rare} == {"rare"}


# --- op9

def brute_base(text):
    words = WORD.findall(text)
    wins = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    twice = Counter(wins)
    hit = {i + k for i, w in enumerate(wins) if twice[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def test_quality_base_and_divergence(spark):
    docs = small(spark, "documents").select("doc_id", "text", "lang").union(awkward(spark).select("doc_id", "text", "lang").where("doc_id <> 3").selectExpr("-doc_id", "text", "lang"))
    rows = docs.collect()
    got = {r.doc_id: r for r in quality_divergence.quality(docs).collect()}
    for r in rows:
        g, want = got[r.doc_id], brute_base(r.text or "")
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == want
        assert g.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (g.base_failed and g.kept)
    p, q = np.array([3, 1, 0, 6.0]), np.array([1, 1, 2, 4.0])
    a, b = p / p.sum(), q / q.sum()
    kl = lambda x, y: float((x[x > 0] * np.log2(x[x > 0] / y[x > 0])).sum())
    want = math.sqrt((kl(a, (a + b) / 2) + kl(b, (a + b) / 2)) / 2)
    import pyspark.sql.functions as F
    one = spark.createDataFrame([([3, 1, 0, 6],)], "c array<long>").select(quality_divergence.js_distance(F.col("c"), [1, 1, 2, 4]).alias("d")).first()
    assert one.d == pytest.approx(want)
    junk = spark.createDataFrame([(r.doc_id, r.text, r.lang) for r in rows if r.lang] + [(-99, "#4$ 99:12 " * 60 + " ".join(map(str, range(200))), "en")], "doc_id long, text string, lang string")
    assert not [r for r in quality_divergence.quality(junk).collect() if r.doc_id == -99][0].kept
    assert quality_divergence.quality(docs.limit(0)).count() == 0


def test_quality_of_texts_without_common_words(spark):
    docs = small(spark, "documents").where("lang IS NOT NULL").select("doc_id", "text", "lang")
    rng = random.Random(9)
    junk = " ".join("".join(rng.choices("bcdfgklmnprtv", k=rng.randint(3, 8))) + "&&&" for _ in range(400))
    signs = " ".join(rng.choice(["the", "of", "and"]) + rng.choice(["&&&", "%%%"]) + str(i) for i in range(300))
    rare = [(10_000 + i, " ".join(rng.choices(["и", "в", "не", "на", "слово", "город", "река", "книга", "дорога"], k=150)), "ru") for i in range(2)]
    more = spark.createDataFrame([(-1, junk, "en"), (-2, signs, "en"), *rare, (-3, "x " * 50, "junk")], "doc_id long, text string, lang string")
    common = docs.union(docs.selectExpr("doc_id + 100000", "text", "lang"))  # the rare language marks under 1 of 64
    got = {r.doc_id: r for r in quality_divergence.quality(common.union(more)).collect()}
    assert not (got[-1].base_failed or got[-1].kept or got[-2].base_failed or got[-2].kept)
    assert all(got[i].kept and got[i].nearest == "ru" for i, _, _ in rare)
    assert "junk" not in {r.nearest for r in got.values()}  # no text of it passes the base rules
    labels = {r.doc_id: r.quality for r in small(spark, "labels").collect()}
    good = [got[i].kept for i, q in labels.items() if q and not got[i].base_failed]
    assert sum(good) >= 0.97 * len(good)


# --- op10

def test_warc_round_trip(spark):
    html = [("a", "x" * 50_000), ("b", ""), ("c", None), ("d", "<p>é</p>\r\n\r\n"), ("e", "<p>é</p>\r\n\r\n"), ("e", "<p>é</p>\r\n\r\n"), (None, "only"), ("f", "<p>é</p>\r\n\r\n")]
    ids = [1, 2, 3, 4, 5, 5, 6, None]
    pages = spark.createDataFrame([(i, u, h, "z") for i, (u, h) in zip(ids, html)], "page_id long, url string, html string, path string")
    made = warc_zstd.write_archives(pages, archive_bytes=1000)
    assert made.count() > 1
    got = {(r.page_id, r.record_type): r for r in warc_zstd.read_archives(made).collect()}
    assert got[1, "response"].payload == b"x" * 50_000 and got[2, "revisit"].refers_to == 3 and (5, "revisit") not in got
    assert got[4, "revisit"].refers_to == 5 and got[None, "revisit"].payload_bytes == len("<p>é</p>\r\n\r\n".encode())
    assert got[6, "response"].payload_digest == warc_zstd.digest(b"only")
    assert warc_zstd.round_trip(pages).count() == len(ids) and warc_zstd.round_trip(pages.limit(0)).count() == 0


def test_broken_archives_raise():
    whole = warc_zstd.archive([warc_zstd.record(k, "u", b"body %d" % k * 50, None, False) for k in range(40)])
    assert len(list(warc_zstd.frames(whole))) == 40
    n = struct.unpack_from("<I", whole, 4)[0]
    packed = zstandard.ZstdCompressor().compress(whole[8:8 + n])  # a compressed dictionary is read as well
    again = struct.pack("<II", warc_zstd.MAGIC, len(packed)) + packed + whole[8 + n:]
    assert len(list(warc_zstd.frames(again))) == 40
    for broken in (b"", whole[:-3], whole[8 + n:]):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc_zstd.frames(broken))
    good = warc_zstd.record(1, "u", b"body", None, False)
    for bad in (good[:-1], good.replace(b"body", b"bodx"), good.replace(b"Content-Length: 4", b"Content-Length: 3"), b"HTTP/1.1 200\r\n\r\n"):
        with pytest.raises(ValueError):
            warc_zstd.parse(bad)


def test_an_id_with_two_texts_keeps_all_links(spark):
    one, two = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(5, one), (5, two), (1, one), (9, two.replace("b59", "zz")), (7, "other words that stand alone here"), (5, two), (6, ""), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted({(r.doc_id, r.component_id) for r in jaccard_metric.components(docs).collect()})
    assert got == [(1, 1), (5, 1), (6, 6), (7, 7), (9, 1)]


def test_shingle_sets_do_not_depend_on_their_neighbours():
    texts = ["", "A b\tc d E f", "one two", " \n", "a b c d e f", "x " * 300_000, "ÄÖ É b c d e", "one  TWO"]
    each = [jaccard_metric.shingle_sets([t])[0] for t in texts]
    together = jaccard_metric.shingle_sets(texts)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(each, together, strict=True))
    assert (each[1] == each[4]).all() and (each[2] == each[7]).all()
    assert [len(x) for x in each] == [0, 2, 1, 0, 2, 1, 2, 1]


def test_number_signs_are_no_letters():
    assert not bigru_langid.has_letter("½ ² Ⅷ 12 _") and bigru_langid.has_letter("½ é") and not bigru_langid.has_letter("")
