"""The common words of a language, of any length."""

from __future__ import annotations

import random
from collections import Counter

from strata.llm import quality_divergence as qd


def test_common_words_have_any_length(spark):
    rng = random.Random(4)
    common = [f"{a}{b}" for a in ("which", "could", "their", "after") for b in ("ever", "with")]  # eight letters and more

    def text(n: int, shares: float) -> str:
        return " ".join(rng.choice(common) if rng.random() < shares else "".join(rng.choices("abcdefghij", k=rng.choice([2, 5, 9]))) for _ in range(n))
    rows = [(i, text(300, 0.5), "xx") for i in range(30)] + [(100, text(300, 0), "xx"), (101, "17 ## " * 2 + "whichever " * 4, "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in qd.quality(docs).collect()}
    assert all(got[i].kept for i in range(30))
    assert not got[100].base_failed and got[100].word_distance > 0.2 and not got[100].kept

    top = qd.common_words(qd.base_counts(docs, qd.Limits()), qd.Limits()).collect()
    counts = Counter(w for i, t, _ in rows for w in t.split() if not got[i].base_failed)
    want = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:8]
    assert [(r.lang, [(x.word, x.n) for x in r.top]) for r in top] == [("xx", want)]


def test_tokens_without_a_letter_are_no_common_words(spark):
    rows = [(i, " ".join(f"w{i}a{k} 12 | 7%" for k in range(40)) + " über", "xx") for i in range(5)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    [r] = qd.common_words(qd.base_counts(d, qd.Limits()), qd.Limits()).collect()
    assert [(x.rank, x.word, x.n) for x in r.top][0] == (1, "über", 5) and len(r.top) == 8
    assert all(x.word[0] in "wü" for x in r.top)
