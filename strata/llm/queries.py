"""The registered queries of the text operators and their DuckDB oracles.

Every query applies its operator with production parameters to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    bigru_langid,
    collocations,
    edit_decontam,
    hash_mixture,
    jaccard_metric,
    link_trust,
    merkle_levels,
    ppm,
    quality_divergence,
    secret_ledger,
    subseq_svm,
    tree_bpe,
    warc_zstd,
)
from strata.llm.common import fold_of, scratch, table


TOXIC = 0.7  # texts from this score on are toxic


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or link-graph verdict of every page's url."""
    return link_trust.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op2_edit_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in every document, within its error budget."""
    return edit_decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every text under a byte model of nine tenths of them."""
    return ppm.score(table(spark, sf_dir, "documents"))


def op4_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every text, through a blob ledger in the shared folder."""
    ledger = secret_ledger.Ledger(spark, scratch(spark, "ledger"))
    return secret_ledger.digest(secret_ledger.scan_paths(table(spark, sf_dir, "documents"), ledger))


def op5_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every text, encoded and decoded."""
    return tree_bpe.digests(tree_bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary()))


def op6_jaccard_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents at a Jaccard similarity of 0.75 or more."""
    return jaccard_metric.components(table(spark, sf_dir, "documents"))


def op7_subseq_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, learned from two thirds of the labels."""
    docs = table(spark, sf_dir, "documents")
    out = subseq_svm.scores(docs, subseq_svm.machine(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", (fold_of(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                      (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def op8_bigru_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from three quarters of the labelled ones."""
    return bigru_langid.predict(table(spark, sf_dir, "documents"))


def op9_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict by divergence from the language references."""
    out = quality_divergence.quality(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back."""
    return warc_zstd.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 2,000 phrases of two to four words of every language."""
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_merkle_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents, each checked against the root."""
    return merkle_levels.verify(table(spark, sf_dir, "documents")).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_hash_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document a mix of all sources by weight takes."""
    return hash_mixture.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT h, max(page_id) AS top, count(*) AS n FROM p GROUP BY h)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(p.h, 1 + 5 * (i // 4)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), '') AS payload_digest,
  CASE WHEN n > 1 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n > 1 AND page_id <> top THEN top END AS refers_to
FROM p JOIN g USING (h)
"""


OP11_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, len(w) AS size, unnest(range(1, len(w) + 1)) AS i FROM w),
f AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, m, count(*) AS a
  FROM places, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE i + m - 1 <= size GROUP BY ALL HAVING count(*) >= 30),
cut AS (SELECT lang, phrase, m, a, k, string_split(phrase, ' ') AS v FROM f, (SELECT unnest([1, 2, 3]) AS k) WHERE k < m),
s AS (SELECT c.lang, c.phrase, c.m, c.a, c.k, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a // (x.a::HUGEINT + y.a))::BIGINT AS score FROM cut c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.v[1:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.v[c.k + 1:c.m], ' ')),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (SELECT lang, array_to_string(v[i:i + j - 1], ' ') AS phrase, max(a) AS cover
  FROM (SELECT lang, m, a, string_split(phrase, ' ') AS v FROM f WHERE m > 2), (SELECT unnest([1, 2, 3]) AS i), (SELECT unnest([2, 3]) AS j)
  WHERE j < m AND i + j - 1 <= m GROUP BY ALL),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank, b.phrase, a, l, r, n.n, score
FROM best b JOIN n USING (lang) LEFT JOIN inner_ USING (lang, phrase) WHERE cover IS NULL OR 100 * cover < 80 * a
QUALIFY rank <= 2000
"""

# Targets: with the sources in order of stop to weight, a stopped source is one of the first.
OP13_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
  (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
o AS (SELECT *, (sum(source_size) OVER ())::HUGEINT AS total,
  coalesce(sum(3 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS held,
  sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS shared
  FROM s WINDOW w AS (ORDER BY source_size::DOUBLE / weight, source)),
f AS (SELECT *, 3 * source_size * shared < (total - held) * weight AS above FROM o),
r AS (SELECT coalesce(sum(3 * source_size) FILTER (above), 0)::DOUBLE AS held, sum(weight) FILTER (NOT above)::DOUBLE AS shared FROM f),
t AS (SELECT f.source, source_size, CASE WHEN above THEN (3 * source_size)::DOUBLE
  ELSE (total::DOUBLE - r.held) * weight / r.shared END AS target FROM f CROSS JOIN r),
b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole,
  target - whole * source_size AS budget FROM t),
k AS (SELECT source, key, sum(size) AS size, (sum(sum(size)) OVER (PARTITION BY source ORDER BY key))::BIGINT AS upto
  FROM d GROUP BY source, key),
x AS (SELECT k.source, k.key, upto <= budget OR (upto - k.size <= budget AND 2 * budget >= 2 * (upto - k.size) + k.size) AS more
  FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source)
SELECT d.doc_id, d.size, b.source_size, b.target, d.size * (whole + more::BIGINT) AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source JOIN x ON x.source IS NOT DISTINCT FROM d.source AND x.key = d.key
"""


def _op12_sql(levels: int = 7) -> str:
    """Both trees level by level, up to 16 ** ``levels`` nodes each."""
    def row(text: str) -> str:
        return "sha256(" + " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in (
            "doc_id", "source", "lang", "n_chars", text)) + ")"

    def tree(t: str) -> str:
        steps = []
        for k in range(levels):
            steps.append(f"""
{t}{k + 1} AS (SELECT tree, pos // 16 AS pos, (n + 15) // 16 AS n,
  CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h FROM {t}{k} GROUP BY tree, pos // 16, n),
{t}s{k} AS (SELECT tree, pos, n > 1 AS up, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {t}{k} WINDOW w AS (PARTITION BY tree, pos // 16 ORDER BY pos))""")
        return ",".join(steps)

    def path(src: str, t: str, tree_of: str, at: str) -> str:
        steps = []
        for k in range(levels):
            last = f"{src}{k}"
            steps.append(f"""
{src}{k + 1} AS (SELECT d.* REPLACE (CASE WHEN s.up THEN sha256(s.l || d.cur || s.r) ELSE d.cur END AS cur,
  CASE WHEN s.up THEN d.proof || s.l || s.r ELSE d.proof END AS proof)
  FROM {last} d JOIN {t}s{k} s ON s.tree IS NOT DISTINCT FROM d.{tree_of} AND s.pos = d.{at} // {16 ** k})""")
        return ",".join(steps)
    return f"""
WITH bits AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crcs),
d AS (SELECT *, {row("text")} AS leaf, {row("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS low,
  xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, crcs[1 + (xor(c, b) & 255)])), 4294967295) AS crc FROM documents, bits),
a AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  count(*) OVER (PARTITION BY source) AS cnt FROM d),
a0 AS (SELECT source AS tree, pos, cnt AS n, leaf AS h FROM a),{tree("a")},
b0 AS (SELECT 0 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos, count(*) OVER () AS n, h, tree AS source FROM a{levels}),
{tree("b")},
p0 AS (SELECT a.doc_id, a.leaf, a.source, 0 AS one, a.pos, b0.pos AS place, b0.h AS subroot, b{levels}.h AS root,
  CASE WHEN coalesce(crc % 5 = 0, false) THEN low ELSE leaf END AS cur, '' AS proof
  FROM a JOIN b0 ON a.source IS NOT DISTINCT FROM b0.source CROSS JOIN b{levels}),{path("p", "a", "source", "pos")},
q0 AS (SELECT * FROM p{levels}),{path("q", "b", "one", "place")}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified FROM q{levels}
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_link_trust, op2_edit_decontam, op3_ppm, op4_secret_ledger, op5_tree_bpe, op6_jaccard_metric,
        op7_subseq_svm, op8_bigru_langid, op9_quality_divergence, op10_warc_zstd, op11_collocations, op12_merkle_levels,
        op13_hash_mixture)}


def oracle_sql() -> dict[str, str]:
    return {"op10_warc_zstd": OP10_SQL, "op11_collocations": OP11_SQL, "op12_merkle_levels": _op12_sql(), "op13_hash_mixture": OP13_SQL}
