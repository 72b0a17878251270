"""Incremental blob ledger: secret scans of every historical version.

Each version (a path and its text) is addressed by the SHA-256 of its text;
equal texts are one blob. A ledger, a Parquet folder, holds one row per
(blob, rule, rule version) that was scanned, with the spans found. A scan
reads only the pairs the ledger lacks: a new text, or a new version of a rule.
Findings are then joined back to all paths that hold the blob.

DataFrame functions only: matches come from ``regexp_extract_all``, their
places from the lengths of what ``split`` leaves between them.

Defined results: a NULL text is the empty text, which has no findings; equal
texts are scanned once and reported for each of their rows; repeated rows each
give a row; an empty table gives an empty result and adds nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import let, scratch, texts


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; those whose ``group``
    has fewer than ``least`` characters are dropped after matching."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}:{self.version}"


# The order of the rules is the order of kinds at equal starts.
BASE_RULES = (
    Rule("assign", "(?i:(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?)([A-Za-z0-9+/_.=-]+)", 6, 2),
    Rule("access", "AKIA[A-Z0-9]+", 20),
    Rule("hex", "[0-9a-f]{24,}", 24),
)
EXTRA_RULES = (
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 29),
    # from BEGIN to its END line, or to the text's end
    Rule("pem", r"(?s)-----BEGIN [A-Z ]*PRIVATE KEY-----(?:.*?-----END [A-Z ]*PRIVATE KEY-----|.*)", 27, version=3),
)
RULES = BASE_RULES + EXTRA_RULES

SPAN = "array<struct<start:int,end:int>>"
LEDGER = f"blob string, rule string, spans {SPAN}"


def spans(text: Column, rule: Rule) -> Column:
    """Places of a rule's matches in code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))

    def placed(row: Column) -> Column:
        step = F.aggregate(
            row["found"], F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), F.array().cast(SPAN).alias("out")),
            lambda acc, m: let(
                acc["at"] + F.length(F.get(row["between"], acc["i"])), lambda start: F.struct(
                    (start + F.length(m)).alias("at"), (acc["i"] + 1).alias("i"),
                    F.when(F.length(F.get(row["measured"], acc["i"])) >= rule.least,
                           F.array_append(acc["out"], F.struct(start.alias("start"), (start + F.length(m)).alias("end"))))
                    .otherwise(acc["out"]).alias("out"))))
        return step["out"]
    parts = F.struct(found.alias("found"), measured.alias("measured"),
                     F.split(text, rule.pattern, -1).alias("between"))
    return F.when(text.rlike(rule.pattern), let(parts, placed)).otherwise(F.array().cast(SPAN))


def merged(found: Column) -> Column:
    """Findings that overlap as one span of the first one's kind: (start, kind, end)."""
    step = F.aggregate(
        found, F.array().cast("array<struct<start:int,kind:string,end:int>>"),
        lambda acc, s: let(F.get(acc, F.size(acc) - 1), lambda last: F.when(
            F.size(acc).cast("boolean") & (s["start"] < last["end"]),
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(
                last["start"].alias("start"), last["kind"].alias("kind"), F.greatest(last["end"], s["end"]).alias("end")))))
            .otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))))))
    return step


def masked(text: Column, found: Column) -> Column:
    """The text with each merged span of its findings replaced by ``[KIND]``."""
    def rebuilt(spans: Column) -> Column:
        before = F.transform(spans, lambda s, i: let(F.coalesce(F.get(spans, i - 1)["end"], F.lit(0)), lambda at: F.concat(
            F.substring(text, at + 1, s["start"] - at), F.lit("["), F.upper(s["kind"]), F.lit("]"))))
        return F.concat(F.array_join(before, ""), F.substring(text, F.get(spans, F.size(spans) - 1)["end"] + 1, F.length(text)))
    return F.when(F.size(found) > 0, let(merged(found), rebuilt)).otherwise(text)


class Ledger:
    """A folder of scan results; each scan appends a folder of its own, named
    only when complete, so a scan that fails leaves nothing half read."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(LEDGER).parquet(f"{self.path}/scan-*")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LEDGER)

    def scan(self, versions: DataFrame, rules=RULES) -> None:
        """Scan the (blob, rule version) pairs of ``versions(blob, text)`` that
        the ledger lacks and append their spans, also when there are none."""
        keys = [r.key for r in rules]
        seen = (self.read().where(F.col("rule").isin(keys)).groupBy("blob")
                .agg(F.collect_set("rule").alias("seen")))
        blobs = versions.groupBy("blob").agg(F.first("text").alias("text"))
        new = blobs.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
        new = new.where(F.size(F.array_except(F.lit(keys), F.col("seen"))) > 0)
        found = F.array(*(F.when(~F.array_contains("seen", r.key), F.struct(
            F.lit(r.key).alias("rule"), spans(F.col("text"), r).alias("spans"))) for r in rules))
        (new.select("blob", F.inline(F.array_compact(found)))
         .write.parquet(f"{self.path}/scan-{uuid.uuid4().hex}"))


def known_spans(ledger: Ledger, rules=RULES) -> DataFrame:
    """(blob, found) of the ledger's blobs with findings of these rules: array of
    (start, rank, kind, end) sorted by start, then the order of the rules."""
    ranks = F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))))
    kinds = F.create_map(*(x for r in rules for x in (F.lit(r.key), F.lit(r.kind))))
    return (ledger.read().where(F.col("rule").isin([r.key for r in rules]) & (F.size("spans") > 0))
            .dropDuplicates(["blob", "rule"])
            .withColumn("found", F.transform("spans", lambda s: F.struct(
                s["start"].alias("start"), ranks[F.col("rule")].alias("rank"),
                kinds[F.col("rule")].alias("kind"), s["end"].alias("end"))))
            .groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("found"))).alias("found")))


def scan_paths(versions: DataFrame, ledger: Ledger, rules=RULES, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Bring the ledger up to date for all versions and join its findings back
    to every path: (doc_id, blob, found: array of (start, rank, kind, end)
    sorted by start, then the order of the rules)."""
    held = texts(versions, id_col, text_col).withColumn("blob", F.sha2(F.col("text").cast("binary"), 256))
    ledger.scan(held.select("blob", "text"), rules)
    known = known_spans(ledger, rules)
    empty = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    return (held.select("doc_id", "blob").join(known, "blob", "left")
            .select("doc_id", "blob", F.coalesce("found", empty).alias("found")))


def digest(found: DataFrame, rules=BASE_RULES) -> DataFrame:
    """Counts per base kind, the digest of the base spans and all spans as text."""
    text = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("found", lambda s: s["kind"].isin([r.kind for r in rules]))

    def number(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *(number(r.kind) for r in rules),
        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("found")).alias("spans"))


def clean_spans(docs: DataFrame, rules=RULES, text_col: str = "text", ledger: Ledger | None = None) -> DataFrame:
    """All rows and columns of ``docs``, the secrets in the text masked by the
    spans that the ledger (a new one by default) holds of its blob."""
    ledger = ledger or Ledger(docs.sparkSession, scratch(docs.sparkSession, "ledger"))
    blob = F.sha2(F.coalesce(docs[text_col], F.lit("")).cast("binary"), 256)
    ledger.scan(docs.select(blob.alias("blob"), F.coalesce(docs[text_col], F.lit("")).alias("text")), rules)
    known = known_spans(ledger, rules).select(F.struct("blob", "found").alias("_known"))
    held = docs.join(known, blob == F.col("_known.blob"), "left")
    return held.withColumn(text_col, masked(docs[text_col], F.col("_known.found"))).select(docs.columns)
