"""Corpus pipeline: five stages over documents, each one text operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written to the shared folder and read again as the next stage's documents. All
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import edit_decontam, jaccard_metric, secret_ledger, subseq_svm, tree_bpe
from strata.llm.common import stored, table
from strata.llm.queries import TOXIC, vocabulary


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine scores as toxic go."""
    trained = subseq_svm.machine(docs, table(spark, sf_dir, "labels"))
    return subseq_svm.clean(docs, trained, TOXIC)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id
    stays; rows without an id stay, as nothing names their group, and of rows
    repeated under one id all do."""
    groups = jaccard_metric.components(docs)
    gone = groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return edit_decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; the secrets in their texts are masked."""
    return secret_ledger.clean_spans(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text that is left: (doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    return tree_bpe.digests(tree_bpe.encode_documents(docs, vocabulary()))


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("encoding", encoding)]

#: A trained classifier decides the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
