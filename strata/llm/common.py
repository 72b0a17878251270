"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from strata.session import checkpoint_dir

# Java regex classes of the contracts: a word is a run without these bytes.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH = 1000  # rows with whole texts that go to a Python worker at a time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Rows hold whole texts, so where the session doesn't say how
    many go to Python at a time, they are fewer than Spark's 10,000."""
    if spark.conf.get(ARROW_ROWS, None) is None:
        spark.conf.set(ARROW_ROWS, str(BATCH))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) only, a NULL text as empty; other columns can't clash."""
    return docs.select(docs[id_col].alias("doc_id"),
                       F.coalesce(docs[text_col], F.lit("")).alias("text"))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written once (with the writer's ``options``) to the shared folder and
    read back: a cut of the lineage that survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it as often as ``body`` likes (a lambda
    variable; Catalyst would otherwise repeat the expression)."""
    return F.transform(F.array(value), body)[0]


def fold_of(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % modulus


def ranked(df: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``pos``, the 0-based place of a row within its ``group`` (NULL
    is a group) in the given order, and ``n``, the group's rows. The rows are
    range-partitioned by group and order, numbered inside each partition and
    shifted by the group's rows in earlier partitions, so a group of any size is
    spread over tasks; one task sees at most a row per partition of a group.
    Rows with equal order come in any order. ``df`` is computed twice (ranges are
    sampled): hand in a stored table."""
    keys = [F.col(group).asc_nulls_first(), *order]
    numbered = stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                      .withColumn("_id", F.monotonically_increasing_id()), name)
    part = F.shiftright("_id", 33)  # the partition, by the definition of the function
    counts = numbered.groupBy(group, part.alias("_part")).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_m"))
    w = W.partitionBy(group)
    before = F.sum("_m").over(w.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    shifts = counts.select(F.struct(F.col(group).alias("g"), "_part", F.sum("_m").over(w).alias("n"),
                                    (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("by")).alias("_s"))
    return (numbered.join(shifts, part.eqNullSafe(F.col("_s._part")) & F.col(group).eqNullSafe(F.col("_s.g")))
            .select(*df.columns, (F.col("_id") + F.col("_s.by")).alias("pos"), F.col("_s.n").alias("n")))
