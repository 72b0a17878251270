"""Table sinks, materialisation and partition keys.

Layers map to folders ``<root>/<layer>/<model>`` (the reference's schema
naming without prefix). Views are lazy DataFrames registered as temp
views; tables are parquet written once per run.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.functions.timefns import trunc_ntz

# The reference's partition calendar.
PARTITION_START = "2024-01-01"
PARTITION_END = "2026-12-31"
UNITS = {"hour": "1 HOUR", "day": "1 DAY", "month": "1 MONTH"}
KEY_FORMATS = {"hour": "yyyy-MM-dd-HH:mm", "day": "yyyy-MM-dd", "month": "yyyy-MM-dd"}


def model_path(root: str, layer: str, model: str) -> str:
    """``<root>/<layer>/<model>``: layer name used as is (no target prefix)."""
    return f"{root.rstrip('/')}/{layer}/{model}"


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = (),
              file_format: str = "parquet") -> int:
    """Replace a table and return the rows written.

    The count comes from an observation of the write itself, not from a
    second scan. With ``partition_by`` only the partitions present in
    ``df`` are replaced (dynamic overwrite), so a rerun of one load
    replaces exactly that load.
    """
    obs = Observation("rows_written")
    w = df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").format(file_format)
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.save(path)
    return int(obs.get.get("n", 0))


def append(df: DataFrame, path: str, file_format: str = "parquet") -> int:
    """Append-only sink for run logs (A11); returns rows written."""
    obs = Observation("rows_appended")
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("append").format(file_format).save(path)
    return int(obs.get.get("n", 0))


def read_table(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """``source()`` / ``ref()`` of a materialised model."""
    return spark.read.format(file_format).load(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """A view model: lazy, re-evaluated by every reader."""
    df.createOrReplaceTempView(name)
    return df


def partition_keys(spark: SparkSession, start: str | dt.date = PARTITION_START,
                   end: str | dt.date = PARTITION_END, unit: str = "day") -> DataFrame:
    """Partition keys of a calendar range, generated on the executors."""
    one = spark.range(1).select(
        F.lit(str(start)).cast("timestamp_ntz").alias("s"), F.lit(str(end)).cast("timestamp_ntz").alias("e"))
    return partition_keys_between(one, "s", "e", unit)


def partition_keys_between(bounds: DataFrame, start: str, end: str, unit: str = "day") -> DataFrame:
    """One row per key from ``start`` to ``end`` of each bounds row.

    ``sequence`` + ``explode`` on a bounds row; the keys of a range never
    pass through the driver.
    """
    step = F.expr(f"INTERVAL {UNITS[unit]}")
    s, e = trunc_ntz(unit, start), trunc_ntz(unit, end)
    t = F.explode(F.sequence(s, e, step)).alias("partition_start")
    out = bounds.select(t)
    return out.withColumn("partition_key", F.date_format("partition_start", KEY_FORMATS[unit]))


def rows_per_partition(df: DataFrame, ts: str, unit: str = "day") -> DataFrame:
    """Per-key row counts over the data's own key range, empty keys as 0."""
    b = df.agg(F.min(ts).alias("s"), F.max(ts).alias("e"))
    keys = partition_keys_between(b, "s", "e", unit)
    counts = df.groupBy(trunc_ntz(unit, ts).alias("partition_start")).agg(F.count(F.lit(1)).alias("n_rows"))
    return (keys.join(counts, "partition_start", "left")
            .select("partition_key", F.coalesce("n_rows", F.lit(0)).alias("n_rows")))
