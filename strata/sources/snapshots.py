"""Market snapshot ingest.

Snapshots are JSON records (one object per line, or JSON arrays with
``multiLine``). The read schema is fixed: fields outside it are dropped,
absent ones come back NULL, integers are read as doubles, and the three
timestamp texts are parsed row by row (unparsable text -> NULL) and cut
to whole seconds. Each load is stamped with one ``load_time`` and one
``partition_date``, both passed in by the caller.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.timefns import to_seconds, try_ts

# The feed columns the reference keeps, in its order.
TEXT_COLUMNS = ("id", "symbol", "name")
NUMBER_COLUMNS = (
    "current_price", "market_cap", "market_cap_rank", "total_volume", "high_24h", "low_24h",
    "price_change_24h", "price_change_percentage_24h", "market_cap_change_24h",
    "market_cap_change_percentage_24h", "circulating_supply", "total_supply", "max_supply",
    "ath", "ath_change_percentage", "atl", "atl_change_percentage",
)
TIME_COLUMNS = ("ath_date", "atl_date", "last_updated")
EXPECTED_COLUMNS = (
    "id", "symbol", "name", "current_price", "market_cap", "market_cap_rank",
    "total_volume", "high_24h", "low_24h", "price_change_24h",
    "price_change_percentage_24h", "market_cap_change_24h",
    "market_cap_change_percentage_24h", "circulating_supply",
    "total_supply", "max_supply", "ath", "ath_change_percentage",
    "ath_date", "atl", "atl_change_percentage", "atl_date", "last_updated",
)


def _field(name: str) -> T.StructField:
    if name in NUMBER_COLUMNS:
        return T.StructField(name, T.DoubleType())
    return T.StructField(name, T.StringType())


# Read schema: numbers as double (A2: integers widen), times as text (parsed later).
SNAPSHOT_SCHEMA = T.StructType([_field(c) for c in EXPECTED_COLUMNS])

# Stored raw table: times parsed to TIMESTAMP_NTZ, plus the load stamps.
MARKET_SCHEMA = T.StructType(
    [T.StructField(c, T.TimestampNTZType()) if c in TIME_COLUMNS else _field(c) for c in EXPECTED_COLUMNS]
    + [T.StructField("load_time", T.TimestampNTZType()), T.StructField("partition_date", T.StringType())])


def read_snapshots(spark: SparkSession, path: str | Sequence[str], multi_line: bool = False,
                   file_format: str = "json") -> DataFrame:
    """Snapshot files -> rows with the fixed schema (A1, A2).

    A JSON number that is an integer reads into a double column as its
    float value; a field with the wrong type reads as NULL (PERMISSIVE).
    """
    reader = spark.read.schema(SNAPSHOT_SCHEMA).option("mode", "PERMISSIVE")
    if file_format == "json":
        reader = reader.option("multiLine", str(multi_line).lower())
    return reader.format(file_format).load(path)


def normalise(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Keep expected columns (absent ones NULL), parse and cut times (A1-A3).

    ``keep`` names extra columns to carry through (e.g. a load partition).
    """
    have = set(df.columns)
    cols = []
    for f in SNAPSHOT_SCHEMA.fields:
        c = F.col(f.name) if f.name in have else F.lit(None)
        if f.name in TIME_COLUMNS:
            cols.append(to_seconds(try_ts(c.cast("string"))).alias(f.name))
        else:
            cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols, *keep)


def stamp(df: DataFrame, load_time: dt.datetime, partition_date: str | None = None) -> DataFrame:
    """One load_time (UTC, whole seconds) and partition_date per load (A4)."""
    lt = load_time.replace(microsecond=0, tzinfo=None)
    part = partition_date or lt.strftime("%Y-%m-%d")
    return (df.withColumn("load_time", F.lit(lt).cast("timestamp_ntz"))
            .withColumn("partition_date", F.lit(part)))


def ingest(spark: SparkSession, path: str | Sequence[str], load_time: dt.datetime,
           partition_date: str | None = None, multi_line: bool = False) -> DataFrame:
    """Read, normalise and stamp one load of snapshot files."""
    return stamp(normalise(read_snapshots(spark, path, multi_line)), load_time, partition_date)


def upper_names(df: DataFrame) -> DataFrame:
    """Column names as the warehouse stores them (H9)."""
    return df.toDF(*[c.upper() for c in df.columns])


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])
