"""Map the driver's test tables onto the market vocabulary.

The operators are generic (keys, columns and spans are parameters); these
bindings only rename columns so the registered queries read like the
reference's models. ``events`` stands for price ticks: one row per
observation of a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as price ticks: id, valid_from, current_price (+ event_id tie-break)."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("id"), F.col("ts").alias("valid_from"),
                    F.col("value").alias("current_price"), "event_id")


# SQL text of the same binding, used by the DuckDB oracles.
TICKS_SQL = ("SELECT user_id AS id, ts AS valid_from, value AS current_price, event_id "
             "FROM events")
