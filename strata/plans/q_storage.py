"""Ingest and storage queries: timestamp normalisation, partition keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from strata.functions.timefns import format_ts, to_seconds, try_ts
from strata.plans.bindings import table
from strata.plans.catalog import query
from strata.sources import snapshots, tables

LOAD_TIME = dt.datetime(2024, 2, 1, 6, 30, 15)


def _order_texts(o):
    """o_orderdate as feed text in several shapes; one class of keys broken on purpose."""
    k = F.col("o_orderkey") % 5
    d = F.col("o_orderdate")
    text = (F.when(k == 0, F.lit("not a date"))
            .when(k == 1, F.concat(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".123Z")))
            .when(k == 2, F.concat(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
            .when(k == 3, F.date_format(d, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
            .otherwise(format_ts(d)))
    return o.select("o_orderkey", F.col("o_custkey").cast("double").alias("o_custkey"), text.alias("raw_text"))


@query("normalise_timestamps", f"""
WITH t AS (
    SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey,
        CASE o_orderkey % 5
            WHEN 0 THEN 'not a date'
            WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.123Z'
            WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || 'Z'
            WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f')
            ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
        END AS raw_text
    FROM orders
),
p AS (
    SELECT *, date_trunc('second', TRY_CAST(regexp_replace(trim(raw_text), '(?i)z$|[+-]00:?00$', '') AS TIMESTAMP)) AS parsed
    FROM t
)
SELECT o_orderkey, o_custkey, raw_text, parsed,
    strftime(parsed, '%Y-%m-%d %H:%M:%S') AS parsed_text,
    TIMESTAMP '{LOAD_TIME:%Y-%m-%d %H:%M:%S}' AS load_time,
    '{LOAD_TIME:%Y-%m-%d}' AS partition_date
FROM p
""")
def normalise_timestamps(spark, sf_dir):
    """A2-A4, H2, H8: widen ints, parse mixed ISO text leniently, stamp the load.

    The key class only shapes the text variants; every order row is checked.
    """
    t = _order_texts(table(spark, sf_dir, "orders"))
    parsed = to_seconds(try_ts("raw_text"))
    out = t.select("o_orderkey", "o_custkey", "raw_text", parsed.alias("parsed"))
    out = out.withColumn("parsed_text", format_ts("parsed"))
    return snapshots.stamp(out, LOAD_TIME)


@query("partition_keys", """
WITH b AS (SELECT date_trunc('day', min(ts)) AS s, date_trunc('day', max(ts)) AS e FROM events),
k AS (SELECT unnest(generate_series(s, e, INTERVAL 1 DAY)) AS partition_start FROM b),
c AS (SELECT date_trunc('day', ts) AS partition_start, count(*) AS n_rows FROM events GROUP BY 1)
SELECT strftime(k.partition_start, '%Y-%m-%d') AS partition_key, coalesce(c.n_rows, 0) AS n_rows
FROM k LEFT JOIN c USING (partition_start)
""")
def partition_keys(spark, sf_dir):
    """Day keys over the events' range, with row counts (0 for empty days)."""
    return tables.rows_per_partition(table(spark, sf_dir, "events"), "ts", "day")


