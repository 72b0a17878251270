"""Queries over landed files: snapshot ingest, versioned SCD2 store, streams.

Each query derives its input files from the driver's tables with Spark
(events written as daily JSON snapshots), runs the operator over them in
a fresh folder under the session's shared checkpoint directory, and
returns a read of the result table.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import dedup
from strata.plans import q_history as H
from strata.plans.bindings import table
from strata.plans.catalog import query
from strata.session import scratch_path
from strata.sources import snapshots
from strata.sources.versioned import VersionedHistory, VersionedTable
from strata.streaming import candles as stream_candles_mod
from strata.streaming import signals as stream_signals
from strata.streaming import snapshots as stream_snapshots

INGEST_LOAD = dt.datetime(2024, 2, 1, 0, 0, 0)
WATERMARK = "10 minutes"


def _scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"queries/{name}/{uuid.uuid4().hex}")


def write_snapshots(spark: SparkSession, sf_dir: str, path: str) -> str:
    """events as daily feed snapshots (JSON lines, one folder per day).

    Shapes the feed's quirks: integers for some numeric fields, an extra
    field, missing fields, ISO times with and without milliseconds, and
    unparsable times for one event type. The rows are dealt by day first, so
    that a day is one file, or files of about a partition's advisory size: the
    number of files doesn't grow with the tasks that read the events.
    """
    e = table(spark, sf_dir, "events")
    text = (F.when(F.col("event_type") == "error", F.lit("n/a"))
            .when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    snap = e.select(F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("symbol"),
                    F.col("event_type").alias("name"), F.col("value").alias("current_price"),
                    F.col("user_id").alias("market_cap_rank"), F.col("event_id").alias("total_volume"),
                    text.alias("last_updated"), F.col("props"),
                    F.date_format("ts", "yyyy-MM-dd").alias("snapshot_day"))
    snap.hint("rebalance", "snapshot_day").write.mode("overwrite").partitionBy("snapshot_day").json(path)
    return path


def _snapshot_sql() -> str:
    given = {
        "id": "CAST(user_id AS VARCHAR)", "symbol": "event_type", "name": "event_type",
        "current_price": "value", "market_cap_rank": "CAST(user_id AS DOUBLE)",
        "total_volume": "CAST(event_id AS DOUBLE)",
        "last_updated": "CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END",
    }
    cols = []
    for c in snapshots.EXPECTED_COLUMNS:
        if c in given:
            cols.append(f"{given[c]} AS {c}")
        elif c in snapshots.TIME_COLUMNS:
            cols.append(f"CAST(NULL AS TIMESTAMP) AS {c}")
        elif c in snapshots.NUMBER_COLUMNS:
            cols.append(f"CAST(NULL AS DOUBLE) AS {c}")
        else:
            cols.append(f"CAST(NULL AS VARCHAR) AS {c}")
    return ",\n    ".join(cols)


@query("snapshot_ingest", f"""
SELECT {_snapshot_sql()},
    TIMESTAMP '{INGEST_LOAD:%Y-%m-%d %H:%M:%S}' AS load_time,
    '{INGEST_LOAD:%Y-%m-%d}' AS partition_date
FROM events
""")
def snapshot_ingest(spark, sf_dir):
    """A1-A4: JSON snapshots -> fixed schema, widened numbers, lenient times, load stamp."""
    path = write_snapshots(spark, sf_dir, _scratch(spark, "snapshots"))
    return snapshots.ingest(spark, path, INGEST_LOAD)


@query("scd2_versioned_store", H.APPLY_SQL)
def scd2_versioned_store(spark, sf_dir):
    """§7.3: SCD2 on plain files: bootstrap history, apply one load, read back."""
    hist, batch = H.history_and_batch(spark, sf_dir)
    store = VersionedHistory(spark, _scratch(spark, "scd2_store"), "id", "name", H.HIST_COLS)
    store.bootstrap(hist, dt.datetime.fromisoformat(H.SCD2_HISTORY_BEFORE))
    store.apply_load(batch.drop("load_time"), dt.datetime.fromisoformat(H.SCD2_BATCH_LOAD))
    return store.read()


@query("stream_ohlc", f"""
WITH c AS (
    SELECT user_id AS id, date_trunc('hour', ts) AS candle_time,
        date_trunc('hour', ts) + INTERVAL 1 HOUR AS candle_end,
        arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
        arg_max(value, (ts, event_id)) AS close, count(*) AS ticks
    FROM events GROUP BY ALL
)
SELECT * FROM c WHERE candle_end <= (SELECT max(ts) - INTERVAL {WATERMARK} FROM events)
""")
def stream_ohlc(spark, sf_dir):
    """L2: watermarked hourly candles from a file stream, appended to a file sink."""
    schema = table(spark, sf_dir, "events").schema
    src = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
           .select(F.col("user_id").alias("id"), F.col("ts").alias("valid_from"),
                   F.col("value").alias("current_price"), "event_id"))
    out = stream_candles_mod.stream_candles(src, "id", "valid_from", "current_price", ["event_id"],
                                            watermark=WATERMARK)
    root = _scratch(spark, "stream_ohlc")
    stream_candles_mod.run_to_table(out, f"{root}/candles", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/candles")


_SNAP_STREAM_SCHEMA = T.StructType(snapshots.SNAPSHOT_SCHEMA.fields + [T.StructField("snapshot_day", T.StringType())])


def _latest_sql(unit: str) -> str:
    return f"""
    SELECT id, name, current_price, load_time, total_volume FROM (
        SELECT CAST(user_id AS VARCHAR) AS id, event_type AS name, value AS current_price,
               date_trunc('{unit}', ts)::TIMESTAMP AS load_time, CAST(event_id AS DOUBLE) AS total_volume,
               CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END AS last_updated
        FROM events
    ) s
    QUALIFY row_number() OVER (PARTITION BY id, load_time ORDER BY last_updated DESC NULLS FIRST,
                                                               total_volume DESC) = 1"""


def _history_sql(unit: str) -> str:
    return f"""
SELECT id, name, current_price, valid_from, valid_to, valid_to IS NULL AS is_current FROM (
    SELECT id, name, current_price, load_time AS valid_from,
           lead(load_time) OVER (PARTITION BY id ORDER BY load_time) AS valid_to
    FROM (
        SELECT *, lag(name) OVER w AS prev_name, row_number() OVER w AS rn
        FROM ({_latest_sql(unit)}) d
        WINDOW w AS (PARTITION BY id ORDER BY load_time)
    ) m
    WHERE rn = 1 OR prev_name IS DISTINCT FROM name
) v
"""


@query("stream_scd2", _history_sql("day"))
def stream_scd2(spark, sf_dir):
    """L1: daily snapshot files -> foreachBatch -> newest per (id, load) -> versioned SCD2."""
    root = _scratch(spark, "stream_scd2")
    path = write_snapshots(spark, sf_dir, f"{root}/landing")
    src = spark.readStream.schema(_SNAP_STREAM_SCHEMA).json(path)
    day = F.to_timestamp(F.col("snapshot_day"), "yyyy-MM-dd").cast("timestamp_ntz")
    feed = snapshots.normalise(src, keep=["snapshot_day"]).withColumn("load_time", day).drop("snapshot_day")
    store = VersionedHistory(spark, f"{root}/scd2", "id", "name", ["id", "name", "current_price"])
    order = dedup.desc_first("last_updated") + [F.col("total_volume").desc()]
    stream_snapshots.run_snapshot_stream(spark, feed, store, ["id"], order, f"{root}/_checkpoint")
    return store.read()


def _stream_signals_sql() -> str:
    frame = "OVER (PARTITION BY id ORDER BY candle_time ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"

    def ma(n: int) -> str:
        f = frame.format(n=n - 1)
        return f"list_reduce(list(close) {f}, lambda a, b: a + b) / count(close) {f} AS ma_{n}"
    return f"""
WITH c AS (
    SELECT user_id AS id, date_trunc('hour', ts) AS candle_time,
        date_trunc('hour', ts) + INTERVAL 1 HOUR AS candle_end,
        arg_max(value, (ts, event_id)) AS close
    FROM events GROUP BY ALL
),
closed AS (SELECT * FROM c WHERE candle_end <= (SELECT max(ts) - INTERVAL {WATERMARK} FROM events)),
ind AS (SELECT id, candle_time, close, {ma(10)}, {ma(50)} FROM closed),
base AS (
    SELECT *, lag(ma_10) OVER (PARTITION BY id ORDER BY candle_time) AS p10,
              lag(ma_50) OVER (PARTITION BY id ORDER BY candle_time) AS p50
    FROM ind
)
SELECT id, candle_time, close, ma_10, ma_50,
    CASE WHEN p10 < p50 AND ma_10 > ma_50 THEN 'BUY'
         WHEN p10 > p50 AND ma_10 < ma_50 THEN 'SELL'
         ELSE 'HOLD' END AS signal
FROM base
"""


@query("stream_signals", _stream_signals_sql())
def stream_signals_query(spark, sf_dir):
    """§2.12: averages and crossover on closed streamed candles, per micro-batch."""
    schema = table(spark, sf_dir, "events").schema
    src = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
           .select(F.col("user_id").alias("id"), F.col("ts").alias("valid_from"),
                   F.col("value").alias("current_price"), "event_id"))
    closed = stream_candles_mod.stream_candles(src, "id", "valid_from", "current_price", ["event_id"],
                                               watermark=WATERMARK)
    root = _scratch(spark, "stream_signals")
    out = stream_signals.run_signal_stream(spark, closed, root, f"{root}/_checkpoint")
    if out is None:  # no candle closed yet
        return spark.createDataFrame([], "id long, candle_time timestamp_ntz, close double, "
                                         "ma_10 double, ma_50 double, signal string")
    return out.select("id", "candle_time", "close", "ma_10", "ma_50", "signal")


def _snapshot_rows_sql() -> str:
    return """
    SELECT CAST(user_id AS VARCHAR) AS id, event_type AS symbol, event_type AS name, value AS current_price,
           CAST(user_id AS DOUBLE) AS market_cap_rank, CAST(event_id AS DOUBLE) AS total_volume,
           CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END AS last_updated,
           date_trunc('day', ts) AS load_time
    FROM events"""


@query("stream_latest", f"""
SELECT id, symbol, name, current_price, market_cap_rank, total_volume, last_updated, load_time FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY load_time DESC NULLS FIRST,
                                 last_updated DESC NULLS FIRST, total_volume DESC) AS rn
    FROM ({_snapshot_rows_sql()}) s
) WHERE rn = 1
""")
def stream_latest(spark, sf_dir):
    """L1 (I2 part): daily snapshot files -> foreachBatch -> versioned newest-row table."""
    root = _scratch(spark, "stream_latest")
    path = write_snapshots(spark, sf_dir, f"{root}/landing")
    src = spark.readStream.schema(_SNAP_STREAM_SCHEMA).json(path)
    day = F.to_timestamp(F.col("snapshot_day"), "yyyy-MM-dd").cast("timestamp_ntz")
    feed = snapshots.normalise(src, keep=["snapshot_day"]).withColumn("load_time", day).drop("snapshot_day")
    newest = VersionedTable(spark, f"{root}/incremental_raw")
    order = dedup.desc_first("last_updated") + [F.col("total_volume").desc()]
    stream_snapshots.run_snapshot_stream(spark, feed, None, ["id"], order, f"{root}/_checkpoint",
                                         newest_table=newest)
    return newest.read().select("id", "symbol", "name", "current_price", "market_cap_rank", "total_volume",
                                "last_updated", "load_time")


def _feed(spark, path: str, unit: str, files: int | None = None):
    """Landed daily files as a stream (or, without ``files``, a batch) of loads of one ``unit``."""
    if files is None:
        src = spark.read.schema(_SNAP_STREAM_SCHEMA).json(path)
    else:
        src = spark.readStream.schema(_SNAP_STREAM_SCHEMA).option("maxFilesPerTrigger", files).json(path)
    load = F.date_trunc(unit, F.to_timestamp(F.col("snapshot_day"), "yyyy-MM-dd")).cast("timestamp_ntz")
    return snapshots.normalise(src, keep=["snapshot_day"]).withColumn("load_time", load).drop("snapshot_day")


def _by_time():
    return dedup.desc_first("last_updated") + [F.col("total_volume").desc()]


#: Files of a micro-batch: a weekly load of daily files never ends where a batch does.
SPLIT_FILES = 10


@query("stream_scd2_split", _history_sql("week"))
def stream_scd2_split(spark, sf_dir):
    """L1: weekly loads split over micro-batches of daily files, in whatever order these come."""
    root = _scratch(spark, "stream_scd2_split")
    path = write_snapshots(spark, sf_dir, f"{root}/landing")
    store = VersionedHistory(spark, f"{root}/scd2", "id", "name", ["id", "name", "current_price"])
    stream_snapshots.run_snapshot_stream(spark, _feed(spark, path, "week", SPLIT_FILES), store, ["id"], _by_time(),
                                         f"{root}/_checkpoint", late="merge")
    return store.read()


@query("stream_latest_split", f"""
SELECT id, symbol, name, current_price, market_cap_rank, total_volume, last_updated, load_time FROM (
    SELECT * REPLACE (date_trunc('week', load_time)::TIMESTAMP AS load_time),
           row_number() OVER (PARTITION BY id ORDER BY date_trunc('week', load_time) DESC NULLS FIRST,
                              last_updated DESC NULLS FIRST, total_volume DESC) AS rn
    FROM ({_snapshot_rows_sql()}) s
) WHERE rn = 1
""")
def stream_latest_split(spark, sf_dir):
    """L1 (I2 part): the newest row per id from weekly loads split over micro-batches."""
    root = _scratch(spark, "stream_latest_split")
    path = write_snapshots(spark, sf_dir, f"{root}/landing")
    newest = VersionedTable(spark, f"{root}/incremental_raw")
    stream_snapshots.run_snapshot_stream(spark, _feed(spark, path, "week", SPLIT_FILES), None, ["id"], _by_time(),
                                         f"{root}/_checkpoint", newest_table=newest, late="merge")
    return newest.read().select("id", "symbol", "name", "current_price", "market_cap_rank", "total_volume",
                                "last_updated", "load_time")


@query("scd2_past_loads", _history_sql("week"))
def scd2_past_loads(spark, sf_dir):
    """The first and the last third of the weekly loads, then those between them, which split intervals."""
    root = _scratch(spark, "scd2_past_loads")
    feed = _feed(spark, write_snapshots(spark, sf_dir, f"{root}/landing"), "week")
    log = dedup.latest(feed, ["id", "load_time"], _by_time())
    log.write.parquet(f"{root}/loads")
    log = spark.read.parquet(f"{root}/loads")
    weeks = [r[0] for r in log.select("load_time").distinct().orderBy("load_time").collect()]  # one row a load
    third = max(1, len(weeks) // 3)
    store = VersionedHistory(spark, f"{root}/scd2", "id", "name", ["id", "name", "current_price"], _by_time())
    for part in (weeks[:third], weeks[-third:], weeks[third:-third]):
        if part:
            store.apply_loads(log.where(F.col("load_time").isin(part)), late="merge")
    return store.read()


@query("stream_ohlc_late", """
SELECT user_id AS id, date_trunc('hour', ts) AS candle_time, arg_min(value, (ts, event_id)) AS open, max(value) AS high,
    min(value) AS low, arg_max(value, (ts, event_id)) AS close, count(*) AS ticks
FROM events GROUP BY ALL
""")
def stream_ohlc_late(spark, sf_dir):
    """L2 with late prices: files in an order that has nothing to do with time, every price counts."""
    root = _scratch(spark, "stream_ohlc_late")
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.col("ts").alias("valid_from"),
                                              F.col("value").alias("current_price"), "event_id")
    e.repartition(6, F.xxhash64("event_id")).write.parquet(f"{root}/landing")
    src = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/landing")
    store = stream_candles_mod.CandleStore(spark, f"{root}/candles", "id")
    stream_candles_mod.run_partials(src, store, f"{root}/_checkpoint", tiebreak=["event_id"])
    return store.candles()
