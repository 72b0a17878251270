"""Hourly OHLC on a stream of prices.

Event-time windows with a watermark, append mode: a candle is emitted
once the watermark passes its end, late rows past the watermark are
dropped. State is one partial aggregate per open (key, window).
Row-count windows (moving averages, crossover) are not allowed on
streams; run them over the emitted candles table (see
:func:`strata.streaming.signals.foreach_signals`).

Where late prices must count, candles are kept as partials instead
(:class:`CandleStore`): per key and hour the first and last (time, tie-breaker,
price), the extremes and the count, which merge in any order. Each micro-batch
is reduced to partials, merged with those of the days it touches and written
back as new copies of these days; the commit names its epoch, so a replay counts
nothing twice.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.exprs import names
from strata.functions.timefns import trunc_ntz
from strata.sources.versioned import Commit, _Versioned
from strata.streaming.snapshots import stream_id


def stream_candles(prices: DataFrame, key: str | Sequence[str] = "id", ts: str = "valid_from",
                   price: str = "current_price", tiebreak: Sequence[str] = (),
                   width: str = "1 hour", watermark: str = "10 minutes") -> DataFrame:
    keys = names(key)
    # Watermarks need TIMESTAMP; NTZ wall time is UTC, and the session zone is UTC.
    if prices.schema[ts].dataType.typeName() == "timestamp_ntz":
        prices = prices.withColumn(ts, F.col(ts).cast("timestamp"))
    order = F.struct(F.col(ts), *[F.col(c) for c in tiebreak]) if tiebreak else F.col(ts)
    p = F.col(price)
    agg = (prices.withWatermark(ts, watermark)
           .groupBy(*keys, F.window(ts, width).alias("w"))
           .agg(F.min_by(p, order).alias("open"), F.max(p).alias("high"),
                F.min(p).alias("low"), F.max_by(p, order).alias("close"),
                F.count(F.lit(1)).alias("ticks")))
    return agg.select(*keys, F.col("w.start").cast("timestamp_ntz").alias("candle_time"),
                      F.col("w.end").cast("timestamp_ntz").alias("candle_end"),
                      "open", "high", "low", "close", "ticks")


def run_to_table(stream: DataFrame, out_path: str, checkpoint: str, mode: str = "append",
                 file_format: str = "parquet") -> None:
    """Process everything available now into a file sink, then stop.

    The file sink is exactly-once through its own log, so a restarted
    query (lost executor, failed driver) resumes from ``checkpoint``.
    """
    q = (stream.writeStream.format(file_format).outputMode(mode)
         .option("path", out_path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise q.exception()


def partials(prices: DataFrame, key: str | Sequence[str] = "id", ts: str = "valid_from",
             price: str = "current_price", tiebreak: Sequence[str] = (), unit: str = "hour") -> DataFrame:
    """One mergeable row per (key, bucket): (first, last, high, low, ticks).

    ``first`` and ``last`` are (ts, tie-breakers, price) structs, so that
    rows with a NULL time sort first, as in :func:`strata.operators.ohlc.candles_hourly`.
    """
    at = F.struct(F.col(ts), *[F.col(c) for c in tiebreak], F.col(price).alias("price"))
    rows = prices.select(*names(key), trunc_ntz(unit, ts).alias("candle_time"), at.alias("at"))
    return rows.groupBy(*names(key), "candle_time").agg(
        F.min("at").alias("first"), F.max("at").alias("last"), F.max("at.price").alias("high"),
        F.min("at.price").alias("low"), F.count(F.lit(1)).alias("ticks"))


def merged(parts: DataFrame, key: str | Sequence[str] = "id") -> DataFrame:
    """Partials of the same (key, bucket) as one."""
    return parts.groupBy(*names(key), "candle_time").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("high").alias("high"),
        F.min("low").alias("low"), F.sum("ticks").alias("ticks"))


def finished(parts: DataFrame, key: str | Sequence[str] = "id") -> DataFrame:
    """Partials as candles."""
    return parts.select(*names(key), "candle_time", F.col("first.price").alias("open"), "high", "low",
                        F.col("last.price").alias("close"), "ticks")


class CandleStore(_Versioned):
    """Candle partials by day; a commit holds new copies of the days it touched."""

    def __init__(self, spark: SparkSession, root: str, key: str | Sequence[str] = "id"):
        super().__init__(spark, root)
        self.keys = names(key)

    def _read(self, wanted: set[str] | None = None) -> DataFrame | None:
        """The newest copies of the ``wanted`` days (None: of all)."""
        done, paths, seen = self.commits(), [], set()
        for c in reversed(done):
            mine = [d for d in c.buckets if d not in seen and (wanted is None or d in wanted)]
            paths += [f"{self._version_dir(c)}/day={d}" for d in mine]
            seen |= set(c.buckets)
        if not paths:
            return None
        return self.spark.read.schema(T.StructType.fromJson(json.loads(done[-1].schema))).parquet(*paths)

    def candles(self) -> DataFrame | None:
        """All candles as of the last commit."""
        parts = self._read()
        return None if parts is None else finished(parts, self.keys)

    def add(self, parts: DataFrame, epoch: str) -> list[str]:
        """Merge partials in; returns the days touched. An epoch already committed changes nothing."""
        if self.has_epoch(epoch):
            return []
        day = F.coalesce(F.date_format("candle_time", "yyyy-MM-dd"), F.lit("none"))
        days = sorted(r[0] for r in parts.select(day.alias("d")).distinct().collect())  # one row a day
        if not days:
            return []
        stored = self._read(set(days))
        both = merged(parts if stored is None else parts.unionByName(stored.select(*parts.columns)), self.keys)
        c = self._next(days[-1], epoch)
        both.withColumn("day", day).write.mode("overwrite").partitionBy("day").parquet(self._version_dir(c))
        self._commit(Commit(c.seq, c.load, c.epoch, {}, tuple(days), both.schema.json()))
        return days


def run_partials(stream: DataFrame, store: CandleStore, checkpoint: str, ts: str = "valid_from",
                 price: str = "current_price", tiebreak: Sequence[str] = (), unit: str = "hour") -> None:
    """Drain a stream of prices, late ones too, into ``store`` and stop."""
    def apply(batch: DataFrame, epoch_id: int) -> None:
        parts = partials(batch, store.keys, ts, price, tiebreak, unit).persist()
        try:
            store.add(parts, f"{stream_id(store.spark, checkpoint)}-{epoch_id:010d}")
        finally:
            parts.unpersist()
    q = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise q.exception()
