"""Open/high/low/close candles.

Two forms:

* ``candle_rows``: one row per observation carrying the OHLC of its hour,
  exactly what the reference's window model returns.
* ``candles_hourly``: one row per (key, hour), the collapsed form the
  reference's documentation promises. A plain aggregate: partial
  aggregation before the shuffle, so a hot key costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.exprs import names
from strata.functions.timefns import hour_of, trunc_ntz, try_ts

OHLC = ("open", "high", "low", "close")


def prices(df: DataFrame, key: str | Sequence[str] = "id", ts: str = "valid_from",
           price: str = "current_price", unit: str = "hour", parse: bool = False) -> DataFrame:
    """Key, bucket start ``candle_time``, price and the ordering time.

    ``parse=True`` applies ``TRY_TO_TIMESTAMP_NTZ`` to a text time column.
    """
    t = try_ts(ts) if parse else F.col(ts)
    return (df.withColumn(ts, t)
            .withColumn("candle_time", hour_of(ts) if unit == "hour" else trunc_ntz(unit, ts)))


def add_ohlc(df: DataFrame, part: Sequence[str], ts: str, price: str,
             tiebreak: Sequence[str] = ()) -> DataFrame:
    """OHLC of each row's bucket, as window columns over ``part + candle_time``.

    FIRST_VALUE/LAST_VALUE respect NULLs, as in the reference.
    """
    w = (Window.partitionBy(*part, "candle_time").orderBy(ts, *tiebreak)
         .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    p = F.col(price)
    return df.select("*", F.first(p).over(w).alias("open"), F.max(p).over(w).alias("high"),
                     F.min(p).over(w).alias("low"), F.last(p).over(w).alias("close"))


def candle_rows(df: DataFrame, key: str | Sequence[str] = "id", ts: str = "valid_from",
                price: str = "current_price", tiebreak: Sequence[str] = (),
                unit: str = "hour", parse: bool = False, hot=True) -> DataFrame:
    """One row per observation with its bucket's OHLC.

    Ordinary keys: window per (key, bucket), one exchange. When some key
    is hot (``strata.operators.sequence.hot_keys``; ``hot=None`` skips the
    check), the OHLC comes from a partial aggregate joined back instead
    (:func:`candle_rows_by_join`), so no bucket of a hot key sits in one task.
    ``ts`` is kept so the later row-count windows have a total order.
    """
    keys = names(key)
    if hot is True:
        from strata.operators.sequence import hot_keys
        hot = hot_keys(df.withColumn(ts, try_ts(F.col(ts))) if parse else df, keys, ts)
    if hot:
        return candle_rows_by_join(df, keys, ts, price, tiebreak, unit, parse)
    p = prices(df, keys, ts, price, unit, parse)
    out = add_ohlc(p.repartition(*keys, "candle_time"), keys, ts, price, tiebreak)
    return out.select(*keys, "candle_time", ts, *OHLC, *tiebreak)


def _ohlc_agg(p: DataFrame, keys: Sequence[str], ts: str, price: str, tiebreak: Sequence[str]) -> DataFrame:
    # A struct is never NULL, so rows with a NULL time still take part and
    # sort first, as in FIRST_VALUE ... ORDER BY ts (NULLS FIRST).
    order = F.struct(F.col(ts), *[F.col(c) for c in tiebreak])
    pr = F.col(price)
    return (p.groupBy(*keys, "candle_time")
            .agg(F.min_by(pr, order).alias("open"), F.max(pr).alias("high"),
                 F.min(pr).alias("low"), F.max_by(pr, order).alias("close"),
                 F.count(F.lit(1)).alias("ticks")))


def candles_hourly(df: DataFrame, key: str | Sequence[str] = "id", ts: str = "valid_from",
                   price: str = "current_price", tiebreak: Sequence[str] = (),
                   unit: str = "hour", parse: bool = False) -> DataFrame:
    """One row per (key, bucket) (D6): min_by/max_by on the order key."""
    keys = names(key)
    return _ohlc_agg(prices(df, keys, ts, price, unit, parse), keys, ts, price, tiebreak)


def candle_rows_by_join(df: DataFrame, key: str | Sequence[str] = "id", ts: str = "valid_from",
                        price: str = "current_price", tiebreak: Sequence[str] = (),
                        unit: str = "hour", parse: bool = False) -> DataFrame:
    """:func:`candle_rows` for inputs with hot keys.

    The OHLC of each bucket comes from a partial aggregate (one row per key
    and bucket per map task), joined back to the rows on (key, bucket)
    with null-safe equality. No bucket is ever gathered into one task: AQE
    splits a skewed join partition of the row side.
    """
    keys = names(key)
    p = prices(df, keys, ts, price, unit, parse)
    c = _ohlc_agg(p, keys, ts, price, tiebreak).drop("ticks")
    c = c.select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.col("candle_time").alias("_c_time"), *OHLC)
    on = [p[k].eqNullSafe(c[f"_c_{k}"]) for k in keys] + [p["candle_time"].eqNullSafe(c["_c_time"])]
    return p.join(c, on=on, how="inner").select(*keys, "candle_time", ts, *OHLC, *tiebreak)
