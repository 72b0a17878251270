"""Moving averages and crossover signals.

``ma_N`` is AVG(close) over ``ROWS N-1 PRECEDING .. CURRENT ROW`` per key
in time order, with no warm-up suppression (short frames average what
exists). The crossover is BUY when the fast average goes from strictly
below the slow one to strictly above, SELL for the reverse, otherwise
HOLD (first row, equality and NULLs included).

All windows share one partitioning and ordering, so a chain of candles,
averages and signals costs one exchange and one sort; hot keys go through
:mod:`strata.operators.sequence`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.exprs import exact_avg, names
from strata.functions.timefns import try_ts
from strata.operators import ohlc
from strata.operators.sequence import hot_keys, over_sequence

# The reference's average spans and signal labels.
DEFAULT_SPANS = (10, 50)
BUY, SELL, HOLD = "BUY", "SELL", "HOLD"


def ma_name(n: int) -> str:
    return f"ma_{n}"


def add_moving_averages(df: DataFrame, part: Sequence[str], order: Sequence[str],
                        value: str = "close", spans: Sequence[int] = DEFAULT_SPANS) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(*order)
    # one select: all frames of one window spec are evaluated by one operator
    return df.select("*", *[exact_avg(value, w.rowsBetween(-(n - 1), 0)).alias(ma_name(n))
                            for n in spans])


def crossover(fast: Column, slow: Column, prev_fast: Column, prev_slow: Column) -> Column:
    return (F.when((prev_fast < prev_slow) & (fast > slow), F.lit(BUY))
            .when((prev_fast > prev_slow) & (fast < slow), F.lit(SELL))
            .otherwise(F.lit(HOLD)))


def add_signal(df: DataFrame, part: Sequence[str], order: Sequence[str],
               fast: str, slow: str) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(*order)
    return df.select("*", crossover(F.col(fast), F.col(slow), F.lag(fast).over(w),
                                    F.lag(slow).over(w)).alias("signal"))


def moving_averages(candles: DataFrame, key: str | Sequence[str] = "id",
                    order: Sequence[str] = ("candle_time", "valid_from"),
                    value: str = "close", spans: Sequence[int] = DEFAULT_SPANS,
                    hot=True) -> DataFrame:
    """``ma_N`` columns over candle rows."""
    keys, order = names(key), list(order)

    def compute(df, part):
        return add_moving_averages(df, part, order, value, spans)

    return over_sequence(candles, keys, order, compute, rows_before=max(spans) - 1,
                         time_col=order[0], hot=hot)


def trading_signals(indicators: DataFrame, key: str | Sequence[str] = "id",
                    order: Sequence[str] = ("candle_time", "valid_from"),
                    spans: Sequence[int] = DEFAULT_SPANS, hot=True) -> DataFrame:
    """BUY/SELL/HOLD from rows that already carry the two averages (I8)."""
    keys, order = names(key), list(order)
    fast, slow = ma_name(min(spans)), ma_name(max(spans))

    def compute(df, part):
        return add_signal(df, part, order, fast, slow)

    return over_sequence(indicators, keys, order, compute, rows_before=1, time_col=order[0], hot=hot)


def signal_chain(df: DataFrame, key: str | Sequence[str] = "id", ts: str = "valid_from",
                 price: str = "current_price", tiebreak: Sequence[str] = (),
                 spans: Sequence[int] = DEFAULT_SPANS,
                 parse: bool = False, hot=True, with_signal: bool = True) -> DataFrame:
    """Observations -> candles -> averages -> signals in one plan.

    ``with_signal=False`` stops after the averages (I7 over raw ticks).

    Without hot keys this is one exchange on the key and one sort, all
    windows sharing them. With hot keys, candles come from a partial
    aggregate per (key, hour) joined back to the rows, and the averages and
    signals run over time segments with
    ``max(spans)`` rows of overlap (the lag of the slow average reaches
    that far back).
    """
    keys, tiebreak = names(key), list(tiebreak)
    order = ["candle_time", ts, *tiebreak]
    fast, slow = ma_name(min(spans)), ma_name(max(spans))
    out_cols = [*keys, "candle_time", ts, "close", *[ma_name(n) for n in spans]]
    out_cols += ["signal"] if with_signal else []
    if hot is True:
        # text times are parsed before their spread is measured
        hot = hot_keys(df.withColumn(ts, try_ts(F.col(ts))) if parse else df, keys, ts)

    def indicators_and_signal(d, part):
        d = add_moving_averages(d, part, order, "close", spans)
        return add_signal(d, part, order, fast, slow) if with_signal else d

    if not hot:
        def compute(d, part):
            d = ohlc.add_ohlc(ohlc.prices(d, keys, ts, price, parse=parse), part, ts, price, tiebreak)
            return indicators_and_signal(d, part)
        return over_sequence(df, keys, order, compute, time_col=ts, hot=None).select(*out_cols)
    rows = ohlc.candle_rows_by_join(df, keys, ts, price, tiebreak, parse=parse)
    reach = max(spans) if with_signal else max(spans) - 1
    return over_sequence(rows, keys, order, indicators_and_signal, rows_before=reach,
                         time_col=ts, hot=hot).select(*out_cols)
