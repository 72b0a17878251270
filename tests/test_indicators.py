"""Candles, moving averages and crossover signals."""

from __future__ import annotations

from conftest import rows, ts

from strata.operators import indicators, ohlc


def _ticks(spark, data):
    return spark.createDataFrame(
        [(k, ts(t), float(p)) for k, t, p in data], "id long, valid_from timestamp_ntz, current_price double")


def test_three_prices_in_one_hour(spark):
    df = _ticks(spark, [(1, "2024-01-01 10:05:00", 3), (1, "2024-01-01 10:20:00", 1), (1, "2024-01-01 10:50:00", 2)])
    got = rows(ohlc.candle_rows(df), "candle_time", "open", "high", "low", "close")
    assert got == [(ts("2024-01-01 10:00:00"), 3.0, 3.0, 1.0, 2.0)] * 3
    hourly = ohlc.candles_hourly(df).collect()
    assert len(hourly) == 1
    h = hourly[0]
    assert (h.open, h.high, h.low, h.close, h.ticks) == (3.0, 3.0, 1.0, 2.0, 3)


def test_null_price_respected_by_first_value(spark):
    df = spark.createDataFrame([(1, ts("2024-01-01 10:05:00"), None), (1, ts("2024-01-01 10:06:00"), 5.0)],
                               "id long, valid_from timestamp_ntz, current_price double")
    r = ohlc.candle_rows(df).collect()
    assert {x.open for x in r} == {None} and {x.close for x in r} == {5.0}


def _signals(spark, prices, spans=(2, 3)):
    data = [(1, f"2024-01-01 {h:02d}:00:00", p) for h, p in enumerate(prices)]
    out = indicators.signal_chain(_ticks(spark, data), spans=spans)
    return [r.signal for r in sorted(out.collect(), key=lambda r: r.valid_from)]


def test_first_row_and_equal_averages_hold(spark):
    # constant prices: averages equal everywhere -> HOLD throughout
    assert _signals(spark, [5, 5, 5, 5]) == ["HOLD"] * 4


def test_buy_when_fast_crosses_from_strictly_below(spark):
    # falling then sharply rising: fast below slow, then above
    sig = _signals(spark, [10, 8, 6, 4, 20])
    assert sig[-1] == "BUY" and set(sig[:-1]) == {"HOLD"}


def test_sell_is_the_mirror(spark):
    sig = _signals(spark, [4, 6, 8, 10, 1])
    assert sig[-1] == "SELL" and set(sig[:-1]) == {"HOLD"}


def test_equal_then_above_is_hold(spark):
    # first rows: ma_2 == ma_3 (same single value) then above -> not a strict cross
    sig = _signals(spark, [5, 6])
    assert sig == ["HOLD", "HOLD"]


def test_keys_are_independent(spark):
    a = [(1, f"2024-01-01 {h:02d}:00:00", p) for h, p in enumerate([10, 8, 6, 4, 20])]
    b = [(2, f"2024-01-01 {h:02d}:00:00", p) for h, p in enumerate([10, 8, 6, 4, 20])]
    out = indicators.signal_chain(_ticks(spark, a + b), spans=(2, 3))
    per = {}
    for r in out.collect():
        per.setdefault(r.id, []).append((r.valid_from, r.signal))
    assert sorted(per[1]) == sorted(per[2]) and sorted(per[1])[-1][1] == "BUY"


def test_moving_average_short_frames_average_what_exists(spark):
    data = [(1, f"2024-01-01 {h:02d}:00:00", p) for h, p in enumerate([1, 2, 3, 4])]
    c = ohlc.candle_rows(_ticks(spark, data))
    out = indicators.moving_averages(c, spans=(2, 10))
    got = [(r.ma_2, r.ma_10) for r in sorted(out.collect(), key=lambda r: r.valid_from)]
    assert got == [(1.0, 1.0), (1.5, 1.5), (2.5, 2.0), (3.5, 2.5)]


def test_candles_by_join_equal_window_candles(spark):
    data = [(k, f"2024-01-01 {h:02d}:{m:02d}:00", (h * 7 + m * 3 + k) % 11) for k in (1, 2) for h in range(3)
            for m in (1, 20, 40)]
    df = _ticks(spark, data).unionByName(
        spark.createDataFrame([(None, ts("2024-01-01 01:00:00"), 4.0), (3, None, 5.0), (3, None, 6.0)],
                              "id long, valid_from timestamp_ntz, current_price double"))
    a = rows(ohlc.candle_rows(df))
    b = rows(ohlc.candle_rows_by_join(df))
    assert len(a) == len(b) == df.count()
    assert [r for r in a if r[2] is not None] == [r for r in b if r[2] is not None]


def test_averages_keep_all_digits(spark):
    """Tiny and huge prices: the average is that of the doubles."""
    from strata.operators.indicators import signal_chain

    for scale in (3e-9, 2e12):
        rows = [("k", f"2024-01-01T{i:02d}:00:00Z", scale * (i + 1)) for i in range(20)]
        df = spark.createDataFrame(rows, "id string, valid_from string, current_price double")
        got = {r.candle_time.hour: r.ma_10 for r in signal_chain(df, parse=True).collect()}
        for i in range(20):
            frame = [scale * (k + 1) for k in range(max(0, i - 9), i + 1)]
            assert abs(got[i] - sum(frame) / len(frame)) <= 1e-12 * got[i]


def test_new_or_changed(spark):
    from strata.functions.exprs import new_or_changed

    df = spark.createDataFrame([("a", None), ("a", "a"), ("a", "b")], "new string, old string")
    assert [r[0] for r in df.select(new_or_changed("new", "old")).collect()] == [True, False, True]
