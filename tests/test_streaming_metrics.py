"""Streams agree with batch (L1, L2); run metrics and alerts."""

from __future__ import annotations

import datetime as dt
import os

from conftest import rows, ts
from pyspark.sql import functions as F

from strata.operators import dedup, ohlc, runmetrics as R, scd2
from strata.sources.versioned import VersionedHistory, VersionedTable
from strata.streaming import candles, snapshots as stream_snapshots


def test_stream_candles_equal_closed_batch_candles(spark, scratch):
    src_path = os.path.join(scratch, "ticks")
    data = [(1, dt.datetime(2024, 1, 1, h, m), float(h * 60 + m)) for h in range(5) for m in (5, 30, 55)]
    spark.createDataFrame(data, "id long, valid_from timestamp_ntz, current_price double").write.parquet(src_path)
    schema = spark.read.parquet(src_path).schema
    stream = spark.readStream.schema(schema).parquet(src_path)
    candles.run_to_table(candles.stream_candles(stream), f"{scratch}/out", f"{scratch}/ck")
    got = rows(spark.read.parquet(f"{scratch}/out"), "candle_time", "open", "high", "low", "close")
    batch = ohlc.candles_hourly(spark.read.parquet(src_path)).where(F.col("candle_time") < ts("2024-01-01 04:00:00"))
    assert got == rows(batch, "candle_time", "open", "high", "low", "close")   # last hour still open


def test_snapshot_stream_micro_batches_equal_build(spark, scratch):
    landing = os.path.join(scratch, "landing")
    loads = {"2024-01-01": [("a", "A"), ("b", "B")], "2024-01-02": [("a", "B")], "2024-01-03": [("a", "A"), ("b", "C")]}
    schema = "id string, name string, current_price double, load_time timestamp_ntz, last_updated timestamp_ntz"
    for day, data in loads.items():   # one landed file per load, in load order
        spark.createDataFrame([(i, n, 1.0, ts(day), ts(day)) for i, n in data], schema) \
            .coalesce(1).write.mode("append").parquet(landing)
    store = VersionedHistory(spark, f"{scratch}/store", "id", "name", ["id", "name", "current_price"])
    newest = VersionedTable(spark, f"{scratch}/newest")
    src = spark.readStream.schema(spark.read.parquet(landing).schema).option("maxFilesPerTrigger", 1).parquet(landing)
    stream_snapshots.run_snapshot_stream(spark, src, store, ["id"], dedup.desc_first("last_updated"),
                                         f"{scratch}/ck", newest_table=newest)
    log = spark.read.parquet(landing)
    expected = scd2.build(log, "id", "name", ["id", "name", "current_price"])
    assert rows(store.read()) == rows(expected.select(*store.read().columns))
    assert rows(newest.read(), "id", "name", "load_time") == [
        ("a", "A", ts("2024-01-03")), ("b", "C", ts("2024-01-03"))]
    assert newest.version() == "20240103000000000000"


def _runs(spark):
    data = [("r1", "a", "success", 1.5, 10, ts("2024-01-01 00:00:01")),
            ("r1", "scd2", "pass", 2.0, 7, ts("2024-01-01 00:00:09")),
            ("r2", "a", "error", 0.5, None, ts("2024-01-02 00:00:01")),
            ("r2", "scd2", "success", 1.0, 3, ts("2024-01-02 00:00:04"))]
    return spark.createDataFrame(data, "run_id string, model_name string, status string, "
                                       "execution_time_seconds double, rows_affected long, executed_at timestamp_ntz")


def test_rollup_pipeline_runs_and_gauges(spark):
    roll = {r.run_id: r for r in R.run_rollup(_runs(spark)).collect()}
    assert roll["r1"].status == "success" and roll["r2"].status == "failure"
    assert roll["r1"].tracked_rows == 7 and roll["r1"].total_execution_seconds == 3.5
    pr = {r.run_id: r for r in R.pipeline_runs(_runs(spark)).collect()}
    assert pr["r1"].duration_seconds == 8.0
    g = {r.gauge: r.value for r in R.last_run_gauges(R.run_rollup(_runs(spark))).collect()}
    assert g == {"run_success": 0.0, "run_duration_seconds": 1.5, "tracked_rows_affected": 3.0}
    g2 = {r.gauge: r.value for r in R.last_run_gauges(R.run_rollup(_runs(spark)), new_records=4).collect()}
    assert g2["new_records_total"] == 4.0


def test_alert_for_duration_and_staleness(spark):
    base = dt.datetime(2024, 1, 1)
    vals = [10, 60, 70, 80, 90, 20]
    hist = spark.createDataFrame([("rows", base + dt.timedelta(seconds=30 * i), float(v)) for i, v in enumerate(vals)],
                                 "metric string, ts timestamp_ntz, value double")
    rule = R.Rule("spike", "rows", ">", 50, 60)
    fired = [r.fired_at for r in R.alert_firings(hist, [rule]).collect()]
    assert sorted(fired) == [base + dt.timedelta(seconds=90), base + dt.timedelta(seconds=120)]
    from strata.operators.sequence import hot_keys
    hot = hot_keys(hist, ["metric"], "ts", hot_rows=2, segment_rows=2)
    assert sorted(r.fired_at for r in R.alert_firings(hist, [rule], hot=hot).collect()) == sorted(fired)
    stale = R.stale_alerts(hist, base + dt.timedelta(days=2))
    assert stale.count() == 1


def test_usage_views(spark):
    u = spark.createDataFrame([("wh", ts("2024-01-01 10:10:00"), 1.0), ("wh", ts("2024-01-01 10:50:00"), 2.0),
                               ("wh", ts("2023-12-20 10:50:00"), 5.0)], "warehouse string, ts timestamp_ntz, credits double")
    h = {r.usage_hour: r.credits_used for r in R.usage_hourly(u).collect()}
    assert h[ts("2024-01-01 10:00:00")] == 3.0
    recent = R.usage_recent(u, ts("2024-01-02 00:00:00"))
    assert recent.count() == 2 and {r.cost for r in recent.collect()} == {3.0, 6.0}


def test_streamed_signals_equal_batch_signals(spark, scratch):
    from pyspark.sql import Window as W

    from strata.functions.exprs import exact_avg
    from strata.streaming import signals as stream_signals
    src_path = os.path.join(scratch, "ticks")
    import random
    rnd = random.Random(3)
    for day in range(4):   # four landed files -> several micro-batches
        data = [(k, dt.datetime(2024, 1, 1 + day, h, rnd.randint(0, 59)), float(rnd.randint(1, 50)))
                for k in (1, 2) for h in range(0, 24, 2)]
        spark.createDataFrame(data, "id long, valid_from timestamp_ntz, current_price double") \
            .coalesce(1).write.mode("append").parquet(src_path)
    schema = spark.read.parquet(src_path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src_path)
    sig = stream_signals.run_signal_stream(spark, candles.stream_candles(stream), f"{scratch}/sig",
                                           f"{scratch}/ck", spans=(3, 5))
    closed = spark.read.parquet(f"{scratch}/sig/candles").drop("epoch")
    w = W.partitionBy("id").orderBy("candle_time")
    exp = (closed.withColumn("ma_3", exact_avg("close", w.rowsBetween(-2, 0)))
           .withColumn("ma_5", exact_avg("close", w.rowsBetween(-4, 0))))
    exp = exp.withColumn("signal", indicators_crossover(exp, w))
    cols = ["id", "candle_time", "close", "ma_3", "ma_5", "signal"]
    assert sig.count() == closed.count() > 0
    assert rows(sig.select(*cols)) == rows(exp.select(*cols))
    batches = spark.read.parquet(f"{scratch}/sig/candles").select("epoch").distinct().count()
    assert batches > 1


def indicators_crossover(df, w):
    from strata.operators.indicators import crossover
    return crossover(F.col("ma_3"), F.col("ma_5"), F.lag("ma_3").over(w), F.lag("ma_5").over(w))


def test_alert_carry_equals_the_range_frame(spark):
    import random
    rnd = random.Random(5)
    base, data, t = dt.datetime(2024, 1, 1), [], 0
    for _ in range(600):
        t += rnd.choice([0, 1, 1, 5, 40])
        for m in ("x", "y"):
            data.append((m, base + dt.timedelta(seconds=t), rnd.choice([None, 1.0, 9.0, 9.0, 9.0, 9.0])))
    hist = spark.createDataFrame(data, "metric string, ts timestamp_ntz, value double")
    rules = [R.Rule("short", "x", ">", 5, 3), R.Rule("long", "x", ">", 0, 60), R.Rule("low", "y", "<", 5, 0)]
    want = []
    for r in rules:
        mine = [(a, v) for m, a, v in data if m == r.metric]
        ok = {">": lambda v: v > r.threshold, "<": lambda v: v < r.threshold}[r.op]
        for a, v in mine:
            back = [u for b, u in mine if a - dt.timedelta(seconds=r.for_seconds) <= b <= a]
            if all(u is not None and ok(u) for u in back) and (a - mine[0][0]).total_seconds() >= r.for_seconds:
                want.append((r.alert, r.metric, a, v))
    from strata.operators.sequence import hot_keys
    hot = hot_keys(hist, ["metric"], "ts", hot_rows=100, segment_rows=20)
    for h in (None, hot):
        assert rows(R.alert_firings(hist, rules, hot=h)) == sorted(want, key=repr)


def test_alerts_shuffle_each_row_once(spark, scratch):
    """86,400 samples, a rule of an hour, segments of 100 rows: no copies of rows in the plan."""
    hist = spark.range(86_400).select(F.lit("m").alias("metric"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id")).cast(
        "timestamp_ntz").alias("ts"), (F.col("id") % 5_000).cast("double").alias("value"))
    from strata.operators.sequence import hot_keys
    hot = hot_keys(hist, ["metric"], "ts", hot_rows=1_000, segment_rows=100)
    out = R.alert_firings(hist, [R.Rule("r", "m", ">", 10, 3600)], hot=hot)
    last, want = None, 0  # a plain scan: the last sample at which the rule does not hold
    for i in range(86_400):
        last = i if i % 5_000 <= 10 else last
        want += i >= 3600 and i - last > 3600
    assert len(out.collect()) == want
    plan = out._jdf.queryExecution().executedPlan()
    written = {}

    def walk(node):
        while node.nodeName() == "AdaptiveSparkPlan" or node.nodeName().endswith("QueryStage"):
            node = node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else node.plan()
        if node.nodeName() == "Exchange":
            m = node.metrics()
            if m.contains("shuffleRecordsWritten"):
                written[node.id()] = m.apply("shuffleRecordsWritten").value()
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))
    walk(plan)
    assert 86_400 <= sum(written.values()) <= 1.1 * 86_400


def _ticks(spark, seed, n=400):
    import random
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    data = [(rnd.choice([1, 2, None]), rnd.choice([None] + [base + dt.timedelta(minutes=rnd.randrange(4 * 1440))] * 9), rnd.choice([None, rnd.random()]), i)
            for i in range(n)]
    return data, "id long, valid_from timestamp_ntz, current_price double, event_id long"


def test_late_prices_correct_their_candles(spark, scratch):
    data, schema = _ticks(spark, 3)
    for k in range(4):  # files in no order of time
        spark.createDataFrame(data[k::4], schema).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
    store = candles.CandleStore(spark, f"{scratch}/c")
    candles.run_partials(src, store, f"{scratch}/ck", tiebreak=["event_id"])
    want = ohlc.candles_hourly(spark.createDataFrame(data, schema), tiebreak=["event_id"])
    cols = ("id", "candle_time", "open", "high", "low", "close", "ticks")
    assert rows(store.candles(), *cols) == rows(want, *cols)
    # a replayed epoch counts nothing twice; a late price touches its own day only
    parts = candles.partials(spark.createDataFrame(data[0::4], schema), tiebreak=["event_id"])
    assert store.add(parts, store.commits()[0].epoch) == []
    late = [(1, dt.datetime(2024, 1, 2, 0, 0), 9.0, -1)]
    assert store.add(candles.partials(spark.createDataFrame(late, schema), tiebreak=["event_id"]), "more-0") == ["2024-01-02"]
    want = ohlc.candles_hourly(spark.createDataFrame(data + late, schema), tiebreak=["event_id"])
    assert rows(store.candles(), *cols) == rows(want, *cols)


def test_signal_stream_reads_one_tail(spark, scratch):
    from strata.operators import indicators
    from strata.streaming import signals
    base, out = dt.datetime(2024, 1, 1), []
    for i in range(150):
        out.append((1, base + dt.timedelta(hours=i), float((i * 37) % 11)))
        if i % 3 == 0:
            out.append((2, base + dt.timedelta(hours=i), float(i % 7)))
    schema = "id long, candle_time timestamp_ntz, close double"
    apply = signals.foreach_signals(spark, f"{scratch}/s")
    parts = [out[k:k + 25] for k in range(0, len(out), 25)]
    for epoch, part in enumerate(parts):
        apply(spark.createDataFrame(part, schema), epoch)
        if epoch == 3:  # a replay
            apply(spark.createDataFrame(part, schema), epoch)
    assert signals._epochs(spark, f"{scratch}/s/tails") == [len(parts) - 2, len(parts) - 1]
    assert signals._tails(spark, f"{scratch}/s", len(parts)).count() == 2 * 50
    got = spark.read.parquet(f"{scratch}/s/signals").drop("epoch")
    whole = spark.createDataFrame(out, schema)
    avg = indicators.add_moving_averages(whole, ["id"], ["candle_time"], "close")
    want = indicators.add_signal(avg, ["id"], ["candle_time"], "ma_10", "ma_50")
    assert rows(got, *want.columns) == rows(want)
