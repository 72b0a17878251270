"""Snapshot ingest and table sinks."""

from __future__ import annotations

import datetime as dt
import json
import os

from strata.functions.timefns import format_ts, try_ts
from strata.plans.q_stream import write_snapshots
from strata.sources import snapshots, tables


def test_lenient_timestamps(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00.123Z",), ("2024-01-01 10:00:00",), ("garbage",),
                                ("2024-01-01T10:00:05Z",), (None,)], "s string")
    got = [r.p for r in df.select(try_ts("s").alias("p")).collect()]
    assert got[0] == dt.datetime(2024, 1, 1, 10, 0, 0, 123000)
    assert got[1] == dt.datetime(2024, 1, 1, 10, 0, 0)
    assert got[2] is None and got[4] is None
    assert got[3] == dt.datetime(2024, 1, 1, 10, 0, 5)


def test_ingest_json_schema_widening_and_stamp(spark, scratch):
    path = os.path.join(scratch, "snap.json")
    recs = [{"id": "bitcoin", "symbol": "btc", "current_price": 42000, "market_cap_rank": 1,
             "last_updated": "2024-01-01T10:00:00.500Z", "extra": {"x": 1}},
            {"id": "eth", "symbol": "eth", "current_price": 2200.5, "last_updated": "not a time"}]
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs))
    out = snapshots.ingest(spark, path, dt.datetime(2024, 1, 1, 11, 0, 0, 999))
    assert out.columns == [*snapshots.EXPECTED_COLUMNS, "load_time", "partition_date"]
    r = {x.id: x for x in out.collect()}
    assert r["bitcoin"].current_price == 42000.0 and r["bitcoin"].market_cap_rank == 1.0
    assert r["bitcoin"].last_updated == dt.datetime(2024, 1, 1, 10, 0, 0)   # cut to seconds
    assert r["eth"].last_updated is None and r["eth"].market_cap is None
    assert r["eth"].load_time == dt.datetime(2024, 1, 1, 11, 0, 0) and r["eth"].partition_date == "2024-01-01"


def test_multiline_array(spark, scratch):
    path = os.path.join(scratch, "arr.json")
    with open(path, "w") as f:
        json.dump([{"id": "a", "current_price": 1}, {"id": "b", "current_price": 2}], f)
    assert snapshots.read_snapshots(spark, path, multi_line=True).count() == 2


def test_names_and_format(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5),)], "t timestamp_ntz")
    assert snapshots.upper_names(df).columns == ["T"]
    assert snapshots.lower_names(snapshots.upper_names(df)).columns == ["t"]
    assert df.select(format_ts("t").alias("s")).first().s == "2024-01-02 03:04:05"


def test_overwrite_append_and_partitions(spark, scratch):
    df = spark.range(10).selectExpr("id", "CAST(id % 2 AS STRING) AS part")
    path = os.path.join(scratch, "t")
    assert tables.overwrite(df, path, ["part"]) == 10
    assert tables.overwrite(df.where("part = '1'"), path, ["part"]) == 5   # replaces one partition only
    assert tables.read_table(spark, path).count() == 10
    log = os.path.join(scratch, "log")
    assert tables.append(df, log) == 10 and tables.append(df, log) == 10
    assert tables.read_table(spark, log).count() == 20
    assert tables.model_path("/w", "gold", "scd2") == "/w/gold/scd2"


def test_partition_keys(spark):
    keys = tables.partition_keys(spark, "2024-01-01", "2024-01-03", "day").collect()
    assert [k.partition_key for k in keys] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    months = tables.partition_keys(spark, "2024-01-15", "2024-03-02", "month").count()
    assert months == 3


def test_strict_cast_raises_under_ansi(spark):
    import pytest
    from strata.functions.timefns import strict_ts
    good = spark.createDataFrame([("2024-01-01 10:00:00",)], "s string")
    assert good.select(strict_ts("s").alias("t")).first().t == dt.datetime(2024, 1, 1, 10)
    bad = spark.createDataFrame([("bad",)], "s string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bad.select(strict_ts("s")).collect()


def test_views_and_partition_counts(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10),), (dt.datetime(2024, 1, 3, 9),),
                                (dt.datetime(2024, 1, 3, 11),)], "ts timestamp_ntz")
    tables.as_view(df, "strata_test_view")
    assert spark.sql("SELECT count(*) AS n FROM strata_test_view").first().n == 3
    got = {r.partition_key: r.n_rows for r in tables.rows_per_partition(df, "ts", "day").collect()}
    assert got == {"2024-01-01": 1, "2024-01-02": 0, "2024-01-03": 2}
    hours = tables.partition_keys(spark, "2024-01-01 00:00:00", "2024-01-01 05:00:00", "hour").collect()
    assert [h.partition_key for h in hours][:2] == ["2024-01-01-00:00", "2024-01-01-01:00"] and len(hours) == 6


def test_a_day_is_one_file_however_many_tasks_read_the_events(spark, scratch):
    days = spark.range(600).selectExpr(
        "id AS event_id", "timestampadd(DAY, cast(id % 3 as int), timestamp_ntz'2024-01-01 10:00:00') AS ts",
        "id % 7 AS user_id", "'click' AS event_type", "id * 0.5 AS value", "'{}' AS props")
    days.repartition(6).write.parquet(f"{scratch}/sf/events.parquet")
    path = write_snapshots(spark, f"{scratch}/sf", f"{scratch}/landing")
    files = {day: [f for f in os.listdir(f"{path}/{day}") if f.endswith(".json")] for day in os.listdir(path) if "=" in day}
    assert {day: len(f) for day, f in files.items()} == {f"snapshot_day=2024-01-0{d}": 1 for d in (1, 2, 3)}
    assert spark.read.json(path).count() == 600
