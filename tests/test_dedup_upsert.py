"""Newest row per key, union dedup, incremental upsert and schema sync."""

from __future__ import annotations

from conftest import rows, ts
from pyspark.sql import functions as F

from strata.operators import dedup, upsert

FEED = "id string, name string, current_price double, last_updated timestamp_ntz, load_time timestamp_ntz"


def test_null_last_updated_wins_desc(spark):
    df = spark.createDataFrame([("a", "x", 1.0, ts("2024-01-01 10:00:00"), ts("2024-01-01 00:00:00")),
                                ("a", "y", 2.0, None, ts("2024-01-01 00:00:00"))], FEED)
    got = dedup.latest(df, "id", dedup.desc_first("last_updated")).collect()
    assert [r.name for r in got] == ["y"]


def test_latest_plan_limits_before_shuffle(spark):
    df = spark.createDataFrame([("a", "x", 1.0, ts("2024-01-01 10:00:00"), ts("2024-01-01 00:00:00"))], FEED)
    plan = dedup.latest(df, "id", dedup.desc_first("last_updated"))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_union_dedup_one_row_per_key_and_load(spark):
    r = spark.createDataFrame([("a", "x", 1.0, ts("2024-01-01 10:00:00"), ts("2024-01-01 00:00:00"))], FEED)
    i = spark.createDataFrame([("a", "x", 1.0, ts("2024-01-01 10:00:00"), ts("2024-01-01 00:00:00")),
                               ("a", "z", 3.0, ts("2024-01-02 10:00:00"), ts("2024-01-02 00:00:00"))], FEED)
    out = dedup.union_dedup([r, i], ["id", "load_time"], dedup.desc_first("last_updated"))
    assert sorted(x.name for x in out.collect()) == ["x", "z"]
    assert "rn" not in out.columns


def test_upsert_drops_rows_at_or_below_hwm_and_replaces_keys(spark):
    target = spark.createDataFrame([("a", "x", 1.0, ts("2024-01-01 10:00:00"), ts("2024-01-02 00:00:00")),
                                    ("b", "x", 1.0, ts("2024-01-01 10:00:00"), ts("2024-01-02 00:00:00"))], FEED)
    src = spark.createDataFrame([
        ("a", "late", 9.0, ts("2024-01-03 10:00:00"), ts("2024-01-01 00:00:00")),   # below hwm
        ("b", "equal", 9.0, ts("2024-01-03 10:00:00"), ts("2024-01-02 00:00:00")),  # equal to hwm
        ("a", "new", 2.0, ts("2024-01-03 10:00:00"), ts("2024-01-03 00:00:00")),
        ("c", "new", 3.0, ts("2024-01-03 10:00:00"), ts("2024-01-03 00:00:00")),
        ("d", "nul", 3.0, ts("2024-01-03 10:00:00"), None),                          # NULL load_time
    ], FEED)
    out = upsert.latest_upsert(src, target, "id", dedup.desc_first("last_updated"))
    assert rows(out, "id", "name") == [("a", "new"), ("b", "x"), ("c", "new")]
    hwm = upsert.high_water_mark(target)
    late = src.where(upsert.late_rows(src, hwm)).count()
    assert late == 3


def test_first_load_has_no_filter(spark):
    src = spark.createDataFrame([("a", "x", 1.0, ts("2024-01-01 10:00:00"), None)], FEED)
    assert upsert.latest_upsert(src, None, "id", dedup.desc_first("last_updated")).count() == 1
    assert upsert.high_water_mark(None).year == 1900


def test_schema_sync_adds_and_drops_columns(spark):
    target = spark.createDataFrame([(1, "a", 10)], "k long, old string, n int")
    upd = spark.createDataFrame([(2, 5, "s")], "k long, n int, added string")
    out = upsert.merge_by_key(target, upd, "k")
    assert out.columns == ["k", "n", "added"]
    assert rows(out) == [(1, 10, None), (2, 5, "s")]


def test_pushdown_of_literal_hwm(spark, scratch):
    path = f"{scratch}/feed"
    spark.createDataFrame([("a", "x", 1.0, ts("2024-01-01 10:00:00"), ts("2024-01-01 00:00:00"))], FEED) \
        .write.parquet(path)
    src = spark.read.parquet(path)
    plan = upsert.newer_than(src, ts("2023-12-31 00:00:00"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan(load_time" in plan
    assert F is not None


def test_rerun_of_the_same_source_changes_nothing(spark):
    src = spark.createDataFrame([("a", "x", 1.0, ts("2024-01-01 10:00:00"), ts("2024-01-01 00:00:00")),
                                 ("a", "y", 2.0, ts("2024-01-02 10:00:00"), ts("2024-01-02 00:00:00")),
                                 ("b", "z", 3.0, ts("2024-01-02 11:00:00"), ts("2024-01-02 00:00:00"))], FEED)
    order = dedup.desc_first("last_updated")
    first = upsert.latest_upsert(src, None, "id", order)
    first = spark.createDataFrame(first.collect(), first.schema)
    again = upsert.latest_upsert(src, first, "id", order)
    assert rows(again) == rows(first)
