"""The commit log: split loads, replays, past loads in any order, buckets."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from strata.operators import dedup, scd2
from strata.sources.versioned import VersionedHistory, VersionedTable
from strata.streaming import snapshots as S

COLS = ["id", "name", "price"]
SCHEMA = "id string, name string, price double, load_time timestamp_ntz, last_updated timestamp_ntz, volume long"


def by_time():
    return dedup.desc_first("last_updated") + [F.col("volume").desc()]


def _random(seed, loads=5, ids=6):
    """Rows (id, name, price, load, last_updated, volume), ids repeated within a load, some without a time, a NULL name."""
    rnd, out, v = random.Random(seed), [], 0
    for d in range(1, loads + 1):
        for i in range(ids):
            for _ in range(rnd.choice([0, 1, 1, 2])):
                v += 1
                out.append((f"k{i}" if i else None, rnd.choice(["A", "B", None]), float(v), dt.datetime(2024, 1, d),
                            rnd.choice([None, dt.datetime(2024, 1, d, rnd.randrange(24))]), v))
    return out


def _expected(spark, data):
    log = dedup.latest(spark.createDataFrame(data, SCHEMA), ["id", "load_time"], by_time())
    return rows(scd2.build(log, "id", "name", COLS))


def _apply(store, spark, data, epoch=None, late="merge"):
    batch = dedup.latest(spark.createDataFrame(data, SCHEMA), ["id", "load_time"], by_time())
    return store.apply_loads(batch, late=late, epoch=epoch)


@pytest.mark.parametrize("seed, buckets", [(1, 1), (2, 3)])
def test_any_order_of_loads_gives_the_sorted_history(spark, scratch, seed, buckets):
    data = _random(seed, loads=4, ids=5)
    order = [1, 2, 3, 4]
    random.Random(seed).shuffle(order)
    store = VersionedHistory(spark, f"{scratch}/s", "id", "name", COLS, by_time(), buckets)
    for n, d in enumerate(order):
        day = [r for r in data if r[3].day == d]
        # each load comes in two parts, the second one after later loads in half the cases
        _apply(store, spark, day[::2], f"a-{n}")
        _apply(store, spark, day[1::2], f"b-{n}") if day[1::2] else None
    assert rows(store.read().select(*COLS, "valid_from", "valid_to", "is_current")) == _expected(spark, data)
    again = _apply(store, spark, data, "a-0")
    assert again["replay"] and rows(store.read()) == _expected(spark, data)
    assert store.vacuum(keep=1) and rows(store.read()) == _expected(spark, data)


def test_a_past_load_splits_cuts_and_merges(spark, scratch):
    def load(day, name, price):
        return [("a", name, price, ts(f"2024-01-0{day}"), None, 1)]
    store = VersionedHistory(spark, f"{scratch}/s", "id", "name", COLS, by_time())
    other = [("b", "Z", 1.0, ts("2024-01-01"), None, 1)]
    for k, batch in enumerate((load(1, "X", 1.0) + other, load(5, "X", 5.0), load(7, "Y", 7.0))):
        _apply(store, spark, batch, f"e{k}")
    done = _apply(store, spark, load(3, "Y", 3.0), "past")  # cuts X, which day 5 starts again
    assert done["late_rows"] == 0 and done["version"] == "20240103000000000000"
    assert [r for r in rows(store.read()) if r[0] == "a"] == [
        ("a", "X", 1.0, ts("2024-01-01"), ts("2024-01-03"), False), ("a", "X", 5.0, ts("2024-01-05"), ts("2024-01-07"), False),
        ("a", "Y", 3.0, ts("2024-01-03"), ts("2024-01-05"), False), ("a", "Y", 7.0, ts("2024-01-07"), None, True)]
    _apply(store, spark, load(6, "Y", 6.0), "past2")  # the open Y starts earlier
    assert [r for r in rows(store.read()) if r[0] == "a" and r[5]] == [("a", "Y", 6.0, ts("2024-01-06"), None, True)]
    # the withdrawn and new rows are those of key a alone
    done = store.commits()[-1]
    assert {r.id for r in store._rows([done], "closed").unionByName(store._rows([done], "gone")).collect()} == {"a"}
    assert store.version() == "20240107000000000000"


def test_refused_rows_are_counted(spark, scratch):
    store = VersionedHistory(spark, f"{scratch}/s", "id", "name", COLS, by_time())
    data = _random(4, loads=2)
    second = [r for r in data if r[3].day == 2]
    _apply(store, spark, second, "e1", late="refuse")
    before = rows(store.read())
    n = dedup.latest(spark.createDataFrame(data, SCHEMA), ["id", "load_time"], by_time()).where("day(load_time) = 1").count()
    mixed = _apply(store, spark, [r for r in data if r[3].day == 1], "e2", late="refuse")
    assert mixed["late"] and mixed["late_rows"] == n and rows(store.read()) == before
    same = _apply(store, spark, second, None, late="refuse")  # the newest load without an epoch: a rerun
    assert same["late"] and rows(store.read()) == before


def test_only_touched_buckets_are_written(spark, scratch):
    store = VersionedHistory(spark, f"{scratch}/s", "id", "name", COLS, by_time(), buckets=16)
    day = [(f"k{i}", "A", 1.0, ts("2024-01-01"), None, 1) for i in range(200)]
    _apply(store, spark, day, "e0")
    _apply(store, spark, [("k7", "B", 2.0, ts("2024-01-02"), None, 1)], "e1")
    c = store.commits()[-1]
    assert len(c.buckets) == 1 and c.held["current"] < 40 and c.held["closed"] == 1
    assert rows(store.read()) == _expected(spark, day + [("k7", "B", 2.0, ts("2024-01-02"), None, 1)])


def test_the_current_set_is_not_exchanged_for_a_small_batch(spark, scratch):
    store = VersionedHistory(spark, f"{scratch}/s", "id", "name", COLS, by_time())
    _apply(store, spark, [(f"k{i}", "A", 1.0, ts("2024-01-01"), None, 1) for i in range(300)], "e0")
    spark.createDataFrame([("k7", "B", 2.0, ts("2024-01-02"), None, 1)], SCHEMA).write.parquet(f"{scratch}/batch")
    given = spark.read.parquet(f"{scratch}/batch").withColumnRenamed("load_time", "_load")
    out, _ = store._changes(given, store.commits(), None, [])
    plan = out.where("kind = 'current' AND NOT _new")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    rest = plan[:plan.index("LeftAnti")]
    assert "Exchange hashpartitioning" not in rest


def _land(spark, path, parts):
    """One file per part, in this order."""
    for data in parts:
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _stream(spark, path, store, newest, checkpoint, late="refuse"):
    src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    return S.run_snapshot_stream(spark, src, store, ["id"], by_time(), checkpoint, newest_table=newest, late=late)


def test_one_load_in_three_files_equals_the_batch(spark, scratch):
    data = [r for r in _random(7, loads=1, ids=9) if r[0] is not None]
    late = [("k1", "A", 0.5, dt.datetime(2023, 12, 31), None, 0), ("new", "B", 0.5, dt.datetime(2023, 12, 31), None, 0)]
    _land(spark, f"{scratch}/in", [data[0::3], data[1::3], data[2::3], late])
    store = VersionedHistory(spark, f"{scratch}/s", "id", "name", COLS)
    newest = VersionedTable(spark, f"{scratch}/n")
    report = _stream(spark, f"{scratch}/in", store, newest, f"{scratch}/ck")
    assert len(report) == 4 and [r["late_rows"] for r in report] == [0, 0, 0, 2]
    assert rows(store.read()) == _expected(spark, data)
    want = dedup.latest(spark.createDataFrame(data, SCHEMA), "id", [F.col("load_time").desc(), *by_time()])
    assert rows(newest.read(), *want.columns) == rows(want)
    # the same micro-batch once more, as after a crash before the stream's own commit
    before, commits = rows(store.read()), len(store.commits())
    apply = S.foreach_load(store, ["id"], by_time(), newest_table=newest, stream=lambda: S.stream_id(spark, f"{scratch}/ck"))
    apply(spark.createDataFrame(data[0::3], SCHEMA), 0)
    assert rows(store.read()) == before and len(store.commits()) == commits
    # another stream counts its epochs from 0 again: not a replay
    _land(spark, f"{scratch}/in2", [[("k1", "Q", 9.0, dt.datetime(2024, 1, 9), None, 99)]])
    _stream(spark, f"{scratch}/in2", store, newest, f"{scratch}/ck2")
    assert rows(newest.read().where("id = 'k1'"), "name") == [("Q",)]


def test_streamed_past_loads_are_placed(spark, scratch):
    data = [r for r in _random(8, loads=3, ids=4) if r[0] is not None]
    days = {d: [r for r in data if r[3].day == d] for d in (1, 2, 3)}
    _land(spark, f"{scratch}/in", [days[2], days[3][::2], days[1], days[3][1::2] or days[3][:1]])
    store = VersionedHistory(spark, f"{scratch}/s", "id", "name", COLS)
    newest = VersionedTable(spark, f"{scratch}/n")
    report = _stream(spark, f"{scratch}/in", store, newest, f"{scratch}/ck", late="merge")
    assert all(r["late_rows"] == 0 for r in report)
    assert rows(store.read()) == _expected(spark, data)
    want = dedup.latest(spark.createDataFrame(data, SCHEMA), "id", [F.col("load_time").desc(), *by_time()])
    assert rows(newest.read(), *want.columns) == rows(want)
