"""SCD2: one load at a time, whole-log build, versioned storage (I4, I5, I10, §7.3)."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import rows, ts

from strata.operators import scd2
from strata.sources.versioned import VersionedHistory, apply_loads

COLS = ["id", "name", "price"]
BATCH = "id string, name string, price double, load_time timestamp_ntz"
LOG = "id string, name string, price double, load_time timestamp_ntz"


def _batch(spark, data, load):
    return spark.createDataFrame([(i, n, float(p), ts(load)) for i, n, p in data], BATCH)


def _loop(spark, loads, null_safe=True):
    hist = None
    for load, data in loads:
        hist = scd2.apply_batch(hist, _batch(spark, data, load), "id", "name", COLS, null_safe=null_safe)
        hist = spark.createDataFrame(hist.collect(), hist.schema)  # keep plans short
    return hist


def test_change_cycle_and_missing_ids(spark):
    h = _loop(spark, [("2024-01-01", [("a", "A", 1), ("b", "B", 1)]),
                      ("2024-01-02", [("a", "B", 2)]),            # b missing: stays current
                      ("2024-01-03", [("a", "A", 3)])])
    got = rows(h, "id", "name", "valid_from", "valid_to", "is_current")
    assert got == [
        ("a", "A", ts("2024-01-01"), ts("2024-01-02"), False),
        ("a", "A", ts("2024-01-03"), None, True),
        ("a", "B", ts("2024-01-02"), ts("2024-01-03"), False),
        ("b", "B", ts("2024-01-01"), None, True),
    ]


def test_same_load_twice_is_no_change(spark):
    loads = [("2024-01-01", [("a", "A", 1)]), ("2024-01-02", [("a", "B", 2)])]
    once = _loop(spark, loads)
    twice = scd2.apply_batch(once, _batch(spark, [("a", "B", 2)], "2024-01-02"), "id", "name", COLS)
    assert rows(twice) == rows(once)


def test_null_tracked_value(spark):
    loads = [("2024-01-01", [("a", None, 1)]), ("2024-01-02", [("a", None, 1)])]
    assert _loop(spark, loads, null_safe=True).count() == 1
    unsafe = _loop(spark, loads, null_safe=False)
    assert unsafe.count() == 2 and unsafe.where("is_current").count() == 2


def test_equal_price_changes_of_two_ids_are_independent(spark):
    h = _loop(spark, [("2024-01-01", [("a", "X", 1), ("b", "X", 1)]),
                      ("2024-01-02", [("a", "Y", 2), ("b", "Y", 2)])])
    assert h.where("is_current").count() == 2 and h.count() == 4


def _random_loads(seed, n_ids=6, n_loads=8):
    rnd = random.Random(seed)
    loads = []
    for d in range(n_loads):
        data = [(f"k{i}", rnd.choice("ABC"), rnd.randint(1, 5)) for i in range(n_ids) if rnd.random() < 0.7]
        loads.append((f"2024-01-{d + 1:02d}", data))
    return loads


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_build_equals_looped_apply(spark, seed):
    loads = _random_loads(seed)
    looped = _loop(spark, loads)
    log = spark.createDataFrame([(i, n, float(p), ts(load)) for load, data in loads for i, n, p in data], LOG)
    built = scd2.build(log, "id", "name", COLS)
    assert rows(built) == rows(looped)
    # hot-key path of the builder gives the same history
    built_hot = scd2.build(log, "id", "name", COLS, hot=_force_hot(spark, log))
    assert rows(built_hot) == rows(looped)
    # several loads at once from a seeded current set
    first = _loop(spark, loads[:3])
    rest = spark.createDataFrame([(i, n, float(p), ts(load)) for load, data in loads[3:] for i, n, p in data], LOG)
    cur = first.where("is_current")
    merged = apply_loads(cur, rest, "id", "name", COLS)
    assert rows(merged.unionByName(first.where("NOT is_current"))) == rows(looped)


def _force_hot(spark, log):
    from strata.operators.sequence import hot_keys
    return hot_keys(log, ["id"], "load_time", hot_rows=2, segment_rows=2)


def test_new_in_last_load_and_one_current(spark):
    h = _loop(spark, [("2024-01-01", [("a", "A", 1), ("b", "B", 1)]), ("2024-01-02", [("a", "B", 2)])])
    assert rows(scd2.new_in_last_load(h, ["id", "name"])) == [("a", "B")]
    assert scd2.one_current_violations(h, "id").count() == 0


def test_versioned_store_commit_rerun_and_late(spark, scratch):
    store = VersionedHistory(spark, f"{scratch}/scd2", "id", "name", COLS)
    assert store.read() is None
    store.apply_load(_batch(spark, [("a", "A", 1), ("b", "B", 1)], "2024-01-01").drop("load_time"), dt.datetime(2024, 1, 1))
    r2 = store.apply_load(_batch(spark, [("a", "B", 2)], "2024-01-02").drop("load_time"), dt.datetime(2024, 1, 2))
    assert r2["closed"] == 1
    again = store.apply_load(_batch(spark, [("a", "C", 2)], "2024-01-02").drop("load_time"), dt.datetime(2024, 1, 2))
    assert again.get("late") is True
    expected = _loop(spark, [("2024-01-01", [("a", "A", 1), ("b", "B", 1)]), ("2024-01-02", [("a", "B", 2)])])
    assert rows(store.read()) == rows(expected)
    # a crashed load (files written, no commit marker) is invisible and is replaced by its rerun
    cur = store.current()
    from strata.sources.tables import overwrite
    overwrite(cur.limit(0), f"{scratch}/scd2/data/version=v20240103000000000000/kind=current")
    assert store.version() == "20240102000000000000"
    store.apply_load(_batch(spark, [("b", "Z", 3)], "2024-01-03").drop("load_time"), dt.datetime(2024, 1, 3))
    assert store.current().count() == 2


def test_vacuum_keeps_history_readable(spark, scratch):
    store = VersionedHistory(spark, f"{scratch}/scd2", "id", "name", COLS)
    loads = _random_loads(5, n_loads=4)
    for load, data in loads:
        store.apply_load(_batch(spark, data, load).drop("load_time"), dt.datetime.fromisoformat(load))
    before = rows(store.read())
    removed = store.vacuum(keep=1)
    assert len(removed) == 3
    assert rows(store.read()) == before == rows(_loop(spark, loads))


def test_merge_replaces_a_closed_row_with_the_same_key(spark):
    hist = spark.createDataFrame([
        ("a", "A", 1.0, ts("2024-01-01"), ts("2024-01-03"), False),
        ("a", "B", 2.0, ts("2024-01-03"), ts("2024-01-05"), False),
        ("a", "C", 3.0, ts("2024-01-05"), None, True)],
        "id string, name string, price double, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")
    # an old load applied again: MERGE on (id, valid_from) replaces the closed B row
    out = scd2.apply_batch(hist, _batch(spark, [("a", "D", 4)], "2024-01-03"), "id", "name", COLS)
    assert rows(out, "name", "valid_from", "valid_to", "is_current") == [
        ("A", ts("2024-01-01"), ts("2024-01-03"), False),
        ("C", ts("2024-01-05"), ts("2024-01-03"), False),
        ("D", ts("2024-01-03"), None, True)]
