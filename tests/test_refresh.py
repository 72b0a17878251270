"""Three daily loads through the whole chain equal the one-pass history."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from strata.operators import dedup, scd2
from strata.plans.q_stream import write_snapshots
from strata.plans.refresh import SCD2_COLUMNS, Refresh
from strata.sources import snapshots, tables

SF = "/root/testdata/sf0.01"
DAYS = ["2024-01-01", "2024-01-02", "2024-01-03"]


def test_three_loads(spark, scratch):
    landing = write_snapshots(spark, SF, f"{scratch}/landing")
    r = Refresh(spark, f"{scratch}/warehouse")
    reports = [r.run(f"{landing}/snapshot_day={d}", dt.datetime.fromisoformat(d) + dt.timedelta(hours=23, minutes=59))
               for d in DAYS]
    assert all(rep.rows_loaded > 0 and not rep.checks_failed for rep in reports)
    assert all(not rep.history_checks_failed for rep in reports)
    assert reports[-1].gauges["run_success"] == 1.0 and reports[-1].gauges["new_records_total"] > 0
    # history equals the one-pass build over each load's newest row per id
    order = dedup.desc_first("last_updated") + [F.col("total_volume").desc_nulls_last()]
    frames = []
    for d in DAYS:
        lt = dt.datetime.fromisoformat(d) + dt.timedelta(hours=23, minutes=59)
        snap = snapshots.ingest(spark, f"{landing}/snapshot_day={d}", lt)
        frames.append(dedup.latest(snap, "id", order))
    log = frames[0].unionByName(frames[1]).unionByName(frames[2])
    expected = scd2.build(log.select(*SCD2_COLUMNS, "load_time"), "id", "name", list(SCD2_COLUMNS))
    assert rows(r.history.read()) == rows(expected.select(*r.history.read().columns))
    # rerunning the last load is late: nothing changes
    again = r.run(f"{landing}/snapshot_day={DAYS[-1]}", dt.datetime.fromisoformat(DAYS[-1]) + dt.timedelta(hours=23, minutes=59))
    assert again.scd2.get("late") is True
    assert rows(r.history.read()) == rows(expected.select(*r.history.read().columns))
    # gold views and run log
    assert r.signals().count() == r.history.read().count()
    n = r.history.read().count()
    assert r.candles().count() == n and r.indicators().count() == n and r.scd2().count() == n
    assert r.raw_data().count() > 0 and r.silver_crypto().count() > 0 and r.incremental_raw().count() > 0
    assert r.mkt_cap().count() == 20
    assert r.new_versions().count() > 0
    log_rows = tables.read_table(spark, r.path("monitoring", "model_runs"))
    assert log_rows.where("status IN ('success', 'pass')").count() == 6 * 4
    # rows opened or closed, and nothing for the late run
    touched = {(x.run_id, x.rows_affected) for x in log_rows.where("model_name = 'scd2'").collect()}
    assert {n for _, n in touched} == {rep.scd2["opened"] + rep.scd2["closed"] for rep in reports} | {0}
    h = r.history.read()
    assert sum(rep.scd2["closed"] for rep in reports) == h.where("NOT is_current").count()
    assert again.gauges["new_records_total"] == 0 and again.gauges["tracked_rows_affected"] == 0
    runs = tables.read_table(spark, r.path("monitoring", "pipeline_runs"))
    assert runs.count() == 4 and runs.where("duration_seconds > 0 AND finished_at > started_at").count() == 4


def test_backfill_equals_sequential_loads(spark, scratch):
    landing = write_snapshots(spark, SF, f"{scratch}/landing")
    days = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    seq = Refresh(spark, f"{scratch}/seq")
    for d in days:
        seq.run(f"{landing}/snapshot_day={d}", dt.datetime.fromisoformat(d) + dt.timedelta(hours=23, minutes=59))
    # the landing folder holds all 30 days; back-fill only the first four
    sub = f"{scratch}/landing4"
    spark.read.json(landing).where(F.col("snapshot_day").isin(*days)).write.partitionBy("snapshot_day").json(sub)
    bf = Refresh(spark, f"{scratch}/bf")
    rep = bf.backfill(sub)
    assert not rep.checks_failed and not rep.history_checks_failed
    assert rows(bf.history.read()) == rows(seq.history.read())
    inc_cols = [*snapshots.EXPECTED_COLUMNS, "load_time"]
    assert rows(bf.incremental.read().select(*inc_cols)) == rows(seq.incremental.read().select(*inc_cols))
    _same_models(bf, seq)


def _same_models(a, b):
    """Every model of two warehouses, by value."""
    for model in ("incremental_raw", "silver_crypto", "scd2", "candles", "indicators", "signals", "mkt_cap", "new_versions"):
        x, y = getattr(a, model)(), getattr(b, model)()
        cols = [c for c in x.columns if c != "partition_date"]
        assert rows(x, *cols) == rows(y, *cols), model
    ids = [r.id for r in a.mkt_cap().collect()]
    assert len(ids) == len(set(ids)) == 20


def test_a_past_day_ends_like_loads_in_order(spark, scratch):
    landing = write_snapshots(spark, SF, f"{scratch}/landing")

    def load(r, day, **kw):
        return r.run(f"{landing}/snapshot_day={day}", dt.datetime.fromisoformat(day) + dt.timedelta(hours=23, minutes=59), **kw)
    # a tracked price changes with every load, so the past day cuts every interval
    seq = Refresh(spark, f"{scratch}/seq", tracked=("current_price",))
    out = Refresh(spark, f"{scratch}/out", tracked=("current_price",), deep_checks=False)
    for d in DAYS:
        load(seq, d)
    for d in (DAYS[0], DAYS[2]):
        load(out, d)
    before = rows(out.silver_crypto())
    refused = load(out, DAYS[1])
    assert refused.scd2["late"] and rows(out.silver_crypto()) == before
    assert out.raw_data().where(f"partition_date = '{DAYS[1]}'").count() == 0
    placed = load(out, DAYS[1], past=True)
    assert placed.scd2["opened"] + placed.scd2["closed"] > 0 and not placed.model_checks_failed
    _same_models(out, seq)


def test_a_failing_gate_leaves_gauges_and_an_alert(spark, scratch):
    landing = write_snapshots(spark, SF, f"{scratch}/landing")
    r = Refresh(spark, f"{scratch}/wh", deep_checks=False)
    load_time = dt.datetime(2024, 1, 1, 23, 59)
    with pytest.raises(Exception, match="freshness"):
        r.run(f"{landing}/snapshot_day=2024-01-01", load_time, as_of=load_time + dt.timedelta(hours=9))
    gauges = {x.metric: x.value for x in tables.read_table(spark, r.path("monitoring", "gauges")).collect()}
    assert gauges["run_success"] == 0.0 and gauges["new_records_total"] == 0.0
    run = tables.read_table(spark, r.path("monitoring", "pipeline_runs")).first()
    assert run.status == "failure" and run.duration_seconds > 0
    later = run.finished_at + dt.timedelta(minutes=2)
    assert [a.alert for a in r.alerts(later).collect()] == ["run_failed"]
    assert r.alerts(run.finished_at + dt.timedelta(seconds=5)).count() == 0
    assert {a.alert for a in r.alerts(run.finished_at + dt.timedelta(days=2)).collect()} == {"run_failed", "stale"}
    # the same load, judged in time, goes through
    done = r.run(f"{landing}/snapshot_day=2024-01-01", load_time)
    assert done.gauges["run_success"] == 1.0 and r.history.read().count() > 0


def test_late_rows_are_counted(spark, scratch):
    landing = write_snapshots(spark, SF, f"{scratch}/landing")
    r = Refresh(spark, f"{scratch}/wh")
    r.run(f"{landing}/snapshot_day=2024-01-02", dt.datetime(2024, 1, 2, 23, 59))
    # an older day arriving after a newer one: every row is at or below the mark
    rep = r.run(f"{landing}/snapshot_day=2024-01-01", dt.datetime(2024, 1, 1, 23, 59))
    assert rep.late_rows == rep.rows_loaded > 0
    assert rep.scd2.get("late") is True
