"""Quality checks, fused suites and the gate."""

from __future__ import annotations

import pytest
from conftest import ts

from strata.operators import quality as Q


def _result(df):
    return {(r.check_name, r.column_name): r for r in df.collect()}


def test_freshness_counts_hour_boundaries(spark):
    df = spark.createDataFrame([(ts("2024-01-01 10:59:00"),)], "t timestamp_ntz")
    r = _result(Q.run_checks(df, [Q.freshness("t", ts("2024-01-01 12:01:00"), max_hours=1)], "x"))
    assert r[("freshness", "t")].observed == 2.0 and not r[("freshness", "t")].passed


def test_empty_table(spark):
    df = spark.createDataFrame([], "t timestamp_ntz, v double")
    r = _result(Q.run_checks(df, [Q.freshness("t", ts("2024-01-01 12:00:00")), Q.row_count_min(1),
                                  Q.not_null("v")], "x"))
    assert not r[("freshness", "t")].passed
    assert not r[("row_count_min", None)].passed
    assert r[("not_null", "v")].passed


def test_accepted_values_and_between_ignore_nulls(spark):
    df = spark.createDataFrame([("BUY", 1.0), ("HOLD", None), (None, 0.0), ("MEH", 2.0)], "s string, p double")
    r = _result(Q.run_checks(df, [Q.accepted_values("s", ["BUY", "SELL", "HOLD"]),
                                  Q.between("p", 0, strict_min=True)], "x"))
    assert r[("accepted_values", "s")].observed == 1.0
    assert r[("between", "p")].observed == 1.0


def test_unique_and_compound(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (2, 2), (None, None), (None, None)], "a long, b long")
    r = _result(Q.run_checks(df, [Q.unique("a"), Q.unique_compound(["a", "b"])], "x"))
    assert r[("unique", "a")].observed == 2.0
    assert r[("unique_compound", "a,b")].observed == 2.0   # the all-NULL rows are skipped


def test_scalar_checks_fuse_into_one_aggregate(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS v")
    out = Q.run_checks(df, [Q.not_null("id"), Q.not_null("v"), Q.row_count_min(50)], "x")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2  # partial + final of the single fused aggregate


def test_freshness_levels(spark):
    df = spark.createDataFrame([(ts("2024-01-01 10:00:00"),)], "t timestamp_ntz")
    lv = [Q.run_checks(df, [Q.freshness_levels("t", ts(a))], "x").first().severity
          for a in ("2024-01-01 10:30:00", "2024-01-01 12:00:00", "2024-01-01 17:00:00")]
    assert lv == ["pass", "warn", "error"]


def test_gate_raises_when_blocking(spark):
    df = spark.createDataFrame([(None,)], "v double")
    res = Q.run_checks(df, [Q.not_null("v")], "x")
    assert len(Q.gate(res, blocking=False)) == 1
    with pytest.raises(Q.QualityGateError):
        Q.gate(res)


def test_freshness_defaults_to_now(spark):
    import datetime as dt
    recent = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.timedelta(minutes=5)
    df = spark.createDataFrame([(recent,)], "t timestamp_ntz")
    assert Q.run_checks(df, [Q.freshness("t")], "x").first().passed


def test_fused_unique_equals_separate(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 1.0), (2, "b", None), (3, None, None), (None, "c", 2.0)],
                               "a long, b string, c double")
    checks = [Q.unique("a"), Q.unique("b"), Q.unique("c")]
    fused = {r.column_name: r.observed for r in Q.run_checks(df, checks, "x").collect()}
    apart = {r.column_name: r.observed for r in Q.run_checks(df, checks, "x", fuse_unique=False).collect()}
    assert fused == apart == {"a": 1.0, "b": 1.0, "c": 1.0}
