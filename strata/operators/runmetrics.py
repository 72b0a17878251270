"""Run metrics: logs, roll-ups, last-run gauges, alert rules, usage views
(SURVEY K1-K6, D5, A11).

Logs are append-only tables (``strata.sources.tables.append``). Everything
here is grouped aggregation (partial before the shuffle) or a bounded
time window per metric run through :mod:`strata.operators.sequence`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.timefns import hour_of, seconds_between
from strata.functions.exprs import join_null_safe
from strata.operators.sequence import SEG, hot_keys, with_segments

# Statuses the reference counts as success.
OK_STATUSES = ("success", "pass")
# The reference's alert thresholds.
ROWS_SPIKE = 50
STALE_SECONDS = 90_000
STALE_FOR_SECONDS = 300
RULE_FOR_SECONDS = 60

MODEL_RUN_COLUMNS = ("run_id", "model_name", "status", "execution_time_seconds", "rows_affected", "executed_at")
PIPELINE_RUN_COLUMNS = ("run_id", "job_name", "status", "started_at", "finished_at", "duration_seconds")


def failed(status: Column) -> Column:
    return ~F.coalesce(status.isin(*OK_STATUSES), F.lit(False))


def pipeline_runs(model_runs: DataFrame, job_name: str = "pipeline") -> DataFrame:
    """One pipeline-run row per run (K2): start, end, duration = end - start."""
    g = model_runs.groupBy("run_id").agg(
        F.min("executed_at").alias("started_at"), F.max("executed_at").alias("finished_at"),
        F.max(failed(F.col("status")).cast("int")).alias("_bad"))
    return g.select("run_id", F.lit(job_name).alias("job_name"),
                    F.when(F.col("_bad") == 1, "failure").otherwise("success").alias("status"),
                    "started_at", "finished_at",
                    seconds_between("started_at", "finished_at").alias("duration_seconds"))


def run_rollup(model_runs: DataFrame, tracked_model: str = "scd2") -> DataFrame:
    """Per run: total execution time, worst status, rows of one model."""
    return model_runs.groupBy("run_id").agg(
        F.sum(F.coalesce("execution_time_seconds", F.lit(0.0))).alias("total_execution_seconds"),
        F.when(F.max(failed(F.col("status")).cast("int")) == 1, "failure").otherwise("success").alias("status"),
        F.coalesce(F.sum(F.when(F.col("model_name") == tracked_model, F.col("rows_affected"))),
                   F.lit(0)).cast("long").alias("tracked_rows"),
        F.count(F.lit(1)).alias("models"),
        F.max("executed_at").alias("finished_at"))


def last_run_gauges(rollup: DataFrame, new_records: int | None = None) -> DataFrame:
    """Gauges of the newest run as (gauge, value) rows (K3).

    ``max_by`` on the run's finish time is a partially aggregated global
    aggregate; ``stack`` unpivots its single row. ``new_records`` (e.g. the
    row count of :func:`strata.operators.scd2.new_in_last_load`) adds the
    new-records gauge.
    """
    last = rollup.agg(F.max_by(F.struct("status", "total_execution_seconds", "tracked_rows", "run_id"),
                               F.struct("finished_at", "run_id")).alias("l"))
    gauges = last.select(F.expr(
        "stack(3, 'run_success', CAST(CAST(l.status = 'success' AS INT) AS DOUBLE), "
        "'run_duration_seconds', CAST(l.total_execution_seconds AS DOUBLE), "
        "'tracked_rows_affected', CAST(l.tracked_rows AS DOUBLE)) AS (gauge, value)"))
    if new_records is None:
        return gauges
    extra = last.select(F.lit("new_records_total").alias("gauge"), F.lit(float(new_records)).alias("value"))
    return gauges.unionByName(extra)


@dataclass(frozen=True)
class Rule:
    """``metric <op> threshold`` held for ``for_seconds`` (Prometheus-style ``for``)."""
    alert: str
    metric: str
    op: str
    threshold: float
    for_seconds: float = RULE_FOR_SECONDS

    def holds(self, value: Column) -> Column:
        th = F.lit(self.threshold)
        return {"==": value == th, ">": value > th, "<": value < th,
                ">=": value >= th, "<=": value <= th, "!=": value != th}[self.op]


def alert_firings(history: DataFrame, rules: Sequence[Rule], metric: str = "metric",
                  ts: str = "ts", value: str = "value", hot=True) -> DataFrame:
    """Samples at which a rule fires (K4).

    A rule fires at a sample when its condition held at every sample of the
    metric in the last ``for_seconds`` and the metric's history reaches back at
    least that far: when the last sample at which it did not hold is older.

    That time is a running maximum, which needs no copies of rows. A hot metric
    is cut into time buckets: each bucket's own last time is folded over the
    buckets before it, and one row per bucket carries it back, so a row is
    shuffled once however long the rules reach.
    """
    mine = history.where(F.col(metric).isin(*{r.metric for r in rules}))
    if hot is True:
        hot = hot_keys(mine, [metric], ts)
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    off = {f"_r{i}": F.when(~F.coalesce(r.holds(F.col(value)), F.lit(False)) & (F.col(metric) == r.metric), at)
           for i, r in enumerate(rules)}
    seg = with_segments(mine.withColumns(off), [metric], ts, hot or None)
    part = [metric, SEG]
    summary = seg.groupBy(*part).agg(*[F.max(c).alias(c) for c in off], F.min(ts).alias("_first"))
    w = Window.partitionBy(metric).orderBy(SEG)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*part, *[F.max(c).over(earlier).alias(f"_c{c}") for c in off],
                           F.min("_first").over(Window.partitionBy(metric)).alias("_first"))
    local = Window.partitionBy(*part).orderBy(at).rangeBetween(Window.unboundedPreceding, 0)
    flagged = join_null_safe(seg.select(*part, ts, value, *[F.max(c).over(local).alias(c) for c in off]), carry, part)
    for i, r in enumerate(rules):
        last = F.greatest(F.col(f"_r{i}"), F.col(f"_c_r{i}"))
        held = last.isNull() | (last < at - int(round(r.for_seconds * 1_000_000)))
        flagged = flagged.withColumn(f"_r{i}", (F.col(metric) == r.metric) & held)
    # One pass: each sample carries the names of the rules firing at it.
    firing = [F.when(F.col(f"_r{i}") & (seconds_between("_first", ts) >= F.lit(r.for_seconds)),
                     F.lit(r.alert)) for i, r in enumerate(rules)]
    alerts = F.filter(F.array(*firing), lambda a: a.isNotNull())
    return (flagged.select(F.explode(alerts).alias("alert"), F.col(metric).alias("metric"),
                           F.col(ts).alias("fired_at"), F.col(value).cast("double").alias("observed")))


def stale_alerts(history: DataFrame, as_of: dt.datetime, key: str = "metric", ts: str = "ts",
                 max_age: float = STALE_SECONDS, for_seconds: float = STALE_FOR_SECONDS,
                 alert: str = "stale") -> DataFrame:
    """Keys whose newest sample is older than ``max_age`` for ``for_seconds`` (K4)."""
    now = F.lit(as_of).cast("timestamp_ntz")
    age = seconds_between(F.max(ts), now)
    g = history.groupBy(key).agg(age.alias("age"))
    return g.where(F.col("age") > F.lit(max_age + for_seconds)).select(
        F.lit(alert).alias("alert"), F.col(key).alias("metric"), now.alias("fired_at"),
        F.col("age").cast("double").alias("observed"))


def usage_hourly(usage: DataFrame, warehouse: str = "warehouse", ts: str = "ts",
                 credits: str = "credits") -> DataFrame:
    """Credits per warehouse and hour (K5)."""
    return (usage.groupBy(F.col(warehouse).alias("warehouse"), hour_of(ts).alias("usage_hour"))
            .agg(F.sum(credits).alias("credits_used"), F.count(F.lit(1)).alias("queries")))


def usage_recent(usage: DataFrame, as_of: dt.datetime, days: int = 7, ts: str = "ts",
                 credits: str = "credits", price_per_credit: float = 3.0) -> DataFrame:
    """Rows of the last ``days`` before ``as_of`` with their cost (K6).

    The bound is a literal, so it reaches the parquet scan.
    """
    start = as_of - dt.timedelta(days=days)
    return (usage.where((F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
                        & (F.col(ts) <= F.lit(as_of).cast("timestamp_ntz")))
            .withColumn("cost", F.col(credits) * F.lit(price_per_credit)))
