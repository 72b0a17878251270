"""Run-metric queries (D5, K1-K6): events stand in for the model-run log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from strata.functions.timefns import trunc_ntz
from strata.operators import runmetrics as R
from strata.plans.bindings import table
from strata.plans.catalog import query

TRACKED_MODEL = "purchase"
STALE_AS_OF = dt.datetime(2024, 2, 1, 2, 0, 0)
USAGE_AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)
RULES = (R.Rule("ValueSpike", "purchase", ">", R.ROWS_SPIKE, R.RULE_FOR_SECONDS),
         R.Rule("ClickSpikeHour", "click", ">", R.ROWS_SPIKE, 3600.0),
         R.Rule("RunFailed", "error", "==", 0.0, R.RULE_FOR_SECONDS))


def model_runs(spark, sf_dir):
    """K1: each event is one model run: day = run, event type = model, 'error' = failed."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("run-"), F.date_format(trunc_ntz("day", "ts"), "yyyyMMdd")).alias("run_id"),
        F.col("event_type").alias("model_name"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
        F.col("value").alias("execution_time_seconds"),
        F.col("user_id").alias("rows_affected"),
        F.col("ts").alias("executed_at"))


_RUNS_SQL = """
SELECT 'run-' || strftime(date_trunc('day', ts), '%Y%m%d') AS run_id, event_type AS model_name,
       CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
       value AS execution_time_seconds, user_id AS rows_affected, ts AS executed_at
FROM events"""

_ROLLUP_SQL = f"""
SELECT run_id,
    sum(coalesce(execution_time_seconds, 0.0)) AS total_execution_seconds,
    CASE WHEN max(CASE WHEN coalesce(status IN ('success', 'pass'), FALSE) THEN 0 ELSE 1 END) = 1
         THEN 'failure' ELSE 'success' END AS status,
    CAST(coalesce(sum(CASE WHEN model_name = '{TRACKED_MODEL}' THEN rows_affected END), 0) AS BIGINT) AS tracked_rows,
    count(*) AS models,
    max(executed_at) AS finished_at
FROM ({_RUNS_SQL}) r GROUP BY run_id"""


@query("run_log", _RUNS_SQL)
def run_log(spark, sf_dir):
    """Model-run log rows as appended by each run."""
    return model_runs(spark, sf_dir)


@query("pipeline_runs", f"""
SELECT run_id, 'pipeline' AS job_name,
    CASE WHEN max(CASE WHEN coalesce(status IN ('success', 'pass'), FALSE) THEN 0 ELSE 1 END) = 1
         THEN 'failure' ELSE 'success' END AS status,
    min(executed_at) AS started_at, max(executed_at) AS finished_at,
    (epoch_us(max(executed_at)) - epoch_us(min(executed_at))) / 1e6 AS duration_seconds
FROM ({_RUNS_SQL}) r GROUP BY run_id
""")
def pipeline_runs(spark, sf_dir):
    """K2: one row per pipeline run with duration = end - start."""
    return R.pipeline_runs(model_runs(spark, sf_dir))


@query("run_rollup", _ROLLUP_SQL)
def run_rollup(spark, sf_dir):
    """Total execution time, worst status, tracked model rows per run."""
    return R.run_rollup(model_runs(spark, sf_dir), TRACKED_MODEL)


@query("run_gauges", f"""
WITH r AS ({_ROLLUP_SQL}),
l AS (SELECT * FROM r ORDER BY finished_at DESC, run_id DESC LIMIT 1)
SELECT 'run_success' AS gauge, CASE WHEN status = 'success' THEN 1.0 ELSE 0.0 END AS value FROM l
UNION ALL SELECT 'run_duration_seconds', CAST(total_execution_seconds AS DOUBLE) FROM l
UNION ALL SELECT 'tracked_rows_affected', CAST(tracked_rows AS DOUBLE) FROM l
""")
def run_gauges(spark, sf_dir):
    """K3: gauges of the newest run, unpivoted."""
    return R.last_run_gauges(R.run_rollup(model_runs(spark, sf_dir), TRACKED_MODEL))


def _rule_sql(i: int, r: R.Rule) -> str:
    return (f"SELECT '{r.alert}' AS alert, metric, ts AS fired_at, CAST(value AS DOUBLE) AS observed "
            f"FROM w WHERE metric = '{r.metric}' AND r{i} "
            f"AND (epoch_us(ts) - epoch_us(first_ts)) / 1e6 >= {r.for_seconds}")


_METRICS_IN = ", ".join(sorted({f"'{r.metric}'" for r in RULES}))
_ALERT_SQL = f"""
WITH h AS (SELECT event_type AS metric, ts, value FROM events WHERE event_type IN ({_METRICS_IN})),
f AS (SELECT metric, min(ts) AS first_ts FROM h GROUP BY metric),
w AS (
    SELECT h.*, f.first_ts,
    {", ".join(
        f"coalesce(bool_and(coalesce(value {r.op if r.op != '==' else '='} {r.threshold}, FALSE)) OVER ("
        f"PARTITION BY metric ORDER BY epoch_us(ts) RANGE BETWEEN {int(r.for_seconds * 1_000_000)} PRECEDING AND CURRENT ROW), FALSE) AS r{i}"
        for i, r in enumerate(RULES))}
    FROM h JOIN f USING (metric)
)
{" UNION ALL ".join(_rule_sql(i, r) for i, r in enumerate(RULES))}
UNION ALL
SELECT 'stale' AS alert, event_type AS metric, TIMESTAMP '{STALE_AS_OF:%Y-%m-%d %H:%M:%S}' AS fired_at,
       CAST((epoch_us(TIMESTAMP '{STALE_AS_OF:%Y-%m-%d %H:%M:%S}') - epoch_us(max(ts))) / 1e6 AS DOUBLE) AS observed
FROM events GROUP BY event_type
HAVING (epoch_us(TIMESTAMP '{STALE_AS_OF:%Y-%m-%d %H:%M:%S}') - epoch_us(max(ts))) / 1e6 > {R.STALE_SECONDS + R.STALE_FOR_SECONDS}
"""


@query("alert_eval", _ALERT_SQL)
def alert_eval(spark, sf_dir):
    """K4: threshold rules held for a duration, plus staleness."""
    e = table(spark, sf_dir, "events")
    hist = e.select(F.col("event_type").alias("metric"), "ts", "value")
    return R.alert_firings(hist, RULES).unionByName(R.stale_alerts(hist, STALE_AS_OF))


def _usage(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("warehouse"), "ts", F.col("value").alias("credits"),
                    F.col("event_id").alias("query_id"))


@query("usage_hourly", """
SELECT event_type AS warehouse, date_trunc('hour', ts) AS usage_hour,
       sum(value) AS credits_used, count(*) AS queries
FROM events GROUP BY ALL
""")
def usage_hourly(spark, sf_dir):
    """K5: credits per warehouse and hour."""
    return R.usage_hourly(_usage(spark, sf_dir))


@query("usage_recent", f"""
SELECT event_type AS warehouse, ts, value AS credits, event_id AS query_id, value * 3.0 AS cost
FROM events
WHERE ts >= TIMESTAMP '{USAGE_AS_OF - dt.timedelta(days=7):%Y-%m-%d %H:%M:%S}'
  AND ts <= TIMESTAMP '{USAGE_AS_OF:%Y-%m-%d %H:%M:%S}'
""")
def usage_recent(spark, sf_dir):
    """K6: the last 7 days before as_of with cost."""
    return R.usage_recent(_usage(spark, sf_dir), USAGE_AS_OF)
