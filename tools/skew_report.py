"""Largest task of the signal chain with one hot key: plain windows vs segments.

Usage: python tools/skew_report.py [sf_dir]
Runs the hot-key binding (every view/click event on one key) twice, with
Spark's event log written to a fresh scratch folder, and prints the largest
task (shuffle records read, run time) of each run.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, ".")

from pyspark.sql import functions as F  # noqa: E402

from strata.operators import indicators  # noqa: E402
from strata.operators.sequence import hot_keys  # noqa: E402
from strata.session import local_session  # noqa: E402


def tasks_by_job(log_dir: str) -> dict:
    stage_job, out = {}, {}
    paths = sorted(p for p in glob.glob(f"{log_dir}/**/*", recursive=True) if not p.endswith("/")
                   and "appstatus" not in p and not p.endswith(".crc") and not os.path.isdir(p))
    for path in paths:
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = ev["Properties"].get("spark.job.description") or ev["Properties"].get("callSite.short", "")
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    label = stage_job.get(ev["Stage ID"], "")
                    cur = out.setdefault(label, {"max_records": 0, "max_run_ms": 0, "tasks": 0})
                    cur["max_records"] = max(cur["max_records"], recs)
                    cur["max_run_ms"] = max(cur["max_run_ms"], m.get("Executor Run Time", 0))
                    cur["tasks"] += 1
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="strata-eventlog-")
    # Partition coalescing is off so task sizes show where keys land (at this
    # scale AQE would otherwise merge every partition into one or two).
    spark = local_session(4, 16, app="skew-report", extra={
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false"})
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    t = e.select(F.when(F.col("event_type").isin("view", "click"), F.lit(-1)).otherwise(F.col("user_id"))
                 .cast("long").alias("id"), F.col("ts").alias("valid_from"),
                 F.col("value").alias("current_price"), "event_id")
    total = t.count()
    hot_n = t.where("id = -1").count()
    runs = {"plain": None, "segmented": hot_keys(t, ["id"], "valid_from", hot_rows=2_000, segment_rows=1_000)}
    for label, hot in runs.items():
        spark.sparkContext.setJobDescription(label)
        indicators.signal_chain(t, "id", "valid_from", "current_price", tiebreak=["event_id"],
                                hot=hot).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    spark.stop()
    stats = tasks_by_job(log_dir)
    print(json.dumps({"rows": total, "hot_key_rows": hot_n,
                      **{k: stats.get(k) for k in runs}}, indent=1))


if __name__ == "__main__":
    main()
