"""One load of the whole medallion chain, in dependency order.

    snapshot files -> raw (bronze, replaced per load) -> quality gate
        -> incremental_raw (newest row per key, versioned)
        -> silver (raw UNION ALL incremental, one row per key and load)
        -> scd2 (versioned history) -> candles -> indicators -> signals (views)
        -> mkt_cap (top 20) ; run log + new-version report

Each step is one of the library's DataFrame functions; the tables live
under ``root/<layer>/<model>``. Every write is its own Spark job on the
cluster; the driver only holds scalars (row counts, the high-water mark,
check results, one row per check).

A load at or before the newest one is refused as a whole and leaves every table
alone; ``past=True`` places it instead: the newest-row table and the history end
as if all loads had come in order. Each run, failed ones too, leaves its steps,
its start and end by the clock, and its gauges in ``monitoring``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import dedup, indicators, ohlc, quality as Q, ranking, runmetrics, scd2, upsert
from strata.sources import snapshots, tables
from strata.sources.versioned import VersionedHistory, VersionedTable
from strata.streaming.snapshots import merge_newest

# The reference's history columns and tracked column (its
# running copy tracks the name; pass tracked=("current_price",) for price).
SCD2_COLUMNS = ("id", "symbol", "name", "current_price", "market_cap", "market_cap_rank", "total_volume")
RULES = (runmetrics.Rule("run_failed", "run_success", "==", 0, runmetrics.RULE_FOR_SECONDS),
         runmetrics.Rule("rows_spike", "tracked_rows_affected", ">", runmetrics.ROWS_SPIKE, runmetrics.RULE_FOR_SECONDS))
MKT_CAP_COLUMNS = ("id", "symbol", "name", "market_cap", "current_price", "market_cap_rank")


@dataclass
class LoadReport:
    load_time: dt.datetime
    rows_loaded: int = 0
    late_rows: int = 0
    scd2: dict = field(default_factory=dict)
    checks_failed: list = field(default_factory=list)
    history_checks_failed: list = field(default_factory=list)
    model_checks_failed: list = field(default_factory=list)
    warnings: list = field(default_factory=list)
    model_runs: list = field(default_factory=list)
    gauges: dict = field(default_factory=dict)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class Run:
    """Steps of one run with their real times, kept also when one fails."""

    def __init__(self, run_id: str):
        self.run_id, self.started, self.steps = run_id, _now(), []

    def step(self, name, fn, rows=lambda r: None, status=lambda r: "success"):
        t0 = _now()
        try:
            out = fn()
        except Exception:
            self._add(name, "error", t0, None)
            raise
        self._add(name, status(out), t0, rows(out))
        return out

    def _add(self, name, status, t0, n):
        end = _now()
        self.steps.append((self.run_id, name, status, (end - t0).total_seconds(), None if n is None else int(n), end))

    @property
    def ok(self) -> bool:
        return all(s[2] in runmetrics.OK_STATUSES for s in self.steps)


@dataclass
class Refresh:
    """``deep_checks`` tests candles and signals after every load too, which
    reads the whole history."""

    spark: SparkSession
    root: str
    tracked: Sequence[str] = ("name",)
    freshness_hours: int = Q.FRESHNESS_MAX_HOURS
    deep_checks: bool = True

    def path(self, layer: str, model: str) -> str:
        return tables.model_path(self.root, layer, model)

    @property
    def incremental(self) -> VersionedTable:
        return VersionedTable(self.spark, self.path("bronze", "incremental_raw"))

    @property
    def history(self) -> VersionedHistory:
        return VersionedHistory(self.spark, self.path("gold", "scd2"), "id", list(self.tracked),
                                list(SCD2_COLUMNS))

    def _within(self) -> list:
        """Order of the rows of one key and load, best first."""
        return dedup.desc_first("last_updated") + [F.col("total_volume").desc_nulls_last()]

    # -- steps ----------------------------------------------------------------
    def load_raw(self, files: str | Sequence[str], load_time: dt.datetime, report: LoadReport) -> DataFrame:
        raw = snapshots.ingest(self.spark, files, load_time)
        report.rows_loaded = tables.overwrite(raw, self.path("raw", "crypto_market_raw"), ["partition_date"])
        return self._partition(load_time.strftime("%Y-%m-%d"))

    def _partition(self, day: str) -> DataFrame:
        return (tables.read_table(self.spark, self.path("raw", "crypto_market_raw"))
                .where(F.col("partition_date") == day))

    def gate(self, raw: DataFrame, as_of: dt.datetime, report: LoadReport) -> DataFrame:
        """The blocking ingest checks (validation suite and governance), one fused
        scan; freshness is judged at ``as_of``."""
        checks = [Q.not_null("id"), Q.not_null("name"), Q.not_null("current_price"),
                  Q.between("current_price", 0, strict_min=True),
                  Q.row_count_min(Q.MIN_ROWS_BEFORE_MODELS), Q.row_count_min(Q.MIN_ROWS_AFTER_LOAD),
                  Q.freshness("load_time", as_of, self.freshness_hours)]
        results = Q.run_checks(raw, checks, "crypto_market_raw")
        report.checks_failed = Q.gate(results, blocking=True)
        return results

    def bronze(self, raw: DataFrame, load_time: dt.datetime, report: LoadReport, past: bool = False) -> DataFrame:
        """Merge the load into the newest-row table. A run that failed after this
        step and comes again finds its load there and leaves the table as it is."""
        cols = [*snapshots.EXPECTED_COLUMNS, "load_time"]
        per_load = dedup.latest(raw.select(*cols), ["id", "load_time"], self._within())
        if past or not self.incremental.is_late(load_time):
            report.late_rows = merge_newest(self.incremental, per_load, ["id"], self._within(),
                                            late="merge" if past else "refuse")
        return self.incremental.read()

    def silver(self, raw: DataFrame, incremental: DataFrame) -> int:
        cols = [*snapshots.EXPECTED_COLUMNS, "load_time"]
        order = dedup.desc_first("last_updated")
        out = dedup.union_dedup([raw.select(*cols), incremental.select(*cols)], ["id", "load_time"], order)
        return tables.overwrite(out, self.path("silver", "silver_crypto"))

    def gold_history(self, raw: DataFrame, load_time: dt.datetime, past: bool = False) -> dict:
        """Apply this load's newest row per id to the history.

        These are exactly the newest-row table's rows stamped with this load,
        taken from the load's own raw partition instead of scanning the
        whole newest-row table.
        """
        batch = dedup.latest(raw.select(*SCD2_COLUMNS, "last_updated"), "id", self._within())
        return self.history.apply_load(batch.select(*SCD2_COLUMNS), load_time, late="merge" if past else "refuse")

    def model_checks(self, raw: DataFrame, report: LoadReport) -> DataFrame:
        """Tests of every model after a load: keys and prices there, one row per
        id where there should be one, known signals. A raw load may hold an id
        twice or lack a market cap; that only warns. Failed ones don't stop the
        run, but it doesn't count as a success."""
        suites = [
            (raw, [Q.not_null("id"), Q.not_null("symbol"), Q.not_null("current_price"), Q.not_null("load_time"),
                   Q.unique("id", "warn"), Q.not_null("market_cap", "warn")], "raw_data"),
            (self.incremental_raw(), [Q.not_null("id"), Q.not_null("current_price")], "incremental_raw"),
            (self.silver_crypto(), [Q.not_null("id"), Q.unique("id"), Q.not_null("symbol"), Q.not_null("current_price")],
             "silver_crypto"),
            (self.mkt_cap(), [Q.not_null("id"), Q.not_null("market_cap_rank")], "mkt_cap")]
        if self.deep_checks:
            suites += [(self.candles(), [Q.not_null("id"), Q.not_null("candle_time")], "candles"),
                       (self.signals(), [Q.not_null("id"), Q.not_null("candle_time"),
                                         Q.accepted_values("signal", ["BUY", "SELL", "HOLD"])], "trading_signals")]
        results = Q.suite(suites)
        failed = Q.gate(results, blocking=False)
        report.model_checks_failed = [f for f in failed if f["severity"] != "warn"]
        report.warnings = [f for f in failed if f["severity"] == "warn"]
        return results

    def history_checks(self, report: LoadReport) -> DataFrame:
        """Non-blocking integrity of the history: one current row per id,
        not-null keys, unique (id, valid_from)."""
        h = self.history.read()
        results = Q.suite([
            (scd2.one_current_violations(h, "id"), [Q.row_count_eq(0)], "scd2_current_violations"),
            (h, [Q.not_null("id"), Q.not_null(scd2.VALID_FROM), Q.unique_compound(["id", scd2.VALID_FROM])],
             "scd2"),
        ])
        report.history_checks_failed = Q.gate(results, blocking=False)
        return results

    def finish(self, run: Run, report: LoadReport) -> None:
        """Append the steps, the run and its gauges, whatever came of it."""
        steps = self.spark.createDataFrame(run.steps, "run_id string, model_name string, status string, execution_time_seconds double, "
                                                      "rows_affected long, executed_at timestamp_ntz")
        tables.append(steps, self.path("monitoring", "model_runs"))
        end = _now()
        whole = [(run.run_id, "refresh", "success" if run.ok else "failure", run.started, end, (end - run.started).total_seconds())]
        tables.append(self.spark.createDataFrame(whole, "run_id string, job_name string, status string, started_at timestamp_ntz, "
                                                        "finished_at timestamp_ntz, duration_seconds double"),
                      self.path("monitoring", "pipeline_runs"))
        rollup = runmetrics.run_rollup(steps, "scd2")
        gauges = runmetrics.last_run_gauges(rollup, new_records=report.scd2.get("opened") or 0).collect()
        report.gauges = {r.gauge: r.value for r in gauges}
        report.model_runs = run.steps
        pushed = [(run.run_id, g, end, v) for g, v in report.gauges.items()]
        tables.append(self.spark.createDataFrame(pushed, "run_id string, metric string, ts timestamp_ntz, value double"),
                      self.path("monitoring", "gauges"))

    def alerts(self, as_of: dt.datetime | None = None) -> DataFrame:
        """Alerts firing at ``as_of`` (default: now). A gauge keeps its last value
        until the next run sets it."""
        now = F.lit(as_of or _now()).cast("timestamp_ntz")
        held = tables.read_table(self.spark, self.path("monitoring", "gauges")).where(F.col("ts") <= now)
        last = held.groupBy("metric").agg(F.max_by("value", "ts").alias("value")).select("metric", now.alias("ts"), "value")
        samples = held.select("metric", "ts", "value").unionByName(last)
        fired = runmetrics.alert_firings(samples, RULES).where(F.col("fired_at") == now)
        return fired.unionByName(runmetrics.stale_alerts(held, as_of or _now()))

    # -- models as DataFrames (tables read back, views lazy) ---------------------------
    def raw_data(self) -> DataFrame:
        return tables.read_table(self.spark, self.path("raw", "crypto_market_raw"))

    def incremental_raw(self) -> DataFrame | None:
        return self.incremental.read()

    def silver_crypto(self) -> DataFrame:
        return tables.read_table(self.spark, self.path("silver", "silver_crypto"))

    def scd2(self) -> DataFrame | None:
        return self.history.read()

    def candles(self) -> DataFrame:
        return ohlc.candle_rows(self.history.read(), "id", "valid_from", "current_price")

    def indicators(self) -> DataFrame:
        return indicators.signal_chain(self.history.read(), "id", "valid_from", "current_price",
                                       with_signal=False)

    def signals(self) -> DataFrame:
        h = self.history.read()
        return indicators.signal_chain(h, "id", "valid_from", "current_price")

    def mkt_cap(self) -> DataFrame:
        silver = tables.read_table(self.spark, self.path("silver", "silver_crypto"))
        return ranking.lowest_ranks(silver, "market_cap_rank", "id", ranking.TOP_RANKS, list(MKT_CAP_COLUMNS))

    def new_versions(self) -> DataFrame:
        return scd2.new_in_last_load(self.history.read(), ["id", "symbol", "name"])

    # -- one load ------------------------------------------------------------------
    def run(self, files: str | Sequence[str], load_time: dt.datetime, run_id: str | None = None,
            as_of: dt.datetime | None = None, past: bool = False) -> LoadReport:
        """One load through all models. ``as_of`` is the clock for the freshness
        check (default: just after the load, for data of past days); ``past``
        places a load that is older than the newest one."""
        report = LoadReport(load_time)
        run = Run(run_id or f"run-{load_time:%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}")
        try:
            if not past and self.history.is_late(load_time):
                self._refuse(run, files, load_time, report)
            else:
                self._load(run, files, load_time, as_of or load_time + dt.timedelta(minutes=1), past, report)
        finally:
            self.finish(run, report)
        return report

    def _refuse(self, run: Run, files, load_time: dt.datetime, report: LoadReport) -> None:
        """A late load: its rows are counted, no table is touched."""
        def count():
            report.rows_loaded = report.late_rows = snapshots.ingest(self.spark, files, load_time).count()
        run.step("raw", count, lambda _: 0)
        report.scd2 = {"version": self.history.version(), "late": True, "closed": 0, "opened": 0, "current": None}
        for name in ("quality_gate", "incremental_raw", "silver_crypto", "scd2", "model_checks"):
            run.step(name, lambda: None, lambda _: 0)

    def _load(self, run: Run, files, load_time: dt.datetime, as_of: dt.datetime, past: bool, report: LoadReport) -> None:
        raw = run.step("raw", lambda: self.load_raw(files, load_time, report), lambda _: report.rows_loaded)
        run.step("quality_gate", lambda: self.gate(raw, as_of, report))
        inc = run.step("incremental_raw", lambda: self.bronze(raw, load_time, report, past))
        run.step("silver_crypto", lambda: self.silver(self._newest_raw(), inc), lambda n: n)
        report.scd2 = run.step("scd2", lambda: self.gold_history(raw, load_time, past), _touched)
        run.step("model_checks", lambda: (self.history_checks(report), self.model_checks(raw, report)),
                 status=lambda _: "fail" if report.history_checks_failed or report.model_checks_failed else "pass")
        # Older full copies (current sets, newest-row tables) are dead weight.
        self.history.vacuum(keep=2)
        self.incremental.vacuum(keep=2)

    def _newest_raw(self) -> DataFrame:
        """The raw partition of the newest load, which silver starts from."""
        day = dt.datetime.strptime(self.incremental.version()[:8], "%Y%m%d")
        return self._partition(day.strftime("%Y-%m-%d"))

    # -- many loads at once ----------------------------------------------------------
    def backfill(self, landing: str, time_of_day: dt.time = dt.time(23, 59),
                 run_id: str | None = None, past: bool = False) -> LoadReport:
        """Load every ``snapshot_day=YYYY-MM-DD`` folder under ``landing`` in one pass.

        One job per layer instead of one run per day: the raw partitions are
        written together, the ingest checks run per load in one grouped
        aggregate, the newest-row table takes each id from the latest load
        that has it, and SCD2 applies all loads in one pass
        (:meth:`VersionedHistory.apply_loads`). The tables end as after the
        single loads. Freshness is not checked: past days are old by design.
        Days before the newest load need ``past=True``.
        """
        schema = T.StructType(snapshots.SNAPSHOT_SCHEMA.fields + [T.StructField("snapshot_day", T.StringType())])
        src = self.spark.read.schema(schema).json(landing)
        offset = time_of_day.hour * 3600 + time_of_day.minute * 60 + time_of_day.second
        load = (F.to_timestamp("snapshot_day", "yyyy-MM-dd") + F.make_interval(secs=F.lit(offset))).cast("timestamp_ntz")
        raw = (snapshots.normalise(src, keep=["snapshot_day"]).withColumn("load_time", load)
               .withColumnRenamed("snapshot_day", "partition_date"))
        span = raw.agg(F.min("load_time").alias("low"), F.max("load_time").alias("high")).first()
        report = LoadReport(span["high"])
        if span["high"] is None:
            return report
        if not past and self.history.is_late(span["low"]):
            raise ValueError(f"backfill from {span['low']} is not newer than the loaded data; pass past=True to place it")
        run = Run(run_id or f"backfill-{span['high']:%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}")
        try:
            self._load_days(run, raw, past, report)
        finally:
            self.finish(run, report)
        return report

    def _load_days(self, run: Run, raw: DataFrame, past: bool, report: LoadReport) -> None:
        late = "merge" if past else "refuse"

        def write():
            report.rows_loaded = tables.overwrite(raw, self.path("raw", "crypto_market_raw"), ["partition_date"])
            days = [r.partition_date for r in raw.select("partition_date").distinct().collect()]
            return (tables.read_table(self.spark, self.path("raw", "crypto_market_raw"))
                    .where(F.col("partition_date").isin(*days)))

        def gate():
            checks = [Q.not_null("id"), Q.not_null("name"), Q.not_null("current_price"),
                      Q.between("current_price", 0, strict_min=True),
                      Q.row_count_min(Q.MIN_ROWS_BEFORE_MODELS), Q.row_count_min(Q.MIN_ROWS_AFTER_LOAD)]
            report.checks_failed = Q.gate(Q.run_checks_by(loaded, checks, "crypto_market_raw", "partition_date"))

        def bronze():
            merge_newest(self.incremental, per_load, ["id"], self._within(), late=late)
            return self.incremental.read()
        loaded = run.step("raw", write, lambda _: report.rows_loaded)
        run.step("quality_gate", gate)
        cols = [*snapshots.EXPECTED_COLUMNS, "load_time"]
        per_load = dedup.latest(loaded.select(*cols), ["id", "load_time"], self._within())
        inc = run.step("incremental_raw", bronze)
        run.step("silver_crypto", lambda: self.silver(self._newest_raw(), inc), lambda n: n)
        report.scd2 = run.step("scd2", lambda: self.history.apply_loads(
            per_load.select(*SCD2_COLUMNS, "load_time"), late=late), _touched)
        run.step("model_checks", lambda: (self.history_checks(report), self.model_checks(self._newest_raw(), report)),
                 status=lambda _: "fail" if report.history_checks_failed or report.model_checks_failed else "pass")
        self.history.vacuum(keep=2)
        self.incremental.vacuum(keep=2)


def _touched(result: dict) -> int:
    """Rows a load opened or closed."""
    return result["opened"] + result["closed"]
