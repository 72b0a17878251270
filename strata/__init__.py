"""strata: medallion-style market-data analytics on Spark DataFrames.

Snapshot ingest, newest-row upserts, SCD type 2 history, OHLC candles,
moving averages and crossover signals, top-N rankings, declarative data
quality checks and run metrics, all as DataFrame -> DataFrame functions.

Entry points:

* ``strata.session.prepare(spark)``: the settings results depend on (UTC).
* ``strata.operators``: the operators (``indicators.signal_chain``,
  ``scd2.build`` / ``scd2.apply_batch``, ``dedup.latest``,
  ``upsert.latest_upsert``, ``quality.run_checks`` / ``gate``, ...).
* ``strata.sources``: snapshot ingest, table sinks, versioned tables.
* ``strata.streaming``: watermarked candles, snapshot and signal streams.
* ``strata.plans.refresh.Refresh``: one load or a backfill, end to end.
* ``strata.plans.catalog.queries()``: the registered queries with oracles.
"""

__version__ = "0.1.0"
