"""Snapshot files -> newest rows and SCD2 history per micro-batch.

A load may come in any number of micro-batches, and a micro-batch may hold
several loads. The batch function keeps the newest row per (key, load) and hands
it to the commit logs of the tables (:mod:`strata.sources.versioned`): rows of
the newest load are merged into it, rows of earlier loads are refused and
counted, or with ``late="merge"`` placed where they belong. A commit carries the
id of the stream and the epoch, so replaying a micro-batch after a failure
changes nothing, and a stream that starts again under a new checkpoint isn't
taken for a replay.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.dedup import latest
from strata.operators.upsert import merge_by_key
from strata.sources.versioned import _FMT, VersionedHistory, VersionedTable


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the stream writes into its checkpoint folder when it starts."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/metadata")
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def merge_newest(table: VersionedTable, newest: DataFrame, key: Sequence[str], order: Sequence[Column],
                 load_col: str = "load_time", late: str = "refuse", epoch: str | None = None) -> int:
    """Merge ``newest`` (one row per key and load) into the newest-row table: the
    row of the latest load of a key, then the first by ``order``. Returns the
    number of rows refused as late; an epoch that is committed changes nothing."""
    if table.has_epoch(epoch):
        return 0
    prev, target = table.version(), table.read()
    refused = F.col(load_col).isNull()
    if prev is not None and late == "refuse":
        mark = F.lit(dt.datetime.strptime(prev, _FMT)).cast("timestamp_ntz")
        refused = refused | ((F.col(load_col) < mark) if epoch is not None else (F.col(load_col) <= mark))
    span = newest.agg(F.max(F.when(~refused, F.col(load_col))).alias("high"), F.count_if(refused).alias("late")).first()
    if span["high"] is None:
        return span["late"]
    by_load = [F.col(load_col).desc_nulls_last(), *order]
    rows = latest(newest.where(~refused), key, by_load)
    if target is not None:
        own = target.join(rows.select(*key), on=list(key), how="left_semi").select(*target.columns)
        rows = latest(rows.unionByName(own, allowMissingColumns=True), key, by_load)
        rows = merge_by_key(target, rows, key)
    table.write(rows, span["high"], epoch=epoch, past=late == "merge")
    return span["late"]


def foreach_load(store: VersionedHistory | None, key: Sequence[str], order: Sequence[Column],
                 load_col: str = "load_time", tiebreak: Sequence[str] = (),
                 newest_table: VersionedTable | None = None,
                 late: str = "refuse", stream: Callable[[], str] = lambda: "stream",
                 report: list[dict] | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function applying each micro-batch.

    ``newest_table`` receives the newest row per key (latest load first,
    then ``order`` inside a load); ``store`` the SCD2 history. One entry per
    micro-batch goes to ``report``: epoch, refused rows, rows closed and opened.
    """
    if store is not None and not store.order:
        store.order = list(order)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        epoch = f"{stream()}-{epoch_id:010d}"
        # The batch function runs several jobs (bounds, writes); keep the
        # deduplicated micro-batch instead of re-reading its files. A lost
        # cached block is recomputed from the micro-batch's lineage.
        newest = latest(batch, [*key, load_col], order).persist()
        entry = {"epoch": epoch_id, "late_rows": 0, "closed": 0, "opened": 0}
        try:
            if newest_table is not None:
                entry["late_rows"] = merge_newest(newest_table, newest, key, order, load_col, late, epoch)
            if store is not None:
                done = store.apply_loads(newest, load_col, tiebreak, late=late, epoch=epoch)
                entry.update(late_rows=done["late_rows"], closed=done["closed"], opened=done["opened"])
        finally:
            newest.unpersist()
        if report is not None:
            report.append(entry)
    return apply


def run_snapshot_stream(spark: SparkSession, source: DataFrame, store: VersionedHistory | None,
                        key: Sequence[str], order: Sequence[Column], checkpoint: str,
                        load_col: str = "load_time", tiebreak: Sequence[str] = (),
                        newest_table: VersionedTable | None = None, late: str = "refuse") -> list[dict]:
    """Drain the snapshot stream into ``store``/``newest_table`` (availableNow) and
    stop; returns the report of its micro-batches, with the refused rows of each."""
    report: list[dict] = []
    batch = foreach_load(store, key, order, load_col, tiebreak, newest_table, late,
                         lambda: stream_id(spark, checkpoint), report)
    q = (source.writeStream.foreachBatch(batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover
        raise q.exception()
    return report
