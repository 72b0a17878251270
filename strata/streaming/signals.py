"""Moving averages and crossover signals on streamed candles.

Row-count windows are not allowed on streaming DataFrames, so signals are
computed per micro-batch of *closed* candles (the append output of
:func:`strata.streaming.candles.stream_candles`). A batch needs, per key,
only the last ``max(spans)`` candles already stored before its first new
candle. They are kept as a table of their own, the tails: each epoch writes the
last candles of every key, found from the tails before it and its own candles,
and the next one reads that folder alone. The work per batch is the batch plus
one bounded tail per key, however many epochs there have been.

Each micro-batch writes its candles, signals and tails into folders named by
its epoch id with overwrite, the tails last, and reads the newest tails of an
earlier epoch, so a replayed batch replaces its own output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.exprs import join_null_safe, names
from strata.operators import indicators
from strata.operators.sequence import over_sequence

NEW = "_new"


def incremental_signals(new: DataFrame, stored: DataFrame | None, key: str | Sequence[str] = "id",
                        order: str = "candle_time", value: str = "close",
                        spans: Sequence[int] = indicators.DEFAULT_SPANS) -> DataFrame:
    """Averages and signal for the rows of ``new``, continuing ``stored``.

    ``stored`` holds earlier candles of the same series (any keys); rows of
    ``new`` are later than the stored rows of their key.
    """
    keys = names(key)
    reach = max(spans)
    cols = [*keys, order, value]
    rows = new.select(*cols).withColumn(NEW, F.lit(True))
    if stored is not None:
        first = new.groupBy(*keys).agg(F.min(order).alias("_first"))
        before = join_null_safe(stored.select(*cols), first, keys).where(F.col(order) < F.col("_first"))
        w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
        tail = (before.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= reach)
                .select(*cols).withColumn(NEW, F.lit(False)))
        rows = tail.unionByName(rows)
    fast, slow = indicators.ma_name(min(spans)), indicators.ma_name(max(spans))

    def compute(d, part):
        d = indicators.add_moving_averages(d, part, [order], value, spans)
        return indicators.add_signal(d, part, [order], fast, slow)

    out = over_sequence(rows, keys, [order], compute, rows_before=reach, time_col=order)
    return out.where(F.col(NEW)).drop(NEW)


def foreach_signals(spark: SparkSession, root: str, key: str | Sequence[str] = "id",
                    spans: Sequence[int] = indicators.DEFAULT_SPANS):
    """``foreachBatch`` function: store closed candles and their signals under ``root``."""
    def apply(batch: DataFrame, epoch_id: int) -> None:
        new = batch.persist()
        try:
            if new.isEmpty():
                return
            stored = _tails(spark, root, epoch_id)
            sig = incremental_signals(new, stored, key, spans=spans)
            new.write.mode("overwrite").parquet(f"{root}/candles/epoch={epoch_id}")
            sig.write.mode("overwrite").parquet(f"{root}/signals/epoch={epoch_id}")
            next_tails(new, stored, key, spans=spans).write.mode("overwrite").parquet(f"{root}/tails/epoch={epoch_id}")
            _drop_tails(spark, root, epoch_id)
        finally:
            new.unpersist()
    return apply


def next_tails(new: DataFrame, stored: DataFrame | None, key: str | Sequence[str] = "id",
               order: str = "candle_time", value: str = "close",
               spans: Sequence[int] = indicators.DEFAULT_SPANS) -> DataFrame:
    """The last ``max(spans)`` candles of every key (a top-k, reduced before the shuffle)."""
    cols = [*names(key), order, value]
    rows = new.select(*cols) if stored is None else stored.select(*cols).unionByName(new.select(*cols))
    w = Window.partitionBy(*names(key)).orderBy(F.col(order).desc())
    return rows.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= max(spans)).select(*cols)


def _epochs(spark: SparkSession, path: str) -> list[int]:
    """Epochs with a complete folder under ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    folders = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("epoch=")]
    done = [f for f in folders if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))]
    return sorted(int(f.getName().split("=")[1]) for f in done)


def _tails(spark: SparkSession, root: str, epoch_id: int) -> DataFrame | None:
    """The tails of the newest epoch before ``epoch_id``."""
    earlier = [e for e in _epochs(spark, f"{root}/tails") if e < epoch_id]
    return spark.read.parquet(f"{root}/tails/epoch={earlier[-1]}") if earlier else None


def _drop_tails(spark: SparkSession, root: str, epoch_id: int, keep: int = 2) -> None:
    """Delete tails that no replay can read: the last epochs' stay."""
    for e in [e for e in _epochs(spark, f"{root}/tails") if e <= epoch_id][:-keep]:
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/tails/epoch={e}")
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return None
    return spark.read.parquet(path)


def run_signal_stream(spark: SparkSession, candles: DataFrame, root: str, checkpoint: str,
                      key: str | Sequence[str] = "id",
                      spans: Sequence[int] = indicators.DEFAULT_SPANS) -> DataFrame | None:
    """Drain a closed-candle stream into ``root`` and return the signals table."""
    q = (candles.writeStream.foreachBatch(foreach_signals(spark, root, key, spans))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover
        raise q.exception()
    out = _read(spark, f"{root}/signals")
    return None if out is None else out.drop("epoch")
