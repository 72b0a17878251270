"""Ordered per-key window computations that survive hot keys.

Every time-series operator of the library (candles, moving averages,
crossover, SCD2 built from a change log, alert windows) is a window
``PARTITION BY key ORDER BY time`` whose frames are *bounded*: they look
at most ``rows_before`` rows back and ``rows_after`` rows ahead (LAG,
LEAD, ``ROWS n PRECEDING``). A plain ``Window.partitionBy(key)`` puts all
rows of a key into one task, so a key holding a third of the data would
serialise a third of the job. This module keeps the plain plan for
ordinary keys and splits hot keys:

1. ``hot_keys``: one partially aggregated pass gives rows and time span per
   key; keys above ``hot_rows`` are hot. Their number is at most
   ``total / hot_rows`` (a bound, checked before it is broadcast).
2. The rows of hot keys are range-partitioned by key and order and numbered in
   their key (:func:`positions`), so bursts and rows of one timestamp are
   spread like any others.
3. Segments are cut by count: row ``p`` lies in segment ``p / segment_rows``,
   and is copied into the segments whose frames reach it, which its number
   alone tells. No segment holds more than ``segment_rows`` plus the reach of
   the frames. Other keys get segment NULL.
4. The caller's window expressions run over ``(key, segment)`` and the
   copies are dropped again.

RANGE frames reach back in time, not in rows: for them segments are uniform
time buckets over the key's own span (:func:`with_segments`), and rows are
copied into the buckets their span reaches.

The computation handed in (``compute``) must use only frames bounded by
``rows_before``/``rows_after``: ROW_NUMBER or unbounded frames would see
segment-local positions.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.exprs import names
from strata.session import scratch_path

SEG = "_seg"
OVL = "_ovl"
_T = "_t"
# Segment of a hot key's rows with a NULL time: below every real bucket, as
# NULLs sort first in the ascending order inside a key.
NULL_TIME_SEG = -(1 << 62)

# Defaults; override per call or with the session settings
# ``spark.strata.sequence.hotRows`` / ``.segmentRows`` / ``.maxHotKeys``.
HOT_ROWS = 4_000_000
SEGMENT_ROWS = 1_000_000
MAX_HOT_KEYS = 100_000

Compute = Callable[[DataFrame, list[str]], DataFrame]


def _conf_int(df: DataFrame, key: str, default: int) -> int:
    try:
        v = df.sparkSession.conf.get(f"spark.strata.sequence.{key}", None)
    except Exception:  # pragma: no cover - conf access on connect sessions
        v = None
    return int(v) if v else default


def time_scale(df: DataFrame, col: str) -> float:
    """Units of :func:`time_value` per second of a time column (1 otherwise)."""
    dt = df.schema[col].dataType
    return 1e6 if isinstance(dt, (T.TimestampType, T.TimestampNTZType)) else 1.0


def time_value(df: DataFrame, col: str) -> Column:
    """The ordering column as a number: epoch micros for times, else itself."""
    dt = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("long")
    return c.cast("double")


@dataclass(frozen=True)
class HotKeys:
    """Hot keys with the rows of a segment, and the origin and width of time segments.

    ``small`` is true when the frame was built from at most
    ``max_hot_keys`` collected rows and may be broadcast.
    """
    frame: DataFrame
    small: bool
    segment_rows: int = SEGMENT_ROWS


def hot_keys(df: DataFrame, keys: Sequence[str], time_col: str,
             hot_rows: int | None = None, segment_rows: int | None = None,
             max_hot_keys: int | None = None) -> HotKeys | None:
    """Keys with more than ``hot_rows`` rows, or ``None`` when there are none.

    The aggregate is partial (one row per key and map task before the
    shuffle). At most ``max_hot_keys`` rows come back to the driver; past
    that bound the aggregated DataFrame itself is used, without a
    broadcast hint.
    """
    keys = names(keys)
    hot_rows = hot_rows or _conf_int(df, "hotRows", HOT_ROWS)
    segment_rows = segment_rows or _conf_int(df, "segmentRows", SEGMENT_ROWS)
    max_hot_keys = max_hot_keys or _conf_int(df, "maxHotKeys", MAX_HOT_KEYS)
    t = time_value(df, time_col)
    stats = (df.select(*keys, t.alias(_T))
             .groupBy(*keys)
             .agg(F.count(F.lit(1)).alias("_n"), F.min(_T).alias("_min"), F.max(_T).alias("_max"))
             .where(F.col("_n") > F.lit(hot_rows)))
    # Uniform buckets over the key's own span, about segment_rows each.
    n_seg = F.ceil(F.col("_n") / F.lit(segment_rows))
    width = F.greatest(F.lit(1.0), F.ceil((F.col("_max") - F.col("_min") + F.lit(1)) / n_seg))
    stats = stats.select(*keys, F.col("_min").cast("double").alias("_min"),
                         width.cast("double").alias("_width"))
    found = stats.limit(max_hot_keys + 1).collect()
    if not found:
        return None
    if len(found) <= max_hot_keys:
        return HotKeys(df.sparkSession.createDataFrame(found, stats.schema), True, segment_rows)
    return HotKeys(stats, False, segment_rows)


def with_segments(df: DataFrame, keys: Sequence[str], time_col: str, hot: HotKeys | None) -> DataFrame:
    """Attach ``_seg``: NULL for ordinary keys, a time bucket for hot keys."""
    keys = names(keys)
    if hot is None:
        return df.withColumn(SEG, F.lit(None).cast("long"))
    side = hot.frame.select(*[F.col(k).alias(f"_hk_{k}") for k in keys], "_min", "_width")
    side = F.broadcast(side) if hot.small else side
    t = time_value(df, time_col)
    # Null-safe: a NULL key can be the hot one too.
    on = [df[k].eqNullSafe(side[f"_hk_{k}"]) for k in keys]
    joined = df.join(side, on=on, how="left").drop(*[f"_hk_{k}" for k in keys])
    seg = (F.when(F.col("_width").isNull(), F.lit(None))
           .when(t.isNull(), F.lit(NULL_TIME_SEG))
           .otherwise(F.floor((t - F.col("_min")) / F.col("_width"))))
    return joined.withColumn(SEG, seg.cast("long"))


def _range_overlap(seg_df: DataFrame, t: Column, span: float) -> DataFrame:
    """Copies of rows into later segments whose RANGE frame reaches back to them.

    Segment b' starts at ``_min + b' * _width``; a row at ``t`` is inside
    its frame when ``t >= start(b') - span``.
    """
    last = F.floor((t + F.lit(span) - F.col("_min")) / F.col("_width")).cast("long")
    first = F.col(SEG) + F.lit(1)
    targets = F.when(last >= first, F.sequence(first, last))
    return (seg_df.where(F.col(SEG) != F.lit(NULL_TIME_SEG))
            .withColumn("_tgt", F.explode(targets))
            .withColumn(SEG, F.col("_tgt")).drop("_tgt"))


def _hot_rows(df: DataFrame, keys: list[str], hot: HotKeys, how: str) -> DataFrame:
    """Rows of hot keys (``left_semi``) or of the others (``left_anti``)."""
    side = hot.frame.select(F.struct(*keys).alias("_hk"))
    side = F.broadcast(side) if hot.small else side
    on = F.lit(True)
    for k in keys:
        on = on & df[k].eqNullSafe(F.col(f"_hk.{k}"))
    return df.join(side, on, how)


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``df`` with ``_pos``, the 0-based place of a row within its key, and
    ``_n``, the key's rows. A key of any size is spread over tasks: the rows are
    range-partitioned by key and order, numbered inside each partition (written
    once to the shared scratch folder) and shifted by the rows of their key in
    earlier partitions."""
    keys = names(keys)
    spark = df.sparkSession
    by = [F.col(k).asc_nulls_first() for k in keys] + [F.asc_nulls_first(o) if isinstance(o, str) else o for o in order]
    path = scratch_path(spark, f"sequence/{uuid.uuid4().hex}")
    numbered = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id())
    numbered.write.parquet(path)
    numbered = spark.read.schema(numbered.schema).parquet(path)
    part = F.shiftright("_id", 33)  # the partition, by the definition of the function
    counts = numbered.groupBy(*keys, part.alias("_part")).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_m"))
    w = Window.partitionBy(*keys)
    before = F.sum("_m").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = counts.select(F.struct(*keys, "_part", F.sum("_m").over(w).alias("n"),
                                    (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("by")).alias("_s"))
    on = part.eqNullSafe(F.col("_s._part"))
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_s.{k}"))
    return (numbered.join(shifts, on)
            .select(*df.columns, (F.col("_id") + F.col("_s.by")).alias("_pos"), F.col("_s.n").alias("_n")))


def _counted_segments(df: DataFrame, keys: list[str], order: list[Column], hot: HotKeys,
                      rows_before: int, rows_after: int) -> DataFrame:
    """Rows of hot keys in the segments that hold them or whose frames reach them."""
    size = hot.segment_rows
    at = positions(_hot_rows(df, keys, hot, "left_semi"), keys, order)
    own = F.floor(F.col("_pos") / size)
    first = F.greatest(F.floor((F.col("_pos") - rows_after) / size), F.lit(0))
    last = F.least(F.floor((F.col("_pos") + rows_before) / size), F.floor((F.col("_n") - 1) / size))
    return (at.select(*df.columns, own.alias("_own"), F.explode(F.sequence(first, last)).alias(SEG))
            .withColumn(OVL, F.col(SEG) != F.col("_own")).drop("_own"))


def over_sequence(df: DataFrame, keys: str | Sequence[str], order: Sequence[str | Column],
                  compute: Compute, *, rows_before: int = 0, rows_after: int = 0,
                  range_before: float = 0, time_col: str | None = None,
                  hot: HotKeys | None | bool = True,
                  hot_rows: int | None = None, segment_rows: int | None = None) -> DataFrame:
    """Run ``compute(df, partition_cols)`` with windows that split hot keys.

    ``order`` is the ascending order inside a key (make it unique with a
    tie-breaker); its first column (or ``time_col``) is the time of RANGE frames.
    ``range_before`` is the reach of a RANGE frame back in time (seconds
    for time columns, else the column's units).
    ``hot=True`` detects hot keys; pass ``None``/``False`` to skip the
    detection (keys known to be bounded) or a result of :func:`hot_keys`.
    """
    keys = names(keys)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    if time_col is None:
        if not isinstance(order[0], str):
            raise ValueError("pass time_col when the first order item is an expression")
        time_col = order[0]
    if hot is True:
        hot = hot_keys(df, keys, time_col, hot_rows=hot_rows, segment_rows=segment_rows)
    if hot is None or hot is False:
        # Ordinary keys: one exchange on the key; every window that
        # partitions by the key (or a superset) reuses it.
        return compute(df.repartition(*keys), keys)
    part = [*keys, SEG]
    if range_before:
        if rows_before or rows_after:
            raise ValueError("a frame reaches in rows or in time, not in both")
        seg_df = with_segments(df, keys, time_col, hot)
        span = float(range_before) * time_scale(df, time_col)
        extra = _range_overlap(seg_df.where(F.col(SEG).isNotNull()), time_value(df, time_col), span)
        both = (seg_df.withColumn(OVL, F.lit(False)).unionByName(extra.withColumn(OVL, F.lit(True)))
                .drop("_min", "_width"))
    else:
        cold = _hot_rows(df, keys, hot, "left_anti").withColumns({SEG: F.lit(None).cast("long"), OVL: F.lit(False)})
        both = cold.unionByName(_counted_segments(df, keys, order_cols, hot, rows_before, rows_after))
    out = compute(both.repartition(*part), part)
    return out.where(~F.col(OVL)).drop(SEG, OVL)
