"""Incremental newest-row upsert.

One load of the reference's incremental bronze model:

1. keep source rows strictly newer than the target's high-water mark
   (``load_time > coalesce(max(target.load_time), '1900-01-01')``);
2. newest row per key among them;
3. MERGE by key: matched target rows are replaced, others inserted;
4. ``sync_all_columns``: the result has the source's columns; columns new
   in the source are NULL on old rows, columns gone from it are dropped.

The high-water mark is computed first and applied as a literal, so the
filter reaches the parquet scan (row-group and partition pruning) instead
of running as a join. The MERGE is an anti join plus union; the joined
side is the deduplicated batch (one row per key), which AQE broadcasts
when its measured size allows and shuffles otherwise.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.exprs import names
from strata.operators.dedup import latest

# Fixed value: the reference's default when the target is empty.
EMPTY_HWM = _dt.datetime(1900, 1, 1)


def high_water_mark(target: DataFrame | None, col: str = "load_time"):
    """``coalesce(max(col), '1900-01-01')`` of the target as a Python value (D3)."""
    if target is None:
        return EMPTY_HWM
    v = target.agg(F.max(col).alias("m")).first()["m"]
    return EMPTY_HWM if v is None else v


def newer_than(source: DataFrame, hwm, col: str = "load_time") -> DataFrame:
    """Strictly newer rows (B4); NULL ``col`` never passes."""
    return source.where(F.col(col) > F.lit(hwm))


def sync_columns(target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Reshape ``target`` to ``columns``: missing ones as NULL, extra ones dropped (A10)."""
    have = set(target.columns)
    return target.select(*[F.col(c) if c in have else F.lit(None).alias(c) for c in columns])


def merge_by_key(target: DataFrame, updates: DataFrame, keys: str | Sequence[str],
                 sync: bool = True) -> DataFrame:
    """MERGE: replace matched rows, insert the rest (C4).

    With ``sync`` the output takes the updates' columns (sync_all_columns);
    types of columns added to the target follow the updates.
    """
    keys = names(keys)
    kept = target.join(updates.select(*keys), on=keys, how="left_anti").select(*target.columns)
    if sync:
        kept = sync_columns(kept, updates.columns)
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in updates.schema.fields]
        return kept.select(*typed).unionByName(updates)
    return kept.unionByName(updates, allowMissingColumns=True)


def latest_upsert(source: DataFrame, target: DataFrame | None, keys: str | Sequence[str],
                  order: Sequence[Column], load_col: str = "load_time",
                  hwm=None) -> DataFrame:
    """One incremental load of the newest-row table.

    ``target=None`` is the first (full) load: no high-water mark filter.
    ``hwm`` may be given to skip the max() job.
    """
    if target is None:
        return latest(source, keys, order)
    mark = high_water_mark(target, load_col) if hwm is None else hwm
    batch = latest(newer_than(source, mark, load_col), keys, order)
    return merge_by_key(target, batch, keys)


def late_rows(source: DataFrame, hwm, col: str = "load_time") -> Column:
    """Condition for rows an incremental load drops silently (<= hwm or NULL)."""
    return ~F.coalesce(F.col(col) > F.lit(hwm), F.lit(False))
