"""Slowly changing dimension, type 2.

History rows carry ``valid_from``, ``valid_to`` (NULL while open) and
``is_current``; intervals are half-open ``[valid_from, valid_to)`` because
the closing load's time is both the old row's end and the new row's start.

* :func:`apply_batch` is one load: close current rows whose tracked
  columns changed, insert new and changed keys, leave equal ones alone;
  then MERGE the inserts by ``(key, valid_from)``. Ids missing from a
  load stay current. Re-applying the same load changes nothing.
* :func:`build` produces the same history from a whole change log in one
  pass (backfill): LAG finds changes, LEAD closes them. Both windows run
  through :mod:`strata.operators.sequence`, so a hot key is split.
* :func:`new_in_last_load` lists the current rows opened by the newest load.

``null_safe=True`` (default) compares tracked values with ``<=>``: two
NULLs are equal. ``null_safe=False`` reproduces the reference's
three-valued comparison, where a NULL tracked value never matches, so
every load adds another current row for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.exprs import all_same, changed, names
from strata.operators.sequence import hot_keys, over_sequence

VALID_FROM, VALID_TO, IS_CURRENT = "valid_from", "valid_to", "is_current"


def _any_changed(new: Sequence[Column], old: Sequence[Column], null_safe: bool) -> Column:
    out = F.lit(False)
    for a, b in zip(new, old):
        out = out | changed(a, b, null_safe)
    return out


def open_rows(batch: DataFrame, columns: Sequence[str], load_col: str = "load_time") -> DataFrame:
    """Batch rows as new open versions (B3): valid_from = load time."""
    return batch.select(*columns, F.col(load_col).cast("timestamp_ntz").alias(VALID_FROM),
                        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
                        F.lit(True).alias(IS_CURRENT))


def apply_batch(history: DataFrame | None, batch: DataFrame, key: str | Sequence[str],
                tracked: str | Sequence[str], columns: Sequence[str] | None = None,
                load_col: str = "load_time", null_safe: bool = True) -> DataFrame:
    """History after one load (I4).

    ``batch`` holds at most one row per key (the newest-row table of the
    load). ``columns`` are the attribute columns kept in history (default:
    batch columns except ``load_col``). ``history=None`` is the first load.
    """
    keys, tracked = names(key), names(tracked)
    columns = list(columns) if columns is not None else [c for c in batch.columns if c != load_col]
    inserts_all = open_rows(batch, columns, load_col)
    if history is None:
        return inserts_all
    hist_cols = [*columns, VALID_FROM, VALID_TO, IS_CURRENT]
    current = history.where(F.col(IS_CURRENT))
    closed = history.where(~F.col(IS_CURRENT))

    # Close changed current rows (UPDATE ... FROM on key, <> on tracked).
    b = batch.select(*[F.col(k).alias(f"_b_{k}") for k in keys],
                     *[F.col(t).alias(f"_b_{t}") for t in tracked],
                     F.col(load_col).cast("timestamp_ntz").alias("_b_load"))
    on = [current[k] == b[f"_b_{k}"] for k in keys]
    j = current.join(b, on=on, how="left")
    hit = F.col(f"_b_{keys[0]}").isNotNull() & _any_changed(
        [F.col(t) for t in tracked], [F.col(f"_b_{t}") for t in tracked], null_safe)
    updated = j.select(*columns, VALID_FROM,
                       F.when(hit, F.col("_b_load")).otherwise(F.col(VALID_TO)).alias(VALID_TO),
                       F.when(hit, F.lit(False)).otherwise(F.col(IS_CURRENT)).alias(IS_CURRENT))

    # Insert batch rows with no current row of equal (key, tracked).
    c = current.select(*[F.col(k).alias(f"_c_{k}") for k in keys],
                       *[F.col(t).alias(f"_c_{t}") for t in tracked])
    cond = [inserts_all[k] == c[f"_c_{k}"] for k in keys]
    cond.append(all_same([inserts_all[t] for t in tracked], [c[f"_c_{t}"] for t in tracked], null_safe))
    inserts = inserts_all.join(c, on=cond, how="left_anti")

    # C4: MERGE on (key, valid_from). Only rows opened at or after the
    # batch's earliest load time can match an insert, so closed history
    # older than that passes through without a join (no history shuffle).
    first_load = batch.agg(F.min(F.col(load_col).cast("timestamp_ntz")).alias("m")).first()["m"]
    if first_load is None:
        return closed.select(*hist_cols).unionByName(updated.select(*hist_cols))
    recent = F.col(VALID_FROM) >= F.lit(first_load)
    old = closed.where(~recent | F.col(VALID_FROM).isNull()).select(*hist_cols)
    touchable = closed.where(recent).select(*hist_cols).unionByName(updated.select(*hist_cols))
    kept = touchable.join(inserts.select(*keys, VALID_FROM), on=[*keys, VALID_FROM], how="left_anti")
    return old.unionByName(kept.select(*hist_cols)).unionByName(inserts.select(*hist_cols))


def build(log: DataFrame, key: str | Sequence[str], tracked: str | Sequence[str],
          columns: Sequence[str] | None = None, load_col: str = "load_time",
          tiebreak: Sequence[str] = (), hot=True) -> DataFrame:
    """History from a whole change log in one pass.

    ``log`` holds at most one row per (key, load) (dedup with
    :func:`strata.operators.dedup.latest` first if needed; ``tiebreak``
    orders any remaining ties). A row opens a version when it is the key's
    first or its tracked values differ (null-safe) from the previous row.
    """
    keys, tracked, tiebreak = names(key), names(tracked), list(tiebreak)
    columns = list(columns) if columns is not None else [
        c for c in log.columns if c not in (load_col, *tiebreak)]
    order = [load_col, *tiebreak]
    if hot is True:
        # Detect once on the log: a key's versions are a subset of its rows,
        # and valid_from takes the load_col values the segments were cut on.
        hot = hot_keys(log, keys, load_col)

    def mark(d, part):
        w = Window.partitionBy(*part).orderBy(*order)
        first = F.lag(F.lit(1)).over(w).isNull()  # not row_number(): segments see local rows
        diff = _any_changed([F.col(t) for t in tracked], [F.lag(t).over(w) for t in tracked], True)
        return d.withColumn("_change", first | diff)

    marked = over_sequence(log, keys, order, mark, rows_before=1, time_col=load_col, hot=hot)
    versions = marked.where("_change").select(*columns, *tiebreak, F.col(load_col).cast("timestamp_ntz").alias(VALID_FROM))
    vorder = [VALID_FROM, *tiebreak]

    def close(d, part):
        w = Window.partitionBy(*part).orderBy(*vorder)
        nxt = F.lead(VALID_FROM).over(w)
        return d.withColumn(VALID_TO, nxt).withColumn(IS_CURRENT, nxt.isNull())

    out = over_sequence(versions, keys, vorder, close, rows_after=1, time_col=VALID_FROM, hot=hot)
    return out.select(*columns, VALID_FROM, VALID_TO, IS_CURRENT)


def newest_valid_from(history: DataFrame):
    """``SELECT MAX(valid_from)`` as a Python value (one partial aggregate)."""
    return history.agg(F.max(VALID_FROM).alias("m")).first()["m"]


def new_in_last_load(history: DataFrame, columns: Sequence[str], newest=None) -> DataFrame:
    """Current rows whose valid_from is the newest in the table.

    The scalar subquery is evaluated first and applied as a literal: on a
    stored history the equality prunes row groups, and the filter is not
    copied (with its subquery plan) into every branch of a union below it.
    """
    m = newest_valid_from(history) if newest is None else newest
    if m is None:
        return history.where(F.lit(False)).select(*columns)
    return history.where((F.col(VALID_FROM) == F.lit(m)) & F.col(IS_CURRENT)).select(*columns)


def one_current_violations(history: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys with a number of current rows other than one.

    Keys with no current row at all are not reported, as in the reference.
    """
    keys = names(key)
    return (history.where(F.col(IS_CURRENT)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_current"))
            .where(F.col("n_current") != 1))
