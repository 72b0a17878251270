"""Newest row per key and union-then-dedup.

``ROW_NUMBER() OVER (PARTITION BY key ORDER BY ...) = 1`` is planned by
Catalyst as a partial ``WindowGroupLimit`` before the shuffle and a final
one after it, so each map task sends at most one row per key: a hot key
costs one row per task, never its whole group.

Ordering follows the reference's warehouse: DESC puts NULLs *first*, so a
row with NULL ``last_updated`` wins. Callers pass explicit sort columns;
:func:`desc_first` builds the usual ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.exprs import names


def desc_first(*cols: str) -> list[Column]:
    """``c DESC`` with the warehouse's NULLS FIRST, for each column."""
    return [F.col(c).desc_nulls_first() for c in cols]


def rank_rows(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column],
              name: str = "rn") -> DataFrame:
    w = Window.partitionBy(*names(keys)).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w))


def latest(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column],
           keep_rn: bool = False) -> DataFrame:
    """First row per key under ``order``."""
    out = rank_rows(df, keys, order, "rn").where(F.col("rn") == 1)
    return out if keep_rn else out.drop("rn")


def union_dedup(frames: Sequence[DataFrame], keys: str | Sequence[str],
                order: Sequence[Column], columns: Sequence[str] | None = None) -> DataFrame:
    """``UNION ALL`` then one row per ``keys`` (G1 + E2, then ``EXCLUDE (rn)``)."""
    frames = list(frames)
    cols = list(columns) if columns is not None else frames[0].columns
    u = frames[0].select(*cols)
    for f in frames[1:]:
        u = u.unionByName(f.select(*cols))
    return latest(u, keys, order)
