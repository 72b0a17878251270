"""Top-N reports.

``orderBy(...).limit(n)`` is planned as ``TakeOrderedAndProject``: each
task keeps its own top n and the driver merges n x tasks rows, so no
global sort of the data happens. The limit is the feature here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.exprs import names

# Report sizes of the reference (gold ranking, feed page).
TOP_RANKS = 20
FEED_SIZE = 250


def top_n(df: DataFrame, n: int, order: Sequence[Column], columns: Sequence[str] | None = None) -> DataFrame:
    out = df.orderBy(*order).limit(n)
    return out.select(*columns) if columns else out


def lowest_ranks(df: DataFrame, rank: str = "market_cap_rank", key: str | Sequence[str] = "id",
                 n: int = TOP_RANKS, columns: Sequence[str] | None = None) -> DataFrame:
    """``ORDER BY rank ASC LIMIT n`` with NULL ranks last and a key tie-break."""
    order = [F.col(rank).asc_nulls_last(), *[F.col(k).asc() for k in names(key)]]
    return top_n(df, n, order, columns)


def feed_page(df: DataFrame, measure: str = "market_cap", key: str | Sequence[str] = "id",
              n: int = FEED_SIZE, columns: Sequence[str] | None = None) -> DataFrame:
    """``market_cap_desc`` page of the feed: largest first, NULLs last (A5)."""
    order = [F.col(measure).desc_nulls_last(), *[F.col(k).asc() for k in names(key)]]
    return top_n(df, n, order, columns)
