"""Small column-expression helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def changed(new, old, null_safe: bool = True) -> Column:
    """Whether two known rows differ. ``null_safe=True`` treats two NULLs as equal and NULL vs value as a
    change; ``False`` is the three-valued form, where a NULL on either side
    is never "unequal".
    """
    new, old = col_of(new), col_of(old)
    if null_safe:
        return ~new.eqNullSafe(old)
    return new != old


def new_or_changed(new, old) -> Column:
    """``old IS NULL OR new <> old`` (B6); never NULL unless ``new`` alone is."""
    new, old = col_of(new), col_of(old)
    return old.isNull() | (new != old)


def same(new, old, null_safe: bool = True) -> Column:
    new, old = col_of(new), col_of(old)
    return new.eqNullSafe(old) if null_safe else (new == old)


def all_same(left: Iterable[Column], right: Iterable[Column], null_safe: bool = True) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right):
        out = out & same(a, b, null_safe)
    return out


def exact_avg(c, w: WindowSpec) -> Column:
    """``AVG(x) OVER w`` in double, added up in the order of the frame.

    A double ``avg`` over a sliding frame depends on the engine's summation
    order. A left fold over the frame's rows is the same in any engine, has no
    fixed scale (prices of 1e-9 and of 1e12 keep all their digits), and makes
    averages over identical frames compare equal (the crossover rule depends
    on equality in the first rows of a series). Meant for bounded frames.
    """
    frame = F.collect_list(col_of(c).cast("double")).over(w)
    n = F.count(c).over(w)
    return F.when(n > 0, F.aggregate(frame, F.lit(0.0), lambda total, x: total + x) / n)


def join_null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``cols`` where NULL matches NULL, keeping one copy of ``cols``.

    Grouping and window partitioning treat NULL as a key value; joins that
    bring per-key facts back must do the same.
    """
    cols = list(cols)
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in cols], *[c for c in right.columns if c not in cols])
    on = [left[c].eqNullSafe(r[f"_r_{c}"]) for c in cols]
    return left.join(r, on=on, how=how).drop(*[f"_r_{c}" for c in cols])
