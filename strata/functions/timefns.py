"""Time expressions.

All expressions stay JVM-side (no UDF). Source times are UTC wall time
stored as TIMESTAMP_NTZ; the session zone is pinned to UTC by
``strata.session.prepare`` so casts between NTZ and LTZ do not shift them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.exprs import col_of

# Fixed value: the text layout the reference writes timestamps in.
TEXT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def trunc_ntz(unit: str, c) -> Column:
    """``DATE_TRUNC(unit, ts)`` that keeps TIMESTAMP_NTZ (H1).

    Spark's ``date_trunc`` returns TIMESTAMP even for NTZ input; casting
    back under a UTC session zone restores the same wall time.
    """
    return F.date_trunc(unit, col_of(c)).cast("timestamp_ntz")


def hour_of(c) -> Column:
    return trunc_ntz("hour", c)


def try_ts(c) -> Column:
    """``TRY_TO_TIMESTAMP_NTZ``: unparsable text gives NULL (H2, A3).

    Each row is parsed on its own, so ISO text with and without fractional
    seconds, with ``T`` or a blank, and with a trailing ``Z`` (UTC) all
    parse; anything else becomes NULL instead of failing the job.
    """
    c = col_of(c)
    text = F.regexp_replace(F.trim(c.cast("string")), "(?i)z$|[+-]00:?00$", "")
    return text.try_cast("timestamp_ntz")


def to_seconds(c) -> Column:
    """Cut to whole seconds, keeping NTZ (A3)."""
    return trunc_ntz("second", c)


def strict_ts(c) -> Column:
    """``x::TIMESTAMP``: bad input raises under ANSI mode (H3)."""
    return col_of(c).cast("timestamp_ntz")


def format_ts(c) -> Column:
    """``strftime('%Y-%m-%d %H:%M:%S')`` (H8)."""
    return F.date_format(col_of(c), TEXT_TS_FORMAT)


def hour_boundaries(start, end) -> Column:
    """``DATEDIFF('hour', a, b)``: number of hour boundaries crossed (H4).

    10:59 -> 12:01 is 2, whereas whole elapsed hours would give 1.
    """
    return F.timestamp_diff("HOUR", hour_of(start), hour_of(end))


def seconds_between(start, end) -> Column:
    """Seconds from start to end as a double (K2), sub-second exact."""
    s, e = col_of(start), col_of(end)
    return (F.unix_micros(e.cast("timestamp")) - F.unix_micros(s.cast("timestamp"))) / F.lit(1e6)


def epoch_seconds(c) -> Column:
    return F.unix_micros(col_of(c).cast("timestamp")) / F.lit(1e6)
