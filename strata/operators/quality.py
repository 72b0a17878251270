"""Declarative data-quality checks, suites and gates.

Every check yields rows of one shape::

    check_name, table_name, column_name, observed, threshold, severity, passed

Scalar checks (not_null, between, accepted_values, row_count, freshness)
are aggregate expressions; a suite fuses all of them for one table into a
single ``agg`` (one scan, partial aggregation) and unpivots the one-row
result into one row per check (``explode`` of an array of structs). Set checks (unique, compound unique, violations)
are their own grouped aggregations. Only the result rows (one per check)
ever reach the driver, in :func:`gate`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.timefns import hour_boundaries, seconds_between

RESULT_COLUMNS = ("check_name", "table_name", "column_name", "observed", "threshold", "severity", "passed")

# Thresholds the reference uses by default.
MIN_ROWS_AFTER_LOAD = 100
MIN_ROWS_BEFORE_MODELS = 50
FRESHNESS_MAX_HOURS = 2
SOURCE_WARN_HOURS = 1
SOURCE_ERROR_HOURS = 6


@dataclass(frozen=True)
class Check:
    """A check over one table.

    ``metric`` is an aggregate expression (scalar checks) or None for set
    checks, whose ``set_metric`` names the grouped computation. ``ok``
    turns the observed value into pass/fail.
    """
    name: str
    column: str | None
    threshold: float | None
    severity: str = "error"
    metric: Column | None = None
    ok: str = "eq"  # eq | le | ge
    set_metric: tuple | None = field(default=None, compare=False)  # (kind, columns) of set checks
    levels: tuple[float, float] | None = None  # (warn, error) of two-level checks
    label: str | None = None  # table_name of the result row (default: the table checked)

    def passed(self, observed: Column) -> Column:
        th = F.lit(self.threshold).cast("double")
        if self.ok == "eq":
            return F.coalesce(observed == th, F.lit(False))
        if self.ok == "le":
            return F.coalesce(observed <= th, F.lit(False))
        if self.ok == "ge":
            return F.coalesce(observed >= th, F.lit(False))
        raise ValueError(self.ok)


# -- scalar checks -------------------------------------------------------------

def not_null(col: str, severity: str = "error") -> Check:
    """No NULL in ``col`` (J1); an empty table passes."""
    return Check("not_null", col, 0, severity, F.count_if(F.col(col).isNull()), "eq")


def between(col: str, min_value: float | None = None, max_value: float | None = None,
            strict_min: bool = False, strict_max: bool = False, severity: str = "error") -> Check:
    """Values inside the bounds; NULLs are ignored."""
    c = F.col(col)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | ((c <= min_value) if strict_min else (c < min_value))
    if max_value is not None:
        bad = bad | ((c >= max_value) if strict_max else (c > max_value))
    return Check("between", col, 0, severity, F.count_if(c.isNotNull() & bad), "eq")


def accepted_values(col: str, values: Sequence, severity: str = "error") -> Check:
    """Every non-NULL value is in ``values``."""
    return Check("accepted_values", col, 0, severity, F.count_if(~F.col(col).isin(list(values))), "eq")


def row_count_min(n: int, severity: str = "error") -> Check:
    """At least ``n`` rows."""
    return Check("row_count_min", None, n, severity, F.count(F.lit(1)), "ge")


def row_count_eq(n: int, severity: str = "error") -> Check:
    """Exactly ``n`` rows (J7 on a violations result)."""
    return Check("row_count_eq", None, n, severity, F.count(F.lit(1)), "eq")


def _clock(as_of: dt.datetime | None) -> Column:
    """``as_of`` (UTC wall time), or the query's start time read in UTC (H5)."""
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")  # session zone is UTC
    return F.lit(as_of).cast("timestamp_ntz")


def freshness(col: str, as_of: dt.datetime | None = None, max_hours: int = FRESHNESS_MAX_HOURS,
              severity: str = "error") -> Check:
    """Hour boundaries from the newest ``col`` to ``as_of`` at most ``max_hours``.

    An empty table (max is NULL) fails. ``as_of`` is UTC, like the data;
    None means now.
    """
    newest = F.max(F.col(col).cast("timestamp_ntz"))
    return Check("freshness", col, max_hours, severity, hour_boundaries(newest, _clock(as_of)), "le")


def freshness_levels(col: str, as_of: dt.datetime | None = None, warn_hours: float = SOURCE_WARN_HOURS,
                     error_hours: float = SOURCE_ERROR_HOURS) -> Check:
    """Source freshness with two levels (J10): observed is the age in hours.

    The row's severity is the level reached (pass / warn / error); only
    error fails.
    """
    newest = F.max(F.col(col).cast("timestamp_ntz"))
    age = seconds_between(newest, _clock(as_of)) / F.lit(3600.0)
    return Check("freshness_levels", col, error_hours, "levels", age, "le",
                 levels=(warn_hours, error_hours))


# -- set checks ---------------------------------------------------------------

def unique(col: str, severity: str = "error") -> Check:
    """No repeated non-NULL value (J2); observed = number of repeated values."""
    return Check("unique", col, 0, severity, None, "eq", set_metric=("unique", [col]))


def unique_compound(cols: Sequence[str], severity: str = "error") -> Check:
    """Combinations unique (J4); rows whose columns are all NULL are skipped.

    Observed = rows belonging to a repeated combination.
    """
    cols = list(cols)
    return Check("unique_compound", ",".join(cols), 0, severity, None, "eq",
                 set_metric=("compound", cols))


def _set_observed(df: DataFrame, check: Check) -> DataFrame:
    kind, cols = check.set_metric
    g = df
    if kind == "unique":
        g = g.where(F.col(cols[0]).isNotNull())
        counted = g.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        return counted.agg(F.count(F.lit(1)).cast("double").alias("observed"))
    any_set = F.lit(False)
    for c in cols:
        any_set = any_set | F.col(c).isNotNull()
    counted = df.where(any_set).groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return counted.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("double").alias("observed"))


# -- running checks -------------------------------------------------------------

def _row(check: Check, table: str, observed: Column) -> list[Column]:
    table = check.label or table
    if check.levels is not None:
        warn, err = check.levels
        level = (F.when(observed.isNull() | (observed > F.lit(err)), F.lit("error"))
                 .when(observed > F.lit(warn), F.lit("warn")).otherwise(F.lit("pass")))
        return [F.lit(check.name).alias("check_name"), F.lit(table).alias("table_name"),
                F.lit(check.column).cast("string").alias("column_name"),
                observed.cast("double").alias("observed"),
                F.lit(check.threshold).cast("double").alias("threshold"),
                level.alias("severity"), (level != F.lit("error")).alias("passed")]
    return [F.lit(check.name).alias("check_name"), F.lit(table).alias("table_name"),
            F.lit(check.column).cast("string").alias("column_name"),
            observed.cast("double").alias("observed"),
            F.lit(check.threshold).cast("double").alias("threshold"),
            F.lit(check.severity).alias("severity"), check.passed(observed.cast("double")).alias("passed")]


def _fused_unique(df: DataFrame, checks: Sequence[Check], table: str) -> DataFrame:
    """Result rows of several single-column unique checks from one pass.

    Each row becomes one struct per check (the check's column in its own
    field, so no cast changes equality), one grouped count finds the
    repeated values of every check at once, with partial aggregation.
    """
    cols = [c.set_metric[1][0] for c in checks]
    structs = [F.struct(F.lit(i).alias("_i"),
                        *[(F.col(col) if j == i else F.lit(None).cast(df.schema[col].dataType)).alias(f"_v{j}")
                          for j, col in enumerate(cols)])
               for i in range(len(cols))]
    pairs = df.select(F.explode(F.array(*structs)).alias("p")).select("p.*")
    present = F.lit(False)
    for j in range(len(cols)):
        present = present | ((F.col("_i") == j) & F.col(f"_v{j}").isNotNull())
    dup = (pairs.where(present).groupBy("_i", *[f"_v{j}" for j in range(len(cols))])
           .agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
           .groupBy("_i").agg(F.count(F.lit(1)).alias("_dups")))
    # one row of metadata per check (a handful of rows), joined once
    meta = df.sparkSession.createDataFrame(
        [(i, c.name, c.label or table, c.column, float(c.threshold), c.severity) for i, c in enumerate(checks)],
        "_i int, check_name string, table_name string, column_name string, threshold double, severity string")
    observed = F.coalesce(F.col("_dups"), F.lit(0)).cast("double")
    return (meta.join(dup.withColumn("_i", F.col("_i").cast("int")), "_i", "left")
            .select("check_name", "table_name", "column_name", observed.alias("observed"), "threshold",
                    "severity", F.coalesce(observed == F.col("threshold"), F.lit(False)).alias("passed")))


def run_checks(df: DataFrame, checks: Sequence[Check], table: str, fuse_unique: bool = True) -> DataFrame:
    """Results of ``checks`` on ``df``: one fused aggregate for scalar checks,
    one fused grouped pass for single-column unique checks."""
    scalar = [c for c in checks if c.metric is not None]
    parts: list[DataFrame] = []
    uniques = [c for c in checks if c.metric is None and c.set_metric[0] == "unique"]
    if fuse_unique and len(uniques) > 1:
        parts.append(_fused_unique(df, uniques, table))
        checks = [c for c in checks if c not in uniques]
    if scalar:
        one = df.agg(*[c.metric.alias(f"_m{i}") for i, c in enumerate(scalar)])
        # unpivot: one row per check, each built from its own metric column
        rows = [F.struct(*_row(c, table, F.col(f"_m{i}"))) for i, c in enumerate(scalar)]
        parts.append(one.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
    for c in checks:
        if c.metric is None:
            parts.append(_set_observed(df, c).select(*_row(c, table, F.col("observed"))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_checks_by(df: DataFrame, checks: Sequence[Check], table: str, by: str) -> DataFrame:
    """Scalar checks per group of ``by`` (e.g. per load of a backfill) in one aggregate.

    Each result row's ``table_name`` is ``<table>@<group>``. Set checks are
    per-table only.
    """
    if any(c.metric is None for c in checks):
        raise ValueError("run_checks_by takes scalar checks only")
    g = df.groupBy(by).agg(*[c.metric.alias(f"_m{i}") for i, c in enumerate(checks)])
    rows = []
    for i, c in enumerate(checks):
        r = _row(c, table, F.col(f"_m{i}"))
        r[1] = F.concat(F.lit(f"{table}@"), F.col(by).cast("string")).alias("table_name")
        rows.append(F.struct(*r))
    return g.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def violations_check(violations: DataFrame, table: str, name: str = "violations",
                     expected: int = 0, severity: str = "error") -> DataFrame:
    """Row count of a violations query must equal ``expected``."""
    c = Check(name, None, expected, severity, F.count(F.lit(1)), "eq")
    return run_checks(violations, [c], table)


def suite(parts: Sequence[tuple[DataFrame, Sequence[Check], str]]) -> DataFrame:
    """Results of several tables' checks together."""
    frames = [run_checks(df, checks, table) for df, checks, table in parts]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


class QualityGateError(RuntimeError):
    pass


def gate(results: DataFrame, blocking: bool = True) -> list[dict]:
    """Failed checks as dicts; raise when blocking and any failed.

    Only the result rows (one per check) are collected.
    """
    failed = [r.asDict() for r in results.where(~F.col("passed")).collect()]
    if failed and blocking:
        raise QualityGateError(f"data quality checks failed: {failed}")
    return failed
