"""Data-quality queries (J1-J11) over lineitem, orders, events and SCD2 history."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.operators import scd2
from strata.plans.bindings import table
from strata.plans.catalog import query

AS_OF = dt.datetime(2024, 1, 31, 1, 30, 0)
_AS_OF_SQL = f"TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}'"
LINEITEM_COLS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
ORDER_STATUSES = ("F", "O")
ORDER_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _row_sql(check: str, tbl: str, col: str | None, observed: str, threshold: float,
             passed: str, severity: str = "'error'") -> str:
    c = f"'{col}'" if col is not None else "CAST(NULL AS VARCHAR)"
    return (f"SELECT '{check}' AS check_name, '{tbl}' AS table_name, {c} AS column_name, "
            f"CAST({observed} AS DOUBLE) AS observed, CAST({threshold} AS DOUBLE) AS threshold, "
            f"{severity} AS severity, {passed} AS passed")


def _scalar_sql(check: str, tbl: str, col: str | None, metric: str, threshold: float, cmp: str,
                src: str | None = None) -> str:
    src = src or tbl
    return (f"SELECT '{check}' AS check_name, '{tbl}' AS table_name, "
            + (f"'{col}'" if col is not None else "CAST(NULL AS VARCHAR)")
            + f" AS column_name, CAST(m AS DOUBLE) AS observed, CAST({threshold} AS DOUBLE) AS threshold, "
            f"'error' AS severity, coalesce(CAST(m AS DOUBLE) {cmp} {threshold}, FALSE) AS passed "
            f"FROM (SELECT {metric} AS m FROM {src}) x")


@query("check_not_null", "\nUNION ALL\n".join(
    _scalar_sql("not_null", "lineitem", c, f"count(*) FILTER (WHERE {c} IS NULL)", 0, "=")
    for c in LINEITEM_COLS))
def check_not_null(spark, sf_dir):
    """NULL counts of every lineitem column in one aggregate."""
    return Q.run_checks(table(spark, sf_dir, "lineitem"), [Q.not_null(c) for c in LINEITEM_COLS], "lineitem")


@query("check_unique", "\nUNION ALL\n".join(
    _scalar_sql("unique", "orders", c, "count(*)", 0, "=",
                f"(SELECT {c} FROM orders WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) d")
    for c in ("o_orderkey", "o_custkey")))
def check_unique(spark, sf_dir):
    """Repeated non-NULL values (orderkey unique, custkey not)."""
    return Q.run_checks(table(spark, sf_dir, "orders"), [Q.unique("o_orderkey"), Q.unique("o_custkey")], "orders")


def _in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


@query("check_accepted", "\nUNION ALL\n".join([
    _scalar_sql("accepted_values", "orders", "o_orderstatus",
                f"count(*) FILTER (WHERE NOT (o_orderstatus IN ({_in_list(ORDER_STATUSES)})))", 0, "="),
    _scalar_sql("accepted_values", "orders", "o_orderpriority",
                f"count(*) FILTER (WHERE NOT (o_orderpriority IN ({_in_list(ORDER_PRIORITIES)})))", 0, "="),
]))
def check_accepted(spark, sf_dir):
    """Accepted values; NULL passes (three-valued NOT IN)."""
    return Q.run_checks(table(spark, sf_dir, "orders"),
                        [Q.accepted_values("o_orderstatus", ORDER_STATUSES),
                         Q.accepted_values("o_orderpriority", ORDER_PRIORITIES)], "orders")


@query("check_compound_unique", _scalar_sql(
    "unique_compound", "lineitem", "l_orderkey,l_linenumber", "coalesce(sum(n), 0)", 0, "=",
    "(SELECT count(*) AS n FROM lineitem WHERE l_orderkey IS NOT NULL OR l_linenumber IS NOT NULL "
    "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) d"))
def check_compound_unique(spark, sf_dir):
    """Rows in repeated (l_orderkey, l_linenumber) combinations."""
    return Q.run_checks(table(spark, sf_dir, "lineitem"),
                        [Q.unique_compound(["l_orderkey", "l_linenumber"])], "lineitem")


@query("check_between", "\nUNION ALL\n".join([
    _scalar_sql("between", "lineitem", "l_extendedprice",
                "count(*) FILTER (WHERE l_extendedprice IS NOT NULL AND l_extendedprice <= 0)", 0, "="),
    _scalar_sql("between", "lineitem", "l_discount",
                "count(*) FILTER (WHERE l_discount IS NOT NULL AND (l_discount <= 0 OR l_discount > 0.1))", 0, "="),
]))
def check_between(spark, sf_dir):
    """Price > 0 (strict) and 0 < discount <= 0.1; NULLs ignored."""
    return Q.run_checks(table(spark, sf_dir, "lineitem"),
                        [Q.between("l_extendedprice", 0, strict_min=True),
                         Q.between("l_discount", 0, 0.1, strict_min=True)], "lineitem")


@query("check_row_count", "\nUNION ALL\n".join([
    _scalar_sql("row_count_min", "lineitem", None, "count(*)", Q.MIN_ROWS_AFTER_LOAD, ">="),
    _scalar_sql("row_count_min", "lineitem", None, "count(*)", Q.MIN_ROWS_BEFORE_MODELS, ">="),
    _scalar_sql("row_count_min", "region", None, "count(*)", Q.MIN_ROWS_BEFORE_MODELS, ">="),
]))
def check_row_count(spark, sf_dir):
    """Minimum row counts (100 after load, 50 before models)."""
    return Q.suite([
        (table(spark, sf_dir, "lineitem"),
         [Q.row_count_min(Q.MIN_ROWS_AFTER_LOAD), Q.row_count_min(Q.MIN_ROWS_BEFORE_MODELS)], "lineitem"),
        (table(spark, sf_dir, "region"), [Q.row_count_min(Q.MIN_ROWS_BEFORE_MODELS)], "region"),
    ])


@query("check_violations", _row_sql(
    "orphan_lineitems", "lineitem", None,
    "(SELECT count(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey))",
    0, "(SELECT count(*) FROM lineitem l WHERE NOT EXISTS "
       "(SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)) = 0"))
def check_violations(spark, sf_dir):
    """A violations query (lineitems without an order) must return no rows."""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    orphans = li.join(o, li.l_orderkey == o.o_orderkey, "left_anti")
    return Q.violations_check(orphans, "lineitem", "orphan_lineitems")


_HISTORY_SQL = """
    SELECT id, valid_to IS NULL AS is_current FROM (
        SELECT id, lead(load_time) OVER (PARTITION BY id ORDER BY load_time, event_id) AS valid_to
        FROM (
            SELECT *, lag(name) OVER w AS prev_name, row_number() OVER w AS rn
            FROM (SELECT user_id AS id, event_type AS name, ts AS load_time, event_id FROM events) s
            WINDOW w AS (PARTITION BY id ORDER BY load_time, event_id)
        ) m WHERE rn = 1 OR prev_name IS DISTINCT FROM name
    ) v"""


@query("check_one_current", _scalar_sql(
    "one_current_row_per_key", "scd2", "id", "count(*)", 0, "=",
    f"(SELECT id FROM ({_HISTORY_SQL}) h WHERE is_current GROUP BY id HAVING count(*) <> 1) d"))
def check_one_current(spark, sf_dir):
    """Keys with other than one current row in the built history."""
    e = table(spark, sf_dir, "events")
    log = e.select(F.col("user_id").alias("id"), F.col("event_type").alias("name"),
                   F.col("ts").alias("load_time"), "event_id")
    hist = scd2.build(log, "id", "name", ["id", "name"], tiebreak=["event_id"])
    return Q.violations_check(scd2.one_current_violations(hist, "id"), "scd2", "one_current_row_per_key") \
        .withColumn("column_name", F.lit("id"))


def _boundaries_sql(col: str) -> str:
    return f"date_diff('hour', date_trunc('hour', max({col})), date_trunc('hour', {_AS_OF_SQL}))"


@query("check_freshness", "\nUNION ALL\n".join([
    _scalar_sql("freshness", "events", "ts", _boundaries_sql("ts"), Q.FRESHNESS_MAX_HOURS, "<="),
    _scalar_sql("freshness", "orders", "o_orderdate", _boundaries_sql("o_orderdate"), Q.FRESHNESS_MAX_HOURS, "<="),
]))
def check_freshness(spark, sf_dir):
    """Hour boundaries from the newest row to a fixed as_of, max 2."""
    return Q.suite([
        (table(spark, sf_dir, "events"), [Q.freshness("ts", AS_OF)], "events"),
        (table(spark, sf_dir, "orders"), [Q.freshness("o_orderdate", AS_OF)], "orders"),
    ])


def _levels_sql(tbl: str, col: str, as_of: str) -> str:
    age = f"((epoch_us({as_of}) - epoch_us(max({col}))) / 1e6 / 3600.0)"
    return (f"SELECT 'freshness_levels' AS check_name, '{tbl}' AS table_name, '{col}' AS column_name, "
            f"CAST(a AS DOUBLE) AS observed, CAST({Q.SOURCE_ERROR_HOURS} AS DOUBLE) AS threshold, "
            f"CASE WHEN a IS NULL OR a > {Q.SOURCE_ERROR_HOURS} THEN 'error' "
            f"WHEN a > {Q.SOURCE_WARN_HOURS} THEN 'warn' ELSE 'pass' END AS severity, "
            f"NOT (a IS NULL OR a > {Q.SOURCE_ERROR_HOURS}) AS passed "
            f"FROM (SELECT {age} AS a FROM {tbl}) x")


FRESH_AS_OF = [dt.datetime(2024, 1, 31, 0, 30), dt.datetime(2024, 1, 31, 3, 0), dt.datetime(2024, 2, 1, 0, 0)]


@query("check_freshness_levels", "\nUNION ALL\n".join(
    _levels_sql("events", "ts", f"TIMESTAMP '{a:%Y-%m-%d %H:%M:%S}'").replace(
        "'events' AS table_name", f"'events@{a:%Y-%m-%dT%H:%M}' AS table_name") for a in FRESH_AS_OF))
def check_freshness_levels(spark, sf_dir):
    """Warn after 1 h, error after 6 h, at three clock readings (one scan)."""
    e = table(spark, sf_dir, "events")
    checks = [replace(Q.freshness_levels("ts", a), label=f"events@{a:%Y-%m-%dT%H:%M}") for a in FRESH_AS_OF]
    return Q.run_checks(e, checks, "events")


_FEED = ("(SELECT user_id AS id, event_type AS name, value AS current_price, ts AS load_time FROM events) f")


@query("check_suite", "\nUNION ALL\n".join([
    _scalar_sql("not_null", "feed", "id", "count(*) FILTER (WHERE id IS NULL)", 0, "=", _FEED),
    _scalar_sql("not_null", "feed", "name", "count(*) FILTER (WHERE name IS NULL)", 0, "=", _FEED),
    _scalar_sql("not_null", "feed", "current_price", "count(*) FILTER (WHERE current_price IS NULL)", 0, "=", _FEED),
    _scalar_sql("between", "feed", "current_price",
                "count(*) FILTER (WHERE current_price IS NOT NULL AND current_price <= 0)", 0, "=", _FEED),
    _scalar_sql("row_count_min", "feed", None, "count(*)", Q.MIN_ROWS_BEFORE_MODELS, ">=", _FEED),
    _scalar_sql("row_count_min", "feed", None, "count(*)", Q.MIN_ROWS_AFTER_LOAD, ">=", _FEED),
    _scalar_sql("freshness", "feed", "load_time",
                _boundaries_sql("load_time"), Q.FRESHNESS_MAX_HOURS, "<=", _FEED),
    _scalar_sql("unique", "feed", "id", "count(*)", 0, "=",
                "(SELECT id FROM " + _FEED + " WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1) d"),
]))
def check_suite(spark, sf_dir):
    """The ingest suite (blocking) fused into one scan plus one grouped check."""
    e = table(spark, sf_dir, "events")
    feed = e.select(F.col("user_id").alias("id"), F.col("event_type").alias("name"),
                    F.col("value").alias("current_price"), F.col("ts").alias("load_time"))
    checks = [Q.not_null("id"), Q.not_null("name"), Q.not_null("current_price"),
              Q.between("current_price", 0, strict_min=True),
              Q.row_count_min(Q.MIN_ROWS_BEFORE_MODELS), Q.row_count_min(Q.MIN_ROWS_AFTER_LOAD),
              Q.freshness("load_time", AS_OF), Q.unique("id")]
    return Q.run_checks(feed, checks, "feed")
