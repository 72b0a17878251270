"""Bronze/silver/gold history queries: dedup, upsert, SCD2, top-N, projections.

Bindings (see ``bindings.py``): ``events`` is the coin feed (id = user_id,
name/symbol = event_type, current_price = value, last_updated = ts);
``orders`` and ``customer`` serve as change log and ranked dimension.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.exprs import new_or_changed
from strata.functions.timefns import trunc_ntz
from strata.operators import dedup, ranking, scd2, upsert
from strata.plans.bindings import table
from strata.plans.catalog import query

# Fixed split points of the test bindings (inside the tables' ranges).
SILVER_RAW_BEFORE = "2024-01-20"      # raw slice: ts < this
SILVER_INC_FROM = "2024-01-10"        # incremental slice: ts >= this (overlap 10th-19th)
UPSERT_FIRST_LOAD_BEFORE = "2024-01-20"
SCD2_HISTORY_BEFORE = "2024-01-15"
SCD2_BATCH_LOAD = "2024-02-01 00:00:00"
ORDERS_SPLIT = "1999-01-01"


def _feed(spark, sf_dir):
    """events as feed rows with a daily load_time."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("id"), F.col("event_type").alias("name"),
                    F.col("value").alias("current_price"), F.col("ts").alias("last_updated"),
                    trunc_ntz("day", "ts").alias("load_time"), "event_id")


_FEED_SQL = ("SELECT user_id AS id, event_type AS name, value AS current_price, ts AS last_updated, "
             "date_trunc('day', ts) AS load_time, event_id FROM events")


def _newest():
    return dedup.desc_first("last_updated") + [F.col("event_id").desc()]

_NEWEST_SQL = "last_updated DESC NULLS FIRST, event_id DESC"


@query("latest_per_key", f"""
SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY {_NEWEST_SQL}) AS rn
    FROM ({_FEED_SQL}) f
) WHERE rn = 1
""")
def latest_per_key(spark, sf_dir):
    """Newest row per id, NULL last_updated first on DESC."""
    return dedup.latest(_feed(spark, sf_dir), "id", _newest())


@query("silver_dedup", f"""
WITH combined AS (
    SELECT * FROM ({_FEED_SQL}) r WHERE last_updated < TIMESTAMP '{SILVER_RAW_BEFORE}'
    UNION ALL
    SELECT * FROM ({_FEED_SQL}) i WHERE last_updated >= TIMESTAMP '{SILVER_INC_FROM}'
)
SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id, load_time ORDER BY {_NEWEST_SQL}) AS rn
    FROM combined
) WHERE rn = 1
""")
def silver_dedup(spark, sf_dir):
    """G1+E2+B2: raw UNION ALL incremental, one row per (id, load_time)."""
    f = _feed(spark, sf_dir)
    raw = f.where(F.col("last_updated") < F.lit(SILVER_RAW_BEFORE).cast("timestamp_ntz"))
    inc = f.where(F.col("last_updated") >= F.lit(SILVER_INC_FROM).cast("timestamp_ntz"))
    return dedup.union_dedup([raw, inc], ["id", "load_time"], _newest())


@query("latest_two_key_order", f"""
SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY load_time DESC NULLS FIRST, {_NEWEST_SQL}) AS rn
    FROM ({_FEED_SQL}) f
) WHERE rn = 1
""")
def latest_two_key_order(spark, sf_dir):
    """Newest per id by load_time DESC, then last_updated DESC."""
    order = dedup.desc_first("load_time", "last_updated") + [F.col("event_id").desc()]
    return dedup.latest(_feed(spark, sf_dir), "id", order)


# -- SCD2 -------------------------------------------------------------------

def _changelog(spark, sf_dir, where=None):
    e = table(spark, sf_dir, "events")
    if where is not None:
        e = e.where(where)
    return e.select(F.col("user_id").alias("id"), F.col("event_type").alias("name"),
                    F.col("value").alias("current_price"), F.col("ts").alias("load_time"), "event_id")


HIST_COLS = ["id", "name", "current_price"]


def _build_sql(where: str = "TRUE") -> str:
    return f"""
    SELECT id, name, current_price, valid_from, valid_to, valid_to IS NULL AS is_current FROM (
        SELECT id, name, current_price, load_time AS valid_from,
               lead(load_time) OVER (PARTITION BY id ORDER BY load_time, event_id) AS valid_to
        FROM (
            SELECT *, lag(name) OVER w AS prev_name, row_number() OVER w AS rn
            FROM (SELECT user_id AS id, event_type AS name, value AS current_price,
                         ts AS load_time, event_id FROM events WHERE {where}) s
            WINDOW w AS (PARTITION BY id ORDER BY load_time, event_id)
        ) m
        WHERE rn = 1 OR prev_name IS DISTINCT FROM name
    ) v"""


@query("scd2_build", _build_sql())
def scd2_build(spark, sf_dir):
    """Whole change log -> versions (lag for changes, lead for valid_to)."""
    return scd2.build(_changelog(spark, sf_dir), "id", "name", HIST_COLS, tiebreak=["event_id"])


def history_and_batch(spark, sf_dir):
    """History before the cut (materialised, as a stored gold table would be) and the next load."""
    cut = F.col("ts") < F.lit(SCD2_HISTORY_BEFORE).cast("timestamp_ntz")
    # Reliable checkpoint into the session's shared checkpoint folder: the
    # history is read by three branches of the merge, and lineage is cut.
    hist = scd2.build(_changelog(spark, sf_dir, cut), "id", "name", HIST_COLS,
                      tiebreak=["event_id"]).checkpoint(eager=True)
    later = _changelog(spark, sf_dir, ~cut)
    batch = (dedup.latest(later, "id", dedup.desc_first("load_time") + [F.col("event_id").desc()])
             .select(*HIST_COLS, F.lit(SCD2_BATCH_LOAD).cast("timestamp_ntz").alias("load_time")))
    return hist, batch


APPLY_SQL = f"""
WITH hist AS ({_build_sql(f"ts < TIMESTAMP '{SCD2_HISTORY_BEFORE}'")}),
batch AS (
    SELECT id, name, current_price, TIMESTAMP '{SCD2_BATCH_LOAD}' AS load_time FROM (
        SELECT user_id AS id, event_type AS name, value AS current_price,
               row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC) AS rn
        FROM events WHERE ts >= TIMESTAMP '{SCD2_HISTORY_BEFORE}'
    ) x WHERE rn = 1
),
cur AS (SELECT * FROM hist WHERE is_current),
updated AS (
    SELECT c.id, c.name, c.current_price, c.valid_from,
        CASE WHEN b.id IS NOT NULL AND c.name IS DISTINCT FROM b.name THEN b.load_time ELSE c.valid_to END AS valid_to,
        CASE WHEN b.id IS NOT NULL AND c.name IS DISTINCT FROM b.name THEN FALSE ELSE c.is_current END AS is_current
    FROM cur c LEFT JOIN batch b ON c.id = b.id
),
inserts AS (
    SELECT b.id, b.name, b.current_price, b.load_time AS valid_from,
           CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
    FROM batch b
    WHERE NOT EXISTS (SELECT 1 FROM cur c WHERE c.id = b.id AND c.name IS NOT DISTINCT FROM b.name)
),
before AS (SELECT * FROM hist WHERE NOT is_current UNION ALL SELECT * FROM updated)
SELECT * FROM before a
WHERE NOT EXISTS (SELECT 1 FROM inserts i WHERE i.id = a.id AND i.valid_from = a.valid_from)
UNION ALL
SELECT * FROM inserts
"""


@query("scd2_apply", APPLY_SQL)
def scd2_apply(spark, sf_dir):
    """I4: history up to day 15, then one load of each id's newest later row."""
    hist, batch = history_and_batch(spark, sf_dir)
    return scd2.apply_batch(hist, batch, "id", "name", HIST_COLS)


@query("scd2_new_versions", f"""
WITH h AS ({APPLY_SQL})
SELECT id, name, valid_from FROM h
WHERE valid_from = (SELECT max(valid_from) FROM h) AND is_current
""")
def scd2_new_versions(spark, sf_dir):
    """Current rows opened by the newest load."""
    hist, batch = history_and_batch(spark, sf_dir)
    h = scd2.apply_batch(hist, batch, "id", "name", HIST_COLS).checkpoint(eager=True)
    return scd2.new_in_last_load(h, ["id", "name", "valid_from"])


# -- Incremental upsert and schema sync --------------------------------------

@query("incremental_upsert", f"""
WITH src AS ({_FEED_SQL}),
tgt AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY {_NEWEST_SQL}) AS rn
        FROM src WHERE load_time < TIMESTAMP '{UPSERT_FIRST_LOAD_BEFORE}'
    ) WHERE rn = 1
),
newer AS (
    SELECT * FROM src
    WHERE load_time > (SELECT coalesce(max(load_time), TIMESTAMP '1900-01-01') FROM tgt)
),
batch AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY {_NEWEST_SQL}) AS rn FROM newer
    ) WHERE rn = 1
)
SELECT * FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.id = t.id)
UNION ALL
SELECT * FROM batch
""")
def incremental_upsert(spark, sf_dir):
    """First load before day 20, then an incremental load of the whole feed."""
    src = _feed(spark, sf_dir)
    first = src.where(F.col("load_time") < F.lit(UPSERT_FIRST_LOAD_BEFORE).cast("timestamp_ntz"))
    target = upsert.latest_upsert(first, None, "id", _newest())
    return upsert.latest_upsert(src, target, "id", _newest())


@query("schema_sync", """
WITH tgt AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer
             WHERE c_mktsegment <> 'BUILDING' OR c_nationkey < 10),
upd AS (SELECT c_custkey, c_name, c_acctbal + 1 AS c_acctbal, c_mktsegment FROM customer
        WHERE c_mktsegment = 'BUILDING')
SELECT t.c_custkey, t.c_name, t.c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment FROM tgt t
WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u.c_custkey = t.c_custkey)
UNION ALL
SELECT * FROM upd
""")
def schema_sync(spark, sf_dir):
    """A10: upsert where the batch adds c_mktsegment and drops c_nationkey.

    Target: the customer table as loaded earlier (without the BUILDING
    segment outside nations 0-9); batch: the BUILDING segment, which both
    replaces and inserts keys.
    """
    c = table(spark, sf_dir, "customer")
    target = (c.where((F.col("c_mktsegment") != "BUILDING") | (F.col("c_nationkey") < 10))
              .select("c_custkey", "c_name", "c_nationkey", "c_acctbal"))
    updates = (c.where(F.col("c_mktsegment") == "BUILDING")
               .select("c_custkey", "c_name", (F.col("c_acctbal") + 1).alias("c_acctbal"), "c_mktsegment"))
    return upsert.merge_by_key(target, updates, "c_custkey")


@query("scd2_change_predicate", f"""
WITH cur AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) AS rn
        FROM orders WHERE o_orderdate < TIMESTAMP '{ORDERS_SPLIT}'
    ) WHERE rn = 1
),
src AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) AS rn
        FROM orders WHERE o_orderdate >= TIMESTAMP '{ORDERS_SPLIT}'
    ) WHERE rn = 1
)
SELECT s.o_custkey, s.o_orderkey, s.o_orderstatus, c.o_orderstatus AS old_status
FROM src s LEFT JOIN cur c ON s.o_custkey = c.o_custkey
WHERE c.o_orderstatus IS NULL OR s.o_orderstatus <> c.o_orderstatus
""")
def scd2_change_predicate(spark, sf_dir):
    """C2+B6: newest order per customer vs the customer's current one."""
    o = table(spark, sf_dir, "orders")
    order = dedup.desc_first("o_orderdate") + [F.col("o_orderkey").desc()]
    split = F.lit(ORDERS_SPLIT).cast("timestamp_ntz")
    cur = dedup.latest(o.where(F.col("o_orderdate") < split), "o_custkey", order)
    src = dedup.latest(o.where(F.col("o_orderdate") >= split), "o_custkey", order)
    j = src.join(cur.select("o_custkey", F.col("o_orderstatus").alias("old_status")), "o_custkey", "left")
    return (j.where(new_or_changed("o_orderstatus", "old_status"))
            .select("o_custkey", "o_orderkey", "o_orderstatus", "old_status"))


# -- Top-N and projections ---------------------------------------------------

_CUST_COLS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


@query("top_n", f"""
SELECT {_CUST_COLS} FROM customer ORDER BY c_acctbal ASC NULLS LAST, c_custkey ASC LIMIT 20
""")
def top_n(spark, sf_dir):
    """The 20 lowest ranks (acctbal as the rank), NULLs last."""
    c = table(spark, sf_dir, "customer")
    return ranking.lowest_ranks(c, "c_acctbal", "c_custkey", ranking.TOP_RANKS)


@query("feed_top_n", f"""
SELECT {_CUST_COLS} FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey ASC LIMIT 250
""")
def feed_top_n(spark, sf_dir):
    """A5: the feed's first page, largest measure first."""
    c = table(spark, sf_dir, "customer")
    return ranking.feed_page(c, "c_acctbal", "c_custkey", ranking.FEED_SIZE)


@query("raw_projection", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
""")
def raw_projection(spark, sf_dir):
    """Named projection, upper-case on write, lower-case in SQL."""
    from strata.sources.snapshots import lower_names, upper_names
    o = table(spark, sf_dir, "orders")
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    return lower_names(upper_names(o.select(*cols)))

