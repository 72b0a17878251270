"""Mixing sources to target weights by hash thresholds.

The size of a row is its number of words. All sources together keep their total
size, shared out by weight; a target stops at ``copies`` times the size of its
source, and what is left over is shared again by weight until no target is
above its stop.

Every row has a key of 60 bits, the start of an MD5 over id and text. A source
takes whole copies of all its rows, as often as its target holds its size, and
one more copy of the rows whose key is below a threshold, so that thresholds of
growing budgets are nested. The threshold is found without sorting rows: sizes
are summed by source and the top 12 bits of the key, the running sum names the
bucket in which the budget ends, and only the rows of that bucket are summed
again by the next 12 bits, until the bucket holds a single key. That last key is
taken if the sum comes nearer to the target with it than without.

Rows are read once for size and key; what is kept and shuffled is (id, source,
size, key). Sums are taken before the shuffle; the decision is joined back by
(source, bucket), so a hot source meets its 4,096 buckets, not one task. The
driver sees three sums a round of resharing, never a source.

Defined results: NULL is a source, the last one; a NULL or empty text has size
0 and is never taken. Repeated rows have the same key and are taken together;
a NULL id counts as ``-``. Where all sizes are 0, all targets are 0. Other
columns of the table are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from strata.llm.common import WORD, ranked, stored

WEIGHTS = (1, 2, 3)
COPIES = 3
BITS, STEP = 60, 12  # of the key, and of one level of the histogram
EXACT = "decimal(38,0)"


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, key) of every row."""
    text = F.coalesce(docs["text"], F.lit(""))
    name = F.concat(F.coalesce(docs["doc_id"].cast("string"), F.lit("-")), F.lit(":"), text)
    key = F.conv(F.substring(F.md5(name.cast("binary")), 1, BITS // 4), 16, 10).cast("long")
    return docs.select(docs["doc_id"].alias("doc_id"), docs["source"].alias("source"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), key.alias("key"))


def histogram(rows: DataFrame, level: int) -> DataFrame:
    """Sizes by source and the first ``level`` + 1 digits of the key."""
    return (rows.groupBy("source", F.shiftright("key", BITS - STEP * (level + 1)).alias("bucket"))
            .agg(F.sum("size").alias("size"), F.min("key").alias("low"), F.max("key").alias("high")))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, copies: int = COPIES) -> DataFrame:
    """(source, source_size, target) of ``sizes(source, source_size)``."""
    placed = ranked(sizes.withColumn("all", F.lit(0)), "all", [F.col("source").asc_nulls_last()], "weights")
    weight = F.element_at(F.array(*(F.lit(int(w)) for w in weights)), (F.col("pos") % len(weights) + 1).cast("int"))
    s = stored(placed.select("source", "source_size", weight.cast("long").alias("weight"),
                             (F.col("source_size") * copies).alias("stop")), "weights")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    held, shared, before = 0, None, None
    while before != (held, shared):  # each round stops more sources, or is the last
        before = (held, shared)
        if shared is None:
            above = F.lit(False)
        else:  # stop < (total - held) * weight / shared
            above = F.col("stop").cast(EXACT) * F.lit(shared) < F.lit(total - held) * F.col("weight").cast(EXACT)
        r = s.agg(F.coalesce(F.sum(F.when(above, F.col("stop"))), F.lit(0)).alias("held"),
                  F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("shared")).first()
        held, shared = r["held"], r["shared"]
    if not shared:
        return s.select("source", "source_size", F.col("stop").cast("double").alias("target"))
    share = F.lit(float(total - held)) * F.col("weight") / F.lit(float(shared))
    above = F.col("stop").cast(EXACT) * F.lit(shared) < F.lit(total - held) * F.col("weight").cast(EXACT)
    return s.select("source", "source_size", F.when(above, F.col("stop").cast("double")).otherwise(share).alias("target"))


def thresholds(rows: DataFrame, sums: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, threshold) for ``budgets(source, budget)``, each above 0 and below
    its source's size: rows with a smaller key come nearest to the budget.
    ``sums`` is the histogram of the first digit."""
    done = None
    for level in range(BITS // STEP):
        w = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
        runs = sums.withColumn("upto", F.sum("size").over(w)).select(F.struct(
            "source", "bucket", "size", "low", "high", "upto").alias("h"))
        cut = runs.join(budgets, F.col("h.source").eqNullSafe(budgets["source"])).where(
            (F.col("h.upto") > F.col("budget")) & (F.col("h.upto") - F.col("h.size") <= F.col("budget")))
        before = F.col("h.upto") - F.col("h.size")
        cut = stored(cut.select("source", "h.bucket", "h.low", "h.high", before.alias("before"), "h.size", "budget"), "cut")
        single = F.col("low") == F.col("high")
        near = 2 * F.col("budget") >= 2 * F.col("before") + F.col("size")
        found = cut.where(single).select("source", (F.col("low") + near.cast("long")).alias("threshold"))
        done = found if done is None else done.unionByName(found)
        open_ = cut.where(~single)
        if open_.isEmpty():
            break
        keys = open_.select(F.struct("source", "bucket").alias("c"))
        bucket = F.shiftright("key", BITS - STEP * (level + 1))
        rows = stored(rows.join(keys, (bucket == F.col("c.bucket")) & F.col("source").eqNullSafe(F.col("c.source")), "left_semi"),
                      "boundary")
        sums = histogram(rows, level + 1)
        budgets = open_.select("source", (F.col("budget") - F.col("before")).alias("budget"))
    return done


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, copies: int = COPIES) -> DataFrame:
    """(doc_id, source, size, source_size, target, times, taken): ``times`` is how
    often the mix takes the row, ``taken`` the words of that."""
    rows = stored(sized(docs), "sizes")
    sums = stored(histogram(rows, 0), "histogram")
    goal = targets(sums.groupBy("source").agg(F.sum("size").alias("source_size")), weights, copies)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goal = stored(goal.withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")),
                  "targets")
    cuts = thresholds(rows, sums, goal.where(F.col("budget") > 0).select("source", "budget"))
    cuts = cuts.select(F.struct("source", "threshold").alias("c"))
    per = goal.join(cuts, F.col("source").eqNullSafe(F.col("c.source")), "left").select(F.struct(
        "source", "source_size", "target", "whole", F.coalesce("c.threshold", F.lit(0)).alias("threshold")).alias("g"))
    by_bucket = sums.select("source", "bucket").join(per, F.col("source").eqNullSafe(F.col("g.source"))).select(
        F.struct("bucket", "g.*").alias("m"))
    out = rows.join(by_bucket, (F.shiftright("key", BITS - STEP) == F.col("m.bucket"))
                    & F.col("source").eqNullSafe(F.col("m.source")))
    times = (F.col("m.whole") + (F.col("key") < F.col("m.threshold")).cast("long")).alias("times")
    return (out.select("doc_id", "source", "size", "m.source_size", "m.target", times)
            .withColumn("taken", F.col("size") * F.col("times")))
