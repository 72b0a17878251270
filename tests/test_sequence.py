"""Hot-key segmentation gives exactly the plain window results."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import sequence


def _series(spark, n_hot=400, n_cold=30, seed=7, sparse=False):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    data = []
    for key, n in (("hot", n_hot), ("cold", n_cold), ("cold2", 3)):
        t = base
        for i in range(n):
            gap = rnd.choice([1, 1, 2, 600]) if sparse else rnd.randint(1, 90)
            t = t + dt.timedelta(seconds=gap)
            data.append((key, t, i, rnd.choice([None, 1.0, 2.0, 3.5]) if i % 17 == 0 else rnd.random()))
    return spark.createDataFrame(data, "k string, t timestamp_ntz, seq long, v double")


def _compute(d, part):
    w = Window.partitionBy(*part).orderBy("t", "seq")
    return (d.withColumn("ma", F.avg("v").over(w.rowsBetween(-7, 0)))
            .withColumn("prev", F.lag("v", 2).over(w))
            .withColumn("nxt", F.lead("seq", 1).over(w))
            .withColumn("first", F.lag(F.lit(1)).over(w).isNull()))


def _range_compute(d, part):
    w = Window.partitionBy(*part).orderBy(F.unix_micros(F.col("t").cast("timestamp"))).rangeBetween(-300_000_000, 0)
    return d.withColumn("n5m", F.count(F.lit(1)).over(w)).withColumn("s5m", F.sum("seq").over(w))


def _as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("sparse", [False, True])
def test_rows_frames_match_plain(spark, sparse):
    df = _series(spark, sparse=sparse)
    plain = sequence.over_sequence(df, "k", ["t", "seq"], _compute, rows_before=7, rows_after=1, hot=None)
    hot = sequence.hot_keys(df, ["k"], "t", hot_rows=50, segment_rows=9)
    assert hot is not None and hot.small
    split = sequence.over_sequence(df, "k", ["t", "seq"], _compute, rows_before=7, rows_after=1, hot=hot)
    assert _as_set(split) == _as_set(plain)


def test_range_frames_match_plain(spark):
    df = _series(spark, sparse=True)
    plain = sequence.over_sequence(df, "k", ["t", "seq"], _range_compute, range_before=300, hot=None)
    hot = sequence.hot_keys(df, ["k"], "t", hot_rows=50, segment_rows=5)
    split = sequence.over_sequence(df, "k", ["t", "seq"], _range_compute, range_before=300, hot=hot)
    assert _as_set(split) == _as_set(plain)


def test_no_hot_keys_is_plain_plan(spark):
    df = _series(spark)
    assert sequence.hot_keys(df, ["k"], "t", hot_rows=10_000) is None
    out = sequence.over_sequence(df, "k", ["t", "seq"], _compute, rows_before=7, hot=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_null_times_of_hot_key_sort_first(spark):
    df = _series(spark, n_hot=120).unionByName(
        spark.createDataFrame([("hot", None, -1, 9.0)], "k string, t timestamp_ntz, seq long, v double"))
    plain = sequence.over_sequence(df, "k", ["t", "seq"], _compute, rows_before=7, rows_after=1, hot=None)
    hot = sequence.hot_keys(df, ["k"], "t", hot_rows=50, segment_rows=11)
    split = sequence.over_sequence(df, "k", ["t", "seq"], _compute, rows_before=7, rows_after=1, hot=hot)
    assert _as_set(split) == _as_set(plain)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000), before=st.integers(0, 12), after=st.integers(0, 3),
       seg=st.integers(1, 40), sparse=st.booleans())
def test_random_series_and_reaches(spark, seed, before, after, seg, sparse):
    df = _series(spark, n_hot=250, seed=seed, sparse=sparse)

    def compute(d, part):
        w = Window.partitionBy(*part).orderBy("t", "seq")
        out = d
        if before:
            out = out.withColumn("s", F.sum("seq").over(w.rowsBetween(-before, 0)))
        if after:
            out = out.withColumn("n", F.lead("seq", after).over(w))
        return out.withColumn("p", F.lag("seq", max(before, 1) if before else 0).over(w)) if before else out

    plain = sequence.over_sequence(df, "k", ["t", "seq"], compute, rows_before=before, rows_after=after, hot=None)
    hot = sequence.hot_keys(df, ["k"], "t", hot_rows=20, segment_rows=seg)
    split = sequence.over_sequence(df, "k", ["t", "seq"], compute, rows_before=before, rows_after=after, hot=hot)
    assert _as_set(split) == _as_set(plain)


def test_null_key_can_be_hot(spark):
    df = _series(spark, n_hot=200).withColumn("k", F.when(F.col("k") == "hot", F.lit(None)).otherwise(F.col("k")))
    plain = sequence.over_sequence(df, "k", ["t", "seq"], _compute, rows_before=7, rows_after=1, hot=None)
    hot = sequence.hot_keys(df, ["k"], "t", hot_rows=50, segment_rows=9)
    seg = sequence.with_segments(df, ["k"], "t", hot)
    assert seg.where(F.col("k").isNull() & F.col("_seg").isNotNull()).count() == 200
    split = sequence.over_sequence(df, "k", ["t", "seq"], _compute, rows_before=7, rows_after=1, hot=hot)
    assert _as_set(split) == _as_set(plain)


def _sizes(df, part):
    return df.groupBy(*part).count()


@pytest.mark.parametrize("burst", ["one day and one old row", "one timestamp"])
def test_bursts_are_cut_by_count(spark, burst):
    """100,000 rows in a day beside one in 1970, or at one time: no segment is over twice its size."""
    n, size = 100_000, 1_000
    t = F.timestamp_seconds(F.lit(1_704_067_200) + (F.col("id") % 86_400 if burst.startswith("one day") else F.lit(0)))
    df = spark.range(n).select(F.lit("hot").alias("k"), t.cast("timestamp_ntz").alias("t"), F.col("id").alias("seq"),
                               (F.col("id") % 7).cast("double").alias("v"))
    if burst.startswith("one day"):
        df = df.unionByName(spark.createDataFrame([("hot", dt.datetime(1970, 1, 1), -1, 1.0)], df.schema))
    hot = sequence.hot_keys(df, ["k"], "t", hot_rows=10_000, segment_rows=size)
    seen = {}

    def compute(d, part):
        seen["largest"] = _sizes(d, part).agg(F.max("count")).first()[0]
        w = Window.partitionBy(*part).orderBy("t", "seq")
        return d.withColumn("prev", F.lag("seq").over(w)).withColumn("s", F.sum("v").over(w.rowsBetween(-49, 0)))

    split = sequence.over_sequence(df, "k", ["t", "seq"], compute, rows_before=49, hot=hot)
    assert seen["largest"] <= size + 49
    plain = sequence.over_sequence(df, "k", ["t", "seq"], compute, rows_before=49, hot=None)
    assert split.exceptAll(plain).count() == 0 and split.count() == plain.count()
