"""Operators on data where one key holds a third of all rows: results stay whole and exact,
and the plans reduce the hot key before any shuffle."""

import datetime as dt

from pyspark.sql import functions as F

from starloom.operators.lookups import latest_per_key, lookup_key
from starloom.operators.snapshots import cumulative_daily_snapshot

N = 30_000


def skewed(spark):
    ids = spark.range(N)
    return ids.select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("k"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 20).cast("int")).alias("day"),
        (F.col("id") % 11).alias("v"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_hot_key(spark):
    df = skewed(spark)
    got = {r.k: r.row_id for r in latest_per_key(df, ["k"], ["row_id"]).collect()}
    want = {r.k: r.m for r in df.groupBy("k").agg(F.max("row_id").alias("m")).collect()}
    assert got == want and len(got) == 98
    plan = _plan(latest_per_key(df, ["k"], ["row_id"]))
    assert "partial_max_by" in plan or "partial_" in plan      # combined before the shuffle


def test_lookup_hot_key_shuffle_join_is_whole(spark):
    facts = skewed(spark)
    dim = spark.range(0, 98).select(F.col("id").alias("k"), (F.col("id") + 1000).alias("key"))
    out = lookup_key(facts, dim, {"k": "k"}, "key", broadcast_max_rows=0)   # force the shuffle path
    assert out.count() == N
    assert out.filter("k = 0").select("key").distinct().collect()[0].key == 1000
    assert out.filter("key = -1").count() == 0


def test_cumulative_snapshot_hot_group(spark):
    df = skewed(spark)
    snap = cumulative_daily_snapshot(df, ["k"], "day", dt.date(2024, 1, 1), dt.date(2024, 1, 21),
                                     distinct={"n": ("row_id", None)}, sums={"v": ("v", None)})
    hot = {r.snapshot_date.day: (r.n, r.v_sum) for r in snap.filter("k = 0").collect()}
    rows = [(r.day, r.v) for r in df.filter("k = 0").collect()]
    for d in range(1, 21):
        upto = [v for day, v in rows if day.day <= d]
        assert hot[d] == (len(upto), sum(upto))
    # every group appears once per day from its first day: 98 groups x 20 days
    assert snap.count() == 98 * 20
