"""Results stay whole and exact when one key holds a third of the rows."""

from pyspark.sql import functions as F

from quarry.operators import splits as sp
from quarry.operators import tabular as tb
from quarry.operators import weblog as wl


def _skewed(spark, n=3000):
    # key 7 holds a third of all rows; the rest spread over 200 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 200 + 100).alias("timestamp"),
        F.col("id").cast("string").alias("k"))


def test_percent_rank_hot_key(spark):
    df = _skewed(spark).repartition(6)
    fast = sorted((r.k, r.percent_rank) for r in sp.percent_rank(df, buckets=8).collect())
    slow = sorted((r.k, r.percent_rank) for r in sp.percent_rank_naive(df).collect())
    assert fast == slow and len(fast) == 3000


def test_chrono_split_hot_key_stays_together(spark):
    df = _skewed(spark)
    train, test = sp.chrono_split(df, 0.2)
    assert train.count() + test.count() == 3000
    hot_sides = {("train" if r.timestamp <= 7 else "test") for r in train.union(test)
                 .filter("timestamp = 7").collect()}
    assert len(hot_sides) == 1


def test_top_k_and_mode_hot_key(spark):
    df = _skewed(spark).select(F.lit("UK").alias("grp"), F.col("timestamp").cast("string").alias("org"))
    counts = df.groupBy("grp", "org").agg(F.count(F.lit(1)).alias("requests"))
    out = wl.top_k_with_rest(counts, 3).collect()
    assert sum(r.requests for r in out) == 3000
    assert [r.org for r in out if r.rank == 1] == ["7"]
    mode = tb.mode_nullaware(df, ["org"]).first()
    assert (mode.mode, mode.mode_count) == ("7", 1000)
