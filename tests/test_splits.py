"""Splits and samples: equality with the window form and invariants."""

from pyspark.sql import functions as F

from quarry.operators import splits as sp
from quarry.sources import standins as si


def test_percent_rank_equals_window(spark, sf_small):
    ratings = si.load_ratings(spark, sf_small)
    fast = sp.percent_rank(ratings, buckets=8)
    slow = sp.percent_rank_naive(ratings)
    key = ["userId", "movieId", "rating", "timestamp", "percent_rank"]
    assert sorted(fast.select(key).collect()) == sorted(slow.select(key).collect())


def test_percent_rank_ties_and_nulls(spark):
    df = spark.createDataFrame([(None,), (1,), (1,), (2,), (3,), (3,), (3,)], "timestamp long")
    fast = sorted((r.timestamp, r.percent_rank) for r in sp.percent_rank(df, buckets=3).collect()
                  if r.timestamp is not None)
    slow = sorted((r.timestamp, r.percent_rank) for r in sp.percent_rank_naive(df).collect()
                  if r.timestamp is not None)
    assert fast == slow


def test_chrono_split_matches_percent_rank(spark, sf_small):
    ratings = si.load_ratings(spark, sf_small)
    ranked = sp.percent_rank_naive(ratings)
    for p in sp.CHRONO_FRACTIONS:
        train, test = sp.chrono_split(ratings, p)
        assert train.count() == ranked.filter(F.col("percent_rank") < p).count()
        assert train.count() + test.count() == ratings.count()
        assert train.agg(F.max("timestamp")).first()[0] < test.agg(F.min("timestamp")).first()[0]


def test_chrono_split_equal_timestamps_one_side(spark):
    df = spark.createDataFrame([(t,) for t in [1, 2, 2, 2, 2, 3]], "timestamp long")
    train, test = sp.chrono_split(df, 0.5)
    assert sorted(r.timestamp for r in train.collect()) == [1, 2, 2, 2, 2]
    assert [r.timestamp for r in test.collect()] == [3]


def test_chrono_split_single_row(spark):
    df = spark.createDataFrame([(5,)], "timestamp long")
    train, test = sp.chrono_split(df, 0.5)
    assert train.count() == 1 and test.count() == 0


def test_hash_split_independent_of_partitioning(spark, sf_small):
    df = si.load_particle_text(spark, sf_small)
    a = sp.hash_split(df, "row_key").select("row_key", "side")
    b = sp.hash_split(df.repartition(7), "row_key").select("row_key", "side")
    assert sorted(a.collect()) == sorted(b.collect())
    n = df.count()
    train = a.filter("side = 'train'").count()
    assert 0.6 * n < train < 0.8 * n


def test_hash_sample_fraction(spark, sf_small):
    df = si.load_particle_text(spark, sf_small)
    n = df.count()
    k = sp.hash_sample(df, "row_key", 0.3, seed=42).count()
    assert 0.2 * n < k < 0.4 * n
    assert sp.hash_sample(df, "row_key", 1.0).count() == n


def test_downsample_more_positives_than_zeros(spark):
    df = spark.createDataFrame([(str(i), 5.0) for i in range(10)] + [("z1", 0.0), ("z2", 0.0)],
                               "k string, Claim_Amount double")
    assert sp.downsample(df, "k").count() == 12


def test_downsample_no_zeros_and_balance(spark):
    df = spark.createDataFrame([(str(i), 1.0) for i in range(4)], "k string, Claim_Amount double")
    assert sp.downsample(df, "k").count() == 4
    big = spark.range(20000).select(F.col("id").cast("string").alias("k"),
                                    F.when(F.col("id") % 10 == 0, 2.0).otherwise(0.0).alias("Claim_Amount"))
    out = sp.downsample(big, "k")
    zeros = out.filter("Claim_Amount = 0").count()
    assert abs(zeros - 2000) < 200


def test_zero_positive_counts_ignores_null_and_negative(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (3.0,), (None,), (-1.0,)], "Claim_Amount double")
    r = sp.zero_positive_counts(df).first()
    assert (r.n_zero, r.n_positive, r.n_total, r.fraction) == (2, 1, 5, 0.5)


def test_frozen_split_round_trip(spark, sf_small):
    df = si.load_particle_text(spark, sf_small)
    train, test = sp.frozen_split(df, "test_frozen")
    assert train.count() + test.count() == df.count()
    assert train.inputFiles() and all("test_frozen" in f for f in train.inputFiles())


def test_percent_rank_key_types(spark):
    import datetime as dt

    rows = [(dt.datetime(2024, 3, 10, h, 30), dt.date(2024, 1, 1 + h % 5), f"k{h % 7}", float(h % 4))
            for h in range(24)] + [(None, None, None, float("nan"))]
    df = spark.createDataFrame(rows, "t timestamp_ntz, d date, s string, x double")
    for key in ("t", "d", "s", "x"):
        fast = sorted((str(r[key]), r.percent_rank) for r in
                      sp.percent_rank(df.select(key), ts=key, buckets=4).collect())
        slow = sorted((str(r[key]), r.percent_rank) for r in
                      sp.percent_rank_naive(df.select(key), ts=key).collect())
        assert fast == slow, key
