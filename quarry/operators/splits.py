"""Splits and samples.

Chronological splits follow ``percent_rank`` exactly (train: rank < p, test:
rank >= p, equal timestamps stay together) without a single-partition
window; hash splits and samples are deterministic per row key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.hashing import uniform
from quarry.plans import prefix
from quarry.session import ensure_checkpoint_dir
from quarry.sources.files import freeze

# The three chronological cut points.
CHRONO_FRACTIONS = (0.5, 0.65, 0.8)


def percent_rank_naive(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """W1 as originally written: a global window (one partition)."""
    return df.withColumn("percent_rank", F.percent_rank().over(Window.orderBy(F.col(ts).asc())))


def percent_rank(df: DataFrame, ts: str = "timestamp", buckets: int | None = None) -> DataFrame:
    """The same ``percent_rank`` column, computed in parallel.

    Null keys sort first, as in the window.  The per-key count table (one
    row per distinct key) is checkpointed to the shared checkpoint folder,
    so the quantile pass and the prefix sum read it instead of the data:
    the data is read twice (counts, final join), not three times.
    """
    ensure_checkpoint_dir(df.sparkSession)
    counts = prefix.key_counts(df, ts).checkpoint(eager=True)
    rb = prefix.rows_before(df, ts, buckets, counts=counts).select(
        F.col(ts).alias("_k"), prefix.percent_rank_expr().alias("percent_rank"))
    # Large side joins on the key; AQE broadcasts the distinct-key table when
    # its measured size is small and splits a hot key's partition otherwise.
    return df.join(rb, F.col(ts).eqNullSafe(F.col("_k"))).drop("_k")


def chrono_cutoffs(df: DataFrame, fractions=CHRONO_FRACTIONS, ts: str = "timestamp",
                   buckets: int | None = None) -> dict:
    """{p: last timestamp whose percent_rank is below p} for all fractions at once.

    One pass over the per-timestamp counts, which are persisted only while
    the cut-offs are computed (they are read twice: quantiles, prefix sum).
    None means no timestamp ranks below p.
    """
    counts = prefix.key_counts(df, ts).persist()
    try:
        return _cutoffs(counts, df, fractions, ts, buckets)
    finally:
        counts.unpersist()


def _cutoffs(counts: DataFrame, df: DataFrame, fractions, ts: str, buckets: int | None) -> dict:
    """Cut-offs from the rows per timestamp."""
    rb = prefix.rows_before(df, ts, buckets, counts=counts)
    pr = prefix.percent_rank_expr()
    aggs = [F.max(F.when(pr < F.lit(float(p)), F.col(ts))).alias(f"c{i}")
            for i, p in enumerate(fractions)]
    row = rb.agg(*aggs).first()
    return {p: row[f"c{i}"] for i, p in enumerate(fractions)}


def chrono_cutoff(df: DataFrame, p: float, ts: str = "timestamp",
                  buckets: int | None = None):
    """The last timestamp whose percent_rank is below ``p`` (None: no train rows)."""
    return chrono_cutoffs(df, (p,), ts, buckets)[p]


def split_at(df: DataFrame, cut, p: float, ts: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """(train, test) for a known cut-off: a range filter Parquet statistics can prune."""
    k = F.col(ts)
    if cut is None:
        # Below the first rank: only null keys (rank 0) can train.
        null_train = k.isNull() & F.lit(p > 0)
        return df.filter(null_train), df.filter(~null_train)
    return df.filter((k <= F.lit(cut)) | k.isNull()), df.filter(k > F.lit(cut))


def chrono_split(df: DataFrame, p: float, ts: str = "timestamp",
                 buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test) = (percent_rank < p, percent_rank >= p).

    Only the cut-off value reaches the driver; the split itself is a plain
    range filter that Parquet row-group statistics can skip on.
    """
    return split_at(df, chrono_cutoff(df, p, ts, buckets), p, ts)


def chrono_splits(df: DataFrame, fractions=CHRONO_FRACTIONS, ts: str = "timestamp",
                  buckets: int | None = None) -> dict:
    """{p: (train, test)} for several fractions from one cut-off pass."""
    cuts = chrono_cutoffs(df, fractions, ts, buckets)
    return {p: split_at(df, cuts[p], p, ts) for p in fractions}


def tag_chrono_sides(df: DataFrame, cuts: dict, ts: str = "timestamp") -> DataFrame:
    """Tag every row with (fraction, side) for each chronological split.

    ``cuts`` maps a fraction to its cut-off (:func:`chrono_cutoffs`); each
    row appears once per fraction.  The tags come from a generated array, so
    all splits are served by one scan and no join.
    """
    tags = []
    for p, cut in sorted(cuts.items()):
        train = F.lit(False) if cut is None else (F.col(ts) <= F.lit(cut))
        train = train | (F.col(ts).isNull() & F.lit(p > 0))
        side = F.when(train, F.lit("train")).otherwise(F.lit("test"))
        tags.append(F.struct(F.lit(float(p)).alias("fraction"), side.alias("side")))
    return df.withColumn("_tag", F.explode(F.array(*tags))).select("*", "_tag.*").drop("_tag")


def chrono_split_summary(df: DataFrame, fractions=CHRONO_FRACTIONS,
                         ts: str = "timestamp") -> DataFrame:
    """Row count and time range of each side of each chronological split.

    One pass over the rows, to count them per timestamp; cut-offs and sides
    come from these counts.
    """
    counts = freeze(prefix.key_counts(df, ts), "time_counts")
    cuts = _cutoffs(counts, df, fractions, ts, None)
    return (tag_chrono_sides(counts, cuts, ts).groupBy("fraction", "side")
            .agg(F.sum("n").alias("n_rows"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts")))


def hash_split(df: DataFrame, key: str, weights=(0.7, 0.3), seed: int = 21,
               labels=("train", "test")) -> DataFrame:
    """Tag each row with a side; the split depends on the row key only."""
    total = float(sum(weights))
    u = uniform(key, seed)
    bounds, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        bounds.append(acc)
    side = None
    for b, lab in zip(bounds, labels):
        side = F.when(u < F.lit(b), F.lit(lab)) if side is None else side.when(u < F.lit(b), F.lit(lab))
    side = side.otherwise(F.lit(labels[len(bounds)])) if side is not None else F.lit(labels[0])
    return df.withColumn("side", side)


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample without replacement, reproducible per key."""
    if fraction >= 1.0:
        return df
    return df.filter(uniform(key, seed) < F.lit(float(fraction)))


def random_split(df: DataFrame, weights=(0.7, 0.3), seed: int = 21) -> list[DataFrame]:
    """R2 as in the original: Spark's seeded ``randomSplit``."""
    return df.randomSplit(list(weights), seed)


def frozen_split(df: DataFrame, name: str, weights=(0.7, 0.3), seed: int = 21,
                 labels=("train", "test")) -> list[DataFrame]:
    """Random split frozen by a Parquet round trip in the checkpoint folder."""
    return [freeze(part, f"{name}_{lab}") for part, lab in zip(random_split(df, weights, seed), labels)]


def split_manifest(sides: DataFrame, share: float = 0.7, key: str = "row_key", first: str = "train") -> DataFrame:
    """(n_rows, key_sum, shared_keys, share_ok): proof that a split is disjoint and complete.

    ``key_sum`` adds up the first 32 bits of the md5 of every row's key, so it equals
    that of the table only if each row is on one side; ``shared_keys`` counts keys on
    both sides; ``share_ok`` tells whether the first side's share lies within six
    standard deviations of ``share``.
    """
    number = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")
    per_key = sides.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("side") == first).alias("n_first"),
                                     F.sum(number).alias("h"))
    sums = per_key.agg(F.sum("n").alias("n_rows"), F.sum("h").alias("key_sum"), F.sum("n_first").alias("n_first"),
                       F.count_if((F.col("n_first") > 0) & (F.col("n_first") < F.col("n"))).alias("shared_keys"))
    spread = 6 * F.sqrt(F.col("n_rows") * share * (1 - share))
    return sums.select("n_rows", "key_sum", "shared_keys", (F.abs(F.col("n_first") - share * F.col("n_rows")) <= spread).alias("share_ok"))


def sorted_positions(df: DataFrame, order: list[str]) -> DataFrame:
    """O1: ``df`` sorted globally, with every row's ``position`` from 0 as it stands in the result.

    The sort is Spark's range-partitioned one.  Its result is written and read back
    with the number each row got in its partition; one count per partition
    (their number is bounded) then shifts them.
    """
    placed = freeze(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "sorted")
    part, at = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = {r.part: r.n for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = [], 0
    for p in sorted(sizes):
        starts.append((p, total))
        total += sizes[p]
    offsets = df.sparkSession.createDataFrame(starts, "_part long, _start long")
    return (placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn("position", at + F.col("_start")).drop("_place", "_part", "_start"))


def zero_positive_counts(df: DataFrame, target: str = "Claim_Amount") -> DataFrame:
    """F7 + A10: zero rows, positive rows, all rows and positives / zeros.

    Null and negative targets fall in neither class.  One aggregation pass.
    """
    c = F.col(target)
    agg = df.agg(F.count_if(c == 0).alias("n_zero"), F.count_if(c > 0).alias("n_positive"),
                 F.count(F.lit(1)).alias("n_total"))
    return agg.withColumn("fraction", F.try_divide(F.col("n_positive").cast("double"),
                                                   F.col("n_zero").cast("double")))


def downsample(df: DataFrame, key: str, target: str = "Claim_Amount",
               seed: int = 3) -> DataFrame:
    """Sample the zero class down to the positive class size, then union.

    fraction = positives / zeros, clamped to 1 (no zeros: nothing sampled).
    Only the two counts reach the driver.
    """
    row = zero_positive_counts(df, target).first()
    zeros = df.filter(F.col(target) == 0)
    positives = df.filter(F.col(target) > 0)
    if row["n_zero"]:
        frac = min(1.0, row["n_positive"] / row["n_zero"])
        zeros = hash_sample(zeros, key, frac, seed)
    return zeros.unionByName(positives)
