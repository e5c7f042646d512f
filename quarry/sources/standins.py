"""Stand-in inputs built from the driver's tables.

The original workflows read an access log, a ratings/movies pair, a wide
particle CSV and an insurance-claims CSV, none of which ship with the
project.  These builders derive frames of the same shape from the driver's
tables with plain DataFrame expressions, so each workflow runs on data that
grows with the tables.  Each builder has an SQL twin in
:mod:`quarry.plans.oracle` so both engines see identical inputs.
"""

from __future__ import annotations

import hashlib
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.hashing import uniform
from quarry.sources.files import (CLAIMS_FILE_COLUMNS, PARTICLE_FEATURES, read_access_log,
                                  read_claims_csv, read_movies_csv, read_particle_csv,
                                  read_ratings_csv)
from quarry.sources.tables import load_table

# Fixed values of the access-log stand-in.
LOG_SUFFIXES = [".ac.jp", ".ac.uk", ".edu", ".example.com"]
LOG_DEPARTMENTS = 13
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss"
LOG_ZONE = "-0400"


def access_log(events: DataFrame) -> DataFrame:
    """One access-log line per event, in column ``value``.

    host    = 'h' + user_id + '.dept' + (user_id mod 13) + suffix(user_id mod 4)
    line    = host - - [dd/MMM/yyyy:HH:mm:ss -0400] "GET /<type>.html HTTP/1.0" status bytes
    errors reply 404 with '-' bytes; others 200 with floor(value) bytes.
    """
    uid = F.col("user_id")
    suffix = F.element_at(F.array(*[F.lit(s) for s in LOG_SUFFIXES]),
                          (F.pmod(uid, F.lit(len(LOG_SUFFIXES))) + 1).cast("int"))
    host = F.concat(F.lit("h"), uid.cast("string"), F.lit(".dept"),
                    F.pmod(uid, F.lit(LOG_DEPARTMENTS)).cast("string"), suffix)
    is_error = F.col("event_type") == "error"
    tail = F.when(is_error, F.lit("404 -")).otherwise(
        F.concat(F.lit("200 "), F.floor("value").cast("string")))
    line = F.concat(
        host, F.lit(" - - ["), F.date_format("ts", LOG_TIME_FORMAT),
        F.lit(f" {LOG_ZONE}] \"GET /"), F.col("event_type"),
        F.lit(".html HTTP/1.0\" "), tail)
    return events.select(line.alias("value"))


def ratings(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """(userId, movieId, rating, timestamp) from orders joined to lineitem.

    rating = ceil(l_quantity / 10) in 1..5; timestamp = epoch seconds of the
    order date.  Ids stay bigint: a narrowing cast would fail under ANSI
    once keys pass 2^31 (ALS checks its own id range).  The join is an ordinary equi-join on the order key: AQE
    broadcasts the orders side only when its measured size is small.
    """
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    li = lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias("userId"),
                    F.col("l_partkey").alias("movieId"),
                    F.ceil(F.col("l_quantity") / 10).cast("double").alias("rating"),
                    F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', "
                           "o_orderdate)").alias("timestamp")))


def movies(part: DataFrame) -> DataFrame:
    """(movieId, title, genres) from part; genres = name words joined by '|'."""
    return part.select(F.col("p_partkey").alias("movieId"),
                       F.col("p_name").alias("title"),
                       F.regexp_replace("p_name", " ", "|").alias("genres"))


def user_segments(customer: DataFrame) -> DataFrame:
    """(userId, cluster): a data-derived grouping of users (market segment)."""
    return customer.select(F.col("c_custkey").alias("userId"),
                           F.col("c_mktsegment").alias("cluster"))


PARTICLE_STANDIN_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def particle_text(lineitem: DataFrame) -> DataFrame:
    """The particle CSV as text: label then four features, all strings.

    label = 1 when l_quantity * (1 - l_discount) > 24, else 0 (a learnable
    rule).  ``row_key`` identifies the row for deterministic sampling.
    """
    label = F.when(F.col("l_quantity") * (1 - F.col("l_discount")) > 24,
                   F.lit(1.0)).otherwise(F.lit(0.0))
    return lineitem.select(
        row_key().alias("row_key"),
        label.cast("string").alias("label"),
        *[F.col(c).cast("string").alias(c) for c in PARTICLE_STANDIN_FEATURES])


def row_key() -> F.Column:
    """A text key of a lineitem row (order, line, part, supplier)."""
    return F.concat_ws("|", *[F.col(c).cast("string") for c in
                              ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])


CLAIMS_STANDIN_CATEGORICAL = ["Blind_Make", "Cat1", "Cat2", "Cat7", "OrdCat"]
CLAIMS_STANDIN_NUMERIC = ["Row_ID", "Household_ID", "Calendar_Year",
                          "Var1", "Var2", "Var3", "Var4"]


def claims_raw(lineitem: DataFrame, part: DataFrame,
               missing_token: str = "?") -> DataFrame:
    """Claims-shaped rows with ``?`` tokens, from lineitem joined to part.

    A row has a claim with a chance that depends on quantity (Var1), tax (Var2)
    and OrdCat together, decided by a hash of the row; the amount follows price
    and tax.  Cat1 = p_type with PROMO missing; Cat7 = l_returnflag kept only
    when 'R' (so its null-aware mode is missing).
    """
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                         "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                         "l_returnflag", "l_linestatus", "l_shipdate")
    p = part.select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    tok = F.lit(missing_token)
    return (li.join(p, li.l_partkey == p.p_partkey).select(
        row_key().alias("row_key"),
        F.col("l_orderkey").alias("Row_ID"),
        F.col("l_suppkey").alias("Household_ID"),
        F.col("p_brand").alias("Blind_Make"),
        F.when(F.col("p_type") == "PROMO", tok).otherwise(F.col("p_type")).alias("Cat1"),
        F.col("l_linestatus").alias("Cat2"),
        F.when(F.col("l_returnflag") == "R", F.col("l_returnflag")).otherwise(tok).alias("Cat7"),
        (F.pmod(F.col("p_size"), F.lit(5)) + 1).cast("string").alias("OrdCat"),
        F.year("l_shipdate").alias("Calendar_Year"),
        F.col("l_quantity").alias("Var1"),
        F.col("l_tax").alias("Var2"),
        F.col("p_retailprice").alias("Var3"),
        F.col("l_discount").alias("Var4"),
        claim_amount().alias("Claim_Amount")))


def claim_amount() -> F.Column:
    """The claim of a lineitem row joined to its part."""
    chance = (F.lit(0.04) + F.when(F.col("l_quantity") > 35, 0.15).otherwise(0.0)
              + F.when((F.col("l_tax") >= 0.06) & (F.pmod(F.col("p_size"), F.lit(5)) >= 3), 0.35).otherwise(0.0))
    return F.when(uniform(row_key(), 77) < chance,
                  F.col("l_extendedprice") * (F.lit(0.05) + F.col("l_tax"))).otherwise(F.lit(0.0))


def claims_wide(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """The claims CSV in full: 35 columns in file order, with ``?`` for missing cells."""
    letter = lambda key, n: F.expr(f"char(65 + {key} % {n})")
    missing = lambda cond, col: F.when(F.expr(cond), F.lit("?")).otherwise(col)
    cols = {
        "Row_ID": F.col("l_orderkey"), "Household_ID": F.col("l_suppkey"), "Vehicle": F.col("l_linenumber"),
        "Calendar_Year": F.year("l_shipdate"), "Model_Year": F.year("l_shipdate") - F.col("p_size") % 7,
        "Blind_Make": F.col("p_brand"), "Blind_Model": F.concat_ws(".", "p_brand", F.col("p_size") % 5),
        "Blind_Submodel": F.concat_ws(".", "p_brand", "p_size"),
        "Cat1": missing("p_type = 'PROMO'", F.col("p_type")), "Cat2": F.col("l_linestatus"),
        "Cat3": letter("l_partkey", 3), "Cat4": missing("l_linenumber > 5", letter("l_partkey", 4)),
        "Cat5": missing("l_partkey % 5 = 0", letter("l_suppkey", 3)), "Cat6": letter("l_partkey", 6),
        "Cat7": missing("l_returnflag <> 'R'", F.col("l_returnflag")), "Cat8": letter("l_suppkey", 2),
        "Cat9": letter("l_suppkey", 5), "Cat10": letter("l_orderkey", 3), "Cat11": letter("l_orderkey", 7),
        "Cat12": missing("l_suppkey % 11 = 0", letter("l_orderkey", 8)), "OrdCat": (F.col("p_size") % 5 + 1).cast("string"),
        **{f"Var{k}": F.col("l_quantity") * k + F.col("l_tax") for k in range(1, 9)},
        "NVCat": letter("l_linenumber", 9), **{f"NVVar{k}": F.col("l_discount") * k for k in range(1, 5)},
        "Claim_Amount": claim_amount(),
    }
    joined = lineitem.join(part, lineitem.l_partkey == part.p_partkey)
    return joined.select(*[cols[c].alias(c) for c in CLAIMS_FILE_COLUMNS])


def particle_wide(lineitem: DataFrame) -> DataFrame:
    """The particle CSV in full: label and 28 numeric features, without names."""
    label = F.when(F.col("l_quantity") * (1 - F.col("l_discount")) > 24, F.lit(1.0)).otherwise(F.lit(0.0))
    base = ("l_quantity", "l_discount", "l_tax", "l_extendedprice")
    return lineitem.select(label.alias("label"), *[
        (F.col(base[k % 4]) * (k + 1)).alias(name) for k, name in enumerate(PARTICLE_FEATURES)])


_WRITTEN: dict = {}
_WRITE_LOCKS: dict = {}
_WRITE_GUARD = threading.Lock()


def _materialized(spark: SparkSession, sf_dir: str, name: str, build, order_by: str | None = None,
                  fmt: str = "parquet", write=None) -> str:
    """Write a stand-in once per application and data folder; return its path.

    The table goes to the shared checkpoint folder (it survives lost
    executors and cuts the lineage of the joins that built it), under a name
    that no other folder or write shares; nothing is ever overwritten.  With
    ``order_by`` the rows are range-partitioned and sorted on that column,
    so files and row groups cover nearly disjoint ranges and range filters on
    it are pruned by Parquet statistics; a hash of the row is the second
    range key, so equal values of the column spread over several files.
    """
    from quarry.session import checkpoint_dir, scratch_path

    folder = sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, checkpoint_dir(spark), folder, name)
    with _WRITE_GUARD:
        lock = _WRITE_LOCKS.setdefault(key, threading.Lock())
    with lock:  # one writer per table, also when callers run in threads; a build may load other tables
        if key not in _WRITTEN:
            tag = f"{folder.rsplit('/', 1)[-1].replace('.', '_')}_{hashlib.sha1(folder.encode()).hexdigest()[:12]}"
            path = scratch_path(spark, f"{name}_{tag}_{uuid.uuid4().hex[:8]}")
            df = build()
            if order_by:
                df = df.repartitionByRange(order_by, F.xxhash64(*df.columns)).sortWithinPartitions(order_by)
            write(df, path) if write else df.write.format(fmt).save(path)
            _WRITTEN[key] = path
        return _WRITTEN[key]


def load_access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The access-log stand-in as a text source, like the original input.

    Written once per session as gzip text files and scanned with ``read.text``
    (S1): parsing then works on a plain column, as on a real log.
    """
    path = _materialized(spark, sf_dir, "access_log",
                         lambda: access_log(load_table(spark, sf_dir, "events")),
                         write=lambda df, to: df.write.option("compression", "gzip").text(to))
    return read_access_log(spark, path)


def load_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings stand-in, stored ordered by timestamp (see :func:`_materialized`)."""
    path = _materialized(spark, sf_dir, "ratings", lambda: ratings(
        load_table(spark, sf_dir, "orders"), load_table(spark, sf_dir, "lineitem")),
        order_by="timestamp")
    return spark.read.parquet(path)


def _csv(header: bool, compression: str = "none"):
    # gzip at its default level takes longer than all else of the write
    return lambda df, path: (df.write.option("header", header).option("compression", compression)
                             .option("zlib.compress.level", "BEST_SPEED").csv(path))


def load_ratings_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ratings stand-in through a CSV file with header."""
    path = _materialized(spark, sf_dir, "ratings_csv", lambda: load_ratings(spark, sf_dir), write=_csv(True))
    return read_ratings_csv(spark, path)


def load_movies_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The movies stand-in through a CSV file with header."""
    path = _materialized(spark, sf_dir, "movies_csv", lambda: load_movies(spark, sf_dir), write=_csv(True))
    return read_movies_csv(spark, path)


def load_particle_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + P4 + P5: 29 numbers through headerless gzip CSV files."""
    path = _materialized(spark, sf_dir, "particle_csv", lambda: particle_wide(load_table(spark, sf_dir, "lineitem")),
                         write=_csv(False, "gzip"))
    return read_particle_csv(spark, path)


def load_claims_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """35 columns through a CSV file with header and ``?`` cells."""
    path = _materialized(spark, sf_dir, "claims_csv", lambda: claims_wide(
        load_table(spark, sf_dir, "lineitem"), load_table(spark, sf_dir, "part")), write=_csv(True))
    return read_claims_csv(spark, path)


def load_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movies(load_table(spark, sf_dir, "part"))


def load_particle_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return particle_text(load_table(spark, sf_dir, "lineitem"))


def load_claims_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims stand-in with '?' tokens, stored once like the original CSV input."""
    path = _materialized(spark, sf_dir, "claims", lambda: claims_raw(
        load_table(spark, sf_dir, "lineitem"), load_table(spark, sf_dir, "part")))
    return spark.read.parquet(path)


def rule_regression(lineitem: DataFrame) -> DataFrame:
    """Label l_quantity, prediction floor(l_extendedprice / 1500).

    Both are whole numbers, so every sum in the metrics is exact.
    """
    return lineitem.select(F.col("l_quantity").alias("label"),
                           F.floor(F.col("l_extendedprice") / 1500).cast("double").alias("prediction"))


def rule_classification(lineitem: DataFrame) -> DataFrame:
    """Label l_extendedprice > 40000, prediction l_quantity > 25 (both 0/1)."""
    return lineitem.select(
        F.when(F.col("l_extendedprice") > 40000, 1.0).otherwise(0.0).alias("label"),
        F.when(F.col("l_quantity") > 25, 1.0).otherwise(0.0).alias("prediction"))
