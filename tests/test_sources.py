"""File sources with explicit schemas."""

import gzip
import os
import tempfile

from pyspark.sql import functions as F

from quarry.sources import files


def _write(path, text, gz=False):
    if gz:
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        with open(path, "w") as f:
            f.write(text)


def test_read_access_log_gzip(spark):
    d = tempfile.mkdtemp(prefix="quarry-src-")
    p = os.path.join(d, "log.gz")
    _write(p, 'a.ac.uk - - [01/Jul/1995:00:00:01 -0400] "GET / HTTP/1.0" 200 10\nx\n', gz=True)
    df = files.read_access_log(spark, p, partitions=2)
    assert df.columns == ["value"] and df.count() == 2


def test_read_ratings_and_movies(spark):
    d = tempfile.mkdtemp(prefix="quarry-src-")
    _write(os.path.join(d, "ratings.csv"), "userId,movieId,rating,timestamp\n1,10,4.5,964982703\n")
    _write(os.path.join(d, "movies.csv"), 'movieId,title,genres\n1,"Toy Story (1995)",Adventure|Animation\n')
    r = files.read_ratings_csv(spark, os.path.join(d, "ratings.csv")).first()
    assert (r.userId, r.movieId, r.rating, r.timestamp) == (1, 10, 4.5, 964982703)
    m = files.read_movies_csv(spark, os.path.join(d, "movies.csv")).first()
    assert m.title == "Toy Story (1995)" and m.genres == "Adventure|Animation"


def test_read_particle_csv_names_and_casts(spark):
    d = tempfile.mkdtemp(prefix="quarry-src-")
    row = ",".join(["1.0"] + [str(i) for i in range(28)])
    bad = ",".join(["0.0", "oops"] + [str(i) for i in range(27)])
    p = os.path.join(d, "particle.csv.gz")
    _write(p, row + "\n" + bad + "\n", gz=True)
    df = files.read_particle_csv(spark, p, partitions=2)
    assert df.columns == ["label"] + files.PARTICLE_FEATURES
    assert all(t == "double" for _, t in df.dtypes)
    rows = sorted(df.collect(), key=lambda r: r.label)
    assert rows[0].lepton_pT is None and rows[1].jet_1_btag == 8.0


def test_read_claims_csv_missing_token(spark):
    d = tempfile.mkdtemp(prefix="quarry-src-")
    p = os.path.join(d, "claims.csv")
    _write(p, "Row_ID,Cat1,Var1,Claim_Amount\n1,A,?,0\n2,?,1.5,3.25\n")
    df = files.read_claims_csv(spark, p, schema="Row_ID int, Cat1 string, Var1 double, Claim_Amount double")
    rows = sorted(df.collect())
    assert rows[0].Var1 is None and rows[1].Cat1 is None and rows[1].Claim_Amount == 3.25


def test_freeze_round_trip(spark):
    df = spark.range(10)
    back = files.freeze(df, "test_freeze_round_trip")
    assert sorted(r.id for r in back.collect()) == list(range(10))


def test_folders_of_one_name_stay_apart(spark, tmp_path):
    from quarry.sources import standins as si

    for side, n in (("a", 30), ("b", 7)):
        folder = tmp_path / side / "sf9"
        folder.mkdir(parents=True)
        spark.range(n).selectExpr("id AS o_orderkey", "id % 3 AS o_custkey", "timestamp_ntz'1995-01-01 00:00:00' AS o_orderdate") \
            .write.parquet(str(folder / "orders.parquet"))
        spark.range(n).selectExpr("id AS l_orderkey", "id % 5 AS l_partkey", "CAST(id AS DOUBLE) AS l_quantity") \
            .write.parquet(str(folder / "lineitem.parquet"))
    first = si.load_ratings(spark, str(tmp_path / "a" / "sf9"))
    second = si.load_ratings(spark, str(tmp_path / "b" / "sf9"))
    assert (first.count(), second.count(), first.count()) == (30, 7, 30)


def test_one_timestamp_spreads_over_files(spark, tmp_path):
    from pyspark.sql import functions as F

    from quarry.sources import standins as si

    folder = tmp_path / "hot"
    folder.mkdir()
    spark.range(9000).selectExpr("id AS o_orderkey", "id AS o_custkey",
                                 "timestamp_ntz'1995-01-01 00:00:00' + make_dt_interval(CASE WHEN id % 3 = 0 THEN 0 ELSE CAST(id AS INT) END) AS o_orderdate") \
        .write.parquet(str(folder / "orders.parquet"))
    spark.range(9000).selectExpr("id AS l_orderkey", "id AS l_partkey", "CAST(id AS DOUBLE) AS l_quantity") \
        .write.parquet(str(folder / "lineitem.parquet"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = si.load_ratings(spark, str(folder)).groupBy(F.input_file_name()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in rows]
    assert len(sizes) > 1 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_particle_width_is_checked(spark, tmp_path):
    import pytest

    from quarry.sources.files import read_particle_csv

    (tmp_path / "narrow.csv").write_text("1.0,2.0,3.0\n")
    with pytest.raises(ValueError):
        read_particle_csv(spark, str(tmp_path / "narrow.csv"))


def test_every_stand_in_opens_in_a_fresh_process():
    """Each loader alone, under a limit: none may wait for a lock that it holds itself."""
    import subprocess
    import sys

    code = (
        "from quarry.session import local_session\n"
        "from quarry.sources import standins as si\n"
        "spark = local_session(cores=2, shuffle_partitions=2)\n"
        "for name in ('ratings_csv', 'movies_csv', 'particle_csv', 'claims_csv', 'access_log', 'ratings', 'claims_raw'):\n"
        "    print(name, getattr(si, 'load_' + name)(spark, '/root/testdata/sf0.001').count())\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=240)
    assert out.returncode == 0, out.stderr[-2000:]
    assert len(out.stdout.split()) == 14 and "0" not in out.stdout.split()[1::2]


def test_the_log_stand_in_is_gzipped(spark, sf_small):
    from quarry.sources import standins as si

    log = si.load_access_log(spark, sf_small)
    names = {r[0] for r in log.select(F.input_file_name()).distinct().collect()}
    assert names and all(n.endswith(".txt.gz") for n in names)
