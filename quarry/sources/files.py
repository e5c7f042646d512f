"""File sources and sinks.

Every reader takes an explicit schema: no inference pass over the data and
stable column types at any scale.  Gzip text and gzip CSV cannot be split, so
the readers repartition right after the scan when asked, otherwise a single
task would parse the whole file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import scratch_path

ACCESS_LOG_SCHEMA = T.StructType([T.StructField("value", T.StringType())])

RATINGS_SCHEMA = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("movieId", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

MOVIES_SCHEMA = T.StructType([
    T.StructField("movieId", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])

# The column order of the headerless particle CSV (label first,
# then 28 features).  The hyphenated name of the source file is written here
# in snake case.
PARTICLE_FEATURES = [
    "lepton_pT", "lepton_eta", "lepton_phi", "missing_energy_magnitude",
    "missing_energy_phi", "jet_1_pt", "jet_1_eta", "jet_1_phi", "jet_1_btag",
    "jet_2_pt", "jet_2_eta", "jet_2_phi", "jet_2_btag", "jet_3_pt", "jet_3_eta",
    "jet_3_phi", "jet_3_btag", "jet_4_pt", "jet_4_eta", "jet_4_phi",
    "jet_4_btag", "mjj", "mjjj", "mlv", "mjlv", "mbb", "mwbb", "mwwbb",
]

# The claims CSV columns, in file order, and those used by the workflow.
CLAIMS_FILE_COLUMNS = [
    "Row_ID", "Household_ID", "Vehicle", "Calendar_Year", "Model_Year",
    "Blind_Make", "Blind_Model", "Blind_Submodel",
    "Cat1", "Cat2", "Cat3", "Cat4", "Cat5", "Cat6", "Cat7", "Cat8", "Cat9",
    "Cat10", "Cat11", "Cat12", "OrdCat",
    "Var1", "Var2", "Var3", "Var4", "Var5", "Var6", "Var7", "Var8",
    "NVCat", "NVVar1", "NVVar2", "NVVar3", "NVVar4", "Claim_Amount",
]
CLAIMS_CATEGORICAL = [
    "Blind_Make", "Blind_Model", "Blind_Submodel", "Cat1", "Cat2", "Cat3",
    "Cat4", "Cat5", "Cat6", "Cat8", "Cat9", "Cat10", "Cat11", "Cat12",
    "NVCat", "OrdCat",
]
CLAIMS_NUMERIC = [
    "Row_ID", "Household_ID", "Vehicle", "Calendar_Year", "Model_Year",
    "Var1", "Var2", "Var3", "Var4", "Var5", "Var6", "Var7", "Var8",
    "NVVar1", "NVVar2", "NVVar3", "NVVar4",
]

_CLAIMS_TEXT = {*CLAIMS_CATEGORICAL, "Cat7"}
_CLAIMS_WHOLE = {"Row_ID", "Household_ID", "Vehicle", "Calendar_Year", "Model_Year"}
CLAIMS_SCHEMA = T.StructType([
    T.StructField(c, T.StringType() if c in _CLAIMS_TEXT else
                  T.LongType() if c in _CLAIMS_WHOLE else T.DoubleType())
    for c in CLAIMS_FILE_COLUMNS])


def _spread(df: DataFrame, partitions: int | None) -> DataFrame:
    return df.repartition(partitions) if partitions else df


def read_access_log(spark: SparkSession, path: str,
                    partitions: int | None = None) -> DataFrame:
    """One row per log line in column ``value`` (gzip is read whole)."""
    return _spread(spark.read.schema(ACCESS_LOG_SCHEMA).text(path), partitions)


def read_ratings_csv(spark: SparkSession, path: str) -> DataFrame:
    """Ratings CSV with header, typed by schema instead of inference."""
    return spark.read.schema(RATINGS_SCHEMA).option("header", True).csv(path)


def read_movies_csv(spark: SparkSession, path: str) -> DataFrame:
    """Movies CSV with header."""
    return (spark.read.schema(MOVIES_SCHEMA).option("header", True)
            .option("quote", '"').option("escape", '"').csv(path))


def read_particle_csv(spark: SparkSession, path: str,
                      partitions: int | None = None) -> DataFrame:
    """S3 + P4 + P5: headerless CSV of 29 doubles, named in one projection.

    The file must have exactly these columns (its first line is looked at).
    Malformed numbers become null (``try_cast``) rather than failing the job.
    """
    names = ["label"] + PARTICLE_FEATURES
    raw = spark.read.option("header", False).csv(path)
    if len(raw.columns) != len(names):
        raise ValueError(f"expected {len(names)} columns, found {len(raw.columns)}")
    return _spread(cast_all(raw.toDF(*names), "double"), partitions)


def cast_all(df: DataFrame, to: str, only_type: str = "string",
             exclude: tuple[str, ...] = ()) -> DataFrame:
    """P5: cast every column of type ``only_type`` in one projection."""
    cols = []
    for field in df.schema.fields:
        if field.dataType.simpleString() == only_type and field.name not in exclude:
            cols.append(F.col(field.name).try_cast(to).alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)


def read_claims_csv(spark: SparkSession, path: str,
                    schema: T.StructType | str = CLAIMS_SCHEMA,
                    missing_token: str = "?") -> DataFrame:
    """Claims CSV with header; ``missing_token`` cells are read as null."""
    return (spark.read.option("header", True).option("encoding", "UTF-8")
            .option("nullValue", missing_token).schema(schema).csv(path))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write Parquet."""
    df.write.mode(mode).parquet(path)


def freeze(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Materialise ``df`` as a Parquet table and read it back.

    Freezes a random split so every later consumer sees the same rows, and
    cuts the lineage (a lost executor re-reads the table instead of replaying
    the sampling).  The table goes to a new folder in the shared checkpoint
    folder unless a path is given, so a later freeze never overwrites files
    an earlier frame still reads.
    """
    import uuid

    spark = df.sparkSession
    target = path or scratch_path(spark, f"{name}_{uuid.uuid4().hex[:12]}")
    write_parquet(df, target)
    return spark.read.parquet(target)
