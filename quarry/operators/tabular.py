"""Tabular preparation (workflow W-D front half): X9, X10, A9, A11, M1-M3, P9.

Column-wise statistics of all columns come from one job.  A mode is counted on
the column's own type, and only columns that hold nulls are filled.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def token_to_null(df: DataFrame, token: str = "?", cols: list[str] | None = None) -> DataFrame:
    """Cells equal to ``token`` become null (string columns only)."""
    targets = set(cols if cols is not None else _string_columns(df))
    return df.select(*[F.nullif(F.col(c), F.lit(token)).alias(c) if c in targets else F.col(c)
                       for c in df.columns])


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column_name, null_count) for every column, from one aggregation."""
    cols = cols or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "null_count")


def mode_nullaware(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """The most frequent value of each column, null counting as a value.

    Output (column_name, mode, mode_count); ``mode`` is the value as text.
    Ties go to the smaller text, null first.  Each column is counted on its own
    type from its own column-pruned scan, and its top row is a limit, so one row
    per column and task goes on; the columns' counts are one job.
    """
    cols = cols or df.columns
    parts = []
    for c in cols:
        text = F.col(c).cast("string")
        counts = df.groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(counts.select(F.lit(c).alias("column_name"), text.alias("mode"), F.col("_n").alias("mode_count"))
                     .orderBy(F.col("mode_count").desc(), F.col("mode").asc_nulls_first()).limit(1))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def mode_fill(df: DataFrame, cols: list[str] | None = None,
              keep: list[str] | None = None) -> tuple[DataFrame, dict]:
    """X10 + D14: fill nulls with each column's mode; drop columns whose mode is null.

    Returns (filled frame, {column: mode}).  One row per column reaches the
    driver.  ``keep`` columns pass through untouched.  When the modes themselves
    are not wanted, :func:`fill_nulls` does less.
    """
    keep = set(keep or [])
    cols = [c for c in (cols or df.columns) if c not in keep]
    modes = {r["column_name"]: r["mode"] for r in mode_nullaware(df, cols).collect()}
    return apply_modes(df, modes), {c: m for c, m in modes.items() if m is not None}


def fill_nulls(df: DataFrame, cols: list[str]) -> DataFrame:
    """X10 + D14 on ``cols``: as :func:`mode_fill`, with modes of the columns that hold nulls only."""
    return apply_modes(df, modes_for_fill(df, cols))


def modes_for_fill(df: DataFrame, cols: list[str]) -> dict:
    """{column: mode text or None} of the columns with nulls, found by one null profile."""
    gaps = [r["column_name"] for r in null_profile(df, cols).collect() if r["null_count"]]
    return {r["column_name"]: r["mode"] for r in mode_nullaware(df, gaps).collect()} if gaps else {}


def apply_modes(df: DataFrame, modes: dict) -> DataFrame:
    """Fill nulls from {column: mode text}; drop columns whose mode is None.

    Columns not in ``modes`` pass through unchanged.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in df.columns:
        if c not in modes:
            out.append(F.col(c))
        elif modes[c] is not None:
            out.append(F.coalesce(F.col(c), F.lit(modes[c]).cast(types[c])).alias(c))
    return df.select(*out)


def index_columns(df: DataFrame, cols: list[str], suffix: str = "_index",
                  handle_invalid: str = "error"):
    """M2: StringIndexer over several columns (most frequent label -> 0.0).

    Returns (fitted model, transformed frame).  Label arrays are bounded by
    the category count, which the fit brings to the driver by design.
    """
    indexer = StringIndexer(inputCols=cols, outputCols=[c + suffix for c in cols],
                            stringOrderType="frequencyDesc", handleInvalid=handle_invalid)
    model = indexer.fit(df)
    return model, model.transform(df)


def one_hot(df: DataFrame, index_cols: list[str], suffix: str = "_ohe",
            drop_last: bool = True):
    """M3: OneHotEncoder over index columns; returns (model, frame)."""
    enc = OneHotEncoder(inputCols=index_cols, outputCols=[c + suffix for c in index_cols],
                        dropLast=drop_last)
    model = enc.fit(df)
    return model, model.transform(df)


def hot_position(vec_col: str) -> tuple[F.Column, F.Column]:
    """(size, hot index or null) of a one-hot vector column, for checks."""
    arr = vector_to_array(F.col(vec_col))
    pos = F.array_position(arr, F.lit(1.0))
    return F.size(arr), F.when(pos > 0, (pos - 1).cast("int"))


def claim_flag(df: DataFrame, target: str = "Claim_Amount", out: str = "binary") -> DataFrame:
    """1 when the claim is positive, else 0 (null counts as 0)."""
    return df.withColumn(out, F.when(F.col(target) > 0, F.lit(1)).otherwise(F.lit(0)))


def assemble(cols: list[str], out: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    """M1: VectorAssembler over the given inputs."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid=handle_invalid)


def encode_pipeline(cat_cols: list[str], handle_invalid: str = "error") -> Pipeline:
    """M4: index then one-hot every categorical column."""
    idx = [c + "_index" for c in cat_cols]
    return Pipeline(stages=[
        StringIndexer(inputCols=cat_cols, outputCols=idx, stringOrderType="frequencyDesc",
                      handleInvalid=handle_invalid),
        OneHotEncoder(inputCols=idx, outputCols=[c + "ohe" for c in cat_cols],
                      handleInvalid=handle_invalid),
    ])
