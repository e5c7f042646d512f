"""Compare a Spark result with its DuckDB oracle (order-insensitive)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd

from quarry.sources.tables import TABLES


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits):
    if v is None or v is pd.NaT or v is pd.NA:
        return None
    if isinstance(v, np.generic):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits) if digits is not None else v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, np.ndarray):
        return tuple(_norm(x, digits) for x in v.tolist())
    if isinstance(v, list):
        return tuple(v)
    return v


def canonical_rows(pdf: pd.DataFrame, digits=None) -> list[tuple]:
    """Rows with columns sorted by name and values normalised, then sorted."""
    cols = sorted(pdf.columns)
    out = [tuple(_norm(x, digits) for x in rec) for rec in pdf[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> dict:
    same_cols = sorted(spark_pdf.columns) == sorted(duck_pdf.columns)
    result = {"rows": (len(spark_pdf), len(duck_pdf)), "same_columns": same_cols,
              "exact": False, "round6": False}
    if same_cols:
        result["exact"] = canonical_rows(spark_pdf) == canonical_rows(duck_pdf)
        result["round6"] = canonical_rows(spark_pdf, 6) == canonical_rows(duck_pdf, 6)
    return result
