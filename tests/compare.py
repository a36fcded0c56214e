"""Side-by-side comparison of a query with its SQL check."""

from __future__ import annotations

import glob
import os

import duckdb
import numpy as np
import pandas as pd


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    """Whole numbers alike, since a column of whole numbers with NULLs comes as floats from one side."""
    if isinstance(value, (float, np.floating)) and value == int(value):
        return int(value)
    return value


def as_rows(pdf: pd.DataFrame) -> list[tuple]:
    ordered = pdf[sorted(pdf.columns)].astype(object).where(pdf[sorted(pdf.columns)].notna(), None)
    return sorted((tuple(str(_plain(v)) for v in row) for row in ordered.itertuples(index=False)))


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if equal, else what differs first."""
    got, want = spark_df.toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} instead of {sorted(want.columns)}"
    kinds = [(c, str(got[c].dtype), str(want[c].dtype)) for c in got.columns if len(got)]
    # times differ in unit only; booleans with NULLs come as objects, whole numbers with NULLs as floats
    alike = ({"object", "boolean"}, {"float64", "Int64"})
    off = [k for k in kinds if k[1] != k[2] and "datetime" not in k[1] and {k[1], k[2]} not in alike]
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    mine, theirs = as_rows(got), as_rows(want)
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{a} instead of {b}"
    return f"types {off}" if off else None
