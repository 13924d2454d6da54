"""Frames for tests."""

from __future__ import annotations

import numpy as np
import pandas as pd

from meteospark.catalog import FEATURES


def frame(spark, pdf: pd.DataFrame):
    """A DataFrame with NULL for NaN and TIMESTAMP_NTZ times."""
    plain = lambda v: None if pd.isna(v) else v.to_pydatetime() if isinstance(v, pd.Timestamp) else v
    rows = [tuple(plain(v) for v in row) for row in pdf.itertuples(index=False, name=None)]
    return spark.createDataFrame(rows, schema=_schema(pdf))


def _schema(pdf):
    kinds = {"f": "double", "i": "bigint", "b": "boolean", "M": "timestamp_ntz"}
    return ", ".join(f"{c} {kinds.get(pdf[c].dtype.kind, 'string')}" for c in pdf.columns)


def hours(n: int, start: str = "2024-01-30 00:00:00", seed: int = 0, nulls: float = 0.0, station: str = "a"):
    """Hourly rows of all features; the default start puts a month border inside."""
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"station_id": station, "ts": pd.date_range(start, periods=n, freq="h")})
    for f in FEATURES:
        values = rng.normal(20, 5, n).round(3)
        values[rng.random(n) < nulls] = np.nan
        pdf[f] = values
    return pdf


def to_pandas(df, by=("station_id", "ts")):
    return df.orderBy(*by).toPandas()
