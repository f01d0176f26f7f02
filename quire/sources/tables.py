"""Written intermediate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a DataFrame that feeds several consumers (or must not be recomputed
    differently on retry) to the shared scratch folder, and read it back."""
    from quire.session import scratch_dir
    path = path or scratch_dir(df.sparkSession, "mat")
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
