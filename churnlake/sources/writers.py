"""Dataset writers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_dataset(
    df: DataFrame, path: str, replace: bool = True, rebalance: bool = False
) -> DataFrame:
    """Write a dataset and read it back.

    Rows that come from a stored table are split by size when they are read, so
    their files need no shuffle. ``rebalance`` is for rows from many uneven or
    small partitions: AQE then merges and splits them, at the price of a shuffle.
    """
    mode = "overwrite" if replace else "errorifexists"
    sized = df.hint("rebalance") if rebalance else df
    sized.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_report(df: DataFrame, path: str, replace: bool = True) -> DataFrame:
    """Write a table of few rows as one file."""
    mode = "overwrite" if replace else "errorifexists"
    df.coalesce(1).write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
