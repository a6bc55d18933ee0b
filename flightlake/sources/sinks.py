"""Parquet sinks (A6, A7; A8 is the gold job)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the table at ``path``."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add files to the table at ``path`` (use ``operators.dedupe.append_unique`` to stay repeat-safe).

    Rows are dealt out by partition first, so each partition gets one file for each advisory size of its rows and not one
    for every task that held some.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
