"""The stored silver table: partitioned by date, written by one keyed append that batch and stream share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flightlake.operators.dedupe import append_unique, keep_first
from flightlake.operators.silver import SILVER_KEYS
from flightlake.session import materialize
from flightlake.sources.readers import read_stored
from flightlake.sources.sinks import write_append

# Partition column: the date (UTC) of the key's time; NULL times share the default partition.
SILVER_PARTITION = "flight_date"


def flight_date(time_col: str = "time_position") -> Column:
    """Date of the epoch seconds in ``time_col``. Times too large for a date count as NULL."""
    seconds = F.col(time_col).try_cast("bigint")
    sane = seconds.between(-62135596800, 253402300799)
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.when(sane, seconds) / 86400).cast("int"))


def read_silver(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored rows without the partition column, or None when nothing is stored."""
    stored = read_stored(spark, path)
    return stored.drop(SILVER_PARTITION) if stored is not None else None


def append_silver(rows: DataFrame, path: str, keys: Sequence[str] = SILVER_KEYS, time_col: str = "time_position") -> None:
    """Add the rows whose key is not stored yet, one per key (the smallest by the other columns).

    The new rows are written once to the shared folder. A stored key of another date cannot equal a new one, so only
    the partitions of the new rows' own dates are read (of rows without a date only if the batch has such rows), and of these
    the key columns alone. Adding the same rows again adds nothing, so a batch that is tried again is safe.
    """
    spark = rows.sparkSession
    keys = list(keys)
    new = materialize(rows.withColumn(SILVER_PARTITION, flight_date(time_col)), "silver-new")
    stored = read_stored(spark, path, new.schema)
    if stored is None:
        fresh = keep_first(new, keys)
    else:
        dates = [r[0] for r in new.select(SILVER_PARTITION).distinct().collect()]  # at most the days of the calendar
        wanted = F.col(SILVER_PARTITION).isin([d for d in dates if d is not None])
        if None in dates:
            wanted = wanted | F.col(SILVER_PARTITION).isNull()
        fresh = append_unique(stored.filter(wanted), new, keys)
    write_append(fresh, path, [SILVER_PARTITION])
