"""Data-quality profile (L6): counts, nulls, describe, duplicates, threshold / box filters, top-N."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from flightlake.fixed import EUROPE_LAT, EUROPE_LON, HIGH_FLYER_ALTITUDE, TOP_N
from flightlake.functions.columns import safe_cast
from flightlake.operators.dedupe import duplicate_count


def row_count(df: DataFrame) -> DataFrame:
    """D6 as a one-row frame (the count stays on the executors until the caller acts)."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def group_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per group."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count of every column, one row, one column per input column."""
    cols = list(columns or df.columns)
    return df.select([F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def describe_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample stddev, min, max of numeric and text columns; one wide row.

    Column names are ``<column>_<statistic>``. (``DataFrame.describe`` returns the same values as
    text in long form; the wide row keeps types and is a single aggregation.) Mean and deviation of text are those
    of the values that parse as numbers (NULL if none does); its minimum and maximum are text.
    """
    kinds = dict(df.dtypes)
    aggs = []
    for c in columns:
        number = safe_cast(c, "double") if kinds[c] == "string" else F.col(c)
        aggs += [
            F.count(c).alias(f"{c}_count"),
            F.avg(number).alias(f"{c}_mean"),
            F.stddev_samp(number).alias(f"{c}_stddev"),
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
        ]
    return df.agg(*aggs)


DESCRIBE_STATS = ["count", "mean", "stddev", "min", "max"]


def describe_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """D7 in the long layout of ``DataFrame.describe`` (a ``summary`` column, one row per statistic),
    with typed values: the single wide aggregation above, then a 5-row unpivot of its one row. Numeric columns
    hold doubles, text columns text."""
    wide = describe_stats(df, columns)
    kinds = {c: "string" if kind == "string" else "double" for c, kind in df.dtypes}
    rows = [
        F.struct(F.lit(stat).alias("summary"), *[F.col(f"{c}_{stat}").cast(kinds[c]).alias(c) for c in columns])
        for stat in DESCRIBE_STATS
    ]
    return wide.select(F.inline(F.array(*rows)))


def describable(df: DataFrame) -> list[str]:
    """The columns a notebook's ``describe`` covers: numbers and text, not flags or times."""
    return [c for c, kind in df.dtypes if kind in ("string", "tinyint", "smallint", "int", "bigint", "float", "double")
            or kind.startswith("decimal")]


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """D7 in the long form of ``DataFrame.describe``: one row per statistic, values as text."""
    return df.select(*columns).describe()


def quality_profile(df: DataFrame, keys: Sequence[str], numeric: Sequence[str],
                    order_by: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The notebook checks as lazy frames (nothing runs until the caller acts on one)."""
    return {
        "row_count": row_count(df),
        "null_counts": null_profile(df),
        "describe": describe_stats(df, numeric),
        "duplicates": duplicate_count(df, keys),
        "preview": preview(df, order_by or list(keys)),
    }


def high_flyers(df: DataFrame, min_altitude: float = HIGH_FLYER_ALTITUDE, col: str = "baro_altitude") -> DataFrame:
    """Rows strictly above the altitude threshold (pushed to the parquet scan)."""
    return df.filter(F.col(col) > F.lit(min_altitude))


def bounding_box(df: DataFrame, lat_range=EUROPE_LAT, lon_range=EUROPE_LON,
                 lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Rows inside an inclusive latitude/longitude box."""
    return df.filter(F.col(lat).between(*lat_range) & F.col(lon).between(*lon_range))


def top_groups_by_count(df: DataFrame, key: str, n: int = TOP_N) -> DataFrame:
    """D5 + F2 + G2: the ``n`` largest groups by rows, key as tie-break.

    ``orderBy(...).limit(n)`` plans as ``TakeOrderedAndProject``: each task keeps its own top n and
    only those travel to the final merge.
    """
    return (
        group_counts(df, key)
        .orderBy(F.col("count").desc(), F.col(key).asc_nulls_first())
        .limit(n)
    )


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """G1: a bounded, deterministic preview (first ``n`` rows in a fixed order)."""
    return df.orderBy(*order_by).limit(n)
