"""Key de-duplication (D10), duplicate counting (D9) and the repeat-safe append."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest row by ``order_by`` then every remaining column.

    Written as ``groupBy(keys).agg(min(struct(...)))`` instead of a ``row_number`` window: the
    minimum is combined map-side before the shuffle, so a key that holds a large share of all rows
    (many copies of one record) collapses to one row per task and never lands whole in one task.
    NULL keys form one group (as ``dropDuplicates`` does); NULL fields sort first in the struct.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordered = [c for c in order_by if c in rest] + [c for c in rest if c not in order_by]
    if not ordered:
        return df.select(*keys).distinct()
    survivor = F.min(F.struct(*[F.col(c) for c in ordered])).alias("_kf_row")
    return df.groupBy(*keys).agg(survivor).select(*keys, *[F.col(f"_kf_row.{c}").alias(c) for c in ordered]).select(
        *df.columns
    )


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: total rows, distinct keys and rows beyond the first per key, in one aggregation pass."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def append_unique(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  order_by: Sequence[str] = ()) -> DataFrame:
    """Rows of ``incoming`` whose key is not yet in ``existing`` (one per key), ready to append.

    One aggregation does both the de-duplication and the "already stored?" test: the stored keys
    (only the key columns are read) are unioned with the incoming rows, grouped by key, and groups
    that contain a stored key are dropped. Grouping treats NULL keys as equal, so re-running a batch
    adds nothing; copies are combined map-side, so a hot key never reaches one task whole.
    """
    keys = list(keys)
    rest = [c for c in incoming.columns if c not in keys]
    ordered = [c for c in order_by if c in rest] + [c for c in rest if c not in order_by]
    row = F.struct(*[F.col(c) for c in ordered])
    fresh = incoming.select(*keys, row.alias("_au_row"), F.lit(False).alias("_au_old"))
    row_type = fresh.schema["_au_row"].dataType
    stored = existing.select(
        *[F.col(k).cast(incoming.schema[k].dataType).alias(k) for k in keys],
        F.lit(None).cast(row_type).alias("_au_row"),
        F.lit(True).alias("_au_old"),
    )
    grouped = fresh.unionByName(stored).groupBy(*keys).agg(
        F.min("_au_row").alias("_au_row"), F.max("_au_old").alias("_au_old")
    )
    return grouped.filter(~F.col("_au_old")).select(
        *keys, *[F.col(f"_au_row.{c}").alias(c) for c in ordered]
    ).select(*incoming.columns)
