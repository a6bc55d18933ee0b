"""Join helpers whose broadcast side has a checked size bound."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import BinaryType, StringType

from flightlake.session import materialize

# Bytes of a side shipped to every executor.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def row_bytes(df: DataFrame) -> Column:
    """Size of a row in a hashed relation: fixed parts (8 bytes a field, and overhead) and text lengths."""
    total = F.lit(48 + 8 * len(df.columns)).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            total = total + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
    return total


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES, name: str = "side") -> tuple[DataFrame, bool]:
    """Write ``df`` to the shared folder; hint it for broadcast only when it proves to be small.

    Rows and text bytes are added up while the side is written (by all tasks, no extra job), so the side is
    computed once and the bound is in bytes. Beyond it the frame is returned unhinted and Spark plans a shuffled
    (sort-merge) join, with AQE splitting skewed keys.
    """
    seen = Observation(f"bytes-{name}")
    side = materialize(df.observe(seen, F.sum(row_bytes(df)).alias("bytes")), name)
    small = (seen.get["bytes"] or 0) <= max_bytes
    return (F.broadcast(side) if small else side), small


def semi_join_bounded(big: DataFrame, keys_df: DataFrame, keys: Sequence[str],
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``big LEFT SEMI JOIN keys_df`` with a broadcast of the key side when its size is proven small."""
    side, _ = broadcast_if_small(keys_df.select(*keys), max_bytes, "semi-keys")
    return big.join(side, list(keys), "left_semi")
