"""Which stored files can hold a key: time range and Bloom filter per file, kept as a side table.

The filters are built from Spark's bitmap functions alone. A file's keys are spread over blocks of 32,768 bits
by a hash; a key sets ``PROBES`` bits of its block. A row of the side table is one block of one file, so filters of any
size are built and searched as plain rows, with nothing gathered in one place.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from flightlake.operators.joins import broadcast_if_small
from flightlake.sources.versions import DAY

BLOCK_BITS = 32_768
KEYS_PER_BLOCK = 2_048
PROBES = 6
# Stands for a time that is no number, so that it has a place in a file's range.
NO_TIME = -(1 << 63)


def seconds(time_col: str) -> Column:
    return F.coalesce(F.col(time_col).try_cast("bigint"), F.lit(NO_TIME).cast("long"))


def _positions(one: Column, two: Column) -> list[Column]:
    return [F.pmod(one + two * F.lit(i), F.lit(BLOCK_BITS)).cast("int") for i in range(PROBES)]


def _hashes(keys: Sequence[str]) -> list[Column]:
    """Three numbers of 31 bits: two for the bits in a block, one for the block. Sums of them cannot overflow."""
    texts = [F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys]
    one, two = F.xxhash64(F.lit(0), *texts), F.xxhash64(F.lit(1), *texts)
    return [F.shiftrightunsigned(one, 33).alias("_h1"), F.shiftrightunsigned(two, 33).alias("_h2"),
            F.pmod(one, F.lit(1 << 31)).alias("_h3")]


def build_filters(stored: DataFrame, keys: Sequence[str], time_col: str) -> DataFrame:
    """``file, flight_date, lo, hi, blocks, block, bits`` of the files that ``stored`` (a file scan) reads.

    ``file`` is the path below the ``run=`` folder's parent, so a table can be moved. Only key columns are read.
    """
    place = F.regexp_extract(F.col("_metadata.file_path"), rf"run=[^/]+/{DAY}=[^/]+/[^/]+$", 0)
    rows = stored.select(place.alias("file"), DAY, seconds(time_col).alias("_t"), *_hashes(keys))
    files = rows.groupBy("file").agg(F.min("_t").alias("lo"), F.max("_t").alias("hi"),
                                     F.ceil(F.count(F.lit(1)) / F.lit(KEYS_PER_BLOCK)).alias("blocks"))
    files, _ = broadcast_if_small(files, name="filter-files")
    bits = rows.join(files, "file").select("file", DAY, "lo", "hi", "blocks", F.pmod("_h3", "blocks").alias("block"), F.explode(
        F.array(*_positions(F.col("_h1"), F.col("_h2")))).alias("_p"))
    return bits.groupBy("file", DAY, "lo", "hi", "blocks", "block").agg(F.bitmap_construct_agg("_p").alias("bits"))


def _bit(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), position % 8)) % 2 == 1


def candidate_files(new: DataFrame, filters: DataFrame, keys: Sequence[str], time_col: str) -> DataFrame:
    """``file``: those that may hold a key of ``new``; no file that holds one is missing.

    A file is looked at for the keys of its day and time range only, so the newest hour of a day passes over all
    files of the hours before it, and a few late rows over all files whose filter lacks them.
    """
    day = F.coalesce(F.col(DAY).cast("string"), F.lit(""))
    wanted = new.select(day.alias("_day"), seconds(time_col).alias("_t"), *_hashes(keys))
    ranges, _ = broadcast_if_small(filters.select("file", day.alias("_day"), "lo", "hi", "blocks").distinct(), name="file-ranges")
    probes = wanted.join(ranges, "_day").where(F.col("_t").between(F.col("lo"), F.col("hi"))).select(
        "file", F.pmod("_h3", "blocks").alias("block"), "_h1", "_h2")
    blocks = filters.select("file", "block", "bits")
    held = reduce(lambda a, b: a & b, [_bit(F.col("bits"), p) for p in _positions(F.col("_h1"), F.col("_h2"))])
    return probes.join(blocks, ["file", "block"]).where(held).select("file").distinct()
