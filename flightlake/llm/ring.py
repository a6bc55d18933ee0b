"""Consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only.

The ring has 65,536 cells. A row's cell comes from the hash of its text, a virtual node's from the hash of its
shard and number; a row belongs to the first virtual node at or after its cell (its arc). Shard capacities add up
to exactly the number of rows and differ by one at most. Rows of an arc beyond the room of its shard go on
clockwise to the next virtual nodes whose shards have room, so counts end at most one apart and only the overflow
moves.

Rows are counted by arc (at most shards * vnodes counts, a parameter and not data, go to the driver); the overflow is
worked out on the counts, as intervals of ranks within an arc; rows get their rank within the arc in Spark (hot arcs,
such as one text with a third of all rows, in salted buckets) and join the few intervals.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, functions as F

from flightlake.llm.common import rank_in_groups
from flightlake.session import materialize_counted

CELLS = 65_536
VNODES = 128


def ring_nodes(spark: SparkSession, shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node in clockwise order; of several in one cell the smallest shard's."""
    nodes = spark.range(shards * vnodes).select(
        F.shiftrightunsigned(F.xxhash64(F.lit("ring"), F.floor(F.col("id") / vnodes), F.col("id") % vnodes), 48).alias("cell"),
        F.floor(F.col("id") / vnodes).cast("int").alias("shard"))
    return sorted((r["cell"], r["shard"]) for r in nodes.groupBy("cell").agg(F.min("shard").alias("shard")).collect())


def fill(counts: list[int], owners: list[int], capacity: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Intervals (arc, first rank, end rank, shard, first slot) that place every row of every arc.

    First each arc's own rows take their shard's room, arc after arc; then one clockwise turn (a second for what
    passes the start) hands the overflow to the next virtual nodes with room.
    """
    room, used, out, waiting = list(capacity), defaultdict(int), [], []

    def take(arc: int, start: int, end: int, shard: int) -> int:
        n = min(end - start, room[shard])
        if n:
            out.append((arc, start, start + n, shard, used[shard]))
            used[shard] += n
            room[shard] -= n
        return start + n

    left = [take(arc, 0, n, owners[arc]) for arc, n in enumerate(counts)]
    for turn in range(2):
        for arc, n in enumerate(counts):
            still = []
            for item, start, end in waiting:
                start = take(item, start, end, owners[arc])
                if start < end:
                    still.append((item, start, end))
            waiting = still
            if not turn and left[arc] < n:
                waiting.append((arc, left[arc], n))
    return out


def ring_shards(docs: DataFrame, shards: int = 24, vnodes: int = VNODES, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document row: id, size, text_crc32, shard, slot (0, 1, ... in each shard), arc and own_shard.

    Row counts of shards differ by one at most (the first shards have the odd rows). ``own_shard`` is the shard
    before overflow. Null text counts as empty, null ids are placed like any other, repeated rows are rows of their own
    (equal rows may swap slots), an empty table gives no rows. Equal texts share an arc, so they stay in one shard
    unless it fills up. Other columns are not read.
    """
    if shards < 1 or vnodes < 1:
        raise ValueError("shards and vnodes must be positive")
    spark = docs.sparkSession
    nodes = ring_nodes(spark, shards, vnodes)
    arcs, at = [], 0
    for cell in range(CELLS):
        while at < len(nodes) and nodes[at][0] < cell:
            at += 1
        arcs.append((cell, at % len(nodes)))
    # 65,536 rows of two integers: a size fixed by the ring, not by the data.
    cells = spark.createDataFrame(arcs, "cell long, arc int")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"), F.xxhash64(text).alias("key"))
    rows = rows.withColumn("cell", F.shiftrightunsigned("key", 48)).join(F.broadcast(cells), "cell").drop("cell")
    rows, n = materialize_counted(rows, "ring-rows")
    counts = [0] * len(nodes)
    for r in rows.groupBy("arc").count().collect():
        counts[r["arc"]] = r["count"]
    capacity = [n // shards + (s < n % shards) for s in range(shards)]
    placed = fill(counts, [shard for _, shard in nodes], capacity)
    # At most two intervals per virtual node and shard that fills: bounded by the ring's parameters.
    intervals = spark.createDataFrame(placed, "arc int, lo long, hi long, shard int, base long")
    owners = spark.createDataFrame([(i, s) for i, (_, s) in enumerate(nodes)], "arc int, own_shard int")
    ranked = rank_in_groups(rows, "arc", ["key", "id", "size", "crc"])
    return (ranked.join(F.broadcast(intervals), "arc").where("rank >= lo and rank < hi").join(F.broadcast(owners), "arc")
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
                    (F.col("base") + F.col("rank") - F.col("lo")).alias("slot"), "arc", "own_shard"))
