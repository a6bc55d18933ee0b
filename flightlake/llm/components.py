"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flightlake.session import materialize, materialize_counted

MAX_ROUNDS = 60


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star then one small-star step; a neighbourhood is never gathered, only its minimum."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("m"))
    large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .where("u != v").distinct())
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    hooked = large.join(least, "u")
    return (hooked.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(hooked.select("u", F.col("m").alias("v")))
            .where("u != v").distinct())


def components(links: DataFrame) -> DataFrame:
    """``links`` (columns u, v; nulls and loops ignored) -> one row per linked node: ``node, root``.

    ``root`` is the smallest node that can be reached. Each round is written to the shared folder (lineage is
    cut, lost executors cost one round) with its row count and a checksum seen while it is written; rounds end
    when both stay the same, which the star steps reach after about log^2 of the longest chain.
    """
    edges = links.where("u is not null and v is not null and u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, n = materialize_counted(edges, "links")
    if n:
        last = None
        for _ in range(MAX_ROUNDS):
            edges = materialize(_stars(edges), "stars")
            seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
            if tuple(seen) == last:
                break
            last = tuple(seen)
        else:
            raise RuntimeError(f"components: no fixed point after {MAX_ROUNDS} rounds")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
