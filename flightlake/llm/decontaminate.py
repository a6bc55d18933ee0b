"""Benchmark decontamination: size-partitioned MinHash containment search, in DataFrame operations only.

A test item is short, a document may be long, so the measure is containment: the share of an item's distinct
five-word shingles that a document holds. Items are put into size classes by powers of two. An item of a class
with at most q shingles is sketched by its k = floor((1 - threshold) * q) + 1 smallest shingle hashes (the
bottom-k form of MinHash). A document that holds at least ``threshold`` of the item's shingles misses at most
k - 1 of them, so it holds one of the sketch: the search of all document shingles in the sketches loses nothing,
however long the document is. Documents with too few shingles for an item's class are passed over. Candidate
documents are cut into their shingles once and joined with those of the items (words, not hashes), so the work grows with
the document and the places it shares with items, also where one file holds a whole benchmark.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from flightlake.operators.joins import broadcast_if_small
from flightlake.session import materialize, materialize_counted

WORDS, THRESHOLD = 5, 0.8
# Sketch rows (16 bytes) probed in one pass over the documents, and bytes of a side that may be broadcast.
SKETCH_ROWS, ITEM_BYTES = 1_000_000, 32 * 1024 * 1024


def words_of(text: Column) -> Column:
    """Lower-case runs of letters, marks and digits; null text has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != F.lit(""))


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: a lambda's own variable, which is not inlined."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _windows(words: Column, one, n_words: int) -> Column:
    """One element per window of ``n_words`` words; a shorter text is one window, no word none."""
    return (F.when(F.size(words) >= n_words, F.transform(
        F.sequence(F.lit(0), F.size(words) - n_words), lambda i: one([F.get(words, i + k) for k in range(n_words)])))
        .when(F.size(words) > 0, F.array(one([F.get(words, F.lit(k)) for k in range(n_words - 1)])))
        .otherwise(F.array().cast("array<bigint>")))


def hashed_shingles(text: Column, n_words: int = WORDS) -> Column:
    """64-bit hash of every shingle, repeats included."""
    return _bind(F.transform(words_of(text), lambda w: F.xxhash64(w)),
                 lambda hashed: _windows(hashed, lambda parts: F.xxhash64(*parts), n_words))


def shingles(text: Column, n_words: int = WORDS) -> Column:
    """Distinct shingles, words joined by a space."""
    def joined(words: Column) -> Column:
        return F.when(F.size(words) >= n_words, F.transform(
            F.sequence(F.lit(1), F.size(words) - n_words + 1), lambda i: F.array_join(F.slice(words, i, n_words), " "))) \
            .when(F.size(words) > 0, F.array(F.array_join(words, " "))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(_bind(words_of(text), joined))


def item_sketches(items: DataFrame, threshold: float, n_words: int) -> DataFrame:
    """``ikey, n_item, least_doc, sketch``: size-partitioned bottom-k sketch of each distinct item text."""
    held = items.select("ikey", F.array_distinct(hashed_shingles(F.col("body"), n_words)).alias("hashes"))
    held = held.withColumn("n_item", F.size("hashes")).where("n_item > 0")
    upper = F.pow(F.lit(2.0), F.ceil(F.log2("n_item")))
    k = (F.floor(upper * (1.0 - threshold) + 1e-9) + 1).cast("int")
    return held.select("ikey", "n_item", F.ceil(F.col("n_item") * threshold - 1e-9).cast("int").alias("least_doc"),
                       F.slice(F.array_sort("hashes"), F.lit(1), k).alias("sketch"))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD,
                 n_words: int = WORDS) -> DataFrame:
    """Pairs of a document and a test item it contains: ids, ``text_hash``, ``n_item``, ``n_shared``, ``containment``.

    Rows of ``docs`` with equal id and text give one row per item; ``text_hash`` (xxhash64 of the text) tells apart
    rows with one id and different texts. Null ids are kept as ids. Null, empty and word-less texts hold nothing; an
    item of fewer than ``n_words`` words is one shingle, met only by documents of just those words. Empty tables
    give no rows; other columns are not read.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    named = items.select(F.col(item_id_col).alias("item"), F.coalesce(F.col(item_text_col), F.lit("")).alias("body"))
    named = materialize(named.withColumn("ikey", F.xxhash64("body")).distinct(), "items")
    bodies = named.select("ikey", "body").dropDuplicates(["ikey"])
    sketches, n = materialize_counted(
        item_sketches(bodies, threshold, n_words).select("ikey", "least_doc", F.explode("sketch").alias("h")), "sketches")
    parts = bodies.select("ikey", shingles(F.col("body"), n_words).alias("ss")).select(
        "ikey", F.size("ss").alias("n_item"), F.posexplode("ss").alias("place", "s"))

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("txt")).withColumn("text_hash", F.xxhash64("txt"))
    hashed = rows.select("id", "text_hash", hashed_shingles(F.col("txt"), n_words).alias("hs"))
    opened = hashed.select("id", "text_hash", F.size("hs").alias("n_doc"), F.explode("hs").alias("h"))
    blocks = max(1, math.ceil(n / SKETCH_ROWS))
    hits = None
    for block in range(blocks):  # a larger benchmark is searched in blocks, each under the broadcast bound
        part = sketches if blocks == 1 else sketches.where(F.pmod(F.col("h"), F.lit(blocks)) == block)
        found = opened.join(F.broadcast(part), "h").where("n_doc >= least_doc").select("id", "text_hash")
        hits = found if hits is None else hits.unionByName(found)
    candidates, _ = broadcast_if_small(hits.groupBy(F.col("id").alias("cid"), F.col("text_hash").alias("chash")).agg(
        F.lit(1).alias("one")), ITEM_BYTES, "candidates")

    # Each candidate document is cut into its distinct shingles once, whatever number of items it holds; only shingles of items
    # go on. Rows with equal id and text find the same places, which count once.
    texts = rows.join(candidates, F.col("id").eqNullSafe(F.col("cid")) & (F.col("text_hash") == F.col("chash")), "left_semi")
    cut = texts.select("id", "text_hash", F.explode(shingles(F.col("txt"), n_words)).alias("s"))
    parts, _ = broadcast_if_small(parts, ITEM_BYTES, "item-shingles")
    verified = (cut.join(parts, "s").groupBy("id", "text_hash", "ikey", "n_item").agg(F.size(F.collect_set("place")).alias("n_shared"))
                .withColumn("containment", F.col("n_shared") / F.col("n_item"))
                .where(F.col("containment") >= threshold - 1e-12))
    names, _ = broadcast_if_small(named.select("ikey", "item"), ITEM_BYTES, "item-names")
    return (verified.join(names, "ikey")
            .select(F.col("id").alias(id_col), "text_hash", F.col("item").alias("item_id"),
                    F.col("n_item").cast("long").alias("n_item"), F.col("n_shared").cast("long").alias("n_shared"),
                    "containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      broadcast_rows: int = 500_000, **options) -> DataFrame:
    """``docs`` without the rows that hold a test item; all columns, names and other rows unchanged.

    The rows to remove (id and text hash, counted while they are written) are broadcast up to
    ``broadcast_rows`` of them, else the anti-join shuffles.
    """
    cols = docs.columns
    rows = docs.toDF(*[f"c{i}" for i in range(len(cols))])
    id_at, text_at = f"c{cols.index(id_col)}", f"c{cols.index(text_col)}"
    bad = contaminated(rows, items, id_at, text_at, **options).select(F.col(id_at).alias("bad_id"), "text_hash").distinct()
    bad, n = materialize_counted(bad, "contaminated")
    bad = F.broadcast(bad) if n <= broadcast_rows else bad
    text = F.coalesce(F.col(text_at), F.lit(""))
    clean = rows.join(bad, F.col(id_at).eqNullSafe(F.col("bad_id")) & (F.xxhash64(text) == F.col("text_hash")), "left_anti")
    return clean.toDF(*cols)
