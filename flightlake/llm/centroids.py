"""Centroid clustering over subvector dictionaries: exact integer k-means whose distances are summed by code.

Components become integers, dimensions are cut into blocks of ``width``, and each block has a dictionary of its distinct
subvectors. Vectors are written once as codes into the dictionaries. In each round the exact squared distance of every
dictionary entry to every centroid's block is worked out once (per task), and a vector's distances are the sums over
its codes.

The dictionaries go to every task, so their entries are bounded (``entries``): the commonest subvectors of all blocks
are in them, found on counts of the whole table. Rarer subvectors stand in the written row as they are; a task
encodes those of a batch in a dictionary of the batch and sums by its codes in the same way, so every distance is exact.
Nothing but the dictionaries, the centroids and per-cluster sums (parameters, not data) reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from flightlake.llm.common import map_arrow
from flightlake.session import materialize

# Subvectors in the dictionaries of all blocks together.
ENTRIES = 131_072
SCALE = 256
# Components beyond this are set to it: the squared distance of 64 such components still fits a long.
LIMIT = 1 << 27
# Dimensions of a block: two components of LIMIT's size fit one long key.
WIDTHS = (1, 2)


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, dims: int) -> DataFrame:
    """``id, v``: kept vectors as arrays of ``floor(256 * x)``, within ``LIMIT`` on both sides."""
    x = F.col(vector_col).cast("array<double>")
    kept = df.select(F.col(id_col).alias("id"), x.alias("x")).where(
        (F.size("x") == dims) & F.forall("x", lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))) & ~F.isnan(c)))
    bound = F.lit(float(LIMIT))
    return kept.select("id", F.transform("x", lambda c: F.floor(
        F.greatest(-bound, F.least(bound, c * F.lit(float(SCALE))))).cast("int")).alias("v"))


def block_keys(v: str, dims: int, width: int) -> F.Column:
    """One long per block: its components, 32 bits each (a block beyond the last dimension is filled with 0)."""
    def part(i: int):
        return F.get(F.col(v), F.lit(i)).cast("long") if i < dims else F.lit(0).cast("long")

    keys = []
    for start in range(0, dims, width):
        keys.append(part(start) if width == 1 else F.shiftleft(part(start), 32) + part(start + 1))
    return F.array(*keys)


def split_keys(keys: np.ndarray, width: int) -> np.ndarray:
    """The components of block keys, along a new last axis."""
    if width == 1:
        return keys[..., None]
    low = ((keys & 0xFFFFFFFF) ^ 0x80000000) - 0x80000000
    return np.stack([(keys - low) >> 32, low], axis=-1)


@dataclass(frozen=True)
class Dictionary:
    """Sorted subvector keys of all blocks, one after another; ``starts`` has the first entry of each block."""

    keys: np.ndarray
    starts: np.ndarray
    dims: int
    width: int

    @property
    def blocks(self) -> int:
        return len(self.starts) - 1

    def encode(self, keys: np.ndarray) -> np.ndarray:
        """Entry number of each key of ``(n, blocks)``, -1 where the block's dictionary lacks it."""
        codes = np.full(keys.shape, -1, np.int32)
        for b in range(self.blocks):
            own = self.keys[self.starts[b]:self.starts[b + 1]]
            if len(own):
                at = np.minimum(np.searchsorted(own, keys[:, b]), len(own) - 1)
                codes[:, b] = np.where(own[at] == keys[:, b], at + self.starts[b], -1)
        return codes

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        """Squared distance of every entry to its block of every centroid, ``(entries, k)``."""
        out = np.empty((len(self.keys), len(centroids)), np.int64)
        for b in range(self.blocks):
            at = slice(self.starts[b], self.starts[b + 1])
            out[at] = block_distances(self.keys[at], centroids, b, self.width)
        return out


def block_distances(keys: np.ndarray, centroids: np.ndarray, block: int, width: int) -> np.ndarray:
    parts, out = split_keys(keys, width), np.zeros((len(keys), len(centroids)), np.int64)
    for j, d in enumerate(range(block * width, min((block + 1) * width, centroids.shape[1]))):
        out += (parts[:, j, None] - centroids[None, :, d]) ** 2
    return out


def build_dictionary(vectors: DataFrame, dims: int, width: int, entries: int) -> Dictionary:
    """The commonest subvectors: all of the least count with which at most ``entries`` fit (counts in steps of 1/8 octave)."""
    counts = materialize(
        vectors.select(F.posexplode(block_keys("v", dims, width)).alias("block", "key")).groupBy("block", "key")
        .agg(F.floor(F.log2(F.count(F.lit(1)).cast("double")) * 8).cast("int").alias("level")), "subvectors")
    levels = sorted(((r["level"], r["n"]) for r in counts.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    total, least = 0, None
    for level, n in levels:
        if total + n > entries:
            break
        total, least = total + n, level
    blocks = -(-dims // width)
    if least is None:
        return Dictionary(np.empty(0, np.int64), np.zeros(blocks + 1, np.int64), dims, width)
    rows = counts.where(F.col("level") >= least).select("block", "key").toArrow()
    block, key = (rows.column(c).to_numpy() for c in ("block", "key"))
    order = np.lexsort((key, block))
    return Dictionary(key[order].astype(np.int64), np.searchsorted(block[order], np.arange(blocks + 1)), dims, width)


def encoded(vectors: DataFrame, dictionary: Dictionary) -> DataFrame:
    """``id, codes, rest``, written: int32 entry numbers of all blocks, and the int64 keys of blocks without one (in order)."""
    shared = vectors.sparkSession.sparkContext.broadcast(dictionary)
    blocks = dictionary.blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            keys = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(batch), blocks)
            codes = shared.value.encode(keys)
            free = codes < 0
            ends = np.concatenate([[0], np.cumsum(free.sum(1))]) * 8
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), binaries(codes, np.arange(len(batch) + 1) * blocks * 4), binaries(keys[free], ends)],
                names=["id", "codes", "rest"])

    keyed = vectors.select("id", block_keys("v", dictionary.dims, dictionary.width).alias("keys"))
    schema = T.StructType([keyed.schema["id"], T.StructField("codes", T.BinaryType()), T.StructField("rest", T.BinaryType())])
    return materialize(map_arrow(keyed, run, schema), "vector-codes")


def binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Byte strings that lie one after another in ``values``."""
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [
        None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())]).cast(pa.binary())


def flat(column: pa.Array, kind) -> np.ndarray:
    """The bytes of a binary column put together, as numbers."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].view(kind) if data is not None else np.empty(0, kind)


def nearest(codes: np.ndarray, rest: np.ndarray, table: np.ndarray, dictionary: Dictionary,
            centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (ties: the smaller number), squared distance and block keys of each encoded vector."""
    keys = np.zeros(codes.shape, np.int64)
    free = codes < 0
    keys[free] = rest
    total = np.zeros((len(codes), len(centroids)), np.int64)
    for b in range(dictionary.blocks):
        code, new = codes[:, b], free[:, b]
        old = ~new
        keys[old, b] = dictionary.keys[code[old]]
        if new.any():
            own, at = np.unique(keys[new, b], return_inverse=True)
            total[new] += block_distances(own, centroids, b, dictionary.width)[at]
            total[old] += table[code[old]]
        else:
            total += table[code]
    label = total.argmin(1)
    return label, total[np.arange(len(label)), label], keys


def _assigning(dictionary, centroids: np.ndarray, emit):
    """A ``mapInArrow`` function: ``emit(ids, labels, distances, keys)`` of each batch; the table is made once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, table = dictionary.value, None
        for batch in batches:
            if not len(batch):
                continue
            table = own.distances(centroids) if table is None else table
            codes = flat(batch.column("codes"), np.int32).reshape(len(batch), own.blocks)
            yield from emit(batch, *nearest(codes, flat(batch.column("rest"), np.int64), table, own, centroids))

    return run


def _sums(codes: DataFrame, dictionary, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Rows and component sums of every non-empty cluster (at most k * (dims + 1) numbers reach the driver)."""
    dims, width = dictionary.value.dims, dictionary.value.width

    def emit(batch, label, distance, keys):
        order = np.argsort(label, kind="stable")
        own, start = np.unique(label[order], return_index=True)
        parts = split_keys(keys[order], width).reshape(len(order), -1)[:, :dims]
        sums = np.concatenate([np.diff(np.append(start, len(order)))[:, None], np.add.reduceat(parts, start, axis=0)], axis=1)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(own, dims + 1), pa.int32()), pa.array(np.tile(np.arange(-1, dims), len(own)), pa.int32()),
            pa.array(sums.ravel(), pa.int64())], names=["cluster", "dim", "total"])

    found = map_arrow(codes, _assigning(dictionary, centroids, emit), "cluster int, dim int, total long")
    out: dict[int, tuple[int, list[int]]] = {}
    rows = found.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total")).collect()
    for c in {r["cluster"] for r in rows}:
        own = {r["dim"]: int(r["total"]) for r in rows if r["cluster"] == c}
        out[c] = own[-1], [own[d] for d in range(dims)]
    return out


def cluster(df: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, seed: int = 2, width: int = 2,
            entries: int = ENTRIES, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per kept vector: id, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Vectors that are null, have another number of components than ``dims``, or a null or non-finite component are not
    kept. Centroids start as the ``k`` kept vectors with the smallest SHA-256 of ``<seed>:<id>`` (a null id: ``<seed>:``; equal
    hashes: the smaller vector first), so fewer than ``k`` vectors give as many centroids, and equal ones leave the later of them empty.
    Repeated rows are vectors of their own. An empty table gives no rows. Components beyond ``LIMIT`` (x beyond
    +-524,288) count as it; sums of distances beyond a long are null. Other columns are not read.
    """
    if width not in WIDTHS:
        raise ValueError(f"width must be one of {WIDTHS}")
    spark = df.sparkSession
    vectors = integer_vectors(df, id_col, vector_col, dims)
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = vectors.orderBy(rank, "v").limit(k).select("v").collect()
    centroids = np.array([r["v"] for r in first], np.int64).reshape(len(first), dims)
    schema = T.StructType([vectors.schema["id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    if not len(first):
        found = spark.createDataFrame([], schema)
        totals = {}
    else:
        dictionary = build_dictionary(vectors, dims, width, entries)
        codes = encoded(vectors, dictionary)
        shared = spark.sparkContext.broadcast(dictionary)
        for _ in range(rounds):
            centroids = centroids.copy()
            for c, (n, total) in _sums(codes, shared, centroids).items():
                centroids[c] = [x // n for x in total]

        def emit(batch, label, distance, keys):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(label, pa.int32()), pa.array(distance, pa.int64())],
                                             names=["id", "cluster", "distance"])

        found = materialize(map_arrow(codes, _assigning(shared, centroids, emit), schema), "assigned")
        totals = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(
            F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}
    whole = sum(totals.values())
    rows = [(c, _long(s), _long(whole), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
            for c, s in totals.items()]
    clusters = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(clusters), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _long(value: int) -> int | None:
    return value if value < 1 << 63 else None
