"""Helpers shared by the training-data operators: free column names, Arrow row maps, split ranks."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

# Text bytes worked on at once inside a task (arrays of a few dozen times this size are held).
CHUNK_BYTES = 512 * 1024


def free_name(df: DataFrame, base: str) -> str:
    """A column name starting with ``base`` that no column of ``df`` has (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def chunks(column: pa.Array) -> Iterator[pa.Array]:
    """Slices of a string column with about ``CHUNK_BYTES`` of text each (one row at least), in order."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > CHUNK_BYTES:
            yield column.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if start < len(column):
        yield column.slice(start)


def utf8_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column put together (nulls: none) and the n + 1 row offsets into them."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, offsets - offsets[0]


def spans(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True within each row of a buffer: starts, ends and row of each."""
    if not len(mask):
        none = np.empty(0, np.int64)
        return none, none, none
    left = np.empty(len(mask), bool)
    left[0], left[1:] = False, mask[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(mask))]
    left[inner] = False
    right = np.empty(len(mask), bool)
    right[-1], right[:-1] = False, mask[1:]
    right[inner - 1] = False
    starts, ends = np.flatnonzero(mask & ~left), np.flatnonzero(mask & ~right) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64)
        up[0] = down[0] = 1
        _POWERS["up"], _POWERS["down"] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: differences of polynomial prefix sums, so no loop over spans."""
    up, down = _powers(len(raw) + 1)
    prefix = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


# Bytes that are compared at once.
COMPARE_BYTES = 1 << 20


def _words(raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as numbers (an overlapping view; padded where the last span needs it)."""
    if len(raw) < int(ends.max(initial=0)) + 8:
        raw = np.concatenate([raw, np.zeros(8, np.uint8)])
    return np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,))


def differing(raw: np.ndarray, starts: np.ndarray, other: np.ndarray, other_starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which of some spans (not empty) differ from the spans of their sizes in ``other``.

    The first 64 bytes are compared eight at a time over all spans, what goes on after them byte by byte, in blocks.
    """
    out, live = np.zeros(len(sizes), bool), np.arange(len(sizes))
    one, two = _words(raw, starts + sizes), _words(other, other_starts + sizes)
    for k in range(0, 64, 8):
        unlike = one[starts[live] + k] ^ two[other_starts[live] + k]
        unlike &= np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.maximum(8 + k - sizes[live], 0) * 8).astype(np.uint64)
        out[live[unlike != 0]] = True
        live = live[sizes[live] > k + 8]
        if not len(live):
            return out
    starts, other_starts, sizes = starts[live] + 64, other_starts[live] + 64, sizes[live] - 64
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        before = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + COMPARE_BYTES, side="right")))
        size, total = sizes[a:b], int(ends[b - 1] - before)
        inner = ends[a:b] - before - size
        step = np.arange(total) - np.repeat(inner, size)
        unlike = raw[np.repeat(starts[a:b], size) + step] != other[np.repeat(other_starts[a:b], size) + step]
        out[live[a:b]] |= np.add.reduceat(unlike, inner, dtype=np.int64) > 0
        a = b
    return out


def equal_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups of equal byte spans (not empty): the first span of each group, and the group of every span.

    Spans are sorted by their hash and then compared byte by byte with the first of their hash. Those of a hash that
    different spans share (texts made for it exist) are grouped by their bytes.
    """
    _, first, group = np.unique(span_hashes(raw, starts, ends), return_index=True, return_inverse=True)
    sizes, lead = ends - starts, first[group]
    bad = sizes != sizes[lead]
    like = np.flatnonzero(~bad & (lead != np.arange(len(lead))))
    bad[like] = differing(raw, starts[like], raw, starts[lead[like]], sizes[like])
    if bad.any():
        ids: dict[tuple[int, bytes], int] = {}
        more = first.tolist()
        for i in np.flatnonzero(np.isin(group, group[bad])).tolist():
            own = (int(group[i]), raw[starts[i]:ends[i]].tobytes())
            if own not in ids:
                lone = any(g == own[0] for g, _ in ids)
                ids[own] = len(more) if lone else own[0]
                if lone:
                    more.append(i)
                else:
                    more[own[0]] = i
            group[i] = ids[own]
        first = np.array(more)
    return first, group


def in_share(point: Column, share: float) -> Column:
    """True for a ``share`` of the rows, by a 64-bit hash: never none of them for being a small share of very many."""
    if share >= 1:
        return F.lit(True)
    return point < F.lit(max(1, int(share * 2.0**64)) - (1 << 63))


def map_arrow(df: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow`` whose Python workers find this package even where the driver's own path was set by hand.

    Where the package is installed on the executors, or sent with the job, the added path changes nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = df.sparkSession.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return df.mapInArrow(run, schema)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(),
          "binary": pa.binary()}


def add_columns(df: DataFrame, inputs: list[str], fields: list[tuple[str, str]], fn: Callable,
                keep: list[str] | None = None) -> DataFrame:
    """``df``'s columns ``keep`` (default: all) and new ``fields`` (name, type) that ``fn`` makes per row.

    ``fn`` gets the input columns of a chunk of rows as Arrow arrays and returns one array for each
    field. It runs in the scan's own tasks (``mapInArrow``); nothing is shuffled. A kept column with
    the name of a new field gives way to it.
    """
    new = {name.lower() for name, _ in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    schema = T.StructType([df.schema[c] for c in kept] + [
        T.StructField(name, T._parse_datatype_string(kind), True) for name, kind in fields])
    types = [_ARROW[kind] for _, kind in fields]
    wanted = list(dict.fromkeys(kept + inputs))
    n_kept, at = len(kept), [wanted.index(c) for c in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for part in chunks(batch.column(at[0])):
                piece = batch.slice(start, len(part))
                start += len(part)
                made = [x if isinstance(x, pa.Array) else pa.array(x, kind)
                        for x, kind in zip(fn(*[piece.column(i) for i in at]), types)]
                yield pa.RecordBatch.from_arrays(
                    piece.columns[:n_kept] + [x.cast(kind) for x, kind in zip(made, types)], names=schema.names)

    return map_arrow(df.select(*[F.col(f"`{c}`") for c in wanted]), run, schema)


def rank_in_groups(df: DataFrame, group: str, order: list[str], target: int = 1_000) -> DataFrame:
    """``df`` (a written table) with ``rank``: 0, 1, ... within each ``group``, without gaps.

    A group of n rows is cut into ceil(n / target) salted buckets by a hash of the ``order`` columns, so no
    task orders a whole hot group; ranks run bucket after bucket, and by ``order`` in each. Rows equal in
    all ``order`` columns are interchangeable. ``group`` must have a number of values that parameters bound (arcs of a
    ring, lengths up to a sequence's): their counts are broadcast, so rows are first dealt out by group and bucket
    and never by the group alone.
    """
    sizes = F.broadcast(df.groupBy(group).agg(F.count(F.lit(1)).alias("__n")))
    salted = df.join(sizes, group).withColumn(
        "__b", F.pmod(F.xxhash64(*order), F.ceil(F.col("__n") / F.lit(target)).cast("long"))).drop("__n")
    before = Window.partitionBy(group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (salted.groupBy(group, "__b").agg(F.count(F.lit(1)).alias("__c"))
               .withColumn("__before", F.coalesce(F.sum("__c").over(before), F.lit(0))).drop("__c"))
    inside = Window.partitionBy(group, "__b").orderBy(*order)
    return (salted.withColumn("__r", F.row_number().over(inside)).join(offsets, [group, "__b"])
            .withColumn("rank", F.col("__before") + F.col("__r") - 1).drop("__b", "__r", "__before"))
