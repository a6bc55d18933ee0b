"""Packing by shortest-pack-first over the length histogram.

Documents are tokenised in the scan's own tasks and cut at the sequence length, so each leaves full pieces and one
remainder. Only the histogram of piece lengths (at most as many numbers as a sequence has tokens) reaches the
driver. There lengths are placed longest first, each into the pack with the fewest tokens that has room and
adds no padding beyond what a pack of its own would have; counts of packing patterns are updated, never single
packs. Pieces then find their sequence by their rank among the pieces of equal length.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flightlake.llm.common import chunks, map_arrow, rank_in_groups
from flightlake.llm.tokens import token_ids
from flightlake.session import materialize

SEQUENCE, END_ID = 1024, 0


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE,
           end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of every document row: ``id, start, length, ids_crc32, doc_tokens`` (and ``ids`` as binary if asked).

    ``end_id`` follows the text's ids, so null and empty texts have one id.
    """
    schema = "start long, length long, ids_crc32 long, doc_tokens long" + (", ids binary" if with_ids else "")
    rows = docs.select(F.col(text_col).alias("body"), F.col(id_col).alias("id"))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in chunks(batch.column(0)):
                owner, starts, lengths, sums, totals, held = [], [], [], [], [], []
                flat, bounds = token_ids(part, tokenizer)
                for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    ids = flat[a:b].tobytes() + end
                    for s in range(0, len(ids), 4 * sequence):
                        piece = ids[s:s + 4 * sequence]
                        owner.append(i)
                        starts.append(s // 4)
                        lengths.append(len(piece) // 4)
                        sums.append(zlib.crc32(piece))
                        totals.append(len(ids) // 4)
                        if with_ids:
                            held.append(piece)
                ids_col = batch.column(1).slice(at, len(part)).take(pa.array(owner, pa.int64()))
                at += len(part)
                columns = [ids_col, *[pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals)]]
                names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    columns, names = [*columns, pa.array(held, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    id_type = rows.schema["id"].dataType.simpleString()
    return map_arrow(rows, run, f"id {id_type}, {schema}")


def pack_histogram(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths in their order in the sequence) and how many sequences have each.

    Lengths come longest first. Of the open patterns the one with the fewest tokens takes the length if it fits: as
    many of its packs as there are pieces (the rest of the pattern keeps its count), until pieces or open patterns
    with room run out; what is left opens packs of its own. A pattern never holds more than ``size`` tokens.
    """
    if any(not 1 <= length <= size for length in counts):
        raise ValueError("lengths must be from 1 to the sequence length")
    open_: dict[int, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))
    filled: list[int] = []  # heap of token counts with open patterns
    for length in sorted(counts, reverse=True):
        left = counts[length]
        # Packs made in this turn are looked at again: several pieces of one length may share a pack.
        while left and filled and filled[0] + length <= size:
            tokens = filled[0]
            if not open_.get(tokens):
                heapq.heappop(filled)
                open_.pop(tokens, None)
                continue
            pattern, n = open_[tokens].popitem()
            used = min(n, left)
            if n > used:
                open_[tokens][pattern] = n - used
            if tokens + length not in open_:
                heapq.heappush(filled, tokens + length)
            open_[tokens + length][(*pattern, length)] += used
            left -= used
        if left:
            # Packs of this length alone: as many pieces side by side as fit, spread over the fewest packs.
            per = size // length
            whole, rest = divmod(left, per)
            for many, n in ((per, whole), (rest, 1 if rest else 0)):
                if n:
                    tokens = many * length
                    if tokens not in open_:
                        heapq.heappush(filled, tokens)
                    open_[tokens][(length,) * many] += n
    merged: dict[tuple[int, ...], int] = defaultdict(int)
    for patterns in open_.values():
        for pattern, n in patterns.items():
            merged[pattern] += n
    return sorted(merged.items(), reverse=True)


def allocation(patterns: list[tuple[tuple[int, ...], int]], size: int) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), by length and rank: pieces of a length with ranks from
    ``first rank`` on go, one each, to the sequences from ``first sequence`` on."""
    rows, next_rank, sequence = [], defaultdict(int), 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, next_rank[length], sequence, offset))
            next_rank[length] += n
            offset += length
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE,
         end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece of every document row: id, ``start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Every id of a document is in exactly one piece; a sequence's pieces lie without gaps from offset 0 and hold at
    most ``sequence`` tokens. Null and empty texts are the end id alone; null ids are ids; repeated rows are packed each;
    an empty table gives no rows; other columns are not read. ``with_ids`` adds the ids (binary).
    """
    cut = materialize(pieces(docs, tokenizer, id_col, text_col, sequence, end_id, with_ids), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``sequence`` rows
    table = allocation(pack_histogram(counts, sequence), sequence)
    ranked = rank_in_groups(cut, "length", ["id", "start", "ids_crc32", "doc_tokens"])
    keys = table[:, 0] << 44 | table[:, 1] if len(table) else np.empty(0, np.int64)
    cols = [c for c in ranked.columns if c != "rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in cols], pa.array(table[row, 2] + rank - table[row, 1]), pa.array(table[row, 3])],
                names=[*cols, "sequence_id", "offset"])

    schema = ranked.drop("rank").schema.add("sequence_id", "long").add("offset", "long")
    return map_arrow(ranked, place, schema).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """Rows ``sequence_id, ids, n_tokens`` from a ``pack`` result with ids: ids put together in order of offset."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p"), F.sum("length").alias("n_tokens")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids"), "n_tokens")
