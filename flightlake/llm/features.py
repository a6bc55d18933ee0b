"""Hashed word n-grams, skip-grams and stems of a block of texts, made with whole-array steps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from flightlake.llm.common import mix, span_hashes, spans, utf8_buffer

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
# Lengths (characters) of the word beginnings that stand for stems; inflected forms share them.
STEMS = (3, 4, 5, 6, 7)
_KINDS = [np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64)) for k in range(1, 3 + len(STEMS) + 1)]


def all_grams(texts: pa.Array, dims_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature), repeats included: words, stems, neighbouring words and words with one word skipped between.

    Words are lower-case runs of ASCII letters and digits and of characters beyond ASCII.
    """
    raw, offsets = utf8_buffer(pc.utf8_lower(pc.fill_null(texts, "")))
    starts, ends, row = spans(_WORD[raw], offsets)
    word = span_hashes(raw, starts, ends)
    found, rows = [mix(word ^ _KINDS[0])], [row]
    for gap, kind in ((1, _KINDS[1]), (2, _KINDS[2])):
        same = row[:-gap] == row[gap:]
        found.append(mix(word[:-gap][same] * np.uint64(3) + mix(word[gap:][same] ^ kind)))
        rows.append(row[gap:][same])
    chars = np.flatnonzero((raw & 0xC0) != 0x80)
    first, last = np.searchsorted(chars, starts), np.searchsorted(chars, ends)
    for length, kind in zip(STEMS, _KINDS[3:]):
        long = last - first > length
        found.append(mix(span_hashes(raw, starts[long], chars[first[long] + length]) ^ kind))
        rows.append(row[long])
    feature = (np.concatenate(found) >> np.uint64(64 - dims_bits)).astype(np.int64)
    return np.concatenate(rows).astype(np.int64), feature


def distinct(row: np.ndarray, feature: np.ndarray, dims_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The (row, feature) pairs, each once, ordered by row."""
    pairs = np.unique(row << dims_bits | feature)
    return pairs >> dims_bits, pairs & ((1 << dims_bits) - 1)
