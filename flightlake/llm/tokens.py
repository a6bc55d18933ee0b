"""Token ids of blocks of texts by a byte-level BPE, with parts seen before looked up instead of encoded again."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from flightlake.llm.common import differing, equal_spans, span_hashes, utf8_buffer

# Most remembered parts in a worker (about 50 bytes each), their greatest length in bytes, and most remembered ids.
KNOWN_PARTS, PART_BYTES, KNOWN_IDS = 1_000_000, 64, 1 << 24
_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), 28, 29, 30, 31, 32]] = True
_OTHER_BLANK = re.compile(r"[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


class Parts:
    """Sorted hashes of known parts, their bytes and where their ids lie; a tokenizer for the others.

    A part is taken for a known one only if its bytes are the same: the hash finds it and does not decide.

    Right for byte-level BPE whose words take in one space before them, without a prefix space or normaliser.
    Such a tokenizer always cuts before a single space and around a single line end that stand between two characters
    which are not white space, so ids of the parts put together are the ids of the text.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.clear()

    def clear(self) -> None:
        self.keys, self.starts, self.sizes = np.empty(0, np.uint64), np.empty(0, np.int32), np.empty(0, np.int32)
        self.flat, self.used = np.empty(1 << 16, "<u4"), 0
        # The known parts' bytes, one after another in the order they came; where each key's lie and how many.
        self.text, self.written = np.empty(1 << 16, np.uint8), 0
        self.text_at, self.lengths = np.empty(0, np.int32), np.empty(0, np.uint8)

    def encode(self, raw: np.ndarray, begins: np.ndarray, lengths: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keep the ids of some parts of a text; where they start and how many each has. ``plain`` parts, without white space
        inside, go through the tokenizer in one text, on lines of their own; the line ends between them are tokens of their
        own and tell where a part ends, so no part is an object of its own."""
        start, size = np.empty(len(begins), np.int64), np.empty(len(begins), np.int64)
        rest = np.ones(len(begins), bool)
        if len(self.line_end) == 1 and plain.any():
            long = lengths[plain]
            ends = np.cumsum(long + 1)
            text = np.full(int(ends[-1]), 10, np.uint8)
            step = np.arange(int(long.sum())) - np.repeat(np.cumsum(long) - long, long)
            text[np.repeat(ends - long - 1, long) + step] = raw[np.repeat(begins[plain], long) + step]
            ids = np.array(self.tokenizer.encode(text.tobytes().decode("utf-8"), add_special_tokens=False).ids, "<u4")
            line = ids == self.line_end[0]
            found = np.flatnonzero(line)
            if len(found) == len(long):
                size[plain] = np.diff(found, prepend=-1) - 1
                start[plain] = self.used + np.cumsum(size[plain]) - size[plain]
                self.flat, self.used = self._append(self.flat, self.used, ids[~line])
                rest = ~plain
        if rest.any():
            data = raw.tobytes()
            parts = [data[a:a + n].decode("utf-8") for a, n in zip(begins[rest].tolist(), lengths[rest].tolist())]
            ids = [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch(parts, add_special_tokens=False)]
            size[rest] = [len(x) for x in ids]
            start[rest] = self.used + np.cumsum(size[rest]) - size[rest]
            self.flat, self.used = self._append(self.flat, self.used, np.concatenate(ids))
        return start, size

    @staticmethod
    def _append(store: np.ndarray, used: int, values: np.ndarray) -> tuple[np.ndarray, int]:
        if used + len(values) > len(store):
            store = np.concatenate([store[:used], np.empty(max(len(store), len(values)), store.dtype)])
        store[used:used + len(values)] = values
        return store, used + len(values)

    def remember(self, keys: np.ndarray, starts: np.ndarray, sizes: np.ndarray, raw: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> None:
        """Add short parts under their hashes; of several parts of a hash the one there first."""
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        new = np.flatnonzero(~known & (lengths <= PART_BYTES))
        keys, pick = np.unique(keys[new], return_index=True)
        new = new[pick]
        lengths, begins = lengths[new], begins[new]
        ends = np.cumsum(lengths)
        text_at = self.written + ends - lengths
        total = int(ends[-1]) if len(new) else 0
        self.text, self.written = self._append(self.text, self.written, raw[np.repeat(begins - (ends - lengths), lengths) + np.arange(total)])
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.starts, self.sizes = np.insert(self.starts, at, starts[new]), np.insert(self.sizes, at, sizes[new])
        self.text_at, self.lengths = np.insert(self.text_at, at, text_at), np.insert(self.lengths, at, lengths)

    def find(self, keys: np.ndarray, raw: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Place of each part among the known ones, -1 for those that are not known byte by byte."""
        at = np.searchsorted(self.keys, keys)
        found = at < len(self.keys)
        found[found] = (self.keys[at[found]] == keys[found]) & (self.lengths[at[found]] == lengths[found])
        hit = np.flatnonzero(found)
        found[hit] = ~differing(raw, begins[hit], self.text, self.text_at[at[hit]].astype(np.int64), lengths[hit])
        return np.where(found, at, -1)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after another, and the n + 1 places where rows begin (null: none)."""
        strings = texts.to_pylist()
        odd = [row for row, t in enumerate(strings) if t and (any(a in t for a in self.added) or _OTHER_BLANK.search(t))]
        whole = {row: np.array(e.ids, "<u4") for row, e in zip(
            odd, self.tokenizer.encode_batch([strings[row] for row in odd], add_special_tokens=False))}
        if odd:
            texts = pa.array([None if row in whole else t for row, t in enumerate(strings)], pa.large_string())
        raw, offsets = utf8_buffer(texts)
        n = len(raw)
        if n:
            blank = _BLANK[raw]
            edge = np.zeros(n + 1, bool)
            edge[offsets] = True
            alone = np.zeros(n, bool)
            alone[1:-1] = blank[1:-1] & ~blank[:-2] & ~blank[2:]
            alone &= ~edge[:-1] & ~edge[1:]
            line = alone & (raw == 10)
            begins = edge[:-1] | (alone & (raw == 32)) | line
            begins[1:] |= line[:-1]
            starts = np.flatnonzero(begins)
            ends = np.append(starts[1:], n)
            first, inverse = equal_spans(raw, starts, ends)
            begins, lengths = starts[first], (ends - starts)[first]
            keys = span_hashes(raw, begins, ends[first])
            at = self.find(keys, raw, begins, lengths)
            new = at < 0
            begin, size = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
            begin[~new], size[~new] = self.starts[at[~new]], self.sizes[at[~new]]
            if new.any():
                # Without white space but one space in front; more than that space.
                blanks = np.concatenate([[0], np.cumsum(blank)])
                inner = blanks[begins + lengths] - blanks[begins] - (raw[begins] == 32)
                plain = (inner == 0) & (lengths > (raw[begins] == 32))
                begin[new], size[new] = self.encode(raw, begins[new], lengths[new], plain[new])
                self.remember(keys[new], begin[new], size[new], raw, begins[new], lengths[new])
            begin, size = begin[inverse], size[inverse]
            after = np.cumsum(size)
            flat = self.flat[np.repeat(begin - (after - size), size) + np.arange(after[-1])]
            bounds = np.concatenate([[0], after])[np.searchsorted(starts, offsets)]
            if len(self.keys) > KNOWN_PARTS or self.used > KNOWN_IDS:
                self.clear()
        else:
            flat, bounds = np.empty(0, "<u4"), np.zeros(len(strings) + 1, np.int64)
        if whole:
            rows = [whole.get(row, flat[bounds[row]:bounds[row + 1]]) for row in range(len(strings))]
            flat, bounds = np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        return flat, bounds


_PARTS: dict[str, Parts] = {}


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """``Parts.ids`` with the tokenizer of ``path``; a worker keeps what it has seen."""
    if path not in _PARTS:
        _PARTS[path] = Parts(path)
    return _PARTS[path].ids(texts)
