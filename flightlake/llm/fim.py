"""Fill-in-middle transformation with cuts found in 64-bit words of the UTF-8 text.

A unit is a run of ASCII letters or any other single code point. A byte ends a unit unless the next byte continues its
code point, or both are letters. These bytes are marked eight at a time: the text is viewed as little-endian uint64,
letters and continuation bytes are marked by arithmetic inside the word, and ``bitwise_count`` of a word is its number
of units. The end of the k-th unit is found by a search in the running counts for its word, and by a select inside
the word. Nothing is split and no unit becomes an object of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from flightlake.llm.common import add_columns, free_name, utf8_buffer

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_ONE = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
_CASE = np.uint64(0x2020202020202020)


def padded_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows' bytes as uint64 words, each row from a word of its own on with one to eight zero bytes behind it; and
    the n + 1 first words."""
    sizes = np.diff(offsets)
    first = np.concatenate([[0], np.cumsum(sizes // 8 + 1)])
    padded = np.zeros(int(first[-1]) * 8, np.uint8)
    for a, size, start in zip(offsets.tolist(), sizes.tolist(), (first[:-1] * 8).tolist()):
        padded[start:start + size] = raw[a:a + size]
    return padded.view("<u8"), first


def continuation(words: np.ndarray) -> np.ndarray:
    """High bit of every byte 10xxxxxx."""
    return words & ~(words << np.uint64(1)) & _HIGH


def letters(words: np.ndarray) -> np.ndarray:
    """High bit of every ASCII letter: with the case bit set, a byte from 0x61 to 0x7A below 0x80."""
    folded = (words | _CASE) & _LOW7
    return (folded + _ONE * np.uint64(0x80 - 0x61)) & ~(folded + _ONE * np.uint64(0x80 - 0x7B)) & ~words & _HIGH


def following(marks: np.ndarray) -> np.ndarray:
    """Each byte's mark moved to the byte before it, over word borders too."""
    out = marks >> np.uint64(8)
    out[:-1] |= marks[1:] << np.uint64(56)
    return out


def unit_ends(words: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """High bit of every byte that ends a unit; bytes behind a row's text are not marked."""
    letter = letters(words)
    ends = ~((letter & following(letter)) | following(continuation(words))) & _HIGH
    ends[first[1:] - 1] &= below(sizes % 8)
    return ends


def below(n: np.ndarray) -> np.ndarray:
    """Words with all bits of the first ``n`` (0 to 7) bytes set."""
    return (np.uint64(1) << (n.astype(np.uint64) * np.uint64(8))) - np.uint64(1)


def select(ends: np.ndarray, running: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Byte behind the marked byte number ``rank`` (from 1 on, over all words)."""
    at = np.searchsorted(running, rank)
    inside = (rank - np.where(at > 0, running[at - 1], 0)).astype(np.uint64)
    # Marks up to each byte of the word; the bytes that have reached the rank follow the one looked for.
    counts = (ends[at] >> np.uint64(7)) * _ONE
    reached = np.bitwise_count(((counts | _HIGH) - inside * _ONE) & _HIGH)
    return at * 8 + 9 - reached.astype(np.int64)


def cut_points(raw: np.ndarray, offsets: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, ...]:
    """Units of each row; bytes before the two cuts (after the smaller and the larger of ``h % (n + 1)`` units); the
    code points before them."""
    words, first = padded_words(raw, offsets)
    sizes = np.diff(offsets)
    ends = unit_ends(words, first, sizes)
    running = np.cumsum(np.bitwise_count(ends), dtype=np.int64)
    before = np.where(first[:-1] > 0, running[first[:-1] - 1], 0)
    n = running[first[1:] - 1] - before
    one, two = h1 % (n + 1), h2 % (n + 1)
    lead = ~continuation(words) & _HIGH
    leads = np.concatenate([[0], np.cumsum(np.bitwise_count(lead), dtype=np.int64)])
    out = [n]
    chars = []
    for units in (np.minimum(one, two), np.maximum(one, two)):
        some = units > 0
        cut = np.zeros(len(n), np.int64)
        cut[some] = select(ends, running, (before + units)[some]) - first[:-1][some] * 8
        at = first[:-1] + cut // 8
        out.append(cut)
        chars.append(leads[at] - leads[first[:-1]] + np.bitwise_count(lead[at] & below(cut % 8)))
    return *out, *chars


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, plain_percent: int = 10,
                   spm_percent: int = 20, keep: list[str] | None = None) -> DataFrame:
    """``docs``' columns ``keep`` (default: all) and ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output``.

    Cuts and form come from the SHA-256 of ``<seed>:<id>`` (null id: ``<seed>:``), so equal ids are cut by the same numbers.
    A null text counts as empty. Empty texts, texts that hold a mark, and ``plain_percent`` of the others stay as they
    are (``form`` plain, lengths null). Each row is worked on by itself: repeated rows give repeated results, an empty
    table an empty one, and a kept column with the name of a new one gives way to it.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    kept = docs.columns if keep is None else keep
    names = [free_name(docs, f"fim_h{i}") for i in range(1, 5)]
    hashed = docs.withColumns({name: F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i, name in enumerate(names)})

    def run(texts: pa.Array, *hashes: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        raw, offsets = utf8_buffer(texts)
        h1, h2, h3, h4 = (h.to_numpy(zero_copy_only=False).astype(np.int64) for h in hashes)
        n, one, two, chars_one, chars_two = cut_points(raw, offsets, h1, h2)
        held = np.zeros(len(texts), bool)
        for mark in (PREFIX, SUFFIX, MIDDLE):
            held |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        plain = (n == 0) | held | (h3 % 100 >= 100 - plain_percent)
        spm = h4 % 100 < spm_percent
        data, output = memoryview(raw), []
        for a, b, p, m, is_plain, is_spm in zip(offsets.tolist(), offsets[1:].tolist(), one.tolist(), two.tolist(), plain.tolist(), spm.tolist()):
            prefix, middle, suffix = data[a:a + p], data[a + p:a + m], data[a + m:b]
            if is_plain:
                output.append(bytes(data[a:b]))
            elif is_spm:
                output.append(b"".join((SUFFIX.encode(), suffix, PREFIX.encode(), prefix, MIDDLE.encode(), middle)))
            else:
                output.append(b"".join((PREFIX.encode(), prefix, SUFFIX.encode(), suffix, MIDDLE.encode(), middle)))
        form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
        return (pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()), pa.array(chars_one, pa.int64(), mask=plain),
                pa.array(chars_two - chars_one, pa.int64(), mask=plain), pa.array(output, pa.large_binary()).cast(pa.large_string()))

    fields = [("n", "long"), ("form", "string"), ("prefix_chars", "long"), ("middle_chars", "long"), ("output", "string")]
    return add_columns(hashed, [text_col, *names], fields, run, keep=kept)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that ``output`` was made of, from it and its form alone."""
    whole, kind = F.col(output), F.col(form)

    def behind(text: Column, at: Column) -> Column:
        return F.substr(text, at + F.lit(3), F.length(text))

    rest = behind(whole, F.lit(1))
    mark = F.when(kind == "psm", F.lit(SUFFIX)).otherwise(F.lit(PREFIX))
    at = F.instr(rest, mark)
    one, tail = F.substr(rest, F.lit(1), at - 1), behind(rest, at)
    split = F.instr(tail, F.lit(MIDDLE))
    two, middle = F.substr(tail, F.lit(1), split - 1), behind(tail, split)
    return (F.when(kind == "plain", whole).when(kind == "psm", F.concat(one, middle, two))
            .otherwise(F.concat(two, middle, one)))
