"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (made from its code point, so no table is stored). The vector of a letter
n-gram binds its letters: each letter's vector is rotated by its place and the vectors are multiplied. A document
bundles (adds) the vectors of all its n-grams; a language's prototype bundles the unit vectors of its documents. A
document's language is the prototype with the largest cosine.

Cosines of unlike texts are not 0 but noise of about 1 / sqrt(dims) around it, and more where letters are shared. What counts
as like a language is learned with the prototypes, from the cosines of the language's own documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flightlake.llm.common import add_columns, chunks, map_arrow

DIMS, NGRAM, SEED = 1024, 3, 7
# Expected number of training documents per language, and the most languages (a prototype takes DIMS floats).
TRAIN_PER_LANG, MAX_LANGS = 4_000, 1_000
UNKNOWN = "und"
# Rejection bound: this part of the low quantile of a language's own training cosines (each against the prototype without
# the document itself, relative to the cosine usual at its length), less so many deviations of the noise. A
# language with one training document alone has none: there it is the cosine that noise exceeds in this share of unlike texts.
MARGIN, LOW, DEVIATIONS, CHANCE = 0.5, 0.01, 2.5, 0.01
# N-gram kinds turned into vectors at once (a block of KINDS x DIMS floats).
KINDS = 2_048
_LETTER = np.empty(0, bool)
_SPACE = 32
_ROWS: dict[tuple[int, int, int], np.ndarray] = {}


def _is_letter(codes: np.ndarray) -> np.ndarray:
    global _LETTER
    if not len(_LETTER):
        _LETTER = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _LETTER[codes]


def letter_vector(code: int, dims: int, seed: int) -> np.ndarray:
    """The random +1/-1 vector of a letter; the same on every executor."""
    key = (code, dims, seed)
    if key not in _ROWS:
        if len(_ROWS) > 8_192:
            _ROWS.clear()
        _ROWS[key] = np.random.Generator(np.random.Philox(key=[seed, code])).integers(0, 2, dims, np.int8) * 2 - 1
    return _ROWS[key]


def ngram_counts(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, kind, count) of all letter n-grams, runs of other characters read as one space; and the kinds' letters."""
    lowered = [(t or "").lower() for t in texts]
    sizes = np.array([len(t) for t in lowered], np.int64)
    flat = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), sizes)
    letter = _is_letter(flat) if len(flat) else np.empty(0, bool)
    # One space around and between the runs of letters of a row; rows without letters have no n-gram.
    first = np.ones(len(flat), bool)
    first[1:] = (row[1:] != row[:-1]) | letter[:-1]
    kept = letter | first
    flat, row, letter = np.where(letter, flat, _SPACE)[kept], row[kept], letter[kept]
    starts = np.searchsorted(row, np.arange(len(texts)))
    lead = [i for i in range(len(texts)) if starts[i] < len(row) and row[starts[i]] == i and letter[starts[i]]]
    flat, row = np.insert(flat, starts[lead], _SPACE), np.insert(row, starts[lead], lead)
    ends = np.searchsorted(row, np.arange(len(texts)), side="right")
    tail = [i for i in range(len(texts)) if ends[i] and row[ends[i] - 1] == i and flat[ends[i] - 1] != _SPACE]
    flat, row = np.insert(flat, ends[tail], _SPACE), np.insert(row, ends[tail], tail)
    if len(flat) < n:
        none = np.empty(0, np.int64)
        return none, none, none, np.empty((0, n), np.int64)
    symbols, coded = np.unique(flat, return_inverse=True)
    m = len(flat) - n + 1
    code = np.zeros(m, np.int64)
    for k in range(n):
        code = code * len(symbols) + coded[k:k + m]
    whole = row[:m] == row[n - 1:]
    kinds, kind = np.unique(code[whole], return_inverse=True)
    pairs, count = np.unique(row[:m][whole] * max(1, len(kinds)) + kind, return_counts=True)
    letters = np.stack([symbols[kinds // len(symbols) ** (n - 1 - k) % len(symbols)] for k in range(n)], 1)
    return pairs // max(1, len(kinds)), pairs % max(1, len(kinds)), count, letters


def bundle(texts: list[str | None], dims: int = DIMS, n: int = NGRAM, seed: int = SEED) -> np.ndarray:
    """The documents' vectors, one row each (zeros without letters)."""
    return _bundled(texts, dims, n, seed)[0]


def _bundled(texts: list[str | None], dims: int, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The documents' vectors and their effective numbers of n-grams: squared sum by sum of squares, so that repeats of a
    few n-grams count as few."""
    row, kind, count, letters = ngram_counts(texts, n)
    out, grams = np.zeros((len(texts), dims), np.float32), np.bincount(row, count, len(texts)).astype(np.float64) ** 2
    grams /= np.maximum(np.bincount(row, count.astype(np.float64) ** 2, len(texts)), 1)
    if not len(row):
        return out, grams
    symbols, at = np.unique(letters, return_inverse=True)
    at = at.reshape(letters.shape)
    table = np.stack([letter_vector(int(s), dims, seed) for s in symbols])
    order = np.argsort(kind, kind="stable")
    row, kind, count = row[order], kind[order], count[order]
    for start in range(0, len(letters), KINDS):
        block = at[start:start + KINDS]
        vectors = np.ones((len(block), dims), np.int8)
        for k in range(n):
            vectors *= np.roll(table, n - 1 - k, axis=1)[block[:, k]]
        lo, hi = np.searchsorted(kind, [start, start + len(block)])
        rows, local = np.unique(row[lo:hi], return_inverse=True)
        weights = np.zeros((len(rows), len(block)), np.float32)
        weights[local, kind[lo:hi] - start] = count[lo:hi]
        out[rows] += weights @ vectors.astype(np.float32)
    return out, grams


def _unit(vectors: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(size == 0, 1, size)


class Profiles:
    """Learned languages in alphabetical order and their unit prototype vectors.

    ``spread`` and ``least`` (one for each language; 0: nothing learned) make the rejection bound, see ``bounds``.
    """

    def __init__(self, langs: list[str], vectors: np.ndarray, n: int, seed: int, spread: np.ndarray | None = None,
                 least: np.ndarray | None = None) -> None:
        self.langs, self.vectors, self.n, self.seed = langs, vectors, n, seed
        self.spread = np.zeros(len(langs)) if spread is None else spread
        self.least = np.zeros(len(langs)) if least is None else least

    def cosines(self, texts: list[str | None]) -> np.ndarray:
        return _unit(bundle(texts, self.vectors.shape[1], self.n, self.seed)) @ self.vectors.T

    def bounds(self, grams: np.ndarray) -> np.ndarray:
        """Cosine with each language (column) from which a text with so many effective n-grams (row) is like it."""
        noise = 1 / np.sqrt(self.vectors.shape[1])
        return np.where(self.least > 0, _usual_cosine(grams[:, None], self.spread) * self.least - DEVIATIONS * noise,
                        NormalDist().inv_cdf(1 - CHANCE / len(self.langs)) * noise)

    def resembles(self, texts: list[str | None]) -> np.ndarray:
        """Whether each text is like a learned language; texts without n-grams are like none."""
        if not self.langs:
            return np.zeros(len(texts), bool)
        vectors, grams = _bundled(texts, self.vectors.shape[1], self.n, self.seed)
        return (grams > 0) & (_unit(vectors) @ self.vectors.T >= self.bounds(grams)).any(axis=1)


def _usual_cosine(grams: np.ndarray, spread: np.ndarray | float) -> np.ndarray:
    """Cosine with its prototype of a text of ``grams`` effective n-grams drawn from a language whose n-gram shares have the
    sum of squares ``spread``: each n-gram adds its share to the product, so it grows with the square root, up to 1."""
    return np.sqrt(np.minimum(grams * spread, 1))


def fit(docs: DataFrame, training: Column | None = None, text_col: str = "text", lang_col: str = "lang",
        id_col: str = "doc_id", per_lang: int = TRAIN_PER_LANG, dims: int = DIMS, n: int = NGRAM, seed: int = SEED, bounds: bool = True) -> Profiles:
    """Prototypes from rows with a language and where ``training`` holds.

    About ``per_lang`` rows of each language are taken by a hash of their id (all, where there are fewer), a bound on
    what training reads of labelled rows. Tasks add up their documents' unit vectors by language; only these sums
    (languages x dims, checked against ``MAX_LANGS``) are shuffled and collected. Null texts and texts without letters
    add nothing; a language without any letter is not learned; with no row nothing is learned.

    With ``bounds`` the same rows are read again for the rejection bounds (used by ``drop_unidentified`` alone); two numbers
    of each come to the driver, so at most about ``per_lang`` pairs for a language.
    """
    rows = docs.select(F.col(text_col).alias("body"), F.col(lang_col).alias("lang"), F.col(id_col).alias("id"),
                       (F.lit(True) if training is None else training).alias("used"))
    rows = rows.where("used and lang is not null and body is not null")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).limit(MAX_LANGS + 1).collect()
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages to learn")
    if not sizes:
        return Profiles([], np.zeros((0, dims), np.float32), n, seed)
    share = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, per_lang / r["rows"])) for r in sizes], "lang string, share double")
    taken = rows.join(F.broadcast(share), "lang").where(
        (F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)) < F.col("share")).select("body", "lang")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            at = 0
            for part in chunks(batch.column(0)):
                langs = np.array(batch.column(1).slice(at, len(part)).to_pylist(), object)
                at += len(part)
                units = _unit(bundle(part.to_pylist(), dims, n, seed))
                for lang in set(langs):
                    total[lang] = total.get(lang, 0) + units[langs == lang].sum(axis=0, dtype=np.float64)
        for lang, vector in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dims), pa.array(np.arange(dims)), pa.array(vector)],
                                             names=["lang", "dim", "x"])

    summed = map_arrow(taken, sums, "lang string, dim long, x double").groupBy("lang", "dim").agg(F.sum("x").alias("x"))
    vectors: dict[str, np.ndarray] = {}
    for r in summed.collect():
        vectors.setdefault(r["lang"], np.zeros(dims))[r["dim"]] = r["x"]
    langs = sorted(lang for lang, v in vectors.items() if v.any())
    stacked = np.stack([vectors[lang] for lang in langs]) if langs else np.zeros((0, dims))
    profiles = Profiles(langs, _unit(np.round(stacked, 9)).astype(np.float32), n, seed)
    if bounds and langs:
        _learn_bounds(profiles, taken, np.linalg.norm(stacked, axis=1))
    return profiles


def _learn_bounds(profiles: Profiles, taken: DataFrame, norms: np.ndarray) -> None:
    """``spread`` and ``least`` from the training rows; ``norms`` are the lengths of the prototypes' sums."""
    dims, n, seed, vectors = profiles.vectors.shape[1], profiles.n, profiles.seed, profiles.vectors
    place = {lang: i for i, lang in enumerate(profiles.langs)}

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in chunks(batch.column(0)):
                lang = np.array([place.get(x, -1) for x in batch.column(1).slice(at, len(part)).to_pylist()], np.int32)
                at += len(part)
                found, grams = _bundled(part.to_pylist(), dims, n, seed)
                used = (lang >= 0) & (grams > 0)
                lang, grams, units = lang[used], grams[used], _unit(found[used])
                # Against the sum without the document itself; where nothing is left of it, there is nothing to learn from.
                along = (units * vectors[lang]).sum(axis=1, dtype=np.float64) * norms[lang]
                rest = np.sqrt(np.maximum(norms[lang] ** 2 - 2 * along + 1, 0))
                some = rest > 0.01
                yield pa.RecordBatch.from_arrays([pa.array(lang[some]), pa.array(grams[some]), pa.array((along[some] - 1) / rest[some])],
                                                 names=["lang", "grams", "cosine"])

    got = map_arrow(taken, own, "lang int, grams double, cosine double").toArrow()
    lang, grams, cosine = (got.column(c).to_numpy() for c in ("lang", "grams", "cosine"))
    for i in range(len(profiles.langs)):
        m, c = grams[lang == i], np.maximum(cosine[lang == i], 0)
        if len(m) and (spread := float(np.median(c ** 2 / m))) > 0:
            profiles.spread[i] = spread
            profiles.least[i] = MARGIN * float(np.quantile(c / _usual_cosine(m, spread), LOW))


def identify(docs: DataFrame, profiles: Profiles, text_col: str = "text", keep: list[str] | None = None,
             names: tuple[str, str, str] = ("lang_pred", "score", "cosine")) -> DataFrame:
    """``keep`` columns (default: all) with the predicted language, its share of the prediction and its cosine.

    The score is the softmax of the cosines (times 20) at the predicted language, from 0 to 1; equal cosines go to
    the first language in the alphabet. Null texts, texts without a letter, and all texts when nothing was learned, are
    ``und`` with score and cosine 0. Every text is read whole and worked on by itself: repeated rows give repeated results,
    an empty table an empty one, and a kept column with the name of a new one gives way to it.
    """
    langs, vectors = np.array([*profiles.langs, UNKNOWN], object), profiles

    def run(texts: pa.Array) -> list:
        if not vectors.langs:
            return [[UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))]
        cos = vectors.cosines(texts.to_pylist()).astype(np.float64)
        known = (cos != 0).any(axis=1)
        best = np.where(known, cos.argmax(axis=1), len(langs) - 1)
        top = np.where(known, cos.max(axis=1), 0.0)
        share = np.where(known, 1.0 / np.exp(20.0 * (cos - cos.max(axis=1, keepdims=True))).sum(axis=1), 0.0)
        return [langs[best].tolist(), share, top]

    return add_columns(docs, [text_col], list(zip(names, ("string", "double", "double"))), run, keep)


def drop_unidentified(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """``docs`` without rows that resemble no learned language: no letter, or every cosine under the language's bound.

    Bounds follow the number of n-grams (``Profiles.bounds``). Under about a hundred letters, clean texts come near the noise;
    such texts rather stay. So can texts in an unlearned language that has letter sequences of a learned one.
    """
    cols = docs.columns

    def run(texts: pa.Array) -> list:
        return [profiles.resembles(texts.to_pylist())]

    rows = add_columns(docs.toDF(*[f"c{i}" for i in range(len(cols))]), [f"c{cols.index(text_col)}"], [("known", "boolean")], run)
    return rows.where("known").drop("known").toDF(*cols)
