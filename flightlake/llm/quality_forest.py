"""Quality rules: rule statistics of every text and an isolation forest over them.

Path lengths over random splits tell rows that are easily set apart (anomalies). Each tree draws its rows from all good
labelled ones; the threshold on the score is set on all labelled rows, so that nearly all good ones stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flightlake.llm.common import add_columns, equal_spans, in_share, map_arrow, rank_in_groups, spans, utf8_buffer
from flightlake.session import materialize, materialize_counted

WINDOW = 5
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Statistics beyond the base ones, for the forest alone.
MORE = ["n_upper", "n_letters", "n_lines"]
FEATURES = ["symbols", "upper", "dup_lines", "repeated", "word_length"]
# Rows that a task puts in order when good rows are numbered, and bins of scores counted at first.
RANKED_ROWS = 10_000
SCORE_BINS = 32_768
# Mean characters of a word between which splits are drawn, whatever the labelled rows have: glued words, encoded data and
# single letters are set apart even where no labelled row has them.
WORD_CHARS = (1.0, 50.0)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SYMBOL, _UPPER, _LETTER = (np.zeros(256, bool) for _ in range(3))
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER[65:91] = True
_LETTER[[*range(65, 91), *range(97, 123), *range(192, 256)]] = True


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _paired(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Numbers from 0 on, equal where both numbers are."""
    return np.unique(one.astype(np.int64) * (int(two.max(initial=0)) + 1) + two, return_inverse=True)[1]


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """``BASE`` and ``MORE`` counts of each text (null: none), by whole-array steps over the UTF-8 bytes."""
    raw, offsets = utf8_buffer(texts)
    n = len(texts)
    starts, ends, row = spans(~_SPACE[raw], offsets)
    words = np.bincount(row, minlength=n)
    # Code points: bytes that do not continue one; white space is ASCII.
    out = {"n_words": words, "word_chars": _per_row(((raw & 0xC0) != 0x80) & ~_SPACE[raw], offsets),
           "n_symbols": _per_row(_SYMBOL[raw], offsets), "n_upper": _per_row(_UPPER[raw], offsets),
           "n_letters": _per_row(_LETTER[raw], offsets)}
    # Windows of five words in one row. Words, pairs, fours and windows are numbered one after another, equal ones alike, so
    # equal numbers of a row are equal words and no hash decides.
    repeat = np.zeros(n, np.int64)
    if len(starts) >= WINDOW:
        word = equal_spans(raw, starts, ends)[1]
        m = len(word) - WINDOW + 1
        pair = _paired(word[:-1], word[1:])
        window = _paired(_paired(pair[:-2], pair[2:])[:m], word[WINDOW - 1:])
        at = np.flatnonzero(row[:m] == row[WINDOW - 1:])
        key = _paired(window[at], row[at])
        found = at[np.bincount(key)[key] > 1]
        edge = np.zeros(len(word) + 1, np.int64)
        np.add.at(edge, found, 1)
        np.add.at(edge, found + WINDOW, -1)
        repeat = np.bincount(row[np.cumsum(edge[:-1]) > 0], minlength=n)
    # Lines with a word, equal to an earlier line of the row; lines end at \n only.
    l_start, l_end, l_row = spans(raw != 10, offsets)
    dup = np.zeros(n, np.int64)
    lines = np.zeros(n, np.int64)
    if len(l_start):
        count = np.concatenate([[0], np.cumsum(~_SPACE[raw])])
        worded = count[l_end] > count[l_start]
        l_start, l_end, l_row = l_start[worded], l_end[worded], l_row[worded]
        lines = np.bincount(l_row, minlength=n)
        _, first = np.unique(_paired(equal_spans(raw, l_start, l_end)[1], l_row), return_index=True)
        again = np.ones(len(l_row), bool)
        again[first] = False
        dup = np.bincount(l_row[again], minlength=n)
    return out | {"n_dup_lines": dup, "n_repeat_words": repeat, "n_lines": lines}


def features(stats: dict[str, np.ndarray]) -> np.ndarray:
    """Ratios of the counts, so that a long text is judged as a short one is; a few words, letters or lines are added
    below the line, so that chance in very short texts is no anomaly. The last is the mean word length, on a log scale, with
    twenty words of five characters added."""
    return np.stack([np.sqrt(stats["n_symbols"] / (stats["n_words"] + 5.0)), stats["n_upper"] / (stats["n_letters"] + 50.0),
                     stats["n_dup_lines"] / (stats["n_lines"] + 10.0), stats["n_repeat_words"] / (stats["n_words"] + 50.0),
                     np.log((stats["word_chars"] + 100.0) / (stats["n_words"] + 20.0))], 1)


@dataclass(frozen=True)
class ForestConfig:
    """``rows``: good rows a tree draws. ``lost``: greatest share of good labelled rows the threshold may reject.
    ``labelled``: None learns from all labelled rows; a caller's number learns from about as many of them only."""

    trees: int = 200
    rows: int = 256
    depth: int = 16
    labelled: int | None = None
    lost: float = 0.002
    seed: int = 5


def _usual_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of a failed search in a binary tree of n rows."""
    n = np.asarray(n, np.float64)
    return np.where(n > 2, 2.0 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2.0 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


class Forest:
    """Random trees over good rows; splits are drawn over each cell of the space from ``low`` to ``high``.

    A tree splits a cell at a random place of a random feature, whether or not rows lie on both sides, until the cell is
    empty or ``depth`` is reached. Places without good rows end after few splits; with splits drawn between the rows
    alone, what no good row has (a symbol, say) would never be split on.
    """

    def __init__(self, data: np.ndarray, low: np.ndarray, high: np.ndarray, config: ForestConfig, draws: np.ndarray | None = None) -> None:
        """``draws``: the places in ``data`` that each tree draws, where ``data`` has drawn rows only."""
        rng = np.random.default_rng(config.seed)
        self.rows = min(config.rows, len(data))
        self.trees = [self._grow(data[rng.choice(len(data), self.rows, replace=False) if draws is None else draws[i]], low, high, config.depth, rng)
                      for i in range(config.trees)]

    @staticmethod
    def _grow(data: np.ndarray, low: np.ndarray, high: np.ndarray, limit: int, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        """Node arrays: feature (leaf: -1), split, left and right child, path length at a leaf."""
        nodes: list[list[float]] = []
        todo = [(data, low, high, 0, -1, 0)]
        while todo:
            part, low, high, depth, parent, side = todo.pop()
            me = len(nodes)
            nodes.append([-1, 0.0, 0, 0, len(part), depth])
            if parent >= 0:
                nodes[parent][2 + side] = me
            open_ = np.flatnonzero(high > low)
            if depth >= limit or not len(part) or not len(open_):
                continue
            f = int(rng.choice(open_))
            split = float(rng.uniform(low[f], high[f]))
            goes = part[:, f] <= split
            nodes[me][:2] = [f, split]
            below, above = high.copy(), low.copy()
            below[f] = above[f] = split
            todo += [(part[~goes], above, high, depth + 1, me, 1), (part[goes], low, below, depth + 1, me, 0)]
        a = np.array(nodes)
        return a[:, 0].astype(int), a[:, 1], a[:, 2:4].astype(int), a[:, 5] + _usual_path(a[:, 4])

    def scores(self, data: np.ndarray) -> np.ndarray:
        """2^(-mean path / usual path): near 1 for rows set apart at once, below 0.5 for common rows."""
        total = np.zeros(len(data))
        for feature, split, child, path in self.trees:
            at = np.zeros(len(data), int)
            live = np.flatnonzero(feature[at] >= 0)
            while len(live):
                node = at[live]
                right = data[live, feature[node]] > split[node]
                at[live] = child[node, right.astype(int)]
                live = live[feature[at[live]] >= 0]
            total += path[at]
        return np.round(2.0 ** (-total / len(self.trees) / max(float(_usual_path(self.rows)), 1.0)), 9)


class QualityModel:
    def __init__(self, forest: Forest | None, threshold: float) -> None:
        self.forest, self.threshold = forest, threshold

    def scores(self, stats: dict[str, np.ndarray]) -> np.ndarray:
        return self.forest.scores(features(stats)) if self.forest else np.zeros(len(stats["n_words"]))


def base_failed(stats: dict[str, np.ndarray]) -> np.ndarray:
    return (stats["n_words"] < 10) | (100 * stats["n_repeat_words"] > 20 * stats["n_words"])


def _measured(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, c: ForestConfig) -> DataFrame:
    """Counts and features of the labelled rows that pass the base rules (written; equal rows of an id once).

    Texts are counted where they are read and only their counts go on: an id may have very many rows, and labels may be
    too many to broadcast.
    """
    known = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("label")).where(
        "label_id is not null and label is not null").groupBy("label_id").agg(F.min("label").alias("label"))
    rows = docs.select(F.col(id_col).alias("label_id"), F.col(text_col).alias("body")).where("label_id is not null")
    point = F.xxhash64("label_id", F.lit(c.seed))
    if c.labelled is not None:
        known = known.where(in_share(point, c.labelled / max(known.count(), 1)))

    def run(texts: pa.Array) -> list:
        stats = statistics(texts)
        return [*[stats[x].astype(np.int64) for x in BASE + MORE], *np.ascontiguousarray(features(stats).T), ~base_failed(stats)]

    fields = [(x, "long") for x in BASE + MORE] + [(x, "double") for x in FEATURES] + [("passed", "boolean")]
    counted = add_columns(rows.withColumn("digest", F.unhex(F.sha2("body", 256))), ["body"], fields, run, ["label_id", "digest"])
    counted = counted.where("passed").drop("passed").distinct().join(known, "label_id")
    if c.labelled is None:
        return materialize(counted, "quality-rows")
    counted, n = materialize_counted(counted.withColumn("point", point), "quality-rows")
    return counted.where(in_share(F.xxhash64("point", "digest"), 2 * c.labelled / max(n, 1)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        config: ForestConfig = ForestConfig()) -> QualityModel:
    """Forest grown on statistics of the labelled rows that pass the base rules; threshold from them.

    The trees draw from the good rows among them, so that what is rare among good rows stands out; splits range over all
    of them. All are scored, and the threshold rejects at most ``config.lost`` of the good rows and otherwise as many bad
    rows as it can. Without good labelled rows nothing is anomalous. At most the rows drawn by the trees reach the driver.
    """
    c = config
    rows = _measured(docs, labels, id_col, text_col, label_col, c)
    ends = rows.agg(F.count_if(F.col("label") == 1).alias("good"), *[f(x).alias(f"{f.__name__}_{x}") for f in (F.min, F.max) for x in FEATURES]).first()
    if not ends["good"]:
        return QualityModel(None, 1.0)
    low, high = (np.array([ends[f"{f}_{x}"] for x in FEATURES]) for f in ("min", "max"))
    low[-1], high[-1] = min(low[-1], np.log(WORD_CHARS[0])), max(high[-1], np.log(WORD_CHARS[1]))
    forest = Forest(*_drawn(rows.where("label = 1"), ends["good"], low, high, c))
    return QualityModel(forest, calibrate(_scored(rows, forest), ends["good"], c.lost))


def _drawn(good: DataFrame, n: int, low: np.ndarray, high: np.ndarray, c: ForestConfig) -> tuple:
    """What a ``Forest`` over ``n`` good rows is made from: the rows, or those that its trees draw where these are fewer.

    Either way each tree draws evenly from all good rows.
    """
    if n <= c.trees * c.rows:
        got = good.select(*BASE, *MORE, *FEATURES).toPandas().sort_values(BASE + MORE)
        return got[FEATURES].to_numpy(), low, high, c
    rng = np.random.default_rng([c.seed, 1])
    draws = np.stack([rng.choice(n, c.rows, replace=False) for _ in range(c.trees)])
    places, draws = np.unique(draws, return_inverse=True)
    ranked = rank_in_groups(good.withColumn("every", F.lit(1)), "every", ["label_id", "digest"], target=RANKED_ROWS)
    wanted = good.sparkSession.createDataFrame(pd.DataFrame({"rank": places}))
    got = ranked.join(F.broadcast(wanted), "rank").select("rank", *FEATURES).toPandas().sort_values("rank")
    return got[FEATURES].to_numpy(), low, high, c, draws.reshape(c.trees, c.rows)


def _scored(rows: DataFrame, forest: Forest) -> DataFrame:
    """``label`` and ``score`` of all measured rows (written)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = np.stack([x.to_numpy(zero_copy_only=False) for x in batch.columns[1:]], 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(forest.scores(data))], names=["label", "score"])

    return materialize(map_arrow(rows.select("label", *FEATURES), run, "label int, score double"), "quality-scores")


def calibrate(scored: DataFrame, n_good: int, lost: float) -> float:
    """Score from which rows are rejected: midway between the highest good score that must stay (at most ``lost`` of the
    ``n_good`` good ones lie above) and the next bad score; without bad rows above every good score.

    The good score of that rank is found exactly among all: by counts of score bins, then of the scores in its bin (scores
    have nine digits), so the driver gets a bounded number of counts.
    """
    good, bad = scored.where("label = 1"), scored.where("label <> 1")
    if bad.isEmpty():
        return float(good.agg(F.max("score")).first()[0]) + 1e-6
    left = min(int(lost * n_good), n_good - 1)
    bin_of = F.floor(F.col("score") * SCORE_BINS)
    part, left = _at_rank(good.groupBy(bin_of.alias("at")).count().collect(), left)
    first, _ = _at_rank(good.where(bin_of == part).groupBy(F.col("score").alias("at")).count().collect(), left)
    above = bad.where(F.col("score") > first).agg(F.min("score")).first()[0]
    return float((first + above) / 2 if above is not None else first + 1e-6)


def _at_rank(counts: list, rank: int) -> tuple:
    """The value that the row of a rank (from 0, greatest value first) has, and its rank among the rows of that value."""
    for at, n in sorted(map(tuple, counts), reverse=True):
        if rank < n:
            return at, rank
        rank -= n
    raise ValueError("rank beyond the rows")


def judge(docs: DataFrame, model: QualityModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all), the base counts, ``base_failed``, ``anomaly`` (forest score) and ``kept``.

    Whole texts are read; null and empty texts have no words and fail the base rule. Repeated rows give repeated results,
    an empty table an empty one, and a kept column with the name of a new one gives way to it.
    """
    def run(texts: pa.Array) -> list:
        stats = statistics(texts)
        failed, anomaly = base_failed(stats), model.scores(stats)
        return [*[stats[x].astype(np.int64) for x in BASE], failed, anomaly, ~failed & (anomaly < model.threshold)]

    fields = [(x, "long") for x in BASE] + [("base_failed", "boolean"), ("anomaly", "double"), ("kept", "boolean")]
    return add_columns(docs, [text_col], fields, run, keep)
