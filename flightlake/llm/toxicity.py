"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Stems (word beginnings) are hashed as words are, since insults are inflected. L1 keeps features that a few examples
alone could tell apart at zero, so a few hundred weights are left and are sent to every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flightlake.llm.common import add_columns, chunks, in_share, map_arrow
from flightlake.session import materialize_counted
from flightlake.llm.features import all_grams, distinct


@dataclass(frozen=True)
class FtrlConfig:
    """``sample``: expected number of labelled documents the model is fitted on, in all (a documented bound)."""

    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.0
    epochs: int = 3
    sample: int = 8_000
    seed: int = 11


class Ftrl:
    """Per-coordinate learning rates and L1 sparsity; features are present or not, and a bias that is not shrunk."""

    def __init__(self, config: FtrlConfig) -> None:
        self.c = config
        self.z, self.n = np.zeros(1 << config.bits), np.zeros(1 << config.bits)
        self.bias_z = self.bias_n = 0.0

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n, c = self.z[at], self.n[at], self.c
        return np.where(np.abs(z) <= c.l1, 0.0, -(z - np.sign(z) * c.l1) / ((c.beta + np.sqrt(n)) / c.alpha + c.l2))

    def bias(self) -> float:
        return -self.bias_z * self.c.alpha / (self.c.beta + self.bias_n ** 0.5)

    def learn(self, at: np.ndarray, label: int) -> None:
        w, bias = self.weights(at), self.bias()
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.c.alpha * w
        self.n[at] = n + g * g
        step = ((self.bias_n + g * g) ** 0.5 - self.bias_n ** 0.5) / self.c.alpha
        self.bias_z += g - step * bias
        self.bias_n += g * g


class ToxicityModel:
    """Indices and values of the non-zero weights (at most 2^bits of each, few in practice) and the bias."""

    def __init__(self, at: np.ndarray, value: np.ndarray, bias: float, bits: int) -> None:
        self.at, self.value, self.bias, self.bits = at, value, bias, bits
        self.table: np.ndarray | None = None  # laid out in the tasks, so only the non-zero weights travel

    def scores(self, texts: pa.Array) -> np.ndarray:
        total = np.full(len(texts), self.bias)
        if len(self.at):
            if self.table is None:
                self.table = np.zeros(1 << self.bits)
                self.table[self.at] = self.value
            row, feature = all_grams(texts, self.bits)
            hit = self.table[feature] != 0
            row, feature = distinct(row[hit], feature[hit], self.bits)
            total += np.bincount(row, self.table[feature], len(texts))
        return 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        config: FtrlConfig = FtrlConfig()) -> ToxicityModel:
    """Weights learned from ``docs`` rows whose id has a label (null ids and null labels have none; of several labels
    of an id the largest holds).

    FTRL takes one example after another, so it runs in one task, over about ``config.sample`` labelled documents
    taken by a hash of their id, and at most about twice as many different rows of these; the ids are broadcast (bounded by
    the sample), so no other text is moved. With no
    labelled row the model scores 0.5 everywhere. Nulls count as empty texts.
    """
    c = config
    known = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("label")).where(
        "label_id is not null and label is not null").groupBy("label_id").agg(F.max("label").alias("label"))
    n = known.count()
    point = F.xxhash64("label_id", F.lit(c.seed))
    taken = known.where(in_share(point, c.sample / max(n, 1)))
    rows = docs.select(F.col(id_col).alias("label_id"), F.col(text_col).alias("body")).join(F.broadcast(taken), "label_id")
    # An id may have many rows: the sample is bounded in rows too, equal rows counting once.
    rows, n_rows = materialize_counted(rows.select("body", "label", point.alias("point")).distinct(), "toxicity-rows")
    rows = rows.where(in_share(F.xxhash64("point", "body"), 2 * c.sample / max(n_rows, 1)))
    bits = c.bits

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            at = 0
            for part in chunks(batch.column(0)):
                y = batch.column(1).slice(at, len(part)).to_numpy()
                at += len(part)
                row, feature = distinct(*all_grams(part, bits), bits)
                ends = np.searchsorted(row, np.arange(len(part) + 1))
                examples += [(feature[a:b].astype(np.int32), int(label)) for a, b, label in zip(ends, ends[1:], y)]
        model = Ftrl(c)
        for _ in range(c.epochs if examples else 0):
            for feature, label in examples:
                model.learn(feature, label)
        w = model.weights(slice(None))
        keep = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(keep, -1)), pa.array(np.append(w[keep], model.bias()))], names=["i", "w"])

    learned = map_arrow(
        rows.repartition(1).sortWithinPartitions("point", "label", "body"), learn, "i long, w double").collect()
    weights = {r["i"]: r["w"] for r in learned}
    bias = weights.pop(-1, 0.0)
    at = np.array(sorted(weights), np.int64)
    return ToxicityModel(at, np.array([weights[i] for i in at]), bias, bits)


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", keep: list[str] | None = None,
          name: str = "score") -> DataFrame:
    """``keep`` columns (default: all) and the probability of the label. Null and empty texts get the bias's.

    Every row is scored by itself: repeated rows get equal scores, and an empty table gives no rows.
    """
    return add_columns(docs, [text_col], [(name, "double")], lambda texts: [model.scores(texts)], keep)
