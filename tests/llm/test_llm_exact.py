"""Equality of texts is decided by their bytes, and samples never round to nothing."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from flightlake.llm import quality_forest, queries, toxicity
from flightlake.llm.common import equal_spans, in_share, span_hashes
from flightlake.llm.tokens import Parts


def thue_morse(n, a, b):
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(n))


# Two texts that every polynomial hash modulo 2^64 takes for one.
TWINS = [thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")]


def test_twins_share_a_hash_and_are_told_apart():
    raw = np.frombuffer("".join(TWINS + TWINS).encode(), np.uint8)
    starts = np.arange(4) * 1024
    hashes = span_hashes(raw, starts, starts + 1024)
    assert hashes[0] == hashes[1]
    first, group = equal_spans(raw, starts, starts + 1024)
    assert group[0] == group[2] != group[1] == group[3] and sorted(first.tolist()) == [0, 1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "ab", "ba", *TWINS, TWINS[0] + "x", TWINS[1] + "x", "é" * 40]), min_size=1, max_size=30))
def test_equal_spans_are_equal_bytes(parts):
    data = [p.encode() for p in parts]
    raw = np.frombuffer(b"".join(data), np.uint8)
    ends = np.cumsum([len(d) for d in data])
    first, group = equal_spans(raw, ends - [len(d) for d in data], ends)
    assert [data[first[g]] for g in group] == data
    assert len(set(group.tolist())) == len(first) == len(set(data))


@pytest.mark.parametrize("blocks", [[TWINS], [[TWINS[0]], [TWINS[1]]], [[f"{t} {t}\nx" for t in TWINS] * 2]])
def test_token_ids_of_twins(blocks):
    path = queries.tokenizer_path()
    parts = Parts(path)
    for block in blocks * 2:
        flat, at = parts.ids(pa.array(block, pa.large_string()))
        want = [e.ids for e in parts.tokenizer.encode_batch(block, add_special_tokens=False)]
        assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == want


def test_known_parts_are_compared_by_their_bytes(monkeypatch):
    from flightlake.llm import tokens

    monkeypatch.setattr(tokens, "span_hashes", lambda raw, starts, ends: np.zeros(len(starts), np.uint64))
    parts = Parts(queries.tokenizer_path())
    rng = random.Random(1)
    for _ in range(6):
        block = [" ".join(rng.choice(["alpha", "beta", "gamma", "del", "epsilon"]) for _ in range(20)) for _ in range(5)]
        flat, at = parts.ids(pa.array(block, pa.large_string()))
        want = [e.ids for e in parts.tokenizer.encode_batch(block, add_special_tokens=False)]
        assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == want


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    marked = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)}
    return len(words), len(lines) - len(set(lines)), len(marked)


def test_quality_counts_of_twins_and_of_any_text():
    rng = random.Random(2)
    texts = ["\n".join(TWINS), "\n".join(TWINS * 2), " ".join([*TWINS, "x", "y", "z", TWINS[1], TWINS[0], "x", "y", "z"]), " ".join(["a b c d e"] * 3), ""]
    texts += [" ".join(rng.choice("ab") + rng.choice(["", "\n"]) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    got = quality_forest.statistics(pa.array(texts, pa.large_string()))
    assert list(zip(got["n_words"].tolist(), got["n_dup_lines"].tolist(), got["n_repeat_words"].tolist())) == [plain_counts(t) for t in texts]


@pytest.mark.parametrize("n", [10**3, 10**9, 10**12, 10**18])
def test_a_sample_of_any_table_has_its_size(spark, n):
    share = 2_000 / n
    bound = spark.range(1).select(in_share(F.lit(-(1 << 63)).cast("long"), share), in_share(F.lit((1 << 63) - 1), share)).first()
    assert bound[0] and bound[1] == (share >= 1)
    if share < 1:
        width = max(1, int(share * 2.0**64))
        assert width / 2**64 * n == pytest.approx(2_000, rel=0.1)
        at = spark.range(1).select(in_share(F.lit(width - 1 - (1 << 63)), share), in_share(F.lit(width - (1 << 63)), share)).first()
        assert tuple(at) == (True, False)


def test_toxicity_sample_is_bounded_in_rows(spark):
    docs = spark.range(4000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text of "), F.col("id").cast("string")).alias("text"))
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, config=toxicity.FtrlConfig(sample=50, l1=0.0))
    assert len(model.at) < 1500  # about 100 rows' words and not 4,000 rows'
    assert len(toxicity.fit(docs, labels, config=toxicity.FtrlConfig(sample=5000, l1=0.0)).at) > 3000


def test_quality_sample_is_bounded_in_rows(spark, monkeypatch):
    docs = spark.range(4000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(
        F.lit("one two three four five six seven eight nine ten eleven "), F.col("id").cast("string")).alias("text"))
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    grown, real = [], quality_forest.Forest
    monkeypatch.setattr(quality_forest, "Forest", lambda rows, *rest: grown.append(len(rows)) or real(rows, *rest))
    quality_forest.fit(docs.unionByName(docs), labels, config=quality_forest.ForestConfig(labelled=50))
    quality_forest.fit(docs.unionByName(docs), labels, config=quality_forest.ForestConfig(labelled=5000))
    assert 50 < grown[0] < 160 and grown[1] == 4000  # about 100 different rows of the id; all of them


def test_quality_learns_from_every_labelled_row(spark, monkeypatch):
    """More rows than trees draw: splits range over all of them and the threshold loses no good one, however rare."""
    n, odd = 30_000, 40
    words = F.concat(F.lit("one two three four five six seven eight nine ten eleven "), F.col("id").cast("string"))
    text = F.when(F.col("id") < odd, F.concat(words, F.lit(" "), F.repeat(F.lit("#"), F.col("id").cast("int")))).when(
        F.col("id") >= n, F.concat(words, F.lit(" ab ABCD " + "#" * 400))).otherwise(words)
    docs = spark.range(n + 5).select(F.col("id").alias("doc_id"), text.alias("text"))
    labels = spark.range(n + 5).select(F.col("id").alias("doc_id"), (F.col("id") < n).cast("int").alias("quality"))
    grown, real = [], quality_forest.Forest
    monkeypatch.setattr(quality_forest, "Forest", lambda *given: grown.append(given) or real(*given))
    model = quality_forest.fit(docs, labels, config=quality_forest.ForestConfig(trees=20, rows=64, lost=0.0))
    got = docs.select("doc_id", "text").toPandas()
    data = quality_forest.features(quality_forest.statistics(pa.array(got["text"])))
    drawn, low, high = grown[0][:3]
    assert np.allclose(high[:4], data[:, :4].max(axis=0)) and np.allclose(low[:4], data[:, :4].min(axis=0))
    assert len(drawn) <= 20 * 64 and grown[0][4].shape == (20, 64) and set(map(tuple, drawn)) <= set(map(tuple, data[got["doc_id"] < n]))
    assert all(len(set(tree)) == 64 for tree in grown[0][4].tolist())
    kept = quality_forest.judge(docs, model, keep=["doc_id"]).where("kept").toPandas()["doc_id"]
    assert sorted(kept) == list(range(n))


@pytest.mark.parametrize("lost", [0.0, 0.002, 0.3, 1.0])
def test_quality_threshold_of_all_scores_equals_a_sort(spark, lost):
    rng = np.random.default_rng(4)
    good, bad = np.round(rng.beta(2, 5, 3000), 9), np.round(rng.beta(5, 3, 400), 9)
    good[:300] = 0.5  # ties
    scored = spark.createDataFrame([(1, float(x)) for x in good] + [(0, float(x)) for x in bad], "label int, score double")
    first = np.sort(good)[::-1][min(int(lost * len(good)), len(good) - 1)]
    assert quality_forest.calibrate(scored, len(good), lost) == ((first + bad[bad > first].min()) / 2 if (bad > first).any() else first + 1e-6)
    assert quality_forest.calibrate(scored.where("label = 1"), len(good), lost) == good.max() + 1e-6
