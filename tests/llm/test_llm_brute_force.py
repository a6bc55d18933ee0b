"""Ring, language, toxicity and quality operators against plain versions that go row by row."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from flightlake.llm import langid, quality_forest, queries, toxicity
from flightlake.llm.ring import VNODES, ring_shards

SF001 = "/root/testdata/sf0.001"


def chained(*parts):
    """Spark's ``xxhash64`` of several columns: the hash of one is the seed of the next."""
    h = 42
    for p in parts:
        h = xxhash.xxh64_intdigest(p, h)
    return h


def le(n, width=8):
    return n.to_bytes(width, "little", signed=True)


def walked(rows, shards):
    """(shard, own shard) of each (id, text): every row walks the ring by itself, one after another."""
    nodes = {}
    for s in range(shards):
        for v in range(VNODES):
            cell = chained(b"ring", le(s), le(v)) >> 48
            nodes[cell] = min(s, nodes.get(cell, s))
    ring = sorted(nodes.items())
    arcs = defaultdict(list)
    for i, text in rows:
        h = xxhash.xxh64_intdigest((text or "").encode(), 42)
        arc = next((at for at, (cell, _) in enumerate(ring) if cell >= h >> 48), 0)
        arcs[arc].append((h - (1 << 64) if h >> 63 else h, i))
    room = [len(rows) // shards + (s < len(rows) % shards) for s in range(shards)]
    placed, over = {}, defaultdict(list)
    for arc in range(len(ring)):
        for _, i in sorted(arcs[arc]):
            own = ring[arc][1]
            if room[own]:
                room[own] -= 1
                placed[i] = own, own
            else:
                over[arc].append(i)
    # Overflow goes on clockwise; who has walked longest enters first.
    walking = []
    for turn in range(2):
        for arc, (_, shard) in enumerate(ring):
            while walking and room[shard]:
                i, own = walking.pop(0)
                room[shard] -= 1
                placed[i] = shard, own
            if not turn:
                walking += [(i, shard) for i in over[arc]]
    return placed


@pytest.mark.parametrize("shards", [1, 7, 24])
def test_every_row_of_the_ring_is_where_a_walk_takes_it(spark, shards):
    rows = [(i, None if i == 5 else "" if i == 6 else "a passage copied often" if i % 3 == 0 else f"text {i * 7919} é") for i in range(2700)]
    got = ring_shards(spark.createDataFrame(rows, "doc_id long, text string"), shards).collect()
    assert {r["doc_id"]: (r["shard"], r["own_shard"]) for r in got} == walked(rows, shards)


def test_one_more_shard_moves_few_rows(spark):
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    before, after = ring_shards(docs, 24).select("doc_id", "shard"), ring_shards(docs, 25).select("doc_id", F.col("shard").alias("new"))
    moved = before.join(after, "doc_id").where("shard <> new").count() / 40_000
    assert 1 / 25 <= moved < 0.15  # hashing by remainder would move 0.96


def plain_profile(text, vectors={}):
    """Sum of the vectors of all letter trigrams, one after another."""
    line = " " + "".join(c if c.isalpha() else " " for c in (text or "").lower()) + " "
    line = re.sub(" +", " ", line)
    total = np.zeros(langid.DIMS)
    if line.strip():
        for gram, times in Counter(line[i:i + 3] for i in range(len(line) - 2)).items():
            if gram not in vectors:
                a, b, c = (langid.letter_vector(ord(x), langid.DIMS, langid.SEED).astype(int) for x in gram)
                vectors[gram] = np.roll(a, 2) * np.roll(b, 1) * c
            total += times * vectors[gram]
    return total


def unit(v):
    return v / (np.linalg.norm(v) or 1)


def test_language_query_equals_plain_prototypes_and_cosines(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang").toPandas()
    vectors = {i: unit(plain_profile(t)) for i, t in zip(docs["doc_id"], docs["text"])}
    sums = defaultdict(lambda: np.zeros(langid.DIMS))
    for i, lang in zip(docs["doc_id"], docs["lang"]):
        if lang is not None and zlib.crc32(str(i).encode()) % 3 != 1:
            sums[lang] += vectors[i]
    langs = sorted(sums)
    prototypes = np.stack([unit(sums[x]) for x in langs])
    got = {r["doc_id"]: r for r in queries.q_language(spark, SF001).collect()}
    assert set(got) == set(docs["doc_id"])
    for i, v in vectors.items():
        cos = prototypes @ v
        first, second = np.sort(cos)[::-1][:2] if len(langs) > 1 else (cos[0], -1)
        if v.any() and first - second > 1e-4:
            assert got[i]["lang_pred"] == langs[int(cos.argmax())]
        share = 1 / np.exp(20 * (cos - first)).sum() if v.any() else 0
        assert got[i]["cosine"] == pytest.approx(first if v.any() else 0, abs=1e-4) and got[i]["score"] == pytest.approx(share, abs=1e-3)


def plain_features(text):
    """Words, word beginnings, neighbours and words with one between them, as text: nothing is hashed."""
    words = re.findall(r"[0-9a-z\u0080-\U0010FFFF]+", (text or "").lower())
    return ({("word", w) for w in words} | {("stem", w[:k]) for w in words for k in (3, 4, 5, 6, 7) if len(w) > k}
            | {("next", *p) for p in zip(words, words[1:])} | {("skip", *p) for p in zip(words, words[2:])})


def plain_ftrl(examples, c):
    """Weights of FTRL-proximal, a coordinate at a time; the bias is a coordinate without L1 and L2."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(f):
        l1, l2 = (0.0, 0.0) if f == "bias" else (c.l1, c.l2)
        if abs(z[f]) <= l1:
            return 0.0
        return -(z[f] - math.copysign(l1, z[f])) / ((c.beta + math.sqrt(n[f])) / c.alpha + l2)

    for _ in range(c.epochs):
        for found, label in examples:
            w = {f: weight(f) for f in found | {"bias"}}
            g = 1 / (1 + math.exp(-sum(w.values()))) - label
            for f in w:
                sigma = (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / c.alpha
                z[f] += g - sigma * w[f]
                n[f] += g * g
    return {f: weight(f) for f in [*z]}


def test_toxicity_equals_plain_ftrl(spark):
    words = ["mild", "calm", "rotten", "rottenest", "vile", "día", "ok7", "of"]
    rows = [(i, " ".join(words[(i * 7 + j * j * (1 + i % 3)) % 8] for j in range(6)), int(i % 4 == 0)) for i in range(80)]
    rows = [(i, t + " Rotten!" if y else t.replace("rotten ", ""), y) for i, t, y in rows]
    config = toxicity.FtrlConfig(l1=0.3, l2=0.1)
    docs = spark.createDataFrame([r[:2] for r in rows] + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 5], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels, config=config)).collect()}

    def place(i):
        h = chained(le(i), le(config.seed, 4))
        return h - (1 << 64) if h >> 63 else h

    known = sorted(((place(i), y, t) for i, t, y in rows if i % 5))
    weights = plain_ftrl([(plain_features(t), y) for _, y, t in known], config)
    assert 10 < sum(w != 0 for w in weights.values()) < len(weights)
    for i, text in [r[:2] for r in rows] + [(900, None), (901, "")]:
        total = sum(weights.get(f, 0.0) for f in plain_features(text) | {"bias"})
        assert got[i] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)


def plain_tree(rows, low, high, depth, limit, rng):
    """A random tree grown by recursion, the side below the split first."""
    wide = [f for f in range(len(low)) if high[f] > low[f]]
    if depth >= limit or not rows or not wide:
        return depth, len(rows)
    f = int(rng.choice(np.array(wide)))
    split = float(rng.uniform(low[f], high[f]))
    below = plain_tree([r for r in rows if r[f] <= split], low, [*high[:f], split, *high[f + 1:]], depth + 1, limit, rng)
    above = plain_tree([r for r in rows if r[f] > split], [*low[:f], split, *low[f + 1:]], high, depth + 1, limit, rng)
    return f, split, below, above


def path(tree, row):
    while len(tree) == 4:
        f, split, below, above = tree
        tree = above if row[f] > split else below
    return tree[0] + usual(tree[1])


def usual(n):
    """Mean depth of a failed search among n rows, with the harmonic number by its usual approximation."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def test_forest_scores_equal_plain_path_lengths():
    rng = np.random.default_rng(3)
    data = np.concatenate([rng.normal(0.3, 0.05, (400, 3)), np.full((30, 3), 0.3)])
    asked = np.concatenate([data[::9], rng.uniform(-1, 2, (60, 3))])
    config = quality_forest.ForestConfig(trees=12, rows=64, depth=7)
    low, high = data.min(axis=0), data.max(axis=0) + 0.5
    got = quality_forest.Forest(data, low, high, config).scores(asked)
    again = np.random.default_rng(config.seed)
    trees = []
    for _ in range(config.trees):
        taken = data[again.choice(len(data), config.rows, replace=False)].tolist()
        trees.append(plain_tree(taken, low.tolist(), high.tolist(), 0, config.depth, again))
    plain = [2 ** (-sum(path(t, row) for t in trees) / len(trees) / usual(config.rows)) for row in asked.tolist()]
    assert np.allclose(got, plain, atol=1e-8) and max(got[-60:]) > max(got[:-60])


def test_verdicts_follow_the_forest_and_the_threshold(spark):
    got = queries.q_quality(spark, SF001).collect()
    docs, labels = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_forest.fit(docs.select("doc_id", "text"), labels.select("doc_id", "quality"))
    assert all(r["kept"] == (not r["base_failed"] and r["anomaly"] < model.threshold) for r in got)
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    known = [r for r in got if r["doc_id"] in good and not r["base_failed"]]
    assert sum(r["anomaly"] >= model.threshold for r in known) <= max(1, 0.002 * len(known))


def test_repeated_rows_get_equal_results_as_often(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").limit(40)
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    twice = docs.unionByName(docs)
    toxic, quality = toxicity.fit(twice, labels), quality_forest.fit(twice, labels)
    for made in (toxicity.score(twice, toxic, keep=["doc_id"]), quality_forest.judge(twice, quality, keep=["doc_id"])):
        count = Counter(tuple(r) for r in made.collect())
        assert len(count) == 40 and set(count.values()) == {2}
    once = toxicity.fit(docs, labels)  # equal rows count once
    assert (once.at == toxic.at).all() and np.allclose(once.value, toxic.value)
