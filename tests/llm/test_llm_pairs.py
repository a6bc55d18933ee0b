"""SimHash trie, components, containment search and ring shards against brute force and on odd rows."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from flightlake.llm.components import components
from flightlake.llm.decontaminate import contaminated, drop_contaminated
from flightlake.llm.ring import fill, ring_shards
from flightlake.llm.simhash_trie import _budgets, classes, fingerprints_of, keep_one, simhash_components, walk

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def brute_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def brute_components(values, bits):
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in values:
        for b in values:
            if a < b and bin(a ^ b).count("1") <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def random_fingerprints(seed, n):
    """Clusters of close values, bit by bit chains and single values."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(n // 3)]
    for base in list(out[:n // 6]):
        for _ in range(3):
            v = base
            for _ in range(rng.randint(1, 7)):
                v ^= 1 << rng.randrange(64)
            out.append(v)
    return sorted(set(out) | {0, (1 << 64) - 1, 1 << 63})


def test_fingerprints_match_brute_force():
    texts = [None, "", " \t\n", "One", "a b c", "A b C d", "a b c d e", "x y " * 900, "é À ü ö É", "a a a b"]
    assert [int(x) for x in fingerprints_of(texts, 4)] == [brute_fingerprint(t) for t in texts]


@pytest.mark.parametrize("bits", [0, 1, 4, 7])
def test_walk_links_exactly_the_near_pairs(bits):
    values = random_fingerprints(bits, 240)
    keys = np.array(values, np.uint64)
    high, low = bits // 2, bits - bits // 2 - 1
    edges = [walk(keys, None, _budgets(high, bits)).T.tolist()]
    if low >= 0:
        turned = np.sort(keys << np.uint64(32) | keys >> np.uint64(32))
        e = walk(turned, None, _budgets(low, bits))
        edges.append((e << np.uint64(32) | e >> np.uint64(32)).T.tolist())
    expected = brute_components(values, bits)
    found = {v: v for v in values}

    def find(x):
        while found[x] != x:
            x = found[x]
        return x

    for a, b in sum(edges, []):
        x, y = find(int(a)), find(int(b))
        assert bin(int(a) ^ int(b)).count("1") <= bits or expected[int(a)] == expected[int(b)]
        found[max(x, y)] = min(x, y)
    assert {v: find(v) for v in values} == expected


@pytest.mark.parametrize("leaf,target", [(65_536, 16_384), (20, 10)])
def test_classes_over_a_deep_trie_match_brute_force(spark, leaf, target):
    values = random_fingerprints(5, 200)
    rows = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)]
    got = {r["fp"] % (1 << 64): r["component_id"] for r in classes(frame(spark, rows, "doc_id long, fp long"), "doc_id", 4, leaf, target).collect()}
    expected = brute_components(values, 4)
    least = {}
    for i, v in enumerate(values):
        least[expected[v]] = min(i, least.get(expected[v], i))
    assert got == {v: least[expected[v]] for v in values}


def test_components_of_chains_stars_and_bad_links(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3), (5, None), (1, 0)]
    got = {r["node"]: r["root"] for r in components(frame(spark, links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components(frame(spark, [], "u long, v long")).count() == 0


def test_simhash_odd_rows(spark):
    rows = [(3, None), (1, ""), (2, "a b c d e f g"), (2, "a b c d e f g"), (None, "A B c d e f g"), (9, "zz yy xx ww vv")]
    got = simhash_components(frame(spark, [(*r, 1) for r in rows], "doc_id long, text string, fp int")).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"]) for r in got) == [(-1, 2), (1, 1), (2, 2), (2, 2), (3, 1), (9, 9)]
    assert simhash_components(frame(spark, [])).count() == 0


def test_keep_one_of_each_component_keeps_columns(spark):
    rows = [(5, "a b c d e f", "x", 1), (2, "A b c d e f", "y", 2), (2, "a b c d e f", "z", 3), (None, "a b c d e f", None, 4), (8, None, None, None), (None, "q r s t u v", "w", 5)]
    docs = frame(spark, rows, "doc_id long, text string, fp string, __row int")
    for bound in (1_000_000, 0):  # removed rows broadcast, and shuffled
        left = keep_one(docs, broadcast_rows=bound)
        assert left.columns == docs.columns
        assert sorted(r["doc_id"] or -1 for r in left.collect()) == [-1, 2, 8]
    assert keep_one(docs.limit(0)).count() == 0


def brute_containment(docs, items, t=0.8):
    import re

    def shingles(text):
        w = [x for x in re.split(r"[^\w]+|_", (text or "").lower()) if x]
        return {" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    return sorted((d, i, len(shingles(b)), len(shingles(b) & shingles(a))) for d, a in docs for i, b in items
                  if shingles(b) and len(shingles(b) & shingles(a)) / len(shingles(b)) >= t)


def test_containment_matches_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 70)))) for i in range(40)]
    docs = []
    for d in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 30, 400]))]
        for _ in range(rng.randint(0, 2)):
            passage = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, 3)):  # up to three altered words
                passage[rng.randrange(len(passage))] = rng.choice(vocabulary)
            at = rng.randint(0, len(words))
            words[at:at] = passage
        docs.append((d, ", ".join(w.upper() if rng.random() < 0.2 else w for w in words)))
    expected = brute_containment(docs, items)
    assert len(expected) > 20
    shown = "doc_id", "item_id", "n_item", "n_shared"
    for rows in (1_000_000, 50):  # one pass, and blocks of sketches
        monkeypatch.setattr("flightlake.llm.decontaminate.SKETCH_ROWS", rows)
        got = contaminated(frame(spark, docs), frame(spark, items, "item_id long, text string")).select(*shown)
        assert sorted(map(tuple, got.collect())) == expected


def test_containment_odd_rows(spark):
    item = "one two three four five six seven"
    items = frame(spark, [(1, item), (2, None), (3, ""), (4, "short one"), (None, item), (1, item)], "item_id long, text string")
    rows = [(1, f"x {item} y", 0), (1, f"x {item} y", 0), (2, None, 0), (3, "", 0), (4, "Short, ONE!", 0), (5, "a short one b", 0), (None, item, 0), (1, "clean text", 0)]
    docs = frame(spark, rows, "doc_id long, text string, h int")
    got = contaminated(docs, items).collect()
    assert sorted((r["doc_id"] or -1, r["item_id"] or -1) for r in got) == [(-1, -1), (-1, 1), (1, -1), (1, 1), (4, 4)]
    for bound in (500_000, 0):
        clean = drop_contaminated(docs, items, broadcast_rows=bound)
        assert clean.columns == docs.columns
        assert sorted(r["text"] or "-" for r in clean.collect()) == ["-", "-", "a short one b", "clean text"]
    assert contaminated(docs.limit(0), items).count() == 0
    assert contaminated(docs, items.limit(0)).count() == 0
    with pytest.raises(ValueError):
        contaminated(docs, items, threshold=0)


def test_fill_places_every_row_once():
    rng = random.Random(1)
    owners = [rng.randrange(5) for _ in range(40)]
    counts = [rng.choice([0, 1, 7, 30, 900]) for _ in owners]
    n = sum(counts)
    capacity = [n // 5 + (s < n % 5) for s in range(5)]
    placed = fill(counts, owners, capacity)
    rows = {arc: [] for arc in range(40)}
    slots = {s: [] for s in range(5)}
    for arc, lo, hi, shard, base in placed:
        rows[arc] += range(lo, hi)
        slots[shard] += range(base, base + hi - lo)
    assert all(sorted(rows[arc]) == list(range(counts[arc])) for arc in rows)
    assert all(sorted(slots[s]) == list(range(capacity[s])) for s in slots)


def test_ring_shards_are_balanced_and_gapless(spark):
    rows = [(i, "copy" if i % 3 == 0 else f"text {i}", i) for i in range(3000)] + [(None, None, 0), (7, "text 7", 1), (7, "text 7", 1), (1, "", 0)]
    docs = frame(spark, rows, "doc_id long, text string, shard int")
    got = ring_shards(docs, 24).collect()
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert sum(map(len, by.values())) == len(rows)
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = {(r["doc_id"], r["size"], r["text_crc32"]) for r in got}
    import zlib
    assert sizes == {(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows}
    alone = {r["doc_id"]: r["shard"] for r in got if r["doc_id"] and r["shard"] == r["own_shard"]}
    assert len(alone) > 0.55 * len(rows)  # only the overflow (here mostly the copies) moved
    again = {r["doc_id"]: r["shard"] for r in ring_shards(docs, 24).collect() if r["doc_id"] != 7}
    assert again == {r["doc_id"]: r["shard"] for r in got if r["doc_id"] != 7}
    assert ring_shards(docs.limit(0), 24).count() == 0


def test_native_operators_have_no_python_in_their_plans(spark):
    docs = frame(spark, [(1, "a b c d e f")])
    for df in (ring_shards(docs, 4), contaminated(docs, frame(spark, [(1, "a b c d e f")], "item_id long, text string"))):
        plan = df._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoop"))


def test_a_dump_of_items_is_cut_once_and_grows_in_proportion(spark):
    import time

    def words(i):
        return " ".join(f"w{i}x{j}" for j in range(12))

    def took(n):
        items = spark.createDataFrame([(i, words(i)) for i in range(n)], "item_id long, text string").cache()
        docs = spark.createDataFrame([(1, " and ".join(words(i) for i in range(n))), (2, "nothing of it here at all")] * 2, "doc_id long, text string").cache()
        items.count(), docs.count()
        start = time.monotonic()
        found = contaminated(docs, items).groupBy("doc_id").count().collect()
        assert [tuple(r) for r in found] == [(1, n)]
        return time.monotonic() - start

    took(200)
    assert took(3200) < 4 * took(400) + 4  # with the square, 64 times


def test_items_of_one_text_are_named_by_their_rows(spark, monkeypatch):
    items = spark.range(3000).select(F.col("id").alias("item_id"), F.when(F.col("id") % 2 == 0, "one two three four five six").alias("text"))
    docs = spark.createDataFrame([(1, "say one two three four five six now"), (2, None)], "doc_id long, text string")
    for bound in (32 * 1024 * 1024, 1):  # names under and over the bound of a broadcast
        monkeypatch.setattr("flightlake.llm.decontaminate.ITEM_BYTES", bound)
        got = contaminated(docs, items)
        assert got.count() == 1500 and got.select("doc_id").distinct().collect() == [(1,)]
    plan = got._jdf.queryExecution().toString()
    assert "rightHint=(strategy=broadcast)" not in plan and "leftHint=(strategy=broadcast)" not in plan
