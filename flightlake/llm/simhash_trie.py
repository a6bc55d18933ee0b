"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

A fingerprint has 64 bits from the XXH64 values (seed 42) of a document's word shingles. Two fingerprints
within ``max_bits`` differ in at most h = max_bits // 2 bits of their upper half or in at most
max_bits - h - 1 bits of their lower half. So two tries are walked, one with the upper half first and one
with the lower half first, and both prune node pairs early: by the half's own error budget inside the first
32 levels, by ``max_bits`` below them. No linked pair is missed.

The walk is dealt out in two steps. Spark walks the top levels: pairs of trie nodes whose prefixes are within
the budget, deeper only where a pair holds more than ``LEAF`` fingerprints. Each remaining pair of subtrees is one
row with both sorted fingerprint arrays (at most LEAF values), and a task walks those two subtrees together,
keeping only a spanning forest of the links it meets (never all pairs). Components of the forests' edges are
then found by star steps. Equal fingerprints are grouped first, so a group of copies of any size is one leaf.

What the walk deals out: with n different fingerprints the top nodes lie at depth d = log2(n / ``NODE_TARGET``), and a node's
array goes to every node within the half's budget, which is at most the sum of C(d, i) for i up to the budget. With 4 bits
that is 1 + d + d(d-1)/2 copies in one trie and 1 + d in the other: 137 + 17 at a billion fingerprints (1.2 TB), 211 +
21 at ten billion. It grows with the square of log n, and no link is left out for it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flightlake.llm.common import add_columns, map_arrow
from flightlake.llm.components import components
from flightlake.session import materialize, materialize_counted

SHINGLE_WORDS = 4
MAX_BITS = 4
# Mean fingerprints of a top node, the most of a node pair, and levels gone down where a pair has more.
NODE_TARGET, LEAF, STEP = 16_384, 65_536, 4
# Node pairs of at most this many fingerprints each are compared directly; pairs walked at once.
SMALL, FRONT = 4, 1 << 18


def fingerprints_of(texts: list[str | None], shingle_words: int) -> np.ndarray:
    """SimHash of each text: A-Z lowered, words split at ASCII white space, shingle repeats counted."""
    from xxhash import xxh64_intdigest

    out = np.zeros(len(texts), np.uint64)
    for row, text in enumerate(texts):
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not words:
            continue
        flat = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:-1].tolist()]
        stops = (ends - 1).tolist()[shingle_words - 1:] or [len(flat)]
        hashes = np.fromiter((xxh64_intdigest(flat[a:b], 42) for a, b in zip(starts, stops)), np.uint64, len(stops))
        ones = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 8192):
            part = hashes[at:at + 8192]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[row] = np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0]
    return out


def fingerprints(docs: DataFrame, text_col: str = "text", shingle_words: int = SHINGLE_WORDS,
                 keep: list[str] | None = None, name: str = "fp") -> DataFrame:
    """``keep`` columns (default: all) and the fingerprint as a signed long. Null or word-less text: zero."""
    def run(texts: pa.Array) -> list:
        return [fingerprints_of(texts.to_pylist(), shingle_words).view(np.int64)]

    return add_columns(docs, [text_col], [(name, "long")], run, keep)


class _Forest:
    """Union-find over array positions with whole-array steps; keeps only what joins two trees."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            ra, rb = root[a], root[b]
            low, high = np.minimum(ra, rb), np.maximum(ra, rb)
            live = low != high
            if not live.any():
                break
            a, b, low, high = a[live], b[live], low[live], high[live]
            np.minimum.at(root, high, low)
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root[:] = up


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def walk(left: np.ndarray, right: np.ndarray | None, budgets: np.ndarray) -> np.ndarray:
    """Walk the tries of two sorted uint64 arrays together; two rows: the ends of a spanning forest's edges.

    ``budgets[d]`` is the most differing bits allowed in the first d bits. ``right`` None: ``left`` with itself.
    """
    own = right is None
    keys = left if own else np.concatenate([left, right])
    shift = 0 if own else len(left)
    n = len(keys)
    forest = _Forest(n)
    last = int(budgets[64])
    first = np.array([[0, len(left), shift, n]], np.int64)
    stack = [(0, first)] if len(left) and n > shift else []
    while stack:
        depth, front = stack.pop()
        if len(front) > FRONT:
            stack.append((depth, front[FRONT:]))
            front = front[:FRONT]
        a0, a1, b0, b1 = front.T
        same = (a0 == b0) & (a1 == b1)
        size_a, size_b = a1 - a0, b1 - b0
        small = ((size_a <= SMALL) & (size_b <= SMALL)) if depth < 64 else np.ones(len(front), bool)
        if small.any():
            s0, s1, t0, t1 = a0[small], a1[small], b0[small], b1[small]
            count = (s1 - s0) * (t1 - t0)
            which = np.repeat(np.arange(len(s0)), count)
            k = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            wide = (t1 - t0)[which]
            x, y = s0[which] + k // wide, t0[which] + k % wide
            fresh = forest.root[x] != forest.root[y]
            x, y = x[fresh], y[fresh]
            near = _bits(keys[x] ^ keys[y]) <= last
            forest.join(x[near], y[near])
        rest = ~small
        if not rest.any():
            continue
        a0, a1, b0, b1, same = a0[rest], a1[rest], b0[rest], b1[rest], same[rest]
        bit = np.uint64(1) << np.uint64(63 - depth)
        low_mask = bit - np.uint64(1)

        def split(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
            """Where each node's second child starts: the first key with this level's bit set."""
            pivot = (keys[lo] & ~(low_mask | bit)) | bit
            if own:
                return np.clip(np.searchsorted(keys, pivot), lo, hi)
            in_left = lo < shift
            return np.clip(np.where(in_left, np.searchsorted(left, pivot), np.searchsorted(right, pivot) + shift), lo, hi)

        am, bm = split(a0, a1), split(b0, b1)
        kids = np.concatenate([
            np.stack([a0, am, b0, bm], 1), np.stack([am, a1, bm, b1], 1),
            np.stack([a0, am, bm, b1], 1), np.stack([am, a1, b0, bm], 1)[~same]])
        kids = kids[(kids[:, 0] < kids[:, 1]) & (kids[:, 2] < kids[:, 3])]
        above = np.uint64(63 - depth)
        apart = _bits((keys[kids[:, 0]] ^ keys[kids[:, 2]]) >> above)
        kids = kids[apart <= budgets[depth + 1]]
        if len(kids):
            stack.append((depth + 1, kids))
    joined = np.flatnonzero(forest.root != np.arange(n))
    return np.stack([keys[joined], keys[forest.root[joined]]])


def _budgets(half: int, total: int) -> np.ndarray:
    return np.array([half] * 33 + [total] * 32, np.int64)


def _walk_pairs(batches: Iterator[pa.RecordBatch], half: int, total: int, swap: bool) -> Iterator[pa.RecordBatch]:
    budgets = _budgets(half, total)
    sign = np.uint64(1 << 63)

    def keys(values: np.ndarray) -> np.ndarray:
        return np.sort(np.asarray(values, np.int64).view(np.uint64) ^ sign)

    for batch in batches:
        for a, b in zip(batch.column(0), batch.column(1)):
            right = keys(b.values.to_numpy()) if b.is_valid else None
            edges = walk(keys(a.values.to_numpy()), right, budgets)
            if swap:
                edges = (edges << np.uint64(32)) | (edges >> np.uint64(32))
            edges = edges.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(edges[0]), pa.array(edges[1])], names=["u", "v"])


def _prefix(depth: int):
    """First ``depth`` bits of the sign-flipped key, so that prefixes order as the unsigned keys do."""
    return F.shiftrightunsigned(F.col("key"), 64 - depth) if depth else F.lit(0).cast("long")


def _masks(depth: int, budget: int) -> list[int]:
    """All values of ``depth`` bits with at most ``budget`` ones."""
    found = [0]
    grown = [(0, 0)]
    for _ in range(budget):
        grown = [(m | 1 << i, i + 1) for m, at in grown for i in range(at, depth)]
        found += [m for m, _ in grown]
    return found


def _trie_links(keys: DataFrame, n: int, half: int, total: int, swap: bool, leaf: int, target: int) -> DataFrame:
    """Forest edges (in fingerprints) of one trie; ``keys``: written table of distinct ``key`` longs."""
    depth = min(30, max(0, math.ceil(math.log2(max(n, 1) / target))))
    hot = None
    parts = []
    while True:
        nodes = keys.select(_prefix(depth).alias("p"), "key")
        counts = nodes.groupBy("p").agg(F.count(F.lit(1)).alias("n"))
        budget = half if depth <= 32 else total
        left, right = counts.select(F.col("p").alias("a"), F.col("n").alias("na")), counts.select(F.col("p").alias("b"), F.col("n").alias("nb"))
        if hot is None:
            masks = F.array(*[F.lit(m).cast("long") for m in _masks(depth, budget)])
            cand = left.select("a", "na", F.explode(masks).alias("m")).withColumn("b", F.col("a").bitwiseXOR(F.col("m"))).drop("m")
        else:
            kids = F.array(*[F.lit(k).cast("long") for k in range(1 << STEP)])
            cand = (hot.select(F.explode(F.transform(kids, lambda k: F.shiftleft("a", STEP) + k)).alias("a"), "b")
                    .select("a", F.explode(F.transform(kids, lambda k: F.shiftleft("b", STEP) + k)).alias("b"))
                    .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= budget).join(left, "a"))
        pairs = cand.where("a <= b").join(right, "b").select("a", "b", "na", "nb")
        pairs, n_pairs = materialize_counted(pairs, "trie-pairs")
        done = F.expr(f"IF(a = b, na, na + nb) <= {leaf}") if depth + STEP <= 62 else F.lit(True)
        ready = pairs.where(done).select("a", "b")
        used = ready.select(F.col("a").alias("p")).unionByName(ready.select(F.col("b").alias("p"))).distinct()
        packed = materialize(nodes.join(used, "p", "left_semi").groupBy("p").agg(F.collect_list("key").alias("keys")), "trie-nodes")
        # A pair of a node with itself needs the array once; tasks then walk it against itself.
        dealt = (ready.join(packed.select(F.col("p").alias("a"), F.col("keys").alias("ka")), "a")
                 .join(packed.select(F.col("p").alias("b"), F.col("keys").alias("kb")), "b")
                 .select("ka", F.when(F.col("a") != F.col("b"), F.col("kb")).alias("kb")))
        # A fixed number of tasks: the arrays are small for the work they cause, so sizes must not merge tasks.
        tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        parts.append(map_arrow(
            dealt.repartition(tasks, F.xxhash64("ka"), F.xxhash64("kb")),
            lambda it: _walk_pairs(it, half, total, swap), "u long, v long"))
        if depth + STEP > 62:
            break
        hot = pairs.where(~done).select("a", "b")
        if hot.isEmpty():
            break
        depth += STEP
    links = parts[0]
    for more in parts[1:]:
        links = links.unionByName(more)
    return links


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, leaf: int = LEAF, target: int = NODE_TARGET) -> DataFrame:
    """Links (u, v) that connect exactly the distinct ``fp`` values within ``max_bits`` bits, transitively."""
    if not 0 <= max_bits <= 31:
        raise ValueError("max_bits must be from 0 to 31")
    flip = F.lit(-(1 << 63)).cast("long")
    high, low = max_bits // 2, max_bits - max_bits // 2 - 1
    keys, n = materialize_counted(fps.select(F.col("fp").bitwiseXOR(flip).alias("key")).distinct(), "trie-keys")
    links = _trie_links(keys, n, high, max_bits, False, leaf, target)
    if low >= 0:
        turned = F.col("key").bitwiseXOR(flip)
        other = keys.select(F.shiftleft(turned, 32).bitwiseOR(F.shiftrightunsigned(turned, 32)).bitwiseXOR(flip).alias("key"))
        links = links.unionByName(_trie_links(other, n, low, max_bits, True, leaf, target))
    return links


def classes(fps: DataFrame, id_col: str, max_bits: int = MAX_BITS, leaf: int = LEAF, target: int = NODE_TARGET) -> DataFrame:
    """``fp, component_id`` for each distinct ``fp`` of ``fps``: smallest non-null id in its component."""
    least = materialize(fps.groupBy("fp").agg(F.min(id_col).alias("least")), "fingerprint-ids")
    roots = components(near_links(least, max_bits, leaf, target))
    placed = least.join(roots, least["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    placed = materialize(placed, "fingerprint-roots")
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(smallest, "root").select("fp", "component_id")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document row: id, ``fp`` and ``component_id``.

    Null or empty text has fingerprint zero and links like any other; repeated rows stay repeated; a null id
    never names a component (a component of null ids only has a null id); an empty table gives no rows. Other
    columns of ``docs`` are not read.
    """
    rows = fingerprints(docs.select(id_col, text_col), text_col, shingle_words, keep=[id_col])
    rows = materialize(rows, "fingerprints")
    return rows.join(classes(rows, id_col, max_bits), "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, broadcast_rows: int = 1_000_000) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id (nulls last; of equal ids any one).

    Rows get a written row number, so repeated and null ids are told apart. Rows to be removed are taken out by
    an anti-join that broadcasts their numbers only up to ``broadcast_rows`` of them (8 bytes each, counted while
    they are written); beyond it the join shuffles.
    """
    uid, fp = "__row", "fp"
    cols = docs.columns
    numbered = fingerprints(docs.toDF(*[f"c{i}" for i in range(len(cols))]), f"c{cols.index(text_col)}", shingle_words)
    numbered = materialize(numbered.withColumn(uid, F.monotonically_increasing_id()), "numbered")
    ids = numbered.select(uid, fp, F.col(f"c{cols.index(id_col)}").alias("id"))
    least = materialize(ids.groupBy(fp).agg(F.min(F.struct(F.col("id").isNull(), "id", uid)).alias("least")), "fingerprint-ids")
    roots = components(near_links(least, max_bits))
    placed = least.join(roots, least[fp] == roots["node"], "left").select("least", F.coalesce("root", fp).alias("root"))
    kept = placed.groupBy("root").agg(F.min("least").alias("least")).select(F.col(f"least.{uid}").alias(uid))
    gone, n = materialize_counted(ids.select(uid).join(kept, uid, "left_anti"), "removed")
    left = numbered.join(F.broadcast(gone) if n <= broadcast_rows else gone, uid, "left_anti")
    return left.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)])
