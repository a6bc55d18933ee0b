"""Centroid dictionaries, fill-in-middle cuts and license diagonals against brute force, and odd rows."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from flightlake.llm import centroids, fim, licenses


# --- centroid clustering -----------------------------------------------------------------------------------------

def plain_kmeans(rows, k, rounds, dims, seed):
    """(id, vector) rows, every distance in Python integers."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(max(-centroids.LIMIT, min(centroids.LIMIT, x * 256))) for x in v]))
    name = {id(r): hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest() for r in kept}
    centres = [list(r[1]) for r in sorted(kept, key=lambda r: (name[id(r)], r[1]))[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for j in range(len(centres)):
            members = [v for (_, v), (_, c) in zip(kept, own) if c == j]
            if members:
                centres[j] = [sum(x) // len(members) for x in zip(*members)]
    own = assign()
    whole = sum(d for d, _ in own)
    out = []
    for (i, _), (d, c) in zip(kept, own):
        inertia = sum(e for e, f in own if f == c)
        sha = hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()
        out.append((i, c, d, inertia if inertia < 1 << 63 else None, whole if whole < 1 << 63 else None, sha))
    return sorted(out, key=repr)


def clustered(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, cluster string")
    return sorted((tuple(r) for r in centroids.cluster(df, **options).collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"entries": 0}, {"entries": 30}, {"width": 1}, {"dims": 5}])
def test_clusters_equal_plain_kmeans(spark, options):
    rng = random.Random(7)
    dims = options.get("dims", 6)
    f32 = lambda x: float(np.float32(x))
    rows = [(i, [f32(rng.gauss(rng.choice([-1, 0, 2]), 0.2)) for _ in range(dims)]) for i in range(150)]
    rows += [rows[3]] * 4 + [(900 + i, rows[5][1]) for i in range(20)]           # repeated rows, equal vectors
    rows += [(None, rows[8][1]), (None, None), (901, []), (902, rows[2][1][:-1]), (903, rows[2][1] + [0.0])]
    rows += [(904, [float("nan")] + rows[1][1][1:]), (905, [float("inf")] + rows[1][1][1:]), (906, [None] + rows[1][1][1:])]
    rows += [(907, [3e30] + rows[1][1][1:]), (908, [-3e30] * dims)]
    got = clustered(spark, rows, k=9, rounds=3, **{"dims": dims, "seed": 2} | options)
    assert got == plain_kmeans(rows, 9, 3, dims, 2)


def test_clusters_of_few_equal_and_no_vectors(spark):
    same = [(i, [0.5, -0.5]) for i in range(5)]
    got = clustered(spark, same, k=4, rounds=2, dims=2)
    assert got == plain_kmeans(same, 4, 2, 2, 2) and {r[1] for r in got} == {0}  # ties go to the smaller number
    assert clustered(spark, same[:2], k=40, dims=2) == plain_kmeans(same[:2], 40, 5, 2, 2)
    assert clustered(spark, [], dims=2) == [] and clustered(spark, [(1, None)], dims=2) == []


def test_dictionary_is_bounded_and_keeps_the_commonest(spark):
    rows = [(i, [1.0 if i % 3 else float(i), float(i)]) for i in range(60)]
    vectors = centroids.integer_vectors(spark.createDataFrame(rows, "a long, b array<double>"), "a", "b", 2)
    own = centroids.build_dictionary(vectors, 2, 1, 10)
    assert own.keys[:own.starts[1]].tolist() == [256] and len(own.keys) <= 10
    whole = centroids.build_dictionary(vectors, 2, 1, 10_000)
    assert len(whole.keys) == len({r[1][0] for r in rows}) + 60
    keys = np.array([[256, 512], [7, 512]])
    assert (whole.encode(keys) >= 0).tolist() == [[True, True], [False, True]]


# --- fill-in-middle -----------------------------------------------------------------------------------------------

def plain_fim(doc_id, text, seed=1):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, flags=re.S)
    s = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(s[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, t = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{t}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{t}<M>{m}"


ODD = [None, "", "a", "é", "𝄞", "ab", "a1b2", "<", "<P", "x<P>y", "a<S>", "<M>", "Ünïcode wörds 中文字 abc", "A" * 4099, "é" * 4099,
       "\x00\x00ab\x00", "a b\nc\td  e", "[Zz]@`{az}", "\x7f\x80\xff", "𝄞a𝄞bc", "abcdefgh", "abcdefghi", "1234567", "12345678", "<<P><S<S", "K", "ſ"]


def test_fill_in_middle_equals_the_split_text(spark):
    rng = random.Random(3)
    alphabet = "abZ é𝄞1 \n<PSM>中"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 90))) for _ in range(300)] + ["word é " * 200_000]
    rows = [(None if i % 41 == 7 else i, t, "kept", 1) for i, t in enumerate(texts)] + [(5, "twice x", "kept", 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, FORM string, fim_h1 int")
    got = fim.fill_in_middle(docs).withColumn("back", fim.restored()).collect()
    assert got[0].asDict().keys() == {"doc_id", "text", "fim_h1", "n", "form", "prefix_chars", "middle_chars", "output", "back"}
    want = sorted(((i, t, *plain_fim(i, t)) for i, t, _, _ in rows), key=repr)
    assert sorted(((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=repr) == want
    assert all(r.back == (r.text or "") for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(docs.limit(0)).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abZ1 <é𝄞\x00"), st.characters(codec="utf-8")), max_size=40), min_size=1, max_size=5),
       st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1))
def test_cut_points_of_any_text(texts, h1, h2):
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    sizes = [len(t.encode()) for t in texts]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    found = fim.cut_points(raw, offsets, np.full(len(texts), h1), np.full(len(texts), h2))
    for t, n, one, two, chars_one, chars_two in zip(texts, *found):
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", t, flags=re.S)
        a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
        assert n == len(units)
        assert (one, two) == tuple(len("".join(units[:x]).encode()) for x in (a, b))
        assert (chars_one, chars_two) == tuple(len("".join(units[:x])) for x in (a, b))


# --- license scan -------------------------------------------------------------------------------------------------

def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_base(text):
    own, found = plain_words(text), []
    for label, phrase in (("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"), ("mit", "mit license")):
        want = phrase.split()
        found += [(i, label) for i in range(len(own)) if own[i:i + len(want)] == want]
    return (len(own), len(found), min((i for i, _ in found), default=None), max((i for i, _ in found), default=None),
            ",".join(sorted({label for _, label in found})))


MIT = next(t.text for t in licenses.TEMPLATES if t.label == "mit" and not t.base)
GPL, LGPL, AGPL = (next(t.text for t in licenses.TEMPLATES if t.label == x and t.key) for x in ("gpl", "lgpl", "agpl"))


def test_scan_counts_every_place_of_a_phrase(spark):
    rng = random.Random(5)
    pieces = ["GNU", "general", "Public", "license", "Apache", "apache license", "cc", "BY", "cc-by", "MIT", "MIT License", "x", "é", "É", "1", ".",
              "\n", "gnu general public license", "CC BY"]
    texts = [None, "", " ", "...", "mit", "mit license", "MIT-LICENSE", "mit\x00license", "mítlicense", "mit licenseé", "Kc by", "CC BY " * 3000,
             "w " * 1023 + "mit license" + " w" * 1022 + " gnu general public license", "mit mit license license"]
    texts += [" ".join(rng.choice(pieces) for _ in range(rng.randint(1, 40))) for _ in range(200)]
    rows = [(None if i % 37 == 5 else i, t, "gpl") for i, t in enumerate(texts)]
    rows += [(1, "mit license", "gpl")] * 3 + [(1, "apache license", "mit")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(docs).collect()), key=repr)
    assert got == sorted(((i, *plain_base(t)) for i, t, _ in rows), key=repr)
    assert licenses.scan(docs.limit(0)).collect() == []


def test_scan_finds_changed_notices_and_leaves_prose_alone(spark):
    mit = MIT.split()
    edits = {"whole": MIT, "wrapped": "/*\n * " + "\n * ".join(" ".join(mit[i:i + 9]) for i in range(0, len(mit), 9)) + "\n */",
             "put in": " ".join(mit[:20] + ["by", "Example", "Corp"] + mit[20:]), "left out": " ".join(mit[:30] + mit[33:]),
             "changed": " ".join(mit[:25] + ["other"] + mit[26:])}
    docs = [(name, "Some code. " * 300 + t + " More code." * 50) for name, t in edits.items()]
    docs += [("half", " ".join(mit[:len(mit) // 2])), ("prose", "The permission of the owner is granted to any person of the town. " * 40),
             ("shuffled", " ".join(random.Random(1).sample(mit, len(mit)))), ("gpl", GPL), ("lgpl", LGPL), ("agpl", AGPL), ("two", MIT + " word " * 60 + MIT)]
    frame = spark.createDataFrame(docs, "doc_id string, text string")
    got = {r.doc_id: r for r in licenses.scan(frame).collect()}
    for name in [*edits, "two"]:
        assert got[name].labels == "mit" and got[name].n_base == 0 and got[name].score >= 0.8, name
    assert got["whole"].score == 1.0 and got["put in"].score < 1.0
    assert [(got[n].labels, got[n].score) for n in ("half", "prose", "shuffled")] == [("", 0.0)] * 3
    assert (got["gpl"].labels, got["gpl"].base_labels, got["gpl"].n_base) == ("gpl", "gpl", 1)
    assert (got["lgpl"].labels, got["agpl"].labels) == ("lgpl", "agpl")
    spans = licenses.license_spans(frame)
    starts = sorted((r.doc_id, r.first_word) for r in spans.where("label = 'mit'").collect())
    size = len(plain_words(MIT))
    assert [s for n, s in starts if n == "two"] == [0, size + 60] and ("whole", 600) in starts


def test_scan_joins_hashes_without_python_and_with_templates_of_your_own(spark):
    own = [licenses.Template("house", "house rules apply", base=True), licenses.Template("a", "one two")]
    docs = spark.createDataFrame([(1, "House rules apply. one, two")], "doc_id long, text string")
    row = licenses.scan(docs, own).collect()[0]
    assert (row.n_base, row.base_labels, row.labels, row.first_word, row.last_word) == (1, "house", "a,house", 0, 0)
    with pytest.raises(ValueError):
        licenses.scan(docs, [licenses.Template("one", "single")])
    plan = licenses.scan(docs, own)._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan
