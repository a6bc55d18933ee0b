"""Language profiles, toxicity, quality forest and the HTML tree: accuracy on held-out rows and odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flightlake.llm import html_tree, langid, quality_forest, queries, toxicity
from flightlake.llm.common import CHUNK_BYTES, add_columns, chunks, span_hashes, spans, utf8_buffer

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_chunks_and_spans():
    column = pa.array(["a b", None, "", "x" * (CHUNK_BYTES + 1), "yy"])
    parts = list(chunks(column))
    assert sum(map(len, parts)) == 5 and [x for p in parts for x in p.to_pylist()] == column.to_pylist()
    raw, offsets = utf8_buffer(pa.array(["ab ab", "ab", None, "", " "]))
    starts, ends, row = spans(raw != 32, offsets)
    assert list(zip(starts, ends, row)) == [(0, 2, 0), (3, 5, 0), (5, 7, 1)]
    assert len(set(span_hashes(raw, starts, ends).tolist())) == 1


def test_language_held_out_accuracy(spark):
    got = queries.q_language(spark, SF01).toPandas()
    truth = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(truth, on="doc_id")
    held = both[both["held_out"]]
    assert len(got) == len(truth) and (held["lang"] == held["lang_pred"]).mean() > 0.98
    assert got["score"].between(0, 1).all()
    assert (both["held_out"] == both["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()


def test_language_vectors_match_the_definition():
    text, n, dims = "Ab, ba!", 3, 64
    grams = [" ab", "ab ", "b b", " ba", "ba "]
    expected = sum(np.roll(langid.letter_vector(ord(g[0]), dims, 7), 2) * np.roll(langid.letter_vector(ord(g[1]), dims, 7), 1)
                   * langid.letter_vector(ord(g[2]), dims, 7) for g in grams)
    got = langid.bundle([text, "", None, "12!"], dims, n, 7)
    assert (got[0] == expected).all() and not got[1:].any()


def test_language_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "", None), (5, "12 !!", "de"), (None, "the dog", None),
            (6, "the " * 60_000, None)]
    docs = spark.createDataFrame([(*r, "keep") for r in rows], "doc_id long, text string, lang string, score string")
    profiles = langid.fit(docs)
    assert profiles.langs == ["de", "en"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(docs, profiles).collect()}
    assert [got[i][0] for i in (1, 2, 3, 4, 5, 6, None)] == ["en", "de", "und", "und", "und", "en", "en"]
    left = langid.drop_unidentified(docs, profiles)
    assert left.columns == docs.columns and sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 1, 2, 6]
    assert {r["score"] for r in left.collect()} == {"keep"}
    none = langid.fit(docs.limit(0))
    assert none.langs == [] and {r["lang_pred"] for r in langid.identify(docs, none).collect()} == {"und"}
    assert langid.identify(docs.limit(0), profiles).count() == 0


FOREIGN = {
    "ru": "кошка спит на коврике а на улице идёт дождь завтра мы пойдём рынок купить хлеб сыр детям завтрак потом школу",
    "el": "η γάτα κοιμάται στο χαλί ενώ έξω βρέχει στην πόλη αύριο θα πάμε αγορά για να αγοράσουμε ψωμί και τυρί",
    "zh": "猫在垫子上 睡觉 外面正在下雨 明天我们 去市场 买面包 和奶酪 给孩子们 做早餐 然后去学校",
    "tr": "kedi halının üzerinde uyuyor ve dışarıda yağmur yağıyor yarın çocukların kahvaltısı için ekmek peynir almak üzere pazara gideceğiz",
    "pl": "kot śpi na macie a za oknem pada deszcz jutro pójdziemy targ żeby kupić chleb ser śniadanie dla dzieci które lubią bawić się"}


def test_language_unlike_texts_go_and_clean_ones_stay(spark):
    rng = random.Random(3)
    unlike = [" ".join(rng.choices(words.split(), k=k)) for words in FOREIGN.values() for k in (40, 100, 300) for _ in range(15)]
    unlike += [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(k)) for k in (40, 100, 300) for _ in range(15)]
    unlike += [" ".join(f"{rng.getrandbits(64):016x}" for _ in range(k)) for k in (40, 100, 300) for _ in range(15)]
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang")
    profiles = langid.fit(docs)
    made = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(unlike)], docs.schema)
    left = [r["doc_id"] for r in langid.drop_unidentified(docs.unionByName(made), profiles).collect()]
    assert sum(i < 0 for i in left) <= 0.02 * len(unlike) and sum(i >= 0 for i in left) == docs.count()


def insults(n, seed=2):
    rng = random.Random(seed)
    common = [f"word{i}" for i in range(300)]
    bad = [f"{stem}{end}" for stem in ("rotten", "vile") for end in ("", "er", "est", "ly", "ness")]
    rows = []
    for i in range(n):
        words = [rng.choice(common) + rng.choice(["", ",", "."]) for _ in range(rng.randint(20, 200))]
        toxic = int(i % 5 == 0)
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(bad).upper()
        rows.append((i, " ".join(words), toxic))
    return rows


def test_toxicity_held_out(spark):
    rows = insults(700)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    train = spark.createDataFrame([(i, y) for i, _, y in rows if i % 7], "doc_id long, toxic int")
    model = toxicity.fit(docs, train)
    assert 0 < len(model.at) < 2_000
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    held = [(got[i] >= 0.5) == bool(y) for i, _, y in rows if i % 7 == 0]
    assert np.mean(held) > 0.97
    again = toxicity.fit(docs.repartition(5), train.repartition(3))
    assert (again.at == model.at).all() and np.allclose(again.value, model.value)


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 0.3), (2, "", 0.3), (None, "rotten", 0.3), (3, "rotten " * 50_000, 0.3)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, None), (None, 1), (9, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert [r["score"] for r in got] == [0.5] * 4  # no labelled row, nothing learned
    assert toxicity.score(docs.limit(0), model).count() == 0


def brute_statistics(text):
    import re
    from collections import Counter

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered.update(range(i, i + 5))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)]


def test_statistics_match_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", "\n\n", "a", "a\na\n a\na ", "é ü x", "#*$%&|<> ##"]
    texts += ["".join(rng.choice(["a ", "b ", "é\t", "c\n", "\r\n", "| ", "  "]) for _ in range(rng.randint(1, 120))) for _ in range(300)]
    texts += ["x y z " * 30_000]
    stats = quality_forest.statistics(pa.array(texts))
    assert [[int(stats[k][i]) for k in quality_forest.BASE] for i in range(len(texts))] == [brute_statistics(t) for t in texts]


def test_quality_query(spark):
    got = queries.q_quality(spark, SF01).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SF01}/documents.parquet").toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{SF01}/labels.parquet").toPandas().set_index("doc_id")
    assert all(got.loc[i, quality_forest.BASE].astype(int).tolist() == brute_statistics(t) for i, t in docs["text"].items())
    failed = (got["n_words"] < 10) | (100 * got["n_repeat_words"] > 20 * got["n_words"])
    assert (failed == got["base_failed"]).all() and not got.loc[failed, "kept"].any()
    known = got[~failed].join(labels, how="inner")
    assert known[known["quality"] == 1]["kept"].mean() > 0.98 and known[known["quality"] == 0]["kept"].mean() < 0.1


def test_quality_words_of_odd_length(spark):
    rng = random.Random(8)
    odd = [" ".join("".join(rng.choices("abcdefghijklmnop", k=chars)) for _ in range(words))
           for chars, words in ((1, 80), (1, 400), (40, 30), (40, 300), (64, 60), (200, 20))]
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    model = quality_forest.fit(docs, spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", "quality"))
    made = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    assert [(r["base_failed"], r["kept"]) for r in quality_forest.judge(made, model).collect()] == [(False, False)] * len(odd)


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "a b c d e f g h i j k", 1)], "doc_id long, text string, kept int")
    model = quality_forest.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    got = quality_forest.judge(docs, model).collect()
    assert sorted((r["base_failed"], r["kept"]) for r in got) == [(False, True), (True, False), (True, False)]
    assert quality_forest.judge(docs.limit(0), model).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>if (a < b) x("</p>");</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/a">Menu</a><li><a href="/b">More</a></ul></nav>
<div class="cookie-notice">We use cookies.</div><div class="ad">Buy now!</div><%s>
<h1>Title &amp; more</h1><p>First   paragraph
of the text, with <a href="#">a link</a> in it.<p>Second &lt;one&gt;, open tag <b>bold<br>broken.
<form><input name=q>Search here</form><div class="comments"><p>Great article, thanks!</p></div></%s>
<aside>Related stories</aside><footer>&copy; 2024</footer></body></html>"""
MAIN = "Title & more First paragraph of the text, with a link in it. Second <one>, open tag bold broken."


@pytest.fixture(scope="module")
def tree(spark):
    return html_tree.fit(spark.read.parquet(f"{SF01}/pages.parquet"))


@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_html_main_text(tree, tag):
    assert tree.extract(PAGE % (tag, tag))[0] == MAIN


TOPICS = """<html><body><nav><a href="/">Home</a></nav><%s><h1 id="top">On forums</h1>
<section id="discussion"><h2 id="input-and-output">Input and output</h2><p id="search">The program reads its input, and then writes.</p></section>
<h3 id="related-work">Related work</h3><p class="more">Earlier authors have said much more, in longer books.</p>
<div class="warning">Mind the step, it is high.</div><section id="message-format"><h2 class="feedback">The format</h2><p>Messages have a head, and a body.</p></section>
<div id="feedback"><p>Loops feed back, as amplifiers do.</p></div>
<p class="more"><a href="/x">Read more of this</a></p><div class="related-posts"><a href="/a">Ten tricks</a> <a href="/b">Nine tips</a></div>
<div id="search"><input name="q">Find it</div><div class="discussion"><p>Nice one, thanks a lot.</p></div><p class="ad">Buy now!</p>
</%s><footer>Imprint</footer></body></html>"""
TOPICS_MAIN = """On forums Input and output The program reads its input, and then writes. Related work Earlier authors have said much more, in longer books.
Mind the step, it is high. The format Messages have a head, and a body. Loops feed back, as amplifiers do.""".replace("\n", " ")


@pytest.mark.parametrize("tag", ["article", "main"])
def test_html_article_parts_named_by_their_topic(tree, tag):
    assert tree.extract(TOPICS % (tag, tag))[0] == TOPICS_MAIN
    assert html_tree.prior_model().extract(TOPICS % (tag, tag))[0] == TOPICS_MAIN
    page = html_tree.parse(TOPICS % (tag, tag))
    leaves, _ = html_tree.leaf_features(page)
    assert [page.text[i] for i, y in zip(leaves, html_tree.leaf_labels(page, leaves)) if y] == [page.text[i] for i in leaves if page.text[i] in TOPICS_MAIN]


GOOD = """<h1>On rivers</h1><p>A river runs to the sea, and takes its time about it. It is old, and it is never the same.</p>
<p>In spring it rises, in summer it falls; the mills know it, and so do the fish.</p>"""
GOOD_MAIN = """On rivers A river runs to the sea, and takes its time about it. It is old, and it is never the same.
In spring it rises, in summer it falls; the mills know it, and so do the fish.""".replace("\n", " ")
PARTS = """<div class="comments"><p>Nice piece, thanks a lot for it.</p></div><div class="sidebar"><p>Our ten best rivers, in order.</p></div>
<form action="/s"><label>Search the site</label><input name="q"></form>"""
WRAPPERS = [
    ('<form id="aspnetForm">', "</form>"), ('<form id="aspnetForm"><article>', "</article></form>"),
    ('<div class="layout has-sidebar"><article>', "</article></div>"), ('<div class="content-with-sidebar"><main>', "</main></div>"),
    ('<div class="page no-sidebar">', "</div>"), ('<div id="app" class="nav-open"><main>', "</main></div>"),
    ('<article class="post comments-open">', "</article>"), ('<div class="single comment-status-open"><article>', "</article></div>"),
    ('<div role="main" class="widget-area-none">', "</div>"), ('<main class="no-sidebar"><article class="post comments-open">', "</article></main>"),
    ('<div class="menu-closed"><div class="cookie-banner-off">', "</div></div>")]


@pytest.mark.parametrize("opened, closed", WRAPPERS)
@pytest.mark.parametrize("inside", [False, True])
def test_html_article_stays_whatever_wraps_it(tree, opened, closed, inside):
    if inside:  # the real parts stand in the wrapper, beside the article
        page = f"<html><body><nav><a href='/'>Home</a></nav>{opened}{GOOD}{PARTS}{closed}<footer>Imprint</footer></body></html>"
    else:
        page = f"<html><body><nav><a href='/'>Home</a></nav>{opened}{GOOD}{closed}{PARTS}<footer>Imprint</footer></body></html>"
    assert tree.extract(page)[0] == GOOD_MAIN


def test_html_parts_that_hold_most_of_the_text_stay_parts(tree):
    talk = "".join(f"<article class='comment'><p>I think, as number {i}, that it is so and not so.</p></article>" for i in range(40))
    for box in (f"<div id='comments' class='comments'>{talk}</div>", f"<section class='comment-list'>{talk}</section>",
                f"<aside>{talk}</aside>", f"<div class='sidebar'>{talk}</div>"):
        for opened, closed in (("<article>", "</article>"), ("<main>", "</main>")):
            assert tree.extract(f"<body>{opened}{GOOD}{closed}{box}</body>")[0] == GOOD_MAIN
            assert tree.extract(f"<body>{opened}{GOOD}{box}{closed}</body>")[0] == GOOD_MAIN


def test_html_empty_comments_and_formulas(tree):
    page = "<article><p>First, as it was.<!--><b>Second</b>, too.<!---> Third, and <!-- gone --!>last.</p><p>Where <math><mi>x</mi><mo>=</mo><mn>2</mn></math>, it holds.</p></article>"
    assert tree.extract(page)[0] == "First, as it was.Second, too. Third, and last. Where x=2, it holds."


def test_html_sentence_marks_of_the_whole_block():
    text = "It began well, they said. Then it ended. All went home. " + "alpha beta " * 60
    leaves, rows = html_tree.leaf_features(html_tree.parse(f"<p>{text}</p>"))
    assert rows[0, html_tree.FEATURES.index("sentence_marks")] == 1.0


def test_html_given_pages(spark, tree):
    import html as h
    import re

    pages = spark.read.parquet(f"{SF01}/pages.parquet").toPandas()
    got = html_tree.extract(spark.read.parquet(f"{SF01}/pages.parquet"), tree, keep=["page_id"]).toPandas().set_index("page_id")
    for row in pages.itertuples():
        inner = re.search(r"<article>(.*?)(</article>|$)", row.html, re.S)[1]
        want = " ".join(h.unescape(re.sub(r"</?b>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", inner))).split())
        assert got.loc[row.page_id, "text"] == want and got.loc[row.page_id, "n_chars"] == len(want)


def brute_marginals(model, page, leaves, rows):
    n, total = len(page.parent), np.zeros(2)
    score = dict(zip(leaves, rows @ model.weights))
    mass = np.zeros((n, 2))
    for state in range(1 << n):
        y = [state >> i & 1 for i in range(n)]
        s = sum(score.get(i, 0.0) * y[i] for i in range(n)) + sum(
            model.tie[int(page.text[i] is not None)][y[page.parent[i]]][y[i]] for i in range(1, n))
        total[0] += np.exp(s)
        for i in range(n):
            mass[i, y[i]] += np.exp(s)
    return [mass[i, 1] / total[0] for i in leaves]


def test_sum_product_matches_enumeration(tree):
    page = html_tree.parse("<div>a<p>Some text here.</p><ul><li><a>x</a></ul><section>tail, more.<p>end</p></section></div>")
    leaves, rows = html_tree.leaf_features(page)
    model = html_tree.TreeModel(tree.weights, np.array([[[0.3, -0.4], [-0.2, 0.5]], [[0.7, -1.0], [-0.6, 0.9]]]))
    assert np.allclose(model.marginals(page, leaves, rows), brute_marginals(model, page, leaves, rows))


def test_html_odd_pages(spark, tree):
    deep = "<div>" * 5_000 + "Deep text, in the end." + "</div>" * 10
    assert tree.extract("<article><p>Whole text, in the end. <a href='x")[0] == "Whole text, in the end."
    assert tree.extract("<article><p>One is < two, and so on.")[0] == "One is < two, and so on."
    for page in ("<a " * 200_000, "<p>x" + "<button>" * 50_000, "<!--" * 50_000, "<p '" * 50_000 + ">", "</" * 100_000 + ">"):
        assert isinstance(tree.extract(page)[0], str)  # in time that grows with the page, not with its square
    for page in (None, "", "   ", "<", "<p", "</p></div>", "<a href='x", "<!-- open", "<script>x", deep, "plain words only"):
        assert isinstance(tree.extract(page)[0], str)
    docs = spark.createDataFrame([(1, "u", None, "t"), (None, None, "", "t"), (1, "u", "<article><p>Hello there, you.</p></article>", "t")],
                                 "page_id long, url string, html string, text string")
    got = html_tree.extract(docs, tree, keep=["page_id", "url"]).collect()
    assert [(r["text"], r["n_chars"]) for r in got] == [("", 0), ("", 0), ("Hello there, you.", 17)]
    assert html_tree.extract(docs.limit(0), tree).count() == 0
    prior = html_tree.fit(docs.limit(0))
    assert prior.extract(PAGE % ("article", "article"))[0] == MAIN


def test_add_columns_replaces_clashing_names(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "text string, Size int")
    out = add_columns(df, ["text"], [("size", "long")], lambda t: [[len(x or "") for x in t.to_pylist()]])
    assert [tuple(r) for r in out.collect()] == [("a", 1), (None, 0)] and out.columns == ["text", "size"]
