"""Main-text extraction with a tree-structured graphical model over DOM nodes.

A page becomes a tree of its block elements; runs of text between block boundaries are its leaves. Every node is
content or not. A node's own potential comes from features of its markup and text (logistic weights), and parent and
child are tied by a 2 x 2 table of how much likelier two labels are together than apart. Sum-product messages go up and
then down the tree and give each leaf's marginal; leaves likelier content than not are the text.

Training pages label themselves: on pages that mark their article (``article`` or ``main``) the leaves inside it, but not
in parts of it named as something else, are content. On half of these pages the marks are hidden from the features, so
that the other weights learn to do without them. Weights keep close to prior means for the names of page parts
(``nav``, ``aside``, class names such as comments or sidebar), so parts that no training page has are still told apart.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flightlake.llm.common import add_columns, in_share, map_arrow

# Expected training pages, the most leaves of a page kept for training, and gradient steps.
TRAIN_PAGES, TRAIN_LEAVES, STEPS, RIDGE = 2_000, 400, 200, 0.002

# Fixed values of HTML: element names by how they are parsed.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe noframes noembed xmp textarea select svg annotation annotation-xml object audio video canvas title button datalist".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
ENDS_P = BLOCK - frozenset("body html caption dd dt li legend tbody td tfoot th thead tr".split())
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
          "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"})}

# Names of page parts in class, id and role, by kind.
NAMED = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc sitemap tabs toolbar skip",
    "header": "header masthead banner topbar branding logo",
    "footer": "footer copyright colophon legal imprint foot bottom",
    "sidebar": "sidebar aside rail widget widgets related recommended recommendations complementary trending popular teaser more",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay disclaimer toast newsletter subscribe subscription paywall message warning",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion commercial dfp adsense",
    "comment": "comment comments commentlist disqus discussion replies reply respond reviews feedback guestbook",
    "form": "form search searchbox login signup register contactform input",
    "social": "share sharing social follow like tweet facebook tags byline meta",
    "body": "article content main post entry story text body articlebody maintext prose",
}
_NAME_KIND = {name: kind for kind, names in NAMED.items() for name in names.split()}
# Names that are also words for what articles are about. Inside an article they count as a whole class or role of a container,
# or where the part is made of links or has form fields; those of ``_PROSE`` (notes to the reader) only by such structure.
_TOPIC = frozenset(
    "discussion more message input search warning related feedback response reply replies respond reviews form register login signup notice alert menu "
    "navigation pagination toc tabs legal copyright share sharing follow like tweet tags meta social subscription subscribe popular trending commercial "
    "promotion recommended recommendations header banner top foot bottom rail disclaimer overlay".split())
_PROSE = frozenset("more message input warning".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_TEXT = _HEADING | frozenset("p blockquote pre li dt dd td th caption figcaption legend summary".split())
_FIELD = frozenset("input select textarea button".split())
_TAG_KIND = {"nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "sidebar", "form": "form", "dialog": "notice", "fieldset": "form"}
KINDS = list(NAMED)
FEATURES = (["bias", "inside_marked", "outside_marked", "log_chars", "link_share", "sentence_marks", "few_words", "heading", "paragraph",
             "list_item", "cell", "plain_block", "pre", "copyright"] + [f"in_{k}" for k in KINDS])
# Prior means: what the names say (stronger than being inside an article and among its text), and a weak preference
# for text that reads like sentences.
PRIOR = {"inside_marked": 3.0, "outside_marked": -3.0, "log_chars": 0.3, "link_share": -3.0, "sentence_marks": 0.5, "paragraph": 0.5,
         "copyright": -3.0, "in_menu": -9.0, "in_header": -3.0, "in_footer": -9.0, "in_sidebar": -9.0, "in_notice": -9.0,
         "in_advert": -9.0, "in_comment": -9.0, "in_form": -9.0, "in_social": -4.0, "in_body": 1.0, "bias": -0.5}
PRIOR_VECTOR = np.array([PRIOR.get(f, 0.0) for f in FEATURES])

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_CUT_OFF = re.compile(r"<[a-zA-Z/!?]")
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[a-z]+")
_MARK = re.compile(r"[.!?;:,](?=\s|$)")


class Page:
    """Block elements and text runs of a page; a parent always comes before its children."""

    __slots__ = ("parent", "tag", "kinds", "text", "linked", "marked", "attributes", "fields")

    def __init__(self) -> None:
        self.parent: list[int] = []
        self.tag: list[str] = []
        self.kinds: list[frozenset] = []  # kinds named by this element or above it
        self.text: list[str | None] = []  # of leaves
        self.linked: list[int] = []
        self.marked: list[bool] = []  # inside article or main
        self.attributes: dict[int, str] = {}  # of block elements
        self.fields: dict[int, int] = {}  # form fields right below an element

    def add(self, parent: int, tag: str, text: str | None = None, linked: int = 0) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.kinds.append(frozenset())
        self.text.append(text)
        self.linked.append(linked)
        self.marked.append(False)
        return len(self.parent) - 1


def _parts(attributes: str, tag: str) -> Iterator[tuple[str, str, list[str]]]:
    """(attribute, value, its lower-case words) of every class, id and role word; camel case and dashes part words. Ids of headings
    and paragraphs are places to link to and name nothing."""
    for name, a, b, c in _ATTR.findall(attributes):
        name = name.lower()
        if name in ("hidden", "aria-hidden") or (name == "id" and (tag in _HEADING or tag in ("p", "blockquote"))):
            continue
        for part in re.sub(r"([a-z])([A-Z])", r"\1 \2" if name == "id" else r"\1-\2", a or b or c).lower().split():
            yield name, part, _WORDS.findall(part)


def _named(attributes: str, tag: str, inside: bool) -> tuple[set[str], set[str]]:
    """Kinds that class, id and role name, word by word, and kinds that count by structure only."""
    found, unsure = set(), set()
    for name, _, words in _parts(attributes, tag):
        whole = name != "id" and tag not in _TEXT and all(w in _NAME_KIND for w in words)
        for w in words:
            if w in _NAME_KIND:
                sure = not inside or w not in _TOPIC or (whole and w not in _PROSE)
                (found if sure else unsure).add(_NAME_KIND[w])
    return found, (set() if tag in _HEADING else unsure - found)


def _called(attributes: str, tag: str) -> set[str]:
    """Kinds that a whole class, id or role names (``comments``, ``cookie-notice``), not one word of it (``comments-open``)."""
    return {_NAME_KIND[w] for _, _, words in _parts(attributes, tag) if words and all(w in _NAME_KIND for w in words) for w in words}


def _settle(page: Page) -> None:
    """Marks and kinds of every node, from the names and from what the elements hold.

    A name or a ``form`` tag makes an element a page part only if it is not a wrapper of the article: an element that holds
    the page's main element is none, nor one that holds most of the text together with the first heading or an article. What is
    called a part as a whole (``class="comments"``) stays one however much text it has, if no such heading or article is in it. A
    name's kinds that are left open count if half of the element's text is linked or it has form fields.
    """
    n = len(page.parent)
    size, linked, fields = [len(t) if t is not None else 0 for t in page.text], page.linked.copy(), [page.fields.get(i, 0) for i in range(n)]
    names = {i: _called(a, page.tag[i]) for i, a in page.attributes.items()}
    apart = set(KINDS) - {"body", "social", "header"}
    named_main = {i for i in range(n) if (page.tag[i] in ("article", "main") or any(
        name == "role" and part in ("main", "article") for name, part, _ in _parts(page.attributes.get(i, ""), page.tag[i])))
        and not names.get(i, set()) & apart}
    holds = [page.tag[i] == "h1" or i in named_main for i in range(n)]
    for i in range(n - 1, 0, -1):  # children come after their parent
        p = page.parent[i]
        size[p], linked[p], fields[p] = size[p] + size[i], linked[p] + linked[i], fields[p] + fields[i]
        holds[p] = holds[p] or holds[i]
    best = max(named_main, key=lambda i: (size[i], -i), default=0)
    best = best if 4 * size[best] >= size[0] else 0
    around, at = set(), best
    while at > 0:
        around.add(at)
        at = page.parent[at]
    within = [False] * n
    for i in range(1, n):
        p, tag, attributes = page.parent[i], page.tag[i], page.attributes.get(i, "")
        kinds = page.kinds[p]
        if page.text[i] is not None:
            page.kinds[i], page.marked[i] = kinds, page.marked[p]
            continue
        within[i] = within[p] or i == best
        whole = size[best] if within[i] else 0 if best else size[0]
        called = names.get(i, set()) & apart or tag in _TAG_KIND and tag != "form"
        wrapper = i in around or (whole and (2 * size[i] >= whole and holds[i] or 5 * size[i] >= 4 * whole and not called))
        main = i in named_main and not kinds & {"comment", "sidebar", "advert"}
        page.marked[i] = page.marked[p] or main
        own, unsure = _named(attributes, tag, page.marked[i] and not main or "body" in kinds)
        if tag in _TAG_KIND and not (tag == "header" and page.marked[i]):
            own.add(_TAG_KIND[tag])
        if i in named_main:
            own -= {"header", "social", "notice"}
        if fields[i] or (size[i] and 2 * linked[i] >= size[i]):
            own |= unsure
        page.kinds[i] = kinds | (own & {"body"} if wrapper else own)


def parse(source: str) -> Page:
    """Tolerant of missing end tags, stray end tags, open quotes and cut-off pages."""
    page = Page()
    root = page.add(-1, "html")
    stack: list[tuple[str, int]] = [("html", root)]  # all open elements with their nearest block node
    run: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            run.clear()
            if text:
                page.add(stack[-1][1], "#text", text, min(linked, len(text)))
        linked = 0

    def close(depth: int) -> None:
        if any(tag in BLOCK for tag, _ in stack[depth:]):
            flush()
        del stack[depth:]

    def open_at(names: set[str] | frozenset, until: set[str] | frozenset = frozenset()) -> int:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                return i
            if stack[i][0] in until:
                break
        return 0

    at, links, n = 0, 0, len(source)
    last, unclosed = source.rfind(">"), set()
    while at < n:
        token = _TOKEN.search(source, at) if at <= last else None
        # After the last ">" no tag ends: what starts there like a tag is a cut-off one and no text.
        cut = _CUT_OFF.search(source, at) if not token else None
        text = source[at:token.start() if token else cut.start() if cut else n]
        if text:
            run.append(text)
            if links:
                linked += len(text)
        if not token:
            break
        at = token.end()
        end, name, attributes = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        if not name:
            continue
        tag = name.lower()
        if not end and tag in _FIELD:
            page.fields[stack[-1][1]] = page.fields.get(stack[-1][1], 0) + 1
        if not end and tag in RAW:
            closing = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at) if tag not in unclosed else None
            if not closing:
                unclosed.add(tag)  # looked for once, not at every further start tag
            if not attributes.rstrip().endswith("/") or tag not in ("svg", "math"):
                at = closing.end() if closing else (n if tag in ("script", "style", "title", "textarea") else at)
            continue
        if end:
            if tag == "a":
                links = 0
            if tag in BLOCK or tag == "a":
                depth = open_at({tag}, frozenset() if tag in BLOCK else BLOCK)
                if depth:
                    close(depth)
            continue
        if tag == "br":
            run.append(" ")
            continue
        if tag not in BLOCK:
            if tag == "a":
                links = 1
            elif tag in VOID:
                continue
            continue
        flush()
        links = 0
        if tag in ENDS_P and (depth := open_at({"p"}, {"td", "th", "table", "body", "div", "article", "section", "main", "li", "dd", "blockquote"})):
            close(depth)
        if tag in CLOSES:
            ends, until = CLOSES[tag]
            first = 0
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in until:
                    break
                if stack[i][0] in ends:
                    first = i
            if first:
                close(first)
        if tag in ("hr", "html", "body"):
            continue
        stack.append((tag, page.add(stack[-1][1], tag)))
        if attributes:
            page.attributes[stack[-1][1]] = attributes
    flush()
    _settle(page)
    return page


def leaf_features(page: Page, hide_marks: bool = False) -> tuple[list[int], np.ndarray]:
    """Leaves in page order and their feature rows."""
    leaves = [i for i, t in enumerate(page.text) if t is not None]
    out = np.zeros((len(leaves), len(FEATURES)))
    known = any(page.marked) and not hide_marks
    for row, i in enumerate(leaves):
        text, tag = page.text[i], page.tag[page.parent[i]]
        words = text.count(" ") + 1
        out[row, :14] = (
            1.0, known and page.marked[i], known and not page.marked[i], min(math.log1p(len(text)), 7.0) / 2, page.linked[i] / len(text),
            min(len(_MARK.findall(text)), 4) / 4, words < 4, tag in ("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"),
            tag in ("p", "blockquote"), tag in ("li", "dd", "dt"), tag in ("td", "th", "caption"), tag in ("div", "section", "html"),
            tag == "pre", text[:1] == "©")
        for k in page.kinds[i]:
            out[row, 14 + KINDS.index(k)] = 1.0
    return leaves, out


def leaf_labels(page: Page, leaves: list[int]) -> np.ndarray:
    """What the page's own marks say: inside its article and in no part named as something else."""
    other = set(KINDS) - {"body", "header", "social"}
    return np.array([page.marked[i] and not page.kinds[i] & other for i in leaves], float)


class TreeModel:
    """Unary weights and parent-child tables (log ratios): ``tie[kind][parent label, child label]``, kind 1 for leaves."""

    def __init__(self, weights: np.ndarray, tie: np.ndarray) -> None:
        self.weights, self.tie = weights, tie

    def marginals(self, page: Page, leaves: list[int], rows: np.ndarray) -> np.ndarray:
        """Sum-product over the tree: messages from children to parents, then from parents to children."""
        n = len(page.parent)
        own = np.zeros((n, 2))
        own[leaves, 1] = np.clip(rows @ self.weights, -30, 30)
        up = own.tolist()
        tie = self.tie.tolist()
        sent: list[tuple[float, float]] = [(0.0, 0.0)] * n
        for i in range(n - 1, 0, -1):  # children come after their parent
            t, (a, b) = tie[page.text[i] is not None], up[i]
            m = (_add(t[0][0] + a, t[0][1] + b), _add(t[1][0] + a, t[1][1] + b))
            sent[i] = m
            p = up[page.parent[i]]
            p[0] += m[0]
            p[1] += m[1]
        belief = [tuple(up[0])] + [(0.0, 0.0)] * (n - 1)
        for i in range(1, n):
            t, (p0, p1) = tie[page.text[i] is not None], belief[page.parent[i]]
            p0, p1 = p0 - sent[i][0], p1 - sent[i][1]
            top = max(p0, p1)
            p0, p1 = p0 - top, p1 - top
            belief[i] = (up[i][0] + _add(t[0][0] + p0, t[1][0] + p1), up[i][1] + _add(t[0][1] + p0, t[1][1] + p1))
        return np.array([1.0 / (1.0 + math.exp(min(max(belief[i][0] - belief[i][1], -700), 700))) for i in leaves])

    def extract(self, source: str | None) -> tuple[str, list[tuple[str, float]]]:
        """The main text and every leaf with its marginal."""
        page = parse(source or "")
        leaves, rows = leaf_features(page)
        if not leaves:
            return "", []
        p = self.marginals(page, leaves, rows)
        return " ".join(page.text[i] for i, x in zip(leaves, p) if x > 0.5), [(page.text[i], float(x)) for i, x in zip(leaves, p)]


def _add(x: float, y: float) -> float:
    """log(exp x + exp y)"""
    if x < y:
        x, y = y, x
    return x + math.log1p(math.exp(y - x))


def _node_labels(page: Page, leaves: list[int], labels: np.ndarray) -> list[int]:
    """An element is content if a leaf below it is."""
    out = [0] * len(page.parent)
    for i, y in zip(leaves, labels):
        out[i] = int(y)
    for i in range(len(out) - 1, 0, -1):
        if out[i]:
            out[page.parent[i]] = 1
    return out


def prior_model() -> TreeModel:
    return TreeModel(PRIOR_VECTOR.copy(), np.zeros((2, 2, 2)))


def learn(features: np.ndarray, labels: np.ndarray, pairs: np.ndarray) -> TreeModel:
    """Logistic weights by gradient steps, held to the prior means; ties from counts of (parent, child) labels."""
    weights = PRIOR_VECTOR.copy()
    if len(labels):
        for _ in range(STEPS):
            p = 1.0 / (1.0 + np.exp(-np.clip(features @ weights, -30, 30)))
            weights -= 0.5 * (features.T @ (p - labels) / len(labels) + RIDGE * (weights - PRIOR_VECTOR))
    joint = pairs.reshape(2, 2, 2) + 1.0
    tie = np.zeros((2, 2, 2))
    for kind in range(2):
        share = joint[kind] / joint[kind].sum()
        tie[kind] = np.clip(np.log(share / (share.sum(axis=1, keepdims=True) * share.sum(axis=0, keepdims=True))), -2.0, 2.0)
    return TreeModel(weights, tie)


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = TRAIN_PAGES, seed: int = 3) -> TreeModel:
    """Model trained on about ``sample`` of the pages that mark their article, taken by a hash of id and page.

    Leaves and pair counts of these pages (at most ``TRAIN_LEAVES`` leaves each) come to the driver. With no such page
    the prior means stand.
    """
    rows = pages.select(F.col(html_col).alias("source"), F.xxhash64(F.col(id_col), F.col(html_col), F.lit(seed)).alias("point"))
    rows = rows.where(F.lower("source").rlike(r"<(article|main)\b"))
    n = rows.count()
    taken = rows.where(in_share(F.col("point"), sample / max(n, 1)))
    width = len(FEATURES)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, point in zip(batch.column(0), batch.column(1).to_pylist()):
                page = parse(source.as_py())
                leaves, found = leaf_features(page, hide_marks=point >> 20 & 1 == 1)
                if not any(page.marked) or not leaves:
                    continue
                labels = leaf_labels(page, leaves)
                nodes = _node_labels(page, leaves, labels)
                pairs = np.zeros(8)
                for i in range(1, len(nodes)):
                    pairs[4 * (page.text[i] is not None) + 2 * nodes[page.parent[i]] + nodes[i]] += 1
                pick = np.linspace(0, len(leaves) - 1, min(len(leaves), TRAIN_LEAVES)).astype(int)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([found[pick].ravel().tolist()]), pa.array([labels[pick].tolist()]), pa.array([pairs.tolist()])], names=["x", "y", "pairs"])

    got = map_arrow(taken, counted, "x array<double>, y array<double>, pairs array<double>").toArrow()
    x = np.concatenate([np.empty(0), *[r.values.to_numpy() for c in got.column("x").chunks for r in c]]).reshape(-1, width)
    y = np.concatenate([np.empty(0), *[r.values.to_numpy() for c in got.column("y").chunks for r in c]])
    pairs = sum((r.values.to_numpy() for c in got.column("pairs").chunks for r in c), np.zeros(8))
    return learn(x, y, pairs)


def extract(pages: DataFrame, model: TreeModel, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all), ``text`` (main text; empty for null, empty and text-less pages) and ``n_chars``.

    Every row is worked on by itself: repeated rows give repeated results, an empty table an empty one, and a kept
    column named ``text`` or ``n_chars`` gives way to the new one.
    """
    def run(sources: pa.Array) -> list:
        texts = [model.extract(s)[0] for s in sources.to_pylist()]
        return [texts, [len(t) for t in texts]]

    return add_columns(pages, [html_col], [("text", "string"), ("n_chars", "long")], run, keep)
