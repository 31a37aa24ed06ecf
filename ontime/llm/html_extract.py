"""Main text of web pages by gradient-boosted trees over DOM nodes, decoded along the tree.

1. A page becomes a tree of its block elements (inline markup and formulas belong to the block around it). Elements that
   never show text, such as scripts, styles and form controls, are skipped; malformed pages are read as far as they go, and
   a hidden element without its end tag ends at the next block element or with the element around it. Only an unclosed
   script, style or textarea takes the rest of the page, as in HTML.
2. Every node gets features: text, link and punctuation density of its subtree, depth, its place among its siblings and
   their statistics, its tag and those above, and how its attribute tokens and those above speak for or against content.
3. The trees are trained on a bounded sample of pages: those with one article or main element as they are, labelled by it,
   and the text of the articles set into random layouts together with menus, notices, comments and so on made from the rest,
   so every node's label is known. Where the sample has no text at all, the layouts are made of built-in texts.
4. Decoding picks the most probable labelling in which a node may be kept only if all above it are, so no choice contradicts
   an ancestor's; dropping a node below one that is kept has a price, so single weak nodes of an article stay.

Pages are extracted row by row in one pass without a shuffle; the model has a fixed size and is broadcast. Text: character
references are decoded, white space inside a block becomes one space, blocks are joined in page order by one line feed.

Defined results: null and empty pages have empty text; a page without markup is one block; a page cut off anywhere keeps
what it has; repeated rows are extracted alike; a null id or URL stays null; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import named

SAMPLE_PAGES = 300
SAMPLE_CHARS = 100_000
LAYOUTS = 3
ROUNDS, DEPTH, RATE, BINS = 50, 4, 0.25, 32
DROP_PRICE = 1.0
PAGES_AT_ONCE = 64
REMEMBERED = 10_000

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup"
    " time tt u var wbr data output".split())
HIDDEN = frozenset("script style title noscript template svg iframe canvas audio video select option textarea button annotation annotation-xml".split())
RAW = frozenset("script style textarea".split())
NOT_NESTED = frozenset("title noscript iframe select option textarea button".split())
MIXED = frozenset("label map object".split())
HOLDS_TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre figcaption caption".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr main menu nav ol p pre section table ul li".split())
ENDS_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
BLOCK = ENDS_PARAGRAPH | frozenset("body li dt dd tr td th tbody thead tfoot".split())
SCOPE = frozenset("ul ol dl table article section div main body".split())
TAGS = ("p div section article main header footer nav aside form ul ol li table td h1 h2 h3 h4 blockquote pre figure body dl").split()
ABOVE = "article main nav header footer aside form ul table section".split()

_SPACE = re.compile(r"\s+")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Page(HTMLParser):
    """Block elements of a page in page order, and its blocks of text.

    What stands in a hidden element is read from the first block element on, and taken back when the element's end tag
    comes. If none comes before the end of an element around it, or of the page, the hidden element ended at that block.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.tokens, self.label = ["#page"], [-1], [[]], [1]
        self.blocks: list[tuple[int, str, int]] = []  # node, text, characters inside links
        self._open, self._links = [0], 0
        self._hidden: list[list] = []  # tag, state to go back to once a block element was seen
        self._within = [Counter()]  # open elements that are no nodes: of the page, of each hidden element
        self._math = 0  # open elements of a formula inside a block
        self._run: list[str] = []
        self._linked = 0
        self.feed(html)
        self.close()
        self._flush()

    def _flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self._run)).strip()
        if text:
            self.blocks.append((self._open[-1], text, min(self._linked, len(text))))
        self._run, self._linked = [], 0

    def _close(self, tags, scope=()) -> None:
        """Close the innermost open element of these tags, and all inside it, unless a scope begins before."""
        for i in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[i]]
            if tag in tags:
                del self._open[i:]
                return
            if tag in scope:
                return

    def _quiet(self) -> bool:
        return bool(self._hidden) and self._hidden[-1][1] is None

    def _hide(self, tag) -> None:
        if tag in NOT_NESTED:
            tags = [h[0] for h in self._hidden]
            while tag in tags[(len(tags) - tags[::-1].index("svg") if "svg" in tags else 0):]:
                self._unhide()
                tags.pop()
        self._hidden.append([tag, None])
        self._within.append(Counter())

    def _unhide(self) -> None:
        self._hidden.pop()
        self._within.pop()

    def _read_on(self) -> None:
        """A block element begins: what follows counts unless the end tags of the hidden elements around it come."""
        state = (len(self.tag), len(self.blocks), self._open[:], self._links, self._run[:], self._linked, self._math)
        for hidden in self._hidden:
            hidden[1] = hidden[1] or state

    def _take_back(self, tag) -> None:
        found = ""
        while found != tag:
            found, state = self._hidden[-1]
            self._unhide()
        if state:
            nodes, blocks, opened, self._links, run, self._linked, self._math = state
            self._open, self._run = opened[:], run[:]
            for kept in (self.tag, self.parent, self.tokens, self.label):
                del kept[nodes:]
            del self.blocks[blocks:]

    def _end_around(self, tag) -> None:
        """Hidden elements end with an open element around them."""
        while self._hidden:
            state = self._hidden[-1][1]
            first = state[0] if state else len(self.tag)
            if any(self.tag[node] == tag for node in self._open if node >= first) or not any(self.tag[node] == tag for node in self._open[1:]):
                return
            self._unhide()

    def _leave(self, tag) -> bool:
        """Close an element that is no node; hidden elements inside it end with it."""
        for i in range(len(self._within) - 1, -1, -1):
            if self._within[i][tag]:
                self._within[i][tag] -= 1
                while len(self._within) > i + 1:
                    self._unhide()
                return True
        return False

    def handle_starttag(self, tag, attrs):
        if tag == "head" or self._hidden and self._hidden[-1][0] in RAW:
            return
        if tag == "body":
            while self._hidden and self._hidden[-1][0] != "title":
                self._unhide()
        if tag in HIDDEN:
            self._hide(tag)
            return
        if self._quiet():
            if tag not in BLOCK:
                self._within[-1][tag] += tag not in VOID
                return
            self._read_on()
        if tag in BLOCK:
            self._math = 0
        elif self._math or tag == "math" or tag in MIXED and self.tag[self._open[-1]] in HOLDS_TEXT:
            self._within[-1][tag] += tag not in VOID
            self._math += tag == "math"
            return
        if tag == "br":
            self._flush()
        if tag in INLINE or tag in VOID:
            self._links += tag == "a"
            self._within[-1][tag] += tag not in VOID
            if tag in VOID and tag not in ("br", "img", "wbr"):
                self._flush()
            return
        self._flush()
        self._links = 0
        if tag in ENDS_PARAGRAPH:
            self._close({"p"}, SCOPE)
        if tag in ENDS_ITSELF:
            self._close(ENDS_ITSELF[tag], SCOPE - {"tr"})
        tokens = []
        for name, value in attrs:
            if name in ("class", "id", "role", "itemprop", "aria-label"):
                tokens += [x.lower() for x in _PART.findall(value or "")]
        self.tag.append(tag)
        self.parent.append(self._open[-1])
        self.tokens.append(tokens)
        self.label.append(next((int(v) for n, v in attrs if n == "data-y" and v in ("0", "1")), -1))
        self._open.append(len(self.tag) - 1)

    def handle_endtag(self, tag):
        if tag == "head" or self._hidden and self._hidden[-1][0] in RAW and self._hidden[-1][0] != tag:
            return
        if tag in HIDDEN:
            if any(h[0] == tag for h in self._hidden):
                self._take_back(tag)
            return
        if tag in INLINE or tag == "math" or self._within[-1][tag]:
            if self._leave(tag) and tag == "math" and not self._quiet():
                self._math = max(0, self._math - 1)
            if tag in INLINE and not self._quiet():
                self._links = max(0, self._links - (tag == "a"))
            return
        self._end_around(tag)
        if self._quiet():
            return
        self._flush()
        self._links = self._math = 0
        self._close({tag})

    def handle_data(self, data):
        if not self._quiet():
            self._run.append(data)
            if self._links:
                self._linked += len(data)


def _grams(token: str) -> list[str]:
    marked = f"^{token}$"
    return [marked[i:i + 4] for i in range(max(1, len(marked) - 3))]


class Words:
    """How much attribute tokens speak for content: smoothed log odds of their 4-grams, so unseen compounds count too."""

    def __init__(self, tokens: list[list[str]], labels: np.ndarray):
        seen = defaultdict(lambda: [0.5, 0.5])
        for own, y in zip(tokens, np.maximum(labels, 0)):
            for gram in {g for t in own for g in _grams(t)}:
                seen[gram][int(y)] += 1
        total = [max(1, (labels == y).sum()) for y in (0, 1)]
        self.known: dict[tuple[str, ...], float] = {}
        self.odds = {g: float(np.log(n1 / total[1]) - np.log(n0 / total[0])) for g, (n0, n1) in seen.items()}

    def score(self, tokens: list[str]) -> float:
        key = tuple(tokens)
        if key not in self.known:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            self.known[key] = float(sum(np.mean([self.odds.get(g, 0.0) for g in _grams(t)]) for t in tokens))
        return self.known[key]


def features(page: Page, words: Words) -> np.ndarray:
    """One row per node."""
    n = len(page.tag)
    parent = np.array(page.parent)
    own = np.zeros((n, 5))  # characters, characters in links, blocks, punctuation marks, words
    for node, text, linked in page.blocks:
        own[node] += (len(text), linked, 1, sum(text.count(c) for c in ".,;:!?"), text.count(" ") + 1)
    below, nodes, paragraphs = own.copy(), np.ones(n), np.array([t == "p" for t in page.tag], float)
    for i in range(n - 1, 0, -1):  # children come after their parents
        below[parent[i]] += below[i]
        nodes[parent[i]] += nodes[i]
        paragraphs[parent[i]] += paragraphs[i]
    depth, before, said, path_low, path_high = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    above = np.zeros((n, len(ABOVE)))
    children = np.bincount(parent[1:], minlength=n) if n > 1 else np.zeros(n)
    place, seen, last = np.zeros(n), np.zeros(n), np.zeros(n)
    for i in range(n):
        said[i] = words.score(page.tokens[i]) if page.tokens[i] else 0.0
        if i:
            p = parent[i]
            depth[i], place[i] = depth[p] + 1, seen[p]
            before[i] = last[p]
            last[i] = before[i] + own[p, 0] / max(1, children[p])
            last[p] += below[i, 0]
            seen[p] += 1
            above[i] = above[p]
            if page.tag[p] in ABOVE:
                above[i, ABOVE.index(page.tag[p])] = 1
            path_low[i], path_high[i] = min(path_low[p], said[p]), max(path_high[p], said[p])
    up = np.maximum(parent, 0)
    share = lambda a, b: a / np.maximum(b, 1)
    tag = np.array([[t == x for x in TAGS] for t in page.tag], float)
    return np.column_stack([
        np.log1p(below[:, 0]), np.log1p(own[:, 0]), share(below[:, 1], below[:, 0]), share(below[:, 3], below[:, 4]), share(below[:, 0], nodes),
        share(below[:, 0], below[:, 2]), share(paragraphs, nodes), np.log1p(nodes), share(below[:, 0], below[0, 0]), share(before, below[0, 0]),
        depth, children, place, children[up], share(below[:, 0], below[up, 0]), share(below[up, 1], below[up, 0]),
        share(below[up, 0], children[up]), share(paragraphs[up], nodes[up]), said, said[up], path_low, path_high, tag, above,
    ])


class Trees:
    """Gradient-boosted regression trees of fixed depth on binned features, logistic loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        b = self._bins(x)
        self.base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        margin = np.full(len(y), self.base)
        self.trees = []
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(b, y - p, p * (1 - p))
            self.trees.append(tree)
            margin += self._leaf(tree, b)

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(self.edges, x.T)]).astype(np.int64)

    @staticmethod
    def _grow(b: np.ndarray, slope: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.zeros(len(b), np.int64)
        feature, cut = np.zeros(2 ** DEPTH - 1, np.int64), np.full(2 ** DEPTH - 1, BINS)
        for level in range(DEPTH):
            first, width = 2 ** level - 1, 2 ** level
            best = np.full(width, 1e-6)
            for f in range(b.shape[1]):
                key = (at - first) * BINS + b[:, f]
                g = np.cumsum(np.bincount(key, slope, width * BINS).reshape(width, BINS), axis=1)
                h = np.cumsum(np.bincount(key, weight, width * BINS).reshape(width, BINS), axis=1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g ** 2 / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - all_g ** 2 / (all_h + 1)
                k = gain.argmax(axis=1)
                top = gain[np.arange(width), k]
                better = top > best
                best = np.where(better, top, best)
                feature[first: first + width] = np.where(better, f, feature[first: first + width])
                cut[first: first + width] = np.where(better, k, cut[first: first + width])
            at = 2 * at + 1 + (b[np.arange(len(b)), feature[at]] > cut[at])
        leaf = at - (2 ** DEPTH - 1)
        g, h = np.bincount(leaf, slope, 2 ** DEPTH), np.bincount(leaf, weight, 2 ** DEPTH)
        return feature, cut, RATE * g / (h + 1)

    @staticmethod
    def _leaf(tree: tuple, b: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        at, rows = np.zeros(len(b), np.int64), np.arange(len(b))
        for _ in range(DEPTH):
            at = 2 * at + 1 + (b[rows, feature[at]] > cut[at])
        return value[at - (2 ** DEPTH - 1)]

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = self._bins(x)
        return self.base + sum(self._leaf(tree, b) for tree in self.trees)


def decode(parent: list[int], margin: np.ndarray) -> np.ndarray:
    """The best labelling in which only nodes below kept nodes are kept; the page itself always is."""
    n = len(parent)
    margin = np.clip(margin, -6, 6)
    keep, drop = -np.logaddexp(0, -margin), -np.logaddexp(0, margin)
    for i in range(n - 1, 0, -1):  # children come after their parents, so both sums are complete here
        keep[parent[i]] += max(keep[i], drop[i] - DROP_PRICE)
        drop[parent[i]] += drop[i]
    kept = np.zeros(n, bool)
    kept[0] = True
    for i in range(1, n):
        kept[i] = kept[parent[i]] and keep[i] >= drop[i] - DROP_PRICE
    return kept


# Names that layouts give to their parts.
CONTENT_NAMES = ("content main-content post entry story article-body post-content entry-content text body-copy page-content single"
                 " articleBody article content-area post-body article__content").split()
WRAPPER_NAMES = "page wrapper container site layout row col-md-8 inner main-wrapper root app outer".split()
PARTS = {
    "menu": (("nav", "div", "ul"), "menu nav navbar main-menu breadcrumb breadcrumbs pagination pager navigation topnav nav-links".split()),
    "header": (("header", "div"), "header site-header masthead topbar top-bar branding page-head logo tagline".split()),
    "footer": (("footer", "div"), "footer site-footer copyright legal bottom colophon footer-links imprint".split()),
    "sidebar": (("aside", "div"), "sidebar side widget related related-posts recommended trending tags most-read secondary right-rail".split()),
    "notice": (("div", "section", "aside"), "cookie cookie-notice consent gdpr notice alert newsletter popup modal overlay warning-banner subscribe paywall".split()),
    "ad": (("div", "section", "aside"), "ad ads advert advertisement sponsored promo banner ad-slot adsbox dfp teaser-ad google-ad".split()),
    "form": (("form",), "search subscribe login contact signup search-form newsletter-form".split()),
    "comments": (("section", "div", "ol"), "comments comment-list discussion replies reader-comments disqus responses comment-section".split()),
    "share": (("div", "ul"), "share social sharing share-buttons social-links".split()),
}


# Texts for layouts where a table's sample has none.
ARTICLES = (
    ("The river rose again", "The river rose by two metres in the night, and the lower streets of the town were closed before dawn. Nobody was hurt.",
     "Engineers had warned of it for years, but the money for a new wall was spent on the bridge. Work is to begin in spring, the mayor said."),
    ("How to keep bread fresh", "Bread goes stale because its starch hardens, not because it dries. A cool place is the worst one for it; a box at room temperature is better.",
     "Slices can be frozen, however, and toasted as they are. They keep for about three months."),
    ("Notes on the second release", "This release reads its settings once, when the program starts. Changes made later are ignored, so restart it after an edit.",
     "Two errors were mended as well: long names are no longer cut off, and an empty list is now shown as such.",
     "Thanks to all who tried the early versions, and who wrote to us about them."),
    ("A walk along the coast", "We left the village at eight, with the sun behind us, and followed the path over the cliffs. It is steep at first, but never hard.",
     "After an hour the lighthouse comes into view. Its keeper sells tea, cake and postcards, and tells stories about the winter of the great storm."),
)
REST = ("Home", "About us", "Contact", "Sign in to your account", "Most read this week", "Related stories", "All rights reserved", "Terms of use and privacy",
        "Share this page", "Subscribe to our newsletter", "We use cookies to improve this site. Accept all", "Leave a comment", "Next page", "Advertisement", "Search")


class Layouts:
    """Random pages of known labels: (tag, attributes, children or text, label)."""

    def __init__(self, articles: list[list[str]], rest: list[str], rng: np.random.Generator):
        self.articles, self.rest, self.rng = articles, rest or ["more"], rng

    def _one(self, items):
        return items[int(self.rng.integers(len(items)))]

    def _phrase(self) -> str:
        text = self._one(self.rest if self.rng.random() < 0.7 else self._one(self.articles))
        words = text.split(" ")
        at = int(self.rng.integers(len(words)))
        return " ".join(words[at: at + int(self.rng.integers(1, 14))])

    def _tag(self, tag: str, inside: str, label: int, name: str = "") -> str:
        where = self._one(("class", "class", "id", "role")) if name else ""
        return f'<{tag} data-y="{label}"' + (f' {where}="{name}"' if name else "") + f">{inside}</{tag}>"

    def _links(self) -> str:
        items = [f'<a href="#">{self._phrase()}</a>' for _ in range(int(self.rng.integers(2, 9)))]
        style = self.rng.random()
        if style < 0.6:
            return self._tag("ul", "".join(self._tag("li", x, 0) for x in items), 0)
        return "".join(self._tag("div" if style < 0.8 else "p", x, 0) for x in items)

    def _part(self, kind: str) -> str:
        tags, names = PARTS[kind]
        tag = self._one(tags)
        telling = tag not in ("div", "section", "ol", "ul")
        name = "" if telling and self.rng.random() < 0.4 else self._one(names)
        if kind in ("menu", "share"):
            inside = self._links()
        elif kind == "comments":
            inner = self._one(("div", "li", "article", "p"))
            inside = (self._tag("h3", self._phrase(), 0) if self.rng.random() < 0.5 else "") + "".join(
                self._tag(inner, self._tag("p", self._one(self._one(self.articles)), 0) if inner != "p" else self._one(self._one(self.articles)), 0,
                          self._one(("comment", "reply", "comment-body", ""))) for _ in range(int(self.rng.integers(1, 6))))
        elif kind == "form":
            inside = self._tag("p", self._phrase(), 0) + "<input name='q'><button>ok</button>"
        else:
            inside = self._links() if kind in ("sidebar", "footer", "header") and self.rng.random() < 0.5 else ""
            for _ in range(int(self.rng.integers(0 if inside else 1, 3))):
                text = self._phrase() if self.rng.random() < 0.7 else self._one(self.rest)
                inside += text if self.rng.random() < 0.5 else self._tag(self._one(("p", "h3", "div", "h2")), text, 0)
        return self._tag(tag, inside, 0, name)

    def _article(self) -> str:
        texts = self._one(self.articles)
        out = self._tag("h1", texts[0][:60], 1) if self.rng.random() < 0.8 else ""
        if out and self.rng.random() < 0.15:
            out = self._tag("header", out, 1, "post-header")
        for text in texts:
            style = self.rng.random()
            if style < 0.03:
                out += f'<p data-y="1"><b>{text}<br>'
            elif style < 0.80:
                out += self._tag("p", text, 1)
            elif style < 0.86:
                out += self._tag("div", text, 1)
            elif style < 0.90:
                out += self._tag("blockquote", self._tag("p", text, 1), 1)
            elif style < 0.94:
                out += self._tag(self._one(("h2", "h3")), text[:50], 1) + self._tag("p", text, 1)
            elif style < 0.98:
                out += self._tag("ul", "".join(self._tag("li", t, 1) for t in text.split(". ")), 1)
            else:
                out += self._tag("table", self._tag("tr", self._tag("td", text, 1), 1), 1)
            if self.rng.random() < 0.02:
                out += self._part(self._one(("ad", "share", "notice")))
        tag = self._one(("article", "article", "main", "div", "section"))
        return self._tag(tag, out, 1, "" if tag in ("article", "main") and self.rng.random() < 0.6 else self._one(CONTENT_NAMES))

    def page(self) -> str:
        chance = self.rng.random
        before = [k for k, p in (("header", 0.5), ("menu", 0.8), ("notice", 0.3), ("ad", 0.4), ("form", 0.2), ("sidebar", 0.2)) if chance() < p]
        after = [k for k, p in (("share", 0.3), ("comments", 0.4), ("sidebar", 0.4), ("form", 0.2), ("ad", 0.3), ("menu", 0.2), ("notice", 0.2), ("footer", 0.8)) if chance() < p]
        middle = self._article()
        if chance() < 0.4:
            beside = "".join(self._part(k) for k in after if k in ("share", "comments", "sidebar", "ad"))
            after = [k for k in after if k not in ("share", "comments", "sidebar", "ad")]
            middle = self._tag(self._one(("div", "main", "section")), middle + beside, 1, self._one(WRAPPER_NAMES))
        inside = "".join(self._part(k) for k in before) + middle + "".join(self._part(k) for k in after)
        if chance() < 0.4:
            inside = self._tag("div", inside, 1, self._one(WRAPPER_NAMES))
        return f'<html data-y="1"><head><title>x</title></head><body data-y="1">{inside}</body></html>'


class Model:
    def __init__(self, words: Words, trees: Trees):
        self.words, self.trees = words, trees

    def texts(self, pages: list[str | None]) -> list[str]:
        """The main text of each page; the trees judge the nodes of all of them at once."""
        parsed = [Page(html or "") for html in pages]
        if not parsed:
            return []
        rows = [features(page, self.words) for page in parsed]
        margins = np.split(self.trees.margin(np.concatenate(rows)), np.cumsum([len(r) for r in rows])[:-1])
        kept = [decode(page.parent, margin) for page, margin in zip(parsed, margins)]
        return ["\n".join(text for node, text, _ in page.blocks if keep[node]) for page, keep in zip(parsed, kept)]


def _seeds(page: Page) -> tuple[list[str], list[str]]:
    """Blocks of a sampled page inside an article or main element, and all others; the page's nodes are labelled by it."""
    inside = np.zeros(len(page.tag), bool)
    for i in range(1, len(page.tag)):
        inside[i] = inside[page.parent[i]] or page.tag[i] in ("article", "main")
    if not inside.any():
        return [t for _, t, _ in page.blocks], []
    holds = inside.copy()
    for i in range(len(page.tag) - 1, 0, -1):
        holds[page.parent[i]] |= holds[i]
    if page.tag.count("article") + page.tag.count("main") == 1:
        page.label = holds.astype(int).tolist()
    return [t for node, t, _ in page.blocks if inside[node]], [t for node, t, _ in page.blocks if not inside[node]]


def train(pages: list[str], layouts: int = LAYOUTS, seed: int = 5) -> Model | None:
    """A model from sampled pages; None if none of them has text."""
    given = [Page(html) for html in pages]
    seeds = [_seeds(page) for page in given]
    return _trained(given, seeds, layouts, seed) if any(a for a, _ in seeds) else None


def built_in(layouts: int = LAYOUTS, seed: int = 5) -> Model:
    """A model from layouts of fixed texts, for tables whose sample has none."""
    return _trained([], [([*texts], [*REST]) for texts in ARTICLES], layouts, seed)


def _trained(given: list[Page], seeds: list[tuple[list[str], list[str]]], layouts: int, seed: int) -> Model:
    articles = [a for a, _ in seeds if a]
    quoted = lambda texts: [t.replace("&", "&amp;").replace("<", "&lt;") for t in texts]
    made = Layouts([quoted(a) for a in articles], quoted([t for _, rest in seeds for t in rest]), np.random.default_rng(seed))
    parsed = [Page(made.page()) for _ in range(layouts * max(60, len(articles)))] + [p for p in given if min(p.label[1:], default=-1) >= 0]
    labels = [np.array(p.label) for p in parsed]
    # each half is described with the words of the other, so trees learn how far unseen words can be trusted
    halves = [Words([t for p in parsed[h::2] for t in p.tokens], np.concatenate(labels[h::2])) for h in (0, 1)]
    x = np.concatenate([features(p, halves[1 - i % 2]) for i, p in enumerate(parsed)])
    y = np.concatenate(labels)
    return Model(Words([t for p in parsed for t in p.tokens], y), Trees(x[y >= 0], y[y >= 0]))


def fit(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE_PAGES) -> Model | None:
    """A model from at most ``sample`` pages in the order of a hash of the page; None if all pages are null or empty.

    Pages of at most SAMPLE_CHARS characters are sampled; if none of these has text, the beginnings of longer ones; if these
    have none either, the built-in texts are used.
    """
    rows = pages.select(named(html_col).cast("string").alias("html")).where(F.length("html") > 0)
    rows = rows.select(F.xxhash64("html").alias("hash"), F.substring("html", 1, SAMPLE_CHARS).alias("html"), (F.length("html") > SAMPLE_CHARS).alias("long"))
    given = False
    for part in (rows.where(~F.col("long")), rows.where("long")):
        chosen = [r.hash for r in part.select("hash").distinct().orderBy("hash").limit(sample).collect()]
        if not chosen:
            continue
        given = True
        texts = part.where(F.col("hash").isin(chosen)).groupBy("hash").agg(F.min("html").alias("html")).orderBy("hash").collect()
        if (model := train([r.html for r in texts])) is not None:
            return model
    return built_in() if given else None


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sample: int = SAMPLE_PAGES) -> DataFrame:
    """One row per input row: page_id, url, text, n_chars."""
    shared = pages.sparkSession.sparkContext.broadcast(fit(pages, html_col, sample))

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = []
            for at in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.column("html").slice(at, PAGES_AT_ONCE).to_pylist()
                texts += model.texts(part) if model else [""] * len(part)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    rows = pages.select(named(id_col).cast("long").alias("page_id"), named(url_col).cast("string").alias("url"), named(html_col).cast("string").alias("html"))
    return rows.mapInArrow(extracted, "page_id long, url string, text string, n_chars long")
