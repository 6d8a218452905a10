"""Operator 5, main text of HTML pages from flat text blocks.

A page is cut into flat blocks at its block elements. A block is described by its word count and link density, those of its two
neighbours, and what it stands in; a decision tree, trained here on the small table of labelled pages below, says whether it
belongs to the article. The article's blocks are joined in page order.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docframe.llm.common import arrow_map, column

#: Elements whose content is no text.
DROPPED = frozenset("script style noscript template svg math canvas iframe object audio video head title select datalist textarea".split())
#: Elements that start and end a block.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of a container's class, id or role that say that it is no part of the article.
AWAY = frozenset(
    "nav navbar navigation menu menus submenu dropdown breadcrumb breadcrumbs crumb crumbs masthead footer foot sidebar sidebars aside widget widgets related recommended recommendations "
    "promo promos promotion advert adverts advertisement advertising ad ads adbox adslot sponsor sponsored sponsors cookie cookies consent gdpr notice notices alert alerts popup modal overlay subscribe "
    "subscription newsletter signup login signin search searchbox share sharing sharebar social comment comments disqus respond reply replies copyright legal disclaimer pagination pager toolbar skip hidden toc "
    "complementary contentinfo feedback discussion discussions".split()
)
#: The words among them of what readers write: an element of such a name is never the page's text.
READERS = frozenset("comment comments disqus respond reply replies feedback discussion discussions".split())
#: The same of words that also name the head of an article: they count where the rest of the name speaks of the site.
HEADS = frozenset("header banner".split())
_SITE = frozenset("site main top global sticky fixed wrapper wrap container inner outer bar large small image area".split())
#: Words that say nothing of their own: a name of these and AWAY words alone leads away for certain.
_PLAIN = _SITE | frozenset("page bottom box block list item items section panel links link button buttons icon icons group row col column div id module secondary primary text title body form field media post posts article articles content thread count meta area slot unit user users reader readers".split())
HOME = frozenset("article content entry post story main prose blog".split())
_PART = re.compile(r"[^\W\d_]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: A tag ends at the first > outside a quoted value; a quote opens a value only after an equals sign.
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|$)|'[^']*+(?:'|$)|[^\s>\"'][^\s>]*+)?+)*+)(?:>|$)|<[!?][^>]*(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*)))?")
_SPACE = re.compile(r"\s+")
_AWAY_TAGS = frozenset("nav aside footer header form button dialog menu fieldset".split())

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "in_article", "in_away", "named_away", "named_home", "heading", "item")


class Node:
    """An element that holds blocks: what it is, what stands in it and, once the page is read, what holds for the blocks in it."""

    __slots__ = ("heading", "holds_home", "in_article", "in_away", "item", "mark", "named_away", "named_home", "parent", "readers", "tag", "words")

    def __init__(self, parent: Node | None, tag: str, mark: int, readers: bool):
        self.parent, self.tag, self.mark, self.readers = parent, tag, mark, readers
        self.words, self.holds_home = 0, tag in ("article", "main")
        self.in_article = self.in_away = self.named_away = self.named_home = self.heading = self.item = 0


class Block:
    """A flat text block: its text, words, words in links, and the element it stands in."""

    __slots__ = ("linked", "node", "text", "words")

    def __init__(self, text: str, words: int, linked: int, node: Node):
        self.text, self.words, self.linked, self.node = text, words, linked, node


def _settle(nodes: list[Node], blocks: list[Block]) -> None:
    """What holds for the blocks of each element. An element that leads away by its tag or name is excused where the page's text lies in
    it: where it is or holds an article and has most of the words outside of links, or where it has nearly all of those of the
    article around it. What readers wrote counts for neither."""
    for b in blocks:
        b.node.words += b.words - b.linked
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.holds_home |= node.holds_home or node.mark < 0
            if not node.readers:
                node.parent.words += node.words
    whole = nodes[0].words
    home: dict[Node, Node | None] = {}
    for node in nodes:
        up = node.parent
        around = home[up] if up is not None else None
        home[node] = node if node.tag in ("article", "main") else around
        tag_away = node.tag in _AWAY_TAGS and not (node.tag == "header" and around is not None)
        if (tag_away or node.mark > 0) and not node.readers:
            most = node.holds_home and 2 * node.words > whole
            nearly = around is not None and node.tag not in ("nav", "aside", "footer") and 10 * node.words >= 9 * around.words > 0
            if most or nearly:
                tag_away, node.mark = False, min(node.mark, 0)
        node.in_article = int(home[node] is not None)
        node.in_away = int(tag_away or (up is not None and bool(up.in_away)))
        node.named_away = max(node.mark, up.named_away if up is not None else 0, 0)
        node.named_home = int(node.mark < 0 or (up is not None and bool(up.named_home)))
        node.heading = int((len(node.tag) == 2 and node.tag[0] == "h" and node.tag[1].isdigit()) or (up is not None and bool(up.heading)))
        node.item = int(node.tag == "li" or (up is not None and bool(up.item)))


def _names_away(name: str) -> int:
    """Of one class, id or role: 2 if it surely leads away from the article, 1 if it may, -1 if it leads to it, 0 otherwise."""
    parts = [x.lower() for x in _PART.findall(_CAMEL.sub(" ", name))]
    away = [x for x in parts if x in AWAY]
    if not away and any(x in HEADS for x in parts):
        return 2 if all(x in HEADS or x in _SITE for x in parts) else 0
    if away:
        return 2 if all(x in AWAY or x in HEADS or x in _PLAIN or len(x) == 1 for x in parts) else 1
    return -1 if any(x in HOME for x in parts) else 0


def _mark(attributes: str) -> tuple[int, bool]:
    """What a container's names say: the strongest of those that lead away, or -1 for one that leads to the article; 2 if hidden; and
    whether readers write there."""
    marks, readers = [0], False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
            return 2, True  # what is hidden is never the page's text either
        if key in ("class", "id", "role"):
            own = list(map(_names_away, value.split()))
            marks += own
            readers |= any(m == 2 and not READERS.isdisjoint(x.lower() for x in _PART.findall(_CAMEL.sub(" ", name))) for m, name in zip(own, value.split(), strict=True))
    return max(marks) or min(marks), readers


def flat_blocks(html: str | None) -> list[Block]:
    """The text blocks of a page in order; broken and unclosed markup is read as far as it goes."""
    blocks: list[Block] = []
    stack = [Node(None, "", 0, False)]
    nodes, open_tags, no_end = [stack[0]], Counter(), set()
    parts: list[str] = []
    linked, in_link = 0, -1  # in_link: the depth of the stack where the open link began; a link ends with what it began in
    html = html or ""

    def end() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", "".join(parts)).strip()
        if text:
            words = len(text.split())
            blocks.append(Block(text, words, min(linked, words), stack[-1]))
        parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = unescape(raw) if "&" in raw else raw
            parts.append(text)
            if in_link >= 0:
                linked += len(text.split())

    def close(i: int) -> None:
        nonlocal in_link
        open_tags.subtract(node.tag for node in stack[i:])
        del stack[i:]
        if len(stack) < in_link:
            in_link = -1

    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            add(html[at:])
            break
        add(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                add(m[0][9:].removesuffix("]]>"))
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in DROPPED and not closing:
            if not m[3].endswith("/"):
                # Where one element has no end, no later one of its name has: the page is searched to its end once for each name.
                found = None if tag in no_end else re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|$)", re.I).search(html, at)
                if found is None:
                    no_end.add(tag)
                at = found.end() if found else (n if tag in ("script", "style", "template", "textarea") else at)
            continue
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = -1 if closing else len(stack)
        elif tag in BLOCKS:
            end()
            if closing:
                for i in range(len(stack) - 1, 0, -1) if open_tags[tag] else ():
                    if stack[i].tag == tag:
                        close(i)
                        break
            elif tag not in VOID:
                if (tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and open_tags["p"] + open_tags[tag]) or stack[-1].tag == "p":
                    # A new block closes the open paragraph, or the open one of its kind within its list or table.
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i].tag in ("p", tag):
                            close(i)
                            break
                        if stack[i].tag in ("ul", "ol", "dl", "table", "div", "article", "section", "body", "nav", "aside", "main", "footer", "header"):
                            break
                mark, readers = _mark(m[3]) if m[3] and tag != "body" else (0, False)
                stack.append(Node(stack[-1], tag, mark, readers))
                nodes.append(stack[-1])
                open_tags[tag] += 1
    end()
    _settle(nodes, blocks)
    return blocks


def features(blocks: list[Block]) -> np.ndarray:
    """One row a block, FEATURES wide: counts and link densities of the block and its neighbours, and its surroundings."""
    n = len(blocks)
    words = np.array([0, *(b.words for b in blocks), 0], float)
    density = np.array([0, *(b.linked / b.words for b in blocks), 0], float)
    own = np.array([(b.node.in_article, b.node.in_away, b.node.named_away, b.node.named_home, b.node.heading, b.node.item) for b in blocks], float).reshape(n, 6)
    return np.column_stack([words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:], own])


#: The labelled pages: + before a block of the article, - before one that is not.
_LABELLED = (
    '<body><header><div>-Site name</div><nav><ul><li><a href="#">-Home</a><li><a href="#">-News today</a></ul></nav></header><main><article><h1>+A title of words</h1><p>+{long}</p><p>+Yes.</p><p>+{mid}</p></article></main><aside><p>-{mid}</p></aside><footer>-{short}</footer></body>',
    '<body><nav><ul><li><a>-One</a></li><li><a>-Two</a></li></ul></nav><div class="ad">-{mid}</div><article><h1>+{short}</h1><p><b>+{short}<br><p>+{long}</p><p>+Be.</p><ul><li>+{short}</li><li>+{mid}</li></ul></article><footer>-{short}</footer></body>',
    '<body><div id="menu"><a>-A</a> <a>b</a></div><div id="content"><h2>+{short}</h2><p>+{long}</p><p>+{long}</p><p>+{short}</p></div><div class="comments"><p>-{long}</p><p>-{short}</p></div><div id="footer">-{short}</div></body>',
    "<body><div>-<a>Home</a> <a>About us</a> <a>Contact</a></div><h1>+{short}</h1><p>+{long}</p><p>+{mid}</p><p>+{long}</p><div>-<a>Next page</a> <a>Previous page</a></div><div>-Copyright</div></body>",
    '<body><div class="cookie-notice">-{mid}</div><article><header><h1>+{short}</h1></header><p>+{long}</p><blockquote>+{mid}</blockquote><aside><p>-{mid}</p></aside><form><label>-{short}</label></form><table><tr><td>+{short}<td>+{short}</table></article><section id="comments"><h3>-{short}</h3><p>-{long}</p></section></body>',
    '<body><div class="sidebar"><h3>-{short}</h3><p>-{long}</p></div><div class="post-content"><p>+{long}</p><h3>+{short}</h3><p>+{mid} <a>with link</a></p><pre>+{mid}</pre></div><div class="related"><ul><li>-<a>{short}</a></li><li>-<a>{mid}</a></li></ul></div></body>',
    "<body><nav>-{short}</nav><article><h1>+{short}</h1><p>+{long}</p><p>+{short}</p></article></body>",
    "<body><article><p>+{short}</p></article></body>",
    "<body><nav>-{short}</nav><article><h1>+Title</h1><p>+Be.</p><p>+Thus.</p><p>+{short}</p><p>+No.</p><p>+So {long}</p></article><footer>-{short}</footer></body>",
    "<body><article><h1>+Odd</h1><p>+{short}</p><p>+One</p></article></body>",
    "<body><article><p>+Word</p><p>+{mid}</p><p>+Two words</p><p>+Word</p></article><div class='ad'>-Buy</div></body>",
    "<body><article><h1>+{short}</h1><p>+Word</p></article></body>",
    "<body><div>-<a>{short}</a></div><article><p>+{mid}</p><p>+{mid}",
    "<body><p>+{long}</p></body>",
    "+{mid}",
    "<p>+{short}</p>",
    "<h1>+{short}</h1><p>+{mid}</p><p>+{short}</p>",
    "<body><main><p>+<a>{mid}</a></p></main></body>",
    "<body><table><tr><td>-<a>Start</a></td><td>-<a>Map</a></td></tr></table><p>+{long}</p><p>+{mid}</p><p>+{long}</p><p>-<a>{mid}</a></p></body>",
    '<body><article><p>+{mid}</p><div class="share">-<a>Tell a friend</a></div><p>+{long}</p><div class="advert">-{long}</div><p>+<a>{short}</a></p><p>+{short}</p><section class="comments"><article><p>-{long}</p></article></section></article></body>',
    '<body><main><h1>+{short}</h1><p>+{short}</p><p>+{long}</p><nav>-<a>{short}</a></nav><div class="newsletter"><p>-{mid}</p></div></main><div role="banner">-{mid}</div></body>',
    '<body><div class="entry"><p>+{mid}</p><ol><li>+{mid}</li><li>+{short}</li></ol><div class="notice">-{mid}</div></div><p>-{short}</p><form><p>-{mid}</p></form></body>',
    '<body><div class="shareholder-news legal-affairs"><h1>+{short}</h1><p>+{long}</p><p>+{mid}</p></div><div class="legal-small-print">-<a>{short}</a></div></body>',
    '<body><div class="wrap right-sidebar"><article><h1>+{short}</h1><p>+{long}</p><p>+{short}</p><p>+{mid}</p></article></div><div class="share-tools-x">-<a>{short}</a> <a>{short}</a></div></body>',
    '<body><article class="social-science-report"><h1>+{short}</h1><p>+{mid}</p><ul><li>+{short}</li></ul><p>+{long}</p></article></body>',
    '<body><a href="#"><div>-{short}</div></a><article><div class="section-header"><h2>+{short}</h2></div><p>+{long}</p></article><div class="left-sidebar-x"><ul><li>-<a>{short}</a></li></ul></div></body>',
)
_FILL = {"short": "few words in here", "mid": " ".join(["some"] * 16), "long": " ".join(["more"] * 60)}


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    rows, labels = [], []
    for page in _LABELLED:
        blocks = flat_blocks(page.format(**_FILL))
        labels += [b.text.startswith("+") for b in blocks]
        rows.append(features(blocks))
    return np.concatenate(rows), np.array(labels)


class Tree:
    """A binary decision tree grown by Gini gain; ties go to the first feature and the lowest threshold."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 8):
        self.value = bool(2 * y.sum() >= len(y))
        self.feature = -1
        if depth and 0 < y.sum() < len(y):
            best = (1e-9, -1, 0.0)
            gini = lambda part: 2 * part.mean() * (1 - part.mean()) * len(part) if len(part) else 0.0
            for f in range(x.shape[1]):
                for low, high in zip((u := np.unique(x[:, f]))[:-1], u[1:], strict=True):
                    t = (low + high) / 2
                    left = x[:, f] <= t
                    gain = gini(y) - gini(y[left]) - gini(y[~left])
                    if gain > best[0] + 1e-12:
                        best = (gain, f, t)
            if best[1] >= 0:
                self.feature, self.threshold = best[1:]
                left = x[:, self.feature] <= self.threshold
                self.low, self.high = Tree(x[left], y[left], depth - 1), Tree(x[~left], y[~left], depth - 1)

    def classify(self, x: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(x), self.value)
        left = x[:, self.feature] <= self.threshold
        out = np.empty(len(x), bool)
        out[left], out[~left] = self.low.classify(x[left]), self.high.classify(x[~left])
        return out


_TREE: list[Tree] = []


def tree() -> Tree:
    """The classifier, trained once per worker on the labelled table."""
    if not _TREE:
        _TREE.append(Tree(*labelled_table()))
    return _TREE[0]


def main_text(html: str | None) -> str:
    blocks = flat_blocks(html)
    if not blocks:
        return ""
    keep = tree().classify(features(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(t.as_py()) for t in column(batch, "html")]
        yield pa.RecordBatch.from_arrays([column(batch, "page_id"), column(batch, "url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars. Null and empty pages have an empty text; repeated rows, null ids and
    null urls stay as they are; other columns are ignored."""
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return arrow_map(base, _extract, "page_id long, url string, text string, n_chars long")
