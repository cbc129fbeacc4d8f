"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into flat text blocks at block-level tags. A block's features
are its word count and link density, those of the two blocks before and after
it, whether it is a heading, its share of phrases that notices use, whether it
stands in the page's article, and how strongly the elements around it hint
that it stands outside (0 no hint, 1 a weak class word, a form or a page
header, 2 a plain class word such as ``sidebar``, 3 an element such as ``nav``
or a class word of comments and related links). A decision tree grown from
``LABELLED_PAGES`` weighs them. Class and id names count as whole names:
``has-sidebar``, ``entry-header`` or ``social-studies`` hint nothing.

An inner ``main`` ends every outer hint, an inner article or content class a
weak one; on a page without any other article also a plain class word's, so a
wrapper's class does not cost the article.

Defined cases: a null or empty page, and one without text, give an empty
text; unclosed comments, scripts and elements end with the page; equal pages
give equal texts; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import byte_slices

#: Elements whose content is never text of the page.
SKIPPED = ("script", "style", "noscript", "template", "textarea", "title", "svg", "math", "iframe", "select", "button", "object", "canvas", "audio", "video")
#: Elements that separate blocks.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol p pre search section summary table caption "
    "tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Elements that hint at what is not main text, and class or id words by the
#: strength of their hint.
OUTSIDE_TAGS = {"nav": 3, "footer": 3, "aside": 3, "menu": 3, "dialog": 3, "head": 3, "fieldset": 3, "search": 3, "form": 1}
OUTSIDE_WORDS = {
    **dict.fromkeys("comment comments reply replies respond disqus related recommended".split(), 3),
    **dict.fromkeys(
        "ad ads adv advert adverts advertisement sponsor sponsored cookie cookies popup modal newsletter subscribe signup nav navbar "
        "navigation menu breadcrumb breadcrumbs sidebar share sharing footer toolbar pagination pager".split(), 2),
    **dict.fromkeys(
        "header masthead banner topbar notice notification alert consent promo promotion legal copyright disclaimer social side widget "
        "form search login discussion".split(), 1),
}
INSIDE_TAGS = {"article": 2, "main": 3}
INSIDE_WORDS = frozenset("article content main post entry story body text".split())
#: Words that say nothing of their own in a name such as ``site-footer``.
LAYOUT_WORDS = frozenset("site page top bottom left right list area box bar section block wrapper container links posts inner outer global primary secondary".split())
_ROLES = {"navigation": 3, "banner": 1, "contentinfo": 3, "complementary": 3, "search": 3, "form": 1, "dialog": 3, "alert": 1}
#: Phrases of notices, in the languages of the pages.
NOTICE = re.compile(
    r"\b(?:we use cookies|cookies?|all rights reserved|alle rechte vorbehalten|tous droits r\u00e9serv\u00e9s|todos los derechos reservados|copyright"
    r"|privacy policy|terms of (?:use|service)|imprint|impressum|newsletter|subscribe|sign (?:up|in)|log ?in|follow us|share this|opening hours"
    r"|mon(?:day)?\s?[-\u2013]\s?(?:fri|sat|sun)(?:day)?|filed under|contact us)\b|\u00a9",
    re.I,
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(" + "|".join(SKIPPED) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME_WORDS = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    words: int
    linked: int  # words inside links
    heading: bool
    inside: int  # 0, or the strongest mark of an open article: 1 class, 2 article, 3 main
    hint: int  # how strongly the elements around it hint that it is outside
    lenient: int  # the same if an article also ends plain class words

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


def _name_hint(name: str, in_article: bool) -> int:
    """Hint of one class or id name; every part of it must be known."""
    parts = _NAME_WORDS.findall(name)
    hint = max((OUTSIDE_WORDS.get(x, 0) for x in parts), default=0)
    if not hint or any(x not in OUTSIDE_WORDS and x not in LAYOUT_WORDS and x not in INSIDE_WORDS for x in parts):
        return 0
    if "header" in parts and hint == 1 and (in_article or not INSIDE_WORDS.isdisjoint(parts) and "main" not in parts):
        return 0  # the article's own header
    return hint


def _container(tag: str, attributes: str, in_article: bool) -> tuple[int, int]:
    """(inside, hint) that an element sets by itself."""
    inside, hint = INSIDE_TAGS.get(tag, 0), OUTSIDE_TAGS.get(tag, 0)
    if tag == "header" and not in_article:
        hint = 1
    if attributes and tag not in ("body", "html"):
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            value = (a or b or c).lower()
            if name.lower() == "role":
                role = value.strip()
                inside, hint = max(inside, INSIDE_TAGS.get(role, 0)), max(hint, _ROLES.get(role, 0))
                continue
            for token in value.split():
                hint = max(hint, _name_hint(token, in_article))
                if INSIDE_WORDS.issuperset(_NAME_WORDS.findall(token)) and _NAME_WORDS.search(token):
                    inside = max(inside, 1)
    return inside, hint


def _nested(mark: tuple[int, int], outer: int, ends: int) -> int:
    """Hint inside an element with ``mark`` under an ``outer`` hint: a main
    ends any hint, an article or content class one of at most ``ends``."""
    inside, hint = mark
    if inside == 3 or inside and outer <= ends and hint < 2:
        return 0
    return max(outer, hint)


def text_blocks(html: str) -> list[Block]:
    """Blocks with text, in page order."""
    out: list[Block] = []
    pieces: list[str] = []
    linked: list[str] = []
    # open elements that matter, with the marks that hold inside them
    stack: list[tuple[str, int, int, int]] = []
    links = 0

    def close_block() -> None:
        if pieces:
            words = unescape("".join(pieces)).split()
            if words:
                out.append(Block(
                    " ".join(words), len(words), sum(len(unescape(x).split()) for x in linked),
                    any(x[0] in HEADINGS for x in stack[-3:]), *(stack[-1][1:] if stack else (0, 0, 0)),
                ))
            pieces.clear()
            linked.clear()

    def text(part: str) -> None:
        if part:
            pieces.append(part)
            if links:
                linked.append(part)

    at = 0
    for m in _TOKEN.finditer(html):
        text(html[at:m.start()])
        at = m.end()
        tag = m.group(3)
        if tag is None:
            if m.group(1) and m.group(1).lower() not in ("svg", "math", "button", "select"):
                close_block()
            continue
        tag = tag.lower()
        if tag == "br":
            text(" ")
        elif tag == "a":
            links = max(0, links - 1) if m.group(2) else 1
        elif tag in BLOCKS:
            close_block()
            links = 0
            if tag in VOID:
                continue
            if not m.group(2):
                if tag == "p" or tag in HEADINGS:  # these do not nest
                    while stack and (stack[-1][0] == "p" or stack[-1][0] in HEADINGS):
                        stack.pop()
                _, inside, hint, lenient = stack[-1] if stack else (tag, 0, 0, 0)
                mark = _container(tag, m.group(4), inside > 0)
                stack.append((tag, max(inside, mark[0]), _nested(mark, hint, 1), _nested(mark, lenient, 2)))
            else:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
                    if tag == "p" and stack[k][0] not in ("p", *HEADINGS):
                        break
    text(html[at:])
    close_block()
    return out


NEIGHBOURS = 2
FEATURES = (
    "words", "density", *(f"{x}_{side}_{n}" for n in range(1, NEIGHBOURS + 1) for side in ("before", "after") for x in ("words", "density")),
    "heading", "notice", "article", "hint",
)


def page_marks(blocks: list[Block]) -> list[tuple[int, int]]:
    """(article, hint) of every block. Article is 1 inside the page's article,
    -1 outside it, 0 on a page without one. A content class makes an article
    only if it holds at least half of the plain words that no element hints
    to be outside; an article or main element always does."""
    strict = any(b.inside and not b.hint for b in blocks)
    hints = [b.hint if strict else b.lenient for b in blocks]
    free = [(b.inside, b.words - b.linked) for b, h in zip(blocks, hints) if not h]
    marked = any(i > 1 for i, _ in free) or 2 * sum(w for i, w in free if i) >= sum(w for _, w in free) > 0
    return [((1 if b.inside and h < 2 else -1) if marked else 0, h) for b, h in zip(blocks, hints)]


def block_features(blocks: list[Block]) -> np.ndarray:
    """One row per block; a missing neighbour has no words and no links."""
    own = np.array([(b.words, b.density) for b in blocks], dtype=float).reshape(-1, 2)
    edge = np.zeros((NEIGHBOURS, 2))
    wide = np.concatenate((edge, own, edge))
    n = len(own)
    near = [wide[NEIGHBOURS + k:NEIGHBOURS + k + n] for d in range(1, NEIGHBOURS + 1) for k in (-d, d)]
    rest = np.array(
        [(b.heading, len(NOTICE.findall(b.text)) / b.words, *marks) for b, marks in zip(blocks, page_marks(blocks))], dtype=float,
    ).reshape(-1, 4)
    return np.concatenate((own, *near, rest), axis=1)


# ---- decision tree -----------------------------------------------------------
@dataclass
class Node:
    feature: int = -1
    cut: float = 0.0
    low: "Node | None" = None
    high: "Node | None" = None
    main: bool = False


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 2) -> Node:
    """Binary tree by Gini impurity; ties go to the first feature and cut."""
    node = Node(main=bool(2 * y.sum() > len(y)))
    if depth == 0 or len(y) < 2 * least or y.min() == y.max():
        return node
    best = None
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, j] <= cut
            n, m = low.sum(), (~low).sum()
            if min(n, m) < least:
                continue
            p, q = y[low].mean(), y[~low].mean()
            impurity = n * p * (1 - p) + m * q * (1 - q)
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, j, cut, low)
    if best is None:
        return node
    _, node.feature, node.cut, low = best
    node.low, node.high = grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)
    return node


def classify(node: Node, x: np.ndarray) -> np.ndarray:
    if node.feature < 0:
        return np.full(len(x), node.main)
    low = x[:, node.feature] <= node.cut
    out = np.zeros(len(x), dtype=bool)
    out[low] = classify(node.low, x[low])
    out[~low] = classify(node.high, x[~low])
    return out


_LONG = "The committee met in the old town hall on Monday evening and spoke for three hours about the bridge, its cost and who should pay for it."
_MORE = "Members of the public asked several questions, most of which concerned noise, traffic at night and the state of the river banks below the mill."
_LINKS = "<li><a href=a>Home</a></li><li><a href=b>Town news</a></li><li><a href=c>Sport</a></li>"
_STORIES = "<li><a href=d>Fire in the old mill</a></li><li><a href=e>Council votes on the new bridge today</a></li><li><a href=f>Rain</a></li><li><a href=g>All about our paper</a></li>"
_COOKIES = "We use cookies to make this site work better."
#: The labelled table: pages whose main blocks begin with a plus sign.
LABELLED_PAGES: tuple[str, ...] = (
    # marked articles between marked and unmarked surroundings
    f"<body><nav><ul>{_LINKS}</ul></nav><div class=ad>Buy new shoes at half the price today.</div><article><h1>+Bridge debate</h1><p>+{_LONG}</p><p>+{_MORE}</p><p>+Yes.</p></article><footer>&copy; Town Gazette &middot; All rights reserved by the publisher.</footer></body>",
    f"<header><a href=/>Gazette</a></header><main><h2>+River</h2><p>+{_MORE}<p>+No comment.<p>+{_LONG}</main><aside><h3>Read on</h3><p>{_LONG}</p></aside><footer><a href=/i>Imprint</a></footer>",
    f"<div id=menu><a href=a>One</a> <a href=b>Two</a></div><div class=content><h1>+Title here</h1><p>+{_LONG}</p><ul><li>+First point</li><li>+Second point</li></ul><blockquote>+{_MORE}</blockquote></div><div class=comments><h3>Reader comments</h3><p>{_LONG}</p><p>I agree.</p></div><div class=footer>Contact us</div>",
    f"<div class='cookie notice'>{_COOKIES} {_LONG}</div><form><p>Your name and your message to the editor of this paper</p><label>E-mail</label></form><article><p>+{_LONG}</p><p>+Hm.</p><p><a href=x>+A linked sentence that belongs to the article</a></p><section class=comments><p>{_MORE}</p></section></article>",
    f"<div class=sidebar><p>{_LONG}</p><p>{_MORE}</p></div><div class=post><h2>+Notes</h2><p>+Short.</p><p>+{_MORE}</p><p>+Also short here.</p></div><div class=related><a href=r>Related story about mills</a></div>",
    f"<article><header><h1>+Report</h1></header><p>+{_LONG}</p><div class=advert>Cheap flights to the sea, book now.</div><p>+{_MORE}</p><footer>Filed under news</footer></article><div role=complementary><p>{_LONG}</p></div>",
    f"<main><p>+One.</p><p>+Two words.</p><p>+{_LONG}</p><p>+Three more words.</p><nav><a href=q>Back to the list</a></nav></main><nav><a href=1>1</a><a href=2>2</a></nav>",
    f"<div>{_COOKIES}</div><article><h1>+Cookies in the news</h1><p>+{_LONG}</p><h2>+Sources</h2><p><a href=s>+Minutes of the committee</a></p><p>+See also:</p><ul><li><a href=u>+The older bridge</a></li></ul></article><div>Opening hours: Monday - Friday, nine to five</div><div>Copyright Gazette, all rights reserved.</div>",
    f"<article><p>+{_COOKIES} That was all the page said.</p><p>+Copyright is a right.</p><p><a href=x>+Cookies</a></p></article><div>{_LONG}</div><p>{_MORE}</p>",
    f"<div><p>{_MORE}</p></div><main><h1><a href=t>+A linked title</a></h1><p>+Sign up was slow.</p></main><div><h3>Most read</h3><p>{_LONG}</p></div>",
    "<nav><a href=a>Home</a></nav><article><h1>+Hm</h1><p>+Yes.</p></article><div class=ad>Now at half the price: shoes for all.</div><footer>Town Gazette</footer>",
    f"<article><h1>+Weir report</h1><p>+{_MORE}</p><h2>+Sources</h2><p><a href=s>+Minutes of the committee</a></p></article><ul>{_LINKS}</ul>",
    f"<main><p>+{_LONG}</p><p>+See also:</p><ul><li><a href=u>+The older bridge</a></li><li><a href=v>+Weir</a></li><li><a href=w>+Mill and river</a></li></ul></main>",
    f"<article><p><a href=a>+First link</a></p><p>+{_LONG}</p><div class=share><a href=b>Send this on</a></div><p><a href=c>+A link of the text</a></p></article>",
    f"<article><ol><li><a href=a>+The first of all the links in this text</a></li><li><a href=b>+Weir</a></li><li><a href=c>+Minutes of the committee</a></li><li><a href=d>+Town and river plan</a></li></ol><div class=share><a href=e>Send this on to all your friends</a> <a href=f>Print</a></div><div class=widget><a href=g>Rain later in the day</a></div></article>",
    f"<article><p>+{_MORE}</p><div class=social><ul>{_LINKS}</ul></div><p><a href=a>+The whole plan as a table</a></p><p>+{_LONG}</p><div class=promo><a href=b>Read the paper for a month</a></div></article>",
    f"<article><p>+{_LONG}</p><p>+Cookies are sold.</p><p>+{_MORE}</p><p>+Copyright is a right.</p><p>+{_LONG}</p><h2>+Opening hours</h2><p>+{_MORE}</p><p>+Contact us</p><div class=notice>{_COOKIES}</div><div class=copyright>Copyright Gazette</div></article>",
    # wrappers whose class is a plain or weak hint, and weak hints around long text
    f"<div class=sidebar><article><h1>+Flood report</h1><p>+{_LONG}</p><p>+{_MORE}</p></article></div><aside><p>{_LONG}</p></aside>",
    f"<form id=all><div class=content><h1>+Mill report</h1><p>+{_MORE}</p><p>+Done.</p></div></form>",
    f"<article><section class=legal><h2>+The case</h2><p>+{_LONG}</p><p>+{_MORE}</p></section><section class=discussion><p>+{_MORE}</p><p>+{_LONG}</p></section></article>",
    f"<article><p>+{_LONG}</p><div class=notice>Read our new app.</div><p>+{_MORE}</p><div class=social>Follow us here</div><div class=promo><a href=a>Join the club today</a></div><form><p>Your e-mail</p></form></article>",
    f"<form><div><h1>+Harvest</h1><p>+{_LONG}</p><p>+{_MORE}</p><p>+{_LONG}</p></div></form>",
    f"<div class=header><p>The paper of the town</p></div><div><p>+{_LONG}</p><p>+{_MORE}</p></div><div class=widget><p>Weather: rain later</p></div><div class=login>Log in here</div>",
    "<div class=header>Gazette</div><form><p>Your name</p><p>Your message to us</p></form><div class=banner>Sale of the week</div>",
    f"<div class=footer><p>{_LONG}</p></div><div class=comments><p>{_MORE}</p><p>Nice.</p><p>{_LONG}</p></div><nav><p>{_LONG}</p></nav><p>+{_MORE}</p><p>+{_LONG}</p>",
    # no marks at all: words, links and neighbours decide
    f"<table><tr><td><a href=a>News</a></td><td><a href=b>Weather today</a></td></tr><tr><td>+{_LONG}</td></tr><tr><td>+{_MORE} {_LONG}</td></tr><tr><td><a href=c>Next page of results</a></td></tr></table>",
    f"<p><a href=a>Start</a> <a href=b>Archive</a> <a href=c>About us</a></p><h1>+Harvest report</h1><p>+{_LONG}</p><p>+{_MORE}</p><p>Copyright Gazette</p><p><a href=d>Terms of use</a></p>",
    f"<div><div>+{_LONG}</div><div>+{_MORE}</div></div><div><a href=p>Previous</a></div><div><a href=n>Next</a></div>",
    f"<ul>{_LINKS}</ul><h1>+Bridge</h1><p>+{_LONG}</p><p>+No.</p><p>+{_MORE}</p><h2>+Sources</h2><p><a href=s>+Minutes of the committee</a></p><p>+{_LONG}</p><ul>{_LINKS}</ul>",
    f"<ul>{_LINKS}</ul><h1>+Mill</h1><p>+{_MORE}</p><p>+See also:</p><ul><li><a href=x>+The older mill</a></li></ul><p>+{_LONG}</p><p>+{_MORE}</p><div>{_COOKIES}</div><div>All rights reserved.</div>",
    f"<div>{_COOKIES}</div><ul>{_LINKS}</ul><p>+{_LONG}</p><p>+Not so.</p><p>+{_MORE}</p><div>Opening hours: Mon-Fri nine to five</div><div>Contact us</div>",
    f"<p>+{_LONG}</p><p>+The council has a cookie shop and a privacy policy, said the mayor, and all rights reserved for the town will stay where they are in the next year.</p><p>+{_MORE}</p>",
    f"<ul>{_LINKS}</ul><p>+{_LONG}</p><p>+{_MORE}</p><h2>+Sources</h2><p><a href=s>+Minutes of the committee</a></p><div>Copyright Gazette</div><div><a href=d>Terms of use</a></div>",
    f"<h1>+Weir</h1><p>+{_MORE}</p><p>+See also:</p><ul><li><a href=u>+The older weir</a></li></ul><ul>{_LINKS}</ul>",
    f"<p>+{_MORE}</p><p>+{_LONG}</p><ul>{_LINKS}</ul>",
    f"<h1>+Mill</h1><p>+{_LONG}</p><ul><li>+Wheel</li><li>+Race</li><li>+Stone</li><li>+Grain store</li></ul><p>+{_MORE}</p><p>+No.</p><p>+Yes.</p><p>+{_LONG}</p>",
    f"<div><a href=a>Start</a></div><div><a href=b>Archive of older pages</a></div><h1>+Weir</h1><p>+Yes.</p><p>+{_LONG}</p><p>+No.</p><div><a href=c>On</a></div>",
    f"<table><tr><td>+Year</td><td>+Loads</td></tr><tr><td>+1901</td><td>+12</td></tr><tr><td>+1902</td><td>+14</td></tr></table><p>+{_MORE}</p><p><a href=a>Start</a> <a href=b>News</a></p>",
    f"<ul>{_STORIES}</ul><h1>+Harvest</h1><p>+{_MORE}</p><p>+{_LONG}</p><h2>+Sources</h2><p><a href=s>+Minutes of the harvest meeting</a></p><p>+{_MORE}</p><ul>{_STORIES}</ul>",
    f"<ul>{_STORIES}</ul><p>+{_LONG}</p><ul>{_STORIES}</ul><p>+{_MORE}</p><div>{_COOKIES}</div><ul>{_STORIES}</ul>",
    f"<div><a href=a>All pages of the paper</a></div><div><p>+{_LONG}</p><h3>+Links</h3><p><a href=b>+Plan of the mill</a></p></div><ul>{_STORIES}</ul>",
    "<p>+Hello</p>",
    "<p>+Yes.</p><p>+No.</p><p>+Perhaps.</p>",
    f"<ul>{_LINKS}</ul><p>+Yes.</p><p>+Rain later in the day.</p><ul>{_LINKS}</ul>",
    "<p>+Only one short line.</p>",
    "<h1>+A title</h1><p>+Two short lines.</p><p>+No more than that.</p>",
    f"<ul>{_LINKS}</ul><div><a href=z>Archive of older pages</a></div><div>{_COOKIES}</div><div>Log in</div>",
)


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    pages = [text_blocks(html) for html in LABELLED_PAGES]
    return np.concatenate([block_features(blocks) for blocks in pages]), np.array([b.text.startswith("+") for blocks in pages for b in blocks], dtype=float)


def train_tree() -> Node:
    return grow(*labelled_table())


def main_text(html: str | None, tree: Node) -> str:
    blocks = text_blocks(html or "")
    if not blocks:
        return ""
    return "\n".join(b.text for b, ok in zip(blocks, classify(tree, block_features(blocks))) if ok)


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` ``page_id``, ``url``, ``text``, ``n_chars``: one
    pass in Arrow batches, no shuffle."""
    tree = train_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "html"):
            texts = [main_text(h, tree) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column("page_id"), "url": batch.column("url"),
                "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            })

    view = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return view.mapInArrow(run, "page_id long, url string, text string, n_chars long")
