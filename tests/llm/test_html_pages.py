"""Main text of whole pages: hand-made layouts, and a plain version of the
block features on top of the standard library's HTML parser."""
from __future__ import annotations

import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from zonecast.llm import html_blocks, queries

A = "People came from far away on the first evening to see the pictures in the old hall by the river and stayed until the lights went out."
B = "Another paragraph with a good number of words follows here, so that the text of the page is plainly an article of a usual length."
PAGES = {
    "class beside content": (f"<div class='content has-sidebar'><h1>Title</h1><p>{A}</p><p>{B}</p></div>", ["Title", A, B]),
    "class of a wrapper": (f"<div id='page' class='with-header'><article><h1>Title</h1><p>{A}</p></article></div>", ["Title", A]),
    "subject in a class": (f"<div class='post social-studies'><p>{A}</p><p>Short.</p></div>", [A, "Short."]),
    "form around a page": (f"<form id=aspnetForm><div class=content><p>{A}</p><p>{B}</p></div></form>", [A, B]),
    "header of the entry": (f"<article><div class='entry-header'><h1>Title</h1></div><p>{A}</p></article>", ["Title", A]),
    "section with a name": (f"<article><p>{B}</p><section class='legal-analysis'><p>{A}</p><p>Short.</p></section></article>", [B, A, "Short."]),
    "linked sources": (f"<article><p>{B}</p><h2>Sources</h2><p><a href=x>A linked paper</a></p></article>", [B, "Sources", "A linked paper"]),
    "linked list": (f"<article><p>{B}</p><p>See also:</p><ul><li><a href=x>Other</a></li></ul></article>", [B, "See also:", "Other"]),
    "wrapper of a hint": (f"<div class='wrapper sidebar'><div class=content><p>{A}</p></div></div>", [A]),
    "notices without marks": (f"<div>We use cookies to improve your visit.</div><p>{A}</p><p>{B}</p><div>All rights reserved 2024.</div><div>Opening hours: Mon-Fri 9-17</div>", [A, B]),
    "boxes beside an article": (f"<div>We use cookies.</div><article><p>{A}</p></article><div>Open daily 9-17</div><div>{B}</div>", [A]),
    "article as comment": (f"<article><p>{A}</p></article><div class=comments-area><article class=comment-body><p>{B}</p></article></div>", [A]),
    "compound names": (f"<div class=site-header>Paper</div><div class=main-menu><a href=x>a</a></div><div id=main-content><p>{A}</p></div><div class=site-footer>F</div><div class=related-posts><article><p>{B}</p></article></div>", [A]),
    "inner main": (f"<div class='nav footer'><main><p>{A}</p></main></div><p>{B}</p>", [A]),
    "words of notices in an article": (f"<article><p>Cookies are sold.</p><p>{A}</p></article>", ["Cookies are sold.", A]),
    "list without marks": (f"<h1>T</h1><p>{A}</p><ul><li>one</li><li>two</li></ul><p>{B}</p>", ["T", A, "one", "two", B]),
    "menus without marks": (f"<ul><li><a href=a>Home</a></li><li><a href=b>All the news</a></li></ul><p>{A}</p><p>{B}</p><ul><li><a href=a>Home</a></li></ul>", [A, B]),
    "link between paragraphs": (f"<p>{A}</p><h2>Sources</h2><p><a href=x>A linked paper</a></p><p>{B}</p>", [A, "Sources", "A linked paper", B]),
    "one line": ("<p>Hello</p>", ["Hello"]),
}


@pytest.mark.parametrize("name", PAGES)
def test_layouts(name):
    html, want = PAGES[name]
    assert html_blocks.main_text(html, html_blocks.train_tree()).split("\n") == want


def test_tree_looks_at_neighbours():
    x, y = html_blocks.labelled_table()
    tree = html_blocks.train_tree()
    assert (html_blocks.classify(tree, x) == y).mean() > 0.99
    used, nodes = set(), [tree]
    while nodes:
        node = nodes.pop()
        if node.feature >= 0:
            used.add(html_blocks.FEATURES[node.feature])
            nodes += [node.low, node.high]
    assert {"words", "density"} < used and any("before" in u or "after" in u for u in used)


class Plain(HTMLParser):
    """Blocks of a well-formed page: [text, words in links, open elements]."""

    def __init__(self):
        super().__init__()
        self.open, self.blocks, self.new = [], [], True

    def handle_starttag(self, tag, attrs):
        self.open.append((tag, " ".join(f'{k}="{v}"' for k, v in attrs)))
        self.new = self.new or tag in html_blocks.BLOCKS

    def handle_endtag(self, tag):
        self.open.pop()
        self.new = self.new or tag in html_blocks.BLOCKS

    def handle_data(self, data):
        if any(t in html_blocks.SKIPPED for t, _ in self.open) or not data.split():
            return
        if self.new:
            self.blocks.append(["", 0, [x for x in self.open if x[0] in html_blocks.BLOCKS]])
            self.new = False
        last = self.blocks[-1]
        last[0] += data
        last[1] += len(data.split()) * any(t == "a" for t, _ in self.open)


def plain_hint(path, ends):
    """(inside, hint) of a block from the elements around it, outermost first."""
    inside = hint = 0
    for tag, attributes in path:
        i, h = html_blocks._container(tag, attributes, inside > 0)
        inside = max(inside, i)
        hint = 0 if i == 3 or i and h < 2 and hint <= ends else max(hint, h)
    return inside, hint


def plain_main_text(html, tree):
    parser = Plain()
    parser.feed(html or "")
    blocks = [(" ".join(t.split()), linked, path) for t, linked, path in parser.blocks]
    size = lambda k: len(blocks[k][0].split()) if 0 <= k < len(blocks) else 0
    density = lambda k: blocks[k][1] / size(k) if size(k) else 0.0
    strict = [plain_hint(path, 1) for _, _, path in blocks]
    marks = strict if any(i and not h for i, h in strict) else [plain_hint(path, 2) for _, _, path in blocks]
    plain_words = lambda want: sum(size(k) - blocks[k][1] for k, (i, h) in enumerate(marks) if not h and (i or not want))
    marked = any(i > 1 and not h for i, h in marks) or 2 * plain_words(True) >= plain_words(False) > 0
    kept = []
    for k, (text, _, path) in enumerate(blocks):
        row = {"words": size(k), "density": density(k)}
        for n in (1, 2):
            row |= {f"words_before_{n}": size(k - n), f"density_before_{n}": density(k - n), f"words_after_{n}": size(k + n), f"density_after_{n}": density(k + n)}
        i, h = marks[k]
        row |= {"heading": any(t in html_blocks.HEADINGS for t, _ in path[-3:]), "notice": len(html_blocks.NOTICE.findall(text)) / size(k)}
        row |= {"article": (1 if i and h < 2 else -1) if marked else 0, "hint": h}
        node = tree
        while node.feature >= 0:
            node = node.low if row[html_blocks.FEATURES[node.feature]] <= node.cut else node.high
        if node.main:
            kept.append(text)
    return "\n".join(kept)


def random_page(rng: random.Random) -> str:
    words = lambda: " ".join(rng.choice("river mill bridge cookies copyright town loud gr&uuml;n &lt;b old".split()) for _ in range(rng.choice((1, 2, 5, 16, 30))))
    names = ["", "", "", " class=content", " class='sidebar'", " class='nav wide'", " id=comments", " class='post has-sidebar'", " role=main", " class=legal", " class='site-header'", " class='entry-header'"]

    def piece(depth: int) -> str:
        kind = rng.random()
        if depth == 0 or kind < 0.45:
            text = words()
            text = f"<a href=x>{text}</a>" if rng.random() < 0.3 else f"{text} <b>{words()}</b>" if rng.random() < 0.2 else text
            return "<{0}>{1}</{0}>".format(rng.choice(("p", "p", "h2", "li", "td")), text)
        if kind < 0.5:
            return f"<script>var a = '{words()}';</script>"
        tag = rng.choice("div div div section article main nav aside footer header form ul".split())
        return f"<{tag}{rng.choice(names)}>" + "".join(piece(depth - 1) for _ in range(rng.randint(0, 4))) + f"</{tag}>"

    return "<body>" + "".join(piece(3) for _ in range(rng.randint(0, 6))) + "</body>"


def test_pages_against_the_plain_version(spark):
    rng = random.Random(5)
    tree = html_blocks.train_tree()
    pages = [random_page(rng) for _ in range(1500)]
    frame = spark.createDataFrame([(k, "u", html) for k, html in enumerate(pages)], "page_id long, url string, html string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_blocks.extract_pages(frame).collect()}
    want = [plain_main_text(html, tree) for html in pages]
    assert got == {k: (text, len(text)) for k, text in enumerate(want)}
    assert 500 < sum(map(bool, want))


def test_query_gives_the_articles(spark):
    """The pages of the smallest table hold the text in one article element."""
    folder = "/root/testdata/sf0.001"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = queries.op1_html_blocks(spark, folder)
    assert got.where(F.col("n_chars") != F.length("text")).count() == 0
    for row in got.collect():
        html = pages[row["page_id"]]
        article = html_blocks.text_blocks(html[html.index("<article"):html.index("</article")])
        assert row["text"] == "\n".join(b.text for b in article)
