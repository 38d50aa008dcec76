"""Parts that names would drop, odd markup in linear time, and a plain second implementation."""

import time
from html.parser import HTMLParser
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from loadlens.llm import html_text
from loadlens.llm.html_text import main_text

PROSE = "This is the text of an article that has been written for the test, and it is long enough. "
prose = PROSE.strip()
STORY = f"<h1>Title</h1><p>{PROSE}</p><p>{PROSE}</p><p>Short.</p>"
WANT = f"Title\n{prose}\n{prose}\nShort."


@pytest.mark.parametrize(
    "name", ["page nav-open", "menu-visible", "social", "widget", "legal", "has-sidebar", "modal-open wrap"]
)
def test_wrappers_with_state_classes(name):
    assert main_text(f'<body><div class="{name}">{STORY}</div></body>') == WANT
    assert main_text(f'<body><div id="{name}"><article>{STORY}</article><nav>{PROSE}</nav></div></body>') == WANT


def test_page_wide_forms():
    page = f"<body><form action=/x><input name=a><article>{STORY}</article><button>Go</button></form></body>"
    assert main_text(page) == WANT
    assert main_text(f"<body><article>{STORY}</article><form><p>{PROSE}</p></form></body>") == WANT


def test_named_parts_inside_wrappers_still_go():
    other = "".join(f'<div class="{n}"><p>{PROSE}</p></div>' for n in ("comments", "cookie-notice", "ad"))
    assert main_text(f'<body class="nav-open"><div class="nav-open"><div>{STORY}</div>{other}</div></body>') == WANT
    assert main_text(f"<body><div>{STORY}</div>{other}</body>") == WANT


def test_longer_comments_than_article():
    comments = f'<section class="comments">{f"<p>{PROSE}</p>" * 10}</section>'
    assert main_text(f"<body><article>{STORY}</article>{comments}</body>") == WANT


def test_a_page_that_is_all_in_a_named_part():
    assert main_text(f'<body><div class="comments">{STORY}</div></body>') == WANT
    assert main_text(f'<body><p>See.</p><div class="ad">{PROSE}</div><p>A short article of few words.</p></body>') == (
        "See.\nA short article of few words."
    )


@pytest.mark.parametrize(
    "bad",
    ["<span>x", "</b>", "<a x", "<div>x", "<!--", "<a x='", '<p class="', "<", "&", "<article>x", "<ul><li>x",
     "<table><tr><td>x", "<script>", "</p>", "<!", "<a =", "<form class=nav>x", "&#x", "<b><p>", "<h1>x</h2>"],
)
def test_a_megabyte_of_bad_markup(bad):
    page = bad * ((1 << 20) // len(bad))
    for text in (page, page + ">", f"<span>x{page}</b>" + "</b>" * 1000):
        began = time.process_time()
        main_text(text)
        assert time.process_time() - began < 6, bad


def test_mixed_open_and_stray_tags():
    began = time.process_time()
    main_text("<span>x" * 75_000 + "</b>" * 75_000 + "<div>" * 50_000 + "</i>" * 50_000)
    assert time.process_time() - began < 6


# The two passes again, over a tree, with every rule looked up by searching it.


class Node:
    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent = tag, {k: v or "" for k, v in reversed(attrs)}, parent

    def path(self):
        here = self
        while here.tag:
            yield here
            here = here.parent


class Tree(HTMLParser):
    """Runs of text with the element they are in, for pages whose elements are closed in order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.here, self.runs, self.lang = Node("", [], None), [], ""

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            self.lang = (dict(attrs).get("lang") or "")[:2].lower()
        if tag in html_text.BLOCK:
            self.close_open(("p",), stop=html_text.BLOCK - {"p"})
            self.runs.append(None)
        if tag in ("li", "td", "th", "tr", "dt", "dd"):
            self.close_open(html_text._ITEMS[tag], stop=html_text._LISTS)
        if tag == "br":
            self.runs.append((" ", self.here))
        if tag not in html_text.VOID:
            self.here = Node(tag, attrs, self.here)

    def close_open(self, tags, stop):
        for node in self.here.path():
            if node.tag in tags:
                self.here = node.parent
                self.runs.append(None)
                return
            if node.tag in stop:
                return

    def handle_endtag(self, tag):
        if tag in [n.tag for n in self.here.path()]:
            while self.here.tag != tag:
                self.here = self.here.parent
            self.here = self.here.parent
            if tag in html_text.BLOCK:
                self.runs.append(None)

    def handle_data(self, data):
        self.runs.append((data, self.here))


def plain_text(html):
    tree = Tree()
    tree.feed(html)
    tree.close()

    def gone(node):
        path = list(node.path())
        article = any(n.tag in html_text.CONTENT for n in path)
        hidden = [n for n in path if n.tag not in ("html", "body") and html_text._is_hidden(n.attrs)]
        return bool(hidden) or any(n.tag in html_text.DROPPED or (n.tag == "header" and not article) for n in path)

    blocks, now = [], []
    for run in [*tree.runs, None]:
        if run is not None:
            if not gone(run[1]):
                now.append(run)
            continue
        text = " ".join("".join(d for d, _ in now).split())
        if text:
            linked = sum(len(d.strip()) for d, n in now if any(x.tag == "a" for x in n.path()))
            blocks.append((text, linked, list(next(n for d, n in now if d.strip()).path())))
        now = []
    labels = [html_text.settle(html_text.Block(t, k, 0, False), tree.lang) for t, k, _ in blocks]

    def mass(inside):
        return sum(len(b[0]) for b, y in zip(blocks, labels, strict=True) if y is not False and inside(b[2]))

    named = {n for b in blocks for n in b[2] if html_text._other_part(n.tag, n.attrs)}
    total = mass(lambda path: True)
    out = {
        n
        for n in named
        if not any(y and n in b[2] for b, y in zip(blocks, labels, strict=True))
        or mass(lambda path, n=n: n in path) <= html_text._other_part(n.tag, n.attrs) * total
    }
    kept = [(b, y) for b, y in zip(blocks, labels, strict=True) if not out & set(b[2])]
    part = [next((n for n in b[2] if n.tag in html_text.CONTENT), None) for b, _ in kept]
    inside = sum(len(b[0]) for (b, y), p in zip(kept, part, strict=True) if y and p)
    outside = sum(len(b[0]) for (b, y), p in zip(kept, part, strict=True) if y and not p)
    lines = []
    for i, (b, y) in enumerate(kept):
        if y is None:
            near = [(abs(i - j), j > i, z) for j, (_, z) in enumerate(kept) if z is not None and part[j] is part[i]]
            y = min(near)[2] if near else True
        if y and (part[i] or not inside or inside < outside):
            lines.append(b[0])
    return "\n".join(lines)


def test_a_plain_second_implementation_agrees():
    place = Path("/root/testdata/sf0.01/pages.parquet")
    if not place.exists():
        pytest.skip("the given pages are not here")
    for page in pq.read_table(place, columns=["html"]).column(0).to_pylist():
        assert plain_text(page or "") == main_text(page or "")
