"""Main text of web pages: blocks are judged by rules, and unsettled ones by their neighbours."""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.llm.common import text_of

# Elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "head script style noscript template svg math iframe object canvas audio video nav aside footer "
    "button select option textarea input label menu dialog map".split()
)
RAW = frozenset("script style textarea title".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search alert dialog form menu menubar toolbar".split()
)
CONTENT = frozenset("article main".split())
# Words of class and id that name parts other than the article.
_WORDS = (
    r"(?:ads?|advert\w*|adverti[sz]ement|sponsor\w*|promo\w*|banner|nav|navbar|navigation|"
    r"menu|breadcrumbs?|side-?bar|footer|cookies?|consent|gdpr|notices?|alert|pop-?up|modal|overlay|"
    r"comments?|commentlist|replies|respond|disqus|share|sharing|social|related|recommended|"
    r"newsletter|subscribe|signup|login|widget|toolbar|skip-link|copyright|legal)(?:$|[\s_-])"
)
_NAMED = re.compile(r"(?:^|[\s_-])" + _WORDS, re.I)
#: What a class begins with: "comment-body", but not "has-comments" or "tag-legal".
_BEGINS = re.compile(r"(?:^|\s)" + _WORDS, re.I)
#: Words of a state or a look, which wrappers of whole pages have too.
_STATES = re.compile(r"(?:^|\s)(?:nav|menu|navigation|banner|alert|notices?|overlay|modal|widget|social|legal|toolbar)[_-]", re.I)
# The most frequent words of four languages.
STOP_WORDS = {
    "en": "the of and to a in is that for it as was with be by on not he i this are or his from at "
    "which but have an had they you were their one all we can her has there been if",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es "
    "an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il "
    "sont avec son aux mais comme ou si leur y dont tout nous sa elle",
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus le "
    "ya o este sí porque esta entre cuando muy sin sobre también me hasta",
}
_STOP = {k: frozenset(v.split()) for k, v in STOP_WORDS.items()}
_ANY_STOP = frozenset().union(*_STOP.values())
_WORD = re.compile(r"[^\W\d_]+")

#: A block with a larger share of its characters in links is not text.
MOST_LINKS = 0.4
#: A block of this length with this share of stop words is text. Shorter ones are unsettled.
LONG, STOP_SHARE = 70, 0.08
#: A part that is named as something else counts after all if it holds more than this share of the
#: text of its page: by a doubtful name, or by a plain one.
DOUBTFUL, PLAIN = 0.5, 0.9
#: Without stop words (another script or language), a block of this length is text.
VERY_LONG = 200


class Block(NamedTuple):
    text: str
    linked: int  # characters within links
    part: int  # number of the innermost article, main or body
    content: bool  # whether that is an article or main
    named: int = 0  # number of the innermost part that is named as something else


class Page(NamedTuple):
    blocks: list[Block]
    lang: str
    #: For each such part, from 1 on: the one around it, and the share of text that makes it count.
    named: list[tuple[int, float]]


#: Markup: a comment, a declaration, or a tag with its attributes. A quotation mark that is not closed
#: is a character, so a tag ends at the next ">" at the latest.
_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*>|</[^a-zA-Z>][^>]*>|</>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')|=)*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s/=>][^\s/=>]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")


def _attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        value = m[2] or ""
        if value[:1] in ("'", '"') and len(value) > 1 and value[-1] == value[0]:
            value = value[1:-1]
        found.setdefault(m[1].lower(), unescape(value))
    return found


class _Blocks:
    """The blocks of a page outside the elements that are dropped whole.

    Open elements are a stack. Where the last of a kind is, is kept beside it, so that closing one
    never searches the stack, and a page of any shape takes time in proportion to its length.
    """

    def __init__(self):
        self.blocks: list[Block] = []
        self.lang = ""
        self.open: list[tuple[str, bool, bool, bool]] = []  # tag, dropped, named, content
        self.places: dict[str, list[int]] = defaultdict(list)  # of open elements, by tag
        self.block_places: list[int] = []
        self.scopes: list[int] = []  # blocks other than p
        self.lists: list[int] = []
        self.dropped = self.links = self.inside = 0
        self.parts = [0]
        self.made = 0
        self.named: list[tuple[int, float]] = [(0, 0.0)]
        self.within = [0]
        self.text: list[str] = []
        self.linked = 0

    def feed(self, html: str) -> None:
        end = html.rfind(">") + 1  # beyond it no tag is complete
        tail = html[end:]
        at = 0
        while m := _MARKUP.search(html, at, end):
            if m.start() > at:
                self.data(html[at : m.start()])
            at = m.end()
            if not m[2]:
                if m[0].startswith("<!--") and not m[0].endswith(">"):
                    tail = ""
                continue
            tag = m[2].lower()
            if m[1]:
                self.end(tag)
                continue
            self.start(tag, _attributes(m[3]) if m[3] else {})
            if tag in RAW:
                close = _RAW_ENDS[tag].search(html, at)
                if not close:  # to the end of the page
                    at, tail = end, html[end:] if tag == "title" else ""
                    break
                if tag == "title":
                    self.data(html[at : close.start()])
                at = close.start()
        broken = _BROKEN.search(tail)
        rest = html[at:end] + (tail[: broken.start()] if broken else tail)
        if rest:
            self.data(rest)
        self._pop(0)
        self._flush()

    def _flush(self) -> None:
        text = " ".join(unescape("".join(self.text)).split())
        if text:
            part, named = self.parts[-1], self.within[-1]
            self.blocks.append(Block(text, self.linked, part, self.inside > 0, named))
        self.text, self.linked = [], 0

    def _push(self, tag: str, dropped: bool, share: float, content: bool) -> None:
        place = len(self.open)
        self.open.append((tag, dropped, share > 0, content))
        self.places[tag].append(place)
        for kind, where in ((BLOCK, self.block_places), (_P_SCOPE, self.scopes), (_LISTS, self.lists)):
            if tag in kind:
                where.append(place)
        self.dropped += dropped
        self.links += tag == "a"
        self.inside += content
        if share:
            self.named.append((self.within[-1], share))
            self.within.append(len(self.named) - 1)
        if content:
            self.made += 1
            self.parts.append(self.made)

    def _pop(self, count: int) -> None:
        """Close the elements from position ``count`` on."""
        if self.block_places and self.block_places[-1] >= count:
            self._flush()
        while len(self.open) > count:
            tag, dropped, named, content = self.open.pop()
            self.places[tag].pop()
            self.dropped -= dropped
            self.links -= tag == "a"
            self.inside -= content
            if named:
                self.within.pop()
            if content:
                self.parts.pop()
        for where in (self.block_places, self.scopes, self.lists):
            while where and where[-1] >= count:
                where.pop()

    def _close_nearest(self, tags: frozenset, until: list[int]) -> None:
        """Close the last open element of ``tags``, unless one of ``until`` is inside it."""
        last = max((self.places[t][-1] for t in tags if self.places[t]), default=-1)
        if last >= 0 and (not until or last >= until[-1]):
            self._pop(last)

    def start(self, tag: str, named: dict[str, str]) -> None:
        if tag == "html":
            self.lang = named.get("lang", "").lower()[:2]
        if tag in BLOCK:
            self._close_nearest(_P, self.scopes)
            if tag in _ITEMS:
                self._close_nearest(_ITEMS[tag], self.lists)
            if tag == "body":
                self._close_nearest(_HEAD, [])
            self._flush()
        if tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        dropped = tag in DROPPED or (tag not in ("html", "body") and _is_hidden(named))
        if tag == "header" and not self.inside:
            dropped = True
        self._push(tag, dropped, 0.0 if dropped else _other_part(tag, named), tag in CONTENT)

    def end(self, tag: str) -> None:
        places = self.places.get(tag)
        if places:
            inline = tag not in BLOCK and tag not in DROPPED
            if not (inline and self.block_places and self.block_places[-1] > places[-1]):
                self._pop(places[-1])

    def data(self, data: str) -> None:
        if not self.dropped:
            self.text.append(data)
            if self.links:
                self.linked += len(unescape(data).strip())


def _is_hidden(named: dict[str, str]) -> bool:
    if not named:
        return False
    style = named.get("style", "").replace(" ", "").lower()
    return "hidden" in named or named.get("aria-hidden") == "true" or "display:none" in style


def _other_part(tag: str, named: dict[str, str]) -> float:
    """The share of its page's text that makes an element count, 0 if nothing speaks against it."""
    if tag in ("html", "body"):
        return 0.0
    if named.get("role", "").lower() in ROLES:
        return PLAIN
    if tag == "main":  # the one main part of a page, whatever its name
        return 0.0
    names = [named.get("class", ""), named.get("id", "")]
    if any(_BEGINS.search(n) and not _STATES.search(n) for n in names):
        return PLAIN
    if tag == "form" or any((_BEGINS if tag == "article" else _NAMED).search(n) for n in names):
        return DOUBTFUL
    return 0.0


_P, _HEAD = frozenset(["p"]), frozenset(["head"])
_P_SCOPE = BLOCK - _P
_LISTS = frozenset("ul ol dl menu table".split())
_ITEMS = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
}
_RAW_ENDS = {tag: re.compile(f"</{tag}(?=[\\s/>])", re.I) for tag in RAW}
_BROKEN = re.compile(r"<[a-zA-Z/!?]")


def parse(html: str) -> Page:
    parser = _Blocks()
    parser.feed(html)
    return Page(parser.blocks, parser.lang, parser.named)


def without_other_parts(page: Page) -> list[Block]:
    """The blocks outside parts that are named as something else.

    A name alone drops nothing that a page consists of: a part counts if the first pass settles some
    of it as text, and if it holds more than its share of all that the pass does not settle as other
    than text; so do the parts around it.
    """
    held, settled = [0] * len(page.named), [False] * len(page.named)
    for b in page.blocks:
        own = settle(b, page.lang)
        held[b.named] += len(b.text) if own is not False else 0
        settled[b.named] |= own is True
    for k in range(len(held) - 1, 0, -1):  # a part comes after the one around it
        around = page.named[k][0]
        held[around] += held[k]
        settled[around] |= settled[k]
    counts = [True] * len(held)
    for k in range(1, len(held)):
        around, share = page.named[k]
        counts[k] = counts[around] and settled[k] and held[k] > share * held[0]
    return [b for b in page.blocks if counts[b.named]]


def settle(block: Block, lang: str) -> bool | None:
    """First pass: text (True), not text (False), or unsettled (None)."""
    text = block.text
    if block.linked > MOST_LINKS * len(text) or text.startswith(("©", "(c) ")):
        return False
    if len(text) < LONG:
        return None
    words = _WORD.findall(text.lower())
    stop = _STOP.get(lang, _ANY_STOP)
    if words and sum(w in stop for w in words) >= STOP_SHARE * len(words):
        return True
    return True if len(text) >= VERY_LONG else None


def classify(found: list[Block], lang: str) -> list[bool]:
    """Second pass: an unsettled block goes with the nearest settled one of the same article, main
    or body; with the one before it if both are as near, and text if there is none.

    Blocks outside articles and main go if those hold at least half of the text that the first pass
    settled; a teaser beside a longer text takes nothing away."""
    first = [settle(b, lang) for b in found]
    nearest: list[tuple[int, bool] | None] = [None] * len(found)
    for order in (range(len(found)), range(len(found) - 1, -1, -1)):
        last: dict[int, tuple[int, bool]] = {}
        for i in order:
            part = found[i].part
            if first[i] is not None:
                last[part] = (i, first[i])
            elif part in last:
                at, label = last[part]
                if nearest[i] is None or abs(i - at) < abs(i - nearest[i][0]):
                    nearest[i] = (at, label)
    out = []
    for b, own, near in zip(found, first, nearest, strict=True):
        if own is None:
            own = near is None or near[1]
        out.append(own)
    settled = [0, 0]  # characters of settled text outside and inside
    for b, own in zip(found, first, strict=True):
        settled[b.content] += len(b.text) if own else 0
    if settled[1] and settled[1] >= settled[0]:
        out = [keep and b.content for b, keep in zip(found, out, strict=True)]
    return out


def main_text(html: str) -> str:
    page = parse(html)
    found = without_other_parts(page)
    keep = classify(found, page.lang)
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


@F.arrow_udf(T.StringType())
def _extracted(pages: pa.Array) -> pa.Array:
    return pa.array([main_text(x.as_py()) for x in pages], pa.string())


def extract_text(html_col: str | Column = "html") -> Column:
    """The main text of a page, as a column: its blocks in page order, joined by line ends.

    Scripts, styles, menus, headers and footers of the page and sidebars are dropped by element.
    Notices, adverts, comments and other parts that a role, a class or an id names, and forms, go
    unless they hold most of the text of their page (``without_other_parts``). The other blocks are settled by link density,
    length and the share of stop words; unsettled short ones take the label of the nearest settled
    block of the same article. If articles and main hold at least half of the settled text of a page,
    only they count. White space inside a block becomes one space; character references are decoded. Null and empty
    pages, and pages without text, give an empty text; repeated pages give it again. Broken markup is
    read as browsers do, roughly; what follows a tag that never ends is dropped. Whole pages are read,
    row by row, in time proportional to their length; nothing is shuffled.
    """
    return _extracted(text_of(html_col))
