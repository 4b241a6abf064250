"""Main text of web pages as the subsequence of greatest score.

Method: a page is a sequence of words and tags. Words score positive, by the element they stand in; tags score negative, by
their name; both weights are log odds from labelled pages. Words in elements that are no article by their role (menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles, reader comments) score negative as well; inside an article they cost
nothing, and between paragraphs elsewhere at most ``Weights.block`` each, as they are cut from the text anyway. One linear scan
finds the contiguous region of the greatest sum, and the blocks in it, without the refused elements, are the text.

A form, or an element that a part of a compound class name refuses (``has-sidebar``), is refused no longer if it holds most of the
page's words and few stand elsewhere; so is what is refused by a class or as a form around the article of a page that has no other, and
by a class name of one part if that article holds most of the words.

Labelled pages are those that mark their article with ``<article>`` or ``<main>``; weights are counted on a sample of about
``LABELLED`` of them, chosen by a hash. The marks themselves are no features: they cost what the dearest tag costs.

Results for odd input: a NULL, empty or tag-only page has an empty text. Repeated rows give repeated results. Unclosed,
misnested and cut-off markup is read as far as it goes, in time that grows with its length. An empty table gives an empty result, and no
labelled page the default weights. Columns other than id, url and html are not read.
"""

from __future__ import annotations

import heapq
import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from signal_lake.llm.common import map_batches, prepare

LABELLED = 2_000
#: The greatest weight; a word that hardly occurs in articles by its element still has a tenth of it.
TOP = 3.0

_TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[(?P<data>.*?)\]\]>|<[!?][^>]*+(?:>|\Z)"""
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>])*+)(?:>|\Z)"""
    r"""|(?P<text>[^<]++|<)""",
    re.DOTALL,
)
#: The same where no CDATA section ends any more, so that none is looked for.
_LATE_TOKEN = re.compile(_TOKEN.pattern.replace(r"<!\[CDATA\[(?P<data>.*?)\]\]>|", "(?P<data>(?!))|"), re.DOTALL)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(?=[\s/>]|\Z))""", re.IGNORECASE)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Names of the markup language.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "meter", "nobr",
    "output", "picture", "q", "rp", "rt", "ruby", "s", "samp", "small", "source", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
BLOCK = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "h1", "h2", "h3", "h4",
    "h5", "h6", "header", "hgroup", "hr", "li", "main", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
MARKS = {"article", "main"}
# Formulas are words of the sentence they stand in; what annotates them says the same again.
FORMULA = {
    "math", "semantics", "mrow", "mi", "mn", "mo", "ms", "mtext", "mspace", "mfrac", "msqrt", "mroot", "mstyle", "merror", "mpadded", "mphantom", "msub", "msup", "msubsup",
    "munder", "mover", "munderover", "mmultiscripts", "mprescripts", "mtable", "mtr", "mtd", "menclose", "mfenced",
}
ANNOTATION = {"annotation", "annotation-xml"}
INLINE |= FORMULA | ANNOTATION
# Elements, roles and parts of class names that say what is no article.
REFUSED = {"head", "nav", "footer", "aside", "form", "menu", "button", "select", "dialog", "object", "svg", "audio", "video", "canvas", "datalist", "map", *RAW}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar", "status"}
CLASSES = {
    "ad", "ads", "alert", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus",
    "footer", "gdpr", "header", "hidden", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "overlay", "pager", "pagination",
    "popup", "promo", "promoted", "promotion", "recommended", "related", "respond", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored",
    "subscribe", "teaser", "toolbar", "topbar", "warning", "widget",
}
#: What is refused by a part of a class name is accepted if it holds this many times the words that stand outside.
MOST = 4
#: Parts that an article has itself.
OWN = {"header", "footer", "teaser"}
KNOWN = INLINE | BLOCK | VOID | REFUSED
#: Elements of running text: what holds one holds prose.
RUNNING = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre"}


#: Tags of prose; what they cost where no labelled page has them.
PROSE = ("p", "br", "h1", "h2", "h3", "h4", "h5", "h6", "b", "i", "em", "strong", "blockquote", "header")


@dataclass
class Weights:
    """Scores of a word by the block it stands in, and costs of a tag by its name."""

    words: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=lambda: dict.fromkeys(PROSE, 0.1))
    word: float = 1.0
    tag: float = 1.0
    refused: float = 3.0
    mark: float = 6.0
    #: Most that a refused element between paragraphs costs as a whole.
    block: float = 3.0


@dataclass(slots=True)
class Piece:
    """A text or a tag of a page. ``block`` numbers the block, ``place`` names its element.

    ``top`` numbers the outermost refused element around, and ``between`` says that it stands among prose.
    """

    tag: str | None
    words: int
    block: int
    place: str
    refused: bool
    marked: bool
    text: str = ""
    top: int = 0
    between: bool = False


NO, SOFT, FIRM, HARD = range(4)


@dataclass(slots=True)
class Element:
    """An element of a page; ``parent`` is its place in the list of all, the first of which is the page.

    ``why`` is NO if nothing refuses the element itself, SOFT or FIRM if a class name or a form does, else HARD; ``key`` is equal for
    elements of one kind, ``words`` are its own.
    """

    name: str
    parent: int
    refused: bool = False
    marked: bool = False
    top: int = 0
    prose: bool = False
    why: int = 0
    key: str = ""
    words: int = 0


def _by_attributes(name: str, attributes: str, marked: bool) -> tuple[int, str]:
    """How firmly attributes refuse an element: HARD, FIRM for a name of one part, SOFT for a part of a name, NO; and its classes."""
    found, classes = NO, []
    refusing = CLASSES - OWN if marked or name == "article" else CLASSES
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id"):
            for token in value.split():
                parts = [p.lower() for p in _PART.findall(token)]
                if not refusing.isdisjoint(parts):
                    found = max(found, FIRM if len(parts) == 1 else SOFT)
                if key == "class" and not any(c.isdigit() for c in token):
                    classes.append(token)
        elif (
            key == "hidden"
            or (key == "role" and value.lower() in ROLES)
            or (key == "aria-hidden" and value.lower() == "true")
            or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE))
        ):
            return HARD, ""
    return (NO if name in ("html", "body", "main") else found), " ".join([name, *sorted(classes)])  # html, body and main are classed by what they hold


class _Open:
    """Open elements from the outermost in, with the places of each name and of block elements at hand, so that no search walks them."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.elements: list[int] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, name: str, element: int) -> None:
        self.places.setdefault(name, []).append(len(self.names))
        if name not in INLINE:
            self.blocks.append(len(self.names))
        self.names.append(name)
        self.elements.append(element)

    def cut(self, level: int) -> None:
        """Close the element at ``level`` and all within; each is closed once, so the cuts of a page take time in its tags."""
        while len(self.names) > level:
            name = self.names.pop()
            self.elements.pop()
            self.places[name].pop()
            if name not in INLINE:
                self.blocks.pop()

    def last(self, name: str) -> int:
        """Level of the innermost element of this name, -1 if none is open."""
        places = self.places.get(name)
        return places[-1] if places else -1

    def block(self) -> int:
        return self.blocks[-1] if self.blocks else -1

    def inner(self) -> int:
        return self.elements[-1] if self.elements else 0


def _scan(page: str) -> tuple[list[tuple[Piece, int, int]], list[Element]]:
    """Words and tags of a page in order, each with its element and, for words, the one that holds their block; all elements."""
    elements = [Element("", 0)]
    stack = _Open()
    found: list[tuple[Piece, int, int]] = []
    block, at, size = 0, 0, len(page)
    place, holder = "", 0
    data_ends = page.rfind("]]>")
    while at < size:
        m = (_TOKEN if at < data_ends else _LATE_TOKEN).match(page, at)
        at = m.end()
        end, name, attributes, data, text = m.group("end", "name", "attributes", "data", "text")
        text = data if text is None else text
        inner = stack.inner()
        if text is not None:
            text = html.unescape(text) if "&" in text and data is None else text
            words = len(text.split())
            elements[inner].words += words
            found.append((Piece(None, words, block, place, False, False, text), inner, holder))
            continue
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            found.append((Piece("br", 0, block, place, False, False, " "), inner, holder))
            continue
        closed = 0
        if end:
            level = stack.last(name)
            if level >= 0 and not (name in INLINE and stack.block() > level):
                closed = stack.elements[level]
                stack.cut(level)
        else:
            if name == "p" or name in BLOCK:  # a paragraph, and inline elements left open in it, end where a block begins
                level = stack.block()
                if level >= 0 and stack.names[level] == "p":
                    stack.cut(level)
            if name == "li" and stack.last("li") > max(stack.last("ul"), stack.last("ol")):
                stack.cut(stack.last("li"))
            parent = stack.inner()
            marked = elements[parent].marked
            why, key = _by_attributes(name, attributes, marked) if attributes.strip() else (NO, name)
            if name == "form":
                why = max(why, SOFT)
            elif name in REFUSED - {"object"} or name in ANNOTATION or (name in ("header", "object") and not marked):
                why = HARD
            if name not in VOID and not attributes.endswith("/"):
                elements.append(Element(name, parent, marked=marked or (name in MARKS and why < FIRM), why=why, key=key))
                stack.push(name, len(elements) - 1)
            if name in RAW:
                close = re.compile(f"</{re.escape(name)}", re.IGNORECASE).search(page, at)
                at = close.start() if close else size
        inner = stack.inner()
        if name in FORMULA:
            continue
        if name not in INLINE:
            block += 1
            level = stack.block()
            place, holder = (stack.names[level], stack.elements[level]) if level >= 0 else ("", 0)
            if place in RUNNING:
                holder = elements[holder].parent
        # The end of a refused element belongs to it.
        found.append((Piece(name if name in KNOWN else "other", 0, block, place, False, False), closed if elements[closed].why else inner, holder))
    return found, elements


def _mark(elements: list[Element]) -> None:
    """Refusal and marks from the root down."""
    for i, e in enumerate(elements[1:], 1):
        above = elements[e.parent]
        e.refused, e.top = above.refused or e.why > NO, above.top or (i if e.why else 0)
        e.marked = above.marked or (e.name in MARKS and not e.refused)


def _accept(elements: list[Element]) -> None:
    """Lift refusals by class, or of a form, of what holds the article; ``why`` becomes NO."""
    if not any(e.why in (SOFT, FIRM) for e in elements):
        return
    hard = [False] * len(elements)
    for i, e in enumerate(elements):
        hard[i] = e.why == HARD or (i > 0 and hard[e.parent])
    inside = [0 if h else e.words for h, e in zip(hard, elements, strict=True)]
    for i in range(len(elements) - 1, 0, -1):
        inside[elements[i].parent] += inside[i]
    firm = [False] * len(elements)
    for i, e in enumerate(elements):
        firm[i] = e.why == FIRM or firm[e.parent]
    # A sidebar's or comments' small article isn't the page's.
    marks = [i for i, e in enumerate(elements) if e.name in MARKS and e.why < FIRM and inside[i] and (not firm[i] or 2 * inside[i] > inside[0])]
    if marks and all(elements[i].refused for i in marks):  # the article of the page is the largest
        at = max(marks, key=lambda i: (inside[i], -i))
        while at:
            elements[at].why, at = NO, elements[at].parent
        _mark(elements)
    scope = any(e.marked and inside[i] for i, e in enumerate(elements))
    _lift(elements, inside, scope)
    _mark(elements)


def _lift(elements: list[Element], inside: list[int], scope: bool) -> None:
    """Lift the refusal of one kind of outermost refused element after the other, as long as that kind holds the article.

    The words outside, those of each kind and the outermost refused elements are kept up to date, and an element is opened once, so
    the time grows with the elements of the page and not with its kinds as well.
    """
    inner: list[list[int]] = [[] for _ in elements]
    for i, e in enumerate(elements[1:], 1):
        inner[e.parent].append(i)
    rest = sum(e.words for e in elements if e.marked >= scope and not e.refused)
    soft: dict[str, list[int]] = {}
    words: Counter = Counter()  # of the liftable elements of a kind
    alike: Counter = Counter()  # of all refused elements of a kind
    total = 0
    rank = {key: k for k, key in enumerate(sorted({e.key for e in elements}))}
    heap: list[tuple[int, int, str]] = []

    def outermost(i: int) -> None:
        nonlocal total
        e = elements[i]
        total += inside[i]
        alike[e.key] += inside[i]
        if e.why == SOFT:
            soft.setdefault(e.key, []).append(i)
            words[e.key] += inside[i]
            heapq.heappush(heap, (-words[e.key], -rank[e.key], e.key))

    for i, e in enumerate(elements):
        if i and e.top == i and e.marked >= scope:
            outermost(i)
    while heap:
        most, _, key = heapq.heappop(heap)
        if not soft.get(key) or -most != words[key]:
            continue
        most = -most
        if not most or most <= MOST * rest or most <= total - alike[key]:
            return
        lifted = soft.pop(key)
        words[key] = 0
        for top in lifted:
            total -= inside[top]
            alike[key] -= inside[top]
            waiting = [top]
            while waiting:
                i = waiting.pop()
                e = elements[i]
                # So is an element in it that holds all its words.
                if i == top or (e.why == SOFT and inside[i] == inside[top]):
                    e.why = NO
                if e.why:
                    outermost(i)
                else:
                    rest += e.words
                    waiting += inner[i]


def _between(elements: list[Element]) -> list[bool]:
    """By number of an outermost refused element: its parent, or an ancestor below the body, holds prose."""
    around = [False] * len(elements)
    for i, e in enumerate(elements):
        if i:
            around[i] = e.name not in ("html", "body") and (e.prose or around[e.parent])
    return [elements[e.parent].prose or around[e.parent] for e in elements]


def pieces(page: str) -> Iterator[Piece]:
    """Words and tags of a page in order."""
    found, elements = _scan(page)
    _mark(elements)
    _accept(elements)
    for piece, element, holder in found:
        if piece.words and not elements[element].refused:
            elements[holder].prose = True
    between = _between(elements)
    for piece, element, _ in found:
        e = elements[element]
        piece.refused, piece.marked, piece.top, piece.between = e.refused, e.marked, e.top, bool(e.top) and between[e.top]
        yield piece


def best_region(found: list[Piece], weights: Weights) -> tuple[int, int]:
    """First piece of the region of the greatest sum, and the one after its last; equal if no word scores."""
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    spent: dict[int, float] = {}
    for i, piece in enumerate(found):
        if piece.tag is not None:
            score = -(weights.mark if piece.tag in MARKS else weights.tags.get(piece.tag, weights.tag))
        elif piece.refused:
            score = -weights.refused * piece.words
        else:
            score = weights.words.get(piece.place, weights.word) * piece.words
        if piece.refused and (piece.marked or piece.between):
            least = 0.0 if piece.marked else spent.get(piece.top, 0.0) - weights.block
            score = max(score, least)
            spent[piece.top] = spent.get(piece.top, 0.0) - score
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, best_at = total, (start, i + 1)
    return best_at


def extract(page: str | None, weights: Weights) -> str:
    """The article's blocks, white space in them as one space, joined by an empty line."""
    found = list(pieces(page or ""))
    start, end = best_region(found, weights)
    inside = {p.block for p in found[start:end] if p.tag is None and p.words and not p.refused}
    blocks: dict[int, list[str]] = {}
    for p in found:
        if p.text and not p.refused and p.block in inside:
            blocks.setdefault(p.block, []).append(p.text)
    return "\n\n".join(" ".join("".join(parts).split()) for parts in blocks.values())


# --- weights ----------------------------------------------------------------------------------


def _count(page: str, counts: Counter) -> None:
    found = list(pieces(page))
    if not any(p.marked for p in found):
        return
    for p in found:
        if p.tag is None:
            if p.words:
                counts["word", p.place, p.marked and not p.refused] += p.words
        elif p.tag not in MARKS:
            counts["tag", p.tag, p.marked and not p.refused] += 1


def weights_from(counts: Counter) -> Weights:
    """Log odds of each name inside and outside articles, words held positive and tags negative."""
    out = Weights()
    for kind, into, low, high in (("word", out.words, TOP / 10, TOP), ("tag", out.tags, 0.1, TOP)):
        names = {n for k, n, _ in counts if k == kind}
        totals = {side: sum(c for (k, _, s), c in counts.items() if k == kind and s == side) + len(names) for side in (True, False)}
        for name in names:
            share = {side: (counts[kind, name, side] + 1) / totals[side] for side in (True, False)}
            odds = math.log(share[True] / share[False])
            into[name] = min(max(odds if kind == "word" else -odds, low), high)
    return out


def learn(pages: DataFrame, html_column: str, labelled: int = LABELLED) -> Weights:
    """Weights from a sample of about ``labelled`` pages that mark their article."""
    prepare(pages.sparkSession)
    rows = pages.select(F.col(html_column).alias("html")).where(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    total = rows.count()
    if not total:
        return Weights()
    share = min(1.0, labelled / total)
    chosen = rows.where(F.pmod(F.xxhash64("html"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                _count(page, counts)
        rows_ = [(*key, n) for key, n in counts.items()]
        columns = list(zip(*rows_, strict=True)) or [(), (), (), ()]
        kinds = [pa.string(), pa.string(), pa.bool_(), pa.int64()]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["kind", "name", "inside", "n"])

    # Names are those of the markup language: some hundred rows, whatever the pages hold.
    found = chosen.mapInArrow(count, "kind string, name string, inside boolean, n bigint").groupBy("kind", "name", "inside").agg(F.sum("n").alias("n"))
    return weights_from(Counter({(r["kind"], r["name"], r["inside"]): r["n"] for r in found.collect()}))


def extract_pages(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", weights: Weights | None = None) -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    prepare(pages.sparkSession)
    learned = weights or learn(pages, html_column)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [extract(page, learned) for page in batch.column(2).to_pylist()]
        return pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_column).alias("id"), F.col(url_column).cast("string").alias("url"), F.col(html_column).alias("html"))
    kind = pages.schema[id_column].dataType.simpleString()
    out = map_batches(rows, run, f"id {kind}, url string, text string, n_chars bigint")
    return out.withColumnsRenamed({"id": id_column, "url": url_column})
