"""Articles of pages against what they were made of."""

from __future__ import annotations

import html
import re
import time

import pytest
from hypothesis import given, settings, strategies as st

from signal_lake.llm import html_extraction as X
from signal_lake.llm.catalog import QUERIES


def marked_article(page):
    """Blocks of the one ``<article>`` of a test page."""
    inner = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
    blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:p|h1)>", inner))
    return "\n\n".join(b for b in blocks if b)


def test_whole_table(spark, small_sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{small_sf}/pages.parquet").collect()}
    rows = QUERIES["op10_html_extraction"](spark, small_sf).collect()
    assert {r.page_id for r in rows} == set(pages) and len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, marked_article(pages[r.page_id].html), len(r.text))


PROSE = "The council met on Monday &amp; agreed to build the bridge over the river before the winter begins."


@pytest.mark.parametrize(("page", "want"), [
    (None, ""), ("", ""), ("   ", ""), ("<p>", ""), ("<nav>Home</nav>", ""), ("plain words", "plain words"), ("<script>var a = 1;", ""), ("a < b and <3", "a < b and <3"),
    ("<p>one&nbsp;two\n three<br>four</p>", "one two three four"), ("<p>a<b>b</b><i>c</i> d", "abc d"), ("<P CLASS='x'>Upper</P>", "Upper"),
    (f"<body><header>Site</header><main><h1>T</h1><p>{PROSE}<p>{PROSE}</main><aside>more</aside><footer>c</footer>", "T\n\n" + "\n\n".join([html.unescape(PROSE)] * 2)),
    (f"<div id=top-menu><a href=/>a</a><a href=/b>b</a></div><div class='content'><p>{PROSE}</p><form><input value=x>Mail me</form><p>{PROSE}</p></div><div class=comments><p>{PROSE}</p></div>", "\n\n".join([html.unescape(PROSE)] * 2)),
    (f"<div class=cookie-notice>We use cookies</div><p>{PROSE}</p><div hidden>secret</div><div style='display: none'>gone</div><!-- no <p>x</p> -->", html.unescape(PROSE)),
    (f"<article><header><h1>Title</h1></header><p title='a > b'>{PROSE}</p><section id='comments'><article class='comment'>first</article></section></article>", "Title\n\n" + html.unescape(PROSE)),
    (f"<title>not this</title><style>p {{}}</style><p>{PROSE}</p><textarea>nor <p>this</p></textarea>", html.unescape(PROSE)),
])
def test_pages(page, want):
    assert X.extract(page, X.Weights()) == want


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>/!-\"'= abpdivscriptARTICLE&;\n", max_size=80))
def test_any_markup_is_read(page):
    text = X.extract(page, X.Weights())
    assert text == text.strip() and "\n\n\n" not in text


def test_best_region_against_all_regions():
    weights = X.Weights(words={"p": 1.0}, tags={"p": 0.5, "div": 4.0})
    page = "<p>a b</p><div>x</div><p>c d e</p><p>f</p><div></div><div></div><p>g h</p>"
    found = list(X.pieces(page))

    def score(some):
        return sum(-weights.tags.get(p.tag, 1.0) if p.tag else weights.words.get(p.place, 1.0) * p.words for p in some)

    start, end = X.best_region(found, weights)
    assert score(found[start:end]) == max(score(found[i:j]) for i in range(len(found)) for j in range(i, len(found) + 1))


def test_odd_pages(spark):
    rows = [(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (None, None, None), (2, "u", ""), (3, "u", "<p>" + "word " * 30_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS id", "2 AS text", "3 AS n_chars")
    found = X.extract_pages(pages).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in found) == [("1", 1), ("1", 1), ("2", 0), ("3", 149_999), ("None", 0)]
    assert X.extract_pages(pages.limit(0)).collect() == []


ADVERT = "<div class=advert>" + "<p>buy this now</p>" * 12 + "</div>"
LEARNED = X.Weights(words={"p": 3.0, "h1": 3.0}, tags={"p": 0.1, "h1": 0.1, "div": 3.0, "aside": 3.0})


@pytest.mark.parametrize("weights", [X.Weights(), LEARNED], ids=["default", "learned"])
@pytest.mark.parametrize("open_, close", [("<article>", "</article>"), ("<main>", "</main>"), ("<div class=content>", "</div>"), ("<body>", "</body>")])
@pytest.mark.parametrize("block", [ADVERT, f"<aside><p>{PROSE}</p><p>{PROSE}</p></aside>", "<div class=share>" + "tell a friend " * 7 + "</div>"], ids=["advert", "aside", "share"])
def test_a_refused_block_does_not_split_an_article(weights, open_, close, block):
    prose = html.unescape(PROSE)
    parts = ["<h1>The bridge over the wide river is built</h1>", block, f"<p>{PROSE}</p>", block, f"<p>{PROSE}</p>", block, "<p>It will open early in May.</p>"]
    page = f"<nav><a>Home</a></nav>{open_}{''.join(parts)}{close}<footer>c</footer>"
    assert X.extract(page, weights) == f"The bridge over the wide river is built\n\n{prose}\n\n{prose}\n\nIt will open early in May."


TOP = "<header>Site</header><nav><a>Home</a> <a>News</a></nav>"


@pytest.mark.parametrize("wrapper", ["class='layout has-sidebar'", "class=no-sidebar", "class=elementor-widget-container", "class='single-post comments-open'", "class='page header-fixed'", None])
@pytest.mark.parametrize("mark", ["article", "main", "div"])
def test_a_wrapper_does_not_refuse_the_article(wrapper, mark):
    open_, close = (f"<div {wrapper}>", "</div>") if wrapper else ("<form id=aspnetForm action=/page>", "</form>")
    side = "<div class=sidebar><article><p>Other news</p></article></div><div class=comments><p>Nice one</p></div>"
    page = f"<body>{TOP}{open_}<{mark}><h1>Title</h1><p>{PROSE}</p><p>{PROSE}</p></{mark}>{side}{close}<footer>c</footer></body>"
    for weights in (X.Weights(), X.Weights(mark=0.1)):
        assert X.extract(page, weights) == "Title\n\n" + "\n\n".join([html.unescape(PROSE)] * 2)


def test_widgets_of_one_kind_hold_a_page_together():
    page = f"<body>{TOP}" + f"<div class='elementor-widget elementor-widget-text e-1'><p>{PROSE}</p></div>" * 3 + "</body>"
    assert X.extract(page, X.Weights()) == "\n\n".join([html.unescape(PROSE)] * 3)


def test_comments_longer_than_the_article_stay_refused():
    page = f"<body><div class=content><p>{PROSE}</p></div><div class=comments>" + f"<p>{PROSE}</p>" * 9 + "</div></body>"
    assert X.extract(page, X.Weights()) == html.unescape(PROSE)


def test_formulas_and_objects_in_an_article():
    page = "<article><p>Here <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x = 1</annotation></math> holds.</p><object data=a><p>A plan of the bridge.</p></object></article>"
    assert X.extract(page, X.Weights()) == "Here x=1 holds.\n\nA plan of the bridge."


HALF = 100_000


@pytest.mark.parametrize("page", [
    "<div>" * HALF + "</span>" * HALF,
    "<b>" * HALF + "<p>" * HALF,
    "<ul>" + "<b>" * HALF + "<li>" * HALF,
    "<![CDATA[x>" * HALF,
    "".join(f"<div class='k{'abcdefghij'[i % 10] * (i // 10 % 50)}x-widget'>w " for i in range(HALF // 5)) + "w " * HALF,
], ids=["unmatched ends", "open inline", "list items", "cdata", "kinds of wrappers"])
def test_time_grows_with_the_page(page):
    """An eighth of the page takes at least a twentieth of the time; quadratic work on these takes minutes."""

    def seconds(text):
        began = time.process_time()
        X.extract(text, X.Weights())
        return time.process_time() - began

    part = page[: len(page) // 16] + page[-(len(page) // 16) :]
    assert seconds(page) < max(2.0, 20 * seconds(part))


def lift_plainly(elements, inside, scope):
    """Refusals lifted as defined, all counts made anew for each kind."""
    hard = [e.why == X.HARD for e in elements]
    for i, e in enumerate(elements):
        hard[i] = hard[i] or (i > 0 and hard[e.parent])
    while True:
        tops = [i for i, e in enumerate(elements) if i and e.top == i and e.marked >= scope]
        rest = sum(e.words for e in elements if e.marked >= scope and not e.refused)
        words = {}
        for i in tops:
            if elements[i].why == X.SOFT and not hard[i]:
                words[elements[i].key] = words.get(elements[i].key, 0) + inside[i]
        key = max(words, key=lambda k: (words[k], k), default=None)
        others = sum(inside[i] for i in tops if elements[i].key != key)
        if not words or not words[key] or words[key] <= X.MOST * rest or words[key] <= others:
            return
        lifted = {i for i in tops if elements[i].why == X.SOFT and elements[i].key == key}
        for i, e in enumerate(elements):
            if i in lifted or (e.top in lifted and e.why == X.SOFT and inside[i] == inside[e.top]):
                e.why = X.NO
        X._mark(elements)


TAGS = st.sampled_from(["p", "div", "li", "ul", "b", "article", "main", "form", "nav", "section"])
CLASSES = st.sampled_from(["", " class=has-sidebar", " class=sidebar", " class='widget-box a'", " class=b-menu", " id=comment-list", " class='no-share y'", " hidden"])
MARKUP = st.lists(st.one_of(st.builds("<{}{}>".format, TAGS, CLASSES), st.builds("</{}>".format, TAGS), st.integers(1, 30).map(lambda n: "w " * n)), max_size=40)


@settings(max_examples=400, deadline=None)
@given(MARKUP.map("".join))
def test_lifting_against_a_plain_model(page):
    def shown():
        return [(p.tag, p.words, p.block, p.refused, p.marked, p.top, p.between) for p in X.pieces(page)]

    quick, kept = shown(), X._lift
    X._lift = lift_plainly
    try:
        assert shown() == quick
    finally:
        X._lift = kept


def without_marks(page):
    """The page with every section a plain ``div`` and no attribute that tells its part."""
    plain = re.sub(r"<(/?)(?:article|main|nav|footer|aside|header|section|form)\b[^>]*>", r"<\1div>", page)
    return re.sub(r"""\s(?:class|id|role|style|hidden|aria-hidden)(?:=(?:"[^"]*"|'[^']*'|[^\s>]+))?(?=[\s/>])""", "", plain)


def test_the_scan_alone_finds_articles(spark, small_sf):
    """Names of sections and classes taken away, weights learned from other pages that have them."""
    table = spark.read.parquet(f"{small_sf.replace('sf0.001', 'sf0.01')}/pages.parquet")
    weights = X.learn(table.where("page_id % 2 = 1"), "html")
    pages = [r.html for r in table.where("page_id % 2 = 0").collect()]
    assert [X.extract(without_marks(page), weights) for page in pages] == [marked_article(page) for page in pages]

    def words_left(page):
        found = list(X.pieces(without_marks(page)))
        start, end = X.best_region(found, weights)
        return [p for k, p in enumerate(found) if p.words and not p.refused and not start <= k < end]

    assert all(words_left(page) for page in pages)  # it is the scan that cuts menus and footers off
    bare = "<div>" + "The bridge over the river opens in May. " * 6 + "</div>"
    assert X.extract(f"<div><a href=/>Home</a></div>{bare}<div>c</div>", weights) == " ".join(["The bridge over the river opens in May."] * 6)
