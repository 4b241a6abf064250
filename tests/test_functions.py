from __future__ import annotations

import hashlib
import html
import re
from datetime import datetime, timezone

import pytest
from dateutil import parser as dateutil_parser
from hypothesis import HealthCheck, Phase, given, settings, strategies as st
from pyspark.sql import functions as F

from signal_lake.functions import html as H, registry_fields as R, scalars as S, text as X
from signal_lake.functions.space import strip_space
from signal_lake.sources.hf import wall_clock

SPACES = [chr(c) for c in range(0x110000) if chr(c).isspace()]


def expected_clean(text: str) -> str:
    """The cleaning rules read line by line, on Python's own string functions."""
    kept = []
    for line in text.splitlines():
        if any(re.search(p, line.strip(), re.I) for p in X.BOILERPLATE_PATTERNS):
            continue
        kept.append(re.sub(r"[ \t ]+", " ", line).strip())
    return re.sub(r"\n{3,}", "\n\n", "\n".join(kept)).strip()


def test_strip_space_takes_every_white_space(run_one):
    values = [f"{s}a{s}b{s}" for s in SPACES] + ["", "".join(SPACES), "x", " ​x "]
    assert run_one(strip_space, values) == [v.strip() for v in values]


def test_lines_end_at_every_line_break(run_one):
    values = ["a\nb", "a\r\nb", "a\r\n\r\nb", "a\rb", "a\x0bb\x0cc", "a\x1cb\x1dc\x1ed", "a\x85b c d", "a\x1fb", "one"]
    assert run_one(X.split_lines, values) == [v.splitlines() for v in values]


LINES = [
    "The post My Title appeared first on Blog.", "The post", "appeared first on", "appeared first on Blog", "appeared first only",
    "Continue reading →", "we continue reading books", "→", "›»↗", "→ more", "Read the full article here", "I read the post today",
    "read story", "spread articles", "...", "[...]", "( .. )", "[…]", "....!", "Subscribe  to our newsletter", "SIGN UP FOR FREE!",
    "unsubscribe at any time", "View this email in your browser", "view this newsletter in your browser", "Powered by Ghost",
    "powered by", "powered by étude", "Click here to read more", "ſign up for free", "clıcK here to read more", "plain text", "", "  indented\t\ttext   end ",
    "  The POST  ", "post ... and more",
]


def test_boilerplate_lines(run_one):
    expected = [any(re.search(p, v.strip(), re.I) for p in X.BOILERPLATE_PATTERNS) for v in LINES]
    assert run_one(X.is_boilerplate, LINES) == expected
    assert sum(expected) == 26


def test_clean_text_rules(run_one):
    values = ["\n".join(LINES), "a\n\n\n\nb", "a\n \n\t\nb\n\nc", " x  y\n...\nz", "a &amp; b", "a\r\n\r\n\r\nb", "  ", ""]
    assert run_one(X.clean_text, values) == [expected_clean(v) for v in values]
    assert run_one(X.clean_text, [None]) == [""]


@settings(max_examples=8, deadline=None, phases=[Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(LINES + ["\t", " ", "word", "\x1f", "\x85"]), max_size=8), min_size=20, max_size=20),
       st.sampled_from(["\n", "\r\n", "\n\n\n", " "]))
def test_clean_text_agrees_with_the_line_rules(run_one, parts, glue):
    values = [glue.join(p) for p in parts]
    assert run_one(X.clean_text, values) == [expected_clean(v) for v in values]


def test_hints_cover_the_patterns(run_one):
    examples = [line for line in LINES if any(re.search(p, line.strip(), re.I) for p in X.BOILERPLATE_PATTERNS)]
    assert run_one(X._hinted, examples) == [True] * len(examples)


def test_untidy_white_space_is_found(run_one):
    values = [f"a{s}{t}b" for s in SPACES for t in ["", " ", "\n"]] + ["a\n\nb", "a\n\n\nb", " a", "a "]
    assert run_one(X.clean_text, values) == [expected_clean(v) for v in values]


def test_strip_html(run_one):
    cases = {
        "no tags &amp; entity": "no tags &amp; entity",
        "<p>a</p><p>b</p>": "a\nb",
        "<p>a</p>\n<p>b</p>": "a\n\n\nb",
        "x<!-- <b>no</b> -->y": "x\ny",
        "a<script>var t='</p>';</script>b<style>p{}</style>c": "a\nb\nc",
        "<p title='a>b'>x</p>": "x",
        "a < b <i>c</i>": "a < b \nc",
        "<b>&lt;tag&gt; &amp;amp; &eacute;&#8212;&#x41;&nope; &amp</b>": "<tag> &amp; é—A&nope; &amp",
        "<b>open": "open",
        "tail <b": "tail ",
        "<b></b>": "",
    }
    assert run_one(H.strip_html, list(cases)) == list(cases.values())


def test_many_adjacent_tags_do_not_overflow(run_one):
    assert run_one(H.strip_html, ["<b>" * 50_000 + "x" + "</b>" * 50_000]) == ["x"]


def test_named_entities_match_the_standard_table(run_one):
    names = ["copy", "middot", "quot", "euro", "Omega", "nbsp", "hellip", "frac12", "apos"]
    values = [f"<i>{'&' + n + ';'}</i>" for n in names]
    assert run_one(H.strip_html, values) == [html.unescape(f"&{n};") for n in names]


def test_elements(run_one):
    page = '<body><div class="x content wide"><div>in <b>bold</b></div> out</div><div id="content">id</div><contents>no</contents></body>'
    assert run_one(lambda c: H.element_text(c, ".content"), [page]) == ["in\nbold\nout"]
    assert run_one(lambda c: H.element_text(c, "#content"), [page]) == ["id"]
    assert run_one(lambda c: H.element_text(c, ".cont"), [page]) == [None]
    assert run_one(lambda c: H.element_text(c, "content"), [page]) == [None]
    assert run_one(lambda c: H.element_text(c, "body"), ["<BODY>a<p>b"]) == ["a\nb"]


def test_titles(run_one):
    pages = [
        "<head><meta content='OG &amp; co' property='og:title'><title>T</title>", "<title lang=x> T &lt; \n</title>",
        '<meta property="og:title" content=""><title>U</title>', "<p>none</p>",
        '<meta name="a > b" property="og:title" content="A > B"><title>U</title>', "<meta content='A > B' property='og:title'>",
    ]
    assert run_one(lambda c: F.coalesce(H.meta_title(c), H.head_title(c)), pages) == ["OG & co", "T <", "U", None, "A > B", "A > B"]


def test_a_quoted_bracket_does_not_end_a_tag(run_one):
    page = '<div title="a > b" class="content" data-x=\'c > d\'>in</div><p title="x > y">p</p>'
    assert run_one(lambda c: H.element_text(c, ".content"), [page]) == ["in"]
    assert run_one(lambda c: H.element_text(c, "p"), [page]) == ["p"]


def test_control_characters_in_the_text_are_no_gaps(run_one):
    assert run_one(H.strip_html, ["<b>a\x01b</b>c"]) == ["ab\nc"]


DATES = [
    "2024-01-05T10:00:00Z", "2024-01-05T10:00:00+03:00", "2024-01-05T10:00:00.123456-0530", "2024-01-05 10:00", "2024-01-05",
    "Fri, 05 Jan 2024 10:00:00 +0300", "05 Jan 2024 10:00:00 GMT", "Fri, 5 January 2024 10:00:00 EST", "Friday, 05 Jan 2024 07:08",
    "01/02/2024", "13/02/2024", "1/2/2024 15:04:05", "Jan 5, 2024", "January 5, 2024 3:04 PM", "5 Mar 2024 12:00 AM", "20240105",
    "20240105T101112", "2024/01/05 10:00:00", "01.02.2024", "2024-01-05T10:00:00 UTC", "Jan 5, 2024 12:30 pm",
    "2024-01-05T10:00:00+03", "2024-01-05 10:00:00+00", "Fri, 05 Jan 24 10:00:00 +0300", "05 Jan 24 10:00:00 GMT", "05 Jan 99", "01/02/24", "2024-01-05 10",
]


def test_dates_agree_with_a_general_parser(run_one):
    expected = []
    for text in DATES:
        moment = dateutil_parser.parse(text)
        if moment.tzinfo is None:
            moment = moment.replace(tzinfo=timezone.utc)
        expected.append(round(moment.timestamp() * 1_000_000))
    assert run_one(lambda c: F.unix_micros(S.parse_datetime(c)), DATES) == expected


@pytest.mark.parametrize("text", ["garbage", "", "2024", "Jan 2024", "2024-13-45", "32 Jan 2024", "2024-01-05 soon", "14/13/2024", None])
def test_no_date(run_one, text):
    assert run_one(lambda c: S.parse_datetime(c), [text]) == [None]


def test_short_years_are_those_near_the_given_moment(run_one):
    texts = ["05 Jan 24", "05 Jan 99", "01/02/49", "Fri, 05 Jan 75 10:00:00 GMT", "2024-01-05"]
    for now, want in (("1998-05-01", [2024, 1999, 1949, 1975, 2024]), ("2024-02-01", [2024, 1999, 2049, 1975, 2024]), ("2051-02-01", [2024, 2099, 2049, 2075, 2024])):
        moment = F.lit(now).cast("timestamp")
        assert run_one(lambda c: F.year(S.parse_datetime(c, moment)), texts, "string") == want  # noqa: B023


def test_dates_do_not_depend_on_the_session_zone(spark, run_one):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert run_one(lambda c: F.unix_seconds(S.parse_datetime(c)), ["2024-01-05"]) == [1704412800]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_wall_clock_discards_the_offset(run_one):
    values = ["2024-01-05T10:00:00.000Z", "2024-01-05T10:00:00+03:00", "2024-01-05", "2024-01-05T10:00", "bad", None]
    noon = int(datetime(2024, 1, 5, 10, tzinfo=timezone.utc).timestamp())
    assert run_one(lambda c: F.unix_seconds(wall_clock(c)), values) == [noon, noon, noon - 36000, noon, None, None]


def python_int(text):
    try:
        return int(text)
    except (TypeError, ValueError):
        return None


def python_lenient(text):
    try:
        return int(float(text.strip()))
    except (AttributeError, ValueError, OverflowError):
        return None


NUMBERS = ["12", " 7 ", "1.5", "", "x", None, "-3", "+4", "1_000", "1__0", "٣", "5d", "1e3", "4.9", "-0.5", ".5", "5.", "nan", "inf", "0", "99999999999"]


def test_numbers(run_one):
    strict = [n if n is not None and abs(n) < 2**31 else None for n in map(python_int, NUMBERS)]
    strict[NUMBERS.index("٣")] = None  # digits of other scripts are not read
    assert run_one(S.strict_int, NUMBERS) == strict
    lenient = [n if n is not None and abs(n) < 2**31 else None for n in map(python_lenient, NUMBERS)]
    for odd in ("٣", "1_000"):
        lenient[NUMBERS.index(odd)] = None
    assert run_one(S.lenient_int, NUMBERS) == lenient


def test_content_hash_traps(spark):
    long = "x" * 301
    rows = [
        ("s", "  ", "T", "b"), ("s", " HTTPS://Ex.org/A ", None, "b"), ("s", "", " Ti Tle ", "b"), ("s", None, None, long),
        ("s", None, "", None), ("s", None, "  ", "b"),
    ]
    keys = ["", "https://ex.org/a", "s::ti tle", "s::" + "x" * 300, "s::", "s::"]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, s string, u string, t string, c string")
    got = frame.select("i", S.content_hash(F.col("s"), F.col("u"), F.col("t"), F.col("c")).alias("h")).orderBy("i").collect()
    assert [r.h for r in got] == [hashlib.sha256(k.encode()).hexdigest() for k in keys]


def test_adverts_are_case_sensitive(run_one):
    values = ["erid: 2V", "ERID: 2V", "Реклама. ООО", "реклама.", "ИНН 77", "ИНН", "ваш промокод", "?utm_source=telegram", "plain", None]
    assert run_one(S.is_advert, values) == [True, False, True, False, True, False, True, True, False, False]


def test_length_counts_characters(run_one):
    assert run_one(S.is_short, ["ж" * 149, "ж" * 150, "😀" * 150, None]) == [True, False, False, True]


def test_canonical_keys(run_one):
    cases = {
        "Александр Горный": "aleksandr-gornyi", "Щука & Ёж": "shchuka-iozh", "  A__b -- C! ": "a-b-c", "Café Société": "cafe-societe",
        "Straße Øst": "strasse-ost", "_x_": "x", "AI/ML": "aiml", "A – B": "a-b", "北京 x": "北京-x",
    }
    assert run_one(R.canonical_key, list(cases)) == list(cases.values())


def test_url_and_handle(spark):
    cases = [
        ("", "X", None, None), ("@a", "X", None, "@a"), ("t.me/ch", "TG", "https://t.me/ch", "@ch"), ("LI Search: A. B", "LI", None, "LI Search: A. B"),
        ("linkedin search: q", "LI", None, "linkedin search: q"), ("http://e.org/x y", "WEB", "http://e.org/x y", None),
        ("site.io", "WEB", "https://site.io", None), ("launches", "forum", "https://news.ycombinator.com/launches", "launches"),
        ("trending", "WEB", None, "trending"), ("reddit.com/r/x", "FORUM", "https://reddit.com/r/x", None), ("a.com / b.com", "WEB", None, "a.com / b.com"),
        ("kellblog / k", "WEB", None, "kellblog / k"), ("a/b", "WEB", None, "a/b"), ("t.me/a/t.me/b", "TG", "https://t.me/a/t.me/b", "@b"),
    ]
    frame = spark.createDataFrame([(i, c[0], c[1]) for i, c in enumerate(cases)], "i int, v string, p string")
    got = frame.select("i", R.url_and_handle(F.col("v"), F.col("p")).alias("r")).orderBy("i").collect()
    assert [(r.r.url, r.r.handle) for r in got] == [(c[2], c[3]) for c in cases]


def test_methods_waves_languages_frequencies(spark, run_one):
    frame = spark.createDataFrame(
        [("tg", ""), ("COMM", "x.ycombinator.com"), ("FORUM", "News"), ("FORUM", "reddit"), ("TG/WEB", ""), ("SS", ""), ("db/feed", "")], "p string, u string"
    )
    got = [r[0] for r in frame.select(R.fetch_method(F.col("p"), F.col("u"))).collect()]
    assert got == ["telegram_api", "hn_api", "hn_api", "web_scraper", "web_scraper", "web_scraper", "web_scraper"]
    assert run_one(R.wave, ["rss", "x_api", "web_scraper", "huggingface_api"]) == [1, 3, 2, 2]
    assert run_one(R.language, ["EN+RU/global", "RU/mixed", "x mixed", "EN/global", "RU", "", None]) == ["mixed", "mixed", "mixed", "en", "ru", None, None]
    assert run_one(R.monitoring_frequency, ["2-3x_week ", " Daily", "Monthly ", ""]) == ["3x_week", "daily", "Monthly", ""]


def test_video_ids(run_one):
    values = ["https://y.com/watch?v=abcDEF_-123&x", "https://youtu.be/abcDEF_-123", "https://e.org/abcDEF_-123", "youtu.be/short"]
    assert run_one(X.video_id, values) == ["abcDEF_-123", "abcDEF_-123", None, None]
