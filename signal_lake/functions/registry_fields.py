"""Fields of a registry row derived from the text columns of the master list."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

from signal_lake.functions.scalars import lookup
from signal_lake.functions.space import is_blank, strip_space

# Latin spelling of Cyrillic letters and of Latin letters that are no accented form.
LETTERS = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "io", "ж": "zh", "з": "z", "и": "i", "й": "i",
    "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f",
    "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "iu",
    "я": "ia", "є": "ie", "і": "i", "ї": "yi", "ґ": "g", "ў": "u",
    "ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "ł": "l", "þ": "th", "ı": "i", "ħ": "h",
    "–": "-", "—": "--", "№": "no", " ": " ",
    "×": "x", "™": "tm", "€": "eur", "©": "c", "®": "r", "°": "deg", "µ": "u", "¹": "1", "²": "2", "³": "3",
}
# Platform bases, methods by platform, waves by method, spellings of a frequency.
FORUM_BASE = "https://news.ycombinator.com/"
PLATFORM_METHODS = {
    "TG": "telegram_api",
    "SB": "rss",
    "POD": "rss",
    "NEWS": "rss",
    "X": "x_api",
    "LI": "linkedin_api",
    "TOOL": "site_change_monitor",
    "DB/FEED": "web_scraper",
    "WEB": "rss",
}
WAVE_ONE = ["rss", "telegram_api", "hn_api", "manual_import", "youtube_transcript"]
WAVE_THREE = ["x_api", "linkedin_api"]
FREQUENCIES = {"daily": "daily", "2-3x_week": "3x_week", "3x_week": "3x_week", "weekly": "weekly"}


def _accented() -> dict[str, str]:
    """Lower-case letters whose canonical decomposition starts with an ASCII letter."""
    found = {}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        letter = chr(code).lower()
        base = unicodedata.normalize("NFD", letter)[0]
        if len(letter) == 1 and letter != base and base.isascii():
            found[letter] = base
    return found


def latin(text: Column) -> Column:
    """Lower-cased Latin spelling. Letters without one stay, so that names in other scripts stay apart."""
    single = {k: v for k, v in {**_accented(), **LETTERS}.items() if len(v) == 1}
    several = {k: v for k, v in LETTERS.items() if len(v) != 1}
    spelled = F.translate(F.lower(text), "".join(single), "".join(single.values()))
    for letter, spelling in several.items():
        spelled = F.replace(spelled, F.lit(letter), F.lit(spelling))
    return F.regexp_replace(spelled, r"\p{M}+", "")


def canonical_key(name: Column) -> Column:
    """Slug: words joined by single hyphens."""
    kept = F.regexp_replace(latin(name), r"(?U)[^\w\s-]", "")
    hyphened = F.regexp_replace(kept, r"(?U)[\s_]+", "-")
    return F.regexp_replace(F.regexp_replace(hyphened, r"^-+|-+\z", ""), "-+", "-")


def url_and_handle(text: Column, platform: Column) -> Column:
    """Struct (url, handle) told from the shape of a mixed address field; the first case that fits counts."""
    v = strip_space(F.coalesce(text, F.lit("")))
    dot, slash, space = v.contains("."), v.contains("/"), v.contains(" ")
    secure = F.concat(F.lit("https://"), v)
    search = F.lower(v).startswith("li search:") | F.lower(v).startswith("linkedin search:")
    forum = F.upper(platform) == "FORUM"

    def pair(url: Column, handle: Column) -> Column:
        return F.struct(url.cast("string").alias("url"), handle.cast("string").alias("handle"))

    none = F.lit(None)
    return (
        F.when(v == "", pair(none, none))
        .when(v.startswith("@"), pair(none, v))
        .when(v.startswith("t.me/"), pair(secure, F.concat(F.lit("@"), F.substring_index(v, "t.me/", -1))))
        .when(search, pair(none, v))
        .when(v.startswith("http://") | v.startswith("https://"), pair(v, none))
        .when(dot & ~space & ~slash, pair(secure, none))
        .when(~slash & ~space & ~dot, pair(F.when(forum, F.concat(F.lit(FORUM_BASE), v)), v))
        .when(dot & ~space, pair(secure, none))
        .otherwise(pair(none, v))
    )


def _parts(text: Column, separator: str) -> Column:
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), separator), strip_space)
    return F.filter(parts, lambda part: part != "")


def themes(text: Column) -> Column:
    return _parts(text, ";")


def platforms(primary: Column, secondary: Column) -> Column:
    """Primary platform first, then the secondary ones, each once."""
    first = F.filter(F.array(strip_space(F.coalesce(primary, F.lit("")))), lambda part: part != "")
    return F.array_distinct(F.concat(first, _parts(secondary, "[,;]")))


def fetch_method(platform: Column, url_or_handle: Column) -> Column:
    p = F.upper(strip_space(F.coalesce(platform, F.lit(""))))
    u = F.lower(F.coalesce(url_or_handle, F.lit("")))
    news_site = u.contains("ycombinator") | u.isin("launches", "news")
    forum = p.isin("FORUM", "COMM")
    return F.when(forum & news_site, F.lit("hn_api")).otherwise(
        F.coalesce(lookup(p, PLATFORM_METHODS), F.lit("web_scraper"))
    )


def wave(method: Column) -> Column:
    return F.when(method.isin(WAVE_ONE), 1).when(method.isin(WAVE_THREE), 3).otherwise(2)


def language(region: Column) -> Column:
    r = F.lower(F.coalesce(region, F.lit("")))
    mixed = r.startswith("en+ru") | r.contains("mixed")
    return F.when(mixed, "mixed").when(r.startswith("en"), "en").when(r.startswith("ru"), "ru")


def monitoring_frequency(text: Column) -> Column:
    bare = strip_space(F.coalesce(text, F.lit("")))
    return F.coalesce(lookup(F.lower(bare), FREQUENCIES), bare)


def or_default(text: Column, default: Column | str | None = None) -> Column:
    """Trimmed text, or the default where nothing is left."""
    bare = strip_space(text)
    return F.when(~is_blank(bare), bare).otherwise(default if isinstance(default, Column) else F.lit(default))
