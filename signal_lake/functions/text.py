"""Text cleaning as one native expression tree."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from signal_lake.functions.html import strip_html
from signal_lake.functions.space import let, or_null, strip_space

# A line holding one of these is boilerplate and goes as a whole. Matching is a search
# on the trimmed line, without regard to case.
BOILERPLATE_PATTERNS = [
    r"the post .+ appeared first on .+",
    r"^the post$",
    r"^appeared first on$",
    r"^appeared first on\b",
    r"continue reading",
    r"^[→›»↗]+$",
    r"read (the )?(full |more |rest of the )?(article|post|story)",
    r"^[\[(\s]*\.{2,}[\])\s]*$",
    r"subscribe\s+to\s+our\s+newsletter",
    r"sign\s+up\s+for\s+free",
    r"unsubscribe\s+at\s+any\s+time",
    r"view\s+this\s+(email|newsletter)\s+in\s+your\s+browser",
    r"powered\s+by\s+\w+",
    r"click\s+here\s+to\s+read\s+more",
]
# Text no match of any pattern can do without: all parts of at least one entry, in upper case. Plain
# substring checks spare nearly every line the pattern search. Words with I or K are cut short: the
# dotted I and the Kelvin sign match them but are no upper case of them.
BOILERPLATE_HINTS = [
    ("THE POST",),
    ("APPEARED",),
    ("NUE READ",),
    ("→",),
    ("›",),
    ("»",),
    ("↗",),
    ("READ ", "CLE"),
    ("READ ", "POST"),
    ("READ ", "STORY"),
    ("..",),
    ("TO", "NEWSLETTER"),
    ("FREE", "GN"),
    ("ANY", "UNSUBSCR"),
    ("BROWSER", "YOUR"),
    ("POWERED", "BY"),
    ("HERE", "MORE"),
]

# (?iU): case and character classes by Unicode.
_BOILERPLATE = "(?iU)" + "|".join(f"(?:{p})" for p in BOILERPLATE_PATTERNS)
_OTHER_BREAKS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
# Any run of blanks but a single space.
_BLANKS = r"[\t\u00a0][ \t\u00a0]*+| [ \t\u00a0]++"


def _holds(text: Column, *parts: str) -> Column:
    """Whether any of the parts is in ``text``: a byte search, far cheaper than a pattern."""
    found = text.contains(parts[0])
    for part in parts[1:]:
        found = found | text.contains(part)
    return found


def split_lines(text: Column) -> Column:
    """Lines by every Unicode line break."""
    # Classes within Latin-1 are a table lookup in the pattern engine; wider ones are slow.
    odd = text.rlike(r"[\r\x0b\x0c\x1c\x1d\x1e\x85]") | _holds(text, "\u2028", "\u2029")
    plain = F.regexp_replace(text, rf"\r\n|[{_OTHER_BREAKS}]", "\n")
    return F.split(F.when(odd, plain).otherwise(text), "\n")


def _hinted(text: Column) -> Column:
    """Whether ``text`` may hold boilerplate at all."""

    def any_hint(folded: Column) -> Column:
        found = F.lit(False)
        for parts in BOILERPLATE_HINTS:
            present = _holds(folded, parts[0])
            for part in parts[1:]:
                present = present & _holds(folded, part)
            found = found | present
        return found

    return let(F.upper(text), any_hint)


def _squeeze(text: Column) -> Column:
    """One space for each run of blanks."""
    return F.when(_holds(text, "  ", "\t", "\u00a0"), F.regexp_replace(text, _BLANKS, " ")).otherwise(text)


def _close_up(text: Column) -> Column:
    """At most one empty line in a row."""
    return F.when(_holds(text, "\n\n\n"), F.regexp_replace(text, "\n{3,}", "\n\n")).otherwise(text)


def is_boilerplate(line: Column) -> Column:
    return _hinted(line) & strip_space(line).rlike(_BOILERPLATE)


def _kept_lines(text: Column) -> Column:
    lines = split_lines(text)
    return F.when(_hinted(text), F.filter(lines, lambda line: ~is_boilerplate(line))).otherwise(lines)


def drop_boilerplate(text: Column) -> Column:
    """``text`` without its boilerplate lines."""
    return F.array_join(_kept_lines(text), "\n")


def clean_text(raw: Column) -> Column:
    """Markup out, boilerplate lines out, white space in order; NULL gives ''.

    Runs of blanks become one blank, lines are trimmed, at most one empty line stays in a row.
    """

    def tidy(text: Column) -> Column:
        trimmed = F.array_join(F.transform(_kept_lines(text), strip_space), "\n")
        return strip_space(let(let(trimmed, _squeeze), _close_up))

    return let(strip_html(F.coalesce(raw, F.lit(""))), tidy)


def video_id(url: Column) -> Column:
    """The eleven-character id in a watch or short link, or NULL."""
    return or_null(F.regexp_extract(url, r"(?:v=|youtu\.be/)([A-Za-z0-9_-]{11})", 1))
