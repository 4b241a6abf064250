"""Numbers, dates, fingerprints and small lookups."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from signal_lake.functions.space import is_blank, let, or_null, strip_space

# Item type of each connector's records.
CONTENT_TYPES = {
    "rss_item": "article",
    "tg_message": "post",
    "yt_video": "video",
    "hn_item": "post",
    "web_page": "article",
    "manual": "article",
}
# Marks of a paid message, matched with regard to case.
AD_MARKERS = ["erid:", "Реклама.", "ИНН ", "промокод", "utm_source=telegram"]
MIN_TEXT_LENGTH = 150

_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


def lookup(key: Column, table: dict[str, str]) -> Column:
    """Value of ``key`` in a small fixed table, NULL if it is not there."""
    return F.try_element_at(F.create_map(*[F.lit(part) for pair in table.items() for part in pair]), key)


def strict_int(text: Column) -> Column:
    """A whole number with blanks around it; anything else is NULL."""
    bare = strip_space(text)
    return F.when(bare.rlike(r"^[+-]?[0-9]+(?:_[0-9]+)*$"), F.replace(bare, F.lit("_"), F.lit("")).try_cast("int"))


def lenient_int(text: Column) -> Column:
    """A number cut to its whole part; blank, junk, NaN and infinity are NULL."""
    bare = strip_space(text)
    number = F.when(bare.rlike(r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"), bare.try_cast("double"))
    return number.try_cast("int")


def is_advert(raw_text: Column) -> Column:
    text = F.coalesce(raw_text, F.lit(""))
    marked = F.lit(False)
    for marker in AD_MARKERS:
        marked = marked | text.contains(marker)
    return marked


def is_short(clean: Column) -> Column:
    return F.length(F.coalesce(clean, F.lit(""))) < MIN_TEXT_LENGTH


def content_type(source_content_type: Column) -> Column:
    return F.coalesce(lookup(source_content_type, CONTENT_TYPES), F.lit("unknown"))


def content_hash(source_id: Column, url: Column, title: Column, clean: Column) -> Column:
    """Fingerprint by address, else by source and title, else by source and the head of the text.

    The 300 characters are the definition of the fingerprint, not a cut of the input.
    """
    scoped = F.concat(source_id, F.lit("::"))
    key = (
        F.when(~is_blank(url), F.lower(strip_space(url)))
        .when(~is_blank(title), F.concat(scoped, F.lower(strip_space(title))))
        .otherwise(F.concat(scoped, F.substring(F.coalesce(clean, F.lit("")), 1, 300)))
    )
    return F.sha2(key, 256)


_CLOCK = r"([T\s][0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]+)?)?(?:\s*[AaPp][Mm])?)"
_ZONE = r"\s*(?![AaPp][Mm]\z)([+-][0-9]{2}(?::?[0-9]{2})?|[A-Za-z]{1,5})\z"
# Date forms, told by the start of the text, each with the place of year, month and day.
_DATE_FORMS = {
    r"^([0-9]{4})[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})(?![0-9])": (1, 2, 3),
    r"^([0-9]{4})([0-9]{2})([0-9]{2})(?![0-9:])": (1, 2, 3),
    r"^([0-9]{1,2})[-/.]([0-9]{1,2})[-/.]([0-9]{4})(?![0-9])": (3, 1, 2),
    r"^([0-9]{1,2})(?:st|nd|rd|th)?[\s-]+([A-Za-z]{3,9})\.?,?[\s-]+([0-9]{4})(?![0-9])": (3, 2, 1),
    r"^([A-Za-z]{3,9})\.?\s+([0-9]{1,2})(?:st|nd|rd|th)?,?\s+([0-9]{4})(?![0-9])": (3, 1, 2),
    r"^([0-9]{1,2})[-/.]([0-9]{1,2})[-/.]([0-9]{2})(?![0-9])": (3, 1, 2),
    r"^([0-9]{1,2})(?:st|nd|rd|th)?[\s-]+([A-Za-z]{3,9})\.?,?[\s-]+([0-9]{2})(?![0-9:])": (3, 2, 1),
}
_TIME = r"^(?:T|[\s,]+)([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:[.,]([0-9]{1,6})[0-9]*)?)?\s*([AaPp][Mm])?\z"
_HOUR = r"^(?:T|[\s,]+)([0-9]{1,2})\z"
_PACKED_TIME = r"^T([0-9]{2})([0-9]{2})([0-9]{2})?\z"


def _month(text: Column) -> Column:
    """Number of a month given as a number or a name."""
    place = F.position(F.lower(F.substring(text, 1, 3)), F.lit(_MONTHS)) - 1
    named = F.when((place >= 0) & (place % 3 == 0), (place / 3).cast("int") + 1)
    return F.when(text.rlike("^[0-9]+$"), text.cast("int")).otherwise(named)


def _whole_year(year: Column, moment: Column) -> Column:
    """A year of two digits is the one nearest to ``moment``, of those more than 50 years ahead or behind none."""
    now = F.year(moment)
    near = F.floor(now / 100) * 100 + year.try_cast("int")
    near = F.when(near >= now + 50, near - 100).when(near < now - 50, near + 100).otherwise(near)
    return F.when(F.length(year) == 2, near.cast("string")).otherwise(year)


def _iso_day(local: Column, now: Column) -> Column:
    """``yyyy-mm-dd`` of the date the text starts with; month first, unless only the other reading is a date."""
    day = F.when(F.lit(False), F.lit(None).cast("string"))
    for form, (y, m, d) in _DATE_FORMS.items():
        year, month, date = (F.regexp_extract(local, form, place) for place in (y, m, d))
        number = _month(month)
        flip = (number > 12) & (F.lit((y, m, d) == (3, 1, 2)))
        text = F.format_string(
            "%s-%02d-%02d", _whole_year(year, now),
            F.when(flip, date.try_cast("int")).otherwise(number), F.when(flip, number).otherwise(date.try_cast("int")),
        )
        day = day.when(local.rlike(form), F.when(number.isNotNull(), text))
    return day


def _iso_time(rest: Column) -> Column:
    """``hh:mm:ss.ffffff`` of what follows the date; NULL if that is no time."""

    def part(pattern: str, group: int) -> Column:
        return F.coalesce(or_null(F.regexp_extract(rest, pattern, group)), F.lit("0"))

    half = F.lower(F.regexp_extract(rest, _TIME, 5))
    hour = part(_TIME, 1).cast("int")
    hour = F.when(half == "", hour).when(half == "pm", hour % 12 + 12).otherwise(hour % 12)
    clock = F.concat(
        F.format_string("%02d:", hour), part(_TIME, 2), F.lit(":"), F.lpad(part(_TIME, 3), 2, "0"), F.lit("."), part(_TIME, 4)
    )
    packed = F.concat_ws(":", part(_PACKED_TIME, 1), part(_PACKED_TIME, 2), F.lpad(part(_PACKED_TIME, 3), 2, "0"))
    hour_only = F.concat(F.lpad(F.regexp_extract(rest, _HOUR, 1), 2, "0"), F.lit(":00:00"))
    return (
        F.when(rest == "", F.lit("00:00:00")).when(rest.rlike(_TIME), clock)
        .when(rest.rlike(_HOUR), hour_only).when(rest.rlike(_PACKED_TIME), packed)
    )


def parse_datetime(text: Column, now: Column | None = None) -> Column:
    """Timestamp of a date in ISO, mail, US or month-name form; without a zone it is UTC.

    The parts are put together into one ISO string with its offset, so the result does not depend on
    the session's time zone. A zone name reads as UTC, a partial date is NULL. Years of two
    digits are those nearest to ``now``, when the text was fetched; if that isn't given, to today.
    """
    now = F.current_timestamp() if now is None else now

    def with_zone(bare: Column) -> Column:
        zone = F.regexp_extract(bare, _CLOCK + _ZONE, 2)
        minutes = F.when(F.length(zone) == 3, "00").otherwise(F.right(zone, F.lit(2)))
        numeric = F.concat(F.substring(zone, 1, 3), F.lit(":"), minutes)
        offset = F.when(zone.rlike("^[+-]"), numeric).otherwise(F.lit("Z"))
        local = F.regexp_replace(bare, _CLOCK + _ZONE, "$1")
        return let(local, lambda moment: F.concat(_iso_day(moment, now), F.lit("T"), after_date(moment), offset))

    def after_date(local: Column) -> Column:
        return let(F.regexp_replace(local, "|".join(_DATE_FORMS), ""), _iso_time)

    bare = F.regexp_replace(strip_space(text), r"(?i)^(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+", "")
    return let(bare, with_zone).try_cast("timestamp")
