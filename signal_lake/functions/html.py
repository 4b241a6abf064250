"""Markup as native expressions: text of a page, of an element, of a title."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

from signal_lake.functions.space import let, or_null, strip_space

# Elements whose text is no text of the page.
_OPAQUE = "script|style|template|rt|rp"
_COMMENT = r"<!--.*?(?:-->|\z)"
_OPAQUE_BLOCK = rf"<({_OPAQUE})(?![a-z0-9-])[^>]*+>.*?(?:</\1\s*+>|\z)"
_TAG = r"<[a-z/!?](?:[^>\"']*+(?:\"[^\"]*+\"|'[^']*+'))*+[^>\"']*+>"
# Attributes of a tag up to some point, and up to its end; a quoted value may hold a ``>``.
_SOME = r"(?:[^>\"']*+(?:\"[^\"]*+\"|'[^']*+'))*?[^>\"']*?"
_REST = r"(?:[^>\"']*+(?:\"[^\"]*+\"|'[^']*+'))*+[^>\"']*+"
_LOOSE_TAG = r"<[a-z/!?][^>]*+(?:>|\z)"
_MARKUP = f"(?is){_COMMENT}|{_OPAQUE_BLOCK}|{_TAG}|{_LOOSE_TAG}"
_HIDDEN = f"(?is){_COMMENT}|{_OPAQUE_BLOCK}"
# Stands for markup between two text nodes; a control character no page text holds.
_GAP = "\x01"

_COMMON = ["amp", "lt", "gt", "quot", "nbsp"]
_NAMED = {name: chr(name2codepoint[name]) for name in [*_COMMON, *sorted(set(name2codepoint) - set(_COMMON))]} | {"apos": "'"}


def _named_entities() -> Column:
    pairs = "\n".join(f"{name}\t{char}" for name, char in _NAMED.items())
    return F.str_to_map(F.lit(pairs), F.lit("\n"), F.lit("\t"))


def _char(code: Column) -> Column:
    """The character of a code point; NULL where there is none."""
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def decode_entities(text: Column) -> Column:
    """Replace named and numeric character references; leave what is no reference as it stands."""

    def decode_piece(piece: Column) -> Column:
        pattern = r"^(?:#[0-9]{1,7};?|#[xX][0-9a-fA-F]{1,6};?|[A-Za-z][A-Za-z0-9]*;)"
        return let(F.regexp_extract(piece, pattern, 0), lambda reference: replaced(piece, reference))

    def replaced(piece: Column, reference: Column) -> Column:
        body = F.rtrim(reference, F.lit(";"))
        rest = F.substr(piece, F.length(reference) + 1)
        return let(
            meaning(body),
            lambda char: F.when(char.isNull(), F.concat(F.lit("&"), piece)).otherwise(F.concat(char, rest)),
        )

    def meaning(body: Column) -> Column:
        decimal = F.substring(body, 2, 8).try_cast("bigint")
        hexadecimal = F.conv(F.substring(body, 3, 6), 16, 10).try_cast("bigint")
        return (
            F.when(body == "", None)
            .when(body.rlike("^#[0-9]"), _char(decimal))
            .when(body.startswith("#"), _char(hexadecimal))
            .otherwise(F.try_element_at(_named_entities(), body))
        )

    def decoded(pieces: Column) -> Column:
        tail = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), decode_piece)
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(tail, ""))

    return F.when(text.contains("&"), let(F.split(text, "&"), decoded)).otherwise(text)


def expand_named(xml: Column) -> Column:
    """Named references that XML doesn't know, as their characters; its own five and what is no name stay."""

    def expanded(piece: Column) -> Column:
        name = F.regexp_extract(piece, "^([A-Za-z][A-Za-z0-9]*);", 1)
        char = F.when(~name.isin("", "amp", "lt", "gt", "quot", "apos"), F.try_element_at(_named_entities(), name))
        rest = F.substr(piece, F.length(name) + 2)
        return F.when(char.isNull(), F.concat(F.lit("&"), piece)).otherwise(F.concat(char, rest))

    def joined(pieces: Column) -> Column:
        tail = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), expanded)
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(tail, ""))

    foreign = xml.rlike("&(?!(?:amp|lt|gt|quot|apos);)[A-Za-z]")
    return F.when(foreign, let(F.split(xml, "&"), joined)).otherwise(xml)


def _gapped(html: Column) -> Column:
    return decode_entities(F.regexp_replace(F.translate(html, _GAP, ""), _MARKUP, _GAP))


def strip_html(text: Column) -> Column:
    """Text nodes joined by a line break; text without ``<`` is left alone, entities included."""
    nodes = F.regexp_replace(F.btrim(_gapped(text), F.lit(_GAP)), f"{_GAP}+", "\n")
    return F.when(text.contains("<"), nodes).otherwise(text)


def page_text(html: Column) -> Column:
    """Text nodes trimmed, blank ones dropped, joined by a line break."""
    nodes = F.transform(F.split(_gapped(html), f"{_GAP}+"), strip_space)
    return F.array_join(F.filter(nodes, lambda node: node != ""), "\n")


def visible_markup(html: Column) -> Column:
    """The page without comments and without elements that hold no text."""
    return F.regexp_replace(html, _HIDDEN, "")


def _opening_tag(selector: Column) -> Column:
    """Pattern of the opening tag for ``tag``, ``.class`` or ``#id``; a constant folds to one pattern."""
    name = F.regexp_replace(F.ltrim(selector, F.lit(".#")), r"([^A-Za-z0-9_])", r"\\$1")

    def filled(template: str) -> Column:
        return F.concat(*[part for text in template.split("NAME") for part in (F.lit(text), name)][:-1])

    start, end = rf"(?s)<[A-Za-z][A-Za-z0-9-]*(?=\s){_SOME}\s", f"{_REST}>"
    by_class = r"(?i:class)\s*=\s*(?:\"(?:[^\"]*\s)?NAME(?:\s[^\"]*)?\"|'(?:[^']*\s)?NAME(?:\s[^']*)?'|NAME(?=[\s>]))"
    by_id = r"(?i:id)\s*=\s*(?:\"NAME\"|'NAME'|NAME(?=[\s>]))"
    return (
        F.when(selector.startswith("."), filled(start + by_class + end))
        .when(selector.startswith("#"), filled(start + by_id + end))
        .otherwise(filled(rf"(?s)<(?i:NAME)(?![A-Za-z0-9-]){_REST}>"))
    )


def _selector(selector: Column | str) -> Column:
    return F.lit(selector) if isinstance(selector, str) else selector


def element_exists(html: Column, selector: Column | str) -> Column:
    return F.regexp_like(html, _opening_tag(_selector(selector)))


def element_html(html: Column, selector: Column | str) -> Column:
    """Inner markup of the first element the selector meets, nested elements of its name included.

    The markup after the opening tag is cut before each opening or closing tag of the same name; the
    pieces are counted up to the one that closes the element. NULL where there is no such element.
    """
    opening = _opening_tag(_selector(selector))

    def inner(tag: Column) -> Column:
        after = F.get(F.split(html, opening, 2), F.lit(1))
        pieces = F.split(after, F.concat(F.lit("(?i)(?=</?"), tag, F.lit("(?![a-z0-9-]))")))
        return let(pieces, lambda cut: F.array_join(F.slice(cut, F.lit(1), taken(cut, tag)), ""))

    def taken(cut: Column, tag: Column) -> Column:
        def step(state: Column, piece: Column) -> Column:
            head = F.lower(F.substr(piece, F.lit(1), F.length(tag) + 2))
            turn = F.when(head == F.concat(F.lit("</"), tag), -1).when(head.startswith(F.concat(F.lit("<"), tag)), 1)
            depth = state["depth"] + F.coalesce(turn, F.lit(0))
            walked = F.struct(depth.alias("depth"), (state["taken"] + (depth > 0).cast("int")).alias("taken"))
            return F.when(state["depth"] == 0, state).otherwise(walked)

        start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("taken"))
        return F.aggregate(cut, start, step, lambda state: state["taken"])

    name = F.lower(F.regexp_extract(F.regexp_substr(html, opening), "^<([A-Za-z][A-Za-z0-9-]*)", 1))
    return let(name, lambda tag: F.when(tag != "", inner(tag)))


def element_text(html: Column, selector: Column | str) -> Column:
    return page_text(element_html(html, selector))


def meta_title(html: Column) -> Column:
    """Content of the first ``og:title`` tag, NULL if there is none or it is empty."""
    wanted = rf"(?is)<meta\b(?={_SOME}\bproperty\s*=\s*[\"']?og:title[\"'\s/>]){_REST}>?"
    tag = F.regexp_extract(html, wanted, 0)
    double = F.regexp_extract(tag, r"(?is)\bcontent\s*=\s*\"([^\"]*)\"", 1)
    single = F.regexp_extract(tag, r"(?is)\bcontent\s*=\s*'([^']*)'", 1)
    return decode_entities(F.coalesce(F.nullif(double, F.lit("")), F.nullif(single, F.lit(""))))


def head_title(html: Column) -> Column:
    """Trimmed text of the ``title`` element, NULL if there is none or it is empty."""
    return or_null(strip_space(decode_entities(F.regexp_extract(html, r"(?is)<title(?:\s[^>]*)?>(.*?)</title", 1))))
