"""RSS and Atom feeds, read as XML."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from signal_lake.functions.html import expand_named
from signal_lake.functions.scalars import parse_datetime
from signal_lake.functions.space import or_null, strip_space
from signal_lake.sources.common import fetched_at, payload, to_raw_items

DEFAULT_LIMIT = 50

_S = T.StringType()
# Markup in an Atom text is a ``div`` of its own, kept as it is written.
_TEXT = T.StructType([T.StructField("_VALUE", _S), T.StructField("_type", _S), T.StructField("div", _S), T.StructField("xhtml:div", _S)])
_GUID = T.StructType([T.StructField("_VALUE", _S), T.StructField("_isPermaLink", _S)])
_LINK = T.StructType([T.StructField("_VALUE", _S), T.StructField("_href", _S), T.StructField("_rel", _S)])
_CATEGORY = T.StructType([T.StructField("_VALUE", _S), T.StructField("_term", _S)])

RSS_ITEM = T.StructType([
    T.StructField("title", _S), T.StructField("link", _S), T.StructField("description", _S),
    T.StructField("content:encoded", _S), T.StructField("guid", _GUID), T.StructField("pubDate", _S),
    T.StructField("dc:date", _S), T.StructField("author", _S), T.StructField("dc:creator", _S),
    T.StructField("category", T.ArrayType(_CATEGORY)), T.StructField("_rdf:about", _S),
])
ATOM_ENTRY = T.StructType([
    T.StructField("title", _TEXT), T.StructField("link", T.ArrayType(_LINK)), T.StructField("summary", _TEXT),
    T.StructField("content", T.ArrayType(_TEXT)), T.StructField("id", _S), T.StructField("published", _S),
    T.StructField("updated", _S), T.StructField("author", T.ArrayType(T.StructType([T.StructField("name", _S)]))),
    T.StructField("category", T.ArrayType(_CATEGORY)),
])
_BROKEN = T.StructField("_broken", _S)
# Items stand in the channel, or next to it in RSS 1.0.
RSS = T.StructType([
    T.StructField("channel", T.StructType([T.StructField("item", T.ArrayType(RSS_ITEM))])),
    T.StructField("item", T.ArrayType(RSS_ITEM)), _BROKEN,
])
ATOM = T.StructType([T.StructField("entry", T.ArrayType(ATOM_ENTRY)), _BROKEN])

# The common shape of an entry of either kind.
_ENTRY_FIELDS = ["title", "link", "summary", "content", "entry_id", "published", "author", "tags"]


def read_feeds(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Landed feed files, one row each: file_path and xml. A feed is one response of a site, parsed whole; ``feed_dumps`` reads larger files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("xml"))


def _pick(values: Column, fits) -> Column:
    return F.get(F.filter(values, fits), F.lit(0))


def _words(text: Column) -> Column:
    """An Atom text: plain or escaped, or the markup of its ``div``."""
    return F.coalesce(or_null(strip_space(text["_VALUE"])), text["div"], text["xhtml:div"], text["_VALUE"])


def _rss_entry(item: Column) -> Column:
    guid = item["guid"]
    permalink = F.when(F.lower(guid["_isPermaLink"]) == "true", guid["_VALUE"])
    return F.struct(
        item["title"].alias("title"),
        F.coalesce(or_null(item["link"]), permalink).alias("link"),
        item["description"].alias("summary"),
        item["content:encoded"].alias("content"),
        F.coalesce(or_null(guid["_VALUE"]), item["_rdf:about"]).alias("entry_id"),
        F.coalesce(or_null(item["pubDate"]), or_null(item["dc:date"])).alias("published"),
        F.coalesce(or_null(item["dc:creator"]), or_null(item["author"])).alias("author"),
        F.transform(F.coalesce(item["category"], F.array()), lambda c: c["_VALUE"]).alias("tags"),
    )


def _atom_entry(entry: Column) -> Column:
    main = _pick(entry["link"], lambda link: F.coalesce(link["_rel"], F.lit("alternate")) == "alternate")
    html = _pick(entry["content"], lambda content: content["_type"].isin("html", "text/html"))
    return F.struct(
        _words(entry["title"]).alias("title"),
        main["_href"].alias("link"),
        _words(entry["summary"]).alias("summary"),
        _words(F.coalesce(html, F.get(entry["content"], F.lit(0)))).alias("content"),
        entry["id"].alias("entry_id"),
        F.coalesce(or_null(entry["published"]), or_null(entry["updated"])).alias("published"),
        F.get(entry["author"], F.lit(0))["name"].alias("author"),
        F.transform(F.coalesce(entry["category"], F.array()), lambda c: c["_term"]).alias("tags"),
    )


# Namespaces whose elements a feed may name with a prefix of its own.
ATOM_NAMES = ["http://www.w3.org/2005/Atom", "http://purl.org/atom/ns#"]
RSS_NAMES = ["http://purl.org/rss/1.0/", "http://my.netscape.com/rdf/simple/0.9/"]

_PROLOG = r"(?s)\A(?:\s|\x{FEFF}|<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>\[]*(?:\[.*?\]\s*)?>)*"
_ENTRY = r"<(?:[\w.-]+:)?(?:item|entry)[\s>/]"


def root_name(xml: Column) -> Column:
    """Name of the root element as it is written, '' if there is none; what the texts inside mention doesn't matter."""
    return F.regexp_extract(xml, _PROLOG + r"<([\w:.-]+)", 1)


def _outside_cdata(xml: Column, change: Callable[[Column], Column]) -> Column:
    """``change`` applied to what stands outside CDATA sections."""
    parts = F.split(xml, r"(?s)(?=<!\[CDATA\[)|(?<=\]\]>)")
    return F.array_join(F.transform(parts, lambda p: F.when(p.startswith("<![CDATA["), p).otherwise(change(p))), "")


def own_prefix(xml: Column, namespaces: list[str]) -> Column:
    """The prefix that a feed's root gives one of these namespaces, '' if none."""
    names = "|".join(re.escape(n) for n in namespaces)
    return F.regexp_extract(xml, rf"""xmlns:([\w.-]+)\s*=\s*["'](?:{names})["']""", 1)


def _without_prefix(xml: Column, namespaces: list[str]) -> Column:
    """The feed with elements of these namespaces named without the prefix that its root gives them."""
    prefix = own_prefix(xml, namespaces)
    pattern = F.concat(F.lit("(</?)"), F.regexp_replace(prefix, r"([.])", r"\\$1"), F.lit(":"))
    return F.when(prefix == "", xml).otherwise(_outside_cdata(xml, lambda part: F.regexp_replace(part, pattern, F.lit("$1"))))


def _up_to_last_entry(xml: Column, kind: Column, root: Column) -> Column:
    """A feed that breaks off, closed after its last whole entry; NULL if there is none."""
    end = F.when(kind == "atom", "</entry>").otherwise("</item>")
    kept = F.call_function("substring_index", xml, end, F.lit(-1))
    head = F.when(F.contains(xml, end), F.substring(xml, F.lit(1), F.length(xml) - F.length(kept)))
    channel = F.when(F.lower(root) == "rss", "</channel>").otherwise("")
    return F.concat(head, channel, F.lit("</"), root, F.lit(">"))


def _once(rows: DataFrame, *columns: Column) -> DataFrame:
    """``rows`` with these columns computed once a row: a one-element list is opened, past which Spark copies no expressions."""
    return rows.select(F.explode(F.array(F.struct(*columns))).alias("_row")).select("_row.*")


def feed_entries(feeds: DataFrame, keep: list[str], xml: str = "xml") -> tuple[DataFrame, DataFrame]:
    """(entries in feed order with ``pos``, feeds with an error).

    The root element alone tells the kind. A feed that breaks off keeps its whole entries. An error is a feed that yields no entry and doesn't
    parse, is no feed, or holds entries by its text.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    written = root_name(F.col(xml))
    local = F.regexp_replace(written, "^.*:", "")
    kind = F.when(local == "feed", "atom").when(local.isin("rss", "RDF", "channel"), "rss").otherwise("none")
    own = [F.col(name) for name in keep]
    named = _once(feeds, *own, expand_named(F.col(xml)).alias("_named"), kind.alias("_kind"))
    plain = F.when(F.col("_kind") == "atom", _without_prefix(F.col("_named"), ATOM_NAMES)).when(F.col("_kind") == "rss", _without_prefix(F.col("_named"), RSS_NAMES))
    readable = _once(named, *own, F.col("_kind"), plain.alias("_xml"))
    is_atom = F.col("_kind") == "atom"
    rss, atom = F.from_xml("_xml", RSS, options), F.from_xml("_xml", ATOM, options)
    roots = _once(readable, *own, F.col("_kind"), F.col("_xml"), F.when(F.col("_kind") == "rss", rss).alias("_rss"), F.when(is_atom, atom).alias("_atom"))
    items = F.when(F.size("_rss.channel.item") > 0, F.col("_rss.channel.item")).otherwise(F.col("_rss.item"))
    whole = F.when(is_atom, F.transform("_atom.entry", _atom_entry)).otherwise(F.transform(items, _rss_entry))
    broken = F.coalesce("_rss._broken", "_atom._broken").isNotNull() | (F.col("_kind") == "none")
    # Only feeds that broke are parsed a second time, up to their last whole entry.
    cut = F.when(broken & (F.coalesce(F.size(whole), F.lit(0)) <= 0), _up_to_last_entry(F.col("_xml"), F.col("_kind"), root_name(F.col("_xml"))))
    first = _once(roots, *own, F.col("_kind"), F.col("_xml"), whole.alias("_whole"), broken.alias("_broken"), cut.alias("_cut"))
    again_rss, again_atom = F.from_xml("_cut", RSS, options), F.from_xml("_cut", ATOM, options)
    second = _once(
        first, *own, F.col("_xml"), F.col("_whole"), F.col("_broken"),
        F.when(F.col("_cut").isNotNull() & (F.col("_kind") == "rss"), again_rss).alias("_rss"),
        F.when(F.col("_cut").isNotNull() & (F.col("_kind") == "atom"), again_atom).alias("_atom"),
    )
    saved_items = F.when(F.size("_rss.channel.item") > 0, F.col("_rss.channel.item")).otherwise(F.col("_rss.item"))
    saved = F.coalesce(F.transform("_atom.entry", _atom_entry), F.transform(saved_items, _rss_entry))
    has = F.coalesce(F.size("_whole"), F.lit(0)) > 0
    text = F.regexp_replace("_xml", r"(?s)<!\[CDATA\[.*?\]\]>|<!--.*?-->", "")
    mentions = F.coalesce(text.rlike(_ENTRY), F.lit(False))
    parsed = second.select(*keep, F.when(has, F.col("_whole")).otherwise(saved).alias("_entries"), (F.col("_broken") | (~has & mentions)).alias("_broken"))
    failed = parsed.where((F.coalesce(F.size("_entries"), F.lit(0)) <= 0) & F.col("_broken"))
    # The outer form keeps Spark from parsing the feed a second time for a filter on empty lists.
    opened = parsed.select(*keep, F.posexplode_outer("_entries").alias("pos", "_entry"))
    opened = opened.where(F.col("pos").isNotNull()).select(*keep, "pos", "_entry.*")
    return opened, failed.select(*keep, F.lit("feed parse error").alias("message"))


def feed_items(entries: DataFrame, keep: list[str]) -> DataFrame:
    """Entries to raw items: summary before content, own id before link."""
    return to_raw_items(
        entries,
        keep,
        external_content_id=F.coalesce(or_null(F.col("entry_id")), or_null(F.col("link"))),
        source_content_type=F.lit("rss_item"),
        title="title",
        raw_text=F.coalesce(or_null(F.col("summary")), or_null(F.col("content")), F.lit("")),
        url="link",
        author_name="author",
        published_at=parse_datetime(F.col("published"), fetched_at(entries)),
        raw_payload=payload(F.col("entry_id").alias("feed_id"), "tags"),
    )
