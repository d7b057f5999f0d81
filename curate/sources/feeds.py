"""Entries of landed feed documents.

Documents lie in one folder per feed, `feed_url=<escaped address>`, as Spark writes them with
`partitionBy("feed_url")`; each is RSS or Atom. Feeds are seldom well-formed: entities that only HTML
knows are resolved and bare ampersands escaped before an entry is parsed.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curate.functions.text import ENTITY, resolve_entities

RSS_ITEM = (
    "title string, link string, guid struct<_VALUE: string, _isPermaLink: string>, pubDate string, "
    "`dc:date` string, updated string"
)
ATOM_ENTRY = (
    "title string, link array<struct<_href: string, _rel: string>>, published string, "
    "updated string"
)


def rss_item(item: Column) -> Column:
    """An entry of RSS. A permanent identifier serves as link where an item has no link."""
    named = F.lower(F.coalesce(item["guid"]["_isPermaLink"], F.lit("true"))) != "false"
    return F.struct(
        item["title"].alias("title"),
        F.coalesce(item["link"], F.when(named, item["guid"]["_VALUE"])).alias("link"),
        item["pubDate"].alias("published"), F.coalesce(item["dc:date"], item["updated"]).alias("updated"),
        item["malformed"].alias("malformed"),
    )


def atom_entry(entry: Column) -> Column:
    """An entry of Atom. The alternate link is the article; other relations point elsewhere."""
    alternate = F.filter(entry["link"], lambda link: F.coalesce(link["_rel"], F.lit("alternate")) == "alternate")
    return F.struct(
        entry["title"].alias("title"), F.try_element_at(alternate, F.lit(1))["_href"].alias("link"),
        entry["published"].alias("published"), entry["updated"].alias("updated"), entry["malformed"].alias("malformed"),
    )


# Sections that hold text as it is, and names that HTML has beyond the five of XML.
DATA = r"(?s)<!\[CDATA\[.*?\]\]>"
COMMENT = r"(?s)<!--.*?-->"
OF_HTML = r"&(?!(?:amp|lt|gt|quot|apos);)[A-Za-z][A-Za-z0-9]{1,31};"


def repaired(text: Column) -> Column:
    """XML text with HTML's entities as characters, and ampersands that begin no entity escaped."""
    def escaped(part: Column) -> Column:
        return resolve_entities(F.regexp_replace(part, f"&(?!{ENTITY[1:]})", "&amp;"), OF_HTML, "&amp;")

    parts = F.zip_with(
        F.transform(F.split(text, DATA, -1), escaped), F.regexp_extract_all(text, F.lit(DATA), F.lit(0)),
        lambda outside, inside: F.concat(outside, F.coalesce(inside, F.lit(""))),
    )
    return F.array_join(parts, "")


def _parsed(documents: DataFrame) -> DataFrame:
    """The entries of whole documents (`value`, and other columns that stay), each parsed on its own, by its kind. An
    entry that cannot be read even so has its text in `malformed` and NULL elsewhere.

    One scan cuts out items and entries. Text sections and comments are stepped over as a whole, in entries and
    between them; an entry that is closed in its own tag has nothing in it and is left out.
    """
    whole, tag = rf"{COMMENT}|{DATA}", "item|entry"
    closed = rf"""<(?:{tag})(?:\s+[^\s<>/="']+\s*=\s*(?:"[^"<]*"|'[^'<]*'))*+\s*/>"""
    pattern = rf"{whole}|{closed}|(<({tag})(?=[\s/>])(?:[^<]++|{whole}|<(?!/\2\s*>))*+</\2\s*>)"
    found = F.regexp_extract_all("value", F.lit(pattern), F.lit(1))
    kept = [name for name in documents.columns if name != "value"]
    each = documents.select(*kept, F.explode(F.filter(found, lambda raw: raw != "")).alias("raw"))

    def read(schema: str) -> Column:
        return F.from_xml(
            repaired(F.col("raw")), f"{schema}, malformed string", {"columnNameOfCorruptRecord": "malformed"}
        )

    is_item = F.col("raw").startswith("<item")
    read_once = each.select(
        *kept, F.when(is_item, read(RSS_ITEM)).alias("item"), F.when(~is_item, read(ATOM_ENTRY)).alias("entry")
    )
    entry = F.when(F.col("item").isNotNull(), rss_item(F.col("item"))).otherwise(atom_entry(F.col("entry")))
    # Out of a generator, so that later filters on a date do not parse the entry again for each part of it.
    return read_once.select(F.explode(F.array(entry)).alias("entry"), *kept).select("entry.*", *kept)


def _documents(source) -> DataFrame:
    return source.format("text").option("wholetext", True).schema("value string, feed_url string")


def unread_entries(spark: SparkSession, path: str) -> DataFrame:
    """`feed_url` and text of the entries below `path` that cannot be read."""
    found = _parsed(_documents(spark.read).load(path))
    return found.select("feed_url", "malformed").where(F.col("malformed").isNotNull())


def feed_entries(spark: SparkSession, path: str) -> DataFrame:
    """Entries of all documents below `path`, as `title, link, published, updated, feed_url`."""
    return _parsed(_documents(spark.read).load(path)).drop("malformed")


def stream_feed_entries(spark: SparkSession, path: str, files_per_batch: int = 10_000) -> DataFrame:
    """The same as a stream over the documents that arrive below `path`."""
    documents = _documents(spark.readStream.option("maxFilesPerTrigger", files_per_batch)).load(path)
    return _parsed(documents).drop("malformed")
