"""HTML columns: containers, visible text, preview pictures."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from curate.functions.text import ENTITIES, resolve_entities, strip, unescape
from curate.functions.urls import resolve

# Where the main text of a page is looked for, in this order.
SELECTORS = (
    "article",
    "main",
    '[role="main"]',
    ".post-content",
    ".entry-content",
    ".td-post-content",
    "#content",
    ".content",
    "#main-content",
    ".main-content",
    "#article-body",
    ".article-body",
)
BODY = "body"

# What a page without a container loses, besides sidebars.
BOILERPLATE = "nav|header|footer|aside"

# Parts of a picture address that mark it as no picture of the article, the
# file endings of pictures, and the least side in pixels.
NO_CONTENT_PICTURE = "ad|banner|sponsor|logo|avatar|icon|spinner|loading|pixel"
PICTURE_ENDINGS = r"[.](?:jpg|jpeg|png|webp)\z"
LEAST_SIDE = 100

# Stands for a removed tag until the pieces of text are joined.
MARK = "\x01"
NOISE = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<script(?=[\s/>])[^>]*>.*?(?:</script\s*>|\z)"
    r"|<style(?=[\s/>])[^>]*>.*?(?:</style\s*>|\z)"
)
# The bound keeps the matcher's stack small; a tag beyond it goes to the tag-by-tag reading.
TAG = (
    r"""<[A-Za-z/!?][^<>"']*+(?:"[^"<>]*+"[^<>"']*+|'[^'<>]*+'[^<>"']*+){0,200}+>"""
)


def _attribute(name: str, value: str) -> str:
    return rf"""<[A-Za-z][^>]*?(?i:\s{name}\s*=\s*)(?:"{value}"|'{value}'|{value}(?=[\s/>]))[^>]*>"""


def _opening(selector: str) -> str:
    if selector.startswith("."):
        name = selector[1:]
        return (
            rf"""<[A-Za-z][^>]*?(?i:\sclass\s*=\s*)(?:"(?:[^">]*\s)?{name}(?:\s[^">]*)?\""""
            rf"""|'(?:[^'>]*\s)?{name}(?:\s[^'>]*)?'|{name}(?=[\s/>]))[^>]*>"""
        )
    if selector.startswith("#"):
        return _attribute("id", selector[1:])
    if selector.startswith("["):
        return _attribute("role", "main")
    return rf"(?i:<{selector}(?=[\s/>]))[^>]*>"


def _block(selector: str) -> str:
    """The first container a selector finds, up to the nearest end tag of its name."""
    opening = _opening(selector)
    if selector[0] in ".#[":
        named = opening.replace("<[A-Za-z]", r"<([A-Za-z][^\s/>]*)(?=[\s/>])", 1)
        return rf"(?s){named}.*?(?i:</\1\s*>)"
    return rf"(?s){opening}.*?(?i:</{selector}\s*>)"


# A value with something in it that looks like an attribute by which containers are found.
QUOTED = r"""(?is)(<[a-z][^<>]*?=\s*)(?:"[^"<>]*\s(?:class|id|role)\s*=[^"<>]*"|'[^'<>]*\s(?:class|id|role)\s*=[^'<>]*')"""
# Elements that have no end tag.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")


def plain_values(clean: Column) -> Column:
    """A page whose attributes hold no values that look like other attributes: up to three a tag are emptied."""
    emptied = clean
    for _ in range(3):
        emptied = F.regexp_replace(emptied, QUOTED, '$1""')
    return F.when(clean.rlike(QUOTED), emptied).otherwise(clean)


def without_noise(html: Column) -> Column:
    """A page less its comments, scripts and styles."""
    return F.regexp_replace(html, NOISE, MARK)


def selector_hit(clean: Column) -> Column:
    """The first selector that finds a container, else `body`, else NULL."""
    hit = F.when(F.lit(False), F.lit(""))
    for selector in SELECTORS:
        hit = hit.when(clean.rlike(_opening(selector)), F.lit(selector))
    return hit.when(clean.rlike(r"(?i)<body(?=[\s/>])[^>]*>"), F.lit(BODY))


def container(clean: Column, hit: Column) -> Column:
    """The container `hit` names, tags included; empty where it is not closed."""
    found = F.when(F.lit(False), F.lit(""))
    for selector in SELECTORS:
        found = found.when(hit == selector, F.regexp_extract(clean, _block(selector), 0))
    body = F.regexp_extract(clean, r"(?is)<body(?=[\s/>])[^>]*>.*?(?:</body\s*>|</html\s*>|\z)", 0)
    bare = F.regexp_replace(
        body, rf"(?is)<({BOILERPLATE})(?=[\s/>])[^>]*>.*?</\1\s*>", MARK
    )
    return found.when(hit == BODY, bare)


def pieces(block: Column) -> Column:
    """A container with a mark in place of each tag."""
    return F.regexp_replace(block, TAG, MARK)


def _occurrences(text: Column, part: Column) -> Column:
    without = F.replace(text, part, F.lit(""))
    return (F.octet_length(text) - F.octet_length(without)) / F.octet_length(part)


def by_tag(clean: Column) -> Column:
    """A page cut before each of its tags."""
    return F.split(clean, "(?=</?[A-Za-z])", -1)


def container_place(parts: Column, clean: Column, hit: Column) -> Column:
    """Which of the parts begins the container that `hit` names, from 1; NULL for the body."""
    rest = F.when(F.lit(False), F.lit(""))
    for selector in SELECTORS:
        rest = rest.when(hit == selector, F.regexp_extract(clean, rf"(?s){_opening(selector)}.*", 0))
    return F.size(parts) - F.size(by_tag(rest)) + 1


def container_end(parts: Column, first: Column) -> Column:
    """With which part the container closes that begins with part `first`, whatever nests in it; one more than there are
    if it is never closed, NULL if a tag cannot be told to be closed in itself.

    A walk over the tags keeps those that are open: a start tag adds one, an end tag closes the last open one of its
    name and all within, and nothing if none is open. The container ends where fewer are open than began it.
    """
    def tag(part: Column) -> Column:
        name = F.lower(F.regexp_extract(part, r"^</?([A-Za-z][^\s/>]*)", 1))
        none = (name == "") | name.isin(*VOID)
        return F.struct(
            name.alias("name"),
            F.when(none, 0).when(part.startswith("</"), -1).when(part.rlike("^<[A-Za-z][^<>]*/>"), 0).otherwise(1).alias("step"),
            # A slash at the end may belong to a value without quotes.
            part.rlike("""^<[A-Za-z][^<>]*=[^\\s"'<>]*/>""").alias("odd"),
        )

    def walk(state: Column, found: Column) -> Column:
        opened, name = state["opened"], found["name"]
        last = F.size(opened) - F.array_position(F.reverse(opened), name)
        left = (
            F.when(found["step"] == 1, F.concat(opened, F.array(name)))
            .when(found["step"] == 0, opened)
            .when(F.get(opened, F.size(opened) - 1) == name, F.slice(opened, 1, F.size(opened) - 1))
            .when(F.array_contains(opened, name), F.slice(opened, F.lit(1), last.cast("int")))
            .otherwise(opened)
        )
        at = state["at"] + 1
        within = F.when(at == first, F.size(opened) + 1).otherwise(state["within"])
        return F.when((state["end"] > 0) | state["odd"], state).otherwise(F.struct(
            left.alias("opened"), at.alias("at"), within.alias("within"),
            F.when((at >= first) & (F.size(left) < within), at).otherwise(0).alias("end"), found["odd"].alias("odd"),
        ))

    start = F.struct(
        F.array().cast("array<string>").alias("opened"), F.lit(0).alias("at"), F.lit(0).alias("within"), F.lit(0).alias("end"),
        F.lit(False).alias("odd"),
    )

    def end(state: Column) -> Column:
        return F.when(~state["odd"], F.when(state["end"] > 0, state["end"]).otherwise(state["at"] + 1))

    return F.when(first.isNotNull(), F.aggregate(F.transform(parts, tag), start, walk, end))


def from_to(parts: Column, first: Column, end: Column) -> Column:
    """The container between two parts; NULL if `end` is."""
    # The last part ends with its tag; what follows is outside.
    last = F.when(end <= F.size(parts), F.regexp_extract(F.get(parts, end - 1), "^[^>]*>", 0)).otherwise("")
    return F.concat(F.array_join(F.slice(parts, first, end - first), ""), last)


def tangled(html: Column, clean: Column, marked: Column, lower: Column) -> Column:
    """True where expressions cannot read the strings of a container, marked and in lower case."""
    known = "|".join(entity[1:-1] for entity, _ in ENTITIES)
    entity = (
        rf"&(?!(?:{known});)"
        r"(?:#|[A-Za-z][A-Za-z0-9]*;|(?:lt|gt|amp|quot|nbsp|copy|reg)(?![A-Za-z0-9;]))"
    )
    return (
        html.contains(MARK)
        | clean.rlike(QUOTED)
        # A tag that another begins in: the parser takes both for one.
        | clean.rlike("<[A-Za-z/!?][^<>]*<")
        | lower.contains("<template") | lower.contains("<rt") | lower.contains("<rp")
        | marked.rlike("<[A-Za-z/!?]")
        | (marked.contains("&") & marked.rlike(entity))
    )


def nests(hit: Column, block: Column, lower: Column) -> Column:
    """True where the nearest end tag may not be the end of the container.

    It may be true too often, at the price of a slower reading, but never too seldom. `lower`
    is the block in lower case: plain searches in it cost far less than patterns.
    """
    inside_itself = (
        F.when(hit == BODY, F.lit(False))
        .when(hit.rlike("^[a-z]"), _occurrences(lower, F.concat(F.lit("<"), hit)) > 1)
        .otherwise(block.rlike(r"(?is)^<([a-z][^\s/>]*)(?=[\s/>]).+?<\1(?=[\s/>])"))
    )
    ends_too_much = F.lit(False)
    for tag in ("div", "section", "main"):
        ends_too_much = ends_too_much | (
            _occurrences(lower, F.lit(f"</{tag}")) > _occurrences(lower, F.lit(f"<{tag}"))
        )
    return (
        (block == "")
        | inside_itself
        | ends_too_much
        | ((hit == BODY) & (
            lower.rlike(rf"</?(?:{BOILERPLATE})(?=[\s/>])")
            | block.rlike(_opening(".sidebar"))
            | block.rlike(_opening("#sidebar"))
        ))
    )


def visible_text(marked: Column) -> Column:
    """The strings between marks, stripped, empty ones dropped, one per line."""
    resolved = F.when(marked.contains("&"), unescape(marked)).otherwise(marked)
    strings = F.transform(F.split(resolved, MARK), strip)
    return F.array_join(F.filter(strings, lambda string: string != ""), "\n")


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of one tag; NULL where the tag lacks it."""
    written = F.nullif(
        F.regexp_extract(tag, rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", 1), F.lit("")
    )
    return resolve_entities(F.regexp_replace(written, """^["']|["']$""", ""))


def _tag(name: str) -> str:
    """A tag with its attributes, whose values may hold what else would end it."""
    return rf"""(?is)<{name}(?=[\s/])[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>"""


def og_image(clean: Column) -> Column:
    """Preview picture a page names for itself; NULL where it names none."""
    named = F.filter(
        F.regexp_extract_all(clean, F.lit(_tag("meta")), F.lit(0)),
        lambda tag: F.coalesce(attribute(tag, "property") == "og:image", F.lit(False)),
    )
    return F.nullif(attribute(F.try_element_at(named, F.lit(1)), "content"), F.lit(""))


def pictures(clean: Column) -> Column:
    """The picture tags of a page in order, with their address and declared sides."""
    tags = F.regexp_extract_all(clean, F.lit(_tag("img")), F.lit(0))
    return F.transform(tags, lambda tag: F.struct(
        attribute(tag, "src").alias("source"),
        attribute(tag, "width").alias("width"),
        attribute(tag, "height").alias("height"),
    ))


def _side(declared: Column) -> Column:
    """A declared side; 0 where none is declared, NULL where it is no whole number."""
    whole = F.regexp_extract(declared, r"\A\s*([+-]?[0-9]+)\s*\z", 1).try_cast("bigint")
    return F.when(declared.isNull(), F.lit(0)).otherwise(whole)


def _shows_content(picture: Column) -> Column:
    source = picture["source"]
    width, height = _side(picture["width"]), _side(picture["height"])
    # One unreadable side makes the page's other declaration count for nothing.
    small = width.isNotNull() & height.isNotNull() & (
        width.between(1, LEAST_SIDE - 1) | height.between(1, LEAST_SIDE - 1)
    )
    return (
        F.lower(source).rlike(PICTURE_ENDINGS)
        & ~source.startswith("data:image")
        & ~F.lower(source).rlike(NO_CONTENT_PICTURE)
        & ~F.coalesce(small, F.lit(False))
    )


def first_content_picture(found: Column) -> Column:
    """Address of the first picture that belongs to the article; NULL if there is none."""
    return F.try_element_at(F.filter(found, _shows_content), F.lit(1))["source"]


def absolute(url: Column, source: Column) -> Column:
    """A picture's address as seen from its page."""
    return F.when(source.rlike("^https?://"), source).otherwise(resolve(url, source))
