"""SQL for what several statements share. Plain SQL only; Spark never sees it."""

# White space for use inside [].
SPACE = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
BLANKS = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
SPACES = "concat(" + ", ".join(f"chr({code})" for code in BLANKS) + ")"
# The entities that the pages of the tables and views hold.
ENTITIES = (("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&lt;", "<"), ("&gt;", ">"), ("&apos;", "'"), ("&#39;", "'"),
            ("&nbsp;", "\xa0"), ("&#038;", "&"), ("&eacute;", "é"), ("&amp;", "&"))
# Chinese, Japanese and bopomofo writing, and what is set apart behind and before it.
CJK = (r"\x{2e80}-\x{2eff}\x{2f00}-\x{2fdf}\x{3040}-\x{309f}\x{30a0}-\x{30fa}\x{30fc}-\x{30ff}\x{3100}-\x{312f}"
       r"\x{3200}-\x{32ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}")
BEHIND = r"A-Za-z0-9@$%^&*+=|/\\\-\x{370}-\x{3ff}\x{a1}-\x{ff}\x{2150}-\x{218f}\x{2700}-\x{27bf}"
BEFORE = r"A-Za-z0-9~$%^&*+=|/!;:,.?\\\-\x{370}-\x{3ff}\x{a1}-\x{ff}\x{2150}-\x{218f}\x{2700}-\x{27bf}"
CLEAN = (
    r"regexp_replace({html}, '(?is)<!--.*?-->|<script(?:[\s/][^>]*)?>.*?</script\s*>"
    r"|<style(?:[\s/][^>]*)?>.*?</style\s*>', chr(1), 'g')"
)


def clean(html: str) -> str:
    return CLEAN.replace("{html}", html)


def unescaped(text: str) -> str:
    for entity, character in ENTITIES:
        character = "chr(39)" if character == "'" else f"'{character}'"
        text = f"replace({text}, '{entity}', {character})"
    return text


def unescaped_text(text: str) -> str:
    """As HTML has it in text: old names count without their semicolon, too."""
    for entity, character in ENTITIES:
        character = "chr(39)" if character == "'" else f"'{character}'"
        optional = "" if entity in ("&apos;", "&#39;") else "?"
        text = f"regexp_replace({text}, '{entity}{optional}', {character}, 'g')"
    return text


def lines(block: str) -> str:
    """Text between tags, one string to a line."""
    marked = rf"regexp_replace({block}, '<[A-Za-z/!?][^>]*>', chr(1), 'g')"
    strings = f"list_transform(string_split({unescaped_text(marked)}, chr(1)), lambda x: trim(x, {SPACES}))"
    return f"array_to_string(list_filter({strings}, lambda x: x <> ''), chr(10))"


def element(html: str, tag: str) -> str:
    return rf"regexp_extract({html}, '(?is)<{tag}(?:[\s/][^>]*)?>.*?</{tag}\s*>', 0)"


def normalized(link: str) -> str:
    return (
        f"CASE WHEN {link} LIKE '//%' THEN concat('https:', {link}) WHEN {link} LIKE 'http://%' OR {link} LIKE 'https://%'"
        f" THEN {link} ELSE concat('https://', {link}) END"
    )


def host(link: str) -> str:
    return rf"replace(regexp_extract({link}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1), 'www.', '')"


def attribute(tag: str, name: str) -> str:
    """Value of an attribute; empty where the tag lacks it."""
    found = rf"""'(?is)\s{name}\s*=\s*(?:"([^"]*)"|([^\s>"]+))'"""
    return unescaped(f"concat(regexp_extract({tag}, {found}, 1), regexp_extract({tag}, {found}, 2))")


def og_image(html: str) -> str:
    meta = rf"""regexp_extract({clean(html)}, '(?is)<meta[^>]*\sproperty="og:image"[^>]*>', 0)"""
    return f"nullif({attribute(meta, 'content')}, '')"


# Fixed values in it: endings of pictures, and parts of addresses that mark no picture of an article.
def first_image(html: str, url: str) -> str:
    """The first fitting picture; resolved for the forms the view of pages uses."""
    source = attribute("x", "src")
    size = "coalesce(try_cast(coalesce(nullif({0}, ''), '0') AS BIGINT), -1)"
    width, height = size.format(attribute("x", "width")), size.format(attribute("x", "height"))
    fits = (
        rf"regexp_matches(lower({source}), '[.](?:jpg|jpeg|png|webp)$') AND NOT {source} LIKE 'data:image%'"
        rf" AND NOT regexp_matches(lower({source}), 'ad|banner|sponsor|logo|avatar|icon|spinner|loading|pixel')"
        f" AND NOT ({width} >= 0 AND {height} >= 0 AND ({width} BETWEEN 1 AND 99 OR {height} BETWEEN 1 AND 99))"
    )
    tags = rf"regexp_extract_all({clean(html)}, '(?is)<img\s[^>]*>')"
    chosen = f"list_extract(list_filter({tags}, lambda x: {fits}), 1)"
    found = attribute(chosen, "src")
    folder = f"regexp_replace(regexp_replace({url}, '[?#].*$', ''), '[^/]*$', '')"
    return (
        f"CASE WHEN {chosen} IS NULL THEN NULL WHEN {found} LIKE 'http%' THEN {found}"
        f" WHEN {found} LIKE '//%' THEN concat(regexp_extract({url}, '^[a-z]+:', 0), {found})"
        f" WHEN {found} LIKE '/%' THEN concat(regexp_extract({url}, '^[a-z]+://[^/]+', 0), {found})"
        f" ELSE concat({folder}, {found}) END"
    )


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def spaced(text: str) -> str:
    """A blank between CJK writing and Latin letters, digits or symbols."""
    after = f"regexp_replace({text}, '([{CJK}])([{BEHIND}])', '\\1 \\2', 'g')"
    return f"regexp_replace({after}, '([{BEFORE}])([{CJK}])', '\\1 \\2', 'g')"


PUBLISHED = "status IN ('complete', 'summarized') AND chinese_summary IS NOT NULL AND chinese_summary <> ''"
