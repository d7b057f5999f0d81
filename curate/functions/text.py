"""Text columns: stripping, file-name slugs, CJK spacing, entities."""

import json
import sys
import unicodedata
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python counts as white space.
SPACES = "".join(filter(str.isspace, map(chr, range(0x3001))))

# The decimal digits of all writings, and the ASCII digit of each.
DIGITS = "".join(letter for letter in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(letter) == "Nd")
VALUES = "".join(str(unicodedata.decimal(letter)) for letter in DIGITS)

# Characters a file name may not hold.
FILE_NAME_FORBIDDEN = '?<>:*|"\\/'
FILE_NAME_LENGTH = 255

# Unicode blocks of Chinese, Japanese and bopomofo writing, and the half-width
# characters set apart from them.
CJK = (
    r"\x{2e80}-\x{2eff}\x{2f00}-\x{2fdf}\x{3040}-\x{309f}\x{30a0}-\x{30fa}\x{30fc}-\x{30ff}"
    r"\x{3100}-\x{312f}\x{3200}-\x{32ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}"
)
HALF_WIDTH = r"A-Za-z0-9$%^&*+=|/\\\-\x{370}-\x{3ff}\x{a1}-\x{ff}\x{2150}-\x{218f}\x{2700}-\x{27bf}"
# Marks that are set apart only behind, or only before, CJK writing.
ONLY_BEHIND, ONLY_BEFORE = "@", "~!;:,.?"
# One range around all of CJK, checked first: most characters of other writing fail it at once.
MAYBE_CJK = r"(?=[\x{2e80}-\x{faff}])"

# The entities replaced by expressions. The ampersand comes last, so that an
# escaped entity is not resolved twice.
ENTITIES = (
    ("&quot;", '"'),
    ("&middot;", "·"),
    ("&copy;", "©"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&apos;", "'"),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&amp;", "&"),
)


def strip(text: Column) -> Column:
    """Drop white space at both ends; a plain `trim` drops blanks only."""
    return F.trim(text, F.lit(SPACES))


def ascii_digits(text: Column) -> Column:
    """Decimal digits of any writing as those of ASCII."""
    return F.when(text.rlike("[^\\x00-\\x7F]"), F.translate(text, DIGITS, VALUES)).otherwise(text)


def title_slug(title: Column) -> Column:
    """A title as a file name: no separators, blanks as underscores, at most 255 characters."""
    # Every kind of white space becomes a blank; what has no counterpart is dropped.
    allowed = F.translate(title, SPACES + FILE_NAME_FORBIDDEN, " " * len(SPACES))
    joined = F.regexp_replace(allowed, " +", "_")
    words = F.regexp_replace(joined, r"[^\p{L}\p{N}_.-]", "")
    return F.substring(words, 1, FILE_NAME_LENGTH)


def cjk_spacing(text: Column) -> Column:
    """A blank wherever CJK writing touches Latin letters, digits or symbols."""
    after = F.regexp_replace(text, f"{MAYBE_CJK}([{CJK}])([{ONLY_BEHIND}{HALF_WIDTH}])", "$1 $2")
    return F.regexp_replace(after, f"([{ONLY_BEFORE}{HALF_WIDTH}]){MAYBE_CJK}([{CJK}])", "$1 $2")


def unescape(text: Column) -> Column:
    """Resolve the entities listed in ENTITIES; others stay as they are."""
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


# A numeric or named character reference.
ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def resolve_entities(text: Column, pattern: str = ENTITY, unknown: str = "&") -> Column:
    """Resolve what `pattern` finds, numeric references and all named ones of HTML, in one pass.

    A name that HTML does not know stays as it is, with `unknown` for its ampersand.
    """
    # As JSON, which Spark reads once; two thousand literals would not fit into one method.
    known = {name[:-1]: character for name, character in sorted(html5.items()) if name.endswith(";")}
    names = F.from_json(F.lit(json.dumps(known)), "map<string, string>")

    def character(entity: Column) -> Column:
        name = F.substring(entity, 2, F.length(entity) - 2)
        hexadecimal = F.regexp_extract(name, "^#[xX](.+)$", 1)
        decimal = F.hex(F.regexp_extract(name, "^#([0-9]+)$", 1).try_cast("int"))
        code = F.lpad(F.when(hexadecimal != "", hexadecimal).otherwise(decimal), 8, "0")
        valid = code.rlike("^00(?:0[0-9A-Fa-f]|10)[0-9A-Fa-f]{4}$") & ~code.rlike("^0000(?:0000|[dD][89A-Fa-f])")
        numeric = F.when(valid, F.decode(F.unhex(code), "UTF-32"))
        named = F.try_element_at(names, name)
        other = F.concat(F.lit(unknown), name, F.lit(";"))
        return F.coalesce(F.when(name.startswith("#"), numeric).otherwise(named), other)

    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), character)
    parts = F.zip_with(F.split(text, pattern, -1), found, lambda part, value: F.concat(part, F.coalesce(value, F.lit(""))))
    return F.when(text.contains("&"), F.array_join(parts, "")).otherwise(text)


def blank(text: Column) -> Column:
    """True where a text is missing or empty."""
    return F.coalesce(text == "", F.lit(True))
