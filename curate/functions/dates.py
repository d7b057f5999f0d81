"""Dates of feed entries."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The zone names of mail dates, as fixed offsets. Others count as UTC.
ZONES = {
    "AST": "-04:00", "ADT": "-03:00", "EST": "-05:00", "EDT": "-04:00", "CST": "-06:00", "CDT": "-05:00",
    "MST": "-07:00", "MDT": "-06:00", "PST": "-08:00", "PDT": "-07:00",
}
MONTHS = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"
CLOCK = r"([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:[.,][0-9]+)?)?"
# Mail dates: the weekday, its comma, the seconds, the whole time and the zone may be missing.
MAIL = (
    r"(?i)^(?:[a-z]+\.?,?\s+)?([0-9]{1,2})[\s-]+([a-z]{3})[a-z]*\.?,?[\s-]+([0-9]{4}|[0-9]{2})"
    rf"(?:\s+{CLOCK})?\s*([a-z]+|[+-][0-9]{{2}}:?[0-9]{{2}})?(?:\s*\(.*\))?$"
)
# ISO dates, with or without separators: a day, a month or a year, and perhaps a time and a zone.
ISO = (
    r"(?i)^([0-9]{4})(?:-?([0-9]{2})(?:-?([0-9]{2}))?)?"
    r"(?:[t\s]+([0-9]{2}):?([0-9]{2})(?::?([0-9]{2})(?:[.,][0-9]+)?)?)?\s*(z|utc|gmt|[+-][0-9]{2}(?::?[0-9]{2})?)?$"
)


def _part(text: Column, form: str, group: int, default: str) -> Column:
    found = F.regexp_extract(text, form, group)
    return F.when(found == "", F.lit(default)).otherwise(found)


def _zone(written: Column) -> Column:
    """An offset as `+hh:mm`."""
    names = F.create_map(*[F.lit(value) for pair in ZONES.items() for value in pair])
    digits = F.rpad(F.regexp_replace(written, "[^0-9]", ""), 4, "0")
    offset = F.concat(F.substring(written, 1, 1), F.substring(digits, 1, 2), F.lit(":"), F.substring(digits, 3, 2))
    return F.when(written.rlike("^[+-]"), offset).otherwise(
        F.coalesce(F.try_element_at(names, F.upper(written)), F.lit("+00:00"))
    )


def _moment(year: Column, month: Column, day: Column, clock: list[Column], zone: Column) -> Column:
    two = [F.lpad(part, 2, "0") for part in (month, day, *clock)]
    text = F.concat(
        year, F.lit("-"), two[0], F.lit("-"), two[1], F.lit("T"), two[2], F.lit(":"), two[3], F.lit(":"), two[4], zone
    )
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))


def feed_timestamp(text: Column) -> Column:
    """A moment from RFC 822 or ISO 8601 text, to the second; NULL where it is neither.

    Text without a zone counts as UTC, whatever the zone of the session. Years of two digits are those
    from 1969 to 2068.
    """
    trimmed = F.trim(text)
    place = F.instr(F.lit(MONTHS), F.upper(F.regexp_extract(trimmed, MAIL, 2)))
    month = F.when(place % 3 == 1, ((place + 2) / 3).cast("int").cast("string"))
    year = F.regexp_extract(trimmed, MAIL, 3)
    century = F.when(F.length(year) == 4, F.lit("")).when(year >= "69", F.lit("19")).otherwise(F.lit("20"))
    mail = _moment(
        F.concat(century, year), month, F.regexp_extract(trimmed, MAIL, 1),
        [_part(trimmed, MAIL, group, "0") for group in (4, 5, 6)], _zone(F.regexp_extract(trimmed, MAIL, 7)),
    )
    iso = _moment(
        F.regexp_extract(trimmed, ISO, 1), _part(trimmed, ISO, 2, "1"), _part(trimmed, ISO, 3, "1"),
        [_part(trimmed, ISO, group, "0") for group in (4, 5, 6)], _zone(F.regexp_extract(trimmed, ISO, 7)),
    )
    return F.when(trimmed.rlike(ISO), iso).when(trimmed.rlike(MAIL), mail)


def utc_date(moment: Column) -> Column:
    """The calendar day in UTC, whatever the zone of the session."""
    return F.to_date(F.to_utc_timestamp(moment, F.current_timezone()))


def entry_date(published: Column, updated: Column) -> Column:
    """Publication day of an entry: the published moment, else the updated one."""
    return utc_date(F.coalesce(feed_timestamp(published), feed_timestamp(updated)))
