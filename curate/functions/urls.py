"""URL columns: normal form, host, video links, resolving a relative link."""

from pyspark.sql import Column
from pyspark.sql import functions as F

AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)"
QUERY = r"^[^?#]*\?([^#]*)"

# Hosts of the video site and the address of its preview pictures.
WATCH_HOSTS = ("www.youtube.com", "youtube.com")
WATCH_HOSTS_WITH_PREVIEW = ("www.youtube.com",)
SHORT_HOST = "youtu.be"
PREVIEW = ("https://img.youtube.com/vi/", "/0.jpg")


def normalize_url(link: Column) -> Column:
    """The address a page is fetched from: https where the link names no web scheme."""
    return (
        F.when(link.startswith("//"), F.concat(F.lit("https:"), link))
        .when(link.startswith("http://") | link.startswith("https://"), link)
        .otherwise(F.concat(F.lit("https://"), link))
    )


def authority(link: Column) -> Column:
    return F.regexp_extract(link, AUTHORITY, 1)


def source_host(link: Column) -> Column:
    """Host with port and case kept, less every `www.`; empty where the link has no host."""
    return F.replace(authority(link), F.lit("www."), F.lit(""))


def _watch_parameter(link: Column) -> Column:
    raw = F.regexp_extract(F.regexp_extract(link, QUERY, 1), "(?:^|&)v=([^&]+)", 1)
    return F.nullif(F.coalesce(F.try_url_decode(raw), raw), F.lit(""))


def _short_path(link: Column) -> Column:
    return F.substring(F.regexp_replace(F.regexp_extract(link, PATH, 1), ";[^/]*$", ""), 2, 2**31 - 1)


def video_id(link: Column, watch_hosts: tuple[str, ...] = WATCH_HOSTS) -> Column:
    host = authority(link)
    return F.when(host.isin(*watch_hosts), _watch_parameter(link)).when(
        host == SHORT_HOST, _short_path(link)
    )


def video_thumbnail(link: Column) -> Column:
    """Preview picture of a video link; the bare watch host has none, unlike in `video_id`."""
    found = F.nullif(video_id(link, WATCH_HOSTS_WITH_PREVIEW), F.lit(""))
    return F.concat(F.lit(PREVIEW[0]), found, F.lit(PREVIEW[1]))


def _without_dots(path: Column) -> Column:
    """Resolve `.` and `..` in an absolute path."""
    closed = F.regexp_replace(path, r"/(\.\.?)$", "/$1/")
    kept = F.aggregate(
        F.split(F.regexp_replace(closed, "^/", ""), "/"),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(part == ".", done)
        .otherwise(F.concat(done, F.array(part))),
    )
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def resolve(base: Column, link: Column) -> Column:
    """`link` as seen from the page at `base`."""
    scheme = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    root = F.concat(scheme, F.lit("://"), authority(base))
    folder = F.regexp_extract(F.regexp_extract(base, PATH, 1), "^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    tail = F.regexp_extract(link, r"([?#].*)$", 1)
    path = F.regexp_extract(link, r"^([^?#]*)", 1)
    return (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, _without_dots(path), tail))
        .when(path == "", F.concat(root, F.regexp_extract(base, PATH, 1), tail))
        .otherwise(F.concat(root, _without_dots(F.concat(folder, path)), tail))
    )
