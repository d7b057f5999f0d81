"""Column functions on single values."""

from urllib.parse import parse_qs, urljoin, urlparse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curate.functions import dates, text, urls


def apply(spark, function, values):
    df = spark.createDataFrame([(i, value) for i, value in enumerate(values)], "i int, v string")
    return [row.r for row in df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_entry_date_is_utc_in_any_session_zone(spark, zone):
    texts = {
        "Mon, 01 Jan 2024 23:30:00 -0500": "2024-01-02",
        "Mon, 1 Jan 2024 23:30:00 GMT": "2024-01-01",
        "1 Jan 2024 23:30 EST": "2024-01-02",
        "Mon, 01 Jan 2024 23:30:00 UT": "2024-01-01",
        "Mon, 01 Jan 2024 23:30:00": "2024-01-01",
        "2024-01-01T23:30:00-05:00": "2024-01-02",
        "2024-01-01T23:30:00Z": "2024-01-01",
        "2024-01-01T23:30:00.123456+0000": "2024-01-01",
        "2024-01-01 23:30:00": "2024-01-01",
        "2024-01-01": "2024-01-01",
        "Monday, 01 January 2024 9:05 GMT": "2024-01-01", "Mon 1 Jan 24 23:30:00 -05:00": "2024-01-02",
        "1 Jan 2024": "2024-01-01", "Mon, 01 Jan 2024 23:30:00 EDT": "2024-01-02", "01 Jan 2024 16:30 PDT": "2024-01-01",
        "01 Jan 2024 17:00 PDT": "2024-01-02", "20240101": "2024-01-01", "2024-02": "2024-02-01",
        "20240101T233000Z": "2024-01-01", "2024-01-01T23:30:00.1234567Z": "2024-01-01", "31 Feb 2024": None,
        "soon": None, "": None, None: None,
    }
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = apply(spark, lambda v: dates.entry_date(v, F.lit(None).cast("string")), texts)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [str(day) if day else None for day in found] == list(texts.values())


def test_updated_date_stands_in(spark):
    row = spark.range(1).select(
        dates.entry_date(F.lit("never"), F.lit("2024-01-02T10:00:00Z")).alias("d")).first()
    assert str(row.d) == "2024-01-02"


def test_normalize_url(spark):
    given_links = ["//www.y.com/b", "http://x/", "https://x/", "a.com/b", ""]
    assert apply(spark, urls.normalize_url, given_links) == [
        "https://www.y.com/b", "http://x/", "https://x/", "https://a.com/b", "https://"]


LINKS = ["//www.y.com/b", "http://WWW.www.x.com:80/a?b", "https://h#f", "https://h?q", "a.com/b", "", "mailto:x",
         "https://www.www.x/", "ftp://u:p@www.h:1/x"]


def test_source_host(spark):
    assert apply(spark, urls.source_host, LINKS) == [urlparse(link).netloc.replace("www.", "") for link in LINKS]


VIDEOS = ["https://www.youtube.com/watch?v=a%20b+c&t=1#x", "https://youtube.com/watch?v=&v=z", "https://youtu.be/abc;d?x=1",
          "https://youtu.be", "https://m.youtube.com/?v=1", "https://www.youtube.com/watch?t=1", "https://youtu.be/a/b#c",
          "https://www.youtube.com/watch?xv=1&v=2", "https://www.youtube.com/watch#?v=2"]


def expected_video(link, hosts=("www.youtube.com", "youtube.com")):
    parts = urlparse(link)
    if parts.netloc in hosts:
        return parse_qs(parts.query).get("v", [None])[0]
    return parts.path[1:] if parts.netloc == "youtu.be" else None


def test_video_id(spark):
    assert apply(spark, urls.video_id, VIDEOS) == [expected_video(link) for link in VIDEOS]


def test_video_thumbnail(spark):
    wanted = [expected_video(link, ("www.youtube.com",)) for link in VIDEOS]
    assert apply(spark, urls.video_thumbnail, VIDEOS) == [
        f"https://img.youtube.com/vi/{video}/0.jpg" if video else None for video in wanted]


def test_resolve(spark):
    bases = ["http://h.com/a/b/c?x#y", "https://h.com", "https://h.com/", "http://h.com:80/a/b/"]
    links = ["i.jpg", "./i.jpg", "../i.jpg", "../../../i.jpg", "/x/../i.jpg", "//o.com/i.jpg", "ftp://z/i.jpg",
             "a/./b/../i.jpg", "?i.jpg", "i.jpg?x=../y", "/i.jpg#a/../b", "/", "a/..", "a/."]
    pairs = [(base, link) for base in bases for link in links]
    df = spark.createDataFrame(pairs, "b string, l string").select("b", "l", urls.resolve(F.col("b"), F.col("l")).alias("r"))
    assert {(row.b, row.l): row.r for row in df.collect()} == {pair: urljoin(*pair) for pair in pairs}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \t\n\x0b\x1c\x1f\x85\xa0 　中", max_size=8), min_size=20, max_size=60))
def test_strip_agrees_with_python(spark, values):
    assert apply(spark, text.strip, values) == [value.strip() for value in values]


def test_title_slug(spark):
    titles = ['a/b: "你好"  x²?', "one\n\ttwo", "é<>|*\\!", "中" * 300]
    assert apply(spark, text.title_slug, titles) == ["ab_你好_x²", "one_two", "é", "中" * 255]


def test_cjk_spacing(spark):
    texts = ["中文abc中3文", "a 中", "中α", "日本go本", "plain", "中，a", "ひらx"]
    assert apply(spark, text.cjk_spacing, texts) == ["中文 abc 中 3 文", "a 中", "中 α", "日本 go 本", "plain", "中，a", "ひら x"]


def test_unescape_once(spark):
    assert apply(spark, text.unescape, ["&amp;lt; &lt;b&gt; &#39;&quot;&bogus;"]) == ["&lt; <b> '\"&bogus;"]
