"""Registries, feed documents, the store, files handed on."""

import datetime
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curate.operators import entries as E
from curate.operators import lifecycle as L
from curate.schema import as_articles
from curate.session import new_path, shared_dir
from curate.sources import feeds, registry, sinks
from curate.sources.store import ArticleStore
from curate.streaming.incremental import ingest_new_documents, pending_entries
from tests.plans import scans


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_path(spark, "x").startswith(shared_dir(spark))


def test_feed_registry(spark, tmp_path):
    (tmp_path / "registry.json").write_text(json.dumps({
        "A": {"rating_criteria": "r", "feeds": ["f1", "f2"], "use_playwright": True},
        "B & C": {"feeds": []}, "D": {}, "E": {"feeds": ["f1"], "rating_criteria": None},
    }, indent=2))
    rows = registry.feed_registry(spark, str(tmp_path / "registry.json")).collect()
    assert sorted(tuple(row) for row in rows) == [
        ("A", "f1", True, "r"), ("A", "f2", True, "r"), ("E", "f1", False, None)]


@pytest.mark.parametrize("content", ['{"AI & Tech": [}', "", "[]", "nonsense"])
def test_malformed_registry_is_empty(spark, tmp_path, content):
    (tmp_path / "bad.json").write_text(content)
    assert registry.feed_registry(spark, str(tmp_path / "bad.json")).count() == 0
    assert registry.criteria_registry(spark, str(tmp_path / "bad.json")).count() == 0


def test_missing_registry_is_empty(spark, tmp_path):
    assert registry.feed_registry(spark, str(tmp_path / "none.json")).collect() == []
    assert registry.criteria_registry(spark, str(tmp_path / "none.json")).collect() == []


def test_criteria_keep_file_order(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"default": {"新": 3, "a": 2}, "A": {"z": 1, "b": 4}}, ensure_ascii=False))
    rows = registry.criteria_registry(spark, str(tmp_path / "c.json")).collect()
    assert sorted(tuple(row) for row in rows) == [
        ("A", 0, "z", 1), ("A", 1, "b", 4), ("default", 0, "新", 3), ("default", 1, "a", 2)]


RSS = """<?xml version="1.0"?><rss version="2.0"><channel><title>Feed</title><link>http://feed</link>
<item><title>One &amp; two</title><link>http://x/1</link><pubDate>Tue, 02 Jan 2024 12:00:00 GMT</pubDate></item>
<item><title><![CDATA[Two <b>]]></title><guid isPermaLink="true">http://x/2</guid>
  <dc:date xmlns:dc="http://purl.org/dc/elements/1.1/">2024-01-02T18:00:00Z</dc:date></item>
<item><title>Three</title><guid isPermaLink="false">77</guid><pubDate>Mon, 01 Jan 2024 00:00:00 GMT</pubDate></item>
<item><title>Undated</title><link>http://x/4</link></item>
</channel></rss>"""
ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>F</title>
<entry><title type="text">A1</title><link rel="self" href="http://s"/><link href="http://a/1"/><updated>2024-01-02T01:00:00Z</updated></entry>
<entry><title>A2</title><link rel="alternate" href="http://a/2"/><published>2024-01-01T23:00:00-02:00</published>
  <updated>2024-01-09T01:00:00Z</updated></entry>
</feed>"""


def landed(tmp_path):
    for name, text in (("http%3A%2F%2Ff%2Frss", RSS), ("http%3A%2F%2Ff%2Fatom", ATOM)):
        folder = tmp_path / f"feed_url={name}"
        folder.mkdir(parents=True)
        (folder / "document.xml").write_text(text)
    return str(tmp_path)


def test_feed_entries(spark, tmp_path):
    entries = feeds.feed_entries(spark, landed(tmp_path / "landing"))
    found = {row.title: (row.link, str(row.publication_date), row.feed_url) for row in E.with_entry_date(entries).collect()}
    assert found == {
        "One & two": ("http://x/1", "2024-01-02", "http://f/rss"),
        "Two <b>": ("http://x/2", "2024-01-02", "http://f/rss"),
        "Three": (None, "2024-01-01", "http://f/rss"),
        "A1": ("http://a/1", "2024-01-02", "http://f/atom"),
        "A2": ("http://a/2", "2024-01-02", "http://f/atom"),
    }
    kept = E.required(E.on_dates(E.with_entry_date(entries), "2024-01-02"))
    assert sorted(row.title for row in kept.collect()) == ["A1", "A2", "One & two", "Two <b>"]


def test_a_broken_document_does_not_stop_the_others(spark, tmp_path):
    path = landed(tmp_path / "landing")
    for name, text in (("cut", RSS[:RSS.index("</link><pubDate>")]), ("none", "not found"), ("empty", "")):
        folder = tmp_path / "landing" / f"feed_url={name}"
        folder.mkdir()
        (folder / "document.xml").write_text(text)
    kept = E.required(E.with_entry_date(feeds.feed_entries(spark, path)))
    assert sorted(row.title for row in kept.collect()) == ["A1", "A2", "One & two", "Two <b>"]


def test_entries_are_cut_past_text_sections_comments_and_closed_tags(spark, tmp_path):
    texts = {
        "data": "<rss><channel><description><![CDATA[<item><title>no</title></item>]]></description><item><title>D1</title>"
                "<description><![CDATA[a </item> b]]></description><link>http://d/1</link></item></channel></rss>",
        "closed": '<rss><channel><item/><item a="/>" /><item><title>S1</title><link>http://s/1</link></item></channel></rss>',
        "comment": "<rss><channel><!-- <item><title>no</title></item> --><item><title>C1</title><!-- </item> -->"
                   "<link>http://c/1</link></item></channel></rss>",
        "long": "<feed><entry><title>L1</title><content>" + "<b>x</b>" * 50_000 + "<![CDATA[</entry>]]></content>"
                "<link href='http://l/1'/></entry></feed>",
    }
    for name, text in texts.items():
        (tmp_path / f"feed_url={name}").mkdir()
        (tmp_path / f"feed_url={name}" / "document.xml").write_text(text)
    found = sorted((row.title, row.link) for row in feeds.feed_entries(spark, str(tmp_path)).collect())
    assert found == [("C1", "http://c/1"), ("D1", "http://d/1"), ("L1", "http://l/1"), ("S1", "http://s/1")]
    assert feeds.unread_entries(spark, str(tmp_path)).isEmpty()


def test_keywords(spark):
    df = spark.createDataFrame([(1, "The ÉTÉ came"), (2, "none"), (3, None)], "id int, content string")
    def ids(words):
        return sorted(row.id for row in E.keyword_filter(df, words).collect())
    assert ids([]) == [1, 2, 3]
    assert ids(["été"]) == [1]
    assert ids(E.split_keywords("zzz,")) == [1, 2]
    assert E.split_keywords("") == []


def test_a_table_of_keywords(spark):
    texts = [(1, "The ÉTÉ came"), (2, "none"), (3, None), (4, ""), (5, "x"), (6, "a日b 12"), (7, "İstanbul"), (8, "abcabd abcd" * 99)]
    df = spark.createDataFrame(texts, "id int, content string")

    def ids(words):
        table = spark.createDataFrame([(word,) for word in words], "keyword string")
        found = E.keyword_filter(df, table)
        assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
        return sorted(row.id for row in found.collect())

    many = [f"no{i}such" for i in range(40)]
    assert ids([]) == ids([None]) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert ids([*many, ""]) == [1, 2, 4, 5, 6, 7, 8]
    assert ids(many) == []
    assert ids([*many, "été"]) == [1] and ids([*many, "X"]) == [5] and ids([*many, "日b"]) == [6] and ids([*many, "2"]) == [6]
    assert ids([*many, "abcd", "abce", "ne", None]) == [2, 8]
    assert ids([*many, "bcda"]) == [8] and ids([*many, "bdab"]) == []
    assert ids(["none", "came"]) == [1, 2]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text("abAé日 ", max_size=7), min_size=20, max_size=60), st.lists(st.text("abAé日 ", max_size=30), max_size=8))
def test_many_keywords_find_what_one_by_one_finds(spark, words, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, content string").coalesce(1)
    words = [word for word in words if word] or ["a"]
    found = sorted(row.id for row in E.keyword_filter(df, words + [f"{i}{i}{i}" for i in range(20)]).collect())
    assert found == [i for i, text in enumerate(texts) if any(word.lower() in text.lower() for word in words)]


def test_keywords_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK_CHARS", 100)
    df = spark.createDataFrame([(1, "one of them"), (2, "two"), (3, "w77w")], "id int, content string")
    assert [row.id for row in E.keyword_filter(df, [f"w{i}w" for i in range(100)]).collect()] == [3]


def articles(spark, *rows):
    """Rows of id, day, category, status."""
    return as_articles(spark.createDataFrame(
        [(i, f"http://u/{i}", "t", datetime.date(2024, 1, day), datetime.date(2024, 1, day), category, status, "text")
         for i, day, category, status in rows],
        "id bigint, url string, title string, publication_date date, fetch_date date, category string, status string, content string"))


@pytest.fixture()
def store(spark):
    return ArticleStore(spark, new_path(spark, "store"))


def states(store):
    return {row.id: row.status for row in store.read().collect()}


def test_an_absent_store_is_empty(store):
    assert store.read().collect() == []
    assert "category" in store.read().columns


def test_replace_touches_only_its_partitions(spark, store):
    store.append(articles(spark, (1, 1, "A & b", "fetched"), (2, 2, "A & b", "fetched"), (3, 1, "x/y: z", "fetched")))
    store.replace(L.finalize_all(store.on_dates("2024-01-01")))
    assert states(store) == {1: "failed", 2: "fetched", 3: "failed"}


def test_clear_empties_one_partition(spark, store):
    store.append(articles(spark, (1, 1, "A & b", "fetched"), (2, 2, "A & b", "fetched"), (3, 1, "x/y: z", "fetched")))
    store.clear("x/y: z", "2024-01-01")
    assert states(store) == {1: "fetched", 2: "fetched"}
    store.clear("A & b", "2024-01-01")
    store.append(articles(spark, (4, 1, "A & b", "rated")))
    assert states(store) == {2: "fetched", 4: "rated"}


def test_a_crash_between_stage_and_commit_is_repaired(spark, store):
    store.append(articles(spark, (1, 1, "A", "fetched"), (2, 2, "A", "fetched")))
    staged = store.stage(L.finalize_all(store.read()))
    assert states(store) == {1: "fetched", 2: "fetched"}
    store.commit(staged)
    store.commit(staged)
    assert states(store) == {1: "failed", 2: "failed"}


def test_scan_reads_what_it_needs(spark, store):
    store.append(articles(spark, (1, 1, "A", "fetched"), (2, 2, "A", "rated")))
    found = store.read().where("fetch_date = date '2024-01-02' AND category = 'A' AND status = 'rated'").select("id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fetch_date" in plan and "EqualTo(status,rated)" in plan
    assert "content" not in plan.split("ReadSchema")[1]
    assert [row.id for row in found.collect()] == [2]


def test_insert_twice_is_insert_once(spark, store):
    batch = spark.createDataFrame(
        [(1, "http://www.a.com:80/x", "first", "A"), (2, "http://www.a.com:80/x", "second", "B"), (3, "http://b/", "t", "B")],
        "id bigint, url string, title string, category string"
    ).withColumn("fetch_date", F.lit("2024-01-01").cast("date")).withColumn("publication_date", F.col("fetch_date"))
    for _ in range(2):
        store.append(L.insert_or_ignore(batch, store.read()))
    assert sorted((row.id, row.title, row.category, row.status, row.source) for row in store.read().collect()) == [
        (1, "first", "A", "fetched", "a.com:80"), (3, "t", "B", "fetched", "b")]
    elsewhere = batch.withColumn("category", F.lit("Z")).withColumn("fetch_date", F.lit("2024-02-02").cast("date"))
    assert L.insert_or_ignore(elsewhere, store.read()).count() == 0
    assert tuple(L.processed_count(batch, L.insert_or_ignore(batch, store.read())).first()) == (3, 0)


def test_updates_leave_other_rows(spark):
    rows = articles(spark, (1, 1, "A", "fetched"), (2, 1, "A", "selected_for_summary"), (3, 1, "B", "summarized"))
    scores = spark.createDataFrame([(1, 7.0, "r"), (2, None, None), (9, 1.0, "")], "id bigint, score double, rating_reason string")
    found = {row.id: (row.status, row.score, row.title) for row in L.apply_ratings(rows, scores).collect()}
    assert found == {1: ("rated", 7.0, "t"), 2: ("selected_for_summary", None, "t"), 3: ("summarized", None, "t")}


def test_a_few_updates_do_not_shuffle_the_store(spark, store, monkeypatch):
    store.append(articles(spark, *[(i, 1, "A", "fetched") for i in range(50)]))
    scores = spark.range(0, 50, 2).select("id", F.lit(7.0).alias("score"), F.lit("r").alias("rating_reason"))
    few = L.apply_ratings(store.read(), scores)
    assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr("curate.operators.skew.BROADCAST_BYTES", 0)
    many = L.apply_ratings(store.read(), scores)
    assert few.exceptAll(many).count() == 0 and few.where("status = 'rated'").count() == 25


def test_finalizing_spares_the_day_itself_and_selected_ones(spark):
    rows = articles(spark, (1, 1, "A", "fetched"), (2, 2, "A", "rated"), (3, 3, "A", "rated"), (4, 1, "B", "rated"),
                    (5, 1, "A", "selected_for_summary"), (6, 1, "A", "complete"))
    found = {row.id: row.status for row in L.finalize_stuck(rows, "A", "2024-01-03").collect()}
    assert found == {1: "failed", 2: "failed", 3: "rated", 4: "rated", 5: "selected_for_summary", 6: "complete"}
    assert {row.id for row in L.finalize_all(rows).where("status = 'failed'").collect()} == {1, 2, 3, 4, 5}


def test_csv_keeps_awkward_titles(spark):
    titles = ['say "hi", ok', "two\nlines", " padded ", "中文", 'a\\"b']
    df = spark.createDataFrame([(t, f"http://x/{i}", "2024-01-01") for i, t in enumerate(titles)],
                               "title string, link string, publication_date string")
    path = new_path(spark, "csv")
    sinks.entries_to_csv(df, path)
    assert {row.URL: row.Title for row in sinks.entries_from_csv(spark, path).collect()} == {
        f"http://x/{i}": t for i, t in enumerate(titles)}


def test_new_documents_are_landed_once(spark, tmp_path):
    landing = landed(tmp_path / "landing")
    checkpoint, pending = str(tmp_path / "stream"), str(tmp_path / "pending")
    assert pending_entries(spark, pending).count() == 0
    ingest_new_documents(spark, landing, pending, checkpoint).awaitTermination()

    def found():
        return sorted(row.title for row in E.required(E.with_entry_date(pending_entries(spark, pending))).collect())

    assert found() == ["A1", "A2", "One & two", "Two <b>"]
    ingest_new_documents(spark, landing, pending, checkpoint).awaitTermination()
    assert found() == ["A1", "A2", "One & two", "Two <b>"]
    later = RSS.replace("One &amp; two", "Changed").replace("http://x/2", "http://x/22").replace("Two <b>", "New")
    (tmp_path / "landing" / "feed_url=http%3A%2F%2Ff%2Frss" / "later.xml").write_text(later)
    ingest_new_documents(spark, landing, pending, checkpoint).awaitTermination()
    # The later document holds an entry of the first again, as it was.
    assert found() == ["A1", "A2", "Changed", "New", "One & two", "Two <b>"]
    # The same document in another file leaves nothing new; a run over a day reads that day's folders.
    (tmp_path / "landing" / "feed_url=http%3A%2F%2Ff%2Frss" / "again.xml").write_text(RSS)
    ingest_new_documents(spark, landing, pending, checkpoint).awaitTermination()
    assert found() == ["A1", "A2", "Changed", "New", "One & two", "Two <b>"]
    day = E.on_dates(E.with_entry_date(pending_entries(spark, pending)), "2024-01-01")
    assert sorted((row.title, row.link) for row in day.collect()) == [("Three", None)]
    (plan, rows), = scans(day)
    assert rows == 1 and "publication_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_one_scan_reads_both_kinds_of_feeds(spark, tmp_path):
    entries = feeds.feed_entries(spark, landed(tmp_path / "landing"))
    assert len(entries.collect()) == 6 and len(scans(entries)) == 1


SLOPPY = """<rss version="2.0"><channel>
<item><title>Caf&eacute;&nbsp;&mdash; R&amp;D &lt;b&gt;</title><link>http://x/?a=1&b=2&copy=3</link>
<pubDate>Tuesday, 2 January 24 9:05 GMT</pubDate></item>
<item><title><![CDATA[R&D &nbsp; <i>x</i>]]></title><link>http://x/2</link><pubDate>2 Jan 2024</pubDate></item>
<item><title>&unheardof; AT&T</title><link>http://x/3</link><pubDate>Tue 02 Jan 2024 09:05:00 +00:00</pubDate></item>
<item><title>never <b>closed</title><link>http://x/4</link></item>
</channel></rss>"""


def test_sloppy_feeds(spark, tmp_path):
    folder = tmp_path / "landing" / "feed_url=f"
    folder.mkdir(parents=True)
    (folder / "document.xml").write_text(SLOPPY)
    kept = E.required(E.with_entry_date(feeds.feed_entries(spark, str(tmp_path / "landing"))))
    assert {(row.title, row.link, str(row.publication_date)) for row in kept.collect()} == {
        ("Café\xa0— R&D <b>", "http://x/?a=1&b=2&copy=3", "2024-01-02"),
        ("R&D &nbsp; <i>x</i>", "http://x/2", "2024-01-02"),
        ("&unheardof; AT&T", "http://x/3", "2024-01-02"),
    }
    unread = feeds.unread_entries(spark, str(tmp_path / "landing")).collect()
    assert [("never" in row.malformed, row.feed_url) for row in unread] == [(True, "f")]


@pytest.mark.parametrize("date", ["2024-1-5", "20240105", "soon"])
def test_clear_wants_a_day(store, date):
    with pytest.raises(ValueError):
        store.clear("A", date)


def test_replacing_leaves_nothing_behind(spark, store, tmp_path, monkeypatch):
    monkeypatch.setattr("curate.session.shared_dir", lambda spark: str(tmp_path))
    store.append(articles(spark, (1, 1, "A", "fetched")))
    store.replace(store.read())
    assert not any(path.name.startswith("staged") for path in tmp_path.rglob("*"))
    assert store.read().count() == 1


def test_guards_and_repeated_updates(spark):
    rows = articles(spark, (1, 1, "A", "fetched"), (2, 1, "A", "complete"), (3, 1, "A", "selected_for_summary"), (4, 1, "A", "summarized"))
    scores = spark.createDataFrame([(i, s, "r") for i in range(1, 5) for s in (8.0, 7.0)], "id bigint, score double, rating_reason string")
    found = sorted((row.id, row.status, row.score) for row in L.apply_ratings(rows, scores).collect())
    assert found == [(1, "rated", 7.0), (2, "complete", None), (3, "selected_for_summary", None), (4, "summarized", None)]
    texts = spark.createDataFrame([(i, "t", "e", "s") for i in range(1, 5)],
                                  "id bigint, chinese_title string, english_summary string, chinese_summary string")
    assert [row.status for row in L.apply_summaries(rows, texts).orderBy("id").collect()] == [
        "fetched", "complete", "summarized", "summarized"]
    pictures = spark.createDataFrame([(i, "p") for i in range(1, 5)], "id bigint, thumbnail_url string")
    assert [row.status for row in L.apply_thumbnails(rows, pictures).orderBy("id").collect()] == [
        "fetched", "complete", "selected_for_summary", "complete"]
