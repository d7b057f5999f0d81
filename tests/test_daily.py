"""The daily run and its stages."""

import pytest
from pyspark.sql import functions as F

from checks.clients import OfflineClient
from curate.operators import digest as D
from curate.operators import stats
from curate.plans import daily
from curate.plans.metrics import RunMetrics
from curate.session import new_path
from curate.sources.store import ArticleStore

FEEDS = "category string, feed_url string"
ENTRIES = "id bigint, title string, link string, published string, updated string, feed_url string"


def entry(number, link, day=2, feed="f1", title="title"):
    return (number, title, link, f"Tue, {day:02d} Jan 2024 10:00:00 GMT", None, feed)


def inputs(spark, entries, pages, transcripts=(), criteria=(("default", 0, "new", 3),)):
    make = spark.createDataFrame
    return daily.Inputs(
        entries=make(list(entries), ENTRIES),
        feeds=make([("A", "f1"), ("B", "f2")], FEEDS),
        pages=make([(url, f'<meta property="og:image" content="http://i/{i}.jpg"><article>{text}</article>')
                    for i, (url, text) in enumerate(pages.items())], "url string, html string"),
        transcripts=make(list(transcripts), "video_id string, text string"),
        criteria=make(list(criteria), "category string, position int, criterion string, points int"),
        min_scores=make([("A", 5.0)], "category string, min_score double"),
        url_status=make([(f"http://i/{i}.jpg", 200) for i in range(9)], "url string, status_code int"),
    )


def settings(**changes):
    return daily.Settings(**{"dates": ("2024-01-02",), "retry_delay": 0.0, "top_articles": 2, **changes})


@pytest.fixture()
def store(spark):
    return ArticleStore(spark, new_path(spark, "store"))


def found(store):
    return {row.url: row for row in store.read().collect()}


# Lengths decide the offline ratings: 80 gives 8.0, 70 gives 'Not relevant', 78 no answer at all.
PAGES = {"http://x/1": "a" * 80, "http://x/2": "b" * 90, "https://x/3": "c" * 85, "http://x/4": "d" * 70,
         "http://x/5": "e" * 78, "http://x/6": "f" * 10, "http://y/7": ""}


def everything(spark):
    entries = [entry(i, link) for i, link in enumerate(["http://x/1", "http://x/2", "//x/3", "http://x/4", "http://x/5", "http://x/6",
                                                         "http://y/7", "http://none/8"])]
    entries += [entry(20, "http://x/1", feed="f2"), entry(21, "http://x/2", day=3), entry(22, ""), entry(23, "http://x/9", feed="?")]
    entries += [entry(30, "https://youtu.be/vid", feed="f2"), entry(31, "https://youtu.be/gone", feed="f2")]
    return inputs(spark, entries, PAGES, [("vid", "v" * 99)])


def test_whole_day(spark, store):
    metrics = RunMetrics("run")
    daily.daily_run(store, everything(spark), OfflineClient, settings(), metrics)
    counted = {row.name: row["count"] for row in stats.run_counters(metrics.counters(spark)).collect()}
    assert counted == {"articles_given": 10, "feeds_read": 3, "articles_saved": 7, "articles_rated_success": 5,
                       "articles_rated_irrelevant": 1, "rating_api_call": 7, "summary_api_call": 9,
                       "summaries_zh_success": 3, "summaries_zh_failed": 0, "summaries_en_success": 3,
                       "summaries_en_failed": 0, "articles_summarized": 3, "thumbnails_found": 2}
    timed = stats.run_timings(metrics.timings(spark)).collect()
    assert [row.name for row in timed] == ["analyze", "fetch", "find_thumbnails", "rating_api_call", "summarize", "summary_api_call"]
    assert all(row.calls == (4 if "call" in row.name else 1) and row.total_time > 0 for row in timed)
    rows = found(store)
    states = {url: row.status for url, row in rows.items()}
    assert states == {
        "http://x/1": "rated", "http://x/2": "complete", "//x/3": "complete", "http://x/4": "fetched",
        "http://x/5": "fetched", "http://x/6": "rated", "https://youtu.be/vid": "summarized",
    }
    assert rows["http://x/2"].score == 9.0 and rows["http://x/2"].rating_reason == "Length 90."
    assert rows["http://x/2"].chinese_title == "共 5chars"
    assert rows["http://x/2"].thumbnail_url == "http://i/1.jpg"
    assert rows["https://youtu.be/vid"].source == "youtu.be" and rows["https://youtu.be/vid"].thumbnail_url is None
    assert [row.url for row in D.category_digest(store.read(), "A", "2024-01-02").collect()] == ["http://x/2", "//x/3"]


def test_a_second_run_adds_nothing(spark, store):
    for _ in range(2):
        daily.fetch(store, everything(spark), settings())
    assert store.read().count() == 7


def test_repeated_pages_and_transcripts_store_a_url_once(spark, store):
    given = everything(spark)
    given.pages = given.pages.withColumn("fetched_at", F.lit(2)).unionByName(
        given.pages.select("url", F.lit("<article>older</article>").alias("html"), F.lit(1).alias("fetched_at")))
    given.transcripts = given.transcripts.union(spark.createDataFrame([("vid", "short")], "video_id string, text string"))
    daily.fetch(store, given, settings())
    rows = store.read().collect()
    assert len(rows) == len({row.url for row in rows}) == 7
    assert found(store)["http://x/1"].content == "a" * 80 and len(found(store)["https://youtu.be/vid"].content) == 99


def test_categories_and_force(spark, store):
    given = everything(spark)
    daily.daily_run(store, given, OfflineClient, settings(categories=("B",)))
    assert set(found(store)) == {"http://x/1", "https://youtu.be/vid"}
    daily.daily_run(store, given, OfflineClient, settings())
    store.replace(store.read().withColumn("status", F.lit("failed")))
    daily.daily_run(store, given, OfflineClient, settings(force=True, categories=("A",)))
    states = {row.category: row.status for row in store.read().collect() if row.url in ("http://x/2", "https://youtu.be/vid")}
    assert states == {"A": "complete", "B": "failed"}


class Counting(OfflineClient):
    """Notes each request in a file of its own."""

    folder = ""

    def request(self, payload):
        import pathlib
        import uuid

        (pathlib.Path(self.folder) / uuid.uuid4().hex).touch()
        return super().request(payload)


def test_a_second_run_asks_nothing_twice_and_sends_nothing_back(spark, store, tmp_path):
    folder = tmp_path / "asked"
    folder.mkdir()

    def client():
        made = Counting()
        made.folder = str(folder)
        return made

    given = everything(spark)
    chosen = settings(replies_path=str(tmp_path / "replies"))
    daily.daily_run(store, given, client, chosen)
    before, asked = found(store), len(list(folder.iterdir()))
    # A new article of the day makes the stages work on its category again.
    more = inputs(spark, [entry(50, "http://x/50")], {"http://x/50": "z" * 81})
    daily.daily_run(store, more, client, chosen)
    after = found(store)
    assert {url: row.status for url, row in before.items() if row.status == "complete"} == {
        url: after[url].status for url, row in before.items() if row.status == "complete"}
    # The new article's rating, three texts if it is chosen, and what has had no answer so far.
    assert len(list(folder.iterdir())) - asked <= 1 + 3 * 3 + 3 * 2


def test_stream_then_run(spark, store, tmp_path):
    from curate.streaming.incremental import ingest_new_documents, pending_entries

    folder = tmp_path / "landing" / "feed_url=f1"
    folder.mkdir(parents=True)
    (folder / "d.xml").write_text("<rss><channel><item><title>t</title><link>http://x/1</link>"
                                  "<pubDate>Tue, 02 Jan 2024 10:00:00 GMT</pubDate></item></channel></rss>")
    pending = str(tmp_path / "pending")
    ingest_new_documents(spark, str(tmp_path / "landing"), pending, str(tmp_path / "stream")).awaitTermination()
    given = everything(spark)
    given.entries = pending_entries(spark, pending)
    daily.daily_run(store, given, OfflineClient, settings())
    assert found(store)["http://x/1"].status == "complete" and found(store)["http://x/1"].content == "a" * 80


def test_no_entries_no_store(spark, store):
    daily.daily_run(store, inputs(spark, [], {}), OfflineClient, settings())
    assert store.read().count() == 0


def test_keywords_keep_what_mentions_them(spark, store):
    daily.fetch(store, everything(spark), settings(keywords=["BBB", "vv"]))
    assert set(found(store)) == {"http://x/2", "https://youtu.be/vid"}


def test_rerun_without_new_articles_selects_no_more(spark, store):
    given = everything(spark)
    daily.fetch(store, given, settings(keywords=["a", "b", "c"]))
    daily.analyze(store, given, OfflineClient, settings())
    daily.analyze(store, given, OfflineClient, settings())
    assert sum(row.status == "selected_for_summary" for row in found(store).values()) == 2
    # With a newly fetched article the day selects among all rated ones again.
    daily.fetch(store, given, settings(keywords=["f"]))
    daily.analyze(store, given, OfflineClient, settings())
    assert sum(row.status == "selected_for_summary" for row in found(store).values()) == 3


class Broken:
    def request(self, payload):
        raise ConnectionError("down")


def test_a_failing_service_leaves_articles_as_they_are(spark, store):
    given = everything(spark)
    daily.fetch(store, given, settings())
    daily.analyze(store, given, Broken, settings())
    assert {row.status for row in found(store).values()} == {"fetched"}


def test_answered_requests_are_not_asked_again(spark, store):
    given = everything(spark)
    daily.fetch(store, given, settings())
    path = new_path(spark, "replies")
    daily.analyze(store, given, OfflineClient, settings(), path)
    answered = spark.read.parquet(path).where("reply IS NOT NULL").count()
    second = ArticleStore(spark, new_path(spark, "store"))
    daily.fetch(second, given, settings())
    daily.analyze(second, given, Broken, settings(), path)
    assert spark.read.parquet(path).where("reply IS NOT NULL").count() == answered
    assert {url: row.score for url, row in found(second).items()} == {url: row.score for url, row in found(store).items()}


def test_forced_rerun(spark, store):
    given = everything(spark)
    daily.daily_run(store, given, OfflineClient, settings())
    store.clear("A", "2024-01-02")
    assert set(found(store)) == {"https://youtu.be/vid"}
    daily.daily_run(store, given, OfflineClient, settings())
    assert found(store)["http://x/2"].status == "complete"


def test_finalize(spark, store):
    given = everything(spark)
    daily.fetch(store, given, settings())
    assert daily.finalize(store, "A", "2024-01-02") == 0
    assert daily.finalize(store, "A", "2024-01-03") == 6
    assert {row.status for row in store.read().where(F.col("category") == "A").collect()} == {"failed"}
    daily.finalize_everything(store)
    assert {row.status for row in store.read().collect()} == {"failed"}
