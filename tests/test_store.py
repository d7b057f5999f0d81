"""State apart from texts, look-ups that skip files, and counts by partition."""

import datetime
import pathlib
import time

import pytest
from pyspark.sql import functions as F

from checks.clients import OfflineClient
from curate.operators import lifecycle as L
from curate.operators import stats
from curate.operators.enrich import enrich
from curate.plans import daily
from curate.schema import STATE_COLUMNS, as_articles
from curate.session import new_path, scratch, shared_dir, written
from curate.sources.store import ArticleStore
from tests.plans import scans
from tests.test_daily import everything, settings


@pytest.fixture()
def store(spark):
    return ArticleStore(spark, new_path(spark, "store"))


def articles(spark, numbers, day=1, category="A", status="fetched", score=None):
    return as_articles(spark.createDataFrame(
        [(i, f"http://u/{i}", "t", datetime.date(2024, 1, day), datetime.date(2024, 1, day), category, status, f"text {i}", score)
         for i in numbers],
        "id bigint, url string, title string, publication_date date, fetch_date date, category string, status string,"
        " content string, score double"))


def files(folder):
    return {path: path.stat().st_mtime_ns for path in pathlib.Path(folder).rglob("*.parquet")}


def states(store):
    return {row.id: (row.status, row.score, row.content) for row in store.read().collect()}


def test_only_fetch_writes_texts(spark, store):
    given = everything(spark)
    daily.fetch(store, given, settings())
    texts = files(store.articles)
    assert texts and not files(store.changes)
    daily.analyze(store, given, OfflineClient, settings())
    daily.summarize(store, OfflineClient, settings())
    daily.find_thumbnails(store, given, settings())
    daily.finalize(store, "A", "2024-01-03")
    daily.finalize_everything(store)
    assert files(store.articles) == texts
    changed = spark.read.parquet(store.changes)
    assert set(changed.columns) == {"id", *STATE_COLUMNS, "seq", "writer", "fetch_date", "category"}
    assert changed.select("seq").distinct().count() == 4
    # A change holds no more than the articles it is about.
    assert changed.where("seq = 1").count() < store.read().count()
    assert {row.status for row in store.read().collect()} == {"failed", "complete", "summarized"}


def test_a_change_counts_until_the_article_is_added_anew(spark, store):
    store.append(articles(spark, range(4)))
    store.append(articles(spark, [9], category="B"))
    store.update(L.finalize_all(store.read().where("id < 2")))
    store.update(store.read().where("id = 1").withColumn("score", F.lit(3.0)))
    assert states(store) == {0: ("failed", None, "text 0"), 1: ("failed", 3.0, "text 1"), 2: ("fetched", None, "text 2"),
                             3: ("fetched", None, "text 3"), 9: ("fetched", None, "text 9")}
    store.clear("A", "2024-01-01")
    assert set(states(store)) == {9}
    store.append(articles(spark, range(2)))
    assert states(store)[1] == ("fetched", None, "text 1")
    store.update(store.read().where("id = 0").withColumn("status", F.lit("rated")))
    before = states(store)
    store.compact()
    assert states(store) == before and before[0][0] == "rated" and before[1][0] == "fetched"
    assert spark.read.parquet(store.changes).count() == 1
    store.replace(store.read().where("category = 'A'").withColumn("score", F.lit(1.0)))
    assert states(store) == {0: ("rated", 1.0, "text 0"), 1: ("fetched", 1.0, "text 1"), 9: ("fetched", None, "text 9")}


def test_an_empty_change_changes_nothing(spark, store):
    store.append(articles(spark, range(3)))
    store.update(store.read().where("id > 7"))
    store.append(articles(spark, []))
    assert states(store) == {i: ("fetched", None, f"text {i}") for i in range(3)}
    store.compact()
    assert len(states(store)) == 3


def test_days_prune_articles_and_changes(spark, store):
    for day in (1, 2, 3):
        store.append(articles(spark, range(10 * day, 10 * day + 5), day))
    store.update(L.finalize_all(store.read()))
    found = store.on_dates("2024-01-02").drop("content")
    assert {row.status for row in found.collect()} == {"failed"}
    assert found.count() == 5
    found.collect()
    read = scans(found)
    assert len(read) == 2
    assert all("fetch_date" in plan.split("PartitionFilters: [")[1].split("]")[0] for plan, _ in read)
    assert all(rows == 5 for _, rows in read)
    assert not any("content" in plan.split("ReadSchema")[1] for plan, _ in read)


def test_texts_of_other_days_are_not_read(spark, store):
    for day in (1, 2, 3):
        store.append(articles(spark, range(10 * day, 10 * day + 5), day))
    store.update(L.finalize_all(store.read()))
    rows = written(store.on_dates("2024-01-02").where("id < 22").select("id", "fetch_date", "category", "status"), "rows")
    found = store.with_texts(rows, "2024-01-02")
    assert sorted((row.id, row.status, row.content) for row in found.collect()) == [(20, "failed", "text 20"), (21, "failed", "text 21")]
    read = [rows for plan, rows in scans(found) if "content" in plan.split("ReadSchema")[1]]
    assert read == [5]


def counts_equal(store):
    full, kept = store.read(), store.counted()
    for one, other in ((stats.articles_per_category, stats.category_counts), (stats.articles_per_day, stats.day_counts)):
        assert sorted(map(tuple, one(full).collect())) == sorted(map(tuple, other(kept).collect()))
    one, other = (dict(map(tuple, rows.collect())) for rows in (stats.avg_score_per_category(full), stats.category_averages(kept)))
    assert one == pytest.approx(other)


def test_counts_follow_every_write(spark, store):
    counts_equal(store)
    for day, category in ((1, "A"), (1, "B"), (2, "A")):
        store.append(articles(spark, range(100 * day + ord(category), 100 * day + ord(category) + 5), day, category, score=1.5))
        counts_equal(store)
    store.update(store.read().where("id % 2 = 0").withColumn("score", F.lit(4.0)))
    counts_equal(store)
    store.update(store.read().where("category = 'B'").withColumn("score", F.lit(None).cast("double")))
    counts_equal(store)
    assert {row.category for row in stats.category_averages(store.counted()).collect()} == {"A"}
    store.clear("A", "2024-01-01")
    counts_equal(store)
    store.append(articles(spark, [1], 1, "A", score=9.0))
    counts_equal(store)
    store.replace(store.on_dates("2024-01-02").where("id % 3 = 0"))
    counts_equal(store)
    store.compact()
    counts_equal(store)
    counted = stats.category_counts(store.counted())
    counted.collect()
    assert all(plan.endswith(store.counts) for plan, _ in scans(counted))


@pytest.fixture(scope="module")
def wide(spark):
    """A store of many files: forty days of 2,500 articles."""
    store = ArticleStore(spark, new_path(spark, "wide"))
    rows = spark.range(100_000).select(
        F.col("id"), F.concat(F.lit("http://u/"), "id").alias("url"), F.lit("t").alias("title"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("fetch_date"), F.lit("A").alias("category"),
        F.lit("fetched").alias("status"), F.concat(F.lit("text "), "id").alias("content"),
    )
    store.append(rows)
    assert len(files(store.articles)) >= 40
    return store


def test_few_urls_skip_most_of_the_store(spark, wide):
    sought = spark.range(1000).select(F.concat(F.lit("http://new/"), "id").alias("url"))
    old = spark.createDataFrame([("http://u/5",), ("http://u/45",)], "url string")
    found = wide.known(sought.union(old))
    assert sorted(row.url for row in found.collect()) == ["http://u/45", "http://u/5"]
    read = sum(rows for plan, rows in scans(found) if "digest" in plan)
    assert read < 100_000 / 10
    # A larger batch meets all digests, with the same result.
    many = spark.range(9000).select(F.concat(F.lit("http://new/"), "id").alias("url")).union(old)
    assert sorted(row.url for row in wide.known(many).collect()) == ["http://u/45", "http://u/5"]
    assert wide.known(sought.limit(0)).collect() == []


def test_an_id_reads_the_file_that_has_it(spark, wide):
    found = wide.by_id(777)
    assert [(row.id, row.content) for row in found.collect()] == [(777, "text 777")]
    assert sum(rows for _, rows in scans(found)) <= 2500
    wide.update(wide.read().where("id = 777").withColumn("status", F.lit("rated")))
    found = wide.by_id(777)
    assert [(row.id, row.status, row.content) for row in found.collect()] == [(777, "rated", "text 777")]
    assert sum(rows for plan, rows in scans(found) if "content" in plan.split("ReadSchema")[1]) <= 2500
    assert wide.by_id(-5).collect() == []


class Slow:
    """Answers after a while, with its own name; every third request fails once."""

    def __init__(self):
        self.failed = set()

    def request(self, payload):
        time.sleep(0.25)
        text = payload["messages"][0]["content"]
        if int(text) % 3 == 0 and text not in self.failed:
            self.failed.add(text)
            raise ConnectionError("busy")
        return {"choices": [{"message": {"content": f"re {text}"}}]}


class Never:
    def request(self, payload):
        raise ConnectionError("down")


def requests(spark, n):
    message = F.array(F.struct(F.lit("user").alias("role"), F.col("id").cast("string").alias("content")))
    return spark.range(n).select("id", F.struct(F.lit("m").alias("model"), message.alias("messages")).alias("request"))


def test_requests_are_under_way_together(spark):
    def seconds(at_once):
        start = time.monotonic()
        rows = enrich(requests(spark, 64), Slow, retry_delay=0.0, parallel=4, at_once=at_once).collect()
        assert {row.id: row.reply for row in rows} == {i: f"re {i}" for i in range(64)}
        assert {row.id: row.attempts for row in rows} == {i: 2 if i % 3 == 0 else 1 for i in range(64)}
        return time.monotonic() - start

    seconds(8)
    assert seconds(8) < seconds(1) / 3


def test_pauses_grow_and_errors_stay(spark):
    start = time.monotonic()
    rows = enrich(requests(spark, 2), Never, retry_delay=0.2, parallel=1, at_once=2).collect()
    assert all(row.reply is None and row.attempts == 3 and row.error == "ConnectionError: down" for row in rows)
    assert all(0.6 <= row.seconds < 2 for row in rows) and time.monotonic() - start >= 0.6


def test_all_tasks_share_one_rate(spark):
    start = time.monotonic()
    rows = enrich(requests(spark, 24), OfflineClient, parallel=2, at_once=4, per_second=16).collect()
    assert len(rows) == 24 and time.monotonic() - start >= 24 / 16 - 0.6


def test_a_scratch_leaves_nothing(spark):
    folder = pathlib.Path(shared_dir(spark)) / "curate"
    before = set(folder.glob("*"))
    with scratch(spark):
        rows = written(spark.range(5).toDF("x"), "some")
        with scratch(spark):
            written(rows, "inner")
        assert rows.count() == 5 and len(set(folder.glob("*")) - before) == 1
    assert set(folder.glob("*")) == before


def test_a_run_leaves_nothing_but_store_and_replies(spark, store, tmp_path):
    folder = pathlib.Path(shared_dir(spark)) / "curate"
    before = set(folder.glob("*"))
    daily.daily_run(store, everything(spark), OfflineClient, settings(replies_path=str(tmp_path / "replies")))
    left = {path.name.rsplit("-", 1)[0] for path in set(folder.glob("*")) - before}
    assert left <= {"store"}
