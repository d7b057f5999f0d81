"""A day's run: fetch, rate, select, summarize, find thumbnails.

Every stage works on all categories and days asked for at once, reads the store, and writes
the states it changed. Stages can be run one by one; each takes up the articles in
the state the one before left them.
"""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curate.functions.text import blank
from curate.functions.urls import video_id
from curate.operators import entries as E
from curate.operators import lifecycle as L
from curate.operators.digest import published
from curate.operators.enrich import AT_ONCE, SUMMARY_MODEL, enrich, merge_summaries, summary_requests
from curate.operators.pages import (
    first_reachable, kept_candidates, main_content, page_of_article, with_pictures,
)
from curate.operators.rating import (
    MINIMUM_SCORE, RATING_MODEL, TOP_ARTICLES, parse_rating, rating_requests,
)
from curate.operators.skew import lookup_join, sendable
from curate.operators.stats import outcome_counts
from curate.plans.metrics import RunMetrics
from curate.schema import FETCHED, KEYS, PARTITIONS, SELECTED, SUMMARIZED
from curate.session import new_path, scratch, written
from curate.sources.store import ArticleStore


@dataclass
class Inputs:
    """What has landed for a run."""

    entries: DataFrame  # title, link, published, updated, feed_url, and id if entries have one
    feeds: DataFrame  # category, feed_url
    pages: DataFrame  # url, html
    transcripts: DataFrame  # video_id, text
    criteria: DataFrame  # category, position, criterion, points
    min_scores: DataFrame  # category, min_score
    url_status: DataFrame  # url, status_code


@dataclass
class Settings:
    dates: tuple[str, ...]
    keywords: list[str] = field(default_factory=list)
    top_articles: int = TOP_ARTICLES
    minimum_score: float = MINIMUM_SCORE
    rating_model: str = RATING_MODEL
    summary_model: str = SUMMARY_MODEL
    max_tries: int = 3
    retry_delay: float = 2.0
    parallel: int | None = None  # tasks that send requests
    at_once: int = AT_ONCE  # requests under way in a task
    requests_per_second: float | None = None  # of all tasks together; none is no limit
    categories: tuple[str, ...] = ()  # none stands for all
    force: bool = False  # clear the days and categories first
    replies_path: str | None = None  # where replies are kept from run to run
    portions: int = 4  # each becomes durable on its own


def _asked_for(rows: DataFrame, settings: Settings) -> DataFrame:
    return rows.where(F.col("category").isin(*settings.categories)) if settings.categories else rows


def _today(store: ArticleStore, settings: Settings) -> DataFrame:
    return _asked_for(store.on_dates(*settings.dates), settings)


def _kept_at(settings: Settings, given: str | None, store: ArticleStore, name: str) -> str:
    """Where the replies of a stage are kept: as given, below the run's place, or in a new one."""
    if given:
        return given
    return f"{settings.replies_path.rstrip('/')}/{name}" if settings.replies_path else new_path(store.spark, name)


def _states(rows: DataFrame) -> DataFrame:
    """Articles without their texts, with the state they had before as `_before`."""
    return rows.drop("content").withColumn("_before", F.col("status"))


def _changed(rows: DataFrame) -> DataFrame:
    """The articles whose state is another than before: all that a stage has to write."""
    return rows.where(F.col("status") != F.col("_before"))


def _groups(rows: DataFrame) -> DataFrame:
    """The days and categories that occur, no more than the store has partitions."""
    return written(rows.select(*PARTITIONS).distinct(), "groups")


def _within(rows: DataFrame, groups: DataFrame) -> DataFrame:
    return lookup_join(rows, groups, list(PARTITIONS), "left_semi", "id")


def _replies(requests: DataFrame, client_factory: Callable, settings: Settings, path: str,
             metrics: RunMetrics | None = None, call: str = "api_call") -> DataFrame:
    """Replies to `requests`, kept at `path`, one per request. A run that is repeated asks only what has no reply
    there yet. Requests are computed once; replies are written portion by portion, so that a failure costs no more
    than one of them."""
    spark = requests.sparkSession
    keys = [name for name in requests.columns if name != "request"]
    part = F.pmod(F.xxhash64(*keys), F.lit(settings.portions))
    staged = new_path(spark, "requests")
    requests = requests.withColumn("portion", part.cast("int"))
    requests.write.partitionBy("portion").parquet(staged)
    requests = spark.read.schema(requests.schema).parquet(staged)
    wanted = requests.select(*keys)
    try:
        answered = spark.read.parquet(path).where(F.col("reply").isNotNull())
        requests = requests.join(answered.select(*keys), keys, "left_anti")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
    for portion in range(settings.portions):
        replies = enrich(
            requests.where(F.col("portion") == portion).drop("portion"), client_factory, max_tries=settings.max_tries,
            retry_delay=settings.retry_delay, parallel=settings.parallel, at_once=settings.at_once,
            per_second=settings.requests_per_second,
        )
        if metrics:
            replies = metrics.timed(replies, call, "seconds")
        replies.write.mode("append").parquet(path)
    kept = spark.read.schema(replies.schema).parquet(path).where(F.col("reply").isNotNull())
    # A request that was answered twice, by runs side by side, has one reply.
    one = kept.groupBy(*keys).agg(F.min("reply").alias("reply"))
    return one.join(wanted, keys, "left_semi")


def fetch(store: ArticleStore, inputs: Inputs, settings: Settings, metrics: RunMetrics | None = None) -> None:
    """Add the articles of the days that are new and have text with a keyword in it. Entries are read once."""
    if settings.force:
        for date in settings.dates:
            for category in settings.categories or [row["category"] for row in _groups_of_day(store, date)]:
                store.clear(category, date)
    with scratch(store.spark):
        entries = inputs.entries
        if metrics:
            entries = metrics.distinct(entries, "feeds_read", "feed_url")
        dated = E.required(E.on_dates(E.with_entry_date(entries), *settings.dates))
        given = [name for name in ("id",) if name in dated.columns]
        feeds = _asked_for(inputs.feeds.select("feed_url", "category").distinct(), settings)
        batch = E.entries_with_feed(dated, feeds).select(
            *given, F.col("link").alias("url"), "title", "publication_date",
            F.col("publication_date").alias("fetch_date"), "category",
        )
        order = (*given, "publication_date", "category", "title")
        fresh = L.insert_or_ignore(batch, store, order).drop("content", "named_image", "first_image")
        fresh = fresh.withColumn("video_id", video_id(F.col("url")))
        if metrics:
            fresh = metrics.counted(fresh, "articles_given")
        fresh = written(fresh, "fresh")
        videos = _with_transcript(fresh.where(~blank(F.col("video_id"))), inputs.transcripts)
        linked = fresh.where(blank(F.col("video_id"))).withColumn("link", F.col("url"))
        # Text and pictures come out of one reading of the pages.
        read = main_content(with_pictures(page_of_article(linked, inputs.pages)))
        articles = videos.unionByName(read.drop("link", "page_url"), allowMissingColumns=True)
        kept = E.keyword_filter(E.has_content(articles), settings.keywords)
        if metrics:
            kept = metrics.counted(kept, "articles_saved")
        store.append(kept)


def _groups_of_day(store: ArticleStore, date: str) -> list:
    return store.on_dates(date).select("category").distinct().collect()


def _with_transcript(articles: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Articles on videos with their transcript as `content`, the longest where a video has several; those without
    one are left out."""
    texts = transcripts.select("video_id", F.col("text").alias("content"))
    best_first = Window.partitionBy("url").orderBy(F.desc_nulls_last(F.length("content")), "content")
    joined = texts.join(sendable(articles), "video_id").withColumn("_rank", F.row_number().over(best_first))
    return joined.where(F.col("_rank") == 1).select(*articles.columns, "content")


def analyze(store: ArticleStore, inputs: Inputs, client_factory: Callable, settings: Settings,
            replies_path: str | None = None, metrics: RunMetrics | None = None) -> None:
    """Rate the fetched articles, then select the best of every day and category that had any."""
    with scratch(store.spark):
        today = _states(_today(store, settings))
        waiting = today.where(F.col("status") == FETCHED)
        path = _kept_at(settings, replies_path, store, "ratings")
        texts = store.with_texts(waiting.select(*KEYS), *settings.dates)
        requests = rating_requests(E.has_content(texts), inputs.criteria, settings.rating_model)
        replies = _replies(requests, client_factory, settings, path, metrics, "rating_api_call")
        ratings = written(parse_rating(replies, "reply"), "ratings")
        if metrics:
            for row in outcome_counts(ratings).collect():
                metrics.increment(f"articles_rated_{row['outcome']}", row["count"])
        rated = written(L.apply_ratings(_within(today, _groups(waiting)), ratings), "rated")
        store.update(_changed(L.mark_selected(rated, inputs.min_scores, settings.top_articles, settings.minimum_score)))


def summarize(store: ArticleStore, client_factory: Callable, settings: Settings,
              replies_path: str | None = None, metrics: RunMetrics | None = None) -> None:
    """Add the three texts to the selected articles."""
    with scratch(store.spark):
        chosen = written(_states(_today(store, settings)).where(F.col("status") == SELECTED), "chosen")
        path = _kept_at(settings, replies_path, store, "summaries")
        requests = summary_requests(store.with_texts(chosen.select(*KEYS, "title"), *settings.dates), settings.summary_model)
        replies = _replies(requests, client_factory, settings, path, metrics, "summary_api_call")
        texts = written(merge_summaries(replies), "texts")
        if metrics:
            asked = E.has_content(store.with_texts(chosen.select(*KEYS), *settings.dates)).count()
            done = texts.agg(F.count("chinese_summary").alias("zh"), F.count("english_summary").alias("en")).first()
            for kind in ("zh", "en"):
                metrics.increment(f"summaries_{kind}_success", done[kind])
                metrics.increment(f"summaries_{kind}_failed", asked - done[kind])
            metrics.increment("articles_summarized", texts.count())
        store.update(_changed(L.apply_summaries(chosen, texts)))


def find_thumbnails(store: ArticleStore, inputs: Inputs, settings: Settings,
                    metrics: RunMetrics | None = None) -> None:
    """Complete the summarized articles of days and categories that have a digest."""
    with scratch(store.spark):
        today = _states(_today(store, settings))
        waiting = written(
            _within(today.where(F.col("status") == SUMMARIZED), _groups(published(today))), "summarized"
        )
        picked = written(first_reachable(kept_candidates(waiting), inputs.url_status), "thumbnails")
        if metrics:
            metrics.increment("thumbnails_found", picked.count())
        store.update(_changed(L.apply_thumbnails(waiting, picked)))


def daily_run(store: ArticleStore, inputs: Inputs, client_factory: Callable, settings: Settings,
              metrics: RunMetrics | None = None) -> DataFrame:
    """All stages in turn; the store afterwards."""
    metrics = metrics or RunMetrics()
    with metrics.time_block("fetch"):
        fetch(store, inputs, settings, metrics)
    with metrics.time_block("analyze"):
        analyze(store, inputs, client_factory, settings, metrics=metrics)
    with metrics.time_block("summarize"):
        summarize(store, client_factory, settings, metrics=metrics)
    with metrics.time_block("find_thumbnails"):
        find_thumbnails(store, inputs, settings, metrics)
    return store.read()


def finalize(store: ArticleStore, category: str, date: str) -> int:
    """Give up unfinished articles of a category from before a day; how many these were."""
    stuck = L.stuck_filter(_states(store.read()), category, date)
    number = stuck.count()
    if number:
        store.update(_changed(L.finalize_stuck(stuck, category, date)))
    return number


def finalize_everything(store: ArticleStore) -> None:
    halfway = _states(store.read()).where(F.col("status").isin(*L.INTERMEDIATE_STATES))
    store.update(_changed(L.finalize_all(halfway)))
