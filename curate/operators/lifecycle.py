"""Ingest and state changes: every function returns the new rows, storage comes after."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curate.functions.urls import source_host
from curate.operators.rating import MINIMUM_SCORE, TOP_ARTICLES, top_k_per_category
from curate.operators.skew import fits, sendable
from curate.schema import (
    COMPLETE, FAILED, FETCHED, INTERMEDIATE_STATES, RATED, SELECTED, STUCK_STATES, SUMMARIZED,
    as_articles,
)
from curate.session import written


def first_by_url(batch: DataFrame, order: tuple[str, ...] = ("id",)) -> DataFrame:
    """The first row of each URL. Every task keeps one row per URL before the shuffle, so a
    URL that fills a third of the batch costs one row per task."""
    in_order = Window.partitionBy("url").orderBy(*order)
    return batch.withColumn("_rank", F.row_number().over(in_order)).where(F.col("_rank") == 1).drop("_rank")


def insert_or_ignore(batch: DataFrame, store, order: tuple[str, ...] = ("id",)) -> DataFrame:
    """The rows of `batch` to add to `store`: new URLs only, in state `fetched`.

    `store` is an article store, which looks the URLs up by their digests, or a table of articles. Of a table
    only the URL column is read. It is cut down to the URLs of the batch first: if these fit, they are
    broadcast and the table is not shuffled at all; if not, both meet in one shuffle of URLs, and the rest
    follows that partitioning. The batch is computed once and staged.
    """
    batch = written(batch, "batch")
    urls = batch.select("url").distinct()
    small = fits(urls)
    if isinstance(store, DataFrame):
        known = store.select("url").join(F.broadcast(urls) if small else urls, "url", "left_semi").distinct()
    else:
        known = store.known(urls)
    # What is known of the batch is no more than the batch, so it fits as well.
    fresh = first_by_url(batch, order).join(F.broadcast(known) if small else known, "url", "left_anti")
    if "id" not in batch.columns:
        fresh = fresh.withColumn("id", F.xxhash64("url"))
    return as_articles(
        fresh.withColumn("status", F.lit(FETCHED)).withColumn("source", source_host(F.col("url")))
    )


def processed_count(given: DataFrame, saved: DataFrame) -> DataFrame:
    """How many items were given and how many of them were saved."""
    return given.agg(F.count("*").alias("given")).withColumn(
        "saved", saved.agg(F.count("*")).scalar()
    )


def apply_updates(store: DataFrame, updates: DataFrame, values: dict[str, Column],
                  only: str | None = None) -> DataFrame:
    """Set columns of the articles that `updates` names by id; others stay as they are.

    `values` maps a column to its new value, written over the columns of `updates`. These are
    broadcast if they fit, which spares shuffling the texts of all articles. Of several updates of an
    article the least counts, by its values in order. With `only`, articles in any other state stay as
    they are.
    """
    fresh = updates.groupBy("id").agg(
        F.min(F.struct(*[value.alias(f"_{name}") for name, value in values.items()])).alias("_new")
    ).select("id", F.lit(True).alias("_hit"), "_new.*")
    matched = store.join(sendable(fresh), "id", "left")
    hit = F.col("_hit") if only is None else F.col("_hit") & (F.col("status") == only)
    return matched.select(*[
        F.when(hit, F.col(f"_{name}")).otherwise(F.col(name)).alias(name)
        if name in values else F.col(name)
        for name in store.columns
    ])


def apply_ratings(store: DataFrame, ratings: DataFrame) -> DataFrame:
    """Store scores and reasons of fetched articles; replies without a score leave theirs as it is."""
    scored = ratings.where(F.col("score").isNotNull())
    return apply_updates(store, scored, {
        "score": F.col("score"), "rating_reason": F.col("rating_reason"), "status": F.lit(RATED),
    }, FETCHED)


def mark_selected(store: DataFrame, min_scores: DataFrame, k: int = TOP_ARTICLES,
                  default: float = MINIMUM_SCORE) -> DataFrame:
    """Mark the best articles of each day and category for a summary.

    The ranking sees narrow rows and ends in at most k ids per group; only these meet the store.
    """
    narrow = store.select("id", "fetch_date", "category", "status", "score")
    return apply_updates(
        store, written(top_k_per_category(narrow, min_scores, k, default).select("id"), "selected"),
        {"status": F.lit(SELECTED)},
    )


def apply_summaries(store: DataFrame, summaries: DataFrame) -> DataFrame:
    """Store the texts of articles selected for a summary."""
    return apply_updates(store, summaries, {
        "chinese_title": F.col("chinese_title"),
        "english_summary": F.col("english_summary"),
        "chinese_summary": F.col("chinese_summary"),
        "status": F.lit(SUMMARIZED),
    }, SELECTED)


def apply_thumbnails(store: DataFrame, thumbnails: DataFrame) -> DataFrame:
    """Store the pictures of summarized articles, which are complete with them."""
    return apply_updates(store, thumbnails, {
        "thumbnail_url": F.col("thumbnail_url"), "status": F.lit(COMPLETE),
    }, SUMMARIZED)


def is_stuck(category: str, date: str) -> Column:
    """Unfinished articles of a category from before a day."""
    return (
        (F.col("category") == category)
        & (F.col("fetch_date") < F.lit(date).cast("date"))
        & F.col("status").isin(*STUCK_STATES)
    )


def stuck_filter(store: DataFrame, category: str, date: str) -> DataFrame:
    return store.where(is_stuck(category, date))


def finalize_stuck(store: DataFrame, category: str, date: str) -> DataFrame:
    status = F.when(is_stuck(category, date), F.lit(FAILED)).otherwise(F.col("status"))
    return store.withColumn("status", status)


def finalize_all(store: DataFrame) -> DataFrame:
    """Every article in an intermediate state fails; summarized ones are published already."""
    halfway = F.col("status").isin(*INTERMEDIATE_STATES)
    return store.withColumn("status", F.when(halfway, F.lit(FAILED)).otherwise(F.col("status")))


def clear_partition(store: DataFrame, category: str, date: str) -> DataFrame:
    """All articles but those of one category and day."""
    return store.where(
        ~((F.col("category") == category) & (F.col("fetch_date") == F.lit(date).cast("date")))
    )
