"""Digest queries over the published articles."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curate.operators.skew import lookup_join, number_within
from curate.schema import DIGEST_COLUMNS, PUBLISHED_STATES

ALL = "all"


def articles_by_status(store: DataFrame, status: str, category: str, date: str) -> DataFrame:
    return store.where(
        (F.col("status") == status)
        & (F.col("category") == category)
        & (F.col("fetch_date") == F.lit(date).cast("date"))
    )


def published(store: DataFrame) -> DataFrame:
    return store.where(
        F.col("status").isin(*PUBLISHED_STATES)
        & F.col("chinese_summary").isNotNull()
        & (F.col("chinese_summary") != "")
    )


def digest_filter(store: DataFrame, date: str | None = None, category: str | None = None) -> DataFrame:
    """Published articles, of one day and one category if these are given."""
    articles = published(store)
    if date:
        articles = articles.where(F.col("fetch_date") == F.lit(date).cast("date"))
    if category and category != ALL:
        articles = articles.where(F.col("category") == category)
    return articles


def digest_rows(articles: DataFrame) -> DataFrame:
    """The columns a digest shows, as far as `articles` has them."""
    return articles.select(*[name for name in DIGEST_COLUMNS if name in articles.columns])


def digest_order(store: DataFrame, date: str | None = None, category: str | None = None) -> DataFrame:
    """Newest day first, best article first."""
    rows = digest_rows(digest_filter(store, date, category))
    return rows.orderBy(F.desc("fetch_date"), F.desc_nulls_last("score"), "id")


def category_digest(store: DataFrame, category: str, date: str) -> DataFrame:
    rows = digest_rows(digest_filter(store, date, category))
    return rows.orderBy(F.desc_nulls_last("score"), "id")


def available_dates(store: DataFrame) -> DataFrame:
    return published(store).select("fetch_date").distinct().orderBy(F.desc("fetch_date"))


def all_categories(store: DataFrame) -> DataFrame:
    return store.select("category").distinct().orderBy("category")


def article_by_id(store: DataFrame, article_id: int) -> DataFrame:
    return store.where(F.col("id") == article_id)


def latest_digest(store: DataFrame, category: str | None = None) -> DataFrame:
    """Digest of the newest day that has one, over all categories, as the default view."""
    newest = published(store).agg(F.max("fetch_date")).scalar()
    return digest_rows(digest_filter(store, None, category).where(F.col("fetch_date") == newest))


def date_pages(store: DataFrame) -> DataFrame:
    """Published articles with the number of their day, the newest day being 1.

    Only the distinct days are ranked, so the one task that ranks sees a calendar, not articles.
    """
    days = published(store).select("fetch_date").distinct()
    ranked = days.withColumn("page", F.dense_rank().over(Window.orderBy(F.desc("fetch_date"))))
    return lookup_join(digest_rows(published(store)), ranked, "fetch_date", "inner", "id")


def date_page(store: DataFrame, page: int | None = None) -> DataFrame:
    """Digest of the n-th newest day, or of every day if none is given."""
    pages = date_pages(store)
    return pages if page is None else pages.where(F.col("page") == page)


def digest_nested(articles: DataFrame, page_size: int | None = None) -> DataFrame:
    """Articles nested by day and category, best first, numbered from 1.

    A day and category has one list: a run publishes at most its top articles. For collections without such
    a bound, `page_size` deals longer lists out over pages 0, 1, 2 and so on, so that no task ever
    holds a whole group; every article is in one of them.
    """
    inner = [name for name in articles.columns if name not in ("fetch_date", "category")]
    if page_size is None:
        best_first = F.struct(F.col("score").isNull().alias("last"), (-F.col("score")).alias("order"), "id")
        listed = F.sort_array(F.collect_list(F.struct(best_first.alias("rank"), F.struct(*inner).alias("article"))))
        numbered = F.transform(listed, lambda row, place: F.struct(
            (place + 1).cast("bigint").alias("position"),
            *[row["article"][name].alias(name) for name in inner],
        ))
        return articles.groupBy("fetch_date", "category").agg(numbered.alias("articles"))
    numbered = number_within(
        articles, ("fetch_date", "category"), (F.desc_nulls_last("score"), F.asc("id"))
    )
    page = F.floor((F.col("position") - 1) / page_size).cast("int")
    listed = F.sort_array(F.collect_list(F.struct("position", *inner)))
    return numbered.groupBy("fetch_date", "category", page.alias("page")).agg(listed.alias("articles"))


def digest_json(nested: DataFrame) -> DataFrame:
    """One JSON document per day and category, and page if there are pages."""
    document = F.to_json(F.struct(*nested.columns))
    return nested.select(document.alias("value"))


def transcript_text(segments: DataFrame, part_size: int | None = None) -> DataFrame:
    """Segments of each video joined by blanks in their order: one text per video, as it ends in one row.

    With `part_size` the text comes in parts of so many segments, numbered from 0.
    """
    if part_size is None:
        listed = F.sort_array(F.collect_list(F.struct("seq", "text")))
        joined = F.array_join(F.transform(listed, lambda row: row["text"]), " ")
        return segments.groupBy("video_id").agg(joined.alias("text"))
    numbered = number_within(segments.select("video_id", "seq", "text"), ("video_id",),
                             (F.asc("seq"), F.asc("text")))
    part = F.floor((F.col("position") - 1) / part_size).cast("int")
    listed = F.sort_array(F.collect_list(F.struct("position", "text")))
    joined = F.array_join(F.transform(listed, lambda row: row["text"]), " ")
    return numbered.groupBy("video_id", part.alias("part")).agg(joined.alias("text"))
