"""Schemas and states of the article collection."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The states of an article, in the order it passes them.
FETCHED = "fetched"
RATED = "rated"
SELECTED = "selected_for_summary"
SUMMARIZED = "summarized"
COMPLETE = "complete"
FAILED = "failed"

PUBLISHED_STATES = (COMPLETE, SUMMARIZED)
STUCK_STATES = (FETCHED, RATED)
INTERMEDIATE_STATES = (FETCHED, RATED, SELECTED)

PARTITIONS = ("fetch_date", "category")

ARTICLE_COLUMNS = {
    "id": "bigint",
    "url": "string",
    "title": "string",
    "publication_date": "date",
    "content": "string",
    "score": "double",
    "status": "string",
    "chinese_title": "string",
    "english_summary": "string",
    "chinese_summary": "string",
    "thumbnail_url": "string",
    "named_image": "string",
    "first_image": "string",
    "rating_reason": "string",
    "source": "string",
    "fetch_date": "date",
    "category": "string",
}
# What changes in the life of an article. Everything else is written once.
STATE_COLUMNS = (
    "score", "status", "chinese_title", "english_summary", "chinese_summary", "thumbnail_url", "rating_reason",
)
KEYS = ("id", *PARTITIONS)
ARTICLE_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in ARTICLE_COLUMNS.items())

# What a digest shows. The article text stays out, so a digest never scans it.
DIGEST_COLUMNS = (
    "id", "url", "title", "publication_date", "fetch_date", "category", "score", "status",
    "chinese_title", "english_summary", "chinese_summary", "thumbnail_url", "rating_reason",
    "source",
)

FEED_SCHEMA = "category string, feed_url string, use_browser boolean, rating_criteria string"


def empty(spark: SparkSession, schema: str = ARTICLE_SCHEMA) -> DataFrame:
    return spark.createDataFrame([], schema)


def as_articles(df: DataFrame) -> DataFrame:
    """Bring `df` to the article schema; columns it lacks become NULL."""
    present = set(df.columns)
    return df.select(*[
        (F.col(name) if name in present else F.lit(None)).cast(kind).alias(name)
        for name, kind in ARTICLE_COLUMNS.items()
    ])
