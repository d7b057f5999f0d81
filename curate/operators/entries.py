"""Feed entries: dates, required fields, filters, the feed they came from."""

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curate.functions.dates import entry_date
from curate.functions.keywords import INDEX, index_keywords, index_list, searcher
from curate.functions.text import blank
from curate.functions.urls import source_host
from curate.operators.skew import lookup_join
from curate.session import written


def with_entry_date(entries: DataFrame) -> DataFrame:
    """Add `publication_date`; entries without any date are dropped. Entries that have it already, as those of a table
    by day, are left as they are, so that a filter on the day finds their folder."""
    if "publication_date" in entries.columns:
        return entries.where(F.col("publication_date").isNotNull())
    dated = entries.withColumn("publication_date", entry_date(F.col("published"), F.col("updated")))
    return dated.where(F.col("publication_date").isNotNull())


def on_dates(entries: DataFrame, *dates: str) -> DataFrame:
    """Entries published on one of the days."""
    return entries.where(F.col("publication_date").isin(*[F.lit(day).cast("date") for day in dates]))


def required(entries: DataFrame) -> DataFrame:
    """Entries with title, link and date; an empty text counts as missing."""
    return entries.where(
        ~blank(F.col("title")) & ~blank(F.col("link")) & F.col("publication_date").isNotNull()
    )


def keyword_filter(articles: DataFrame, keywords: list[str] | DataFrame, column: str = "content") -> DataFrame:
    """Articles that mention any keyword, whatever its case; no keywords keep every article.

    `keywords` is a list, or a table with a column `keyword` (NULLs in it are no keywords). Up to FEW of them are
    searched for one by one. More are looked up by the hashes of their windows (`functions/keywords.py`) in an index. That
    of a list goes along with the task; that of a table is written by tasks to the shared folder and read by tasks
    from there, a file of about BLOCK_CHARS bytes at a time, and of its keywords the driver sees FEW and one at most. The folder must be on a
    store that pyarrow can open (file, hdfs, s3, gs, abfs), and what is in it lasts as long as the `scratch` around it. The articles stay
    where they are: nothing of them is shuffled or joined. An empty keyword is in every text.
    """
    if isinstance(keywords, DataFrame):
        spoken = keywords.select(F.lower("keyword").alias("word")).where(F.col("word").isNotNull()).distinct()
        spoken = written(spoken, "keywords")
        some = [row["word"] for row in spoken.limit(FEW + 1).collect()]
        empty = not spoken.where("word = ''").isEmpty()
    else:
        some = list(dict.fromkeys(word.lower() for word in keywords))
        empty = "" in some
    if not some:
        return articles
    if empty:
        return articles.where(F.col(column).isNotNull())
    lowered = F.lower(F.col(column))
    if len(some) <= FEW:
        # The one-element array has the text put in lower case once, not once per keyword.
        return articles.where(F.exists(F.array(lowered), lambda text: reduce(or_, [text.contains(word) for word in some])))
    blocks = _index(spoken) if isinstance(keywords, DataFrame) else [index_list(some)]
    return articles.where(F.arrow_udf(searcher(blocks), "boolean")(lowered.cast("binary")))


# How many keywords are searched for one by one; bytes of those of a table that are looked up at once.
FEW, BLOCK_CHARS = 16, 1 << 25


def _index(spoken: DataFrame) -> list[str]:
    """The files of an index of keywords, in lower case and none of them empty."""
    blocks = -(-spoken.agg(F.sum(F.octet_length("word"))).first()[0] // BLOCK_CHARS)
    words = spoken.select(F.col("word").cast("binary").alias("word")).repartition(blocks, "word")
    return sorted(written(words.mapInArrow(index_keywords, INDEX), "keyword-index").inputFiles())


def split_keywords(setting: str) -> list[str]:
    """Keywords from a comma-separated setting; blanks around them count."""
    return setting.split(",") if setting else []


def has_content(articles: DataFrame, column: str = "content") -> DataFrame:
    return articles.where(~blank(F.col(column)))


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Entries of all feeds, duplicates kept."""
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), feeds)


def entries_with_feed(entries: DataFrame, feeds: DataFrame) -> DataFrame:
    """Each entry with the category its feed is registered under."""
    return lookup_join(entries, feeds, "feed_url", "inner", "link")


def with_source(entries: DataFrame, link: str = "link") -> DataFrame:
    return entries.withColumn("source", source_host(F.col(link)))
