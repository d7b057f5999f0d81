"""Text and pictures of fetched pages."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curate.functions import html as H
from curate.functions.html_tree import reader
from curate.functions.text import blank
from curate.functions.urls import normalize_url, video_thumbnail
from curate.operators.skew import fits, sendable, skew_safe_join
from curate.session import written

REACHABLE = 200


def settled(column: Column) -> Column:
    """A costly column as a generator's output: Spark would copy the expressions behind it into
    every later filter on it, and does not look inside a generator."""
    return F.explode(F.array(column))


def page_scan(pages: DataFrame, columns: tuple[str, ...] = ("url", "html")) -> DataFrame:
    """Landed pages under the address they were fetched from."""
    return pages.select(*columns).withColumn("url", normalize_url(F.col("url")))


LOCATOR = ("_file", "_row")


def located(pages: DataFrame) -> DataFrame:
    """Scanned pages with the file and row they come from, under `page_url`. Pages that are not read from Parquet
    files are written to some first."""
    known = [name for name in ("fetched_at", "page_id") if name in pages.columns]
    columns = ["url", "html", *known]
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    try:
        found = pages.select(*columns, *place)
    except AnalysisException:
        found = written(pages.select(*columns), "pages").select(*columns, *place)
    return found.withColumn("page_url", normalize_url(F.col("url"))).drop("url")


def latest_pages(pages: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Which of several located pages of one address counts, without its html: the latest fetch, where `fetched_at`
    says when that was, then the highest `page_id`, then the greatest digest of the text. With `wanted`, only of
    the addresses (`page_url`) in it.

    Only narrow rows are compared, and every task keeps one an address before the shuffle.
    """
    known = [name for name in ("fetched_at", "page_id") if name in pages.columns]
    narrow = pages.select(
        "page_url", F.struct(*known, F.xxhash64("html").alias("digest"), *LOCATOR).alias("_place")
    )
    if wanted is not None:
        narrow = narrow.join(sendable(wanted), "page_url", "left_semi")
    return narrow.groupBy("page_url").agg(F.max("_place").alias("_place")).select(
        "page_url", *[F.col(f"_place.{name}").alias(name) for name in LOCATOR]
    )


def with_html(chosen: DataFrame, pages: DataFrame) -> DataFrame:
    """Rows that name pages by file and row, with the `html` of these. The rows are sent to the pages if they fit; if
    not, both meet by file and row, without sorting the pages."""
    texts = pages.select(*LOCATOR, "html")
    if fits(chosen):
        return texts.join(F.broadcast(chosen), list(LOCATOR)).select("html", *chosen.columns)
    return texts.join(chosen.hint("shuffle_hash"), list(LOCATOR)).select("html", *chosen.columns)


def entry_page(entries: DataFrame, pages: DataFrame, spread: str = "id") -> DataFrame:
    """Each entry with the page fetched for its link; without one, `html` is NULL.

    Any number of entries may name the same page. The page of each address is chosen among narrow rows, and only
    the html of those is read, late.
    """
    keyed = entries.withColumn("page_url", normalize_url(F.col("link")))
    found = located(pages)
    chosen = written(latest_pages(found, keyed.select("page_url").distinct()), "chosen-pages")
    one = with_html(chosen, found).select("page_url", "html")
    return skew_safe_join(keyed, one, "page_url", "left", spread)


def page_of_article(articles: DataFrame, pages: DataFrame) -> DataFrame:
    """Articles, whose links are unique, with their pages; those without a page are left out.

    Of an address that was fetched more than once, only pages that articles need are compared, as narrow rows; html
    is read of the chosen ones alone, and moved only if the articles of a run are too many to be sent to it.
    """
    keyed = written(articles.withColumn("page_url", normalize_url(F.col("link"))), "addressed")
    found = located(pages)
    chosen = latest_pages(found, keyed.select("page_url").distinct())
    # Two links may come to one address.
    rows = written(keyed.join(sendable(chosen), "page_url"), "chosen-pages")
    return with_html(rows, found).select("page_url", "html", *[name for name in keyed.columns if name != "page_url"])


def selector_hit(pages: DataFrame) -> DataFrame:
    """Which container holds the text of each page."""
    bare = pages.withColumn("_bare", H.without_noise(F.col("html"))).withColumn("_clean", H.plain_values(F.col("_bare")))
    return bare.withColumn("selector", H.selector_hit(F.col("_clean"))).drop("_bare", "_clean")


def read_by_expressions(pages: DataFrame) -> DataFrame:
    """Add `_text`, the main text of pages that expressions can read, and `_rest`, the html of the others.

    A flat container ends at the nearest end tag of its name; one with others nested in it, or that lacks an end tag,
    where a walk over the tags has closed it. What is left has strings that need a parser, or no container but
    parts of the body to be left out that nest.
    """
    flat = (
        pages.withColumn("_bare", H.without_noise(F.col("html")))
        .withColumn("_clean", H.plain_values(F.col("_bare")))
        .withColumn("_hit", H.selector_hit(F.col("_clean")))
        .withColumn("_block", H.container(F.col("_clean"), F.col("_hit")))
        .withColumn("_lower", F.lower("_block"))
        .withColumn("_nested", H.nests(*map(F.col, ("_hit", "_block", "_lower"))))
    )
    deep = (
        flat.withColumn("_parts", F.when(F.col("_nested"), H.by_tag(F.col("_clean"))))
        .withColumn("_first", F.when(F.col("_nested"), H.container_place(F.col("_parts"), F.col("_clean"), F.col("_hit"))))
        .withColumn("_end", H.container_end(F.col("_parts"), F.col("_first")))
        .withColumn("_block", F.when(F.col("_nested"), H.from_to(F.col("_parts"), F.col("_first"), F.col("_end")))
                    .otherwise(F.col("_block")))
        .withColumn("_marked", H.pieces(F.col("_block")))
        .withColumn("_lower", F.lower("_block"))
    )
    # Without a hit there is no text; a hit without a block is for the parser.
    rest = F.when(F.col("_block").isNull(), F.col("_hit").isNotNull()).otherwise(
        H.tangled(*map(F.col, ("html", "_clean", "_marked", "_lower")))
    )
    read = F.struct(
        F.when(F.col("_parsed"), F.col("html")).alias("_rest"),
        F.when(~F.col("_parsed"), H.visible_text(F.col("_marked"))).alias("_text"),
    )
    return deep.withColumn("_parsed", rest).select(*pages.columns, settled(read).alias("_read")).select(
        *pages.columns, "_read.*"
    )


def main_content(pages: DataFrame) -> DataFrame:
    """Replace `html` by `content`, the main text of the page.

    One pass over the pages. Expressions read nearly all of them; the rest go through the tag-by-tag reading, and
    only those are handed to Python.
    """
    kept = [name for name in pages.columns if name != "html"]
    read = F.pandas_udf(reader(H.SELECTORS), "string")
    return read_by_expressions(pages).select(*kept, "_rest", "_text").select(
        *kept, settled(F.coalesce("_text", read("_rest"))).alias("content")
    )


def og_image(pages: DataFrame) -> DataFrame:
    return pages.withColumn("image_url", settled(H.og_image(H.without_noise(F.col("html")))))


def first_image(pages: DataFrame, url: str = "url") -> DataFrame:
    """The first picture of the article itself. The search stays in the row of the page."""
    return (
        pages.withColumn("_found", H.pictures(H.without_noise(F.col("html"))))
        .withColumn("_source", H.first_content_picture(F.col("_found")))
        .select(*pages.columns, settled(H.absolute(F.col(url), F.col("_source"))).alias("image_url"))
    )


def reachable(candidates: DataFrame, url_status: DataFrame, url: str = "image_url",
              spread: str = "id") -> DataFrame:
    """Candidates whose address answered with success in the crawl log."""
    answered = (
        url_status.where(F.col("status_code") == REACHABLE)
        .select(F.col("url").alias(url)).distinct()
    )
    return skew_safe_join(candidates, answered, url, "left_semi", spread)


def thumbnail_candidates(articles: DataFrame, pages: DataFrame) -> DataFrame:
    """Up to three picture addresses per article, by priority: the preview of a video (0), the
    picture its page names (1), the first picture on its page (2)."""
    wanted = articles.select("id", F.col("url").alias("link"))
    previews = wanted.select(
        "id", F.lit(0).alias("priority"), video_thumbnail(F.col("link")).alias("image_url")
    )
    found = page_of_article(wanted, pages)
    pictures = (
        first_image(found.withColumn("_named", H.og_image(H.without_noise(F.col("html")))), "page_url")
        .select("id", F.posexplode(F.array("_named", "image_url")).alias("position", "image_url"))
        .select("id", (F.col("position") + 1).alias("priority"), "image_url")
    )
    return previews.unionByName(pictures).where(~blank(F.col("image_url")))


def with_pictures(pages: DataFrame, url: str = "page_url") -> DataFrame:
    """Add the picture each page names, `named_image`, and the first of its article, `first_image`."""
    named = pages.withColumn("named_image", settled(H.og_image(H.without_noise(F.col("html")))))
    return first_image(named, url).withColumnRenamed("image_url", "first_image")


def kept_candidates(articles: DataFrame) -> DataFrame:
    """As `thumbnail_candidates`, from the pictures that were kept with the articles when their pages were read."""
    each = F.array(video_thumbnail(F.col("url")), F.col("named_image"), F.col("first_image"))
    found = articles.select("id", F.posexplode(each).alias("priority", "image_url"))
    return found.where(~blank(F.col("image_url")))


def first_reachable(candidates: DataFrame, url_status: DataFrame) -> DataFrame:
    """The reachable candidate of least priority of each article; articles without one are left out.

    The candidates, a few short rows per article, are staged: looking for hot addresses would compute
    them again otherwise.
    """
    usable = reachable(written(candidates, "candidates"), url_status)
    return usable.groupBy("id").agg(F.min_by("image_url", "priority").alias("thumbnail_url"))


def thumbnail_pick(articles: DataFrame, pages: DataFrame, url_status: DataFrame) -> DataFrame:
    """The first reachable picture of each article, its page being read for it."""
    return first_reachable(thumbnail_candidates(articles, pages), url_status)
