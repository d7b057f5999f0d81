"""Sources, sinks, the store, incremental ingest and the whole run, on files Spark writes."""

from pyspark.sql import functions as F

from checks import fragments as S
from checks.clients import OfflineClient
from checks.digest_queries import NESTED, flat
from checks.register import query
from curate.operators import digest as D
from curate.operators.entries import with_entry_date
from curate.plans.daily import Inputs, Settings, daily_run as run_all, fetch, finalize_everything
from curate.session import new_path
from curate.sources import feeds as feed_files
from curate.sources import registry, sinks
from curate.sources.store import ArticleStore
from curate.streaming.incremental import ingest_new_documents, pending_entries

CATEGORY, DAY = "Crypto", "2024-01-05"


@query("SELECT category, feed_url, use_browser, rating_criteria FROM {feeds}")
def feed_registry(t):
    feeds = t("feeds")
    entry = F.struct(
        F.first("rating_criteria").alias("rating_criteria"), F.collect_set("feed_url").alias("feeds"),
        F.when(F.first("use_browser"), F.lit(True)).alias("use_playwright"),
    )
    path = new_path(feeds.sparkSession, "registry")
    one = feeds.groupBy("category", "rating_criteria").agg(entry.alias("entry"))
    one.select(F.to_json(F.create_map("category", "entry"))).write.text(path)
    return registry.feed_registry(feeds.sparkSession, path, lines=True)


@query("SELECT category, position, criterion, points FROM {criteria}")
def criteria_registry(t):
    criteria = t("criteria")
    listed = F.sort_array(F.collect_list(F.struct("position", "criterion", "points")))
    pairs = F.transform(listed, lambda row: F.struct(row["criterion"], row["points"]))
    path = new_path(criteria.sparkSession, "criteria")
    one = criteria.groupBy("category").agg(F.map_from_entries(pairs).alias("entry"))
    one.select(F.to_json(F.create_map("category", "entry"))).write.text(path)
    return registry.criteria_registry(criteria.sparkSession, path, lines=True)


def escaped(text):
    for character, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(character), F.lit(entity))
    return text


def documents_of(entries):
    """Feed documents of the entries: Atom for one language, RSS for the others.

    A document holds the entries of one feed among 2,000 neighbouring ids.
    """
    def element(name, value):
        return F.coalesce(F.concat(F.lit(f"<{name}>"), escaped(value), F.lit(f"</{name}>")), F.lit(""))

    title, updated = element("title", F.col("title")), element("updated", F.col("updated"))
    rss = F.concat(
        F.lit("<item>"), title, element("link", F.col("link")), element("pubDate", F.col("published")), updated,
        F.lit("</item>"),
    )
    atom = F.concat(
        F.lit('<entry><link rel="self" href="http://self/"/>'), title,
        F.concat(F.lit('<link href="'), escaped(F.col("link")), F.lit('"/>')),
        element("published", F.col("published")), updated, F.lit("</entry>"),
    )
    is_atom = F.col("lang") == "es"
    each = entries.select("feed_url", "lang", F.floor(F.col("id") / 2000).alias("part"), F.when(is_atom, atom).otherwise(rss).alias("item"))
    items = each.groupBy("feed_url", "lang", "part").agg(F.array_join(F.collect_list("item"), "").alias("items"))
    return items.select(
        F.when(is_atom, F.concat(F.lit("<feed>"), "items", F.lit("</feed>")))
        .otherwise(F.concat(F.lit('<rss version="2.0"><channel>'), "items", F.lit("</channel></rss>"))).alias("value"),
        "feed_url",
    )


def land(entries, path):
    """One file per document, as feeds are fetched."""
    documents_of(entries).write.mode("append").option("maxRecordsPerFile", 1).partitionBy("feed_url").text(path)


@query("SELECT title, link, published, updated, feed_url FROM {dated_texts}")
def feed_entries(t):
    entries = t("dated_texts")
    path = new_path(entries.sparkSession, "landing")
    land(entries, path)
    return feed_files.feed_entries(entries.sparkSession, path)


def stored_articles(t):
    articles = t("articles")
    store = ArticleStore(articles.sparkSession, new_path(articles.sparkSession, "store"))
    store.append(articles)
    return store


@query(f"""
    SELECT id, url, title, score, content FROM {{articles}}
    WHERE status = 'rated' AND category = '{CATEGORY}' AND fetch_date = date '{DAY}'
""")
def article_scan(t):
    found = D.articles_by_status(stored_articles(t).read(), "rated", CATEGORY, DAY)
    return found.select("id", "url", "title", "score", "content")


@query(f"""
    SELECT id, title, fetch_date, category, score, CASE WHEN status IN ('fetched', 'rated', 'selected_for_summary') THEN 'failed'
      ELSE status END AS status FROM {{articles}} WHERE NOT (category = '{CATEGORY}' AND fetch_date = date '{DAY}')
""")
def article_store_write(t):
    store = stored_articles(t)
    finalize_everything(store)
    store.clear(CATEGORY, DAY)
    return store.read().select("id", "title", "fetch_date", "category", "score", "status")


@query(f"""
    SELECT fetch_date, category, count(*) AS articles, count(score) AS scored, round(coalesce(sum(score), 0), 6) AS score_sum
    FROM {{articles}} WHERE NOT (category = '{CATEGORY}' AND fetch_date = date '{DAY}') GROUP BY fetch_date, category
""")
def partition_counts(t):
    """What statistics add up, kept with the store: after a change of state and a cleared partition."""
    store = stored_articles(t)
    finalize_everything(store)
    store.clear(CATEGORY, DAY)
    return store.counted().withColumn("score_sum", F.round("score_sum", 6))


@query("""
    SELECT id, url, title, fetch_date, category, score, 'failed' AS status, content FROM {articles} WHERE id = 8
""")
def stored_article(t):
    """One article out of the store, by its id, after a change of its state."""
    store = stored_articles(t)
    store.update(store.by_id(8).withColumn("status", F.lit("failed")))
    return store.by_id(8).select("id", "url", "title", "fetch_date", "category", "score", "status", "content")


@query("""
    SELECT link AS url, count(*) AS times FROM {raw_entries} WHERE link NOT IN (SELECT url FROM {articles}) GROUP BY link
""")
def unknown_urls(t):
    """Addresses of entries that the store does not have."""
    entries = t("raw_entries").groupBy(F.col("link").alias("url")).agg(F.count("*").alias("times"))
    return entries.join(stored_articles(t).known(entries.select("url")), "url", "left_anti")


@query('SELECT title AS "Title", link AS "URL", CAST(utc_date AS VARCHAR) AS "Date" FROM {dated_texts} WHERE utc_date IS NOT NULL')
def entries_to_csv(t):
    entries = t("dated_texts")
    path = new_path(entries.sparkSession, "csv")
    sinks.entries_to_csv(with_entry_date(entries), path)
    return sinks.entries_from_csv(entries.sparkSession, path)


@query(NESTED)
def digest_to_json(t):
    rows = D.digest_rows(D.published(t("articles"))).select("fetch_date", "category", "id", "title", "score")
    nested = D.digest_nested(rows)
    path = new_path(rows.sparkSession, "digest")
    sinks.digest_to_json(nested, path)
    return flat(rows.sparkSession.read.schema(nested.schema).json(path))


DAYS = tuple(f"2024-01-{day:02d}" for day in range(1, 32)) + ("2023-12-31",)
PAGE_TEXT = S.lines(S.element(S.clean("p.html"), "article"))
FIRST = "SELECT *, row_number() OVER (PARTITION BY link ORDER BY {0} utc_date, category, title) AS rn"


SPOKEN = """
    SELECT video_id, string_agg(text, ' ' ORDER BY seq, text) AS text FROM {transcript} GROUP BY video_id
"""


@query(f"""
    SELECT * FROM (
      SELECT link AS url, title, utc_date AS publication_date, category, {S.host('link')} AS source,
        coalesce(v.text, {PAGE_TEXT}) AS content, 'fetched' AS status FROM (
        {FIRST.format("")} FROM (
          SELECT d.*, f.category FROM {{run_entries}} d JOIN {{feeds}} f ON f.feed_url = d.feed_url WHERE utc_date IS NOT NULL) e
      ) n LEFT JOIN {{pages}} p ON p.url = n.link
      LEFT JOIN ({SPOKEN}) v ON n.link = 'https://www.youtube.com/watch?v=' || v.video_id WHERE rn = 1
    ) a WHERE content <> ''
""")
def incremental_ingest(t):
    """Two landings: the feeds in English, then all feeds, so that the second repeats the first. What the stream has
    landed, a run fetches."""
    entries = t("run_entries")
    spark = entries.sparkSession
    landing, checkpoint, pending = (new_path(spark, name) for name in ("landing", "stream", "pending"))
    store = ArticleStore(spark, new_path(spark, "store"))
    for wave in (entries.where(F.col("lang") == "en"), entries):
        land(wave, landing)
        ingest_new_documents(spark, landing, pending, checkpoint).awaitTermination()
    inputs = Inputs(
        entries=pending_entries(spark, pending), feeds=t("feeds"), pages=t("pages"),
        transcripts=D.transcript_text(t("transcript")).withColumn("video_id", F.col("video_id").cast("string")),
        criteria=t("criteria"), min_scores=t("min_scores"), url_status=t("url_status"),
    )
    fetch(store, inputs, Settings(dates=DAYS))
    return store.read().select("url", "title", "publication_date", "category", "source", "content", "status")


def run_sql():
    """The whole run as one statement."""
    page = S.lines(S.element(S.clean("p.html"), "article"))
    fetched = f"""
        SELECT e.id, e.link, e.title, e.utc_date, e.category, coalesce(v.text, {page}) AS content,
          CASE WHEN v.text IS NULL THEN NULL ELSE 'https://img.youtube.com/vi/' || v.video_id || '/0.jpg' END AS preview,
          {S.og_image("p.html")} AS named, {S.first_image("p.html", "p.url")} AS pictured
        FROM (SELECT r.*, f.category, row_number() OVER (PARTITION BY link ORDER BY id) AS rn
              FROM {{run_entries}} r JOIN {{feeds}} f ON f.feed_url = r.feed_url WHERE utc_date IS NOT NULL) e
        LEFT JOIN {{pages_img}} p ON p.url = e.link
        LEFT JOIN ({SPOKEN}) v
          ON e.link = 'https://www.youtube.com/watch?v=' || v.video_id
        WHERE rn = 1
    """
    kept = f"""
        SELECT *, length(content) AS size, length('Title: ' || title || 'Text:' || content) + 3 AS body_size
        FROM ({fetched}) a WHERE content <> '' AND (contains(lower(content), 'the') OR contains(lower(content), 'é'))
    """
    rated = f"""
        SELECT k.*, coalesce(m.min_score, 5.0) AS min_score,
          CAST(CASE WHEN size % 13 <> 0 AND size % 7 <> 0 THEN (size % 101) / 10.0 END AS DOUBLE) AS score
        FROM ({kept}) k LEFT JOIN {{min_scores}} m ON m.category = k.category
    """
    chosen = f"""
        SELECT *, coalesce(score >= min_score, false) AND row_number() OVER (
          PARTITION BY utc_date, category, coalesce(score >= min_score, false) ORDER BY score DESC, id) <= 2 AS picked
        FROM ({rated}) r
    """
    texts = f"""
        SELECT *, picked AND body_size % 13 <> 0 AS done, picked AND body_size % 13 <> 0 AND length(title) % 13 <> 0 AS pair
        FROM ({chosen}) c
    """
    reached = "IN (SELECT url FROM {url_status} WHERE status_code = 200)"
    shown = f"""
        SELECT *, CASE WHEN done AND bool_or(pair) OVER (PARTITION BY utc_date, category) THEN
          CASE WHEN preview {reached} THEN preview WHEN named {reached} THEN named
               WHEN pictured {reached} THEN pictured END END AS thumbnail_url
        FROM ({texts}) t
    """
    return f"""
        SELECT link AS url, title, utc_date AS publication_date, category, score, thumbnail_url,
          CASE WHEN score IS NOT NULL THEN 'Length ' || size || '.' END AS rating_reason,
          CASE WHEN thumbnail_url IS NOT NULL THEN 'complete' WHEN done THEN 'summarized' WHEN picked THEN 'selected_for_summary'
               WHEN score IS NOT NULL THEN 'rated' ELSE 'fetched' END AS status,
          CASE WHEN pair THEN '共 ' || length(title) || 'chars' END AS chinese_title,
          CASE WHEN done THEN '共' || body_size || 'chars' END AS english_summary,
          CASE WHEN pair THEN '共 ' || body_size || 'chars' END AS chinese_summary
        FROM ({shown}) s
    """


@query(run_sql())
def daily_run(t):
    entries = t("run_entries")
    spark = entries.sparkSession
    whole = D.transcript_text(t("transcript")).withColumn("video_id", F.col("video_id").cast("string"))
    # A second, shorter transcript of every video, and an older fetch of every page.
    whole = whole.unionByName(whole.withColumn("text", F.substring("text", 1, 5)))
    pages = t("pages_img").withColumn("fetched_at", F.lit("2024-01-02"))
    older = pages.withColumns({"fetched_at": F.lit("2024-01-01"), "html": F.lit("<article>old</article>")})
    inputs = Inputs(
        entries=entries.select("id", "title", "link", "published", "updated", "feed_url"), feeds=t("feeds"),
        pages=pages.unionByName(older), transcripts=whole, criteria=t("criteria"), min_scores=t("min_scores"),
        url_status=t("url_status"),
    )
    settings = Settings(dates=DAYS, keywords=["The", "É"], top_articles=2, minimum_score=5.0, retry_delay=0.0)
    store = ArticleStore(spark, new_path(spark, "store"))
    result = run_all(store, inputs, OfflineClient, settings)
    return result.select(
        "url", "title", "publication_date", "category", "score", "rating_reason", "status",
        "chinese_title", "english_summary", "chinese_summary", "thumbnail_url",
    )
