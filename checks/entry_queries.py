"""Entries: projections, filters, unions and the feed they belong to."""

from pyspark.sql import functions as F

from checks.fragments import SPACE, host, normalized, spaced
from checks.register import query
from curate.functions import text as T
from curate.functions import urls as U
from curate.operators import entries as E
from curate.operators import lifecycle as L

DAY = "2024-01-05"
WORDS = ["License", "été ", "ÜBER"]


@query("SELECT id, utc_date AS publication_date FROM {dated_texts} WHERE utc_date IS NOT NULL")
def entry_date(t):
    return E.with_entry_date(t("dated_texts")).select("id", "publication_date")


@query(f"SELECT id, link, {normalized('link')} AS url FROM {{raw_entries}}")
def normalize_url(t):
    return t("raw_entries").select("id", "link", U.normalize_url(F.col("link")).alias("url"))


@query(f"SELECT id, {host('link')} AS source FROM {{raw_entries}}")
def source_host(t):
    return E.with_source(t("raw_entries")).select("id", "source")


WATCH = "nullif(url_decode(replace(regexp_extract(regexp_extract(link, '^[^?#]*\\?([^#]*)', 1), '(?:^|&)v=([^&]+)', 1), '+', ' ')), '')"
SHORT = "regexp_extract(link, '^https://youtu\\.be/([^?#;]*)', 1)"


@query(f"""
    SELECT id, link, CASE WHEN link LIKE 'https://www.youtube.com/%' OR link LIKE 'https://youtube.com/%' THEN {WATCH}
      WHEN link LIKE 'https://youtu.be/%' THEN {SHORT} END AS video_id FROM {{video_links}}
""")
def video_id(t):
    return t("video_links").select("id", "link", U.video_id(F.col("link")).alias("video_id"))


@query(f"""
    SELECT id, 'https://img.youtube.com/vi/' || CASE WHEN link LIKE 'https://www.youtube.com/%' THEN {WATCH}
      WHEN link LIKE 'https://youtu.be/%' THEN nullif({SHORT}, '') END || '/0.jpg' AS thumbnail_url FROM {{video_links}}
""")
def video_thumbnail(t):
    return t("video_links").select("id", U.video_thumbnail(F.col("link")).alias("thumbnail_url"))


@query(
    "SELECT doc_id, substr(regexp_replace(regexp_replace(regexp_replace(text, '[?<>:*|\"\\\\/]', '', 'g'),"
    f" '[{SPACE}]+', '_', 'g'), '[^\\pL\\pN_.-]', '', 'g'), 1, 255) AS slug FROM {{documents}}"
)
def title_slug(t):
    return t("documents").select("doc_id", T.title_slug(F.col("text")).alias("slug"))


MIXED = "concat('第', CAST(doc_id AS STRING), '篇', text, '中', lang, '文')"


@query(f"SELECT doc_id, {spaced(MIXED)} AS text FROM {{documents}}")
def cjk_spacing(t):
    mixed = F.concat(F.lit("第"), F.col("doc_id").cast("string"), F.lit("篇"), F.col("text"), F.lit("中"), F.col("lang"), F.lit("文"))
    return t("documents").select("doc_id", T.cjk_spacing(mixed).alias("text"))


@query(f"SELECT id, title, publication_date FROM {{entries}} WHERE publication_date = date '{DAY}'")
def filter_target_date(t):
    return E.on_dates(t("entries"), DAY).select("id", "title", "publication_date")


@query("""
    SELECT id, title, link, publication_date FROM {thin_entries}
    WHERE title IS NOT NULL AND title <> '' AND link IS NOT NULL AND link <> '' AND publication_date IS NOT NULL
""")
def filter_required(t):
    return E.required(t("thin_entries")).select("id", "title", "link", "publication_date")


@query("SELECT doc_id, text FROM {documents} WHERE " + " OR ".join(f"contains(lower(text), lower('{word}'))" for word in WORDS))
def keyword_filter(t):
    return E.keyword_filter(t("documents"), WORDS, "text").select("doc_id", "text")


@query("""
    SELECT doc_id, text FROM {documents} d WHERE EXISTS (
      SELECT 1 FROM (SELECT DISTINCT substring(url, 24, 12) AS keyword FROM {pages} UNION ALL SELECT substring(text, 5, 24) FROM {documents}
                     WHERE doc_id % 3 = 0 AND length(text) >= 40) k
      WHERE keyword <> '' AND contains(lower(d.text), lower(k.keyword)))
""")
def keyword_table(t):
    """Keywords by the thousand: parts of a third of the documents, and of the addresses of pages."""
    of_pages = t("pages").select(F.substring("url", 24, 12).alias("keyword"))
    of_texts = t("documents").where("doc_id % 3 = 0 AND length(text) >= 40").select(F.substring("text", 5, 24).alias("keyword"))
    keywords = of_pages.union(of_texts).where("keyword <> ''")
    return E.keyword_filter(t("documents"), keywords, "text").select("doc_id", "text")


@query("SELECT id, content FROM {thin_entries} WHERE content IS NOT NULL AND content <> ''")
def has_content(t):
    return E.has_content(t("thin_entries")).select("id", "content")


@query("""
    SELECT e.id, e.feed_url, f.category, f.use_browser FROM {raw_entries} e JOIN {feeds} f ON e.feed_url = f.feed_url
""")
def entries_with_feed(t):
    entries = t("raw_entries").select("id", "link", "feed_url")
    return E.entries_with_feed(entries, t("feeds")).select("id", "feed_url", "category", "use_browser")


@query("SELECT id, title, link, lang FROM {raw_entries}")
def union_feeds(t):
    entries = t("raw_entries").select("id", "title", "link", "lang")
    english = F.col("lang").eqNullSafe("en")
    return E.union_feeds(entries.where(english), entries.where(~english))


@query("""
    SELECT id, url, category FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY id) AS rn FROM {entries}) e WHERE rn = 1
""")
def first_by_url(t):
    return L.first_by_url(t("entries").select("id", "url", "category"))
