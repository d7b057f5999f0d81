"""Views that turn the given tables into entries, articles, pages and logs.

The same text runs on Spark and as plain SQL. It therefore holds no backslashes and no quoted
quotes, and names tables and views in braces.
"""

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ("documents", "pages", "conversations", "events", "labels")

VIEWS = {
    # Entries as feeds give them. One URL in ten comes twice.
    "raw_entries": """
        SELECT doc_id AS id,
          concat(CASE root % 4 WHEN 0 THEN 'https://www.' WHEN 1 THEN 'http://' WHEN 2 THEN '//www.'
                 ELSE 'https://m.' END, 'src', CAST(root % 20 AS STRING), '.example.com',
                 CASE WHEN root % 5 = 0 THEN ':8080' ELSE '' END, '/a/', CAST(root AS STRING)) AS link,
          trim(split_part(text, chr(10), 1)) AS title,
          CASE WHEN doc_id % 7 = 3 THEN NULL ELSE date '2024-01-01' + CAST(doc_id % 14 AS INT) END AS published,
          CASE WHEN doc_id % 5 = 2 THEN NULL ELSE date '2024-01-02' + CAST(doc_id % 14 AS INT) END AS updated,
          CASE doc_id % 3 WHEN 0 THEN 'Crypto' WHEN 1 THEN 'AI & Tech' ELSE 'Academic' END AS category,
          text AS content, lang, source,
          concat('https://feeds.example.com/', lang, '/', source, '.xml') AS feed_url,
          CASE WHEN doc_id % 6 = 0 THEN 'Not relevant'
               WHEN doc_id % 11 = 0 THEN 'I like it, 8 out of 10'
               ELSE concat('Matches criteria ', CAST(doc_id % 9 AS STRING), '. Rating: ',
                           CAST(CAST(floor(((doc_id * 37) % 101) / 10) AS BIGINT) AS STRING), '.',
                           CAST(((doc_id * 37) % 101) % 10 AS STRING), '/10') END AS raw_rating
        FROM (SELECT *, CASE WHEN doc_id % 10 = 6 THEN doc_id - 4 ELSE doc_id END AS root FROM {documents}) d
    """,
    # The same entries with the texts that dates have in feeds, and what they come to in UTC.
    "dated_texts": """
        SELECT id, title, link, feed_url, lang,
          CASE WHEN published IS NULL THEN NULL ELSE
            concat('Mon, ', CAST(day(published) AS STRING), ' Jan 2024 ', hh, ':30:00',
                   CASE id % 3 WHEN 0 THEN ' -0500' WHEN 1 THEN ' GMT' ELSE ' +0900' END) END AS published,
          CASE WHEN updated IS NULL THEN NULL ELSE
            concat('2024-01-', lpad(CAST(day(updated) AS STRING), 2, '0'), 'T', hh, ':30:00',
                   CASE id % 3 WHEN 0 THEN '-05:00' WHEN 1 THEN 'Z' ELSE '+09:00' END) END AS updated,
          coalesce(published, updated) + CAST(CASE
            WHEN id % 3 = 0 AND id % 24 >= 19 THEN 1 WHEN id % 3 = 2 AND id % 24 < 9 THEN -1 ELSE 0 END AS INT)
            AS utc_date
        FROM (SELECT *, lpad(CAST(id % 24 AS STRING), 2, '0') AS hh FROM {raw_entries}) e
    """,
    "entries": """
        SELECT id, link, link AS url, title, coalesce(published, updated) AS publication_date,
          coalesce(published, updated) AS fetch_date, category, content, feed_url, lang
        FROM {raw_entries} WHERE coalesce(published, updated) IS NOT NULL
    """,
    "articles": """
        SELECT id, link AS url, title, publication_date, publication_date AS fetch_date, category, content,
          sc AS score,
          CASE WHEN sc IS NULL THEN 'fetched' WHEN sc < 6.5 OR rk > 3 THEN 'rated'
               WHEN id % 4 = 0 THEN 'selected_for_summary' WHEN id % 4 = 1 THEN 'summarized'
               ELSE 'complete' END AS status,
          CASE WHEN sc >= 6.5 AND rk <= 3 AND id % 4 > 0 THEN concat('EN ', CAST(id AS STRING)) END AS english_summary,
          CASE WHEN sc >= 6.5 AND rk <= 3 AND id % 4 > 0 THEN
            CASE WHEN id % 7 = 0 THEN '' WHEN id % 13 = 0 THEN NULL
                 ELSE concat('摘要 ', CAST(id AS STRING)) END END AS chinese_summary
        FROM (
          SELECT *, row_number() OVER (PARTITION BY publication_date, category
                      ORDER BY CASE WHEN sc >= 6.5 THEN sc END DESC NULLS LAST, id) AS rk
          FROM (
            SELECT *, try_cast(nullif(regexp_extract(raw_rating, '(?i)Rating:[ ]*([0-9]+(?:[.][0-9]+)?)/10', 1), '')
                        AS DOUBLE) AS sc
            FROM (
              SELECT *, row_number() OVER (PARTITION BY link ORDER BY id) AS rn
              FROM (SELECT *, coalesce(published, updated) AS publication_date FROM {raw_entries}) a
              WHERE publication_date IS NOT NULL AND title <> ''
            ) b WHERE rn = 1
          ) c
        ) k
    """,
    # Entries some of which lack a title, a link or text.
    "thin_entries": """
        SELECT id, CASE WHEN id % 9 = 4 THEN '' WHEN id % 9 = 5 THEN NULL ELSE title END AS title,
          CASE WHEN id % 8 = 3 THEN '' WHEN id % 8 = 5 THEN NULL ELSE link END AS link,
          CASE WHEN id % 5 = 1 THEN '' WHEN id % 5 = 2 THEN NULL ELSE content END AS content,
          coalesce(published, updated) AS publication_date
        FROM {raw_entries}
    """,
    "video_links": """
        SELECT doc_id AS id, CASE doc_id % 6
            WHEN 0 THEN concat('https://www.youtube.com/watch?v=', source, '%20', CAST(doc_id AS STRING), '&t=', lang)
            WHEN 1 THEN concat('https://youtube.com/watch?list=', lang, '&v=', CAST(doc_id AS STRING), '#v=0')
            WHEN 2 THEN concat('https://youtu.be/', CAST(doc_id AS STRING), '?si=', source)
            WHEN 3 THEN concat('https://www.youtube.com/watch?v=&t=', CAST(doc_id AS STRING))
            WHEN 4 THEN concat('https://m.youtube.com/watch?v=', CAST(doc_id AS STRING))
            ELSE concat('https://', source, '/watch?v=', CAST(doc_id AS STRING)) END AS link
        FROM {documents}
    """,
    "feeds": """
        SELECT DISTINCT CASE WHEN lang IN ('fr', 'de') THEN 'Crypto' WHEN lang = 'es' THEN 'Academic'
                 ELSE 'AI & Tech' END AS category, feed_url,
          lang = 'es' AS use_browser, concat('Is it about ', lang, '?') AS rating_criteria
        FROM {raw_entries}
    """,
    # Criteria with the number of documents as points; one category has none of its own.
    "criteria": """
        SELECT category, CAST(row_number() OVER (PARTITION BY category ORDER BY criterion) - 1 AS INT) AS position,
          criterion, CAST(count(*) AS INT) AS points
        FROM (
          SELECT CASE WHEN lang = 'en' THEN 'default' ELSE 'Crypto' END AS category, source AS criterion
          FROM {documents}
          UNION ALL SELECT 'Crypto', lang FROM {documents}
          UNION ALL SELECT 'AI & Tech', concat(lang, ' ', source) FROM {documents}
        ) c GROUP BY category, criterion
    """,
    "min_scores": """
        SELECT category, CAST(points AS DOUBLE) AS min_score
        FROM (VALUES ('AI & Tech', 7.2), ('Crypto', 6.0)) AS m(category, points)
    """,
    # Entries whose links name landed pages in three ways; two entries in three name page 1.
    "page_entries": """
        SELECT e.doc_id AS id, CASE e.doc_id % 3 WHEN 0 THEN p.url WHEN 1 THEN replace(p.url, 'https:', '')
                 ELSE replace(p.url, 'https://', '') END AS link
        FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN doc_id % (SELECT count(*) FROM {pages}) ELSE 1 END AS page_id
              FROM {documents}) e JOIN {pages} p ON p.page_id = e.page_id
    """,
    "pages_plain": """
        SELECT page_id, url, replace(replace(html, '<article', '<section'), '</article', '</section') AS html
        FROM {pages}
    """,
    "pages_mixed": """
        SELECT page_id, url, CASE page_id % 5 WHEN 0 THEN html
            WHEN 1 THEN replace(replace(html, '<article', '<main'), '</article', '</main')
            WHEN 2 THEN replace(replace(html, '<article', '<div id="top" class="wide entry-content"'), '</article', '</div')
            WHEN 3 THEN replace(replace(html, '<article', '<section role="main"'), '</article', '</section')
            ELSE replace(replace(html, '<article', '<section'), '</article', '</section') END AS html
        FROM {pages}
    """,
    # Pages whose container has others of its name in it, one of which is never closed.
    "pages_nested": """
        SELECT page_id, url, replace(replace(html, '<article>', '<div class="top content"><div>a<div class="content">b</div></div><div>'),
            '</article>', CASE WHEN page_id % 2 = 0 THEN '</div><DIV>tail</DIV></div><div>no</div>' ELSE '</div>tail<p></div><div>no</div>' END) AS html
        FROM {pages}
    """,
    # Pages without a container, in which a value looks like the attribute of one.
    "pages_quoted": """
        SELECT page_id, url, replace(replace(html, '<article>', '<section title="a class=content b"><section data-x="see id=content role=main ">'),
            '</article>', '</section></section>') AS html
        FROM {pages}
    """,
    # Pages with pictures: a named one on every third page, the same for half of these; then
    # a logo, a small one and inline data before the one that counts.
    "pages_img": """
        SELECT page_id, url, concat(
            CASE WHEN page_id % 3 = 0 THEN concat('<meta property="og:image" content="https://img.example.com/og/',
                   CAST(CASE WHEN page_id % 2 = 0 THEN 0 ELSE page_id END AS STRING), '.jpg?a=1', CASE WHEN page_id % 4 < 2 THEN '&#038;' ELSE '&amp;' END, 'b=2">') ELSE '' END,
            '<img src="/logo.png"><img width="50" src="/s/', CAST(page_id AS STRING), '.jpg">',
            '<img src="data:image/png;base64,x.png"><img alt="none"><img src="/s/', CAST(page_id AS STRING), '.gif">',
            CASE page_id % 5 WHEN 0 THEN '<img src="https://cdn.example.com/pic/' WHEN 1 THEN '<img height=400 src="//cdn.example.com/pic/'
                 WHEN 2 THEN '<img src="/pic/' WHEN 3 THEN '<img width="100%" height="50" src="pic/' ELSE '<p title="' END,
            CAST(page_id AS STRING), '.jpg">', html) AS html
        FROM {pages}
    """,
    "url_status": """
        SELECT concat('https://img.example.com/og/', CAST(doc_id % 40 AS STRING), '.jpg?a=1&b=2') AS url,
          CASE quality WHEN 1 THEN 200 ELSE 404 END AS status_code FROM {labels}
        UNION ALL
        SELECT concat('https://cdn.example.com/pic/', CAST(doc_id AS STRING), '.jpg'),
          CASE quality WHEN 1 THEN 200 ELSE 404 END FROM {labels}
        UNION ALL
        SELECT concat(regexp_extract(url, '^[a-z]+://[^/]+', 0), '/pic/', CAST(page_id AS STRING), '.jpg'),
          CASE WHEN page_id % 4 = 2 THEN 200 ELSE 500 END FROM {pages}
        UNION ALL
        SELECT concat('https://img.youtube.com/vi/', CAST(conv_id AS STRING), '/0.jpg'),
          CASE WHEN count(*) % 3 = 0 THEN 404 ELSE 200 END FROM {conversations} GROUP BY conv_id
    """,
    "candidates": """
        SELECT doc_id AS id, concat('https://cdn.example.com/pic/',
          CAST(CASE WHEN doc_id % 3 = 0 THEN 2 ELSE doc_id END AS STRING), '.jpg') AS image_url
        FROM {documents}
    """,
    "transcript": "SELECT conv_id AS video_id, turn AS seq, text FROM {conversations}",
    "counters": "SELECT event_type AS name, CAST(floor(value) AS BIGINT) AS count FROM {events}",
    "timings": "SELECT event_type AS name, value AS duration FROM {events}",
    # Ratings and thumbnails for some of the articles.
    "ratings": """
        SELECT id, CASE WHEN doc_score % 4 = 0 THEN NULL ELSE CAST(doc_score AS DOUBLE) / 8 END AS score,
          concat('because of ', CAST(doc_score AS STRING)) AS rating_reason
        FROM (SELECT id, length(content) % 80 AS doc_score FROM {articles} WHERE status = 'fetched') f
    """,
    # Three replies per article, some of them missing, some empty.
    "replies": """
        SELECT id, kind, CASE WHEN (id + n) % 7 = 0 THEN NULL WHEN id % 11 = 0 THEN '  '
          ELSE concat(' ', kind, ' 中', CAST(id AS STRING), '文', chr(10), title, chr(10)) END AS reply
        FROM (SELECT id, title, 'zh_title' AS kind, 0 AS n FROM {articles}
              UNION ALL SELECT id, title, 'zh_summary', 1 FROM {articles}
              UNION ALL SELECT id, title, 'en_summary', 2 FROM {articles}) r
    """,
    "summaries": """
        SELECT id, concat('题', CAST(id AS STRING)) AS chinese_title, concat('S ', title) AS english_summary,
          concat('摘', CAST(id AS STRING)) AS chinese_summary
        FROM {articles} WHERE status = 'selected_for_summary'
    """,
    "thumbnails": """
        SELECT id, concat('https://cdn.example.com/pic/', CAST(id AS STRING), '.jpg') AS thumbnail_url
        FROM {articles} WHERE status = 'summarized'
    """,
    # What is stored already and what comes in; both overlap in days and in URLs.
    "stored": """
        SELECT url FROM {entries} WHERE publication_date <= date '2024-01-07'
    """,
    "arriving": """
        SELECT id, url, title, publication_date, fetch_date, category, content
        FROM {entries} WHERE publication_date >= date '2024-01-05'
    """,
    # A run's entries: links to landed pages, several to one page, and links to videos.
    "run_entries": """
        SELECT t.id, t.lang, t.title, t.feed_url, t.published, t.updated, t.utc_date,
          CASE WHEN t.id % 10 = 9 THEN concat('https://www.youtube.com/watch?v=', CAST(t.id % 97 AS STRING)) ELSE p.url END AS link
        FROM {dated_texts} t JOIN {pages} p ON p.page_id = t.id % (SELECT count(*) FROM {pages})
    """,
}


def expand(sql: str) -> str:
    """A statement with the views it names put in front of it."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name in re.findall(r"\{(\w+)\}", text):
            if name in VIEWS and name not in needed:
                add(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    add(sql)
    plain = re.compile(r"\{(" + "|".join(VIEWS) + r")\}")
    parts = [f"{name} AS ({plain.sub(r'\1', VIEWS[name])})" for name in needed]
    body = plain.sub(r"\1", sql)
    return f"WITH {', '.join(parts)} {body}" if parts else body


def oracle(sql: str) -> str:
    """The statement as plain SQL over the registered tables."""
    return re.sub(r"\{(" + "|".join(TABLES) + r")\}", r"\1", expand(sql))


def reader(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    """Gives a table or a view by name."""

    def read(name: str) -> DataFrame:
        if name in TABLES:
            return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        sql = expand(f"SELECT * FROM {{{name}}}")
        used = {table: read(table) for table in TABLES if f"{{{table}}}" in sql}
        return spark.sql(sql, **used)

    return read
