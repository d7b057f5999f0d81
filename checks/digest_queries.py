"""Digests over published articles."""

from pyspark.sql import functions as F

from checks.fragments import PUBLISHED
from checks.register import query
from curate.operators import digest as D

CATEGORY, DAY = "AI & Tech", "2024-01-05"
COLUMNS = "id, url, title, publication_date, fetch_date, category, score, status, english_summary, chinese_summary"


@query(f"SELECT id, fetch_date, category, status, chinese_summary FROM {{articles}} WHERE {PUBLISHED}")
def published_filter(t):
    return D.published(t("articles")).select("id", "fetch_date", "category", "status", "chinese_summary")


@query(f"SELECT id, fetch_date, category FROM {{articles}} WHERE {PUBLISHED} AND fetch_date = date '{DAY}' AND category = '{CATEGORY}'")
def digest_filter(t):
    return D.digest_filter(t("articles"), DAY, CATEGORY).select("id", "fetch_date", "category")


@query(f"SELECT id, {COLUMNS.removeprefix('id, ')}, content FROM {{articles}} WHERE id = 8")
def article_by_id(t):
    return D.article_by_id(t("articles"), 8)


@query(f"SELECT {COLUMNS} FROM {{articles}} WHERE {PUBLISHED} ORDER BY fetch_date DESC, score DESC NULLS LAST, id")
def digest_order(t):
    return D.digest_order(t("articles"))


@query(f"""
    SELECT {COLUMNS} FROM {{articles}} WHERE {PUBLISHED} AND fetch_date = date '{DAY}' AND category = '{CATEGORY}'
    ORDER BY score DESC NULLS LAST, id
""")
def category_digest(t):
    return D.category_digest(t("articles"), CATEGORY, DAY)


@query(f"SELECT DISTINCT fetch_date FROM {{articles}} WHERE {PUBLISHED} ORDER BY fetch_date DESC")
def available_dates(t):
    return D.available_dates(t("articles"))


@query("SELECT DISTINCT category FROM {articles} ORDER BY category")
def all_categories(t):
    return D.all_categories(t("articles"))


@query(f"""
    SELECT {COLUMNS} FROM {{articles}}
    WHERE {PUBLISHED} AND fetch_date = (SELECT max(fetch_date) FROM {{articles}} WHERE {PUBLISHED})
""")
def latest_date(t):
    return D.latest_digest(t("articles"))


PAGES = f"""
    SELECT {COLUMNS}, CAST(dense_rank() OVER (ORDER BY fetch_date DESC) AS INT) AS page FROM {{articles}} WHERE {PUBLISHED}
"""


@query(PAGES)
def date_pages(t):
    return D.date_pages(t("articles"))


@query(PAGES)
def date_page(t):
    return D.date_page(t("articles"))


NESTED = f"""
    SELECT fetch_date, category, CAST(n - 1 AS INT) AS place, n AS position, id, title, score
    FROM (SELECT *, row_number() OVER (PARTITION BY fetch_date, category ORDER BY score DESC NULLS LAST, id) AS n
          FROM {{articles}} WHERE {PUBLISHED}) a
"""


def flat(nested):
    listed = nested.select("*", F.posexplode("articles").alias("place", "article")).drop("articles")
    return listed.select(
        *listed.columns[:-1], "article.position", "article.id", "article.title", "article.score")


@query(NESTED)
def digest_nested(t):
    rows = D.digest_rows(D.published(t("articles"))).select("fetch_date", "category", "id", "title", "score")
    return flat(D.digest_nested(rows))


@query(f"""
    SELECT fetch_date, category, CAST((position - 1) // 2 AS INT) AS page, CAST((position - 1) % 2 AS INT) AS place,
      position, id, title, score
    FROM ({NESTED}) n
""")
def digest_pages(t):
    rows = D.digest_rows(D.published(t("articles"))).select("fetch_date", "category", "id", "title", "score")
    return flat(D.digest_nested(rows, 2))
