"""Ingest and state changes."""

from pyspark.sql import functions as F

from checks import fragments as S
from checks.register import query
from curate.operators import digest, stats
from curate.operators import lifecycle as L

CATEGORY, DAY = "Crypto", "2024-01-09"
STATE = ("id", "status", "score")
INSERTED = f"""
    SELECT id, url, category, fetch_date, 'fetched' AS status, {S.host('url')} AS source FROM (
      SELECT *, row_number() OVER (PARTITION BY url ORDER BY id) AS rn FROM {{arriving}}
    ) a WHERE rn = 1 AND url NOT IN (SELECT url FROM {{stored}})
"""


@query(INSERTED)
def insert_or_ignore(t):
    new = L.insert_or_ignore(t("arriving"), t("stored"))
    return new.select("id", "url", "category", "fetch_date", "status", "source")


@query(f"SELECT (SELECT count(*) FROM {{arriving}}) AS given, (SELECT count(*) FROM ({INSERTED}) i) AS saved")
def processed_count(t):
    arriving = t("arriving")
    return L.processed_count(arriving, L.insert_or_ignore(arriving, t("stored")))


@query("""
    SELECT a.id, a.title, CASE WHEN r.id IS NULL THEN a.score ELSE r.score END AS score
    FROM {articles} a LEFT JOIN {ratings} r ON r.id = a.id
""")
def apply_updates(t):
    articles = t("articles").select("id", "title", "score")
    return L.apply_updates(articles, t("ratings"), {"score": F.col("score")})


@query("""
    SELECT a.id, coalesce(r.score, a.score) AS score, r.rating_reason, CASE WHEN r.id IS NULL THEN a.status ELSE 'rated' END AS status
    FROM {articles} a LEFT JOIN (SELECT * FROM {ratings} WHERE score IS NOT NULL) r ON r.id = a.id AND a.status = 'fetched'
""")
def apply_ratings(t):
    articles = t("articles").select("id", "score", F.lit(None).cast("string").alias("rating_reason"), "status")
    # Ratings of articles in other states, and the same again, change nothing.
    ratings = t("ratings").select("id", "score", "rating_reason")
    others = t("articles").where("status <> 'fetched'").select(
        "id", F.lit(1.0).alias("score"), F.lit("late").alias("rating_reason"))
    return L.apply_ratings(articles, ratings.union(others).union(ratings))


@query("""
    SELECT id, fetch_date, category, score, CASE WHEN picked THEN 'selected_for_summary' ELSE status END AS status FROM (
      SELECT a.*, a.status = 'rated' AND score >= coalesce(min_score, 6.5) AND row_number() OVER (
        PARTITION BY fetch_date, a.category, a.status = 'rated' AND coalesce(score >= coalesce(min_score, 6.5), false)
        ORDER BY score DESC, id) <= 4 AS picked
      FROM {articles} a LEFT JOIN {min_scores} m ON m.category = a.category) p
""")
def mark_selected(t):
    articles = t("articles").select("id", "fetch_date", "category", "score", "status")
    return L.mark_selected(articles, t("min_scores"), 4)


@query("""
    SELECT a.id, coalesce(s.chinese_title, '') AS chinese_title, coalesce(s.english_summary, a.english_summary) AS english_summary,
      coalesce(s.chinese_summary, a.chinese_summary) AS chinese_summary, CASE WHEN s.id IS NULL THEN status ELSE 'summarized' END AS status
    FROM {articles} a LEFT JOIN {summaries} s ON s.id = a.id
""")
def apply_summaries(t):
    articles = t("articles").select(
        "id", F.lit("").alias("chinese_title"), "english_summary", "chinese_summary", "status")
    others = t("articles").where("status <> 'selected_for_summary'").select(
        "id", *[F.lit("late").alias(name) for name in ("chinese_title", "english_summary", "chinese_summary")])
    return L.apply_summaries(articles, t("summaries").unionByName(others))


@query("""
    SELECT a.id, h.thumbnail_url, CASE WHEN h.id IS NULL THEN status ELSE 'complete' END AS status
    FROM {articles} a LEFT JOIN {thumbnails} h ON h.id = a.id
""")
def apply_thumbnails(t):
    articles = t("articles").select("id", F.lit(None).cast("string").alias("thumbnail_url"), "status")
    others = t("articles").where("status <> 'summarized'").select("id", F.lit("late").alias("thumbnail_url"))
    return L.apply_thumbnails(articles, t("thumbnails").unionByName(others))


STUCK = f"category = '{CATEGORY}' AND fetch_date < date '{DAY}' AND status IN ('fetched', 'rated')"


@query(f"SELECT id, title, status FROM {{articles}} WHERE {STUCK}")
def stuck_filter(t):
    return L.stuck_filter(t("articles"), CATEGORY, DAY).select("id", "title", "status")


@query(f"SELECT id, score, CASE WHEN {STUCK} THEN 'failed' ELSE status END AS status FROM {{articles}}")
def finalize_stuck(t):
    return L.finalize_stuck(t("articles"), CATEGORY, DAY).select(*STATE)


@query("""
    SELECT id, score, CASE WHEN status IN ('fetched', 'rated', 'selected_for_summary') THEN 'failed' ELSE status END AS status
    FROM {articles}
""")
def finalize_all(t):
    return L.finalize_all(t("articles")).select(*STATE)


@query(f"SELECT id, score, status FROM {{articles}} WHERE NOT (category = '{CATEGORY}' AND fetch_date = date '{DAY}')")
def clear_partition(t):
    return L.clear_partition(t("articles"), CATEGORY, DAY).select(*STATE)


@query("SELECT category, count(*) AS count FROM {articles} GROUP BY category")
def articles_per_category(t):
    return stats.articles_per_category(t("articles"))


@query("SELECT category, round(avg(score), 6) AS avg_score FROM {articles} WHERE score IS NOT NULL GROUP BY category")
def avg_score_per_category(t):
    averages = stats.avg_score_per_category(t("articles"))
    return averages.select("category", F.round("avg_score", 6).alias("avg_score"))


@query("SELECT fetch_date, count(*) AS count FROM {articles} GROUP BY fetch_date ORDER BY fetch_date DESC")
def articles_per_day(t):
    return stats.articles_per_day(t("articles"))


@query("SELECT name, CAST(sum(count) AS BIGINT) AS count FROM {counters} GROUP BY name ORDER BY name")
def run_counters(t):
    return stats.run_counters(t("counters"))


@query("""
    SELECT name, count(*) AS calls, round(sum(duration), 4) AS total_time, round(avg(duration), 6) AS avg_time
    FROM {timings} GROUP BY name ORDER BY name
""")
def run_timings(t):
    return stats.run_timings(t("timings")).select(
        "name", "calls", F.round("total_time", 4).alias("total_time"), F.round("avg_time", 6).alias("avg_time"))


@query("SELECT video_id, string_agg(text, ' ' ORDER BY seq, text) AS text FROM {transcript} GROUP BY video_id")
def transcript_text(t):
    return digest.transcript_text(t("transcript"))


@query("""
    SELECT video_id, CAST((n - 1) // 3 AS INT) AS part, string_agg(text, ' ' ORDER BY n) AS text
    FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY seq, text) AS n FROM {transcript}) s GROUP BY video_id, (n - 1) // 3
""")
def transcript_parts(t):
    return digest.transcript_text(t("transcript"), 3)
