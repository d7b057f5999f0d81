"""Rating, selection and model replies."""

from pyspark.sql import functions as F

from checks import fragments as S
from checks.clients import OfflineClient
from checks.register import query
from curate.functions import text as T
from curate.operators import enrich as R
from curate.operators import entries as E
from curate.operators import lifecycle as L
from curate.operators import rating as G
from curate.operators import stats
from curate.schema import RATED

MERGED = """
    SELECT category, criterion, points, CAST(row_number() OVER (PARTITION BY category ORDER BY part, position) - 1 AS INT) AS position
    FROM (
      SELECT c.category, d.criterion, coalesce(o.points, d.points) AS points, 0 AS part, d.position
      FROM (SELECT DISTINCT category FROM {articles}) c CROSS JOIN (SELECT * FROM {criteria} WHERE category = 'default') d
      LEFT JOIN {criteria} o ON o.category = c.category AND o.criterion = d.criterion
      UNION ALL
      SELECT o.category, o.criterion, o.points, 1, o.position FROM {criteria} o
      WHERE o.category <> 'default' AND o.criterion NOT IN (SELECT criterion FROM {criteria} WHERE category = 'default')
    ) m
"""
CRITERIA_TEXT = f"""
    SELECT category, string_agg(criterion || ' (' || points || ' points)', ', ' ORDER BY position) AS criteria
    FROM ({MERGED}) m GROUP BY category
"""


@query(MERGED)
def criteria_merge(t):
    categories = t("articles").select("category").distinct()
    merged = G.article_criteria(categories, t("criteria"), "category")
    listed = merged.select("category", F.posexplode(F.map_entries("criteria")).alias("position", "pair"))
    return listed.select("category", "position", F.col("pair.key").alias("criterion"), F.col("pair.value").alias("points"))


@query(f"SELECT a.id, a.category, c.criteria FROM {{articles}} a JOIN ({CRITERIA_TEXT}) c ON c.category = a.category")
def article_criteria(t):
    merged = G.article_criteria(t("articles").select("id", "category"), t("criteria"))
    return merged.select("id", "category", G.criteria_text(F.col("criteria")).alias("criteria"))


@query(f"""
    SELECT a.id, 'gpt-3.5-turbo' AS model, 'system' AS first_role, 'user' AS second_role,
      'Judge articles by these criteria and nothing else: ' || c.criteria ||
      '. Reply ''Not relevant'' if the article meets none of them. Otherwise give the reason in one sentence and then '
      || '''Rating: X/10'', X being a number from 1 to 10.' AS system_text,
      'Article to judge:' || chr(10) || chr(10) || a.content AS user_text
    FROM {{articles}} a JOIN ({CRITERIA_TEXT}) c ON c.category = a.category
""")
def rating_prompt(t):
    requests = G.rating_requests(t("articles").select("id", "category", "content"), t("criteria"))
    messages = F.col("request.messages")
    return requests.select(
        "id", "request.model", messages[0]["role"].alias("first_role"), messages[1]["role"].alias("second_role"),
        messages[0]["content"].alias("system_text"), messages[1]["content"].alias("user_text"),
    )


PARSED = f"""
    SELECT *, CASE WHEN lower(reply) = 'not relevant' THEN 'irrelevant' WHEN score IS NOT NULL THEN 'success' ELSE 'bad_format' END AS outcome,
      CASE WHEN score IS NOT NULL THEN trim(regexp_extract(reply, '(?is)^(.*?)Rating:', 1), {S.SPACES}) END AS rating_reason
    FROM (SELECT id, reply, try_cast(nullif(regexp_extract(reply, '(?i)Rating:\\s*([0-9]+(?:\\.[0-9]+)?)/10', 1), '') AS DOUBLE) AS score
          FROM (SELECT id, trim(raw_rating, {S.SPACES}) AS reply FROM {{raw_entries}}) a) b
"""


@query(f"SELECT id, score, rating_reason, outcome FROM ({PARSED}) p")
def parse_rating(t):
    return G.parse_rating(t("raw_entries").select("id", "raw_rating")).select("id", "score", "rating_reason", "outcome")


WIDE = "translate({0}, '0123456789', '０１２３４５６７８９')"


@query(f"SELECT id, score, {WIDE.format('rating_reason')} AS rating_reason, outcome FROM ({PARSED}) p")
def wide_digits(t):
    """Replies with full-width digits, as Chinese keyboards have them; the `/10` is fixed."""
    wide = F.replace(F.translate("raw_rating", "0123456789", "０１２３４５６７８９"), F.lit("/１０"), F.lit("/10"))
    replies = t("raw_entries").select("id", wide.alias("raw_rating"))
    return G.parse_rating(replies).select("id", "score", "rating_reason", "outcome")


@query(f"SELECT outcome, count(*) AS count FROM ({PARSED}) p GROUP BY outcome")
def outcome_counts(t):
    return stats.outcome_counts(G.parse_rating(t("raw_entries").select("id", "raw_rating")))


MINIMUM = "SELECT a.*, coalesce(m.min_score, 6.5) AS min_score FROM {articles} a LEFT JOIN {min_scores} m ON m.category = a.category"


@query(f"SELECT id, category, score, min_score FROM ({MINIMUM}) a")
def article_min_score(t):
    return G.with_min_score(t("articles").select("id", "category", "score"), t("min_scores"))


@query(f"SELECT id, category, score FROM ({MINIMUM}) a WHERE score >= min_score")
def min_score_filter(t):
    return G.min_score_filter(t("articles").select("id", "category", "score"), t("min_scores")).drop("min_score")


TOP = f"""
    SELECT * FROM (
      SELECT fetch_date, category, id, score, CAST(row_number() OVER (PARTITION BY fetch_date, category ORDER BY score DESC, id) AS INT) AS rank
      FROM ({MINIMUM}) a WHERE status = 'rated' AND score >= min_score
    ) t WHERE rank <= 5
"""


@query(TOP)
def top_k_per_category(t):
    narrow = t("articles").select("fetch_date", "category", "id", "score", "status")
    return G.top_k_per_category(narrow, t("min_scores"), 5).select("fetch_date", "category", "id", "score", "rank")


@query(f"""
    SELECT * FROM (
      SELECT e.fetch_date, e.category, e.id, e.title, {S.host('e.url')} AS source, p.score, p.rating_reason,
        CAST(row_number() OVER (PARTITION BY e.fetch_date, e.category ORDER BY p.score DESC, e.id) AS INT) AS rank
      FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY id) AS rn FROM {{entries}} WHERE title <> '') e
      JOIN ({PARSED}) p ON p.id = e.id LEFT JOIN {{min_scores}} m ON m.category = e.category
      WHERE rn = 1 AND p.score >= coalesce(m.min_score, 6.5)
    ) t WHERE rank <= 5
""")
def daily_best(t):
    """From raw entries to the best of each day: dates, required fields, one row per URL, replies, top k."""
    replies = t("raw_entries").select("id", "raw_rating")
    new = L.first_by_url(E.required(t("entries")).select("id", "url", "title", "fetch_date", "category"))
    rated = G.parse_rating(E.with_source(new, "url").join(replies, "id"))
    scored = rated.withColumn("status", F.when(F.col("outcome") == G.SUCCESS, F.lit(RATED)))
    best = G.top_k_per_category(scored, t("min_scores"), 5)
    return best.select("fetch_date", "category", "id", "title", "source", "score", "rating_reason", "rank")


@query("""
    SELECT id, title, score FROM {articles} WHERE status = 'rated' AND category = 'Crypto' AND fetch_date = date '2024-01-05'
      AND score >= 4.0 ORDER BY score DESC, id LIMIT 10
""")
def top_k_one(t):
    return G.top_k_one(t("articles"), "Crypto", "2024-01-05", 4.0).select("id", "title", "score")


def summary_case(kind, system, opening, body):
    return f"""
        SELECT id, '{kind}' AS kind, 'gpt-4o' AS model, {S.literal(system)} AS system_text,
          {S.literal(opening)} || chr(10) || chr(10) || {body} AS user_text FROM {{articles}}
    """


WHOLE = "'Title: ' || title || chr(10) || chr(10) || 'Text:' || chr(10) || content"


@query(" UNION ALL ".join([
    summary_case("zh_title", "Translate titles into Chinese (zh-CN) and reply with the translation only.",
                 "Title to translate:", "title"),
    summary_case("zh_summary", "Summarize articles in Chinese (zh-CN), briefly, in 3 to 5 sentences and without"
                 " anything the article does not say.", "Article to summarize in Chinese:", WHOLE),
    summary_case("en_summary", "Summarize articles in English, briefly, in 3 to 5 sentences.",
                 "Article to summarize:", WHOLE),
]))
def summary_prompts(t):
    requests = R.summary_requests(t("articles").select("id", "title", "content"))
    messages = F.col("request.messages")
    return requests.select(
        "id", "kind", "request.model", messages[0]["content"].alias("system_text"), messages[1]["content"].alias("user_text")
    )


@query("""
    SELECT id, CASE WHEN size % 13 = 0 THEN NULL WHEN size % 7 = 0 THEN 'Not relevant'
        ELSE 'Length ' || size || '. Rating: ' || (size % 101) // 10 || '.' || (size % 101) % 10 || '/10' END AS reply,
      CASE WHEN size % 13 = 0 THEN 'ConnectionError: no answer' END AS error,
      CAST(CASE WHEN size % 13 = 0 THEN 3 ELSE 1 END AS INT) AS attempts
    FROM (SELECT id, length(content) AS size FROM {articles}) a
""")
def enrich(t):
    requests = G.rating_requests(t("articles").select("id", "category", "content"), t("criteria"))
    return R.enrich(requests, OfflineClient, retry_delay=0.0).drop("seconds")


def reply_of(kind):
    return f"max(CASE WHEN kind = '{kind}' THEN trim(reply, {S.SPACES}) END)"


SUMMARY_TEXTS = f"""
    SELECT id, CASE WHEN zh IS NOT NULL AND za IS NOT NULL THEN {S.spaced('zh')} END AS chinese_title, english_summary,
      CASE WHEN zh IS NOT NULL AND za IS NOT NULL THEN {S.spaced('za')} END AS chinese_summary
    FROM (SELECT id, {reply_of('zh_title')} AS zh, {reply_of('zh_summary')} AS za, {reply_of('en_summary')} AS english_summary
          FROM {{replies}} GROUP BY id) r
"""


@query(f"""
    SELECT * FROM ({SUMMARY_TEXTS}) s
    WHERE coalesce(chinese_title, '') <> '' OR coalesce(english_summary, '') <> '' OR coalesce(chinese_summary, '') <> ''
""")
def merge_summaries(t):
    return R.merge_summaries(t("replies"))
