"""Criteria, replies, selection, summaries."""

import datetime

from pyspark.sql import functions as F

from curate.operators import enrich as R
from curate.operators import rating as G

REPLIES = {
    "Good. Rating: 8.5/10": (8.5, "Good.", "success"),
    "RATING:  7/10": (7.0, "", "success"),
    "Rating: high. Rating: 6/10": (6.0, "", "success"),
    "a\nb\n rating: 15/10 etc": (15.0, "a\nb", "success"),
    "Rating: 0/10": (0.0, "", "success"),
    "  Not Relevant\n": (None, None, "irrelevant"),
    "not relevant.": (None, None, "bad_format"),
    "Not relevant. Rating: 2/10": (2.0, "Not relevant.", "success"),
    "": (None, None, "bad_format"),
    "Rating: 8 / 10": (None, None, "bad_format"),
    None: (None, None, None),
}


def test_parse_rating(spark):
    df = spark.createDataFrame([(i, reply) for i, reply in enumerate(REPLIES)], "i int, raw_rating string")
    found = G.parse_rating(df).orderBy("i").collect()
    assert [(row.score, row.rating_reason, row.outcome) for row in found] == list(REPLIES.values())


def test_criteria_keep_their_order_and_the_default_is_untouched(spark):
    rows = [("default", 0, "new", 3), ("default", 1, "clear", 2), ("A", 0, "clear", 5), ("A", 1, "big", 1)]
    criteria = spark.createDataFrame(rows, "category string, position int, criterion string, points int")
    articles = spark.createDataFrame([(1, "A"), (2, "B")], "id bigint, category string")
    found = G.article_criteria(articles, criteria).select("id", G.criteria_text(F.col("criteria")).alias("t")).collect()
    assert {row.id: row.t for row in found} == {
        1: "new (3 points), clear (5 points), big (1 points)", 2: "new (3 points), clear (2 points)"}


def test_no_criteria_no_request(spark):
    criteria = spark.createDataFrame([("A", 0, "x", 1)], "category string, position int, criterion string, points int")
    articles = spark.createDataFrame([(1, "A", "t"), (2, "B", "t")], "id bigint, category string, content string")
    assert [row.id for row in G.rating_requests(articles, criteria).collect()] == [1]


def ranked(spark, scores, status="rated"):
    day = datetime.date(2024, 1, 1)
    rows = [(i, day, "A", score, status) for i, score in enumerate(scores)]
    return spark.createDataFrame(rows, "id bigint, fetch_date date, category string, score double, status string")


def minimum(spark, *rows):
    return spark.createDataFrame(list(rows), "category string, min_score double")


def test_top_k_ties_go_by_id(spark):
    best = G.top_k_per_category(ranked(spark, [7.0, 9.0, 7.0, 7.0, 9.0]), minimum(spark), 3)
    assert [(row.id, row["rank"]) for row in best.orderBy("rank").collect()] == [(1, 1), (4, 2), (0, 3)]


def test_a_large_k_gives_the_same(spark, monkeypatch):
    articles = ranked(spark, [float(i % 7) + 4 for i in range(300)])
    small = G.top_k_per_category(articles, minimum(spark), 50).orderBy("rank").collect()
    monkeypatch.setattr(G, "RANKED_PER_TASK", 10)
    assert G.top_k_per_category(articles, minimum(spark), 50).orderBy("rank").collect() == small
    assert len(small) == 50


def test_top_k_respects_threshold_and_state(spark):
    low = minimum(spark, ("A", 8.0))
    assert G.top_k_per_category(ranked(spark, [7.0, None, 6.0]), low).count() == 0
    assert G.top_k_per_category(ranked(spark, [6.4, 6.5, 6.6]), minimum(spark)).count() == 2
    assert G.top_k_per_category(ranked(spark, [9.0], "complete"), minimum(spark)).count() == 0


def test_top_k_one_is_the_same(spark):
    articles = ranked(spark, [7.0, 9.0, 7.0, 7.0, 9.0, 6.0])
    one = [row.id for row in G.top_k_one(articles, "A", "2024-01-01", 6.5, 3).collect()]
    many = G.top_k_per_category(articles, minimum(spark), 3).orderBy("rank").collect()
    assert one == [row.id for row in many]


class Failing:
    def __init__(self):
        self.calls = 0

    def request(self, payload):
        self.calls += 1
        if payload["messages"][1]["content"].endswith("never") or self.calls == 1:
            raise TimeoutError("late")
        return {"choices": [{"message": {"content": f"call {self.calls}"}}]}


def test_enrich_retries_and_reports(spark):
    df = spark.createDataFrame([(1, "once"), (2, "never"), (3, "fine")], "id bigint, content string").coalesce(1)
    asked = df.select("id", G.chat_request("m", F.lit("s"), F.col("content")).alias("request"))
    found = {row.id: (row.reply, row.error, row.attempts) for row in R.enrich(asked, Failing, retry_delay=0.0).collect()}
    assert found == {1: ("call 2", None, 2), 2: (None, "TimeoutError: late", 3), 3: ("call 6", None, 1)}


def test_summaries_stand_or_fall(spark):
    rows = [
        (1, "zh_title", " 题a "), (1, "zh_summary", "摘b"), (1, "en_summary", "e"),
        (2, "zh_title", "题"), (2, "zh_summary", None), (2, "en_summary", "e"),
        (3, "zh_title", None), (3, "zh_summary", "摘"), (3, "en_summary", None),
        (4, "zh_title", " "), (4, "zh_summary", ""), (4, "en_summary", None),
    ]
    found = R.merge_summaries(spark.createDataFrame(rows, "id bigint, kind string, reply string")).collect()
    assert {row.id: tuple(row)[1:] for row in found} == {1: ("题 a", "e", "摘 b"), 2: (None, "e", None)}


def test_summary_requests_skip_empty_articles(spark):
    df = spark.createDataFrame([(1, "t", "c"), (2, "t", ""), (3, "t", None)], "id bigint, title string, content string")
    assert sorted((row.id, row.kind) for row in R.summary_requests(df).collect()) == [
        (1, "en_summary"), (1, "zh_summary"), (1, "zh_title")]


def test_digits_of_any_writing(spark):
    replies = ["ok Rating: ８.5/10", "Rating: ٧/10", "Rating: 9.٢５/10", "Rating: x/10", "评分 Rating:　７/10"]
    df = spark.createDataFrame(list(enumerate(replies)), "id int, raw_rating string")
    rows = G.parse_rating(df).orderBy("id").collect()
    assert [row.score for row in rows] == [8.5, 7.0, 9.25, None, 7.0]
    assert [row.outcome for row in rows] == ["success"] * 3 + ["bad_format", "success"] and rows[4].rating_reason == "评分"
