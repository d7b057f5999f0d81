"""Rating: criteria, requests, replies, thresholds, the best of each day."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curate.functions.text import SPACES, ascii_digits, strip
from curate.operators.skew import SALTS, lookup_join
from curate.schema import RATED

# Settings of a run.
TOP_ARTICLES = 10
MINIMUM_SCORE = 6.5
RATING_MODEL = "gpt-3.5-turbo"
DEFAULT_CATEGORY = "default"
# Up to this rank Spark cuts each group per task before the shuffle.
RANKED_PER_TASK = 1000

# The form a reply must have, and the outcomes of reading it.
IRRELEVANT_REPLY = "not relevant"
SCORE_FORM = rf"(?i)Rating:[{SPACES}]*(\p{{Nd}}+(?:\.\p{{Nd}}+)?)/10"
REASON_FORM = r"(?is)\A(.*?)Rating:"
SUCCESS, IRRELEVANT, BAD_FORMAT = "success", "irrelevant", "bad_format"


def merge_criteria(default: Column, own: Column) -> Column:
    """Default criteria and those of a category, whose points win; order of first mention."""
    kept = F.transform_values(default, lambda name, points: F.coalesce(F.try_element_at(own, name), points))
    added = F.map_filter(own, lambda name, points: ~F.map_contains_key(default, name))
    return F.map_concat(kept, added)


def criteria_by_category(criteria: DataFrame) -> DataFrame:
    """Rows `(category, position, criterion, points)` as one map per category, in file order."""
    listed = F.sort_array(F.collect_list(F.struct("position", "criterion", "points")))
    pairs = F.transform(listed, lambda row: F.struct(row["criterion"], row["points"]))
    return criteria.groupBy("category").agg(F.map_from_entries(pairs).alias("criteria"))


def article_criteria(articles: DataFrame, criteria: DataFrame, spread: str = "id") -> DataFrame:
    """Add the `criteria` that hold for each article: its category's over the default ones.

    Merging happens once per category. The default set is a scalar subquery, so it reaches
    categories without an entry without a join.
    """
    maps = criteria_by_category(criteria)
    default = F.coalesce(
        maps.where(F.col("category") == DEFAULT_CATEGORY).select("criteria").scalar(),
        F.create_map().cast("map<string,int>"),
    )
    merged = maps.withColumn("_default", default).select(
        "category", merge_criteria(F.col("_default"), F.col("criteria")).alias("_merged")
    )
    found = F.coalesce(F.col("_merged"), default)
    joined = lookup_join(articles, merged, "category", "left", spread)
    return joined.withColumn("criteria", found).drop("_merged")


def criteria_text(criteria: Column) -> Column:
    return F.array_join(
        F.transform(
            F.map_entries(criteria),
            lambda entry: F.concat(entry["key"], F.lit(" ("), entry["value"].cast("string"), F.lit(" points)")),
        ),
        ", ",
    )


def chat_request(model: str, system: Column, user: Column) -> Column:
    """One request to a chat model, in the usual message form."""
    return F.struct(
        F.lit(model).alias("model"),
        F.array(
            F.struct(F.lit("system").alias("role"), system.alias("content")),
            F.struct(F.lit("user").alias("role"), user.alias("content")),
        ).alias("messages"),
    )


def rating_request(criteria: Column, content: Column, model: str = RATING_MODEL) -> Column:
    system = F.concat(
        F.lit("Judge articles by these criteria and nothing else: "),
        criteria_text(criteria),
        F.lit(
            ". Reply 'Not relevant' if the article meets none of them. Otherwise give the reason"
            " in one sentence and then 'Rating: X/10', X being a number from 1 to 10."
        ),
    )
    return chat_request(model, system, F.concat(F.lit("Article to judge:\n\n"), content))


def rating_requests(articles: DataFrame, criteria: DataFrame, model: str = RATING_MODEL) -> DataFrame:
    """One request per article with text; without any criteria there is none to make."""
    ready = article_criteria(articles, criteria).where(F.size("criteria") > 0)
    return ready.select("id", rating_request(F.col("criteria"), F.col("content"), model).alias("request"))


def parse_rating(replies: DataFrame, column: str = "raw_rating") -> DataFrame:
    """Add `score`, `rating_reason` and `outcome` read from a reply."""
    reply = strip(F.col(column))
    irrelevant = F.lower(reply) == IRRELEVANT_REPLY
    score = F.when(~irrelevant, ascii_digits(F.regexp_extract(reply, SCORE_FORM, 1)).try_cast("double"))
    parsed = replies.withColumn("score", score)
    return parsed.withColumn(
        "rating_reason",
        F.when(F.col("score").isNotNull(), strip(F.regexp_extract(reply, REASON_FORM, 1))),
    ).withColumn(
        "outcome",
        F.when(irrelevant, F.lit(IRRELEVANT))
        .when(F.col("score").isNotNull(), F.lit(SUCCESS))
        .when(F.col(column).isNotNull(), F.lit(BAD_FORMAT)),
    )


def with_min_score(articles: DataFrame, min_scores: DataFrame, default: float = MINIMUM_SCORE) -> DataFrame:
    """Add the `min_score` of each article's category."""
    own = min_scores.select("category", F.col("min_score").alias("_own"))
    joined = lookup_join(articles, own, "category", "left", "id")
    return joined.withColumn("min_score", F.coalesce("_own", F.lit(default))).drop("_own")


def min_score_filter(articles: DataFrame, min_scores: DataFrame, default: float = MINIMUM_SCORE) -> DataFrame:
    return with_min_score(articles, min_scores, default).where(F.col("score") >= F.col("min_score"))


def top_k_per_category(articles: DataFrame, min_scores: DataFrame, k: int = TOP_ARTICLES,
                       default: float = MINIMUM_SCORE) -> DataFrame:
    """The k best rated articles per day and category, with their `rank`; ties go by id.

    Give narrow rows only. Every task first keeps its own k best of each group, so what is
    shuffled does not grow with a hot category. Spark does that by itself for a small k; for a
    larger one each group is first ranked in SALTS parts.
    """
    best = min_score_filter(articles.where(F.col("status") == RATED), min_scores, default)
    group, order = ("fetch_date", "category"), (F.desc("score"), F.asc("id"))
    if k > RANKED_PER_TASK:
        part = F.pmod(F.xxhash64("id"), F.lit(SALTS))
        within = Window.partitionBy(*group, part).orderBy(*order)
        best = best.withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= k)
    return best.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(
        F.col("rank") <= k
    )


def top_k_one(articles: DataFrame, category: str, date: str, min_score: float = MINIMUM_SCORE,
              k: int = TOP_ARTICLES) -> DataFrame:
    """The k best rated articles of one category and day, best first."""
    return (
        articles.where(
            (F.col("status") == RATED)
            & (F.col("category") == category)
            & (F.col("fetch_date") == F.lit(date).cast("date"))
            & (F.col("score") >= min_score)
        )
        .orderBy(F.desc("score"), "id")
        .limit(k)
    )
