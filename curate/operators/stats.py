"""Counts, averages and run metrics."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def articles_per_category(store: DataFrame) -> DataFrame:
    return store.groupBy("category").agg(F.count("*").alias("count"))


def avg_score_per_category(store: DataFrame) -> DataFrame:
    """Average score of the scored articles; categories without any are left out."""
    scored = store.where(F.col("score").isNotNull())
    return scored.groupBy("category").agg(F.avg("score").alias("avg_score"))


def articles_per_day(store: DataFrame) -> DataFrame:
    return store.groupBy("fetch_date").agg(F.count("*").alias("count")).orderBy(F.desc("fetch_date"))


def category_counts(counted: DataFrame) -> DataFrame:
    """As `articles_per_category`, added up from counts by day and category."""
    return counted.groupBy("category").agg(F.sum("articles").alias("count")).where(F.col("count") > 0)


def category_averages(counted: DataFrame) -> DataFrame:
    """As `avg_score_per_category`, from the same counts."""
    summed = counted.groupBy("category").agg(F.sum("score_sum").alias("total"), F.sum("scored").alias("scored"))
    return summed.where(F.col("scored") > 0).select("category", (F.col("total") / F.col("scored")).alias("avg_score"))


def day_counts(counted: DataFrame) -> DataFrame:
    """As `articles_per_day`, from the same counts."""
    summed = counted.groupBy("fetch_date").agg(F.sum("articles").alias("count"))
    return summed.where(F.col("count") > 0).orderBy(F.desc("fetch_date"))


def run_counters(metrics: DataFrame) -> DataFrame:
    """Sum of each counter, from rows `(name, count)`."""
    return metrics.groupBy("name").agg(F.sum("count").alias("count")).orderBy("name")


def run_timings(metrics: DataFrame) -> DataFrame:
    """Calls, total and average time by name, from rows `(name, duration)`."""
    calls, total = F.count("duration"), F.coalesce(F.sum("duration"), F.lit(0.0))
    return metrics.groupBy("name").agg(
        calls.alias("calls"),
        total.alias("total_time"),
        F.coalesce(F.avg("duration"), F.lit(0.0)).alias("avg_time"),
    ).orderBy("name")


def outcome_counts(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("outcome").agg(F.count("*").alias("count"))
