"""The feed registry and the rating criteria, kept as JSON documents."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curate.schema import FEED_SCHEMA, empty

FEED_DOCUMENT = "map<string, struct<rating_criteria: string, feeds: array<string>, use_playwright: boolean>>"
CRITERIA_DOCUMENT = "map<string, map<string, int>>"
CRITERIA_SCHEMA = "category string, position int, criterion string, points int"


def documents(spark: SparkSession, path: str, kind: str, lines: bool) -> DataFrame | None:
    """Parsed documents: one per file, or one per line. Malformed ones are NULL."""
    try:
        texts = spark.read.text(path, wholetext=not lines)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return texts.select(F.from_json("value", kind).alias("document"))


def feed_registry(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row per category and feed; a missing or malformed document adds none."""
    found = documents(spark, path, FEED_DOCUMENT, lines)
    if found is None:
        return empty(spark, FEED_SCHEMA)
    listed = found.select(F.explode("document").alias("category", "entry"))
    return listed.select(
        "category",
        F.explode("entry.feeds").alias("feed_url"),
        F.coalesce("entry.use_playwright", F.lit(False)).alias("use_browser"),
        "entry.rating_criteria",
    )


def criteria_registry(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row per category and criterion, in the order of the document."""
    found = documents(spark, path, CRITERIA_DOCUMENT, lines)
    if found is None:
        return empty(spark, CRITERIA_SCHEMA)
    listed = found.select(F.explode("document").alias("category", "entry"))
    each = listed.select("category", F.posexplode(F.map_entries("entry")).alias("position", "pair"))
    return each.select("category", "position", F.col("pair.key").alias("criterion"), F.col("pair.value").alias("points"))
