"""Files handed on: entries as CSV, digests as JSON."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curate.operators.digest import digest_json

CSV_COLUMNS = {"Title": "title", "URL": "link", "Date": "publication_date"}
# Quotes are doubled, as spreadsheets expect; quoted line breaks stay inside their field.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "lineSep": "\n",
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def entries_to_csv(entries: DataFrame, path: str) -> None:
    rows = entries.select(*[F.col(column).cast("string").alias(name) for name, column in CSV_COLUMNS.items()])
    options = {name: value for name, value in CSV_OPTIONS.items() if name != "multiLine"}
    rows.write.options(**options).csv(path)


def entries_from_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.options(**CSV_OPTIONS).csv(path, schema="Title string, URL string, Date string")


def digest_to_json(nested: DataFrame, path: str) -> None:
    """One document per line."""
    digest_json(nested).write.text(path)
