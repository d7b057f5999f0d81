"""The list of queries with their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.views import oracle, reader

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of a table reader under its own name, with the SQL to compare to."""

    def add(function):
        name = function.__name__
        QUERIES[name] = lambda spark, sf_dir: function(reader(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return function

    return add
