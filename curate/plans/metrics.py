"""Counters and timings of one run."""

import time
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class RunMetrics:
    """A handful of numbers per run. Rows are counted inside the jobs that write them."""

    def __init__(self, run_id: str | None = None):
        self.run_id = run_id or uuid.uuid4().hex
        self._counts: list[tuple[str, int]] = []
        self._observed: list[tuple[str, Observation]] = []
        self._calls: list[tuple[str, Observation]] = []
        self._timings: list[tuple[str, float]] = []

    def increment(self, name: str, count: int = 1) -> None:
        self._counts.append((name, count))

    def counted(self, rows: DataFrame, name: str) -> DataFrame:
        """The same rows; once they are written, their number is a counter."""
        observation = Observation()
        self._observed.append((name, observation))
        return rows.observe(observation, F.count(F.lit(1)).alias("rows"))

    def distinct(self, rows: DataFrame, name: str, column: str) -> DataFrame:
        """The same rows; once they are written, the number of values of `column`, which are few, is a counter."""
        observation = Observation()
        self._observed.append((name, observation))
        return rows.observe(observation, F.size(F.collect_set(column)).alias("rows"))

    def timed(self, rows: DataFrame, name: str, column: str) -> DataFrame:
        """The same rows; once they are written, the sum of `column` is a timing, and their number a counter."""
        observation = Observation()
        self._calls.append((name, observation))
        return rows.observe(
            observation, F.count(F.lit(1)).alias("calls"), F.coalesce(F.sum(column), F.lit(0.0)).alias("total")
        )

    @contextmanager
    def time_block(self, name: str):
        start = time.monotonic()
        try:
            yield
        finally:
            self._timings.append((name, time.monotonic() - start))

    def counters(self, spark: SparkSession) -> DataFrame:
        """Rows `(run_id, name, count)` for `stats.run_counters`."""
        seen = [(name, observation.get["rows"]) for name, observation in self._observed]
        seen += [(name, observation.get["calls"]) for name, observation in self._calls]
        rows = [(self.run_id, name, int(count)) for name, count in self._counts + seen]
        return spark.createDataFrame(rows, "run_id string, name string, count bigint")

    def timings(self, spark: SparkSession) -> DataFrame:
        """Rows `(run_id, name, duration)` for `stats.run_timings`."""
        called = [(name, observation.get["total"]) for name, observation in self._calls]
        rows = [(self.run_id, name, float(duration)) for name, duration in self._timings + called]
        return spark.createDataFrame(rows, "run_id string, name string, duration double")
