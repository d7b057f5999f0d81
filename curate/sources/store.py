"""The article store: texts written once, and the changes of state beside them.

Below the store's path, `articles` holds every article as it was added, in one folder per day and category;
`changes` holds what happened to it since, in one folder per change; `counts` holds what statistics need of each day
and category. A change is a few short columns per article, so no text is written again when an article
is rated, chosen, summarized or given up. An article's state is that of its latest change.

Files of articles are ordered by a digest of the URL and carry Bloom filters on it and on the id, so that
looking for a few of them skips most of the files, and most pages of the others.
"""

import datetime
import re
import uuid
from functools import reduce
from operator import or_

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from curate.operators.skew import sendable
from curate.schema import (
    ARTICLE_COLUMNS, ARTICLE_SCHEMA, KEYS, PARTITIONS, STATE_COLUMNS, as_articles, empty,
)
from curate.session import new_path, remove

# Characters a partition folder holds as percent codes.
ESCAPED = re.compile(r"""["#%'*/:=?\\{\[\]^\x00-\x1f\x7f]""")
# `since` is the last change before the article was added; `digest` is of its URL.
ADDED = "digest bigint, since bigint"
CHANGE_SCHEMA = ", ".join([
    *[f"{name} {ARTICLE_COLUMNS[name]}" for name in ("id", *STATE_COLUMNS)], "seq bigint", "writer string",
    *[f"{name} {ARTICLE_COLUMNS[name]}" for name in PARTITIONS],
])
COUNTS_SCHEMA = "articles bigint, scored bigint, score_sum double, fetch_date date, category string"
# Filters that tell a thousand URLs from those of a file with hardly an error.
BLOOM = {
    "parquet.bloom.filter.adaptive.enabled": "true",
    **{f"parquet.bloom.filter.enabled#{name}": "true" for name in ("digest", "id")},
    **{f"parquet.bloom.filter.fpp#{name}": "0.00001" for name in ("digest", "id")},
}
# As many URLs are looked for by their digests, in lists short enough to be pushed to the files.
SOUGHT, LISTED = 4096, 8


def url_digest(url: Column) -> Column:
    return F.xxhash64(url)


def _any(conditions: list[Column]) -> Column:
    """One of many conditions, as a tree of even depth."""
    while len(conditions) > 1:
        conditions = [reduce(or_, conditions[at:at + 2]) for at in range(0, len(conditions), 2)]
    return conditions[0]


class ArticleStore:
    """One writer per day and category at a time; readers see Parquet files."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.articles, self.changes, self.counts = (f"{self.path}/{name}" for name in ("articles", "changes", "counts"))

    def _at(self, path: str, schema: str) -> DataFrame:
        place, system = self._folder(path)
        return self.spark.read.schema(schema).parquet(path) if system.exists(place) else empty(self.spark, schema)

    def _folder(self, path: str):
        """A folder and its file system, as Hadoop sees them."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        """The changes so far."""
        place, system = self._folder(self.changes)
        if not system.exists(place):
            return []
        names = [status.getPath().getName() for status in system.listStatus(place)]
        return sorted(int(name.removeprefix("seq=")) for name in names if name.startswith("seq="))

    def _last(self) -> int:
        return max(self._numbers(), default=0)

    def _added(self) -> DataFrame:
        return self._at(self.articles, f"{ARTICLE_SCHEMA}, {ADDED}")

    def _states(self) -> DataFrame:
        """The latest change of each article that has any."""
        changes = self._at(self.changes, CHANGE_SCHEMA)
        latest = F.max(F.struct("seq", F.struct(*STATE_COLUMNS).alias("state")))
        return changes.groupBy(*KEYS).agg(latest.alias("_latest"))

    def read(self) -> DataFrame:
        """All articles; an absent store has none. Filters on day and category reach both scans, others that of
        the articles as far as they are not about their state. Without `content` no text is read or moved."""
        added = self._added()
        if not self._numbers():
            return added.select(*ARTICLE_COLUMNS)
        joined = added.join(self._states(), list(KEYS), "left")
        changed = F.col("_latest.seq") > F.col("since")
        return joined.select(*[
            F.when(changed, F.col(f"_latest.state.{name}")).otherwise(F.col(name)).alias(name)
            if name in STATE_COLUMNS else F.col(name)
            for name in ARTICLE_COLUMNS
        ])

    def on_dates(self, *dates: str) -> DataFrame:
        return self.read().where(F.col("fetch_date").isin(*[F.lit(day).cast("date") for day in dates]))

    def with_texts(self, rows: DataFrame, *dates: str) -> DataFrame:
        """Rows of some articles of these days, with `content`; no days stand for all. Texts of other days are not read.
        The rows are sent to the texts if they fit; both are shuffled otherwise."""
        texts = self._added().select(*KEYS, "content")
        if dates:
            texts = texts.where(F.col("fetch_date").isin(*[F.lit(day).cast("date") for day in dates]))
        return texts.join(sendable(rows), list(KEYS)).select(*rows.columns, "content")

    def known(self, urls: DataFrame) -> DataFrame:
        """Those of distinct `url`s that the store has. Few are looked for by lists of digests, which reach
        the files; more meet all digests, eight bytes an article, and texts of URLs only where these agree."""
        sought = urls.select("url").withColumn("digest", url_digest(F.col("url")))
        stored = self._added().select("digest", "url")
        few = [row["digest"] for row in sought.select("digest").distinct().limit(SOUGHT + 1).collect()]
        if not few:
            return stored.select("url").limit(0)
        if len(few) <= SOUGHT:
            few.sort()
            lists = [F.col("digest").isin(few[at:at + LISTED]) for at in range(0, len(few), LISTED)]
            stored = stored.where(_any(lists))
        return stored.join(sendable(sought), ["digest", "url"], "left_semi").select("url").distinct()

    def by_id(self, article_id: int) -> DataFrame:
        """The article of an id, with its text; the files that cannot hold it are passed over."""
        return self.read().where(F.col("id") == article_id)

    def _noted(self, rows: DataFrame) -> tuple[DataFrame, Observation]:
        """The same rows; once they are written, their days and categories are known without a second scan."""
        touched = Observation()
        return rows.observe(touched, F.collect_set(F.struct(*PARTITIONS)).alias("groups")), touched

    def _write(self, rows: DataFrame, mode: str) -> None:
        added, touched = self._noted(as_articles(rows).withColumns({
            "digest": url_digest(F.col("url")), "since": F.lit(self._last()).cast("bigint"),
        }))
        # Rebalancing splits a large partition over tasks and gathers small ones.
        even = added.hint("rebalance", *[F.col(name) for name in PARTITIONS])
        ordered = even.sortWithinPartitions(*PARTITIONS, "digest")
        writer = ordered.write.mode(mode).option("partitionOverwriteMode", "dynamic").options(**BLOOM)
        writer.partitionBy(*PARTITIONS).parquet(self.articles)
        self._recount(touched)

    def append(self, rows: DataFrame) -> None:
        self._write(rows, "append")

    def update(self, rows: DataFrame) -> None:
        """Set the state of articles: rows of `id`, day, category and all columns of the state. One change, written
        in one job; nothing is read back and no file is replaced. A repeated call sets the same states again."""
        folder = f"{self.changes}/seq={self._last() + 1}/writer={uuid.uuid4().hex}"
        narrow, touched = self._noted(rows.select(*[
            F.col(name).cast(ARTICLE_COLUMNS[name]).alias(name) for name in (*STATE_COLUMNS, *KEYS)
        ]))
        narrow.hint("rebalance", *[F.col(name) for name in PARTITIONS]).write.partitionBy(*PARTITIONS).parquet(folder)
        self._recount(touched)

    def stage(self, rows: DataFrame) -> str:
        """Write the coming rows of some partitions aside and name the place."""
        path = new_path(self.spark, "staged")
        as_articles(rows).write.parquet(path)
        return path

    def commit(self, staged: str) -> None:
        """Put staged rows in place of the partitions they belong to. After a crash the same
        call, with the staged rows still there, finishes the work."""
        self._write(self.spark.read.schema(ARTICLE_SCHEMA).parquet(staged), "overwrite")

    def replace(self, rows: DataFrame) -> None:
        """Replace whole partitions, texts included; earlier changes no longer count for them. The rows may come
        from this store: they are staged first, so a failing write never loses its own input."""
        staged = self.stage(rows)
        self.commit(staged)
        remove(self.spark, staged)

    def clear(self, category: str, date: str) -> None:
        """Empty the partition of one category and day, written as `yyyy-mm-dd`. A dynamic overwrite leaves
        partitions without new rows alone, so the folder gets an empty file of its own."""
        if datetime.date.fromisoformat(date).isoformat() != date:
            raise ValueError(f"not a day: {date}")
        folder = ESCAPED.sub(lambda found: f"%{ord(found.group()):02X}", category)
        for path, schema in ((self.articles, f"{ARTICLE_SCHEMA}, {ADDED}"), (self.counts, COUNTS_SCHEMA)):
            nothing = empty(self.spark, schema).drop(*PARTITIONS)
            nothing.write.mode("overwrite").parquet(f"{path}/fetch_date={date}/category={folder}")

    def _recount(self, touched: Observation) -> None:
        """Bring the counts of the days and categories just written up to date: at most the folders of the store."""
        try:
            groups = [tuple(group) for group in touched.get["groups"]]
        except Py4JJavaError:
            # Spark drops the observation together with a plan that turns out to be empty.
            return
        if not groups:
            return
        kinds = ", ".join(f"{name} {ARTICLE_COLUMNS[name]}" for name in PARTITIONS)
        days = sorted({day for day, _ in groups})
        rows = self.read().where(F.col("fetch_date").isin(days)).select(*PARTITIONS, "score")
        counted = rows.join(F.broadcast(self.spark.createDataFrame(groups, kinds)), list(PARTITIONS), "left_semi").groupBy(
            *PARTITIONS
        ).agg(
            F.count("*").alias("articles"), F.count("score").alias("scored"),
            F.coalesce(F.sum("score"), F.lit(0.0)).alias("score_sum"),
        )
        counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(self.counts)

    def counted(self) -> DataFrame:
        """`articles`, `scored` ones and their `score_sum` by day and category, as the last write left them."""
        return self._at(self.counts, COUNTS_SCHEMA)

    def compact(self) -> None:
        """Fold all changes into one, which holds the state of each changed article. Texts are not touched. No
        one may read or write the store meanwhile."""
        numbers = self._numbers()
        if len(numbers) < 2:
            return
        current = self._added().select(*KEYS, "since").join(self._states(), list(KEYS))
        states = current.where(F.col("_latest.seq") > F.col("since")).select("_latest.state.*", *KEYS)
        folder = f"{self.changes}/seq={numbers[-1] + 1}/writer={uuid.uuid4().hex}"
        states.hint("rebalance", *[F.col(name) for name in PARTITIONS]).write.partitionBy(*PARTITIONS).parquet(folder)
        for number in numbers:
            place, system = self._folder(f"{self.changes}/seq={number}")
            system.delete(place, True)
