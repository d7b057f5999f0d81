"""Pick up newly landed feed documents."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curate.functions.dates import entry_date
from curate.operators.entries import with_entry_date
from curate.schema import empty
from curate.session import settings
from curate.sources.feeds import stream_feed_entries

ENTRY = ("title", "link", "published", "updated", "feed_url")
PENDING_SCHEMA = ", ".join([*[f"{name} string" for name in ENTRY], "batch int", "publication_date date"])
# How long an entry is remembered, counted from when it was last read.
REMEMBERED = "30 days"
# Keyed state on disk, so that what is remembered need not fit into memory.
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def ingest_new_documents(spark: SparkSession, landing: str, pending: str, checkpoint: str,
                         remembered: str = REMEMBERED) -> StreamingQuery:
    """Land the entries of all documents not seen before in the table at `pending`, then stop.

    The table has a folder per batch and publication day; a run takes its days from there (`pending_entries`) and
    gives entries their text when it has their page, be that days later. Entries without any date are left
    out, as no run could take them. The checkpoint remembers documents, and for `remembered` their entries, in
    state on disk: feeds repeat what they have said before, and an entry that comes again as it was is not
    landed again. One that comes changed is; the store knows URLs, and lets the first in. A batch that is run again
    after a failure replaces what it has written before.
    """

    def add(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").partitionBy("publication_date").parquet(f"{pending.rstrip('/')}/batch={number}")

    with settings(spark, STATE):
        # The day comes out of a generator, so that no later filter works it out again.
        day = F.explode(F.array(entry_date(F.col("published"), F.col("updated"))))
        entries = with_entry_date(stream_feed_entries(spark, landing).withColumn("publication_date", day))
        # When an entry was read, not what it says: no entry is ever late.
        new = (
            entries.withColumn("_read", F.current_timestamp()).withWatermark("_read", remembered)
            .dropDuplicatesWithinWatermark([*ENTRY]).drop("_read")
        )
        return (
            new.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )


def pending_entries(spark: SparkSession, pending: str) -> DataFrame:
    """The entries landed so far, for `Inputs.entries`, with their `publication_date`; none before the first. A
    filter on the day reads that day's folders."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pending)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return empty(spark, PENDING_SCHEMA).drop("batch")
    return spark.read.schema(PENDING_SCHEMA).parquet(pending).drop("batch")
