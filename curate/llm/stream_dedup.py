"""Exact duplicates by a stream whose state keeps one entry per distinct text.

The stream reads documents as files land. Its state, on disk in RocksDB and never expiring, has under the
digest of a text the identifier of the row that stays, its locator (file and row in it), and
how many rows had the digest. A digest is not a proof: all rows whose digest was met more than once are
then compared by full bytes with the row that the locator names, and digests under which different
texts met are resolved by the texts themselves.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curate.operators.skew import lookup_join, sendable, skew_safe_join
from curate.session import new_path, remove, written

BLANKS = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"
# How many bytes of files a micro-batch takes.
BATCH_BYTES = 64 << 30
# A partition of the state for so many bytes of documents that are there at the first start, and the least
# number of them. A store takes 4 MB of disk before it holds anything, so there are not more than needed.
STATE_BYTES, STATE_PARTITIONS = 4 << 30, 12
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # All state of an executor shares one bounded cache and write buffer.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def normalised(text: Column) -> Column:
    """The text with every run of blanks as one space; NULL is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _located(docs: DataFrame, digest_chars: int) -> DataFrame:
    """Rows of a file source without their texts: the digest, and the order in which rows stay: the smallest
    `doc_id`, NULL last, then the place of the row."""
    text = normalised(F.col("text"))
    return docs.select(
        sha256(text).alias("text_sha256"), sha256(text).substr(1, digest_chars).alias("digest"),
        F.struct(
            F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").cast("long").alias("doc_id"),
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
        ).alias("place"),
    )


def digest_stream(spark: SparkSession, path: str, schema: StructType, checkpoint: str, updates: str,
                  digest_chars: int = 64, options: dict | None = None) -> None:
    """Take up all documents under `path` that the checkpoint has not seen, and stop.

    Each micro-batch appends the state of the digests it met to `updates`: a digest's last state is the
    one with the largest count. A batch that is run again after a failure writes the same again.
    """
    status = _status(spark, path)
    there = status and status.getPath().getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(
        status.getPath()
    ).getLength()
    partitions = max(STATE_PARTITIONS, (there or 0) // STATE_BYTES)
    settings = STATE | {"spark.sql.streaming.internal.stateStore.partitions": str(partitions)}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        # No file is too old to be read: one may come long after the newest was written.
        stream = spark.readStream.schema(schema).option("maxFileAge", "36500d").options(
            **(options or {"maxBytesPerTrigger": str(BATCH_BYTES)})
        )
        met = (
            _located(stream.parquet(_source(spark, path)), digest_chars).groupBy("digest")
            .agg(F.min("place").alias("place"), F.count("*").alias("size"))
        )

        def keep(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{updates}/batch={number}")

        query = (
            met.writeStream.outputMode("update").foreachBatch(keep)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def exact_duplicates(spark: SparkSession, path: str, schema: StructType, digest_chars: int = 64,
                     options: dict | None = None, state: str | None = None) -> DataFrame:
    """`doc_id`, `keep_id`, `group_size`, `kept` and `text_sha256` of each row under `path`, and the `file` and `row`
    that it is.

    Of equal texts the row with the smallest `doc_id` stays, a NULL one last, and of repeated `doc_id`s
    the one whose file and row come first, so each group keeps exactly one row. NULL texts are empty. An
    empty table gives no rows; other columns are not read. `digest_chars` shortens the digest under which
    the state is kept; the result is the same. `options` go to the stream's reader instead of the bound on a batch's bytes.

    `state` names a folder that keeps checkpoint and state: a later call with it reads only the files that have come
    since into the state, and compares the texts of all groups. Without it both are deleted.

    Texts are moved only of rows whose digest was met again, to be compared with the first row of their group; a
    group of any size is dealt out for that over as many tasks as it takes. Else rows are digests and places.
    """
    if state is None:
        checkpoint, updates = new_path(spark, "digest-stream"), new_path(spark, "digest-updates")
    else:
        checkpoint, updates = f"{state.rstrip('/')}/stream", f"{state.rstrip('/')}/updates"
    digest_stream(spark, path, schema, checkpoint, updates, digest_chars, options)
    place = "struct<unknown: boolean, doc_id: bigint, file: string, row: bigint>"
    kinds = f"digest string, place {place}, size bigint"
    if _exists(spark, updates):
        found = spark.read.schema(f"{kinds}, batch int").parquet(updates)
    else:
        found = spark.createDataFrame([], kinds)
    groups = written(
        found.groupBy("digest").agg(F.min("place").alias("first"), F.max("size").alias("size")), "digests"
    )
    if state is None:
        remove(spark, checkpoint, updates)
    source = spark.read.schema(schema).parquet(path)
    # Rows met once need nothing else; the groups that others are in are sent to them if they fit, and if not the
    # rows of a large group are dealt out.
    rows = _located(source, digest_chars).withColumn("row", F.col("place.row"))
    located = lookup_join(rows, groups.where("size > 1"), "digest", "left", "row").drop("row")
    located = written(located.withColumns({
        "first": F.coalesce("first", "place"), "size": F.coalesce("size", F.lit(1).cast("long")),
    }), "located")
    again = located.where("size > 1").select(
        "digest", F.col("place.file").alias("file"), F.col("place.row").alias("row"), (F.col("place") == F.col("first")).alias("is_first")
    )
    texts = written(_texts_of(source, again).withColumn("text", normalised(F.col("text"))), "met-again")
    first = texts.where("is_first").select("digest", F.col("text").alias("kept_text"))
    unequal = skew_safe_join(texts.where("NOT is_first").select("digest", "row", "text"), first, "digest", "inner", "row")
    # Written before it is made distinct: a join that feeds a grouping by its own key cannot be split.
    unequal = written(unequal.where("text <> kept_text").select("digest"), "unequal")
    result = [
        F.col("place.doc_id").alias("doc_id"), F.col("first.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"), (F.col("place") == F.col("first")).alias("kept"), F.col("text_sha256"),
        F.col("place.file").alias("file"), F.col("place.row").alias("row"),
    ]
    if unequal.isEmpty():
        return located.select(*result)
    clash = written(unequal.distinct(), "clashes")
    unsure = located.join(clash, "digest", "left_semi").drop("first", "size")
    sides = texts.join(clash, "digest", "left_semi").select("file", "row", "text")
    unsure = unsure.withColumns({"file": F.col("place.file"), "row": F.col("place.row")}).join(sides, ["file", "row"]).drop("file", "row")
    by_text = unsure.groupBy("text").agg(F.min("place").alias("first"), F.count("*").alias("size"))
    return (
        located.join(clash, "digest", "left_anti").select(*result)
        .unionByName(unsure.join(by_text, "text").select(*result))
    )


def _with_place(source: DataFrame) -> DataFrame:
    return source.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def _texts_of(source: DataFrame, rows: DataFrame) -> DataFrame:
    """`rows` with the `text` of the file and row they name. They are sent to the texts if they fit."""
    texts = _with_place(source.select("text", "_metadata")).select(
        F.col("_file").alias("file"), F.col("_row").alias("row"), "text"
    )
    return texts.join(sendable(rows), ["file", "row"])


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, that stay: of equal texts, a NULL one being empty, the one with the smallest
    `doc_id`, NULL last, and of repeated ids one of them. No rows give none; columns of any name stay as they are.

    The stream needs files, so the rows are staged first. They are read again less those that go, whose files and rows
    are sent to them if they fit; no text is moved for it then.
    """
    spark = docs.sparkSession
    path = new_path(spark, "to-deduplicate")
    docs.write.parquet(path)
    going = exact_duplicates(spark, path, docs.schema).where("NOT kept").select(
        F.col("file").alias("_file"), F.col("row").alias("_row")
    )
    rows = _with_place(spark.read.schema(docs.schema).parquet(path))
    return rows.join(sendable(written(going, "going")), ["_file", "_row"], "left_anti").drop("_file", "_row")


def _status(spark: SparkSession, path: str):
    """The status of a file or folder on any store, or None."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.getFileStatus(place) if store.exists(place) else None


def _exists(spark: SparkSession, path: str) -> bool:
    return _status(spark, path) is not None


def _source(spark: SparkSession, path: str) -> str:
    """A stream reads folders, or what a pattern names: a single file is named by a pattern."""
    status = _status(spark, path)
    return f"{path[:-1]}[{path[-1]}]" if status is not None and status.isFile() else path
