"""From raw documents to packed training sequences, stage by stage.

A stage takes the documents that the one before has kept, written as Parquet and read again, and returns
what it keeps of them, with the same columns; the last returns the packed pieces.

All stages bear NULLs in any column, empty and very long texts, ties, repeated rows, columns of any other names and
tables without rows, which give none. What each does with them is said below and by the operator it calls.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curate.llm.packing import pack_documents
from curate.llm.personal_data import without_personal_data
from curate.llm.quality import kept_documents
from curate.llm.queries import VOCABULARY
from curate.llm.simhash import one_of_each
from curate.llm.stream_dedup import kept_rows
from curate.session import new_path, remove, scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; their thresholds come from the labels. NULL and empty texts have fewer
    words than the least, and go; repeated rows are judged alike; each row counts, also without `doc_id`."""
    return kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each text: that of the smallest `doc_id`, NULL last; of rows that share it, one."""
    return kept_rows(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of alike fingerprints, by `doc_id`, NULL last. Texts without a word, NULL or
    not, are alike."""
    return one_of_each(docs, distance=2, shingle=3, seed=42)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with the kind in place of each personal datum, and its length, if there is a column for it,
    brought up to date. A NULL text stays NULL; rows are cleaned one by one, whatever their ids."""
    cleaned = without_personal_data(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(kind))
    return cleaned.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens. A NULL text is empty, and every document, repeated or
    not, has at least the piece with its end."""
    return pack_documents(docs, VOCABULARY, capacity=1024, end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("best_fit_packing", packing),
]
# Encoding, fingerprints and forests are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`. What a stage has put aside goes with it, and its documents once the
    next one has written its own; the table of the last stage stays, as the result is read from it."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        with scratch(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        remove(spark, *before)
        before = [path]
    return docs
