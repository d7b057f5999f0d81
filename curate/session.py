"""The shared folder that staged tables and checkpoints live in."""

import re
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
# What the scopes now open have put into the shared folder, innermost last.
_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a session within one process may go without the setting; it then gets a folder beside its
    warehouse.
    """
    folder = spark.conf.get(SETTING, None)
    context = spark.sparkContext
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder
    chosen = context.getCheckpointDir()
    if chosen:
        return chosen
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError(f"{SETTING} must name a folder shared by the whole cluster")
    folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/curate-shared"
    context.setCheckpointDir(folder)
    return folder


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings that hold inside; a streaming query keeps those it was started with."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    path = f"{shared_dir(spark).rstrip('/')}/curate/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession):
    """Deletes on leaving what was put into the shared folder inside. Results that are computed late must have been
    written elsewhere by then."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        remove(spark, *paths)


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table in the shared folder, which lasts as long as the `scratch` around it."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders that `new_path` has named, on whatever store they are."""
    top = f"{shared_dir(spark).rstrip('/')}/curate/"
    for path in paths:
        if not path.startswith(top):
            raise ValueError(f"not a path of the shared folder: {path}")
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
