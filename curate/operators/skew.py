"""Joins and numbering that keep hot keys and hot groups apart."""

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curate.session import shared_dir, written

# How many rows of a key a join leaves in one part.
PART_ROWS = 1_000_000
# Over how many parts a large group is ranked before it is ranked as a whole.
SALTS = 64
# How large a table may be that is sent to every executor. Whatever the size, the rows are the same.
BROADCAST_BYTES = 64 * 1024 * 1024


def fits(df: DataFrame) -> bool:
    """Whether `df` is small enough to broadcast, by its measured size. JSON leaves NULLs out, which take
    room in memory all the same: every column counts for eight bytes more."""
    row = F.octet_length(F.to_json(F.struct(*df.columns))) + 8 * len(df.columns)
    return (df.agg(F.sum(row)).first()[0] or 0) <= BROADCAST_BYTES


def sendable(df: DataFrame) -> DataFrame:
    """`df`, marked for broadcast if it fits. For joins whose keys are unique on both sides."""
    return F.broadcast(df) if fits(df) else df


def lookup_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str, spread: str) -> DataFrame:
    """Join `left` with a table that is small as a rule: broadcast while it is, dealt out beyond.

    Left to itself Spark often cannot tell that such a table is small, shuffles `left` by a key
    like the category, and brings a hot one into a single task.
    """
    if fits(right):
        return left.join(F.broadcast(right), on, how)
    return skew_safe_join(left, right, on, how, spread)


def skew_safe_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str, spread: str) -> DataFrame:
    """Join `left` with the lookup table `right`, which holds few rows per key.

    A key with more than PART_ROWS rows in `left` has them dealt out over as many parts as it takes to have no
    more than that in one, by their `spread` column, and its few rows in `right` are copied to each part. There
    is at most one hot key for PART_ROWS rows; their list is broadcast if it fits. `left` is counted in
    one pass over its keys.
    """
    keys = [on] if isinstance(on, str) else list(on)
    missing = reduce(or_, [F.col(key).isNull() for key in keys])
    counts = left.where(~missing).groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > PART_ROWS)
    hot = sendable(written(
        counts.select(*keys, F.ceil(F.col("_rows") / PART_ROWS).cast("bigint").alias("_parts")), "hot-keys"
    ))
    dealer = F.xxhash64(F.col(spread))
    dealt = left.join(hot, keys, "left").withColumn(
        "_salt", F.when(missing, dealer).when(F.col("_parts").isNull(), F.lit(0)).otherwise(F.pmod(dealer, "_parts"))
    ).drop("_parts")
    every, first = F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1), F.array(F.lit(0).cast("bigint"))
    copied = right.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_parts").isNull(), first).otherwise(every))
    ).drop("_parts")
    return dealt.join(copied, [*keys, "_salt"], how).drop("_salt")


def number_within(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                  name: str = "position") -> DataFrame:
    """Number the rows of each group from 1 in the given order, however large a group is.

    A window would bring each group into one task. Here the rows are range-sorted, so a large
    group spans many tasks; each task's count of earlier rows is added to its own numbering.
    The sorted rows are checkpointed, since both passes must see the same ranges.
    """
    shared_dir(df.sparkSession)
    ordered = df.orderBy(*[F.col(key) for key in group], *order)
    fixed = ordered.withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    fixed = fixed.withColumn("_task", F.shiftright("_row", 33))
    runs = fixed.groupBy(*group, "_task").agg(
        F.count("*").alias("_rows"), F.min("_row").alias("_first")
    )
    earlier = Window.partitionBy(*group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        *[F.col(key).alias(f"_{key}") for key in group],
        F.col("_task").alias("_start_task"),
        "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
    )
    same = F.col("_task") == F.col("_start_task")
    for key in group:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    numbered = fixed.join(starts, same)
    position = F.col("_before") + F.col("_row") - F.col("_first") + 1
    return numbered.select(*df.columns, position.alias(name))
