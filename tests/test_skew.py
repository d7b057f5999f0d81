"""Hot keys and hot groups, against plain joins and windows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import digest_queries
from curate.operators import digest, skew
from curate.operators.lifecycle import first_by_url, insert_or_ignore
from curate.operators.rating import top_k_per_category


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def hot(spark, size=60_000):
    """A third of the rows share one key; some have none."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 7000).cast("string")))
    return spark.range(size).withColumn("key", key)


def lookup(spark):
    rows = [("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(0, 7000, 2)]
    return spark.createDataFrame(rows, "key string, value int")


def test_lookup_is_broadcast_only_while_it_fits(spark, no_broadcast, monkeypatch):
    left, right = hot(spark), lookup(spark)
    plain = left.join(right, "key", "left").select("id", "value", "key")
    small = skew.lookup_join(left, right, "key", "left", "id").select(plain.columns)
    assert "BroadcastHashJoin" in executed(small) and "SortMergeJoin" not in executed(small)
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 1000)
    large = skew.lookup_join(left, right, "key", "left", "id").select(plain.columns)
    assert "SortMergeJoin" in executed(large)
    assert small.exceptAll(plain).count() == large.exceptAll(plain).count() == 0
    assert small.count() == large.count() == plain.count()


def test_parts_grow_with_the_key(spark, no_broadcast, monkeypatch):
    """No part holds much more than PART_ROWS rows, for a key far above as for one just above."""
    monkeypatch.setattr(skew, "PART_ROWS", 1000)
    rows = spark.range(12_000).withColumn("key", F.when(F.col("id") < 1100, F.lit("k2")).otherwise(F.lit("hot")))
    joined = skew.skew_safe_join(rows, lookup(spark).where("value <> 2"), "key", "left", "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "500")
    try:
        tasks = joined.groupBy("key", F.spark_partition_id().alias("t")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert max(row["count"] for row in tasks) <= 1200
    assert sum(row["count"] for row in tasks) == 12_000
    assert len([row for row in tasks if row["key"] == "k2"]) == 2


def test_join_on_two_keys(spark, monkeypatch):
    monkeypatch.setattr(skew, "PART_ROWS", 100)
    left = hot(spark).withColumn("day", F.col("id") % 3)
    right = lookup(spark).select("key", F.lit(0).cast("bigint").alias("day"))
    found = skew.skew_safe_join(left, right, ["key", "day"], "left_semi", "id")
    assert found.count() == left.join(right, ["key", "day"], "left_semi").count() > 0


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_join_equals_a_plain_one(spark, no_broadcast, monkeypatch, how):
    monkeypatch.setattr(skew, "PART_ROWS", 5)  # many keys are hot
    left, right = hot(spark), lookup(spark)
    found = skew.skew_safe_join(left, right, "key", how, "id")
    plain = left.join(right, "key", how).select(found.columns)
    assert found.count() == plain.count()
    assert found.exceptAll(plain).count() == 0


def test_join_spreads_the_hot_key(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(skew, "PART_ROWS", 1500)
    joined = skew.skew_safe_join(hot(spark), lookup(spark), "key", "left_semi", "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = joined.where("key = 'hot'").select(F.spark_partition_id().alias("t")).groupBy("t").count()
        assert tasks.count() >= 6
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_numbers_equal_row_number(spark):
    df = hot(spark).withColumn("score", F.col("id") % 10)
    found = skew.number_within(df, ("key",), (F.desc("score"), F.asc("id")))
    window = Window.partitionBy("key").orderBy(F.desc("score"), "id")
    wanted = df.withColumn("position", F.row_number().over(window).cast("bigint"))
    assert found.count() == df.count()
    assert found.exceptAll(wanted).count() == 0


def test_numbering_spreads_the_hot_group(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = skew.number_within(hot(spark), ("key",), (F.asc("id"),)).where("key = 'hot'")
        parts = found.groupBy(F.spark_partition_id().alias("t")).agg(F.count("*").alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(parts) >= 2


def test_long_lists_go_on_in_further_pages(spark):
    articles = spark.range(2500).select(
        "id", F.lit("2024-01-01").cast("date").alias("fetch_date"), F.lit("A").alias("category"),
        (F.col("id") % 7).cast("double").alias("score"))
    whole = digest.digest_nested(articles).first().articles
    assert [(article.position, article.id) for article in whole] == [
        (place + 1, i) for place, i in enumerate(sorted(range(2500), key=lambda i: (-(i % 7), i)))]
    pages = digest.digest_nested(articles, 1000).orderBy("page").collect()
    assert [len(row.articles) for row in pages] == [1000, 1000, 500]
    listed = [(-article.score, article.id) for row in pages for article in row.articles]
    assert listed == sorted(listed) and len(listed) == 2500


def test_a_long_transcript_is_one_text(spark):
    segments = spark.range(12_000).select(F.lit("v").alias("video_id"), F.col("id").alias("seq"), F.col("id").cast("string").alias("text"))
    assert [tuple(row) for row in digest.transcript_text(segments).collect()] == [("v", " ".join(map(str, range(12_000))))]


def test_transcript_parts(spark):
    rows = [("v", i, f"s{i}") for i in range(25)] + [("w", 3, "b"), ("w", 1, "a")]
    df = spark.createDataFrame(rows, "video_id string, seq int, text string")
    assert {(row.video_id, row.part): row.text for row in digest.transcript_text(df, 20).collect()} == {
        ("v", 0): " ".join(f"s{i}" for i in range(20)), ("v", 1): " ".join(f"s{i}" for i in range(20, 25)), ("w", 0): "a b"}


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranking_cuts_before_the_shuffle(spark):
    articles = hot(spark).select(
        "id", F.to_date(F.timestamp_seconds("id")).alias("fetch_date"), F.col("key").alias("category"),
        F.col("id").cast("double").alias("score"), F.lit("rated").alias("status"))
    minimum = spark.createDataFrame([("A", 0.0)], "category string, min_score double")
    assert executed(top_k_per_category(articles, minimum)).count("WindowGroupLimit") == 2


def test_date_page_without_a_number_has_every_day(spark):
    rows = spark.sql("""
        SELECT id, date '2024-01-01' + CAST(id % 5 AS INT) AS fetch_date, 'A' AS category, 1.0D AS score,
          CASE WHEN id < 20 THEN 'complete' ELSE 'rated' END AS status, 'text' AS chinese_summary FROM range(25)""")
    wanted = {(i, 5 - i % 5) for i in range(20)}
    for found in (digest.date_page(rows), digest_queries.date_page(lambda name: rows)):
        assert {(row.id, row.page) for row in found.collect()} == wanted
    assert {row.id for row in digest.date_page(rows, 2).collect()} == {3, 8, 13, 18}


def test_dedupe_cuts_before_the_shuffle(spark):
    assert executed(first_by_url(hot(spark).withColumnRenamed("key", "url"))).count("WindowGroupLimit") == 2


def test_small_batch_leaves_the_store_unshuffled(spark, tmp_path):
    store = spark.range(1000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"))
    store.write.parquet(str(tmp_path / "store"))
    batch = spark.createDataFrame([(1, "u5"), (2, "new"), (3, "new")], "id bigint, url string")
    new = insert_or_ignore(batch, spark.read.parquet(str(tmp_path / "store")))
    assert [row.url for row in new.collect()] == ["new"]
    plan = executed(new)
    store_side = plan[plan.index("BroadcastHashJoin [url", plan.index("LeftAnti") + 1):].split("LocalTableScan")[0]
    assert "FileScan" in plan and "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in store_side.split("FileScan")[0]


def test_large_batch_gives_the_same(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 10)
    batch = hot(spark).where("key IS NOT NULL").withColumnRenamed("key", "url")
    store = spark.range(0, 7000, 2).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("url"))
    new = insert_or_ignore(batch, store)
    wanted = batch.join(store, "url", "left_anti").groupBy("url").agg(F.min("id").alias("id"))
    assert "SortMergeJoin" in executed(new)
    assert new.count() == wanted.count() == new.select("url", "id").intersect(wanted).count()
