"""Toxicity: held-out accuracy, the folds, and the risk estimate."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from curate.llm.toxicity import BEGINNINGS, WIDTH, places, risk_slopes, score_documents, telling, train
from tests.llm.conftest import HARD

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def scores(docs, labels):
    return {row["doc_id"]: row for row in score_documents(docs, labels).collect()}


def test_held_out_accuracy_and_no_look_at_held_out_labels(tables):
    docs, labels = tables
    found = scores(docs, labels)
    assert all(row["held_out"] == (zlib.crc32(str(doc_id).encode()) % 3 == 1) for doc_id, row in found.items())
    assert all(row["predicted"] == (row["score"] >= 0.7) for row in found.values())
    held = [(row["toxic"], found[row["doc_id"]]["predicted"]) for row in labels.collect()
            if found[row["doc_id"]]["held_out"]]
    hits = sum(toxic and predicted for toxic, predicted in held)
    assert hits >= 0.6 * sum(toxic for toxic, _ in held)
    assert hits >= 0.9 * sum(predicted for _, predicted in held)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    turned = labels.withColumn("toxic", F.when(held_out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    others = docs.withColumns({"lang": F.lit("x"), "source": F.lit("y")})
    assert {key: row["score"] for key, row in scores(others, turned).items()} == {
        key: row["score"] for key, row in found.items()
    }


def test_hard_rows(spark, hard, nothing, tables):
    _, labels = tables
    found = score_documents(hard, labels).collect()
    assert len(found) == len(HARD)
    assert all(0 <= row["score"] <= 1 and row["held_out"] is not None for row in found)
    no_label = labels.withColumn("toxic", F.lit(None).cast("int"))
    assert {row["score"] for row in score_documents(hard, no_label).collect()} == {0.0}
    assert score_documents(nothing, labels).count() == 0


def test_unlabelled_positives_do_not_mislead():
    """A third of the unlabelled rows are positives; the model still calls those without the feature clean."""
    rng = np.random.default_rng(1)
    positive = [np.array([0, *rng.integers(1, 5, 1)]) for _ in range(300)]
    unlabelled = [np.array([0, *rng.integers(1, 5, 1)][number % 3 > 0:]) for number in range(3000)]
    weights, bias = train(positive, unlabelled, 5, 1 / 3)
    assert bias + weights[0] > 0.5
    assert bias + weights[1:].max() < -0.5


def test_the_rest_of_the_risk_is_kept_from_going_negative():
    """With a prior far too high the corrected risk would call everything positive at any price."""
    positive = [np.array([0])] * 50
    unlabelled = [np.array([1])] * 500
    weights, bias = train(positive, unlabelled, 2, 0.9)
    assert np.isfinite(weights).all() and bias + weights[0] > bias + weights[1]
    called = np.logaddexp(0, bias + weights[1]) - 0.9 * np.logaddexp(0, bias + weights[0])
    assert called > -0.2


def test_every_surprising_feature_is_used():
    n_positive = np.full(5_000, 40)
    assert telling(n_positive + 1, n_positive, 100_000, 1_000).tolist() == list(range(5_000))


def test_toxic_documents_of_a_rare_kind(spark):
    """Eight toxic documents in a language of their own among 5,400 others: less than 0.2 % of the positives."""
    rare = F.col("doc_id") >= 50_000
    learnt = [doc_id for doc_id in range(50_000, 50_100) if zlib.crc32(str(doc_id).encode()) % 3 != 1][:6]
    kept = [doc_id for doc_id in range(50_000, 50_100) if zlib.crc32(str(doc_id).encode()) % 3 == 1][:2]
    docs = spark.range(45_400).withColumnRenamed("id", "doc_id").union(
        spark.createDataFrame([(doc_id,) for doc_id in learnt + kept], "doc_id long")
    ).withColumn("text", F.when(rare, F.lit("grobul snarvek")).when(F.col("doc_id") < 5_400, F.lit("nasty words"))
                 .otherwise(F.lit("plain words")))
    labels = docs.where((F.col("doc_id") < 9_000) | rare).select(
        "doc_id", ((F.col("doc_id") < 5_400) | rare).cast("int").alias("toxic")
    )
    found = scores(docs, labels)
    assert [found[doc_id]["held_out"] for doc_id in kept] == [True, True]
    assert [found[doc_id]["predicted"] for doc_id in kept] == [1, 1]
    assert [found[doc_id]["predicted"] for doc_id in (0, 20_000)] == [1, 0]


def plain_places(text):
    """One feature after the other, with whole numbers."""
    whole = (1 << 64) - 1

    def mix(n):
        for _ in range(2):
            n = ((n ^ n >> 32) * 0xD6E8FEB86659FD93) & whole
        return n ^ n >> 32

    def place(n, times):
        return mix((n >> 24) + (times << 40)) % WIDTH

    def number(part):
        return int.from_bytes(part.ljust(8, b"\0"), "big")

    words = set(re.findall(rb"[a-z\x80-\xff]+", (text or "").lower().encode()))
    found, starts = set(), Counter()
    for word in words:
        n = mix(number(word[:8]))
        for at in range(8, len(word), 8):
            n = mix((n * 3 + number(word[at:at + 8])) & whole)
        found.add(place(n, 1))
        starts.update((word[:length], length) for length in BEGINNINGS if len(word) > length)
    for (start, length), times in starts.items():
        found |= {place(mix((number(start) + length) & whole), 1 + least) for least in range(1, min(times, 3) + 1)}
    return sorted(found)


def test_features_of_texts():
    texts = ["Redword redwing redwoods blue blueish x9 RED", None, "", "abcdefg abcdeg abcdeh abcdei", "Été é日本語の文章 " * 9, "a" * 5000,
             "it's 12 no_w Word word " + " ".join(f"longer{n}word longer{'x' * n}" for n in range(40))]
    doc, place = places(texts)
    for number, text in enumerate(texts):
        assert place[doc == number].tolist() == plain_places(text)
    assert places([])[0].tolist() == [] == places([None, ""])[1].tolist()


@pytest.mark.parametrize("prior, bias", [(0.2, 0.3), (0.9, -2.0)])
def test_slopes_are_those_of_the_risk_over_all_rows(spark, prior, bias):
    """Against differences of the risk itself, written down row by row; the second case has a negative rest."""
    rng = np.random.default_rng(4)
    rows = [(number, sorted(set(rng.integers(0, 6, 3).tolist())) if number % 5 else [], None) for number in range(90)]
    rows = [(number, places, 1 if 0 in places else [0, None][number % 2]) for number, places, _ in rows]
    weights = rng.normal(size=6)
    weights[0] = 6.0 if prior == 0.9 else weights[0]

    def risk(weights, bias):
        raw = np.array([bias + sum(weights[place] for place in places) for _, places, _ in rows])
        positive = np.array([toxic == 1 for _, _, toxic in rows])
        rest = np.logaddexp(0, raw).mean() - prior * np.logaddexp(0, raw[positive]).mean()
        return (rest + prior * np.logaddexp(0, -raw[positive]).mean() if rest >= 0 else -rest), rest

    found = spark.createDataFrame(rows, "doc_id long, found array<int>, toxic int").repartition(4)
    slope, slope_of_bias, rest = risk_slopes(found, weights, bias, prior)
    assert rest == pytest.approx(risk(weights, bias)[1]) and (rest < 0) == (prior == 0.9)
    step = 1e-6
    want = [(risk(weights + step * one, bias)[0] - risk(weights - step * one, bias)[0]) / (2 * step) for one in np.eye(6)]
    assert slope == pytest.approx(want, abs=1e-6)
    assert slope_of_bias == pytest.approx((risk(weights, bias + step)[0] - risk(weights, bias - step)[0]) / (2 * step), abs=1e-6)


def test_recall_in_every_language(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    found = scores(docs.repartition(8), labels)
    langs = {row["doc_id"]: row["lang"] for row in docs.select("doc_id", "lang").collect()}
    held = [(langs[row["doc_id"]], row["toxic"], found[row["doc_id"]]["predicted"]) for row in labels.collect()
            if found[row["doc_id"]]["held_out"]]
    hits = {lang: sum(toxic and predicted for of, toxic, predicted in held if of == lang) for lang in set(langs.values())}
    toxic = {lang: sum(toxic for of, toxic, _ in held if of == lang) for lang in hits}
    print(hits, toxic, sum(predicted for _, _, predicted in held))
    assert sum(hits.values()) >= 0.9 * sum(toxic.values())
    assert all(hits[lang] >= 0.8 * toxic[lang] for lang in hits)
    assert sum(hits.values()) >= 0.95 * sum(predicted for _, _, predicted in held)
