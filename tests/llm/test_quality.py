"""Quality rules: counts against a plain version, and what the forests reject."""

import re
from collections import Counter

import numpy as np

from curate.llm.quality import COUNTS, grow, judge_documents, kept_documents, statistics
from tests.llm.conftest import HARD, sentence


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[at:at + 3]) for at in range(len(words) - 2))
    covered = {at + step for at in range(len(words) - 2) if windows[tuple(words[at:at + 3])] > 1 for step in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    doubled = sum(line in lines[:at] for at, line in enumerate(lines))
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), doubled, len(covered))


def plain_failed(counts):
    return counts[0] < 50 or 100 * counts[4] > 50 * counts[0]


TEXTS = ["a b c a b c", "a a a a", "a\nb\na\n a\n\n\na", "é 日本 | # <x>", "a b\x0bc\x1cd e", "x y z x y z x y"]


def test_statistics():
    for text in [text for _, text in HARD if len(text or "") < 50_000] + TEXTS:
        assert statistics(text)[:len(COUNTS)] == plain_counts(text), repr(text)[:60]


def test_hard_rows(spark, hard, nothing, labels):
    found = judge_documents(hard, labels).collect()
    short = [(doc_id, text) for doc_id, text in HARD]
    expected = Counter((doc_id, *(counts := plain_counts(text) if len(text or "") < 50_000 else statistics(text)[:5]),
                        plain_failed(counts)) for doc_id, text in short)
    assert Counter((row["doc_id"], *(row[name] for name in COUNTS), row["base_failed"]) for row in found) == expected
    assert not any(row["kept"] and row["base_failed"] for row in found)
    assert kept_documents(hard, labels).columns == hard.columns
    assert judge_documents(nothing, labels).count() == 0
    assert kept_documents(nothing, labels).count() == 0
    without = judge_documents(hard, labels.limit(0)).collect()
    assert all(row["kept"] != row["base_failed"] for row in without)


def test_oddness_of_an_outlier():
    rng = np.random.default_rng(2)
    rows = np.concatenate([rng.normal(0, 1, (1000, 2)), [[9.0, 9.0]]])
    scores = grow(rows).scores(rows)
    assert scores.argmax() == 1000
    assert 0 < scores.min() and scores.max() < 1
    assert len(grow(np.zeros((0, 2))).scores(np.ones((3, 2)))) == 3


def test_labels_set_the_thresholds(spark):
    """Documents full of symbols are odd and labelled bad; long numbers are odd and labelled good."""
    rows, marks = [], []
    for number in range(600):
        words = sentence(number, 120).split()
        if number % 10 == 3:
            words = [word + "%%$" for word in words]
        if number % 10 == 7:
            words = [word + "0123456789" if at % 3 else word for at, word in enumerate(words)]
        rows.append((number, " ".join(words)))
        if number % 2:
            marks.append((number, int(number % 10 != 3)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks + [(None, 1), (5, None), (marks[0])], "doc_id long, quality int")
    gone = {row["doc_id"] for row in judge_documents(docs, labels).where("not kept").collect()}
    assert gone == {number for number in range(600) if number % 10 == 3}
    kept = kept_documents(docs, labels).collect()
    assert sorted(row["doc_id"] for row in kept) == [number for number in range(600) if number not in gone]


def test_given_documents(spark):
    """On the labelled tables nearly all good documents stay, and nearly no bad one."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = judge_documents(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").collect()
    good = [row["kept"] for row in found if row["quality"] == 1 and not row["base_failed"]]
    bad = [row["kept"] for row in found if row["quality"] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.05
