"""Repeated passages against a table of all windows, and suffixes against a plain sort."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from curate.llm import suffixes
from curate.llm.queries import QUERIES
from curate.llm.suffixes import (
    WINDOW, common_prefixes, later_windows, pieces_of, two_stage_sort, without_repeats,
)

SF_DIR = "/root/testdata/sf0.001"
SMALL = st.lists(st.integers(1, 3), max_size=60)


def plain(docs):
    """Rows of `doc_id`, bytes, spans and rest, by a set of all windows seen."""
    out, seen = [], set()
    rows = [((doc_id is not None, doc_id or 0), doc_id, (text or "").encode()) for doc_id, text in docs]
    for _, doc_id, data in sorted(rows, key=lambda row: (row[0], row[2])):
        gone = bytearray(len(data))
        for at in range(len(data) - WINDOW + 1):
            window = data[at:at + WINDOW]
            if window in seen:
                gone[at:at + WINDOW] = b"\1" * WINDOW
            seen.add(window)
        spans, at = [], 0
        while (start := gone.find(1, at)) >= 0:
            at = gone.find(0, start)
            at = len(data) if at < 0 else at
            spans.append((start, at))
        out.append((doc_id, len(data), spans, bytes(byte for byte, mark in zip(data, gone) if not mark)))
    return out


def found(df):
    return [
        (row["doc_id"], row["n_bytes"], [tuple(span) for span in row["spans"]], bytes(row["kept"])) for row in df.collect()
    ]


def in_order(rows):
    return sorted(rows, key=repr)


@settings(max_examples=300, deadline=None)
@given(SMALL, st.sampled_from([1, 2, 8, 16]))
def test_suffixes_are_sorted(letters, twice):
    text = np.array(letters * twice + [0], np.uint8)
    whole = bytes(text)
    order = two_stage_sort(text, len(text))
    assert order.tolist() == sorted(range(len(text)), key=lambda at: whole[at:])
    shared = common_prefixes(text, order, 20)
    for place in range(1, len(order)):
        a, b = whole[order[place - 1]:], whole[order[place]:]
        n = next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[place] == min(n, 20) or min(len(a), len(b)) < 20


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=30), min_size=1, max_size=6), st.integers(2, 9))
def test_later_windows(texts, window):
    piece, place = later_windows([text.encode() for text in texts], window)
    want, seen = [], set()
    for number, text in enumerate(texts):
        for at in range(len(text) - window + 1):
            if text[at:at + window] in seen:
                want.append((number, at))
            seen.add(text[at:at + window])
    assert list(zip(piece.tolist(), place.tolist())) == want


def sentence(rng, n, letters="abcdefgh      é"):
    return "".join(rng.choice(letters) for _ in range(n))


def test_every_window_is_in_one_piece(monkeypatch):
    monkeypatch.setattr(suffixes, "SLICE", 300)
    rng = random.Random(3)
    texts = [sentence(rng, n).encode() for n in (0, 99, 700, 100, 5, 1000, 90)]
    texts += [texts[2] + texts[5], b"a" * 500]
    data, lengths = b"".join(texts), np.array([len(text) for text in texts])
    wanted, start = [], 0
    for text in texts:
        wanted += range(start, start + max(0, len(text) - WINDOW + 1))
        start += len(text)
    for hot in ((), pieces_of(data, lengths, np.empty(0, np.int64))[2][:5]):
        first, last, key = pieces_of(data, lengths, np.sort(np.array(hot, np.int64)))
        assert [at for a, b in zip(first.tolist(), last.tolist()) for at in range(a, b + 1)] == wanted
        anchors = {}
        for a, b, anchor in zip(first.tolist(), last.tolist(), key.tolist()):
            for at in range(a, b + 1):
                assert anchors.setdefault(data[at:at + WINDOW], anchor) == anchor


def documents_of(seed, n):
    """Texts with copies, shared passages, lines quoted everywhere, and repeats inside a text."""
    rng = random.Random(seed)
    passages = [sentence(rng, size) for size in (99, 100, 101, 250, 600, 48)]
    rows = []
    for number in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts.append(sentence(rng, rng.randint(0, 200)))
            parts.append(rng.choice(passages))
        text = "".join(parts)
        if rows and rng.random() < 0.3:
            text = rng.choice(rows)[1] or ""
            if rng.random() < 0.5 and text:
                at = rng.randrange(len(text))
                text = text[:at] + "#" + text[at + 1:]
        rows.append((rng.randrange(-5, 3 * n) * 10 + number % 10, text))
    ids = list({doc_id: None for doc_id, _ in rows})
    rows = [(doc_id, text) for doc_id, text in dict(rows).items()]
    assert len(ids) == len(rows)
    return rows


@pytest.mark.parametrize("hot", [0, 1, 50_000])
def test_equals_all_windows(spark, monkeypatch, hot):
    # Small chunks, slices and sorters; `hot` of 0 spreads every anchor the sample meets.
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(suffixes, "SORTER_BYTES", 2000)
    monkeypatch.setattr(suffixes, "SLICE", 1000)
    monkeypatch.setattr(suffixes, "DOCS_SHARE", 2)
    monkeypatch.setattr(suffixes, "PIECES_SHARE", 1)
    rows = documents_of(5, 120)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert in_order(found(without_repeats(docs, hot))) == in_order(plain(rows))


HARD = [
    (1, None), (2, ""), (3, "x" * 99), (4, "x" * 100), (5, "x" * 101), (6, "y" * 3000), (None, "x" * 150), (None, None),
    (7, "日本語 😀 é " * 40), (8, "本語 😀 é 日" * 40), (9, "ab" * 80_000), (10, "0" * 99 + "1" + "0" * 99), (11, "0" * 99 + "1"),
    (-1, "z" * 120), (12, "z" * 120),
]


def test_hard_rows(spark):
    docs = spark.createDataFrame(HARD, "doc_id long, text string").repartition(3)
    docs = docs.selectExpr("*", *[f"'c' AS {name}" for name in ("chunk", "at", "key", "kept", "spans", "bytes", "n_bytes")])
    assert in_order(found(without_repeats(docs))) == in_order(plain(HARD))
    ints = docs.where("doc_id IS NOT NULL").selectExpr("int(doc_id) AS doc_id", "text")
    assert {row[0] for row in found(without_repeats(ints))} == {row[0] for row in HARD if row[0] is not None}


def test_rows_that_share_an_id_follow_each_other(spark):
    rows = [(1, "b" * 200), (1, "a" * 200), (1, "a" * 200), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert in_order(found(without_repeats(docs))) == in_order(plain(rows))


def test_nothing(nothing):
    df = without_repeats(nothing)
    assert df.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("spans", "array<struct<start:bigint,end:bigint>>"),
                         ("kept", "binary")]
    assert found(df) == []


def test_query_over_given_documents(spark, documents):
    rows = [tuple(row) for row in documents.select("doc_id", "text").collect()]
    wanted = sorted(
        (doc_id, size, size - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
        for doc_id, size, spans, kept in plain(rows)
    )
    got = QUERIES["op12_two_stage_suffixes"](spark, SF_DIR)
    assert got.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"),
                          ("kept_sha256", "string")]
    assert sorted(tuple(row) for row in got.collect()) == wanted
    assert any(row[2] for row in wanted)
