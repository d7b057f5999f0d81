"""Ranked lexical search against a plain ranking of all documents, and its SQL."""

import math
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from curate.llm import lexical
from curate.llm.lexical import Best, Postings, accumulate, norms, search, terms_of
from curate.llm.queries import ORACLES, QUERIES
from tests.compare import connect, rows

SF_DIR = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return [re.sub("[A-Z]", lambda letter: letter[0].lower(), term) for term in TERM.findall(text or "")]


def plain_search(docs, items, k=10):
    texts = [(doc_id, terms) for doc_id, text in docs if (terms := plain_terms(text))]
    n_docs, words = len(texts), sum(len(terms) for _, terms in texts)
    df = {}
    for _, terms in texts:
        for term in set(terms):
            df[term] = df.get(term, 0) + 1
    out = []
    for item_id, text in items:
        found = []
        for doc_id, terms in texts:
            m = 100 - 75 + (75 * len(terms) * n_docs) // words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                * ((1000000000 * terms.count(term)) // (1000 * terms.count(term) + 8 * m))
                for term in plain_terms(text) if term in terms
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, unknown, doc_id) in enumerate(sorted(found)[:k], 1):
            out.append((item_id, rank, None if unknown else doc_id, -score))
    return sorted(out, key=repr)


def found(df):
    assert df.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted((tuple(row) for row in df.collect()), key=repr)


@given(st.text(max_size=60))
def test_terms(text):
    assert [term.decode() for term in terms_of(text)] == plain_terms(text)


def test_terms_of_nothing():
    assert terms_of(None) == [] and terms_of(" \n.,;") == []


def test_query_equals_sql(spark):
    wanted = connect(SF_DIR).execute(ORACLES["op11_term_at_a_time"])
    names = [column[0] for column in wanted.description]
    got = QUERIES["op11_term_at_a_time"](spark, SF_DIR)
    assert rows(got.columns, [tuple(row) for row in got.collect()]) == rows(names, wanted.fetchall())


DOCS = [
    (1, "The cat sat. THE CAT!"), (2, "the dog"), (3, "Éa éa ÉA été 日本 x9"), (4, None), (5, ""), (6, " ... "),
    (7, "cat " * 5000), (8, "the cat sat. the cat!"), (8, "the cat sat. the cat!"), (None, "the cat sat. the cat!"),
    (9, "bird"), (10, "bird"), (11, "bird bird the"), (12, "x9 cat dog bird the the the"),
]
ITEMS = [
    (1, "the cat"), (2, "bird bird"), (2, "dog"), (3, None), (4, "nowhere"), (5, "Éa x9 日本"), (None, "the"),
    (6, "cat cat cat dog the bird x9"), (7, " "),
]


@pytest.mark.parametrize("k", [1, 2, 10])
@pytest.mark.parametrize("block", [1, 3, 1 << 14])
def test_hard_rows(spark, monkeypatch, k, block):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = docs.selectExpr("*", "'c' AS score", "'c' AS rank", "'c' AS item", "'c' AS item_id")
    items = items.selectExpr("*", "'c' AS doc_id", "'c' AS score")
    assert found(search(docs, items, k)) == plain_search(DOCS, ITEMS, k)


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEM_BYTES", 100)
    docs = spark.createDataFrame(DOCS, "doc_id int, text string")
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert found(search(docs, items)) == plain_search(DOCS, ITEMS)


def test_nothing(spark, hard, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert found(search(nothing, items)) == [] == found(search(hard, items.limit(0)))
    assert found(search(hard.where("doc_id = 2"), items)) == []


def test_shared_hard_rows(spark, hard):
    items = [(1, "one two"), (2, "the word fox12 ann"), (3, "日本語 0")]
    wanted = plain_search([(row["doc_id"], row["text"]) for row in hard.select("doc_id", "text").collect()], items)
    assert found(search(hard, spark.createDataFrame(items, "item_id long, text string"))) == wanted


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 4), st.integers(0, 2))
def test_accumulators_lose_no_rank(seed, k, skew):
    """Limited accumulators give the k best that all accumulators give, block after block."""
    rng = np.random.default_rng(seed)
    n, n_words = int(rng.integers(1, 60)), 12
    chances = 1 / np.arange(1, n_words + 1) ** skew
    found_words = [rng.choice(n_words, int(rng.integers(1, 12)), p=chances / chances.sum()) for _ in range(n)]
    lengths = [len(words) + int(rng.integers(0, 5)) for words in found_words]
    query = [(int(word), int(rng.integers(0, 3000))) for word in rng.permutation(n_words)[:6]]
    ids = rng.permutation(n).tolist()
    best, want = Best(k), []
    for first in range(0, n, 17):
        part = slice(first, first + 17)
        postings = Postings(found_words[part], lengths[part], n_words, n, sum(lengths))
        docs, scores = accumulate(postings, query, k, best.reached(), len(found_words[part]))
        best.add(ids[part], docs, scores)
        every = np.zeros(len(found_words[part]), np.int64)
        for word, share in query:
            places, worth = postings.of(word)
            every[places] += share * worth
        want += [(-int(score), False, doc) for score, doc in zip(every, ids[part]) if score > 0]
    assert best.rows == sorted(want)[:k]


def test_norms_beyond_64_bits():
    lengths = np.array([1, 10**9], np.int64)
    assert norms(lengths, 10**9, 10**12).tolist() == [25, 25 + 75 * 10**6]
