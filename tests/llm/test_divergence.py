"""Differences between sources against a plain count, and the SQL."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from curate.llm import divergence as module
from curate.llm.divergence import LETTERS, buffer_of, divergence, share, shard_runs, sort_pointers, word_pointers
from curate.llm.queries import ORACLES, QUERIES
from tests.compare import connect, rows

SF_DIR = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
TEXTS = st.lists(st.text(st.sampled_from("abAB é日.3 \n") | st.characters(exclude_categories=["Cs"]), max_size=40), max_size=6)


def plain_terms(text):
    return [re.sub("[A-Z]", lambda letter: letter[0].lower(), term) for term in TERM.findall(text or "")]


def plain(docs, least, ranks):
    df, counts, groups = Counter(), Counter(), set()
    for text, lang, source in docs:
        lang, source, terms = lang or "", source or "", plain_terms(text)
        groups.add((lang, source))
        df.update((lang, term) for term in set(terms))
        counts.update((lang, source, term) for term in terms)
    out = []
    for lang in {lang for lang, _ in groups}:
        kept = [term for (of, term), n in df.items() if of == lang and n >= least]
        sources = [source for of, source in groups if of == lang]
        total = {source: sum(counts[lang, source, term] for term in kept) for source in sources}

        def part(n, whole):
            return 1 + (1000000000 * (n + 5)) // (whole + 5 * len(kept))

        p = {source: [part(counts[lang, source, term], total[source]) for term in kept] for source in sources}
        q = [part(sum(counts[lang, source, term] for source in sources), sum(total.values())) for term in kept]
        for source in sources:
            pairs = [(-sum(abs(a - b) for a, b in zip(p[source], p[other])), other) for other in sources if other != source]
            terms = [(b - a, term) for a, b, term in zip(p[source], q, kept) if counts[lang, source, term] and a > b]
            for name, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda row: (row[0], row[1].encode()))
                out += [
                    (lang, source, name, item, -value, rank) for rank, (value, item) in enumerate(found, 1)
                    if name == "pair" or rank <= ranks
                ]
    return sorted(out)


def found(df):
    assert df.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"),
                         ("value", "bigint"), ("rank", "int")]
    return sorted(tuple(row) for row in df.collect())


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_pointers_are_sorted_by_word(texts):
    data, offsets = buffer_of(pa.array(texts, pa.string()))
    letters = LETTERS[data]
    starts, sizes = word_pointers(letters, offsets)
    words = [bytes(letters[at:at + size]).decode() for at, size in zip(starts, sizes)]
    assert words == [term for text in texts for term in plain_terms(text)]
    if words:
        order, run = sort_pointers(letters, starts, sizes)
        assert sorted(order.tolist()) == list(range(len(words)))
        ordered = [words[place].encode() for place in order]
        assert ordered == sorted(ordered)
        assert [number for number in run] == np.cumsum([0] + [a != b for a, b in zip(ordered, ordered[1:])]).tolist()


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_runs_of_a_shard(texts):
    langs, sources = [str(len(text) % 2) for text in texts], [str(len(text) % 3) for text in texts]
    batch = shard_runs([pa.array(texts[:2], pa.string()), pa.array(texts[2:], pa.string())], langs, sources) if texts else None
    docs, counts = Counter(), Counter()
    for text, lang, source in zip(texts, langs, sources):
        docs.update((lang, term) for term in set(plain_terms(text)))
        counts.update((lang, term, source) for term in plain_terms(text))
    got = batch.to_pylist() if batch else []
    assert {(row["lang"], row["term"]): row["docs"] for row in got} == dict(docs)
    assert {(row["lang"], row["term"], cell["source"]): cell["n"] for row in got for cell in row["sources"]} == dict(counts)


def test_query_equals_sql(spark):
    wanted = connect(SF_DIR).execute(ORACLES["op13_pointer_sort"])
    names = [column[0] for column in wanted.description]
    got = QUERIES["op13_pointer_sort"](spark, SF_DIR)
    assert rows(got.columns, [tuple(row) for row in got.collect()]) == rows(names, wanted.fetchall())


DOCS = [
    ("The cat sat on the mat", "en", "a"), ("the cat", "en", "b"), ("The dog, the CAT", "en", "b"), (None, "en", "c"),
    ("", "en", None), ("le chat " * 3000, "fr", "a"), ("le chien été", "fr", "b"), (" 12 34 ", "de", "a"), (None, None, None),
    ("the the cat", "en", "a"), ("the the cat", "en", "a"), ("x" * 5000, "en", "d"), ("日本 le", "fr", "b"), ("solo", "es", "z"),
]


def test_hard_rows(spark, monkeypatch):
    docs = spark.createDataFrame(DOCS, "text string, lang string, source string").repartition(3)
    docs = docs.selectExpr("*", *[f"'c' AS {name}" for name in ("term", "n", "number", "item", "value", "rank", "docs", "total")])
    for least, ranks in ((1, 2), (2, 50), (100, 50)):
        assert found(divergence(docs, least, ranks)) == plain(DOCS, least, ranks)
    # Small shards, slices and tiles: the same rows.
    monkeypatch.setattr(module, "SHARD_BYTES", 16)
    monkeypatch.setattr(module, "CELLS", 4)
    monkeypatch.setattr(module, "TILE", 2)
    assert found(divergence(docs, 1, 50)) == plain(DOCS, 1, 50)


def test_nothing(nothing):
    empty = nothing.selectExpr("text", "'en' AS lang", "'a' AS source")
    assert found(divergence(empty)) == []


def test_shares_of_large_numbers(spark):
    from pyspark.sql import functions as F

    cases = [(n, total) for n in (0, 7, 10**13) for total in (n + 5, 3 * n + 11, 10**14 + 7)]
    got = spark.createDataFrame(cases, "n long, total long").select(share(F.col("n"), F.col("total"))).collect()
    assert [row[0] for row in got] == [1 + 10**9 * (n + 5) // total for n, total in cases]
    assert module._shares(np.array([10**13]), np.array([10**14 + 7])).tolist() == [1 + 10**9 * (10**13 + 5) // (10**14 + 7)]
