"""Look-up of many keywords by hashes of windows, against plain search."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from curate.functions import keywords as K
from curate.operators import entries as E


def index(tmp_path, *blocks):
    files = []
    for number, words in enumerate(blocks):
        path = tmp_path / f"{number}.parquet"
        batches = list(K.index_keywords(iter([pa.RecordBatch.from_pydict({"word": pa.array(words, pa.binary())})])))
        pq.write_table(pa.Table.from_batches(batches), path)
        files.append(path.as_uri())
    return files


def texts_and_words(seed, n_words=60):
    picked = random.Random(seed)
    def text(most):
        return "".join(picked.choices(["a", "b", "é", "日", " "], k=picked.randrange(most))).encode()
    texts = [None if number % 9 == 4 else text(60) for number in range(80)]
    return texts, sorted({word for word in (text(40) for _ in range(n_words)) if len(word) > 3})


@pytest.mark.parametrize("kind", [pa.binary(), pa.large_binary()])
@pytest.mark.parametrize(("most", "at_once"), [(10, 1 << 18), (2, 7), (0, 1), (3, 64)])
def test_the_index_finds_what_plain_search_finds(tmp_path, monkeypatch, most, at_once, kind):
    monkeypatch.setattr(K, "MOST", most)
    monkeypatch.setattr(K, "AT_ONCE", at_once)
    for seed in range(10):
        texts, words = texts_and_words(seed)
        # Parts of texts, and beginnings that words share.
        words = sorted({*words, *(text[-9:] for text in texts[::20] if text), *(word[:-1] for word in words[::5])} - {b""})
        wanted = [text is not None and any(word in text for word in words) for text in texts]
        mentions = K.searcher(index(tmp_path, words[::2], words[1::2]))
        assert mentions(pa.array(texts, kind)).to_pylist() == wanted
        assert mentions(pa.array(texts, kind).slice(7, 50)).to_pylist() == wanted[7:57]
        assert 0 < sum(wanted) < len(texts)
        assert K.searcher([K.index_list(["é日", "ab a", "b" * 9])])(pa.array(texts, kind)).to_pylist() == [
            text is not None and any(word.encode() in text for word in ("é日", "ab a", "b" * 9)) for text in texts]
    assert mentions(pa.array([], kind)).to_pylist() == [] and mentions(pa.array([None, b""], kind)).to_pylist() == [False, False]


def test_hashes_that_several_words_share_are_told_apart_by_bytes(tmp_path, monkeypatch):
    monkeypatch.setattr(K, "together", lambda first, last, length: np.zeros(len(first), np.uint64))
    texts, words = texts_and_words(3, 12)
    wanted = [text is not None and any(word in text for word in words) for text in texts]
    assert K.searcher(index(tmp_path, words))(pa.array(texts, pa.binary())).to_pylist() == wanted


def test_keywords_of_a_table_stay_out_of_the_plan(spark, monkeypatch):
    """The work per article, and what the driver holds, must not grow with the keywords."""
    table = spark.range(5000).select(F.format_string("Keyword number %d.", "id").alias("keyword"))
    df = spark.createDataFrame([(1, "has KEYWORD NUMBER 4999."), (2, "keyword number 5000."), (2, "keyword number 17.")], "id int, content string")
    found = E.keyword_filter(df, table)
    assert "number 17" not in found._jdf.queryExecution().toString() and "exists(" not in found._jdf.queryExecution().toString()
    assert sorted(row.id for row in found.collect()) == [1, 2]
    monkeypatch.setattr(E, "BLOCK_CHARS", 20_000)
    again = E.keyword_filter(df, table)
    assert sorted(row.id for row in again.collect()) == [1, 2]
