"""Ranked lexical search, a term at a time, with a limit on accumulators.

Every task turns its documents, block by block, into postings of the terms that items ask for. An
item's terms are taken rarest first. Each posting opens an accumulator, until what the terms still
to come can add at most is less than the k-th best partial score: from there on no new
document can enter, and the remaining terms only update the accumulators that are open, exactly. The
k-th score of the blocks before counts, too. A task hands on the k best documents of each item that it
has seen, and these are ranked over all tasks.

Statistics cover all documents. Items are a stated query set: they are read in blocks of a bounded size,
and each block is searched for in all documents.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the score: what a term's frequency and a document's length weigh.
SCALE, TF_SCALE, NORM, SHARE = 1_000_000_000, 1000, 8, 75
RANKS = 10
# Text of items that is searched for at once, and text of documents that is indexed at once.
ITEM_BYTES, BLOCK_BYTES, BLOCK_DOCS = 1 << 21, 1 << 23, 1 << 14
# Letters of a term, A-Z made small; every other byte is a blank.
TERM_BYTES = bytes(
    byte + 32 if ord("A") <= byte <= ord("Z")
    else byte if byte >= 128 or chr(byte).isalnum() else ord(" ")
    for byte in range(256)
)
RESULT = "item_id long, rank int, doc_id long, score long"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, repeats included."""
    return (text or "").encode().translate(TERM_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def norms(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a document's length costs it; in Python's numbers where 64 bits could run over."""
    if len(lengths) and SHARE * int(lengths.max()) * n_docs >= 2**63:
        return np.array([100 - SHARE + SHARE * int(n) * n_docs // n_terms for n in lengths], np.int64)
    return 100 - SHARE + SHARE * lengths * n_docs // n_terms


class Postings:
    """The postings of a block of documents, by term, with what each adds per unit of weight."""

    def __init__(self, found: list[np.ndarray], lengths: list[int], n_words: int, n_docs: int, n_terms: int):
        docs = np.repeat(np.arange(len(found)), [len(ids) for ids in found])
        words = np.concatenate(found) if found else np.empty(0, np.int64)
        keys, tf = np.unique(words * max(len(found), 1) + docs, return_counts=True)
        self.docs = keys % max(len(found), 1)
        norm = norms(np.array(lengths, np.int64), n_docs, n_terms)
        self.worth = SCALE * tf // (TF_SCALE * tf + NORM * norm[self.docs])
        places = np.searchsorted(keys // max(len(found), 1), np.arange(n_words + 1))
        self.places = places.tolist()
        self.most = np.zeros(n_words, np.int64)
        there = places[1:] > places[:-1]
        if there.any():
            self.most[there] = np.maximum.reduceat(self.worth, places[:-1][there])

    def of(self, word: int) -> tuple[np.ndarray, np.ndarray]:
        cut = slice(self.places[word], self.places[word + 1])
        return self.docs[cut], self.worth[cut]


def accumulate(postings: Postings, query: list[tuple[int, int]], k: int, reached: int,
               n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a block that may be among the k best of a query, with their exact scores.

    `query` lists words and their weights, rarest first; `reached` is a score that a document needs at
    least (0: none). A document that is not returned scores less than `reached` or than k others.
    """
    rest = [0]
    for word, share in reversed(query):
        rest.append(rest[-1] + share * int(postings.most[word]))
    rest.reverse()
    scores = np.zeros(n_docs, np.int64)
    place = 0
    opened = np.empty(0, np.int64)
    while place < len(query):
        if rest[place] < reached:
            break
        if len(opened) >= k and rest[place] < np.partition(scores[opened], len(opened) - k)[len(opened) - k]:
            break
        word, share = query[place]
        docs, worth = postings.of(word)
        scores[docs] += share * worth
        opened = np.flatnonzero(scores)
        place += 1
    survivors = opened
    sums = scores[survivors]
    for word, share in query[place:]:
        if not len(survivors):
            break
        docs, worth = postings.of(word)
        if len(docs):
            at = np.minimum(np.searchsorted(docs, survivors), len(docs) - 1)
            sums += np.where(docs[at] == survivors, share * worth[at], 0)
    return survivors, sums


class Best:
    """The k best documents of one item, by score and then by id; a document without id comes last."""

    def __init__(self, k: int):
        self.k = k
        self.rows: list[tuple[int, bool, int]] = []

    def reached(self) -> int:
        return -self.rows[-1][0] if len(self.rows) == self.k else 0

    def add(self, ids: list[int | None], docs: np.ndarray, scores: np.ndarray) -> None:
        if len(scores) > self.k:
            least = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            keep = scores >= max(int(least), self.reached())
            docs, scores = docs[keep], scores[keep]
        found = [
            (-score, ids[doc] is None, ids[doc] or 0) for doc, score in zip(docs.tolist(), scores.tolist())
        ]
        self.rows = sorted(self.rows + found)[:self.k]


def _item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items with their terms, in blocks of bounded text."""
    block, size = [], 0
    for row in items.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        block.append((row["item_id"], terms_of(row["text"])))
        size += 64 + len((row["text"] or "").encode())
        if size >= ITEM_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def statistics(docs: DataFrame, words: dict[bytes, int]) -> tuple[int, int, list[int]]:
    """Documents with a term, all their terms, and for each of `words` the documents that hold it."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(words), np.int64)
        n_docs = n_terms = 0
        for batch in batches:
            for text in batch["text"]:
                found = terms_of(text.as_py())
                n_docs += bool(found)
                n_terms += len(found)
                asked = [words[word] for word in words.keys() & set(found)]
                df[asked] += 1
        there = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([[-2, -1], there]), pa.int64()),
            pa.array(np.concatenate([[n_docs, n_terms], df[there]]), pa.int64()),
        ], names=["word", "n"])

    counted = docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # A row for each word asked for: as many as the block of items has, and no more.
    found = {row["word"]: row["n"] for row in counted.collect()}
    return found.get(-2, 0), found.get(-1, 0), [found.get(number, 0) for number in range(len(words))]


def _search_block(docs: DataFrame, items: list[tuple[int | None, list[bytes]]], k: int) -> DataFrame | None:
    words = {word: number for number, word in enumerate(sorted({word for _, terms in items for word in terms}))}
    n_docs, n_terms, df = statistics(docs, words)
    if not n_docs:
        return None
    queries = []
    for _, terms in items:
        times: dict[int, int] = {}
        for word in terms:
            times[words[word]] = times.get(words[word], 0) + 1
        rarest = sorted((df[word], word) for word in times if df[word])
        queries.append([(word, times[word] * weight(n_docs, n)) for n, word in rarest])
    item_ids = [item_id for item_id, _ in items]

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [Best(k) for _ in queries]
        ids, found, lengths, size = [], [], [], 0

        def finish():
            postings = Postings(found, lengths, len(words), n_docs, n_terms)
            for top, query in zip(tops, queries):
                docs_found, scores = accumulate(postings, query, k, top.reached(), len(ids))
                if len(docs_found):
                    top.add(ids, docs_found, scores)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                terms = terms_of(text.as_py())
                asked = [words[word] for word in terms if word in words]
                if asked:
                    ids.append(doc_id)
                    found.append(np.array(asked, np.int64))
                    lengths.append(len(terms))
                    size += 8 * len(asked)
                if size >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                    finish()
                    ids, found, lengths, size = [], [], [], 0
        if ids:
            finish()
        rows = [
            (number, item_id, None if unknown else doc_id, -score)
            for number, (item_id, top) in enumerate(zip(item_ids, tops))
            for score, unknown, doc_id in top.rows
        ]
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, pa.int64()) for column in columns], names=["item", "item_id", "doc_id", "score"]
        )

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        best, "item long, item_id long, doc_id long, score long"
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "item_id", "rank", "doc_id", "score"
    )


def search(docs: DataFrame, items: DataFrame, k: int = RANKS) -> DataFrame:
    """The k best documents of each row of `items` by `text`: `item_id`, `rank`, `doc_id`, `score`.

    Ranks are unique; equal scores go by ascending `doc_id`. A NULL or empty text has no terms: as a
    document it is not counted, as an item it finds nothing. Every row is a document or an item of its own,
    also if rows share an id; a document without `doc_id` comes after its equals, and its result has none.
    Texts of any length count whole. No documents, or no items: no rows. Other columns, whatever their names,
    are not looked at. `docs` is read twice for each ITEM_BYTES of items.
    """
    parts = [part for block in _item_blocks(items) if (part := _search_block(docs, block, k)) is not None]
    if not parts:
        return docs.sparkSession.createDataFrame([], RESULT)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
