"""Token counts by counting every distinct pre-token once.

Texts are taken in blocks. A block becomes the list of its distinct pre-tokens and, for every
document, how often it has which of them. The pre-tokens of all blocks meet sorted, so that each is
given to the model once, however many blocks have it, and only its number of pieces goes back.
Joined to a block, the numbers times the frequencies add up to the tokens of each document. Ids are
never made for a text.
"""

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curate.llm.tokens import EVEN_CUT, PLAIN, Encoder
from curate.session import new_path

# How much text a block takes, and what a row counts for besides its text.
BLOCK_BYTES, ROW_BYTES = 32 << 20, 64
# What a block holds of a document: places in the block's list of pre-tokens as differences, and how often.
PLACES, TIMES = np.dtype("<u4"), np.dtype("<u4")
BLOCKS = ("part int, number long, n_words long, words array<string>, doc_ids array<long>, sizes array<long>, "
          "distinct array<int>, places binary, times binary")
RESULT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
MARK = "\0"  # before a special token, so that it is no pre-token of the same letters


class Cutter(Encoder):
    """The pre-tokens of texts, as the library cuts them, and how many pieces one has."""

    def __init__(self, vocabulary: str):
        super().__init__(vocabulary)
        tokens = self.library.get_added_tokens_decoder().values()
        special = sorted((re.escape(token.content) for token in tokens), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(special) + ")") if special else None
        if not self.even:
            raise ValueError("counting by pre-tokens needs a plain byte-level BPE vocabulary")

    def cut(self, run: str) -> list[str]:
        """The pre-tokens of a run of text."""
        plain = PLAIN.fullmatch(run)
        if plain:
            return [part.encode().decode("latin-1").translate(self.letters) for part in plain.groups() if part]
        words = []
        for number, part in enumerate(self.special.split(run) if self.special else [run]):
            if number % 2:
                words.append(MARK + part)
            elif part:
                words += [piece for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(part)]
        return words

    def runs(self, text: str) -> Iterator[str]:
        """The text in runs that can be cut on their own: a run starts at a single blank or around a line end
        between other characters."""
        parts = EVEN_CUT.split(text)
        yield parts[0]
        for blank, part in zip(parts[1::2], parts[2::2]):
            if blank == "\n":
                yield blank
                yield part
            else:
                yield blank + part

    def pieces(self, word: str) -> int:
        return 1 if word.startswith(MARK) else len(self.model.tokenize(word))


@lru_cache(maxsize=1)
def cutter(vocabulary: str) -> Cutter:
    return Cutter(vocabulary)


class _Places(dict):
    """The pre-tokens of each run of a block, as places in the block's list."""

    def __init__(self, cut):
        super().__init__()
        self.cut, self.words = cut, {}

    def __missing__(self, run: str) -> bytes:
        words = self.words
        found = np.array([words.setdefault(word, len(words)) for word in self.cut(run)], PLACES).tobytes()
        if len(run) <= 64:
            self[run] = found
        return found


class _Block:
    """What a block holds of the documents added so far."""

    def __init__(self, cut):
        self.places, self.size = _Places(cut), 0
        self.doc_ids, self.sizes, self.distinct, self.all_places, self.all_times = [], [], [], [], []

    def add(self, doc_id: int | None, text: str, runs: Iterator[str]) -> None:
        found = b"".join(map(self.places.__getitem__, runs))
        which, times = np.unique(np.frombuffer(found, PLACES), return_counts=True)
        self.doc_ids.append(doc_id)
        self.sizes.append(len(text.encode()))
        self.distinct.append(len(which))
        self.all_places.append(np.diff(which, prepend=PLACES.type(0)))
        self.all_times.append(times.astype(TIMES))
        self.size += len(text) + ROW_BYTES

    def batch(self, part: int, number: int) -> pa.RecordBatch:
        words = list(self.places.words)
        return pa.RecordBatch.from_pylist([{
            "part": part, "number": number, "n_words": len(words), "words": words, "doc_ids": self.doc_ids,
            "sizes": self.sizes, "distinct": self.distinct, "places": _packed(self.all_places),
            "times": _packed(self.all_times),
        }], BLOCKS_SCHEMA)


def frequencies(docs: DataFrame, vocabulary: str) -> DataFrame:
    """The blocks of `docs`, as in BLOCKS. A block goes on from batch to batch until it is full. `part` and `number`
    name it within one evaluation only."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tools = cutter(vocabulary)
        part, number, block = TaskContext.get().partitionId(), 0, _Block(tools.cut)
        for batch in batches:
            for doc_id, value in zip(batch["doc_id"].to_pylist(), batch["text"]):
                text = value.as_py() or ""
                if block.doc_ids and block.size + len(text) + ROW_BYTES > BLOCK_BYTES:
                    yield block.batch(part, number)
                    number, block = number + 1, _Block(tools.cut)
                block.add(doc_id, text, tools.runs(text))
        if block.doc_ids:
            yield block.batch(part, number)

    return docs.select("doc_id", "text").mapInArrow(count, BLOCKS)


BLOCKS_SCHEMA = pa.schema([
    ("part", pa.int32()), ("number", pa.int64()), ("n_words", pa.int64()), ("words", pa.list_(pa.string())),
    ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("distinct", pa.list_(pa.int32())),
    ("places", pa.binary()), ("times", pa.binary()),
])


def _packed(parts: list[np.ndarray]) -> bytes:
    import zstandard

    flat = np.concatenate(parts) if parts else np.empty(0, PLACES)
    # Byte by byte of all numbers in turn: the high bytes are nearly all zero.
    planes = np.ascontiguousarray(flat.view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(PLACES).reshape(-1)


def bits(part: int, number: int, n_words: int) -> tuple[int, int]:
    """How many bits the number of a block in its part takes, and a place in a block, if these are the largest. A
    block and a place in it are one number on the way through the shuffles."""
    widths = part.bit_length(), number.bit_length(), n_words.bit_length()
    if sum(widths) > 63:
        raise OverflowError(f"no 63 bits for part {part}, block {number} and {n_words} pre-tokens: use more partitions")
    return widths[1:]


def piece_counts(words: DataFrame, vocabulary: str, place_bits: int) -> DataFrame:
    """`block`, and place and pieces in one number, for rows of `word` and `at`, block and place in one. The rows come
    sorted by word: the model sees a word once per partition, and partitions do not share words."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces_of = cutter(vocabulary).pieces
        last, pieces = None, 0
        for batch in batches:
            counts = []
            for word in batch["word"].to_pylist():
                if word != last:
                    last, pieces = word, pieces_of(word)
                counts.append(pieces)
            at = np.asarray(batch["at"])
            found = (at & (1 << place_bits) - 1) << 32 | np.array(counts, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at >> place_bits, pa.int64()), pa.array(found, pa.int64())], names=["block", "found"]
            )

    return words.mapInArrow(count, "block long, found long")


def add_up(_, docs: pa.Table, counts: pa.Table, limit: int) -> pa.Table:
    """The tokens of the documents of a block, from its frequencies and the pieces of its pre-tokens."""
    found = np.asarray(counts["found"])
    pieces = np.zeros(counts.num_rows, np.int64)
    pieces[found >> 32] = found & (1 << 32) - 1
    parts = []
    for row in docs.to_pylist():
        ends = np.cumsum(row["distinct"], dtype=np.int64)
        steps, times = _unpacked(row["places"]).astype(np.int64), _unpacked(row["times"]).astype(np.int64)
        # Places are differences within a document.
        places = np.cumsum(steps)
        starts = ends - np.array(row["distinct"], np.int64)
        before = np.concatenate([[0], places])[starts]
        places -= np.repeat(before, row["distinct"])
        total = np.concatenate([[0], np.cumsum(pieces[places] * times)])
        tokens = total[ends] - total[starts]
        parts.append(pa.table({
            "doc_id": pa.array(row["doc_ids"], pa.int64()), "n_bytes": pa.array(row["sizes"], pa.int64()),
            "n_tokens": pa.array(tokens, pa.int64()), "over_limit": pa.array(tokens > limit, pa.bool_()),
        }))
    return pa.concat_tables(parts)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """`doc_id`, `n_bytes`, `n_tokens` and whether these are more than `limit`, for every row.

    A NULL text is empty and has none; NULL or repeated `doc_id`s and repeated rows are counted row by row;
    texts of any length count whole; an empty table has no rows; other columns are not looked at. The blocks are staged in the shared
    folder, so that their numbers stay the same when a task runs again.
    """
    spark = docs.sparkSession
    path = new_path(spark, "frequencies")
    frequencies(docs, vocabulary).write.option("compression", "zstd").parquet(path)
    staged = spark.read.schema(BLOCKS).parquet(path)
    largest = staged.agg(*[F.coalesce(F.max(name), F.lit(0)) for name in ("part", "number", "n_words")]).first()
    number_bits, place_bits = bits(*largest)
    block = F.shiftleft(F.col("part").cast("long"), number_bits) + F.col("number")
    staged = staged.select(block.alias("block"), "words", "doc_ids", "sizes", "distinct", "places", "times")
    words = (
        staged.select("block", F.posexplode("words").alias("place", "word"))
        .select("word", (F.shiftleft("block", place_bits) + F.col("place")).alias("at"))
        .repartition("word").sortWithinPartitions("word")
    )
    counted = piece_counts(words, vocabulary, place_bits)
    return staged.drop("words").groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(
        lambda key, left, right: add_up(key, left, right, limit), RESULT
    )
