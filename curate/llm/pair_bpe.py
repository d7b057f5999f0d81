"""Byte-pair encoding by an index of pair occurrences, and decoding.

All pre-tokens that a block of texts needs are laid out in one array of symbols. The index maps each
pair of neighbours that has a rank to the list of all its places. The lowest active rank is
applied to all its places at once; the lists of the pairs that this breaks or makes are brought up
to date, and so on until no listed pair is left. That is the same as merging word by word, because
a pair made by a merge always has a higher rank than the merge (this is checked on loading).
"""

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curate.llm.tokens import ID, PLAIN, RECENT_RUNS, Encoder, byte_letters

# How much text shares one index.
BLOCK_BYTES = 8 << 20
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PairIndex:
    """Merges of a vocabulary, and the index over the symbols of many pieces."""

    def __init__(self, vocab: dict[str, int], merges: list):
        pairs = [tuple(merge.split(" ")) if isinstance(merge, str) else tuple(merge) for merge in merges]
        made: dict[str, int] = {}
        for rank, (left, right) in enumerate(pairs):
            made.setdefault(left + right, rank)
        if any(made.get(symbol, -1) >= rank for rank, pair in enumerate(pairs) for symbol in pair):
            raise ValueError("a merge uses a symbol that a later merge makes")
        self.left = np.array([vocab[left] for left, _ in pairs], np.int64)
        self.right = np.array([vocab[right] for _, right in pairs], np.int64)
        self.result = np.array([vocab[left + right] for left, right in pairs], np.int64)
        self.width = max(vocab.values()) + 1
        codes = self.left * self.width + self.right
        self.codes, first = np.unique(codes, return_index=True)
        self.ranks = first
        self.bytes = np.array([vocab[letter] for letter in byte_letters()], np.int64)

    def _listed(self, places: np.ndarray, codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The places by rank, of those whose pair has one."""
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        known = self.codes[at] == codes
        ranks, places = self.ranks[at[known]], places[known]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist()]
        for rank, start, end in zip(ranks[starts].tolist(), starts, [*starts[1:], len(places)]):
            yield rank, places[start:end]

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, packed."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        n = int(lengths.sum())
        if not n:
            return [b"" for _ in pieces]
        symbols = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        ends = np.cumsum(lengths)
        places = np.arange(n)
        after, before = places + 1, places - 1
        filled = lengths > 0
        after[ends[filled] - 1] = -1
        before[(ends - lengths)[filled]] = -1
        alive = np.ones(n, bool)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(places: np.ndarray, codes: np.ndarray) -> None:
            for rank, found in self._listed(places, codes):
                if rank in index:
                    index[rank].append(found)
                else:
                    index[rank] = [found]
                    heapq.heappush(active, rank)

        paired = places[after >= 0]
        add(paired, symbols[paired] * self.width + symbols[after[paired]])
        while active:
            rank = heapq.heappop(active)
            left, right = self.left[rank], self.right[rank]
            listed = index.pop(rank)
            at = np.sort(np.concatenate(listed))
            at = at[np.concatenate([[True], at[1:] != at[:-1]])]
            # A list may name places that an earlier merge has changed.
            at = at[alive[at] & (symbols[at] == left)]
            second = after[at]
            good = second >= 0
            at, second = at[good], second[good]
            good = symbols[second] == right
            at, second = at[good], second[good]
            if left == right and len(at) > 1:
                at, second = _apart(at, second)
            if not len(at):
                continue
            symbols[at] = self.result[rank]
            alive[second] = False
            third = after[second]
            after[at] = third
            linked = third >= 0
            before[third[linked]] = at[linked]
            first = before[at]
            has_first = first >= 0
            new = np.concatenate([first[has_first], at[linked]])
            if len(new):
                add(new, symbols[new] * self.width + symbols[after[new]])
        kept = np.concatenate([[0], np.cumsum(alive)])
        bounds = (kept[np.concatenate([[0], ends])] * ID.itemsize).tolist()
        ids = symbols[alive].astype(ID).tobytes()
        return [ids[start:end] for start, end in zip(bounds, bounds[1:])]


def _apart(at: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of places of a pair of equal symbols, those left after taking each run from its left."""
    kept, used = [], -1
    for number, (start, end) in enumerate(zip(at.tolist(), second.tolist())):
        if start != used:
            kept.append(number)
            used = end
    return at[kept], second[kept]


class PairEncoder(Encoder):
    """Ids as `Encoder` gives them, with all merges done by the pair index.

    The library reads the file, cuts texts that are not plain words, and names the special tokens;
    its own merging is never called.
    """

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as source:
            settings = json.load(source)
        model = settings["model"]
        self.index = PairIndex(model["vocab"], model["merges"])
        self.pieces: dict[str, bytes] = {}
        added = {token["content"]: token["id"] for token in settings["added_tokens"]}
        self.added = {content: np.array([number], ID).tobytes() for content, number in added.items()}
        longest = sorted(map(re.escape, added), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(longest) + ")") if longest else None
        back = {letter: byte for byte, letter in enumerate(byte_letters())}
        size = max([*model["vocab"].values(), *added.values()]) + 1
        self.table = [b""] * size
        for token, number in model["vocab"].items():
            self.table[number] = bytes(back[letter] for letter in token)
        for content, number in added.items():
            self.table[number] = content.encode()
        self.decimal = list(map(str, range(size)))
        super().__init__(vocabulary)
        # Runs age between blocks only: a block looks up what it has prepared.
        self.inner.most = self.first.most = float("inf")
        if not self.even:
            raise ValueError("the pair index needs a plain byte-level BPE vocabulary")

    def _cut(self, text: str) -> list[str]:
        """The pre-tokens of a text without special tokens."""
        return [text[start:end] for _, (start, end) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _merged(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            self.learn([piece])
            found = self.pieces[piece]
        return found

    def whole(self, text: str) -> bytes:
        parts = self.special.split(text) if self.special else [text]
        ids = []
        for number, part in enumerate(parts):
            if number % 2:
                ids.append(self.added[part])
            elif part:
                ids.extend(map(self._merged, self._cut(part)))
        return b"".join(ids)

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode pieces that are not known yet, all over one index."""
        new = [piece for piece in dict.fromkeys(pieces) if piece not in self.pieces]
        self.pieces.update(zip(new, self.index.encode([piece.encode() for piece in new])))

    def prepare(self, texts: Iterable[str]) -> None:
        """Make the index over all pre-tokens that a block of texts needs and does not have yet, and keep the ids
        of its runs."""
        self.pieces.clear()
        for runs in (self.inner, self.first):
            if len(runs) >= RECENT_RUNS:
                runs.age()
        inner, first = set(), set()
        words, marked, odd = [], [], []
        for text in texts:
            for line in text.split("\n"):
                runs = line.split(" ")
                first.add(runs[0])
                del runs[0]
                inner.update(runs)
        needed: set[str] = set()
        for runs, found in ((self.inner, inner), (self.first, first)):
            for run in found:
                if run in runs or run in runs.old or not run:
                    continue
                if run.isascii() and run.isalpha():
                    words.append((runs, run))
                    continue
                plain = PLAIN.fullmatch(runs.before + run)
                if not plain:
                    odd.append(runs.before + run)
                elif plain[2]:
                    marked.append((runs, run, plain[1], plain[2]))
                else:
                    words.append((runs, run))
        needed.update(runs.before + run for runs, run in words)
        for _, _, word, marks in marked:
            needed.add(word)
            needed.add(marks)
        for run in odd:
            for part in (self.special.split(run)[::2] if self.special else [run]):
                needed.update(self._cut(part) if part else ())
        self.learn(needed)
        pieces = self.pieces
        for runs, run in words:
            runs.keep(run, pieces[runs.before + run])
        for runs, run, word, marks in marked:
            runs.keep(run, pieces[word] + pieces[marks])

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        table = self.table
        numbers = np.frombuffer(ids, ID).tolist()
        return b"".join([table[number] for number in numbers]).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def pair_encoder(vocabulary: str) -> PairEncoder:
    """One encoder per worker, kept over its tasks."""
    return PairEncoder(vocabulary)


def blocks(values: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of a column, NULL as empty, in blocks of about `limit` bytes: the place of
    the first, and the texts. A longer text is a block of its own."""
    start, size, block = 0, 0, []
    for number, value in enumerate(values):
        text = value.as_py() or ""
        if block and size + len(text) > limit:
            yield start, block
            start, size, block = number, 0, []
        size += len(text)
        block.append(text)
    if block:
        yield start, block


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """`doc_id` and the token `ids` of every text. A NULL text is empty; a NULL or repeated `doc_id` and
    repeated rows give a row each; texts of any length are encoded whole; no rows give none; other columns, whatever
    their names, are not looked at."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pair_encoder(vocabulary)
        for batch in batches:
            for start, texts in blocks(batch["text"]):
                encoder.prepare(texts)
                ids = [np.frombuffer(encoder.encode(text), np.int32) for text in texts]
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][start:start + len(texts)], pa.ListArray.from_arrays(pa.array(offsets), flat)],
                    names=["doc_id", "ids"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """`doc_id` and `text` for rows of `doc_id` and `ids`; NULL ids are an empty text."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pair_encoder(vocabulary)
        for batch in batches:
            texts = [
                encoder.decode(np.asarray(value.values, ID).tobytes()) if value.is_valid else ""
                for value in batch["ids"]
            ]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Digests of the ids of every text and of the text decoded from them, as in `RESULT`.

    NULLs, repeats and other columns are treated as by `encode_documents`.
    """
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pair_encoder(vocabulary)
        decimal = encoder.decimal
        for batch in batches:
            for start, texts in blocks(batch["text"]):
                encoder.prepare(texts)
                sizes, of_ids, of_text = [], [], []
                for text in texts:
                    ids = encoder.encode(text)
                    numbers = np.frombuffer(ids, ID).tolist()
                    listed = ",".join([decimal[number] for number in numbers])
                    sizes.append(len(numbers))
                    of_ids.append(hashlib.sha256(listed.encode()).hexdigest())
                    of_text.append(hashlib.sha256(encoder.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][start:start + len(texts)], pa.array(sizes, pa.int64()),
                     pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(digest, RESULT)
