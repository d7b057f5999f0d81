"""Which texts hold a keyword of a large table, by hashes of windows that double in size.

A keyword has the largest window, of 2^k bytes, that fits into it: its first one and its last one cover it. A text has
the hashes of all its windows, those of 2^(k+1) bytes made of two of 2^k. Where one is that of a keyword's first window,
both hashes together are looked up among those of all keywords, and what is found is compared byte by
byte. So the work grows with the texts and hardly with the keywords. UTF-8 is searched as bytes, which finds the same. Of a keyword
of more than two of the largest windows, hashes cover the beginning.

Executors may lack this package: what runs there brings its code along.
"""

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The largest windows have 2^MOST bytes; places of a text, or bytes of keywords, that are hashed at once.
MOST, AT_ONCE = 10, 1 << 18
INDEX = "size int, first long, both long, word binary"
# Odd numbers that hashes are multiplied by.
MIX, JOIN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
HALF = np.uint64(32)


def windows(text: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Hashes of the windows of 1, 2, 4 and so on bytes from every place of `text`, up to 2^most."""
    hashes = (text.astype(np.uint64) + np.uint64(1)) * JOIN
    hashes ^= hashes >> HALF
    yield hashes
    for size in range(most):
        step = 1 << size
        longer = hashes[:-step] * MIX
        longer += hashes[step:]
        longer ^= longer >> HALF
        hashes = longer
        yield hashes


def together(first: np.ndarray, last: np.ndarray, length: np.ndarray) -> np.ndarray:
    return ((first * MIX + last) ^ (first >> HALF)) * JOIN + length.astype(np.uint64)


def covered(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many bytes of keywords the hashes cover, and the power of two of their windows."""
    covers = np.minimum(lengths, 2 << MOST)
    return covers, np.minimum(np.frexp(covers)[1] - 1, MOST)


def index_keywords(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keywords, none of them empty, with the hash of their first window and of both."""
    def indexed(words: list[bytes]) -> pa.RecordBatch:
        covers, sizes = covered(np.array([len(word) for word in words]))
        ends = np.cumsum(covers)
        text = np.frombuffer(b"".join(word[:2 << MOST] for word in words), np.uint8)
        first, both = np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64)
        for size, hashes in enumerate(windows(text, int(sizes.max()))):
            own = np.flatnonzero(sizes == size)
            first[own] = hashes[ends[own] - covers[own]]
            both[own] = together(first[own], hashes[ends[own] - (1 << size)], covers[own])
        return pa.RecordBatch.from_arrays(
            [pa.array(sizes, pa.int32()), pa.array(first.view(np.int64)), pa.array(both.view(np.int64)), pa.array(words, pa.binary())],
            ["size", "first", "both", "word"],
        )

    for batch in batches:
        words, held = [], 0
        for word in batch["word"]:
            words.append(word.as_py())
            held += len(words[-1])
            if held >= AT_ONCE:
                yield indexed(words)
                words, held = [], 0
        if words:
            yield indexed(words)


class Sized:
    """The keywords whose windows have 2^size bytes."""

    def __init__(self, size: int, first: np.ndarray, both: np.ndarray, words: pa.Array):
        self.window, self.words = 1 << size, words
        covers = covered(np.diff(np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, 4 * words.offset)))[0]
        # Each first window once, with the lengths that its keywords have.
        order = np.lexsort((covers, first))
        first, covers = first[order], covers[order]
        new = np.ones(len(first), bool)
        new[1:] = (first[1:] != first[:-1]) | (covers[1:] != covers[:-1])
        first, self.covers = first[new], covers[new]
        self.begins = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
        self.first, self.n = first[self.begins], np.diff(np.append(self.begins, len(first)))
        # What a hash is looked up in before that: most are not there.
        bits = min(24, max(12, int(16 * len(self.first)).bit_length()))
        self.shift = np.uint64(64 - bits)
        self.there = np.zeros(1 << bits, bool)
        self.there[self.first >> self.shift] = True
        self.order = np.argsort(both)
        self.both = both[self.order]

    def met(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the first `n` places those where a first window is, once for each length of its keywords; these lengths."""
        at = np.flatnonzero(self.there[hashes[:n] >> self.shift])
        place = np.searchsorted(self.first, hashes[at])
        known = self.first[np.minimum(place, len(self.first) - 1)] == hashes[at]
        at, place = at[known], place[known]
        n_lengths = self.n[place]
        within = np.arange(n_lengths.sum()) - np.repeat(np.cumsum(n_lengths) - n_lengths, n_lengths)
        return np.repeat(at, n_lengths), self.covers[np.repeat(self.begins[place], n_lengths) + within]

    def holds(self, text: memoryview, place: int) -> bool:
        """Whether `text` begins with a keyword of the same hashes as that at `place`."""
        both = self.both[place]
        while place < len(self.both) and self.both[place] == both:
            word = self.words[int(self.order[place])].as_py()
            if text[:len(word)] == word:
                return True
            place += 1
        return False


def index_list(words: list[str]) -> pa.Table:
    """The index of a list of different keywords, none of them empty."""
    batch = pa.RecordBatch.from_arrays([pa.array([word.encode() for word in words], pa.binary())], ["word"])
    return pa.Table.from_batches(index_keywords(iter([batch])))


def read_block(block: str | pa.Table) -> list[Sized]:
    """The keywords of a table, or a file, of the index."""
    import pyarrow.parquet as pq
    from pyarrow.fs import FileSystem

    table = block
    if isinstance(block, str):
        store, path = FileSystem.from_uri(block)
        with store.open_input_file(path) as source:
            table = pq.read_table(source)
    sizes, found = table["size"].to_numpy(), []
    for size in np.unique(sizes).tolist():
        own = table.filter(pa.array(sizes == size)).combine_chunks()
        first, both = (own[name].to_numpy().view(np.uint64) for name in ("first", "both"))
        found.append(Sized(size, first, both, own["word"].chunk(0)))
    return found


def search(texts: pa.Array, found: np.ndarray, block: list[Sized]) -> None:
    """Mark in `found` the texts that hold a keyword of the block."""
    _, offsets, data = texts.buffers()
    if data is None or not block:
        return
    wide = pa.types.is_large_binary(texts.type)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    whole, by_size = memoryview(data).cast("B"), {sized.window: sized for sized in block}
    most = max(by_size).bit_length() - 1
    for begin in range(int(ends[0]), int(ends[-1]), AT_ONCE):
        part = np.frombuffer(whole[begin:min(begin + AT_ONCE + (2 << MOST), int(ends[-1]))], np.uint8)
        for size, hashes in enumerate(windows(part, most)):
            if (1 << size) not in by_size or not len(hashes):
                continue
            sized = by_size[1 << size]
            at, covers = sized.met(hashes, AT_ONCE)
            text = np.searchsorted(ends, begin + at, "right") - 1
            fits = (begin + at + covers <= ends[text + 1]) & ~found[text]
            at, covers, text = at[fits], covers[fits], text[fits]
            both = together(hashes[at], hashes[at + covers - sized.window], covers)
            place = np.searchsorted(sized.both, both)
            known = sized.both[np.minimum(place, len(sized.both) - 1)] == both
            at, text, place = at[known], text[known], place[known]
            while len(text):
                # One place of each text; the others if it is not a keyword's after all.
                _, one = np.unique(text, return_index=True)
                for number in one.tolist():
                    own = int(text[number])
                    found[own] = sized.holds(whole[begin + int(at[number]):int(ends[own + 1])], int(place[number]))
                left = ~found[text]
                left[one] = False
                at, text, place = at[left], text[left], place[left]


def searcher(blocks: list[str | pa.Table]) -> Callable[[pa.Array], pa.Array]:
    """Whether texts, as bytes, hold a keyword of the index in `blocks`. One of them at a time is made ready in memory."""
    held: dict[int, list[Sized]] = {}

    def mentions(texts: pa.Array) -> pa.Array:
        found = np.zeros(len(texts), bool)
        for number, block in enumerate(blocks):
            if number not in held:
                held.clear()
                held[number] = read_block(block)
            left = np.flatnonzero(~found)
            rest = texts if len(left) == len(texts) else texts.take(pa.array(left))
            new = np.zeros(len(rest), bool)
            search(rest, new, held[number])
            found[left] = new
        return pa.array(found)

    return mentions
