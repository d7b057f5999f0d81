"""Repeated passages: every byte covered by a string of WINDOW bytes that also starts earlier.

Suffixes are sorted in two stages. Those smaller than their successors are sorted directly; the
others follow from them in one scan over the buckets of first bytes, each sorted suffix placing its
predecessor. Common prefixes of neighbours then show which windows are equal, and of equal
windows the first stays.

Not all suffixes of a corpus need to meet. A window is owned by its anchor, the least of its grams of GRAM bytes by
a hash, so equal windows have equal anchors. A piece is a run of windows with the same anchor, and each
window is in one piece. Pieces travel as numbers: anchor, digest of the piece's bytes, place. Of equal pieces
the first one counts, as all windows of the others start there earlier; only different pieces of the same anchor
have their bytes sent to one suffix sorter. An anchor that has very many pieces (a line that everyone
quotes, between different neighbours) is spread: its windows are pieces of their own, which are equal or have nothing
in common.

Texts are staged once, compressed, in chunks that tasks read by their place in a file.
"""

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curate.session import new_path, written

WINDOW, GRAM = 100, 32
# Bytes of texts in a chunk and of pieces in a suffix sorter; both hold at least a whole text or anchor.
CHUNK_BYTES, SORTER_BYTES = 1 << 22, 1 << 20
# Bytes hashed at once; a place among them fits in PLACE_BITS.
SLICE, PLACE_BITS = 1 << 19, 20
# Text that a task goes through, by default: a hundred terabytes ask for a gigabyte, lest there be too many tasks.
TASK_BYTES = 1 << 24
# An anchor with more pieces than HOT is spread, judged by a sample: one document of DOCS_SHARE, one piece of PIECES_SHARE.
HOT, DOCS_SHARE, PIECES_SHARE = 50_000, 16, 16
# A text without id comes before all others.
NO_ID = -(1 << 63)
HEAD = struct.Struct("<Q")
DIGIT = 8
MANIFEST = "chunk long, file string, at long, size long, bytes long, sample array<long>"
# Fixed at random: what each byte is in a hash, and odd factors.
_rng = np.random.default_rng(20240607)
BYTE_HASH = _rng.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
FACTORS = _rng.integers(0, 1 << 63, 8, np.uint64) * np.uint64(2) + np.uint64(1)


# Suffixes in two stages.

def sort_directly(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """`places` of the zero-padded `text` in the order of its suffixes there, by `depth` bytes at least."""
    digits = np.ndarray(len(text) - DIGIT, ">u8", text.data, strides=(1,))
    order = places.copy()
    run = np.zeros(len(places), np.int64)
    active = np.arange(len(places))
    for seen in range(0, depth, DIGIT):
        which = order[active]
        keys = digits[np.minimum(which + seen, len(digits) - 1)].astype(np.uint64)
        by = np.lexsort((keys, run[active])) if seen else np.argsort(keys, kind="quicksort")
        which, keys, before = which[by], keys[by], run[active]
        order[active] = which
        opens = np.ones(len(active), bool)
        opens[1:] = (keys[1:] != keys[:-1]) | (before[1:] != before[:-1])
        heads = np.flatnonzero(opens)
        lengths = np.diff(np.append(heads, len(active)))
        run[active] = np.repeat(active[heads], lengths)
        active = active[np.repeat(lengths > 1, lengths)]
        if not len(active):
            break
    return order


def two_stage_sort(text: np.ndarray, depth: int = WINDOW) -> np.ndarray:
    """The suffix array of `text`, bytes that end in their only or least one, zero; suffixes that agree in
    `depth` bytes may come in any order."""
    n = len(text)
    # The next place where neighbours differ decides whether a suffix is smaller than its successor.
    differs = np.append(text[:-1] != text[1:], True)
    nearest = np.where(differs, np.arange(n), n)
    nearest = np.minimum.accumulate(nearest[::-1])[::-1]
    smaller = np.ones(n, bool)
    inner = nearest < n - 1
    smaller[inner] = text[nearest[inner]] < text[nearest[inner] + 1]
    padded = np.concatenate([text, np.zeros(depth + 2 * DIGIT, np.uint8)])
    direct = sort_directly(padded, np.flatnonzero(smaller), depth)
    larger = ~smaller
    letters = np.flatnonzero(np.bincount(text, minlength=256))
    ends = np.searchsorted(text[direct], letters, "right")
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]

    def place_predecessors(found: np.ndarray, letter: int) -> np.ndarray:
        """Append the larger predecessors to their buckets; those of this bucket are returned."""
        before = found[found > 0] - 1
        before = before[larger[before]]
        first = text[before]
        by = np.argsort(first, kind="stable")
        before, first = before[by], first[by]
        cuts = np.flatnonzero(np.diff(first)) + 1
        own = np.empty(0, np.int64)
        for part in np.split(before, cuts) if len(before) else []:
            if text[part[0]] == letter:
                own = part
            else:
                induced[text[part[0]]].append(part)
        return own

    out, start = [], 0
    for letter, end in zip(letters.tolist(), ends.tolist()):
        found = np.concatenate(induced[letter]) if induced[letter] else np.empty(0, np.int64)
        while len(found):
            out.append(found)
            found = place_predecessors(found, letter)
        out.append(direct[start:end])
        place_predecessors(direct[start:end], letter)
        start = end
    return np.concatenate(out)


def common_prefixes(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """How many bytes each suffix of `places` shares with the one before, `depth` at most."""
    padded = np.concatenate([text, np.zeros(depth + 2 * DIGIT, np.uint8)])
    digits = np.ndarray(len(padded) - DIGIT, ">u8", padded.data, strides=(1,))
    shared = np.zeros(len(places), np.int64)
    active = np.arange(1, len(places))
    for seen in range(0, depth, DIGIT):
        if not len(active):
            break
        other = digits[places[active] + seen].astype(np.uint64) ^ digits[places[active - 1] + seen].astype(np.uint64)
        equal = other == 0
        # The highest bit that differs, by the exponent of the number; a rounding up is taken back.
        top = np.frexp(other[~equal].astype(np.float64))[1] - 1
        top -= (other[~equal] >> top.clip(0, 63).astype(np.uint64)) == 0
        shared[active[~equal]] = seen + (63 - top) // 8
        shared[active[equal]] = seen + DIGIT
        active = active[equal]
    return np.minimum(shared, depth)


def later_windows(pieces: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Windows of pieces, given in the order of their places, that are equal to an earlier one: the number of
    the piece and the place in it, ascending."""
    sizes = np.array([len(piece) for piece in pieces], np.int64)
    bases = np.concatenate([[0], np.cumsum(sizes + 1)])
    # No byte of UTF-8 is 255: one more than a byte leaves zero for the ends of pieces.
    text = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8) + np.uint8(1)
    order = two_stage_sort(text, window)
    whole = np.zeros(len(text), bool)
    for base, size in zip(bases.tolist(), sizes.tolist()):
        whole[base:max(base, base + size - window + 1)] = True
    order = order[whole[order]]
    equal = common_prefixes(text, order, window) >= window
    heads = np.flatnonzero(~equal)
    if not len(heads):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.repeat(np.minimum.reduceat(order, heads), np.diff(np.append(heads, len(order))))
    later = np.sort(order[order != first])
    piece = np.searchsorted(bases, later, "right") - 1
    return piece, later - bases[piece]


# Windows by their anchors.

def _grams(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on."""
    found, size, step = BYTE_HASH[data], 1, 0
    while size < GRAM:
        found = found[:-size] * FACTORS[step] + found[size:]
        size, step = 2 * size, step + 1
    found ^= found >> np.uint64(31)
    found *= FACTORS[6]
    found ^= found >> np.uint64(29)
    return found


def _anchored(data: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of at most a slice of text: first window, last window, anchor. `whole` says where windows start."""
    grams = _grams(data)
    least = (grams >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(grams), dtype=np.uint64)
    size, span = 1, WINDOW - GRAM + 1
    while 2 * size <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if span > size:
        least = np.minimum(least[:len(least) - (span - size)], least[span - size:])
    owner = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    opens = whole.copy()
    opens[1:] &= (owner[1:] != owner[:-1]) | ~whole[:-1]
    closes = whole.copy()
    closes[:-1] &= (owner[1:] != owner[:-1]) | ~whole[1:]
    first, last = np.flatnonzero(opens), np.flatnonzero(closes)
    return first, last, grams[owner[first]].view(np.int64)


def pieces_of(data: bytes, lengths: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First windows, last windows and anchors of the pieces of texts that follow each other in `data`; windows of
    anchors in `hot` (ascending) are pieces of their own, with a hash of the window for anchor."""
    from xxhash import xxh3_64_intdigest

    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    letters = np.frombuffer(data, np.uint8)
    ends = np.cumsum(lengths)
    # A window must not go on into the next text.
    breaks = np.zeros(len(data) + 1, np.int32)
    for end in ends[:-1].tolist():
        breaks[max(0, end - WINDOW + 1)] += 1
        breaks[end] -= 1
    whole = np.cumsum(breaks[:n]) == 0
    parts = []
    for start in range(0, n, SLICE):
        stop = min(n, start + SLICE)
        if whole[start:stop].any():
            first, last, key = _anchored(letters[start:stop + WINDOW - 1], whole[start:stop])
            parts.append((first + start, last + start, key))
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    first, last, key = (np.concatenate(column) for column in zip(*parts))
    if len(hot):
        spread = hot[np.searchsorted(hot, key).clip(0, len(hot) - 1)] == key
        if spread.any():
            counts = (last - first + 1)[spread]
            each = np.repeat(first[spread], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            view = memoryview(data)
            hashes = [xxh3_64_intdigest(view[at:at + WINDOW], 1) for at in each.tolist()]
            first = np.concatenate([first[~spread], each])
            last = np.concatenate([last[~spread], each])
            key = np.concatenate([key[~spread], np.array(hashes, np.uint64).view(np.int64)])
            by = np.argsort(first)
            first, last, key = first[by], last[by], key[by]
    return first, last, key


# Chunks of texts in files.

def _open(path: str):
    """The file system of a folder in the shared store, and the folder's path on it."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path)


class Chunk:
    """Texts that follow each other, by ascending id."""

    def __init__(self, ids: list[int | None], lengths: list[int], data: bytes):
        self.ids, self.lengths, self.data = ids, np.array(lengths, np.int64), data
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)

    @classmethod
    def of(cls, rows: list[tuple[int | None, bytes]]) -> "Chunk":
        rows.sort(key=lambda row: (NO_ID if row[0] is None else row[0], row[1]))
        return cls([doc_id for doc_id, _ in rows], [len(text) for _, text in rows], b"".join([text for _, text in rows]))

    def packed(self) -> bytes:
        import zstandard

        known = np.array([doc_id is not None for doc_id in self.ids], np.uint8)
        ids = np.array([doc_id or 0 for doc_id in self.ids], "<i8")
        raw = b"".join([HEAD.pack(len(self.ids)), ids.tobytes(), self.lengths.astype("<i8").tobytes(), known.tobytes(), self.data])
        return zstandard.ZstdCompressor(level=3).compress(raw)

    @classmethod
    def read(cls, path: str, row: dict) -> "Chunk":
        import zstandard

        store, folder = _open(path)
        with store.open_input_file(f"{folder}/{row['file']}") as source:
            source.seek(row["at"])
            raw = zstandard.ZstdDecompressor().decompress(source.read(row["size"]))
        n, = HEAD.unpack_from(raw)
        ids = np.frombuffer(raw, "<i8", n, HEAD.size).tolist()
        lengths = np.frombuffer(raw, "<i8", n, HEAD.size + 8 * n)
        known = np.frombuffer(raw, np.uint8, n, HEAD.size + 16 * n).tolist()
        return cls([doc_id if there else None for doc_id, there in zip(ids, known)], lengths, raw[HEAD.size + 17 * n:])

    def sample(self, seed: int) -> list[int]:
        """Anchors of some pieces of some texts."""
        rng = np.random.default_rng(seed)
        chosen = np.flatnonzero(rng.random(len(self.ids)) * DOCS_SHARE < 1)
        data = b"".join([self.data[self.starts[doc]:self.starts[doc + 1]] for doc in chosen.tolist()])
        _, _, keys = pieces_of(data, self.lengths[chosen], np.empty(0, np.int64))
        return keys[rng.random(len(keys)) * PIECES_SHARE < 1].tolist()


def stage_texts(docs: DataFrame, path: str) -> DataFrame:
    """Write all texts in chunks under `path`; returns where each chunk is, and a sample of its anchors. Files of
    failed attempts are not named by any row."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name = f"texts-{part:06d}-{uuid.uuid4().hex}.chunks"
        store, folder = _open(path)
        sink, at, number, rows, size = None, 0, 0, [], 0
        schema = pa.schema([
            ("chunk", pa.int64()), ("file", pa.string()), ("at", pa.int64()), ("size", pa.int64()), ("bytes", pa.int64()),
            ("sample", pa.list_(pa.int64())),
        ])
        found = []

        def finish():
            nonlocal sink, at, number, rows, size
            if sink is None:
                store.create_dir(folder, recursive=True)
                sink = store.open_output_stream(f"{folder}/{name}")
            chunk = Chunk.of(rows)
            packed = chunk.packed()
            sink.write(packed)
            place = part << 32 | number
            found.append({
                "chunk": place, "file": name, "at": at, "size": len(packed), "bytes": len(chunk.data),
                "sample": chunk.sample(place),
            })
            at, number, rows, size = at + len(packed), number + 1, [], 0

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                data = (text.as_py() or "").encode()
                if rows and size + len(data) > CHUNK_BYTES:
                    finish()
                rows.append((doc_id, data))
                size += len(data) + 32
        if rows:
            finish()
        if sink is not None:
            sink.close()
            # Only a file that is whole is named.
            yield pa.RecordBatch.from_pylist(found, schema)

    return written(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(write, MANIFEST), "chunks")


# The passes over chunks.

def _numbered(path: str, hot: np.ndarray):
    """Pieces of chunks, as numbers; of equal pieces of a chunk only the first."""
    from xxhash import xxh3_64_intdigest

    names = ("key", "digest", "doc", "chunk", "at")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk.read(path, row)
                first, last, key = pieces_of(chunk.data, chunk.lengths, hot)
                if not len(first):
                    continue
                view = memoryview(chunk.data)
                digest = np.array([
                    xxh3_64_intdigest(view[start:end]) for start, end in zip(first.tolist(), (last + WINDOW).tolist())
                ], np.uint64).view(np.int64)
                by = np.lexsort((digest, key))
                same = (key[by][1:] == key[by][:-1]) & (digest[by][1:] == digest[by][:-1])
                keep = np.sort(by[np.concatenate([[True], ~same])])
                doc = np.searchsorted(chunk.starts, first[keep], "right") - 1
                ids = np.array([NO_ID if doc_id is None else doc_id for doc_id in chunk.ids], np.int64)
                columns = (key[keep], digest[keep], ids[doc], np.full(len(keep), row["chunk"]), first[keep])
                yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names=list(names))

    return pieces


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first of equal pieces, from pieces sorted by anchor, digest and place; `several` if its anchor has others."""
    def judge(rows: list[np.ndarray]) -> pa.RecordBatch:
        key, digest, chunk, at = rows
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        new = new_key.copy()
        new[1:] |= digest[1:] != digest[:-1]
        heads = np.flatnonzero(new_key)
        classes = np.add.reduceat(new.astype(np.int64), heads)
        several = np.repeat(classes > 1, np.diff(np.append(heads, len(key))))
        return pa.RecordBatch.from_arrays(
            [pa.array(chunk[new]), pa.array(at[new]), pa.array(several[new])], names=["chunk", "at", "several"]
        )

    rest = [np.empty(0, np.int64)] * 4
    for batch in batches:
        rows = [
            np.concatenate([kept, batch[name].to_numpy(zero_copy_only=False)])
            for kept, name in zip(rest, ("key", "digest", "chunk", "at"))
        ]
        if not len(rows[0]):
            continue
        # The last anchor may go on in the next batch.
        cut = np.searchsorted(rows[0], rows[0][-1], "left")
        if cut:
            yield judge([column[:cut] for column in rows])
        rest = [column[cut:] for column in rows]
    if len(rest[0]):
        yield judge(rest)


def _cut(path: str, hot: np.ndarray):
    """For each chunk: the windows of pieces that are not first, and the bytes of those to be sorted."""
    import zstandard

    def cut(firsts: pa.Table, chunks: pa.Table) -> pa.Table:
        row = chunks.to_pylist()[0]
        chunk = Chunk.read(path, row)
        first, last, key = pieces_of(chunk.data, chunk.lengths, hot)
        at, several = firsts["at"].to_numpy(), firsts["several"].to_numpy(zero_copy_only=False)
        known = np.searchsorted(first, at)
        repeated = np.ones(len(first), bool)
        repeated[known] = False
        spans = np.stack([first[repeated], last[repeated] + WINDOW]).astype("<i8").tobytes()
        chosen = np.sort(known[several.astype(bool)]) if len(at) else np.empty(0, np.int64)
        doc = np.searchsorted(chunk.starts, first[chosen], "right") - 1
        ids = [NO_ID if chunk.ids[place] is None else chunk.ids[place] for place in doc.tolist()]
        n = len(chosen)
        return pa.table({
            "chunk": pa.array([row["chunk"]] * (n + 1), pa.int64()),
            "key": pa.array([None, *key[chosen].tolist()], pa.int64()),
            "doc": pa.array([None, *ids], pa.int64()),
            "at": pa.array([None, *first[chosen].tolist()], pa.int64()),
            "data": pa.array(
                [None, *(chunk.data[a:b] for a, b in zip(first[chosen].tolist(), (last[chosen] + WINDOW).tolist()))], pa.binary()
            ),
            "spans": pa.array([zstandard.ZstdCompressor().compress(spans), *[None] * n], pa.binary()),
        })

    return cut


def _sorted_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of windows that start earlier, too, from pieces sorted by anchor, some anchors to a suffix sorter."""
    def judge(rows: list[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
        rows.sort(key=lambda row: row[1:4])
        piece, place = later_windows([row[4] for row in rows])
        opens = np.ones(len(piece), bool)
        opens[1:] = (piece[1:] != piece[:-1]) | (place[1:] != place[:-1] + 1)
        heads = np.flatnonzero(opens)
        tails = np.append(heads[1:], len(piece))[:len(heads)] - 1
        at = np.array([row[3] for row in rows], np.int64)[piece[heads]]
        return pa.RecordBatch.from_arrays([
            pa.array(np.array([row[2] for row in rows], np.int64)[piece[heads]]),
            pa.array(at + place[heads]), pa.array(at + place[tails] + WINDOW),
        ], names=["chunk", "start", "end"])

    rows, size = [], 0
    for batch in batches:
        for row in zip(*(batch[name].to_pylist() for name in ("key", "doc", "chunk", "at", "data"))):
            if size >= SORTER_BYTES and row[0] != rows[-1][0]:
                yield judge(rows)
                rows, size = [], 0
            rows.append(row)
            size += len(row[4])
    if rows:
        yield judge(rows)


def _removed(path: str):
    """The texts of a chunk without the spans, and the spans as maximal runs of each text."""
    import zstandard

    def remove(spans: pa.Table, chunks: pa.Table) -> pa.Table:
        row = chunks.to_pylist()[0]
        chunk = Chunk.read(path, row)
        depth = np.zeros(len(chunk.data) + 1, np.int64)
        for start, end, packed in zip(*(spans[name].to_pylist() for name in ("start", "end", "spans"))):
            if packed is None:
                depth[start] += 1
                depth[end] -= 1
            else:
                starts, ends = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), "<i8").reshape(2, -1)
                np.add.at(depth, starts, 1)
                np.add.at(depth, ends, -1)
        gone = np.cumsum(depth[:-1]) > 0
        letters = np.frombuffer(chunk.data, np.uint8)
        kept, found = [], []
        for start, end in zip(chunk.starts[:-1].tolist(), chunk.starts[1:].tolist()):
            part = gone[start:end]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], part, [False]]).astype(np.int8))).reshape(-1, 2)
            found.append([{"start": a, "end": b} for a, b in edges.tolist()])
            kept.append(letters[start:end][~part].tobytes())
        return pa.table({
            "doc_id": pa.array(chunk.ids, pa.int64()),
            "n_bytes": pa.array(chunk.lengths, pa.int64()),
            "spans": pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            "kept": pa.array(kept, pa.binary()),
        })

    return remove


def without_repeats(docs: DataFrame, hot_pieces: int = HOT, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Every text without the bytes that a string of WINDOW bytes covers which also starts earlier: in a text of smaller
    `doc_id`, or before it in the same text.

    Returns a row per row of `docs`: `doc_id`, `n_bytes`, `spans` (maximal runs removed, by start and exclusive
    end in bytes), `kept` (the rest, as bytes, which need not be whole characters). A NULL or empty text has no
    bytes. A row without `doc_id` comes before all others. Rows that share a `doc_id` follow each other by
    their texts if they are read together, else as they are read. Texts of any length count whole, but a text
    is held in one task. No rows give no rows. Other columns, whatever their names, are not looked at.

    An anchor with more than about `hot_pieces` pieces is spread over its windows, with the same result; there is at
    most one for that many pieces, so the list of them is a millionth of the texts, or less. `task_bytes` is how much text
    a task goes through, chunk by chunk; it changes the number of tasks alone.
    """
    spark = docs.sparkSession
    path = new_path(spark, "texts")
    chunks = stage_texts(docs, path)
    samples = chunks.select(F.explode("sample").alias("key")).groupBy("key").count()
    hot = samples.where(F.col("count") * DOCS_SHARE * PIECES_SHARE > hot_pieces).select("key")
    hot = np.array(sorted(row["key"] for row in hot.toLocalIterator()), np.int64)
    total = chunks.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    tasks = max(1, -(-total[1] // task_bytes), min(total[0], 2 * spark.sparkContext.defaultParallelism))
    located = chunks.select("chunk", "file", "at", "size").repartition(tasks, "chunk")
    pieces = located.mapInArrow(_numbered(path, hot), "key long, digest long, doc long, chunk long, at long")
    firsts = (
        pieces.repartition(tasks, "key").sortWithinPartitions("key", "digest", "doc", "chunk", "at")
        .mapInArrow(_firsts, "chunk long, at long, several boolean")
    )

    # A chunk's rows are few and its work is not: tasks are as many whatever the rows weigh.
    def by_chunk(rows: DataFrame) -> DataFrame:
        return rows.repartition(tasks, "chunk")

    def places() -> DataFrame:
        return by_chunk(chunks.select(F.col("chunk").alias("chunk"), "file", F.col("at").alias("at"), "size"))

    cut = written(
        by_chunk(firsts).groupBy("chunk").cogroup(places().groupBy("chunk")).applyInArrow(
            _cut(path, hot), "chunk long, key long, doc long, at long, data binary, spans binary"
        ),
        "pieces",
    )
    later = (
        cut.where("data IS NOT NULL").select("key", "doc", "chunk", "at", "data")
        .repartition(tasks, "key").sortWithinPartitions("key")
        .mapInArrow(_sorted_windows, "chunk long, start long, end long")
    )
    spans = later.select("chunk", "start", "end", F.lit(None).cast("binary").alias("spans")).unionByName(
        cut.where("data IS NULL").select(
            "chunk", F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("end"), "spans"
        )
    )
    return by_chunk(spans).groupBy("chunk").cogroup(places().groupBy("chunk")).applyInArrow(
        _removed(path), "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    )
