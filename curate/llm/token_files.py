"""Token ids in files of shuffled planes, with a chunk index.

A file holds the ids of a run of documents, one after the other. They are cut into blocks of
BLOCK_IDS ids. A block is transposed: its lowest bytes (or bits) first, then the next, and so
on, and every plane is compressed by zstandard on its own; the high planes of token ids are
nearly constant and shrink to almost nothing. The end of the file has the documents (id and
number of ids), the chunk index (place, ids and plane sizes of each block) and a trailer that
says where these are, so a reader can fetch any range of ids by reading a few blocks.
"""

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curate.llm.tokens import ID, encoder
from curate.session import new_path, written

# The file format: name and trailer, and how many ids a block has.
MAGIC = b"IDPLANE1"
TRAILER = struct.Struct("<QQQQBI8s")  # documents at, their number, index at, blocks, planes, block size, name
BLOCK_IDS = 1 << 16
BYTES, BITS = 4, 32
# Documents that a reader or writer turns over at once.
ROWS = 4096
MANIFEST = "part int, file string, n_docs long, n_ids long"
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def to_planes(ids: np.ndarray, planes: int) -> np.ndarray:
    """The bytes or bits of `ids`, one row for each place value, lowest first."""
    by_byte = np.ascontiguousarray(ids.astype(ID).view(np.uint8).reshape(-1, BYTES).T)
    if planes == BYTES:
        return by_byte
    bits = np.unpackbits(by_byte[:, :, None], axis=2, bitorder="little")
    return np.packbits(bits.transpose(0, 2, 1).reshape(BITS, -1), axis=1, bitorder="little")


def from_planes(rows: np.ndarray, planes: int, n: int) -> np.ndarray:
    """The ids behind `to_planes`."""
    if planes == BITS:
        bits = np.unpackbits(rows, axis=1, bitorder="little", count=n).reshape(BYTES, 8, n)
        rows = np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little").reshape(BYTES, n)
    return np.ascontiguousarray(rows.T).view(ID).reshape(-1)


class PlaneWriter:
    """Writes one file; only a block of ids and the numbers of the documents are in memory."""

    def __init__(self, sink, planes: int = BYTES, block_ids: int = BLOCK_IDS, level: int = 3):
        import zstandard

        if planes not in (BYTES, BITS):
            raise ValueError("planes must be 4 (bytes) or 32 (bits)")
        self.sink, self.planes, self.block_ids = sink, planes, block_ids
        self.pack = zstandard.ZstdCompressor(level=level).compress
        self.at = len(MAGIC)
        self.pending, self.n_pending, self.n_ids = [], 0, 0
        self.ids, self.lengths, self.index = [], [], []
        sink.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(doc_id)
        self.lengths.append(len(ids) // ID.itemsize)
        self.pending.append(ids)
        self.n_pending += self.lengths[-1]
        self.n_ids += self.lengths[-1]
        if self.n_pending >= self.block_ids:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.pending), ID)
        whole = len(ids) if last else len(ids) // self.block_ids * self.block_ids
        for start in range(0, whole, self.block_ids):
            block = ids[start:min(start + self.block_ids, whole)]
            packed = [self.pack(plane.tobytes()) for plane in to_planes(block, self.planes)]
            self.index.append([self.at, len(block), *map(len, packed)])
            for plane in packed:
                self.sink.write(plane)
                self.at += len(plane)
        rest = ids[whole:]
        self.pending, self.n_pending = [rest.tobytes()], len(rest)

    def close(self) -> None:
        self._flush(True)
        known = np.array([doc_id is not None for doc_id in self.ids], np.uint8)
        numbers = np.array([doc_id or 0 for doc_id in self.ids], "<i8")
        docs = self.pack(known.tobytes() + numbers.tobytes() + np.array(self.lengths, "<u8").tobytes())
        index = self.pack(np.array(self.index, "<u8").tobytes())
        self.sink.write(docs)
        self.sink.write(index)
        self.sink.write(TRAILER.pack(
            self.at, len(self.ids), self.at + len(docs), len(self.index), self.planes, self.block_ids, MAGIC
        ))


class PlaneReader:
    """Reads a file by its chunk index; `source` is an open file that can seek."""

    def __init__(self, source):
        import zstandard

        self.source = source
        self.unpack = zstandard.ZstdDecompressor().decompress
        size = source.seek(0, 2)
        trailer = self._at(size - TRAILER.size, TRAILER.size)
        docs, n_docs, index, n_blocks, self.planes, self.block_ids, magic = TRAILER.unpack(trailer)
        if magic != MAGIC:
            raise ValueError("not a file of id planes")
        raw = self.unpack(self._at(docs, index - docs))
        known = np.frombuffer(raw, np.uint8, n_docs)
        numbers = np.frombuffer(raw, "<i8", n_docs, n_docs)
        self.doc_ids = [int(number) if there else None for number, there in zip(numbers, known)]
        self.lengths = np.frombuffer(raw, "<u8", n_docs, 9 * n_docs).astype(np.int64)
        raw = self.unpack(self._at(index, size - TRAILER.size - index))
        self.index = np.frombuffer(raw, "<u8").reshape(n_blocks, 2 + self.planes).astype(np.int64)

    def _at(self, place: int, size: int) -> bytes:
        self.source.seek(place)
        return self.source.read(size)

    def block(self, number: int) -> np.ndarray:
        at, n, *sizes = self.index[number].tolist()
        raw, rows, place = self._at(at, sum(sizes)), [], 0
        for size in sizes:
            rows.append(np.frombuffer(self.unpack(raw[place:place + size]), np.uint8))
            place += size
        return from_planes(np.stack(rows), self.planes, n)

    def ids(self, start: int, n: int) -> Iterator[np.ndarray]:
        """`n` ids from place `start` on, block by block."""
        while n > 0:
            number, skip = divmod(start, self.block_ids)
            part = self.block(number)[skip:skip + n]
            yield part
            start, n = start + len(part), n - len(part)

    def documents(self) -> Iterator[tuple[int | None, int, Iterator[np.ndarray]]]:
        """Each document with its place in the file and its ids in parts; every block is read once."""
        number, block, skip, start = -1, np.empty(0, ID), 0, 0

        def parts(n: int):
            nonlocal number, block, skip
            while n > 0:
                if skip == len(block):
                    number, skip = number + 1, 0
                    block = self.block(number)
                part = block[skip:skip + n]
                skip, n = skip + len(part), n - len(part)
                yield part

        for doc_id, n in zip(self.doc_ids, self.lengths.tolist()):
            found = parts(n)
            yield doc_id, start, found
            for _ in found:  # what the caller has left
                pass
            start += n


def _open(path: str):
    """The file system of a folder in the shared store, and the folder's path on it."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path)


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2, planes: int = BYTES,
                      block_ids: int = BLOCK_IDS) -> DataFrame:
    """Write the ids of all texts, each closed by `end_id`, in ascending `doc_id` order under `path`.

    Returns the manifest: a row per file with its part, name and numbers of documents and ids.
    Parts follow each other in the order of ids. A NULL `doc_id` comes first; a NULL text is
    empty; rows that share a `doc_id` are ordered by a hash of their texts. Texts of any length are written whole; without
    rows there is no file, and no row of the manifest. Other columns are not looked at. A task that runs again writes a file of another name, and the manifest, committed
    by Spark, names the files that count. `path` must be on a store that pyarrow can open (file,
    hdfs, s3, gs, abfs) and that all executors share.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        end = np.array([end_id], ID).tobytes()
        part = TaskContext.get().partitionId()
        name = f"ids-{part:06d}-{uuid.uuid4().hex}.planes"
        store, folder = _open(path)
        writer = None
        sink = None
        for batch in batches:
            if batch.num_rows and writer is None:
                store.create_dir(folder, recursive=True)
                sink = store.open_output_stream(f"{folder}/{name}")
                writer = PlaneWriter(sink, planes, block_ids)
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                writer.add(doc_id, encode(text.as_py()) + end)
        if writer is not None:
            writer.close()
            sink.close()
            row = {"part": part, "file": name, "n_docs": len(writer.ids), "n_ids": writer.n_ids}
            yield pa.RecordBatch.from_pylist([row], pa.schema([
                ("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
            ]))

    tie = F.xxhash64("text")
    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    )
    return written(ordered.mapInArrow(write, MANIFEST), "id-manifest")


def read_token_files(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """A row per document, from the files alone: its id, its place among the ids of all documents,
    how many it has, and their CRC-32."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select(
        "part", "file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(name, pa.int64()) for name in ("doc_id", "start", "n_tokens", "ids_crc32")])
        store, folder = _open(path)
        for batch in batches:
            for row in batch.to_pylist():
                rows = []
                with store.open_input_file(f"{folder}/{row['file']}") as source:
                    for doc_id, start, parts in PlaneReader(source).documents():
                        n, crc = 0, 0
                        for part in parts:
                            n, crc = n + len(part), zlib.crc32(part.tobytes(), crc)
                        rows.append((doc_id, row["base"] + start, n, crc))
                        if len(rows) >= ROWS:
                            yield _columns(rows, schema)
                            rows = []
                yield _columns(rows, schema)

    # A file to a task: the manifest is small, its files are not.
    tasks = max(1, manifest.count())
    return files.repartition(tasks, "part").mapInArrow(read, RESULT)


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    values = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(value, field.type) for value, field in zip(values, schema)], schema=schema
    )


def token_files(docs: DataFrame, vocabulary: str, end_id: int = 2, path: str | None = None,
                planes: int = BYTES) -> DataFrame:
    """Write the files, by default to a new place in the shared folder, and read them back; NULLs, ties, long texts and
    empty tables are as `write_token_files` has them."""
    spark = docs.sparkSession
    path = path or new_path(spark, "id-files")
    return read_token_files(spark, path, write_token_files(docs, path, vocabulary, end_id, planes))
