"""Token ids in binary files: blocks of ids, transposed into planes, each compressed.

A file holds the ids of a range of documents in ascending ``doc_id``:

    header   magic, block size, planes per id (4 byte planes or 32 bit planes)
    blocks   per block of ids its planes, each compressed with zstandard on its own
    index    per block: offset, number of ids, compressed length of each plane
    rows     doc_id, its null marks, and the number of ids of each document
    footer   places of index and rows, counts, magic

The high planes of small ids are all zeros and compress to almost nothing. The index lets
a reader fetch any block, and any plane of it, without the rest. A task writes one file
under a name of its own attempt; the table of files that Spark commits names only files
of attempts that ended well, so lost and repeated attempts leave no trace in a reading.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changefeed.llm import tokens
from changefeed.llm.common import written
from changefeed.session import shared_dir

MAGIC = b"IDPLANES"
BLOCK = 1 << 16
END_ID = 2
HEADER, ENTRY, FOOTER = struct.Struct("<8sII"), struct.Struct("<QI"), struct.Struct("<QQQQI8s")
FILES = "file string, first_id long, n_docs long, n_ids long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def to_planes(ids: np.ndarray, planes: int) -> list[bytes]:
    """The ids' bytes (4 planes) or bits (32 planes), least significant first."""
    by_byte = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if planes == 4:
        return [column.tobytes() for column in np.ascontiguousarray(by_byte.T)]
    bits = np.unpackbits(by_byte, axis=1, bitorder="little")
    return [np.packbits(column).tobytes() for column in np.ascontiguousarray(bits.T)]


def from_planes(parts: list[bytes], count: int) -> np.ndarray:
    raw = [np.frombuffer(part, np.uint8) for part in parts]
    if len(parts) == 4:
        return np.ascontiguousarray(np.stack(raw, axis=1)).view("<u4").ravel()
    bits = np.stack([np.unpackbits(part, count=count) for part in raw], axis=1)
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class Writer:
    def __init__(self, path: str, *, block: int = BLOCK, planes: int = 4) -> None:
        store, where = opened(path)
        self.out = store.open_output_stream(where)
        self.block, self.planes = block, planes
        self.packer = zstandard.ZstdCompressor(level=1)
        self.index: list[bytes] = []
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []
        self.waiting, self.place, self.total = b"", 0, 0
        self.put(HEADER.pack(MAGIC, block, planes))

    def put(self, data: bytes) -> None:
        self.out.write(data)
        self.place += len(data)

    def add(self, doc_ids: list[int | None], counts: list[int], ids: bytes) -> None:
        """Documents with their numbers of ids, and all their ids."""
        self.doc_ids += doc_ids
        self.counts += counts
        data, size = self.waiting + ids, 4 * self.block
        whole = len(data) - len(data) % size
        for at in range(0, whole, size):
            self.put_block(data[at : at + size])
        self.waiting = data[whole:]

    def put_block(self, data: bytes) -> None:
        ids = np.frombuffer(data, "<u4")
        packed = [self.packer.compress(plane) for plane in to_planes(ids, self.planes)]
        lengths = struct.pack(f"<{self.planes}I", *map(len, packed))
        self.index.append(ENTRY.pack(self.place, len(ids)) + lengths)
        self.total += len(ids)
        for plane in packed:
            self.put(plane)

    def close(self) -> None:
        if self.waiting:
            self.put_block(self.waiting)
        index_at = self.place
        self.put(b"".join(self.index))
        rows_at = self.place
        missing = np.array([d is None for d in self.doc_ids], np.uint8)
        ids = np.array([d or 0 for d in self.doc_ids], "<i8")
        counts = np.array(self.counts, "<u8")
        self.put(self.packer.compress(missing.tobytes() + ids.tobytes() + counts.tobytes()))
        self.put(FOOTER.pack(index_at, rows_at, len(self.doc_ids), self.total, len(self.index), MAGIC))
        self.out.close()


class Reader:
    def __init__(self, path: str) -> None:
        store, where = opened(path)
        self.file = store.open_input_file(where)
        self.unpacker = zstandard.ZstdDecompressor()
        magic, self.block, self.planes = HEADER.unpack(self.at(0, HEADER.size))
        size = self.file.size()
        index_at, rows_at, docs, self.total, blocks, end = FOOTER.unpack(
            self.at(size - FOOTER.size, FOOTER.size)
        )
        if magic != MAGIC or end != MAGIC:
            raise ValueError(f"{path} is not a file of id planes")
        entry = struct.Struct(f"<QI{self.planes}I")
        self.index = list(entry.iter_unpack(self.at(index_at, blocks * entry.size)))
        rows = self.unpacker.decompress(self.at(rows_at, size - FOOTER.size - rows_at))
        missing = np.frombuffer(rows, np.uint8, docs)
        ids = np.frombuffer(rows, "<i8", docs, docs)
        self.doc_ids = [None if gone else i for gone, i in zip(missing, ids.tolist(), strict=True)]
        self.counts = np.frombuffer(rows, "<u8", docs, 9 * docs).tolist()

    def at(self, place: int, length: int) -> bytes:
        self.file.seek(place)
        return self.file.read(length)

    def ids(self, block: int) -> np.ndarray:
        place, count, *lengths = self.index[block]
        parts = []
        for length in lengths:
            parts.append(self.unpacker.decompress(self.at(place, length)))
            place += length
        return from_planes(parts, count)

    def documents(self) -> Iterator[tuple[int | None, bytes]]:
        buffer, held, block = b"", 0, 0
        for doc_id, count in zip(self.doc_ids, self.counts, strict=True):
            while len(buffer) - held < 4 * count:
                buffer = buffer[held:] + self.ids(block).tobytes()
                held, block = 0, block + 1
            yield doc_id, buffer[held : held + 4 * count]
            held += 4 * count
        self.file.close()


def write_ids(
    documents: DataFrame,
    folder: str,
    *,
    end_id: int = END_ID,
    vocabulary: str = "byte_bpe_50k.json",
    kind: str = "byte",
    block: int = BLOCK,
    planes: int = 4,
) -> DataFrame:
    """Write the ids of all texts under ``folder``; one row per file, staged.

    Rows are ordered by ``doc_id``, null first, rows that repeat an id by text. A null or
    empty text is the end id alone. No rows give no files. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(vocabulary, kind)
        writer = None
        for batch in batches:
            for at in range(0, batch.num_rows, tokens.TEXTS):
                rows = batch.slice(at, tokens.TEXTS)
                if writer is None:
                    path = f"{folder}/ids-{uuid.uuid4().hex}"
                    opened(folder)[0].create_dir(opened(folder)[1], recursive=True)
                    writer = Writer(path, block=block, planes=planes)
                ids, edges = encode(rows.column("text"), end_id)
                counts = np.diff(edges).tolist()
                writer.add(rows.column("doc_id").to_pylist(), counts, ids.astype("<u4").tobytes())
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "file": path,
                        "first_id": writer.doc_ids[0],
                        "n_docs": len(writer.doc_ids),
                        "n_ids": writer.total,
                    }
                ],
                pa.schema(
                    [("file", pa.string()), ("first_id", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]
                ),
            )

    source = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = source.repartitionByRange(F.asc_nulls_first("doc_id")).sortWithinPartitions(
        F.asc_nulls_first("doc_id"), F.asc_nulls_first("text")
    )
    return written(ordered.mapInArrow(run, FILES), "id-files")


def read_ids(files: DataFrame) -> DataFrame:
    """One row per document from the files: its place among all ids, and a checksum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out, start = [], row["start"]
                for doc_id, ids in Reader(row["file"]).documents():
                    out.append((doc_id, start, len(ids) // 4, zlib.crc32(ids)))
                    start += len(ids) // 4
                columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    # One row per file meets in this window; files hold whole ranges of documents.
    before = Window.orderBy(F.asc_nulls_first("first_id")).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start")
    placed = files.select("file", start)
    return placed.repartition(max(1, files.count())).mapInArrow(run, ROWS)


def token_files(documents: DataFrame, folder: str | None = None, **options: object) -> DataFrame:
    """Write the ids and read them back."""
    folder = folder or f"{shared_dir(documents.sparkSession)}/changefeed-llm/ids-{uuid.uuid4().hex}"
    return read_ids(write_ids(documents, folder, **options))
