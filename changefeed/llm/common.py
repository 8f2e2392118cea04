"""What the operators share: words, Arrow batches as bytes, written copies."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.session import shared_dir

# A word is a run of [^\x20\x09-\x0D]. bytes.split() without arguments splits UTF-8
# at exactly these six bytes, and bytes.lower() lower-cases exactly A-Z.
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text; none of a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def crc_mod(name: str, modulus: int) -> Column:
    """crc32 of the decimal text of an id, modulo; 0 where the id is null."""
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % modulus, F.lit(0))


def texts(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes, null as empty."""
    values = column.cast(pa.large_binary()).to_pylist()
    return [v if v is not None else b"" for v in values]


def fresh(columns: Sequence[str], name: str) -> str:
    """``name``, longer by underscores until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder.

    Cuts the lineage in a way that survives lost executors and fixes rows that a
    later step reads more than once.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/changefeed-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Texts hashed in one go; one longer text goes alone.
HASHED_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_OF_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse."""
    if len(_POWERS[0]) < size:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(size, HASHED_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS


def word_hashes(group: list[bytes]) -> Iterator[np.ndarray]:
    """64-bit hashes of the words of each text: differences of running sums over its bytes."""
    at = 0
    while at < len(group):
        end, size = at, 0
        while end < len(group) and (end == at or size + len(group[end]) < HASHED_BYTES):
            size += len(group[end]) + 1
            end += 1
        data = np.frombuffer(b"\n".join([b"", *group[at:end], b""]), np.uint8)
        power, inverse = _powers(len(data))
        sums = np.cumsum(_OF_BYTE[data] * power[: len(data)])
        turn = np.flatnonzero(np.diff(_SPACE[data]))  # last byte before a word, last byte of it
        before, last = turn[0::2], turn[1::2]
        hashes = mixed((sums[last] - sums[before]) * inverse[before] + (last - before).astype(np.uint64))
        ends = np.cumsum([len(t) + 1 for t in group[at:end]])
        edges = np.concatenate([[0], np.searchsorted(before, ends)])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield hashes[a:b]
        at = end


_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` consecutive values."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = total * _STEP + h[k : k + n]
    return mixed(total)


def run_starts(values: np.ndarray) -> np.ndarray:
    """Where each run of equal neighbours begins."""
    if not len(values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, values[1:] != values[:-1]])


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it


def give_back() -> None:
    """Return freed memory to the system.

    A Python worker stays for later tasks. What Arrow and the C library hold back of a task's
    memory meanwhile counts against its executor, beside the heap of stages without Python.
    """
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def giving_back(run: Run) -> Run:
    """``run``, with its freed memory given back when the task ends."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def in_slices(batch: pa.RecordBatch, rows: int = 2_000) -> Iterator[pa.RecordBatch]:
    """A batch in pieces, so that output columns stay small."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
