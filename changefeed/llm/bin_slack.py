"""Pack documents into fixed windows of token ids by minimum bin slack.

Full windows are cut off each document; what remains of a document is one piece. The
multiset of remaining lengths fills window after window: the longest remaining piece
opens a window, and a bitset of reachable sums (bit s of an integer: some pieces sum to
s) over the lengths present finds the fill closest to the capacity; walking back through
the bitsets gives how many pieces of each length it takes. Pieces that no choice fills up
exactly are set aside until more documents have come, and the next longest goes on; what
is left at the end of a partition is cut freely into full windows, and the last, partial one into lengths that are powers of
two and so need no padding. Every partition packs its own rows: nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.llm import tokens

CAPACITY = 4096
END_ID = 2
# Documents whose remainders are packed together; bounds a task's memory.
POOL = 4_096

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many pieces of each length come closest to ``room`` without passing it."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        if length > room:
            continue
        left, block = counts[length], 1
        while left and block * length <= room:
            take = min(block, left)
            steps.append((length, take, reach))
            reach |= (reach << (take * length)) & mask
            left -= take
            block *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= take * length
    return chosen


class Pool:
    """Remaining pieces by length, each a (document, start)."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.by_length: dict[int, list[tuple[int, int]]] = {}
        self.size = 0

    def add(self, length: int, piece: tuple[int, int]) -> None:
        self.by_length.setdefault(length, []).append(piece)
        self.size += 1

    def take(self, length: int) -> tuple[int, int]:
        pieces = self.by_length[length]
        piece = pieces.pop()
        if not pieces:
            del self.by_length[length]
        self.size -= 1
        return piece

    def window(self) -> list[tuple[int, int, int]] | None:
        """Pieces (document, start, length) that fill a window exactly, if there are."""
        first = max(self.by_length)
        counts = {length: len(pieces) for length, pieces in self.by_length.items()}
        counts[first] -= 1
        fill = best_fill(counts, self.capacity - first)
        if first + sum(length * n for length, n in fill.items()) < self.capacity:
            return None
        lengths = [first, *(length for length, n in fill.items() for _ in range(n))]
        return [(*self.take(length), length) for length in lengths]

    def drain(self) -> Iterator[list[tuple[int, int, int]]]:
        """Windows filled exactly; pieces that open none are set aside and stay in the pool."""
        aside: dict[int, list[tuple[int, int]]] = {}
        while self.by_length:
            window = self.window()
            if window is None:
                longest = max(self.by_length)
                aside[longest] = self.by_length.pop(longest)
            else:
                yield window
        self.by_length = aside

    def rest(self) -> Iterator[list[tuple[int, int, int]]]:
        """All that is left, cut into full windows and then powers of two."""
        left = [(*piece, n) for n, pieces in sorted(self.by_length.items()) for piece in pieces]
        total = sum(n for *_, n in left)
        sizes = [self.capacity] * (total // self.capacity)
        sizes += [1 << b for b in reversed(range(self.capacity.bit_length())) if total % self.capacity >> b & 1]
        self.by_length, self.size = {}, 0
        for size in sizes:
            window = []
            while size:
                doc, start, n = left.pop()
                cut = min(n, size)
                window.append((doc, start, cut))
                if cut < n:
                    left.append((doc, start + cut, n - cut))
                size -= cut
            yield window


def pack(
    documents: DataFrame,
    *,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    vocabulary: str = "word_bpe_49k.json",
    kind: str = "word",
    pool: int = POOL,
) -> DataFrame:
    """One row per piece of a document.

    A null or empty text is the end id alone. A null ``doc_id`` stays null; rows that
    repeat a ``doc_id`` are packed each on its own. No rows give no pieces. Other
    columns are ignored. ``sequence_id`` is unique, not dense: the partition and a count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(vocabulary, kind)
        sequence = TaskContext.get().partitionId() << 36
        remaining = Pool(capacity)
        kept: dict[int, tuple[int | None, int, bytes, int]] = {}
        number = 0
        out: list[tuple] = []

        def emit(window: list[tuple[int, int, int]]) -> None:
            nonlocal sequence
            offset = 0
            for doc, start, length in window:
                doc_id, total, ids, first = kept[doc]
                part = ids[4 * (start - first) : 4 * (start - first + length)]
                out.append((doc_id, start, length, zlib.crc32(part), total, sequence, offset))
                offset += length
            sequence += 1

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * 7
            out.clear()
            arrays = [pa.array(c, pa.int64()) for c in columns]
            return pa.RecordBatch.from_arrays(
                arrays,
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, tokens.TEXTS):
                rows = batch.slice(at, tokens.TEXTS)
                every, edges = encode(rows.column("text"), end_id)
                edges = edges.tolist()
                data = memoryview(every.astype("<u4").tobytes())
                for doc_id, a, b in zip(rows.column("doc_id").to_pylist(), edges, edges[1:]):
                    ids, total = data[4 * a : 4 * b], b - a
                    full = total - total % capacity
                    kept[number] = (doc_id, total, ids, 0)
                    for start in range(0, full, capacity):
                        emit([(number, start, capacity)])
                    if full < total:
                        kept[number] = (doc_id, total, bytes(ids[4 * full :]), full)
                        remaining.add(total - full, (number, full))
                    else:
                        del kept[number]
                    number += 1
                if remaining.size >= pool:
                    for window in remaining.drain():
                        emit(window)
                    alive = {doc for pieces in remaining.by_length.values() for doc, _ in pieces}
                    kept = {doc: kept[doc] for doc in alive}
                    if remaining.size >= pool // 2:  # lengths that no window can combine
                        for window in remaining.rest():
                            emit(window)
                        kept = {}
                if len(out) > 20_000:
                    yield flushed()
        for window in remaining.drain():
            emit(window)
        for window in remaining.rest():
            emit(window)
        yield flushed()

    source = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(run, PIECES)
