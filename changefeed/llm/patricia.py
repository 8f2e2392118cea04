"""Exact duplicates by Patricia tries of whole normalised texts.

Texts are dealt out by byte length and content hash. A task inserts the full byte strings
it gets into a compressed radix trie whose terminal nodes hold how many rows ended there
and the identifier that owns the text. The same step runs before the shuffle, so a text
that a third of all rows share leaves each task once. When a trie's labels and nodes pass the
memory bound, its heaviest subtree is given out and forgotten ("spilled"); since counts
add and owners compare, a later step merges what was given out in parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed.llm.common import ascii_lower, giving_back

# Memory that a trie holds, labels and nodes, before it gives out a subtree.
TRIE_BYTES = 128 << 20
# What a node takes beside the bytes of its label: the object, the table of its children
# (a branch of two or more takes 200 and more), the byte string's head, owner and count.
NODE_BYTES = 320


class Node:
    __slots__ = ("label", "children", "rows", "owner")

    def __init__(self, label: bytes) -> None:
        self.label = label
        self.children: dict[int, Node] | None = None
        self.rows = 0
        self.owner: int | None = None


def shared_length(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    def __init__(self, keep: str) -> None:
        self.root = Node(b"")
        self.bytes = 0
        self.better = max if keep == "max" else min

    def insert(self, text: bytes, owner: int | None, rows: int) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at]) if node.children else None
            if child is None:
                child = Node(text[at:])
                node.children = node.children or {}
                node.children[text[at]] = child
                self.bytes += len(text) - at + NODE_BYTES
                node, at = child, len(text)
                break
            if text.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            common = shared_length(child.label, text[at : at + len(child.label)])
            fork = Node(child.label[:common])
            child.label = child.label[common:]
            fork.children = {child.label[0]: child}
            node.children[text[at]] = fork
            self.bytes += NODE_BYTES
            node, at = fork, at + common
        node.rows += rows
        if owner is not None:
            node.owner = owner if node.owner is None else self.better(node.owner, owner)

    def drain(self, start: Node | None = None, prefix: bytes = b"") -> Iterator[tuple[bytes, int | None, int]]:
        """The texts that end at or below a node, with owner and number of rows."""
        stack = [(start or self.root, prefix)]
        while stack:
            node, before = stack.pop()
            text = before + node.label
            if node.rows:
                yield text, node.owner, node.rows
            stack.extend((child, text) for child in (node.children or {}).values())

    def spill(self) -> Iterator[tuple[bytes, int | None, int]]:
        """Give out and forget the heaviest subtree of the root."""

        def weight(top: Node) -> int:
            total, stack = 0, [top]
            while stack:
                node = stack.pop()
                total += len(node.label) + NODE_BYTES
                stack.extend((node.children or {}).values())
            return total

        first, heaviest = max(self.root.children.items(), key=lambda item: weight(item[1]))
        self.bytes -= weight(heaviest)
        del self.root.children[first]
        yield from self.drain(heaviest)


def _merged(keep: str, trie_bytes: int, digest: bool):
    """The trie step over a partition; ``digest`` replaces the text by its SHA-256."""
    # Before the shuffle the text travels on, after it only its digest does.
    names = ["digest" if digest else "text", "owner", "rows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(keep)

        def out(found: Iterator[tuple[bytes, int | None, int]]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for text, owner, rows in found:
                held.append((hashlib.sha256(text).hexdigest() if digest else text, owner, rows))
                size += len(text)
                if len(held) >= 5_000 or size >= 8 << 20:
                    yield batch_of(held)
                    held, size = [], 0
            if held:
                yield batch_of(held)

        def batch_of(held: list[tuple]) -> pa.RecordBatch:
            key, owners, rows = zip(*held, strict=True)
            first = pa.array(key, pa.string() if digest else pa.binary())
            return pa.RecordBatch.from_arrays(
                [first, pa.array(owners, pa.int64()), pa.array(rows, pa.int64())], names
            )

        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("text", "owner", "rows"))
            for text, owner, rows in zip(*columns, strict=True):
                trie.insert(text, owner, rows)
                if trie.bytes > trie_bytes:
                    yield from out(trie.spill())
        yield from out(trie.drain())

    return run


def normalised(text: Column) -> Column:
    """A-Z lower-cased; null is the empty text."""
    return ascii_lower(F.coalesce(text, F.lit("")))


def owners(documents: DataFrame, *, keep: str = "min", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per distinct text: its SHA-256, the row that owns it, how many rows share it."""
    if keep not in ("min", "max"):
        raise ValueError("keep is min or max")
    source = documents.select(
        normalised(F.col("text")).cast("binary").alias("text"),
        F.col("doc_id").cast("long").alias("owner"),
        F.lit(1).cast("long").alias("rows"),
    )
    local = source.mapInArrow(giving_back(_merged(keep, trie_bytes, False)), "text binary, owner long, rows long")
    dealt = local.repartition(F.octet_length("text"), F.xxhash64("text"))
    parts = dealt.mapInArrow(giving_back(_merged(keep, trie_bytes, True)), "digest string, owner long, rows long")
    best = F.max("owner") if keep == "max" else F.min("owner")
    return parts.groupBy("digest").agg(best.alias("owner"), F.sum("rows").alias("rows"))


def _owned(documents: DataFrame, keep: str, trie_bytes: int) -> DataFrame:
    """The documents with the digest, owner and number of rows of their text."""
    found = owners(documents, keep=keep, trie_bytes=trie_bytes).select(
        F.col("digest").alias("__digest"), F.col("owner").alias("__owner"), F.col("rows").alias("__rows")
    )
    keyed = documents.withColumn("__digest", F.sha2(normalised(F.col("text")).cast("binary"), 256))
    return keyed.join(found, "__digest")


def judged(documents: DataFrame, *, keep: str = "min", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """All columns of the documents with ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Null texts equal empty ones. A null ``doc_id`` never owns a text that a row with an id
    has; if no row has one, ``keep_id`` is null and every row of the group stays. Rows that
    repeat the owning ``doc_id`` all stay. No rows give no rows. Columns of the input
    with these four names are replaced.
    """
    rest = documents.drop("keep_id", "group_size", "kept", "text_sha256")
    return _owned(rest, keep, trie_bytes).select(
        *rest.columns,
        F.col("__owner").alias("keep_id"),
        F.col("__rows").alias("group_size"),
        F.col("doc_id").cast("long").eqNullSafe(F.col("__owner")).alias("kept"),
        F.col("__digest").alias("text_sha256"),
    )


def without_copies(documents: DataFrame, *, keep: str = "max") -> DataFrame:
    """The documents that own their text; one row of each group of equal texts.

    Rows that repeat the owning id have equal texts and are kept once.
    """

    def keys(doc_id: str, digest: Column) -> dict[str, Column]:
        number = F.col(doc_id).cast("long")
        return {
            "__number": F.coalesce(number, F.lit(0).cast("long")),
            "__unnumbered": number.isNull(),
            # Never null, so that the join does not compute it once more to check.
            "__digest": F.coalesce(digest, F.lit("")),
        }

    mine = keys("owner", F.col("digest"))
    found = owners(documents, keep=keep).select(*[c.alias(name) for name, c in mine.items()])
    by = list(mine)
    digest = F.sha2(normalised(F.col("text")).cast("binary"), 256)
    keyed = documents.withColumns(keys("doc_id", digest))
    # Joined by the very columns that drop repeated rows, so the texts move once here.
    return keyed.join(found, by, "left_semi").dropDuplicates(by).select(*documents.columns)
