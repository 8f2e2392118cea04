"""SimHash near-duplicates found through Golay-code keys.

A fingerprint's 64 bits are cut into segments of 23, 23 and 18 bits. The binary Golay code
is perfect: every 23-bit word lies within 3 bits of exactly one codeword. A segment's keys
are the indices of the codewords that it and its one-bit neighbours decode to, at most
six; two segments that differ in at most 2 bits have a neighbour in common and so share a
key. If fingerprints differ in at most 4 bits, either no segment differs in more than 2, and
they share a key triple; or one differs in 3 or 4, and then of the others one is equal and
the other differs in at most 1: they share the equal segment with a key of the other.

Keys are dealt out to partitions, sorted, and verified where they meet. Fingerprints that
meet are linked by a forest, not by all pairs: a search from one fingerprint compares only
with those not reached yet. A key that more fingerprints share than one task should hold
is given out to a second step, which compares its blocks two by two.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed.llm.common import giving_back, run_starts, texts, written
from changefeed.llm.components import components

SHINGLE = 4
SEED = 42
MOST_BITS = 4
SEGMENTS = ((0, 23), (23, 23), (46, 18))  # first bit, width
GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
KEYS = 6
# Fingerprints of one key that one task compares.
BLOCK = 20_000


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """Bit i is 1 if more than half of the shingles' hashes have it."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends + 1 - lengths)[: len(tokens) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[width - 1 :].tolist(), strict=True)]
    by_byte = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    ones = np.unpackbits(by_byte, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def _row_hash() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def fingerprints(documents: DataFrame, *, width: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``row`` (a hash of id and text) and ``fp``, the fingerprint as a signed
    long; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, width) for t in texts(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(found.view(np.int64))], ["doc_id", "row", "fp"]
            )

    source = documents.select(
        F.col("doc_id").cast("long"), _row_hash().alias("row"), F.col("text").cast("string")
    )
    return source.mapInArrow(giving_back(run), "doc_id long, row long, fp long")


@lru_cache(maxsize=1)
def code_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits, and the error of each syndrome."""

    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    low = np.array([remainder(w) for w in range(1 << 12)], np.uint32)
    high = np.array([remainder(w << 12) for w in range(1 << 11)], np.uint32)
    errors = np.zeros(1 << 11, np.uint32)
    for weight in range(4):
        for bits in combinations(range(23), weight):
            error = sum(1 << b for b in bits)
            errors[remainder(error)] = error
    return low, high, errors


def decoded(segment: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword next to each 23-bit word."""
    low, high, errors = code_tables()
    syndrome = low[segment & np.uint32(0xFFF)] ^ high[segment >> np.uint32(12)]
    return (segment ^ errors[syndrome]) >> np.uint32(11)


def segment_keys(segment: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of each segment, at most six, and which of the six places hold one."""
    flips = np.array([0, *(1 << b for b in range(width))], np.uint32)
    every = np.sort(decoded(segment[:, None] ^ flips), axis=1)
    new = np.concatenate([np.ones((len(every), 1), bool), every[:, 1:] != every[:, :-1]], axis=1)
    place = np.cumsum(new, axis=1) - 1
    keys = np.zeros((len(every), KEYS), np.uint64)
    rows = np.broadcast_to(np.arange(len(every))[:, None], every.shape)
    keys[rows[new], place[new]] = every[new]
    return keys, np.arange(KEYS) <= place[:, -1:]


def all_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, fingerprint) for all keys of unsigned fingerprints; kinds of key in the top bits."""
    u = np.uint64
    parts = [(fps >> u(first) & u((1 << width) - 1)).astype(np.uint32) for first, width in SEGMENTS]
    found = [segment_keys(part, width) for part, (_, width) in zip(parts, SEGMENTS, strict=True)]
    (k0, m0), (k1, m1), (k2, m2) = found
    triples = (k0[:, :, None, None] << u(24)) | (k1[:, None, :, None] << u(12)) | k2[:, None, None, :]
    mask = m0[:, :, None, None] & m1[:, None, :, None] & m2[:, None, None, :]
    owner = np.broadcast_to(fps[:, None, None, None], mask.shape)
    keys, owners = [triples[mask]], [owner[mask]]
    for kind, (i, j) in enumerate(((0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1)), 1):
        kj, mj = found[j]
        key = u(kind << 36) | (parts[i].astype(np.uint64)[:, None] << u(12)) | kj
        keys.append(key[mj])
        owners.append(np.broadcast_to(fps[:, None], mj.shape)[mj])
    return np.concatenate(keys), np.concatenate(owners)


def forest(fps: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links that connect what links of at most ``most`` bits connect."""
    links, left = [], fps
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue[-1]) <= most
            node = queue.pop()
            reached = left[near]
            links.extend((int(node), int(x)) for x in reached)
            queue.extend(reached)
            left = left[~near]
    return links


def between(first: np.ndarray, second: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links between two blocks, enough to connect what links between them connect."""
    links, left = [], second
    open_first = first
    # A search that alternates sides: each fingerprint is reached once.
    while len(open_first) and len(left):
        queue, open_first = [(open_first[0], True)], open_first[1:]
        while queue:
            node, of_first = queue.pop()
            others = left if of_first else open_first
            near = np.bitwise_count(others ^ node) <= most
            reached = others[near]
            links.extend((int(node), int(x)) for x in reached)
            queue.extend((x, not of_first) for x in reached)
            if of_first:
                left = others[~near]
            else:
                open_first = others[~near]
    return links


LINKS = "a long, b long, key long"


def _batch(rows: np.ndarray, keys: np.ndarray | None = None) -> pa.RecordBatch:
    """Links (two columns of fingerprints), or fingerprints with a key for the second step."""
    n = len(rows)
    if keys is None:
        rows = np.unique(np.sort(rows.reshape(-1, 2), axis=1), axis=0).view(np.int64)
        columns = [pa.array(rows[:, 0]), pa.array(rows[:, 1]), pa.nulls(len(rows), pa.int64())]
    else:
        columns = [pa.array(rows.view(np.int64)), pa.nulls(n, pa.int64()), pa.array(keys.view(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "key"])


def _linker(most: int, block: int):
    """Links of fingerprints that share a key; the rows come sorted by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        passing: int | None = None  # the key whose fingerprints go to the second step

        def linked(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Whole runs."""
            starts = run_starts(keys)
            sizes = np.diff(np.append(starts, len(keys)))
            of_run = np.repeat(sizes, sizes)
            found = []
            small = np.flatnonzero(of_run <= 8)
            for step in range(1, min(8, int(sizes.max(initial=1)))):
                i = small[: len(small)]
                i = i[i + step < len(keys)]
                i = i[keys[i] == keys[i + step]]
                i = i[np.bitwise_count(fps[i] ^ fps[i + step]) <= most]
                found.append(np.stack([fps[i], fps[i + step]], axis=1))
            for at in np.flatnonzero(sizes > 8):
                run_fps = fps[starts[at] : starts[at] + sizes[at]]
                if len(run_fps) > block:
                    yield _batch(run_fps, np.full(len(run_fps), keys[starts[at]]))
                elif links := forest(run_fps, most):
                    found.append(np.array(links, np.uint64))
            if found and sum(map(len, found)):
                yield _batch(np.concatenate(found))

        for batch in batches:
            more_keys = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
            more_fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            keys, fps = np.concatenate([keys, more_keys]), np.concatenate([fps, more_fps])
            if passing is not None:
                same = int(np.searchsorted(keys != np.uint64(passing), True))
                if same:
                    yield _batch(fps[:same], keys[:same])
                keys, fps = keys[same:], fps[same:]
                if len(keys):
                    passing = None
            if not len(keys):
                continue
            last = int(run_starts(keys)[-1])
            yield from linked(keys[:last], fps[:last])
            keys, fps = keys[last:], fps[last:]
            if len(keys) > block:
                passing = int(keys[0])
                yield _batch(fps, keys)
                keys, fps = keys[:0], fps[:0]
        yield from linked(keys, fps)

    return run


def _block_linker(most: int):
    """Links within and between two blocks of the fingerprints of one key."""

    def run(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        side = table.column("side").to_numpy()
        first, second = np.unique(fps[side == 0]), np.unique(fps[side == 1])
        links = between(first, second, most) if len(second) else forest(first, most)
        rows = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.table({"a": pa.array(rows[:, 0]), "b": pa.array(rows[:, 1])})

    return run


def links(fps: DataFrame, *, most: int = MOST_BITS, block: int = BLOCK) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct fingerprints (column ``fp``) that connect the same
    sets as all pairs within ``most`` bits, which must not exceed 4."""
    if most > MOST_BITS:
        raise ValueError(f"the keys are made for at most {MOST_BITS} bits")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(every), 1_000):
                keys, owners = all_keys(every[at : at + 1_000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(owners.view(np.int64))], ["key", "fp"]
                )

    rows = fps.select("fp").mapInArrow(giving_back(keyed), "key long, fp long")
    dealt = rows.repartition("key").sortWithinPartitions("key")
    found = written(dealt.mapInArrow(giving_back(_linker(most, block)), LINKS), "links")
    large = found.where("key IS NOT NULL").select("key", F.col("a").alias("fp"))
    direct = found.where("key IS NULL").select("a", "b")
    if large.isEmpty():
        return direct
    # Block i of a key meets every block j >= i of it once; rows are dealt out by a hash.
    counts = large.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    placed = large.join(counts, "key").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    met = placed.select(
        "key", "fp", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    ).select(
        "key",
        "fp",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"),
    )
    more = met.groupBy("key", "i", "j").applyInArrow(_block_linker(most), "a long, b long")
    return direct.unionByName(more)


def linked_rows(
    documents: DataFrame, *, most: int = MOST_BITS, width: int = SHINGLE, block: int = BLOCK
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with their fingerprint (and a hash of id and text), the fingerprints once, and
    the links between them."""
    marked = written(fingerprints(documents, width=width), "fingerprints")
    distinct = written(marked.select("fp").distinct(), "distinct-fingerprints")
    return marked, distinct, links(distinct, most=most, block=block)


def _rooted(documents: DataFrame, **options: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their fingerprint (and a hash of id and text), and fingerprints with their root."""
    marked, distinct, linked = linked_rows(documents, **options)
    labels = components(linked)
    roots = distinct.join(labels, distinct["fp"] == labels["node"], "left").select(
        F.col("fp").alias("__fp"), F.coalesce("label", "fp").alias("root")
    )
    return marked, roots


def near_groups(documents: DataFrame, **options: int) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id`` of every document.

    Documents are linked if their fingerprints differ in at most ``most`` bits; the
    component is the smallest ``doc_id`` reachable. Texts without words (null, empty) have
    fingerprint zero and are linked like any others. A null ``doc_id`` takes part and is
    never the smallest. Repeated rows are linked with each other. No rows give no rows.
    """
    marked, roots = _rooted(documents, **options)
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = least.join(roots, F.col("fp") == F.col("__fp")).select("__fp", "root", "least")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = rooted.drop("least").join(smallest, "root").drop("root")
    return marked.join(of_fp, F.col("fp") == F.col("__fp")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def without_near_copies(documents: DataFrame, **options: int) -> DataFrame:
    """One document of each group, with the columns it came with: the smallest ``doc_id``,
    of equal ids the text that hashes lowest, of equal rows one; null ids come last."""
    marked, roots = _rooted(documents, **options)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    least = marked.groupBy("fp").agg(first)
    keep = (
        least.join(roots, F.col("fp") == F.col("__fp"))
        .groupBy("root")
        .agg(F.min("first").alias("first"))
        .select(F.col("first.row").alias("__row"))
    )
    keyed = documents.withColumn("__row", _row_hash())
    return keyed.join(keep, "__row", "left_semi").dropDuplicates(["__row"]).select(*documents.columns)
