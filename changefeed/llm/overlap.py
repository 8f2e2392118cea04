"""Near copies by the Jaccard similarity of their shingle sets.

Candidates share a band of MinHash values: 40 bands of 6, so a pair with a similarity of 0.8
shares none with a probability of (1 - 0.8^6)^40 < 1e-5. One byte of each of the 240 values is
kept as a signature; a pair is compared further if two thirds of the bytes agree, which a pair
at 0.8 misses by five standard deviations. Every link is verified on the sets themselves.

Pairs that op6's fingerprints link (``golay``) are candidates, too, whatever their bands.

No pairs of a band are listed. In two rounds a text of each band, another one in every band
and round, is a candidate for the others whose signatures agree with its own, and each text is
compared with the likeliest of its candidates of another group; this joins most of a large
group by as many pairs as it has texts. Then what is still apart is compared with one text in
every band and with what the fingerprints link it to. Last, the texts of a band that are not
linked yet meet in a task, in blocks of bounded size, which keeps those whose signatures agree
with one of another group; their sets are compared in a task, too, which returns as many links
as join them. Texts with equal sets are one node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.llm.common import fresh, giving_back, mixed, run_starts, texts, window_hashes, word_hashes, written
from changefeed.llm.components import components
from changefeed.llm.golay import _row_hash, linked_rows

SHINGLE = 5
LEAST = 0.8
BANDS, ROWS = 40, 6
# Share of equal signature bytes from which a pair is compared on its sets.
LIKELY = 0.66
# Shingles whose MinHash values are made in one go.
SHINGLES = 2_048
# Nodes of a band that meet in one task; more are dealt into blocks, and all pairs of blocks meet.
BLOCK = 4_096
# Rounds in which each node is compared with one other.
ROUNDS = 2

_RANDOM = np.random.default_rng(11)
_TIMES = _RANDOM.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RANDOM.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
_BAND = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))


def shingle_sets(group: list[bytes], width: int) -> Iterator[np.ndarray]:
    """The sorted hashes of the shingles of each text; a shorter text is one shingle."""
    for hashes in word_hashes([text.lower() for text in group]):
        yield np.unique(window_hashes(hashes, min(width, len(hashes)))) if len(hashes) else hashes


def lowest_values(shingles: np.ndarray) -> np.ndarray:
    """The MinHash values of a set."""
    lowest = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), SHINGLES):
        values = shingles[at : at + SHINGLES, None] * _TIMES + _PLUS
        np.minimum(lowest, values.min(axis=0), out=lowest)
    return mixed(lowest)


def band_keys(lowest: np.ndarray) -> np.ndarray:
    """A key for each band of the MinHash values."""
    return mixed(window_hashes(lowest, ROWS)[::ROWS] ^ _BAND)


def marks(documents: DataFrame, width: int) -> DataFrame:
    """``doc_id``, ``row`` (a hash of id and text), ``node`` (a hash of the set), ``keys``, ``signature``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, keys, signatures = [], [], []
            for found in shingle_sets(texts(batch.column("text")), width):
                nodes.append(mixed(mixed(found).sum(dtype=np.uint64) + np.uint64(len(found))))
                lowest = lowest_values(found)
                keys.append(band_keys(lowest))
                signatures.append(lowest.astype(np.uint8).tobytes())
            values = np.concatenate([np.zeros(0, np.uint64), *keys]).view(np.int64)
            edges = pa.array(np.arange(0, len(values) + 1, BANDS), pa.int32())
            columns = [
                batch.column("doc_id"),
                batch.column("row"),
                pa.array(np.array(nodes, np.uint64).view(np.int64)),
                pa.ListArray.from_arrays(edges, pa.array(values)),
                pa.array(signatures, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "node", "keys", "signature"])

    source = documents.select(F.col("doc_id").cast("long"), _row_hash().alias("row"), F.col("text").cast("string"))
    return source.mapInArrow(giving_back(run), "doc_id long, row long, node long, keys array<long>, signature binary")


def _whole_runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[np.ndarray]]:
    """Columns of whole runs of the first one; the rows come sorted by it."""
    parts: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        more = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        if parts and parts[0][0][0] == more[0][-1]:
            parts.append(more)
            continue
        columns = [np.concatenate(c) for c in zip(*parts, more, strict=True)]
        last = int(run_starts(columns[0])[-1])
        parts = [[c[last:] for c in columns]]
        if last:
            yield [c[:last] for c in columns]
    if parts:
        yield [np.concatenate(c) for c in zip(*parts, strict=True)]


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the keys that several have, with their number. A key's nodes take 16 bytes each."""
    for keys, nodes in _whole_runs(batches, ["key", "node"]):
        sizes = np.diff(np.append(run_starts(keys), len(keys)))
        number = np.repeat(sizes, sizes)
        several = number > 1
        columns = [keys[several], nodes[several], number[several]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "node", "number"])


def _matrix(column: pa.Array) -> np.ndarray:
    """Signatures as the rows of a matrix of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first node ``a`` of each key with each other one ``b`` of another label that its
    signature agrees with, and the share of equal bytes."""
    key = node = label = signature = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, nodes, labels = (batch.column(c).to_numpy() for c in ("key", "node", "label"))
        rows = _matrix(batch.column("signature"))
        starts = run_starts(keys)
        sizes = np.diff(np.append(starts, len(keys)))
        first, of_first, pivot = (np.repeat(v[starts], sizes, axis=0) for v in (nodes, labels, rows))
        if key == keys[0]:  # the key of the batch before goes on
            first[: sizes[0]], of_first[: sizes[0]], pivot[: sizes[0]] = node, label, signature
        key, node, label, signature = keys[-1], first[-1], of_first[-1], pivot[-1].copy()
        share = (rows == pivot).mean(axis=1)
        alike = (share >= LIKELY) & (of_first != labels)
        yield pa.RecordBatch.from_arrays([pa.array(c[alike]) for c in (first, nodes, share)], ["a", "b", "share"])


def pivots(shared: DataFrame, labels: DataFrame, number: int) -> DataFrame:
    """Pairs of the nodes of each key with the one of them that comes first in this round."""
    rows = with_labels(shared, labels, "node", "label")
    dealt = rows.withColumn("order", F.xxhash64("key", "node", F.lit(number)))
    dealt = dealt.repartition("key").sortWithinPartitions("key", "order").select("key", "node", "label", "signature")
    return dealt.mapInArrow(giving_back(_pivots), "a long, b long, share double")


def _across(labels: np.ndarray, side: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each row with the later ones of another label, and of the other side if there are two, that it may be linked with.

    The rows of the most frequent label are not compared with each other, only with the rest.
    """
    names, code = np.unique(labels, return_inverse=True)
    if len(names) < 2:
        return
    frequent = np.bincount(code).argmax()
    ask = np.flatnonzero(code != frequent)
    two_sided = side.any()
    for at in ask.tolist():
        other = code != code[at]
        if two_sided:
            other &= side != side[at]
        # A pair of two asking rows is met once.
        other &= (code == frequent) | (np.arange(len(code)) > at)
        found = np.flatnonzero(other)
        alike = (rows[found] == rows[at]).sum(axis=1) >= LIKELY * rows.shape[1]
        if alike.any():
            yield at, found[alike]


def _unsettled(table: pa.Table) -> pa.Table:
    """The rows of a meeting whose signature agrees with one of another label."""
    labels, side = table.column("label").to_numpy(), table.column("side").to_numpy()
    if labels.min() == labels.max():
        return table.slice(0, 0)
    used = np.zeros(len(labels), bool)
    for at, others in _across(labels, side, _matrix(table.column("signature"))):
        used[at] = used[others] = True
    return table.filter(pa.array(used))


def _settled(least: float):
    """Links that join the rows of a meeting as all similar pairs do."""

    def run(table: pa.Table) -> pa.Table:
        nodes, labels, side = (table.column(c).to_numpy() for c in ("node", "label", "side"))
        sets = [np.frombuffer(v, np.uint64) for v in table.column("shingles").to_pylist()]
        names, group = np.unique(labels, return_inverse=True)
        a, b = [], []
        for at, others in _across(labels, side, _matrix(table.column("signature"))):
            for other in others.tolist():
                if group[at] == group[other]:
                    continue
                one, two = sets[at], sets[other]
                if min(len(one), len(two)) < least * max(len(one), len(two)) - 1e-9:
                    continue
                both = len(np.intersect1d(one, two, assume_unique=True))
                if both >= least * (len(one) + len(two) - both) - 1e-9:
                    group[group == group[other]] = group[at]
                    a.append(nodes[at])
                    b.append(nodes[other])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets are at least as similar as ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            sets = (batch.column(c).to_pylist() for c in ("sa", "sb"))
            for i, (one, two) in enumerate(zip(*sets, strict=True)):
                # The similarity cannot pass the smaller size over the larger one.
                if min(len(one), len(two)) >= least * max(len(one), len(two)) - 1e-6:
                    one, two = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                    both = len(np.intersect1d(one, two, assume_unique=True))
                    keep[i] = both >= least * (len(one) + len(two) - both) - 1e-9
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    ones = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    others = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    joined = pairs.join(ones, "a").join(others, "b").select("a", "b", "sa", "sb")
    return joined.mapInArrow(giving_back(run), "a long, b long")


def with_labels(rows: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    """The rows with the label of ``node`` as ``name``; a node without one is its own."""
    found = labels.select(F.col("node").alias("__node"), F.col("label").alias("__label"))
    joined = rows.join(found, F.col(node) == F.col("__node"), "left")
    return joined.withColumn(name, F.coalesce("__label", node)).drop("__node", "__label")


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs of nodes with different labels, which ``one`` and ``two`` give."""
    both = with_labels(with_labels(pairs.select("a", "b"), labels, "a", "one"), labels, "b", "two")
    return both.where("one <> two")


def merged(labels: DataFrame, pairs: DataFrame) -> DataFrame:
    """The labels when the pairs link their nodes, too; only links between labels are walked."""
    between = apart(pairs, labels).select(F.col("one").alias("a"), F.col("two").alias("b"))
    onward = components(between)
    found = with_labels(labels.withColumnRenamed("label", "old"), onward, "old", "label")
    return written(found.select("node", "label"), "near-labels")


def meetings(labelled: DataFrame, block: int) -> DataFrame:
    """The nodes of keys with several labels, dealt so that each two blocks of a key meet once.

    ``key``, ``i`` and ``j`` name a meeting; ``side`` tells the two blocks apart.
    """
    mixed_keys = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    open_rows = labelled.join(mixed_keys.where("low < high").select("key"), "key", "left_semi")
    placed = open_rows.withColumn("blocks", F.ceil(F.col("number") / block)).withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("blocks"))
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    return placed.select("key", "node", "label", "signature", "own", other).select(
        "key",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"),
        "node",
        "label",
        "signature",
    )


def by_fingerprint(documents: DataFrame, marked: DataFrame) -> DataFrame:
    """The pairs of nodes that op6's fingerprints link: nodes of one fingerprint with the
    lowest of them, and the lowest ones of two linked fingerprints."""
    rows, _, linked = linked_rows(documents)
    of_fp = marked.select("row", "node").join(rows.select("row", "fp"), "row").select("fp", "node").distinct()
    of_fp = written(of_fp, "fingerprint-nodes")
    lowest = of_fp.groupBy("fp").agg(F.min("node").alias("low"))
    one, two = (lowest.select(F.col("fp").alias(n), F.col("low").alias(f"low_{n}")) for n in "ab")
    across = linked.select("a", "b").join(one, "a").join(two, "b").select("low_a", "low_b")
    pairs = of_fp.join(lowest, "fp").select("low", "node").union(across).toDF("a", "b").where("a <> b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def groups(documents: DataFrame, marked: DataFrame, width: int, least: float, *, block: int = BLOCK) -> DataFrame:
    """``node`` and ``label`` of the groups that all pairs of a similarity of ``least`` connect;
    nodes that share nothing are left out."""
    linked = written(by_fingerprint(documents, marked), "fingerprint-pairs")
    nodes = marked.groupBy("node").agg(F.first("keys").alias("keys"))
    dealt = nodes.select("node", F.explode("keys").alias("key")).repartition("key").sortWithinPartitions("key")
    found = written(dealt.mapInArrow(giving_back(_shared), "key long, node long, number long"), "shared-bands")
    ids = found.select("node").union(linked.select("a")).union(linked.select("b")).distinct()
    of_node = ids.join(
        marked.groupBy("node").agg(F.min("row").alias("row"), F.first("signature").alias("signature")), "node"
    )
    of_node = written(of_node, "shared-nodes")
    shared = written(found.join(of_node.select("node", "signature"), "node"), "shared-signatures")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [s.tobytes() for s in shingle_sets(texts(batch.column("text")), width)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(packed, pa.binary())], ["node", "shingles"])

    rows = of_node.select("row", "node")
    source = documents.select(_row_hash().alias("row"), F.col("text").cast("string")).join(rows, "row")
    source = source.dropDuplicates(["row"]).select("node", "text")
    sets = written(source.mapInArrow(giving_back(sets_of), "node long, shingles binary"), "shingle-sets")

    labels = of_node.select("node", F.col("node").alias("label"))
    for number in range(ROUNDS):  # of a node's candidates the likeliest one
        likeliest = F.max_by("a", F.struct("share", "a")).alias("a")
        best = pivots(shared, labels, number).groupBy("b").agg(likeliest)
        labels = merged(labels, written(verified(best, sets, least), "near-pivots"))
    # All that this leaves apart, and the links of the fingerprints.
    rest = pivots(shared, labels, ROUNDS).select("a", "b").unionByName(apart(linked, labels).select("a", "b"))
    rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    labels = merged(labels, written(verified(rest, sets, least), "near-pivots"))
    met = meetings(with_labels(shared, labels, "node", "label"), block)
    names = ["key", "i", "j"]
    rows = "key long, i long, j long, side int, node long, label long, signature binary"
    unsettled = written(met.groupBy(*names).applyInArrow(_unsettled, rows), "unsettled")
    more = unsettled.join(sets, "node").groupBy(*names).applyInArrow(_settled(least), "a long, b long")
    return merged(labels, written(more, "near-links"))


def without_near_copies(
    documents: DataFrame, *, width: int = SHINGLE, least: float = LEAST, block: int = BLOCK
) -> DataFrame:
    """One document of each linked group, with the columns it came with: the smallest
    ``doc_id``, of equal ids the text that hashes lowest, of equal rows one; null ids come
    last. Texts without words (null, empty) are one group. No rows give no rows. Rows are
    known by one 64-bit hash of id and text."""
    marked = written(marks(documents, width), "band-keys")
    labels = groups(documents, marked, width, least, block=block).withColumnRenamed("node", "__node")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    lowest = marked.groupBy("node").agg(first)
    keep = (
        lowest.join(labels, F.col("node") == F.col("__node"), "left")
        .groupBy(F.coalesce("label", "node"))
        .agg(F.min("first").alias("first"))
        .select(F.col("first.row").alias("row"))
    )
    row = fresh(documents.columns, "__row")
    keyed = documents.withColumn(row, _row_hash())
    kept = keyed.join(keep.withColumnRenamed("row", row), row, "left_semi")
    return kept.dropDuplicates([row]).select(*documents.columns)
