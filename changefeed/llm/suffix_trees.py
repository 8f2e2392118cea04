"""Substring dedup by suffix trees over groups of suffixes that share a prefix.

A window is ``width`` consecutive words; a suffix is what follows from a window's start. Two
suffixes are below the same internal node of depth ``width`` or more exactly if their
windows are equal, so the deep internal nodes give the repeated passages, and the smallest
document below a node is the one that keeps its copy.

Suffixes are split by a prefix of variable length: it reaches from the suffix's start to
the end of the five words in its window that hash lowest (its anchor). Equal windows have
equal prefixes. Neighbouring suffixes mostly share the anchor, so all suffixes whose
prefixes end in an anchor form a group, and a run of neighbours travels as one text:

1. Anchors that only one document has cannot lie in a repeat. Each task sends each of its
   anchors once, with its smallest document; anchors of two documents come back.
2. The tasks find the suffixes at these anchors. A window that a task has met in several
   documents is settled there but for the smallest one, so a passage that a third of all
   documents share leaves each task once. The rest are dealt out by anchor. Where an anchor
   has more documents than a task should hold, the prefix is lengthened to the whole window.
3. A task sorts the suffixes of a group by words. The common prefixes of neighbours give the
   internal nodes; those of depth ``width`` or more that also differ in the word before are the
   maximal repeats, and all documents below one but the smallest lose the passage.
4. Words covered by a settled window are removed from the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.llm.common import mixed, run_starts, texts, window_hashes, word_hashes

WIDTH = 13
ANCHOR = 5
# Documents of an anchor beyond which its suffixes are grouped by whole windows.
MOST_IN_GROUP = 4_096


def anchors(hashes: np.ndarray, width: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window the place of its anchor, and the anchors' hashes by place."""
    by_place = window_hashes(hashes, anchor)
    if len(hashes) < width:
        return np.zeros(0, np.int64), by_place
    places = sliding_window_view(by_place, width - anchor + 1).argmin(axis=1)
    return places + np.arange(len(places)), by_place


def hashes_at(hashes: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` values from each place on."""
    total = np.zeros(len(places), np.uint64)
    for k in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[places + k]
    return mixed(total)


def _among(values: np.ndarray, some: np.ndarray) -> np.ndarray:
    if not len(some):
        return np.zeros(len(values), bool)
    some = np.sort(some)
    return some[np.minimum(np.searchsorted(some, values), len(some) - 1)] == values


def _dealt(bucket: np.ndarray, buckets: int, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per bucket with the bytes of its part of each column."""
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        part = order[edges[b] : edges[b + 1]]
        data = [pa.array([c[part].tobytes()], pa.binary()) for c in columns]
        names = [f"c{i}" for i in range(len(columns))]
        yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), *data], ["bucket", *names])


def repeated_anchors(
    documents: DataFrame, *, width: int, anchor: int, most_in_group: int, buckets: int
) -> DataFrame:
    """``doc_id``, ``anchor`` and ``hot`` for anchors that more than one document has."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, owner = [], []
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc_id, words in zip(ids, word_hashes(texts(batch.column("text"))), strict=True):
                places, by_place = anchors(words, width, anchor)
                if len(places):
                    own = np.unique(by_place[places])
                    found.append(own)
                    owner.append(np.full(len(own), doc_id, np.int64))
        if not found:
            return
        keys, docs = np.concatenate(found), np.concatenate(owner)
        order = np.lexsort((docs, keys))
        keys, docs = keys[order], docs[order]
        starts = run_starts(keys)
        sizes = np.diff(np.append(starts, len(keys)))
        # One row per anchor, its smallest document and how many it has here; then the
        # other documents of anchors that are known to repeat, dealt out by document.
        many = np.repeat(docs[starts], sizes) != docs
        count = np.where(np.isin(np.arange(len(keys)), starts), np.repeat(sizes, sizes), 0)
        first = count > 0
        multiple = np.add.reduceat(many, starts) > 0
        count[starts] = np.where(multiple, np.maximum(count[starts], 2), 1)
        send_rows = first | many
        bucket = np.where(first, keys % np.uint64(buckets), mixed(docs.view(np.uint64)) % np.uint64(buckets))
        yield from _dealt(
            bucket[send_rows].astype(np.int64), buckets, keys[send_rows], docs[send_rows], count[send_rows]
        )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = [[], [], []]
        for batch in batches:
            for i, kind in enumerate((np.uint64, np.int64, np.int64)):
                parts[i].extend(np.frombuffer(v, kind) for v in batch.column(f"c{i}").to_pylist())
        if not parts[0]:
            return
        keys, docs, count = map(np.concatenate, parts)
        sent_on = count == 0
        met = ~sent_on
        order = np.argsort(keys[met], kind="stable")
        k, d, n = keys[met][order], docs[met][order], count[met][order]
        starts = run_starts(k)
        sizes = np.diff(np.append(starts, len(k)))
        if len(starts):
            total = np.add.reduceat(n, starts)
            apart = np.minimum.reduceat(d, starts) != np.maximum.reduceat(d, starts)
            repeated = np.repeat(apart | (np.maximum.reduceat(n, starts) > 1), sizes)
            hot = np.repeat(total > most_in_group, sizes)
        else:
            repeated = hot = np.zeros(0, bool)
        out_keys = np.concatenate([k[repeated], keys[sent_on]]).view(np.int64)
        out_docs = np.concatenate([d[repeated], docs[sent_on]])
        # The documents sent on learn from the row of their task whether it is hot.
        out_hot = np.concatenate([hot[repeated], np.zeros(int(sent_on.sum()), bool)])
        for at in range(0, len(out_keys), 100_000):
            to = at + 100_000
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_docs[at:to]), pa.array(out_keys[at:to]), pa.array(out_hot[at:to])],
                ["doc_id", "anchor", "hot"],
            )

    sent = documents.mapInArrow(send, "bucket int, c0 binary, c1 binary, c2 binary")
    return sent.repartition(buckets, "bucket").mapInArrow(meet, "doc_id long, anchor long, hot boolean")


# ``also`` are places of the same document with the same window.
RUNS = "key long, doc_id long, text_hash long, start int, windows int, run binary, also binary"


def _suffix_runs(width: int, anchor: int):
    """Runs of suffixes to be compared, and windows settled here (``run`` null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, hashes_of, bodies, lasts = [], [], [], 0
        window, anchored, place, at, hot = [], [], [], [], []
        ordinal, offset = [], []
        for batch in batches:
            columns = [batch.column(c) for c in ("doc_id", "text_hash", "anchors", "hot")]
            some = [i for i in range(batch.num_rows) if columns[2][i].is_valid]
            with_some = texts(batch.column("text").take(pa.array(some, pa.int64())))
            for i, text, words in zip(some, with_some, word_hashes(with_some), strict=True):
                found = columns[2][i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                places, by_place = anchors(words, width, anchor)
                if not len(places):
                    continue
                of_window = by_place[places]
                here = np.flatnonzero(_among(of_window, found))
                if not len(here):
                    continue
                long = columns[3][i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                window.append(hashes_at(words, here, width))
                anchored.append(of_window[here])
                hot.append(_among(of_window[here], long))
                place.append(places[here])
                at.append(here)
                ordinal.append(np.full(len(here), len(docs)))
                offset.append(here + lasts)
                docs.append((columns[0][i].as_py(), columns[1][i].as_py()))
                hashes_of.append(words)
                bodies.append(text)
                lasts += len(words)
        if not docs:
            return
        every = np.concatenate(hashes_of)
        del hashes_of
        window, anchored, place, at, hot, ordinal, offset = map(
            np.concatenate, (window, anchored, place, at, hot, ordinal, offset)
        )
        ids = np.array([d for d, _ in docs], np.int64)[ordinal]
        order = np.lexsort((offset, ids, window))
        starts = run_starts(window[order])
        sizes = np.diff(np.append(starts, len(order)))
        lead = np.repeat(order[starts], sizes)  # the smallest document's occurrence
        same = order != lead
        for k in range(width):  # equal hashes may still be different words
            same &= every[offset[order] + k] == every[offset[lead] + k]
        done = np.zeros(len(order), bool)
        done[order] = same & (ids[order] > ids[lead])
        # Further places of the window in its smallest document share the first one's fate.
        repeats = same & (ordinal[order] == ordinal[lead])
        shadow = np.zeros(len(order), bool)
        shadow[order[repeats]] = True
        also: dict[int, list[int]] = {}
        for first, place_again in zip(lead[repeats].tolist(), at[order[repeats]].tolist(), strict=True):
            also.setdefault(first, []).append(place_again)
        alone = hot.copy()
        alone[list(also)] = True

        def stretches(which: np.ndarray, apart: np.ndarray | None) -> Iterator[tuple[int, int]]:
            """First index and length of neighbours in the same document (and group)."""
            if not len(which):
                return
            new = (np.diff(offset[which]) != 1) | (np.diff(ordinal[which]) != 0)
            if apart is not None:
                new |= (np.diff(place[which]) != 0) | apart[which][1:] | apart[which][:-1]
            first = np.flatnonzero(np.r_[True, new])
            for a, n in zip(which[first].tolist(), np.diff(np.append(first, len(which))).tolist(), strict=True):
                yield a, n

        out: list[tuple] = []

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            names = ["key", "doc_id", "text_hash", "start", "windows", "run", "also"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        spread = mixed(np.array([h for _, h in docs], np.int64).view(np.uint64)).view(np.int64)
        for a, n in stretches(np.flatnonzero(done), None):
            d = int(ordinal[a])
            out.append((int(spread[d]), *docs[d], int(at[a]), n, None, None))
            if len(out) >= 10_000:
                yield flushed()
        signed_anchor, signed_window = anchored.view(np.int64), window.view(np.int64)
        last, words = -1, []
        for a, n in stretches(np.flatnonzero(~done & ~shadow), alone):
            d = int(ordinal[a])
            if d != last:
                last, words = d, bodies[d].split()
            start = int(at[a])
            key = int(signed_window[a]) if hot[a] else int(signed_anchor[a])
            again = np.array(also[a], np.int32).tobytes() if a in also else None
            out.append((key, *docs[d], start, n, b" ".join(words[start : start + n + width - 1]), again))
            if len(out) >= 10_000:
                yield flushed()
        if out:
            yield flushed()

    return run


MARKS = "doc_id long, text_hash long, start int, windows int"


def deep_nodes(suffixes: list[tuple], width: int) -> Iterator[tuple[int, int, int]]:
    """Internal nodes of depth ``width`` or more of the tree over sorted suffixes, from the
    leaves up: depth in words, and the range of the suffixes below."""
    open_nodes: list[tuple[int, int]] = []  # depth, first suffix
    last = len(suffixes)
    for i in range(1, last + 1):
        depth = 0
        if i < last:
            a, b = suffixes[i - 1], suffixes[i]
            if a[:width] == b[:width]:
                depth = min(len(a), len(b))
                if a[:depth] != b[:depth]:
                    depth = next(k for k in range(width, depth) if a[k] != b[k])
        first = i - 1
        while open_nodes and open_nodes[-1][0] > depth:
            node_depth, first = open_nodes.pop()
            yield node_depth, first, i
        if depth and (not open_nodes or open_nodes[-1][0] < depth):
            open_nodes.append((depth, first))


def maximal_repeats(runs: list[tuple], width: int) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """Passages of ``width`` words or more that repeat and go on differently on both sides.

    ``runs`` has (doc_id, text_hash, start, windows, text, also). A passage is its number of
    words and its places: doc_id, run, word of the run. A deep node whose suffixes all follow
    the same word is left out: it ends the longer passage of the node one word before.
    """
    words = [run[4].split(b" ") for run in runs]
    leaves = [(tuple(words[r][k:]), runs[r][0], r, k) for r in range(len(runs)) for k in range(runs[r][3])]
    leaves.sort(key=lambda leaf: leaf[0])
    for depth, first, end in deep_nodes([leaf[0] for leaf in leaves], width):
        below = leaves[first:end]
        _, _, r, k = below[0]
        before = words[r][k - 1] if k else None
        if before is None or any(not k or words[r][k - 1] != before for _, _, r, k in below):
            yield depth, [leaf[1:] for leaf in below]


def subtree(runs: list[tuple], width: int) -> dict[tuple[int, int], int]:
    """How many windows from (run, word) on also start in a smaller document of the group.

    The smallest document below a node keeps its copy of the node's passage; the others
    lose all windows of theirs.
    """
    lost: dict[tuple[int, int], int] = {}
    for depth, places in maximal_repeats(runs, width):
        least = min(doc_id for doc_id, _, _ in places)
        for doc_id, r, k in places:
            if doc_id > least:
                lost[r, k] = max(lost.get((r, k), 0), depth - width + 1)
    return lost


def _trees(width: int):
    """Marks from the runs of each group; rows come sorted by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        group: list[tuple] = []
        current = None

        def close() -> None:
            lost = subtree(group, width) if len(group) > 1 else {}
            for (number, k), windows in lost.items():
                doc_id, text_hash, start, _, _, also = group[number]
                out.append((doc_id, text_hash, start + k, windows))
                if also is not None:
                    out.extend((doc_id, text_hash, place, 1) for place in np.frombuffer(also, np.int32).tolist())
            group.clear()

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            names = ["doc_id", "text_hash", "start", "windows"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(7))
            for key, *row in zip(*columns, strict=True):
                if row[4] is None:
                    out.append(tuple(row[:4]))
                    continue
                if key != current:
                    close()
                    current = key
                group.append(tuple(row))
            if len(out) > 10_000:
                yield flushed()
        close()
        if out:
            yield flushed()

    return run


def marks(
    documents: DataFrame, *, width: int = WIDTH, anchor: int = ANCHOR, most_in_group: int = MOST_IN_GROUP
) -> DataFrame:
    """Windows that also start in a document with a smaller id, as stretches of
    ``windows`` neighbours from word ``start`` of the row (``doc_id``, ``text_hash``)."""
    spark = documents.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = repeated_anchors(
        documents, width=width, anchor=anchor, most_in_group=most_in_group, buckets=buckets
    )
    # A hot anchor is hot for every document that has it.
    hot = found.where("hot").select(F.col("anchor").alias("hot_anchor")).distinct()
    by_doc = (
        found.join(hot, F.col("anchor") == F.col("hot_anchor"), "left")
        .groupBy(F.col("doc_id").alias("__doc"))
        .agg(F.collect_list("anchor").alias("anchors"), F.collect_list("hot_anchor").alias("hot"))
    )
    with_anchors = documents.join(by_doc.hint("shuffle_hash"), F.col("doc_id") == F.col("__doc"), "left").select(
        "doc_id", "text", F.xxhash64("text").alias("text_hash"), "anchors", "hot"
    )
    runs = with_anchors.mapInArrow(_suffix_runs(width, anchor), RUNS)
    return runs.repartition("key").sortWithinPartitions("key").mapInArrow(_trees(width), MARKS)


CLEANED = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _cleaned(width: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marked = batch.column("marks")
            hashes = batch.column("text_hash").to_pylist()
            counts, removed, digests, bodies = [], [], [], []
            for i, text in enumerate(texts(batch.column("text"))):
                words = text.split()
                gone = 0
                counts.append(len(words))
                if marked[i].is_valid:
                    covered = np.zeros(len(words), bool)
                    for mark in marked[i].as_py():
                        if mark["text_hash"] == hashes[i]:
                            covered[mark["start"] : mark["start"] + mark["windows"] + width - 1] = True
                    gone = int(covered.sum())
                    if gone:
                        words = [words[k] for k in np.flatnonzero(~covered).tolist()]
                kept = b" ".join(words)
                removed.append(gone)
                digests.append(hashlib.sha256(kept).hexdigest())
                bodies.append(kept if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(bodies, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    return run


def cleaned(
    documents: DataFrame,
    *,
    width: int = WIDTH,
    anchor: int = ANCHOR,
    most_in_group: int = MOST_IN_GROUP,
    with_text: bool = True,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and ``kept``, the words that stay.

    A null text has no words. Texts shorter than a window lose nothing, nor does the
    smallest id among equal texts. Rows with equal ids are the same document: windows they
    share stay. A row without an id is kept whole and is no one's smaller document. No
    rows give no rows. Columns other than ``doc_id`` and ``text`` are ignored.
    """
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    known = rows.where("doc_id IS NOT NULL")
    found = marks(known, width=width, anchor=anchor, most_in_group=most_in_group)
    by_doc = found.groupBy(F.col("doc_id").alias("__doc")).agg(
        F.collect_list(F.struct("text_hash", "start", "windows")).alias("marks")
    )
    joined = known.join(by_doc.hint("shuffle_hash"), F.col("doc_id") == F.col("__doc"), "left").select(
        "doc_id", "text", F.xxhash64("text").alias("text_hash"), "marks"
    )
    unnamed = rows.where("doc_id IS NULL").select(
        "doc_id", "text", F.xxhash64("text").alias("text_hash"), F.lit(None).cast(joined.schema["marks"].dataType).alias("marks")
    )
    work = _cleaned(width, with_text)
    return joined.mapInArrow(work, CLEANED).unionByName(unnamed.mapInArrow(work, CLEANED))
