"""Product quantisation of vectors, with norm-of-sum bounds in the clustering rounds.

A vector is cut into parts, and each part is coded by the nearest entry of its codebook. For
every part a row keeps its entry, an upper bound of the distance to it, and for each group of
entries a lower bound of the distance to all others of the group. A bound carries the stamp
of the round in which it was measured. In a later round the codebooks of all rounds so far
are at hand, so an entry's true displacement since the stamp, the norm of the sum of its
moves, loosens the bound; the sum of the norms, which is what adding up drifts gives, is never
less. Where the bounds cannot separate the entry from a group, the distance is measured, and
if that is not enough the group's entries are all measured again.

Components are integers, so distances decide exactly; bounds are rounded to the safe side,
and a group that could hold a tie is measured.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.llm.common import written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Groups of entries that share a lower bound.
GROUPS = 8
# Rows whose distances to all entries are in memory at once.
ROWS = 2_048
# A label may have a third of all rows: they meet its sum in so many tasks.
SALTS = 32
_SLACK = 1e-9


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all entries, as integers."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if x.shape[1] * (2 * most) ** 2 < 1 << 53:
        # Every sum is an integer that a double holds, whatever the order of additions.
        a, b = x.astype(np.float64), entries.astype(np.float64)
        out = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
        return out.astype(np.int64)
    out = np.zeros((len(x), len(entries)), np.int64)
    for k in range(x.shape[1]):
        step = x[:, k, None] - entries[None, :, k]
        out += step * step
    return out


def _down(values: np.ndarray) -> np.ndarray:
    """Lower bounds as half floats, rounded down."""
    safe = np.minimum(values * (1 - _SLACK), 65_000.0)
    short = safe.astype(np.float16)
    return np.where(short.astype(np.float64) > safe, np.nextafter(short, np.float16(-np.inf)), short)


def _up(values: np.ndarray) -> np.ndarray:
    safe = values * (1 + _SLACK)
    short = safe.astype(np.float32)
    return np.where(short.astype(np.float64) < safe, np.nextafter(short, np.float32(np.inf)), short)


def group_starts(entries: int, groups: int) -> np.ndarray:
    """First entry of each group; groups hold consecutive entries."""
    return np.unique(np.linspace(0, entries, groups, endpoint=False).astype(np.int64))


@dataclass
class Bounds:
    """What a row keeps of one part: entry, upper bound, lower bounds, and their stamps."""

    code: np.ndarray
    upper: np.ndarray
    lower: np.ndarray
    upper_stamp: np.ndarray
    lower_stamp: np.ndarray


def measured(x: np.ndarray, entries: np.ndarray, starts: np.ndarray, stamp: int) -> Bounds:
    """Bounds from the distances to all entries."""
    squared = distances(x, entries)
    code = squared.argmin(axis=1)  # the lowest index of equal ones
    rows = np.arange(len(x))
    upper = np.sqrt(squared[rows, code].astype(np.float64))
    others = squared.astype(np.float64)
    others[rows, code] = np.inf
    lower = np.sqrt(np.minimum.reduceat(others, starts, axis=1))
    return Bounds(
        code.astype(np.uint8),
        _up(upper),
        _down(lower),
        np.full(len(x), stamp, np.uint8),
        np.full(lower.shape, stamp, np.uint8),
    )


def reassigned(x: np.ndarray, old: Bounds, history: list[np.ndarray], starts: np.ndarray) -> tuple[Bounds, int]:
    """The bounds under the last codebook of ``history``, and how many distances it took."""
    now = len(history) - 1
    entries = history[now].astype(np.float64)
    moved = np.stack([np.sqrt(((entries - then) ** 2).sum(1)) for then in history]) * (1 + _SLACK)
    reach = np.maximum.reduceat(moved, starts, axis=1)  # by stamp and group
    code, upper, lower = old.code.copy(), old.upper.copy(), old.lower.copy()
    upper_stamp, lower_stamp = old.upper_stamp.copy(), old.lower_stamp.copy()
    low = lower.astype(np.float64) - reach[lower_stamp, np.arange(len(starts))]
    nearest = low.min(axis=1)
    high = upper.astype(np.float64) + moved[upper_stamp, code]
    open_rows = np.flatnonzero(~(high * (1 + _SLACK) < nearest))
    exact = ((x[open_rows] - history[now][code[open_rows]]) ** 2).sum(1)
    count = len(open_rows)
    upper[open_rows], upper_stamp[open_rows] = _up(np.sqrt(exact.astype(np.float64))), now
    high = upper[open_rows].astype(np.float64)
    unsure = ~(high * (1 + _SLACK) < nearest[open_rows])
    rows, best, high = open_rows[unsure], exact[unsure], high[unsure]
    first_code, first_best = code[rows].astype(np.int64), best.copy()
    best_code = first_code.copy()
    scans = ~(high[:, None] * (1 + _SLACK) < low[rows])
    ends = np.append(starts[1:], len(entries))
    kept = []
    for g, (start, end) in enumerate(zip(starts, ends, strict=True)):
        at = np.flatnonzero(scans[:, g])
        squared = distances(x[rows[at]], history[now][start:end])
        count += squared.size
        kept.append((at, squared))
        if not len(at):
            continue
        index = squared.argmin(axis=1)
        value = squared[np.arange(len(at)), index]
        index = index + start
        better = (value < best[at]) | ((value == best[at]) & (index < best_code[at]))
        best[at[better]], best_code[at[better]] = value[better], index[better]
    for g, (start, end) in enumerate(zip(starts, ends, strict=True)):
        at, squared = kept[g]
        others = squared.astype(np.float64)
        mine = (best_code[at] >= start) & (best_code[at] < end)
        others[np.flatnonzero(mine), best_code[at][mine] - start] = np.inf
        lower[rows[at], g] = _down(np.sqrt(others.min(axis=1, initial=np.inf)))
        lower_stamp[rows[at], g] = now
        # An entry that a row leaves in a group that was not measured bounds that group, too.
        left = (best_code != first_code) & (first_code >= start) & (first_code < end) & ~scans[:, g]
        bound = np.minimum(low[rows[left], g], np.sqrt(first_best[left].astype(np.float64)))
        lower[rows[left], g], lower_stamp[rows[left], g] = _down(np.maximum(bound, 0.0)), now
    code[rows] = best_code
    upper[rows] = _up(np.sqrt(best.astype(np.float64)))
    return Bounds(code, upper, lower, upper_stamp, lower_stamp), count


def _packed(values: np.ndarray) -> pa.Array:
    """One binary value per row of a matrix."""
    values = np.ascontiguousarray(values)
    width = values.dtype.itemsize * int(np.prod(values.shape[1:]))
    edges = np.arange(len(values) + 1, dtype=np.int64) * width
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(values), [None, pa.py_buffer(edges), pa.py_buffer(values)]
    ).cast(pa.binary())


def _unpacked(column: pa.Array, dtype: np.dtype, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), *shape)


@dataclass
class Layout:
    """Sizes of a compression, and the widest integer type its components need."""

    parts: int
    width: int
    groups: int
    dtype: str

    def vectors(self, column: pa.Array) -> np.ndarray:
        return _unpacked(column, np.dtype(self.dtype), self.parts, self.width).astype(np.int64)


STATE = "vec_id long, label string, vector binary, codes binary, upper binary, lower binary, stamps binary"


def _state(ids: pa.Array, labels: pa.Array, vectors: pa.Array, found: list[Bounds]) -> pa.RecordBatch:
    stamps = np.concatenate(
        [np.stack([b.upper_stamp for b in found], 1), np.concatenate([b.lower_stamp for b in found], 1)], 1
    )
    columns = [
        ids,
        labels,
        vectors,
        _packed(np.stack([b.code for b in found], 1)),
        _packed(np.stack([b.upper for b in found], 1)),
        _packed(np.stack([b.lower for b in found], 1)),
        _packed(stamps),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in STATE.split(", ")])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def integers(column: pa.Array, size: int, scale: int) -> np.ndarray:
    """floor(scale * x) of lists of doubles; shorter ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), size), np.int64)
    out[np.arange(size)[None, :] < lengths[:, None]] = np.floor(flat * float(scale)).astype(np.int64)
    return out


def _first(layout: Layout, history: list[np.ndarray], scale: int):
    starts = group_starts(history[0].shape[1], layout.groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            whole = integers(batch.column("embedding"), layout.parts * layout.width, scale)
            x = whole.reshape(len(whole), layout.parts, layout.width)
            found = [measured(x[:, p], history[0][p], starts, 0) for p in range(layout.parts)]
            yield _state(batch.column("vec_id"), batch.column("label"), _packed(whole.astype(layout.dtype)), found)

    return run


def _restored(batch: pa.RecordBatch, layout: Layout, groups: int) -> list[Bounds]:
    parts = layout.parts
    codes = _unpacked(batch.column("codes"), np.dtype(np.uint8), parts)
    upper = _unpacked(batch.column("upper"), np.dtype(np.float32), parts)
    lower = _unpacked(batch.column("lower"), np.dtype(np.float16), parts, groups)
    stamps = _unpacked(batch.column("stamps"), np.dtype(np.uint8), parts * (1 + groups))
    of_lower = stamps[:, parts:].reshape(len(stamps), parts, groups)
    return [Bounds(codes[:, p], upper[:, p], lower[:, p], stamps[:, p], of_lower[:, p]) for p in range(parts)]


def _round(layout: Layout, history: list[np.ndarray], *, last: bool):
    starts = group_starts(history[0].shape[1], layout.groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            x = layout.vectors(batch.column("vector"))
            old = _restored(batch, layout, len(starts))
            found = [
                reassigned(x[:, p], old[p], [book[p] for book in history], starts)[0] for p in range(layout.parts)
            ]
            if not last:
                yield _state(batch.column("vec_id"), batch.column("label"), batch.column("vector"), found)
                continue
            codes = np.stack([b.code for b in found], 1)
            error = np.zeros(len(x), np.int64)
            for p in range(layout.parts):
                error += ((x[:, p] - history[-1][p][codes[:, p]]) ** 2).sum(1)
            texts = [bytes(row).hex() for row in codes]
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(texts, pa.string()), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    return run


def _sums(layout: Layout, entries: int):
    """Sums of the parts of each entry in a task: rows (slot, position, total), the count at -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((layout.parts * entries, layout.width + 1), np.int64)
        for batch in _slices(batches):
            x = layout.vectors(batch.column("vector"))
            codes = _unpacked(batch.column("codes"), np.dtype(np.uint8), layout.parts).astype(np.int64)
            for p in range(layout.parts):
                np.add.at(sums[:, 1:], codes[:, p] + p * entries, x[:, p])
                sums[:, 0] += np.bincount(codes[:, p] + p * entries, minlength=len(sums))
        used = np.flatnonzero(sums[:, 0])
        slot = np.repeat(used, layout.width + 1)
        place = np.tile(np.arange(-1, layout.width), len(used))
        arrays = [pa.array(slot.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(sums[used].ravel())]
        yield pa.RecordBatch.from_arrays(arrays, ["slot", "place", "total"])

    return run


def moved_entries(state: DataFrame, layout: Layout, book: np.ndarray) -> np.ndarray:
    """The codebooks with each used entry at the floor of the mean of its parts.

    What reaches the driver is as large as the codebooks, whatever the number of rows.
    """
    entries = book.shape[1]
    tasks = state.select("vector", "codes").mapInArrow(_sums(layout, entries), "slot int, place int, total long")
    totals = tasks.groupBy("slot", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = {(r.slot, r.place): int(r.total) for r in totals.toLocalIterator()}
    out = book.copy()
    for (slot, place), total in found.items():
        if place >= 0:
            out[slot // entries, slot % entries, place] = total // found[slot, -1]
    return out


@dataclass
class Compressed:
    """``rows`` with vec_id, label, code and error; the final codebooks by part, entry, position."""

    rows: DataFrame
    codebooks: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def compress(
    embeddings: DataFrame,
    *,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    groups: int = GROUPS,
    scale: int = SCALE,
) -> Compressed | None:
    """Codes of all vectors; None if no vector is kept.

    Vectors that are null or hold a null, NaN or infinite component are dropped. All vectors
    are as long as the longest one, rounded up to whole parts; shorter ones end in zeros.
    Rows of one id are told apart by their components and all kept. A null id comes after
    all others as a seed. With fewer rows than entries the codebooks have as many entries as
    rows. Components whose squared distances pass 63 bits raise a ValueError.
    """
    if not 0 < entries <= 256 or rounds > 255:
        raise ValueError("codes and stamps are bytes")
    wide = F.col("embedding").cast("array<double>")
    finite = F.forall("embedding", lambda e: e.isNotNull() & (F.abs(e) < float("inf")))
    kept = embeddings.select(
        F.col("vec_id").cast("long"), F.col("label").cast("string"), wide.alias("embedding")
    ).where(F.col("embedding").isNotNull() & finite)
    largest = F.array_max(F.transform("embedding", lambda e: F.abs(e)))
    seeds = kept.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).select("embedding").collect()
    if not seeds:
        return None
    length, most = kept.agg(F.max(F.size("embedding")), F.coalesce(F.max(largest), F.lit(0.0))).first()
    width = -(-length // parts)
    bound = most * scale + 1
    if width * (2 * bound) ** 2 >= 2.0**62:
        raise ValueError(f"a component of {most} is too large for exact distances of 63 bits")
    dtype = next(t for t in ("i2", "i4", "i8") if bound < 2 ** (8 * int(t[1]) - 1))
    layout = Layout(parts, width, groups, dtype)
    # The lists may have any length, an empty one included.
    lists = pa.array([s.embedding for s in seeds], pa.list_(pa.float64()))
    book = integers(lists, parts * width, scale).reshape(len(seeds), parts, width).transpose(1, 0, 2).copy()
    history = [book]
    state = written(kept.mapInArrow(_first(layout, history, scale), STATE), "codes-0")
    for r in range(1, rounds + 1):
        history = [*history, moved_entries(state, layout, history[-1])]
        if r < rounds:
            state = written(state.mapInArrow(_round(layout, history, last=False), STATE), f"codes-{r}")
    coded = state.mapInArrow(
        _round(layout, history, last=True), "vec_id long, label string, code string, error long"
    )
    return Compressed(written(coded, "codes"), history[-1])


def codes(embeddings: DataFrame) -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error``, ``codebooks_sha256`` of each kept row.

    Null labels are one label. No kept rows give no rows. Other columns are not read.
    """
    found = compress(embeddings)
    if found is None:
        nothing = embeddings.select(F.col("vec_id").cast("long")).limit(0)
        types = {"code": "string", "error": "long", "label_error": "long", "codebooks_sha256": "string"}
        return nothing.select("vec_id", *(F.lit(None).cast(t).alias(n) for n, t in types.items()))
    key = [F.col("label").isNull().alias("unlabelled"), F.coalesce("label", F.lit("")).alias("of_label")]
    sums = found.rows.groupBy(*key).agg(F.sum("error").alias("label_error"))
    sums = sums.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int")
    rows = found.rows.select("vec_id", "code", "error", *key, salt.alias("salt"))
    return rows.join(sums, ["unlabelled", "of_label", "salt"]).select(
        "vec_id", "code", "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256")
    )


def oracle(*, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same for DuckDB with all distances, for vectors of one length of whole parts."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
far{r} AS (
  SELECT c.r, c.p, b.e, sum((c.x - b.x) * (c.x - b.x))::BIGINT AS d
  FROM comps c JOIN book{r} b ON b.p = c.p AND b.j = c.j GROUP BY ALL),
near{r} AS MATERIALIZED (
  SELECT r, p, e, d FROM far{r} QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1)""")
        if r < rounds:
            steps.append(f"""
mean{r} AS (
  SELECT n.p, n.e, c.j, sum(c.x)::HUGEINT AS s, count(*)::HUGEINT AS n
  FROM near{r} n JOIN comps c ON c.r = n.r AND c.p = n.p GROUP BY ALL),
book{r + 1} AS MATERIALIZED (
  SELECT b.p, b.e, b.j, coalesce((s - ((s % n) + n) % n) // n, b.x)::BIGINT AS x
  FROM book{r} b LEFT JOIN mean{r} m ON m.p = b.p AND m.e = b.e AND m.j = b.j)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
comps AS MATERIALIZED (
  SELECT r, (i - 1) // (len(embedding) // {parts}) AS p, (i - 1) % (len(embedding) // {parts}) AS j,
         floor({scale} * embedding[i]::DOUBLE)::BIGINT AS x
  FROM (SELECT r, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM kept)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, j, x FROM comps WHERE r <= {entries}),
{",".join(steps)},
coded AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM near{rounds} GROUP BY r)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, j)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (r)"""
