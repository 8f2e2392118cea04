"""How far the sources of a language differ, by exact term counts.

The counts are made the way a CountVectorizer per language makes them: ``fit`` keeps the terms
in at least ``min_df`` documents, at most as many as an integer index allows, and ``transform``
gives each document its exact sparse vector. Spark's own class holds the vocabulary in the
driver and in every task, which grows with the corpus; here it is a table. Documents are split
once, in blocks that list each of their terms once. Only these terms go to the vocabulary and
come back with their index; a term is in a block at most once, so none of them is a hot key.

Vectors are summed per group of language and source. The divergence of two groups is a sum
over all terms, but only terms that one of them has need a look: both have none, a constant;
one has the term, a sum over the distinct counts of that group; both have it, a correction
for each such term.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changefeed.llm.common import run_starts, texts, written
from changefeed.operators.positions import range_ordered

MIN_DF = 10
VOCAB_SIZE = 2**31 - 1
UNIT = 1_000_000_000
TOP_TERMS = 10

# Bytes of text in the blocks that a task holds at a time; a longer text is a block alone.
BLOCK_BYTES, BLOCK_DOCS = 16 << 20, 1 << 16
# Indices that are summed as one packed row.
CHUNK = 1 << 12
# Rows and sums that a task holds before it passes them on.
HELD = 2_000_000

# A term is a run of [^\x00-\x40\x5B-\x60\x7B-\x7F], that is of ASCII letters and of all
# bytes from 0x80. What is not in a term becomes a space; only A-Z change.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


BLOCKS = (
    "block long, lang string, doc_ids array<long>, sources array<string>, "
    "terms array<string>, df array<int>, counts binary, places binary"
)


def _listed(values: pa.Array) -> pa.Array:
    """One row with all the values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _block(block: int, lang: str, docs: list[tuple[int | None, str, np.ndarray]], seen: dict[bytes, int]) -> pa.RecordBatch:
    """A row with the terms of a block: the documents of each term, one for each occurrence."""
    of_term = np.concatenate([ids for *_, ids in docs])
    places = np.repeat(np.arange(len(docs), dtype=np.uint16), [len(ids) for *_, ids in docs])
    order = np.argsort(of_term, kind="stable")
    of_term, places = of_term[order], places[order]
    new = np.ones(len(places), np.int32)
    new[1:] = (of_term[1:] != of_term[:-1]) | (places[1:] != places[:-1])
    starts = run_starts(of_term)
    df = np.add.reduceat(new, starts) if len(starts) else new
    columns = {
        "block": pa.array([block]),
        "lang": pa.array([lang], pa.string()),
        "doc_ids": _listed(pa.array([d[0] for d in docs], pa.int64())),
        "sources": _listed(pa.array([d[1] for d in docs], pa.string())),
        "terms": _listed(pa.array([w.decode("utf-8", "replace") for w in seen], pa.string())),
        "df": _listed(pa.array(df.astype(np.int32))),
        "counts": pa.array([np.diff(np.append(starts, len(places))).astype(np.uint32).tobytes()], pa.binary()),
        "places": pa.array([places.tobytes()], pa.binary()),
    }
    return pa.RecordBatch.from_pydict(columns)


def blocks(documents: DataFrame, *, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of documents of one language, with their terms; a row for each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        held: dict[str, tuple[list, dict[bytes, int]]] = {}
        size = count = 0
        for batch in batches:
            rows = zip(
                batch.column("doc_id").to_pylist(),
                batch.column("lang").to_pylist(),
                batch.column("source").to_pylist(),
                texts(batch.column("text")),
                strict=True,
            )
            for doc_id, lang, source, text in rows:
                if held and (size + len(text) > block_bytes or count == BLOCK_DOCS):
                    for name, (docs, seen) in held.items():
                        yield _block(block, name, docs, seen)
                        block += 1
                    held, size, count = {}, 0, 0
                docs, seen = held.setdefault(lang, ([], {}))
                number = seen.setdefault
                ids = np.array([number(word, len(seen)) for word in terms(text)], np.int32)
                docs.append((doc_id, source, ids))
                size, count = size + len(text), count + 1
        for name, (docs, seen) in held.items():
            yield _block(block, name, docs, seen)
            block += 1

    return _plain(documents).mapInArrow(run, BLOCKS)


def _plain(documents: DataFrame) -> DataFrame:
    empty = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    return documents.select(F.col("doc_id").cast("long"), empty("text"), empty("lang"), empty("source"))


def _terms_of(made: DataFrame) -> DataFrame:
    """``block``, ``lang``, ``at``, ``term`` and ``df`` of each term of each block."""
    exploded = made.select("block", "lang", F.posexplode(F.arrays_zip("terms", "df")).alias("at", "t"))
    return exploded.select("block", "lang", "at", F.col("t.terms").alias("term"), F.col("t.df").alias("df"))


def fit(made: DataFrame, *, min_df: int = MIN_DF, vocab_size: int = VOCAB_SIZE) -> DataFrame:
    """The vocabulary: ``lang``, ``term``, ``df`` and ``index``, from 0 in the order of UTF-8.

    A language with more terms than ``vocab_size`` raises an error when it is read; none is
    dropped. Positions come from a range partitioning and one row per partition and language.
    """
    counts = _terms_of(made).groupBy("lang", "term").agg(F.sum("df").alias("df"))
    placed = written(range_ordered(counts.where(F.col("df") >= min_df), "lang", "term"), "vocabulary")
    spans = placed.groupBy(F.col("_block").alias("at"), F.col("lang").alias("of")).agg(
        F.count(F.lit(1)).alias("n"), F.min("_row").alias("first")
    )
    before = Window.partitionBy("of").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("at", "of", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    same = (F.col("_block") == F.col("at")) & (F.col("lang") == F.col("of"))
    index = F.col("start") + F.col("_row") - F.col("first")
    checked = F.when(index < vocab_size, index.cast("int")).otherwise(
        F.raise_error(F.lit("more terms than the vocabulary may have")).cast("int")
    )
    return placed.join(spans, same).select("lang", "term", "df", checked.alias("index"))


VECTORS = (
    "lang string, doc_ids array<long>, sources array<string>, edges binary, indices binary, counts binary"
)


def _vectors(made: pa.Table, known: pa.Table) -> pa.Table:
    """The sparse vectors of one block as the rows of a compressed matrix."""
    counts = np.frombuffer(made.column("counts")[0].as_py(), np.uint32)
    index = np.full(len(counts), -1, np.int64)
    index[known.column("at").to_numpy()] = known.column("index").to_numpy()
    of_place = np.repeat(index, counts)
    places = np.frombuffer(made.column("places")[0].as_py(), np.uint16).astype(np.int64)
    cells = np.sort((places << 32 | of_place)[of_place >= 0])
    first = run_starts(cells)
    number = np.diff(np.append(first, len(cells))).astype(np.int32)
    cells = cells[first]
    n_docs = len(made.column("doc_ids")[0])
    edges = np.searchsorted(cells >> 32, np.arange(n_docs + 1)).astype(np.int32)
    packed = {"edges": edges, "indices": (cells & 0xFFFFFFFF).astype(np.int32), "counts": number}
    return pa.table(
        {
            **{name: made.column(name) for name in ("lang", "doc_ids", "sources")},
            **{name: pa.array([values.tobytes()], pa.binary()) for name, values in packed.items()},
        }
    )


def transform(made: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The exact sparse vectors of the documents, a row with a compressed matrix per block.

    Row ``i`` of a block's matrix has the ascending ``indices`` and ``counts`` between
    ``edges[i]`` and ``edges[i + 1]``, none if the document has no term of the vocabulary.
    """
    known = _terms_of(made).join(vocabulary.select("lang", "term", "index"), ["lang", "term"])
    known = known.select(F.col("block").alias("of_block"), "at", "index")
    payload = made.select("block", "lang", "doc_ids", "sources", "counts", "places")
    return payload.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(_vectors, VECTORS)


def vectors(documents: DataFrame, *, min_df: int = MIN_DF) -> tuple[DataFrame, DataFrame]:
    """A row per document with ``lang``, ``source``, ``doc_id``, ``indices`` and ``counts``, and the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                edges = pa.array(np.frombuffer(row["edges"], np.int32))
                lists = [
                    pa.ListArray.from_arrays(edges, pa.array(np.frombuffer(row[c], np.int32)))
                    for c in ("indices", "counts")
                ]
                heads = [pa.array([row["lang"]] * len(row["doc_ids"]), pa.string())]
                heads += [pa.array(row["sources"], pa.string()), pa.array(row["doc_ids"], pa.int64())]
                yield pa.RecordBatch.from_arrays([*heads, *lists], ["lang", "source", "doc_id", "indices", "counts"])

    made = written(blocks(documents), "audit-blocks")
    vocabulary = written(fit(made, min_df=min_df), "terms")
    rows = "lang string, source string, doc_id long, indices array<int>, counts array<int>"
    return transform(made, vocabulary).mapInArrow(run, rows), vocabulary


def _packed_sums(batches: Iterator[pa.RecordBatch], *, chunk: int) -> Iterator[pa.RecordBatch]:
    """The sums of the vectors of a block by source, in rows of ``chunk`` indices."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in ("lang", "sources", "edges", "indices", "counts")}
            edges, indices, counts = (np.frombuffer(row[c], np.int32) for c in ("edges", "indices", "counts"))
            names = {name: k for k, name in enumerate(dict.fromkeys(row["sources"]))}
            of_doc = np.array([names[s] for s in row["sources"]], np.int64)
            cells = np.repeat(of_doc, np.diff(edges)) << 32 | indices
            order = np.argsort(cells)
            cells, counts = cells[order], counts[order].astype(np.int64)
            first = run_starts(cells)
            if not len(first):
                continue
            cells, total = cells[first], np.add.reduceat(counts, first)
            rows = run_starts(cells // chunk)
            bounds = np.append(rows, len(cells))
            of_row = cells[rows]
            listed = list(names)
            offsets, sums = (cells % chunk).astype(np.uint16), total
            cut = lambda values: pa.array(
                [values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()  # noqa: B023
            )
            columns = [
                pa.array([row["lang"]] * len(rows), pa.string()),
                pa.array([listed[k] for k in (of_row >> 32).tolist()], pa.string()),
                pa.array(((of_row & 0xFFFFFFFF) // chunk).astype(np.int32)),
                cut(offsets),
                cut(sums),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "chunk", "offsets", "sums"])


def _added(batches: Iterator[pa.RecordBatch], *, chunk: int) -> Iterator[pa.RecordBatch]:
    """The rows of a chunk added up; they come sorted, so one chunk is held at a time."""
    out: list[tuple[tuple, np.ndarray, np.ndarray]] = []
    size, at, total = 0, None, np.zeros(chunk, np.int64)

    def close() -> int:
        used = np.flatnonzero(total)
        out.append((at, (used + at[2] * chunk).astype(np.int32), total[used]))
        total[:] = 0
        return len(used)

    def flushed() -> pa.RecordBatch:
        sizes = [len(index) for _, index, _ in out]
        repeated = lambda k: pa.array(np.repeat(np.array([key[k] for key, *_ in out], object), sizes), pa.string())
        columns = [repeated(0), repeated(1)] + [pa.array(np.concatenate([o[k] for o in out])) for k in (1, 2)]
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "index", "count"])

    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "chunk")), strict=True)
        for key, offsets, sums in zip(
            keys, batch.column("offsets").to_pylist(), batch.column("sums").to_pylist(), strict=True
        ):
            if at is not None and key != at:
                size += close()
                if size > HELD:
                    yield flushed()
                    out, size = [], 0
            at = key
            total[np.frombuffer(offsets, np.uint16)] += np.frombuffer(sums, np.int64)
    if at is not None:
        close()
        yield flushed()


def group_sums(matrices: DataFrame, *, chunk: int = CHUNK) -> DataFrame:
    """The sum of the vectors of each group: ``lang``, ``source``, ``index``, ``count``.

    The vectors of a block are added up before the shuffle.
    """
    packed = matrices.mapInArrow(
        partial(_packed_sums, chunk=chunk), "lang string, source string, chunk int, offsets binary, sums binary"
    )
    keys = ["lang", "source", "chunk"]
    dealt = packed.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(partial(_added, chunk=chunk), "lang string, source string, index int, count long")


def _probability(count: Column, total: Column, terms_of_lang: Column) -> Column:
    """1 + floor(UNIT * (count + 2) / (total + 2 * V)), exact; null without terms."""
    wide = lambda c: c.cast("decimal(24,0)")
    above = wide(count + F.lit(2)) * F.lit(UNIT).cast("decimal(10,0)")
    below = F.nullif(wide(total) + wide(F.lit(2) * terms_of_lang), F.lit(0).cast("decimal(25,0)"))
    # The quotient of two decimals is rounded; without the remainder it is exact.
    return F.lit(1) + ((above - above % below) / below).cast("decimal(20,0)").cast("long")


def _apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); the squares fit, as no probability passes UNIT + 1."""
    square = (p - q) * (p - q)
    return ((square - square % (p + q)) / (p + q)).cast("decimal(20,0)").cast("long")


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _corrections(batches: Iterator[pa.RecordBatch], *, most: int) -> Iterator[pa.RecordBatch]:
    """For each pair a < b of sources: the sum over the terms that both have of what their
    divergence differs from the sum of the two one-sided ones. Rows come sorted by language,
    index and source, whole terms in one task, ``most`` rows and sums are held at a time."""
    held: dict[tuple[str, str, str], int] = {}

    def flushed() -> pa.RecordBatch:
        keys = list(held)
        columns = [pa.array([k[i] for k in keys], pa.string()) for i in range(3)]
        out = pa.RecordBatch.from_arrays(
            [*columns, pa.array([held[k] for k in keys], pa.int64())], ["lang", "a", "b", "value"]
        )
        held.clear()
        return out

    def evaluate(lang: str, names: np.ndarray, source: np.ndarray, p: np.ndarray, p0: np.ndarray) -> None:
        """Terms of one language with equally many sources: a row of each matrix per term."""
        k = source.shape[1]
        for i in range(k - 1):
            # One source of each term against those behind it.
            q, q0, s = p[:, i + 1 :], p0[:, i + 1 :], source[:, i + 1 :]
            one, one0 = p[:, i, None], p0[:, i, None]
            value = _f(one, q) - _f(one, q0) - _f(one0, q) + _f(one0, q0)
            pair = source[:, i, None].astype(np.int64) * len(names) + s
            keys, inverse = np.unique(pair.ravel(), return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, inverse, value.ravel())
            for key, add in zip(keys.tolist(), total.tolist(), strict=True):
                at = (lang, names[key // len(names)], names[key % len(names)])
                held[at] = held.get(at, 0) + add

    def chunk(table: pa.Table) -> None:
        for lang in pa.compute.unique(table.column("lang")).to_pylist():
            own = table.filter(pa.compute.equal(table.column("lang"), lang))
            coded = own.column("source").combine_chunks().dictionary_encode()
            coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
            names = np.array(coded.dictionary.to_pylist(), object)
            by_name = np.argsort(names)  # so that a < b by the rank of a source
            rank = np.empty(len(names), np.int64)
            rank[by_name] = np.arange(len(names))
            source = rank[coded.indices.to_numpy()]
            index, p, p0 = (own.column(c).to_numpy() for c in ("index", "p", "p0"))
            order = np.lexsort((source, index))
            index, source, p, p0 = index[order], source[order], p[order], p0[order]
            starts = run_starts(index)
            sizes = np.diff(np.append(starts, len(index)))
            for k in np.unique(sizes[sizes > 1]):
                of_size = starts[sizes == k]
                step = max(1, most // (2 * int(k)))
                for at in range(0, len(of_size), step):
                    rows = of_size[at : at + step, None] + np.arange(k)
                    evaluate(lang, names[by_name], source[rows], p[rows], p0[rows])

    waiting: list[pa.Table] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(pa.Table.from_batches([batch]))
        count += batch.num_rows
        if count < most:
            continue
        table = pa.concat_tables(waiting).combine_chunks()
        index, lang = table.column("index").to_numpy(), table.column("lang").to_numpy()
        # The last term may go on in the next batch.
        differs = np.flatnonzero((index[1:] != index[:-1]) | (lang[1:] != lang[:-1]))
        whole = int(differs[-1]) + 1 if len(differs) else 0
        if whole:
            chunk(table.slice(0, whole))
        waiting, count = [table.slice(whole)], table.num_rows - whole
        if len(held) > most:
            yield flushed()
    if waiting:
        chunk(pa.concat_tables(waiting).combine_chunks())
    yield flushed()


def pair_values(dealt: DataFrame, groups: DataFrame, *, held: int = HELD) -> DataFrame:
    """``lang``, ``a``, ``b``, ``value`` of all ordered pairs of sources of a language.

    ``groups`` has a row per group with ``p0``, the probability of a term it does not have,
    and ``V``. The result has as many rows by its nature; nothing larger is made of them.
    """
    ones = groups.select("lang", F.col("source").alias("a"), F.col("p0").alias("p0a"), "V")
    others = groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("p0b"))
    both = ones.join(others, "lang").where("a < b")
    ground = both.select("lang", "a", "b", F.coalesce(F.col("V") * _apart(F.col("p0a"), F.col("p0b")), F.lit(0)).alias("value"))
    # One-sided: all terms with one count in a group are as far from the other group's p0.
    counts = dealt.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).alias("n"))
    sided = counts.join(others, "lang").where("source <> b")
    more = F.col("n") * (_apart(F.col("p"), F.col("p0b")) - _apart(F.col("p0"), F.col("p0b")))
    sided = sided.select(
        "lang", F.least("source", "b").alias("a"), F.greatest("source", "b").alias("b"), more.alias("value")
    )
    by_term = dealt.select("lang", "index", "source", "p", "p0").repartition("lang", "index")
    shared = by_term.sortWithinPartitions("lang", "index", "source").mapInArrow(
        partial(_corrections, most=held), "lang string, a string, b string, value long"
    )
    total = ground.unionByName(sided).unionByName(shared).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    total = written(total, "pair-values")
    mirrored = total.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value")
    return total.unionByName(mirrored)


def _ranked(values: DataFrame, *order: Column) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order))
    return values.withColumn("rank", rank.cast("int"))


def audit(
    documents: DataFrame,
    *,
    min_df: int = MIN_DF,
    top: int = TOP_TERMS,
    block_bytes: int = BLOCK_BYTES,
    chunk: int = CHUNK,
    held: int = HELD,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank`` of all groups.

    Part ``pair`` has the other sources of the language by falling divergence, part ``term``
    the ``top`` terms that a group uses more than its language. Null text, language and source
    are empty, so a null source and an empty one are one group. Each row is a document, a
    repeated one, too. A language without kept terms has pairs of value 0 and no terms; a
    source alone in its language has no pairs. Other columns are not read; no rows give none.
    """
    made = written(blocks(documents, block_bytes=block_bytes), "audit-blocks")
    vocabulary = written(fit(made, min_df=min_df), "terms")
    sums = written(group_sums(transform(made, vocabulary), chunk=chunk), "group-sums")
    sizes = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("V"))
    totals = sums.groupBy("lang", "source").agg(F.sum("count").alias("N"))
    groups = _plain(documents).select("lang", "source").distinct()
    groups = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("N", F.lit(0)).alias("N"), F.coalesce("V", F.lit(0)).alias("V"))
    groups = groups.withColumn("p0", _probability(F.lit(0).cast("long"), F.col("N"), F.col("V")))
    groups = written(groups, "audit-groups")
    langs = groups.groupBy("lang").agg(F.sum("N").alias("lang_n"))
    stats = groups.join(langs, "lang")
    in_lang = F.sum("count").over(Window.partitionBy("lang", "index"))
    dealt = sums.withColumn("lang_count", in_lang).join(stats, ["lang", "source"])
    dealt = dealt.select(
        "lang",
        "source",
        "index",
        "p0",
        _probability(F.col("count"), F.col("N"), F.col("V")).alias("p"),
        _probability(F.col("lang_count"), F.col("lang_n"), F.col("V")).alias("q"),
    )
    dealt = written(dealt, "probabilities")
    pairs = pair_values(dealt, groups, held=held).withColumnsRenamed({"a": "source", "b": "item"})
    pairs = _ranked(pairs, F.desc("value"), F.asc("item"))
    above = dealt.where("p > q").select("lang", "source", "index", _apart(F.col("p"), F.col("q")).alias("value"))
    # Indices ascend with the terms' UTF-8 bytes.
    tops = _ranked(above, F.desc("value"), F.asc("index")).where(F.col("rank") <= top)
    named = tops.join(vocabulary.select("lang", "index", F.col("term").alias("item")), ["lang", "index"])
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(
        named.withColumn("part", F.lit("term")).select(*columns)
    )


def oracle(*, min_df: int = MIN_DF, top: int = TOP_TERMS) -> str:
    """The same for DuckDB over dense pairs of groups and terms."""
    p = lambda c, n: f"1 + ({UNIT}::HUGEINT * ({c} + 2)) // nullif({n} + 2 * v, 0)"
    f = "((p - q) * (p - q) // (p + q))"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT r) >= {min_df}),
vocab AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
counts AS (SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
  SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(n, 0) AS n
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN vocab USING (lang)
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL) USING (lang, source)),
dense AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c, {p('coalesce(c, 0)', 'n')} AS p
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS other, sum({f.replace('p', 'x.p').replace('q', 'y.p')}) AS s
    FROM dense x JOIN dense y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) d
  ON d.lang = a.lang AND d.source = a.source AND d.other = b.source),
whole AS (SELECT lang, sum(n) AS n, any_value(v) AS v FROM groups GROUP BY ALL),
langs AS (
  SELECT lang, term, {p('t.c', 'w.n')} AS q
  FROM (SELECT lang, term, sum(c) AS c FROM counts GROUP BY ALL) t JOIN whole w USING (lang)),
above AS (SELECT lang, source, term AS item, {f} AS value FROM dense JOIN langs USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL
  SELECT lang, source, 'term' AS part, item, value FROM above)
SELECT lang, source, part, item, value::BIGINT AS value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM ranked QUALIFY part = 'pair' OR rank <= {top}"""
