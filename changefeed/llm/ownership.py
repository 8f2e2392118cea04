"""Secrets by the number of their owners, in DataFrame functions only.

Fixed patterns find the base spans. The method looks at more: every run of characters that
could be a credential is a candidate, known by the hash of its value. Over the whole corpus
the distinct owners and repositories of each hash are counted. A value that many owners have
was copied from somewhere, an example of a manual or a licence. A value that one owner has in
few repositories looks live; where no base span touches it, it becomes a span of kind ``live``.

An owner is a source, a repository what a source has in one language; other columns can be
named. Texts are read once: what is found in them is written as a narrow table, and all that
is counted, joined and sorted later are positions and hashes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changefeed.llm.common import written


def either_case(pattern: str) -> str:
    """The pattern with each letter as a class of its two cases; no flag, which engines read apart."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in pattern)


# What counts as a secret of each kind.
ASSIGN = (
    f"({either_case('password|passwd|secret|token|api_?key')})"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
# Runs too short for a span are not worth a row. A run that is too short holds no longer one,
# so the bound can stand in these two patterns; not so in the first, where it moves the match.
LONG_ACCESS = "AKIA[A-Z0-9]{14,}"
LONG_HEX = "[0-9a-f]{16,}"
CANDIDATE = "[A-Za-z0-9+/_-]{16,}"
VALUE_CHARS = 12

KINDS = ("assign", "access", "hex", "live")
LIVE = KINDS.index("live")

# A candidate looks live if it has letters, digits and this many different characters.
DISTINCT_CHARS = 8
# Owners and repositories that a live value has at most, and owners that make an example.
MOST_OWNERS, MOST_REPOSITORIES, EXAMPLE_OWNERS = 1, 2, 3
# One value may be in a third of all rows: its rows meet the counts in so many tasks.
SALTS = 16

RESULTS = ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_example")


def _hits(text: Column, kind: str, pattern: str, fits) -> Column:
    """The matches of a pattern, left to right: how long each is, how far from the one before."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(found.alias("hit"), F.split(text, pattern, -1).alias("gap"))
    hits = F.transform(
        F.filter(pairs, lambda p: p["hit"].isNotNull()),
        lambda p, i: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            i.alias("at"),
            F.length(p["gap"]).cast("long").alias("gap"),
            F.length(p["hit"]).cast("long").alias("size"),
            fits(p["hit"]).alias("fits"),
            (F.sha2(p["hit"], 256) if kind == "live" else F.lit(None).cast("string")).alias("digest"),
        ),
    )
    return F.when(F.size(found) > 0, hits)


def _looks_live(hit: Column) -> Column:
    return (
        hit.rlike("[0-9]") & hit.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(hit, ""))) >= DISTINCT_CHARS)
    )


def _joined_hash(columns: Sequence[str]) -> Column:
    """One text for several columns; null is a value of its own."""
    return F.to_json(F.array(*(F.col(c).cast("string") for c in columns)))


def found(documents: DataFrame, *, owner: Sequence[str], repository: Sequence[str]) -> DataFrame:
    """One narrow row per document: ``row``, ``doc_id``, ``owner``, ``repository``, ``hits``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    value = lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= VALUE_CHARS
    kinds = [
        _hits(text, "assign", ASSIGN, value),
        _hits(text, "access", LONG_ACCESS, lambda _: F.lit(True)),
        _hits(text, "hex", LONG_HEX, lambda _: F.lit(True)),
        _hits(text, "live", CANDIDATE, _looks_live),
    ]
    hits = F.flatten(F.array_compact(F.array(*kinds)))
    return documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id"),
        _joined_hash(owner).alias("owner"),
        _joined_hash(repository).alias("repository"),
        hits.alias("hits"),
    )


def located(finds: DataFrame) -> DataFrame:
    """The hits that fit with ``start`` and ``end``; ``covered`` tells if a base span meets them.

    A position is a running sum over the hits of a document and kind, so no task has more
    of them than one text holds.
    """
    hits = finds.where(F.size("hits") > 0).select("row", "owner", "repository", F.explode_outer("hits").alias("h"))
    hits = hits.select("row", "owner", "repository", "h.*").repartition("row")
    so_far = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = hits.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far))
    placed = placed.withColumn("start", F.col("end") - F.col("size")).where("fits")
    # Base spans of one kind do not overlap, so the nearest ones on both sides decide; a base
    # span with the same start comes before the candidate in the first order.
    base = F.col("kind") < LIVE
    onward = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    back = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind"))
    back = back.rowsBetween(Window.unboundedPreceding, -1)
    before = F.max(F.when(base, F.col("end"))).over(onward)
    after = F.min(F.when(base, F.col("start"))).over(back)
    covered = (F.coalesce(before, F.lit(0)) > F.col("start")) | (
        F.coalesce(after, F.col("end")) < F.col("end")
    )
    return placed.withColumn("covered", ~base & covered).select(
        "row", "owner", "repository", "kind", "start", "end", "digest", "covered"
    )


def ownership(candidates: DataFrame) -> DataFrame:
    """``digest`` with its numbers of distinct ``owners`` and ``repositories`` in the corpus.

    Each step combines before its shuffle, so a value that is everywhere costs a task one row.
    """
    places = candidates.groupBy("digest", "owner", "repository").agg(F.count(F.lit(1)).alias("times"))
    owners = places.groupBy("digest", "owner").agg(
        F.count(F.lit(1)).alias("repositories"), F.sum("times").alias("times")
    )
    return owners.groupBy("digest").agg(
        F.count(F.lit(1)).alias("owners"),
        F.sum("repositories").alias("repositories"),
        F.sum("times").alias("times"),
    )


def verdicts(counts: DataFrame) -> DataFrame:
    """``live`` and ``example`` of each ``digest``; what lies between is neither."""
    return counts.select(
        "digest",
        ((F.col("owners") <= MOST_OWNERS) & (F.col("repositories") <= MOST_REPOSITORIES)).alias("live"),
        (F.col("owners") >= EXAMPLE_OWNERS).alias("example"),
    )


def _text(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    shown = F.transform(
        spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(shown, ",")


def scan(
    documents: DataFrame, *, owner: Sequence[str] = ("source",), repository: Sequence[str] = ("source", "lang")
) -> DataFrame:
    """``doc_id`` and the spans of each row, in code points.

    A null or empty text has no spans, and the hash of the empty text. Every row gives a row,
    also a repeated one or one without an id; repeated rows of one source are one owner's.
    A null source is an owner, a null language makes a repository. Other columns of the input
    are not read. Counts are of base spans, ``n_live`` and ``n_example`` of candidates with
    that verdict, touched by a base span or not. No rows give no rows.
    """
    finds = written(found(documents, owner=owner, repository=repository), "secret-hits")
    spans = written(located(finds), "secret-spans")
    candidates = spans.where(F.col("kind") == LIVE)
    judged = verdicts(ownership(candidates)).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    salt = F.pmod(F.xxhash64("row", "start"), F.lit(SALTS)).cast("int")
    known = candidates.withColumn("salt", salt).join(judged, ["digest", "salt"])
    base = spans.where(F.col("kind") < LIVE).select(
        "row", "kind", "start", "end", F.lit(True).alias("spanned"), F.lit(False).alias("live"), F.lit(False).alias("example")
    )
    added = known.select(
        "row", "kind", "start", "end", (F.col("live") & ~F.col("covered")).alias("spanned"), "live", "example"
    )
    span = F.struct("start", "kind", "end")
    of_kind = lambda k: F.count_if(F.col("kind") == KINDS.index(k))
    per_row = base.unionByName(added).groupBy("row").agg(
        F.array_sort(F.collect_list(F.when(F.col("spanned"), span))).alias("all"),
        of_kind("assign").alias("n_assign"),
        of_kind("access").alias("n_access"),
        of_kind("hex").alias("n_hex"),
        F.count_if("live").alias("n_live"),
        F.count_if("example").alias("n_example"),
    )
    shown = per_row.select(
        "row",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(_text(F.filter("all", lambda s: s["kind"] < LIVE)), 256).alias("base_sha256"),
        _text(F.col("all")).alias("spans"),
        "n_live",
        "n_example",
    )
    empty = {
        name: F.lit("") if name == "spans" else F.sha2(F.lit(""), 256) if name == "base_sha256" else F.lit(0).cast("long")
        for name in RESULTS
    }
    some = finds.where(F.size("hits") > 0).select("row", "doc_id").join(shown, "row", "left")
    none = finds.where(F.size("hits") == 0)
    return some.select("doc_id", *(F.coalesce(F.col(n), v).alias(n) for n, v in empty.items())).unionByName(
        none.select("doc_id", *(v.alias(n) for n, v in empty.items()))
    )


def oracle() -> str:
    """The same for DuckDB: the gaps of a split and the matches give the positions."""
    kinds = " UNION ALL ".join(
        f"SELECT r, {k} AS kind, string_split_regex(t, $P${p}$P$) AS g, regexp_extract_all(t, $P${p}$P$) AS h FROM docs"
        for k, p in enumerate((ASSIGN, ACCESS, HEX, CANDIDATE))
    )
    names = "['" + "', '".join(KINDS) + "']"
    shown = f"string_agg({names}[kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind)"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, lang, source FROM documents),
pieces AS (
  SELECT r, kind, unnest(range(1, len(h) + 1)) AS i, unnest(g[:len(h)]) AS gap, unnest(h) AS hit FROM ({kinds})),
placed AS (
  SELECT r, kind, hit, sum(length(gap) + length(hit)) OVER (PARTITION BY r, kind ORDER BY i) AS e FROM pieces),
fit AS (
  SELECT r, kind, hit, e - length(hit) AS s, e FROM placed
  WHERE CASE kind
    WHEN 0 THEN length(regexp_extract(hit, $P${ASSIGN}$P$, 2)) >= {VALUE_CHARS}
    WHEN 1 THEN length(hit) >= 18
    WHEN 2 THEN length(hit) >= 16
    ELSE regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]')
      AND len(list_distinct(string_split(hit, ''))) >= {DISTINCT_CHARS} END),
base AS (SELECT * FROM fit WHERE kind < {LIVE}),
owned AS (
  SELECT hit, count(DISTINCT [source]) AS owners, count(DISTINCT [source, lang]) AS repositories
  FROM fit JOIN docs USING (r) WHERE kind = {LIVE} GROUP BY hit),
judged AS (
  SELECT f.*, owners <= {MOST_OWNERS} AND repositories <= {MOST_REPOSITORIES} AS live,
         owners >= {EXAMPLE_OWNERS} AS example
  FROM fit f JOIN owned USING (hit) WHERE kind = {LIVE}),
touched AS (
  SELECT DISTINCT j.r, j.s FROM judged j JOIN base b ON b.r = j.r AND b.s < j.e AND j.s < b.e),
every AS (
  SELECT r, kind, s, e FROM base UNION ALL
  SELECT r, kind, s, e FROM judged j WHERE live AND NOT EXISTS (
    SELECT 1 FROM touched t WHERE t.r = j.r AND t.s = j.s)),
spans AS (
  SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex, {shown} FILTER (kind < {LIVE}) AS b, {shown} AS a
  FROM every GROUP BY r),
seen AS (
  SELECT r, count(*) FILTER (live) AS n_live, count(*) FILTER (example) AS n_example FROM judged GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM docs LEFT JOIN spans USING (r) LEFT JOIN seen USING (r)"""
