"""Quality rules by distribution divergence, in DataFrame functions only.

Every document has two histograms: of its characters over seven classes, and of its words
over a fixed list of common words (all others in one bin). The reference of a language is
the sum of both over all its documents; one more is the sum over all documents, for texts
in several languages. A document's distance is the Jensen-Shannon distance (the square
root of the divergence in bits, 0 to 1) to the nearest reference. It is rejected if it is
long enough for its histogram to mean something and a distance passes the bound. The bound
for words falls with the length: a short text is far from any reference by chance.

The references of languages with at least one document in a hundred are at most 101 with
that of all documents, and go into the plan as literals. A document of a rarer language is
compared with these and with its own language's reference, which is joined by language: no
such key has more than a hundredth of the rows. If that reference is of too few documents to
mean something, the distances do not reject.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed.llm.common import words, written

# Common words of the languages, as they stand inside a sentence.
COMMON_WORDS = (
    "the of and to in is that for it with as was on are by this be at from or "
    "der die und den von zu das mit des auf ist im "
    "de la le et les du que est pour dans un une sur par "
    "el los las y en se por con para su no"
).split()
SYMBOLS = "#*$%&|<>"
WORD_SPAN = 8

RESULTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "char_distance", "word_distance", "base_failed", "kept",
)

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
# Documents shorter than these are not judged by the distance in question.
MIN_CHARS_JUDGED = 200
MIN_WORDS_JUDGED = 60
# Documents of a rare language that make a reference.
MIN_REFERENCE_DOCS = 30
MAX_CHAR_DISTANCE = 0.29
# The bound for words is the first plus the second divided by the number of words.
MAX_WORD_DISTANCE = (0.25, 4.5)


def _length_without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def char_classes(text: Column) -> Column:
    """Counts of a-z, other small letters, capitals, digits, sentence marks, white space, the rest."""
    total = F.length(text)
    found = [
        total - _length_without(text, pattern)
        for pattern in ("[a-z]+", r"[^\x00-\x7F\p{Lu}]+", r"\p{Lu}+", "[0-9]+", r"[.,;:?'\"()\-]+", r"[\x20\x09-\x0D]+")
    ]
    rest = total
    for count in found:
        rest = rest - count
    return F.array(*(c.cast("long") for c in [*found, rest]))


def features(documents: DataFrame, *, common: Sequence[str] = tuple(COMMON_WORDS)) -> DataFrame:
    """The documents with the rules' base counts and the histograms.

    Windows of words are compared by 64-bit hashes within their document.
    """
    text = F.col("__text")
    split = documents.withColumn("__text", F.coalesce(F.col("text").cast("string"), F.lit(""))).withColumn(
        "words", words(text)
    )
    hashed = F.transform(
        F.sequence(F.lit(1), F.size("words") - (WORD_SPAN - 1)),
        lambda i: F.xxhash64(F.slice("words", i, WORD_SPAN)),
    )
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = split.select(
        *documents.columns,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _length_without(text, r"[^#*$%&|<>]+").cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.when(F.size("words") > WORD_SPAN, hashed).otherwise(F.array().cast("array<long>")).alias("windows"),
        char_classes(text).alias("classes"),
        F.filter("words", lambda w: w.isin(*common)).alias("hits"),
    )
    paired = counted.withColumn(
        "ordered",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    ordered = F.col("ordered")
    twice = paired.withColumn(
        "twice",
        F.array_sort(
            F.transform(
                F.filter(
                    ordered,
                    lambda p, k: (F.get(ordered, k - 1)["h"] == p["h"]) | (F.get(ordered, k + 1)["h"] == p["h"]),
                ),
                lambda p: p["i"],
            )
        ),
    )
    span = F.lit(WORD_SPAN)
    ends = F.array_append(F.slice("twice", F.lit(2), F.size("twice")), F.lit(2**31 - 1))
    covered = F.aggregate(
        F.zip_with("twice", ends, lambda a, b: F.least(span, b - a)), F.lit(0), lambda total, n: total + n
    )
    bins = F.array(*(F.lit(c) for c in common))
    per_word = F.transform(bins, lambda c: (F.size("hits") - F.size(F.array_remove("hits", c))).cast("long"))
    return twice.select(
        *documents.columns,
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        "classes",
        F.array_append(per_word, (F.col("n_words") - F.size("hits")).cast("long")).alias("common"),
    )


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b)
    return F.transform(counts, lambda c: F.when(total > 0, c / total).otherwise(F.lit(0.0)))


def js_distance(p: Column, q: Sequence[float] | Column) -> Column:
    """Jensen-Shannon distance of an array of shares to fixed shares or those of a column."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    other = q if isinstance(q, Column) else F.array(*map(F.lit, q))
    terms = F.zip_with(p, other, lambda a, b: part(a, b) + part(b, a))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda x, y: x + y) / 2))


def references(
    counts: DataFrame, *, common: Sequence[str] = tuple(COMMON_WORDS)
) -> tuple[list[tuple], dict[str | None, int], DataFrame | None]:
    """Shares of classes and of common words of all documents and of each frequent language; the
    frequent ones with their documents; and if there are rare ones a table of their shares."""
    sums = [F.sum(F.col("classes")[i]) for i in range(7)]
    sums += [F.sum(F.col("common")[i]) for i in range(len(common) + 1)]
    named = [c.alias(f"s{i}") for i, c in enumerate(sums)]
    by_lang = written(counts.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), *named), "quality-languages")
    columns = [F.sum(c).alias(c) for c in by_lang.columns if c != "lang"]
    everything = by_lang.agg(*columns).first()
    total = everything["docs"] or 0
    frequent = by_lang.where(F.col("docs") * 100 >= total).collect()

    def shares(values: Sequence[int | None]) -> list[float]:
        total = sum(v or 0 for v in values)
        return [(v or 0) / total if total else 0.0 for v in values]

    rows = [everything, *(row[1:] for row in frequent)]
    found = sorted({(tuple(shares(row[1:8])), tuple(shares(row[8:]))) for row in rows})
    if sum(row["docs"] for row in frequent) == total:
        return found, {row["lang"]: row["docs"] for row in frequent}, None
    rare = by_lang.where(F.col("docs") * 100 < total).select(
        F.col("lang").alias("__lang"),
        F.col("docs").alias("__docs"),
        _shares(F.array(*(F.col(f"s{i}") for i in range(7)))).alias("own_shares"),
        _shares(F.array(*(F.col(f"s{i}") for i in range(7, len(sums))))).alias("own_word_shares"),
    )
    return found, {row["lang"]: row["docs"] for row in frequent}, rare


def judge(
    documents: DataFrame,
    *,
    max_char_distance: float = MAX_CHAR_DISTANCE,
    max_word_distance: tuple[float, float] = MAX_WORD_DISTANCE,
    min_chars: int = MIN_CHARS_JUDGED,
    min_words: int = MIN_WORDS_JUDGED,
    with_text: bool = True,
) -> DataFrame:
    """The documents with counts, distances, ``base_failed`` and ``kept``.

    A null text is empty: no words, so the base rule rejects it. A null language is one of
    its own. Rows that repeat are judged alike. No rows give no rows. The input needs
    ``text`` and ``lang``; its columns that have names of results are replaced.
    """
    counts = features(documents.drop(*RESULTS, "classes", "common"))
    counts = written(counts if with_text else counts.drop("text"), "quality-counts")
    found, frequent, rare = references(counts)
    distances = counts.withColumn("shares", _shares(F.col("classes"))).withColumn(
        "word_shares", _shares(F.col("common"))
    )

    def nearest(name: str, which: int) -> Column:
        each = [js_distance(F.col(name), reference[which]) for reference in found]
        return F.array_min(F.array(*each))

    distances = distances.withColumn("char_distance", nearest("shares", 0)).withColumn(
        "word_distance", nearest("word_shares", 1)
    )
    # One guard for all languages, frequent or not.
    enough = F.lit(True)
    for lang, docs in frequent.items():
        if docs < MIN_REFERENCE_DOCS:
            enough = enough & ~F.col("lang").eqNullSafe(F.lit(lang))
    if rare is not None:
        is_frequent = F.lit(False)
        for lang in frequent:
            is_frequent = is_frequent | F.col("lang").eqNullSafe(F.lit(lang))
        known = distances.where(is_frequent)
        own = distances.where(~is_frequent).join(rare, F.col("lang").eqNullSafe(F.col("__lang")))
        own = (
            own.withColumn("char_distance", F.least("char_distance", js_distance(F.col("shares"), F.col("own_shares"))))
            .withColumn(
                "word_distance", F.least("word_distance", js_distance(F.col("word_shares"), F.col("own_word_shares")))
            )
            .drop("__lang", "own_shares", "own_word_shares")
        )
        distances = known.withColumn("__docs", F.lit(None).cast("long")).unionByName(own)
        enough = enough & F.coalesce(F.col("__docs") >= MIN_REFERENCE_DOCS, F.lit(True))

    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    base, slope = max_word_distance
    far = ((F.col("word_chars") >= min_chars) & (F.col("char_distance") > max_char_distance)) | (
        (F.col("n_words") >= min_words) & (F.col("word_distance") > base + slope / F.col("n_words"))
    )
    return (
        distances.withColumn("base_failed", failed)
        .withColumn("kept", ~failed & ~(far & enough))
        .drop("classes", "common", "shares", "word_shares", "__docs")
    )


def kept_documents(documents: DataFrame, **options: object) -> DataFrame:
    """The documents that pass, with the columns they came with, whatever their names.

    Null, empty and short texts do not pass. Rows that repeat pass or fail together.
    """
    others = [c for c in documents.columns if c not in ("text", "lang")]
    places = {c: f"__in{i}" for i, c in enumerate(others)}
    plain = documents.select("text", "lang", *(F.col(f"`{c}`").alias(p) for c, p in places.items()))
    kept = judge(plain, **options).where("kept")
    return kept.select(*(F.col(places.get(c, c)).alias(c) for c in documents.columns))
