"""The audit of sources against SQL, and its vectors against Spark's CountVectorizer."""

from __future__ import annotations

import re
import string

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.feature import CountVectorizer

from changefeed.llm import source_audit

SCHEMA = "doc_id long, text string, lang string, source string, value string, index string, term string"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def rows():
    rng = np.random.default_rng(3)
    words = [*(f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(100)), "Éa", "éa", "ÉA", "𝒳y", "x1y"]
    found = []
    for i in range(260):
        picks = rng.zipf(1.3, rng.integers(0, 60)) % len(words)
        source = [None, "", "a", "b", "c", "d"][min(5, int(rng.integers(0, 9)))]
        text = "; ".join(words[k] for k in picks) if i % 17 else None
        found.append((i, text, ["en", "de", None][min(2, i % 5 // 2)], source, "v", None, "t"))
    long = (None, "Long tExt_ " * 40_000, "en", "a", None, None, None)
    return [*found, found[5], found[5], long, (9, "only here", "xx", "alone", None, None, None)]


def sql(records, **options):
    con = duckdb.connect()
    con.register("documents", pa.table({n: [r[i] for r in records] for i, n in enumerate(NAMES)}))
    found = con.execute(source_audit.oracle(**options))
    order = [c[0] for c in found.description]
    return order, sorted(map(repr, found.fetchall()))


@pytest.mark.parametrize("min_df", [10, 1, 1_000])
def test_equals_sql(spark, min_df):
    got = source_audit.audit(spark.createDataFrame(rows(), SCHEMA), min_df=min_df).collect()
    order, want = sql(rows(), min_df=min_df)
    assert sorted(repr(tuple(r[c] for c in order)) for r in got) == want


def test_small_blocks_and_chunks_change_nothing(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    got = source_audit.audit(docs, block_bytes=5_000, chunk=8, held=50).collect()
    order, want = sql(rows())
    assert sorted(repr(tuple(r[c] for c in order)) for r in got) == want


def test_vectors_equal_count_vectorizer(spark):
    docs = spark.createDataFrame([r for r in rows() if r[2] == "en"], SCHEMA)
    found, vocabulary = source_audit.vectors(docs)
    term_of = {r["index"]: r.term for r in vocabulary.collect()}
    assert sorted(term_of) == list(range(len(term_of)))
    assert [term_of[i] for i in range(len(term_of))] == sorted(term_of.values(), key=lambda t: t.encode())
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    split = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(lower))
    tokens = spark.createDataFrame([(r[0], split(r[1])) for r in rows() if r[2] == "en"], "doc_id long, words array<string>")
    model = CountVectorizer(inputCol="words", outputCol="v", minDF=10.0, vocabSize=source_audit.VOCAB_SIZE).fit(tokens)
    want = [
        (r.doc_id, sorted((model.vocabulary[i], int(n)) for i, n in zip(r.v.indices, r.v.values, strict=True)))
        for r in model.transform(tokens).collect()
    ]
    got = [
        (r.doc_id, sorted((term_of[i], n) for i, n in zip(r.indices, r.counts, strict=True)))
        for r in found.collect()
    ]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_no_rows(spark):
    assert source_audit.audit(spark.createDataFrame([], SCHEMA)).collect() == []
