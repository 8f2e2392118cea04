"""Stages keep input columns that have the names they use themselves."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from changefeed.llm import divergence

NAMES = "words lines shares size copies taken __row __one __taken keep_id kept label n_words __in0 classes".split()
SCHEMA = "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} string" for n in NAMES)


def rows():
    word = lambda i, k: f"{'the of and to in'.split()[(i + k) % 5]} w{(i * 31 + k * k) % 97}"
    texts = [" ".join(word(i, k) for k in range(30 + i)) for i in range(40)]
    found = [(i, t, "en", f"s{i % 3}", *(f"{n}{i}" for n in NAMES)) for i, t in enumerate(texts)]
    return [*found, found[3], (None, texts[5] + " more", None, None, *[None] * len(NAMES))]


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES[:4])
def test_input_columns_come_back_unchanged(spark, name, stage):
    docs = spark.createDataFrame(rows(), SCHEMA)
    got = stage(spark, docs, "")
    assert got.columns == docs.columns
    found = {tuple(r) for r in got.collect()}
    assert found and found <= set(rows())


def test_equal_rows_are_mixed_each_on_its_own(spark):
    docs = spark.createDataFrame([rows()[0]] * 50 + [rows()[1]] * 50, SCHEMA)
    mix = dict(corpus_pipeline.STAGES)["mix_sources"]
    got = Counter(r["doc_id"] for r in mix(spark, docs, "").collect())
    assert set(got) <= {0, 1} and all(n <= 150 for n in got.values())
    assert got == Counter(r["doc_id"] for r in mix(spark, docs, "").collect())


def test_the_guard_does_not_depend_on_the_size_of_the_table(spark):
    junk = "ZQXJ 77#% KKWV 31@! " * 40
    for n in (1_900, 2_100):  # 20 documents are more, and less, than one in a hundred
        docs = [(i, rows()[i % 40][1], "en", "s", *[None] * len(NAMES)) for i in range(n - 20)]
        docs += [(i, f"{junk}{i}", "xx", "s", *[None] * len(NAMES)) for i in range(n - 20, n)]
        kept = divergence.judge(spark.createDataFrame(docs, SCHEMA).select("doc_id", "text", "lang"))
        odd = kept.where("lang = 'xx' AND NOT base_failed")
        assert odd.where("NOT kept").count() == 0
