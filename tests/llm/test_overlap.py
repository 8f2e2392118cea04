"""The pipeline's near copies against all pairs of shingle sets."""

from __future__ import annotations

import numpy as np

import corpus_pipeline
from changefeed.llm import overlap

SCHEMA = "doc_id long, text string, lang string, source string"


def texts():
    rng = np.random.default_rng(5)
    some = lambda n: [f"w{i}" for i in rng.integers(0, 5_000, n)]
    found, passage = [], some(30)
    for n in (22, 60, 150, 400, 900):
        for _ in range(4):
            base = some(n) + passage * (n > 100)
            found.append(base)
            for edits in range(1, 1 + max(2, n // 25)):
                copy = list(base)
                for at in rng.integers(0, n, edits):
                    copy[at] = "edited"
                found.append(copy)
    return [" ".join(words) for words in found] + ["", None, "a b", "A  b"]


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_similar_documents_are_linked_and_no_others(spark):
    rows = [(i, text, "en", "s") for i, text in enumerate(texts())]
    sets, group = [shingles(row[1]) for row in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    near_dedup = dict(corpus_pipeline.STAGES)["near_dedup"]
    got = near_dedup(spark, spark.createDataFrame([*rows, rows[3], (None, rows[0][1], "en", "s")], SCHEMA), "")
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(set(group))


def test_crowded_bands_are_dealt_into_blocks_and_lose_no_link(spark):
    rng = np.random.default_rng(8)
    passage = [f"p{i}" for i in range(60)]
    found = []
    for k in range(120):  # all share a passage; those of a chain are similar to their neighbours only
        own = [f"x{k}-{i}" for i in range(12)] if k % 3 else [f"x0-{i}" for i in range(k // 3, k // 3 + 12)]
        found.append(" ".join(passage + own))
    for k in range(40):
        words = passage + [f"y{i}" for i in range(60)]
        for at in rng.integers(60, 120, 4):
            words[at] = f"z{k}-{at}"
        found.append(" ".join(words))
    rows = [(i, text, "en", "s") for i, text in enumerate(found)]
    sets, group = [shingles(text) for text in found], list(range(len(found)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    docs = spark.createDataFrame(rows, SCHEMA)
    for block in (overlap.BLOCK, 7):
        got = overlap.without_near_copies(docs, block=block)
        assert sorted(r["doc_id"] for r in got.collect()) == sorted(set(group))
    assert 10 < len(set(group)) < 150
