"""The pairs that the pipeline's near copies are found by: as many as a group has texts, not as bands."""

from __future__ import annotations

import numpy as np

from changefeed.llm import overlap

SCHEMA = "doc_id long, text string, lang string, source string"


def test_a_large_group_costs_about_one_pair_for_each_text(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base, rows = [f"w{i}" for i in range(300)], []
    for k in range(150):
        words = list(base)
        for at in rng.integers(0, len(words), 2):
            words[at] = f"own{k}-{at}"
        rows.append((k, " ".join(words), "en", "s"))
    asked, walked = [], []
    verified, components = overlap.verified, overlap.components

    def counted(pairs, sets, least):
        asked.append(pairs.count())
        return verified(pairs, sets, least)

    def walk(edges, **options):
        walked.append(edges.distinct().count())
        return components(edges, **options)

    monkeypatch.setattr(overlap, "verified", counted)
    monkeypatch.setattr(overlap, "components", walk)
    got = overlap.without_near_copies(spark.createDataFrame(rows, SCHEMA))
    assert [r["doc_id"] for r in got.collect()] == [0]
    assert sum(asked) < 3 * len(rows)
    assert sum(walked) < 2 * len(rows)
